"""Merkle manifest of a dataset by butterfly exchange.

A row is a leaf: the digest of its columns.  Per group (``lang``) the leaves stand in order of ``doc_id``; runs of
``fanout`` nodes hash to their parent until one node, the subroot, remains; the subroots of all groups, in order of the
group (null first), hash to the root in the same way.

Leaves are ranked without a global sort in one task (ranges, counts per range, offsets) and dealt to blocks of
``fanout ** levels`` consecutive leaves.  A block hashes its own levels.  Then the blocks exchange: in round ``j`` the
blocks whose numbers differ only in digit ``j`` (to the base ``fanout``) swap the subtree roots they hold, and each hashes the
parent for itself.  A group of the exchange has at most ``fanout`` members, ancestors are hashed redundantly, and
after the last round every block holds the subroot and the siblings on its way up: there is no downward pass.  Where
the last subtree of a run is not full, its blocks stand in for the numbers that are missing.  The groups go through
the same exchange to the root.

Nulls in any column hash as ``-``; a null id comes first, equal ids are ordered by their leaf; rows that repeat are
leaves each.  Texts of any length are hashed whole.  An empty table gives no rows.  DataFrame functions but for the
levels inside a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointgate.llm.text import materialise, partitions_for, prepare

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK = ["has_group", "group", "block"]
STEP_FIELDS = [("before", pa.string()), ("after", pa.string())]
STEPS = "array<struct<before: string, after: string>>"


@dataclass(frozen=True)
class ManifestOptions:
    fanout: int = 8
    #: Levels that a block hashes by itself: blocks have fanout ** levels leaves.
    levels: int = 3


def leaf_of(values: Sequence[Column]) -> Column:
    """Digest of the values, each as its length in bytes, a colon and the value; ``-`` for null."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, values)), 256)


def ranked(leaves: DataFrame) -> DataFrame:
    """The leaves with ``rank`` and ``size``: the place in their group, from 0, and the number of leaves in it."""
    order = [F.col("has_group"), F.col("group"), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    ranges = materialise(
        leaves.repartitionByRange(partitions_for(leaves.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn("id", F.monotonically_increasing_id()),
        "manifest-ranges",
    ).withColumn("part", F.shiftright("id", 33))
    key = ["has_group", "group"]
    # as many rows as ranges and groups together
    counts = ranges.groupBy(*key, "part").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *key, "part", "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        F.sum("n").over(Window.partitionBy(*key)).alias("size"),
    )
    rank = F.col("base") + F.col("id") - F.col("first")
    return ranges.join(counts, [*key, "part"]).withColumn("rank", rank).drop("id", "part", "first", "base")


def climb(nodes: list[str], fanout: int) -> list[str]:
    return [hashlib.sha256("".join(nodes[k : k + fanout]).encode()).hexdigest() for k in range(0, len(nodes), fanout)]


def block_roots(leaves: DataFrame, options: ManifestOptions) -> DataFrame:
    """The root of each block, and the number of blocks of its group; a task holds one block at a time."""
    width = options.fanout**options.levels

    def run(block: pa.Table) -> pa.Table:
        nodes, _ = local(block.sort_by("rank"), options)
        kept = block.slice(0, 1)
        count = -(-kept.column("size")[0].as_py() // width)
        out = {c: kept.column(c) for c in BLOCK}
        return pa.table(out | {"blocks": pa.array([count], pa.int64()), "root": pa.array(nodes, pa.string())})

    return leaves.groupBy(*BLOCK).applyInArrow(
        run, "has_group boolean, group string, block long, blocks long, root string"
    )


def local(block: pa.Table, options: ManifestOptions) -> tuple[list[str], list[list[dict[str, str]]]]:
    """The root of a block as a list of one, and for each leaf the siblings of each level below it."""
    fanout = options.fanout
    nodes, total = block.column("leaf").to_pylist(), block.column("size")[0].as_py()
    steps: list[list[dict[str, str]]] = [[] for _ in nodes]
    for level in range(options.levels):
        if total <= fanout**level:  # one node is left
            break
        for k, own in enumerate(steps):
            at = k // fanout**level
            begin = at - at % fanout
            own.append({"before": "".join(nodes[begin:at]), "after": "".join(nodes[at + 1 : begin + fanout])})
        nodes = climb(nodes, fanout)
    return nodes, steps


def exchanged(blocks: DataFrame, key: list[str], fanout: int) -> DataFrame:
    """Butterfly exchange of subtree roots within each ``key``.

    ``blocks`` has the key, ``block`` (0 to ``blocks`` - 1), ``blocks`` and ``root``; other columns stay.  ``root`` becomes
    that of the whole key, and ``steps`` lead from the old one to it.
    """
    kept = [c for c in blocks.columns if c not in ("block", "blocks", "root")]
    now = materialise(blocks.withColumn("steps", F.array().cast(STEPS)), "butterfly")
    most = now.agg(F.max("blocks")).first()[0] or 0
    reach = 1  # blocks below a subtree root that is held
    while reach < most:
        tree = F.expr(f"block div {reach}")
        first = F.expr(f"block div {reach * fanout}") * fanout * reach  # the first block of the run
        own = F.least(F.lit(reach), F.col("blocks") - tree * reach)  # blocks of this subtree
        lanes = F.least(F.lit(reach), F.col("blocks") - first)  # blocks of the run's first subtree
        offers = now.select(
            *key, first.alias("run"), F.expr(f"(block div {reach}) % {fanout}").alias("digit"), "root",
            F.explode(F.sequence(F.expr(f"block % {reach}"), lanes - 1, own)).alias("lane"),
        )
        swapped = offers.groupBy(*key, "run", "lane").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("digit", "root"))), lambda s: s["root"]).alias("roots")
        )
        joined = F.array_join("roots", "")
        size = F.length(F.element_at("roots", 1))  # digests are equally long
        met = now.withColumn("run", first).withColumn("lane", F.expr(f"block % {reach}")).join(swapped, [*key, "run", "lane"])
        digit = F.expr(f"(block div {reach}) % {fanout}").cast("int")
        step = F.struct(
            F.substr(joined, F.lit(1), digit * size).alias("before"),
            F.substr(joined, (digit + 1) * size + 1).alias("after"),
        )
        done = F.col("blocks") <= reach  # a lone node stays as it is
        now = materialise(
            met.select(
                *kept, "block", "blocks",
                F.when(done, F.col("root")).otherwise(F.sha2(joined, 256)).alias("root"),
                F.when(done, F.col("steps")).otherwise(F.concat("steps", F.array(step))).alias("steps"),
            ),
            "butterfly",
        )
        reach *= fanout
    return now


def folded_up(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def siblings(steps: Column) -> Column:
    """All siblings on the way up, level by level, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "")


def manifest(
    docs: DataFrame, now: dict[str, Column] | None = None, options: ManifestOptions = ManifestOptions()
) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, ``steps`` (the siblings of each level), and ``leaf_now``.

    ``now`` gives columns that differ from those the manifest is made of; ``leaf_now`` is the leaf with them, to be
    held against the manifest by ``folded_up(leaf_now, steps) == root``.
    """
    prepare(docs.sparkSession)
    present = {c: F.col(c) for c in COLUMNS}
    key = BLOCK[:2]
    width = options.fanout**options.levels
    hashed = materialise(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("lang").isNotNull().alias("has_group"),
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("group"),
            leaf_of(list(present.values())).alias("leaf"),
            leaf_of(list((present | (now or {})).values())).alias("leaf_now"),
        ),
        "manifest-hashes",
    )
    leaves = materialise(ranked(hashed).withColumn("block", F.expr(f"rank div {width}")), "manifest-leaves")
    upper = exchanged(block_roots(leaves, options), key, options.fanout)
    subroots = upper.where("block = 0").select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(True).alias("has_group"), F.lit("").alias("group"),
        F.concat(F.col("has_group").cast("int").cast("string"), F.col("group")).alias("leaf"), "root",
    )
    tops = exchanged(
        ranked(subroots).select("leaf", F.col("rank").alias("block"), F.col("size").alias("blocks"), "root"),
        [], options.fanout,
    ).select(
        F.expr("substr(leaf, 1, 1) = '1'").alias("has_group"), F.expr("substr(leaf, 2)").alias("group"),
        F.col("root").alias("top"), F.col("steps").alias("top_steps"),
    )
    proofs = upper.join(tops, key).select(
        *BLOCK, F.col("root").alias("subroot"), F.col("top").alias("root"), F.concat("steps", "top_steps").alias("steps")
    )

    def run(block: pa.Table, proof: pa.Table) -> pa.Table:
        block = block.sort_by("rank")
        _, steps = local(block, options)
        above = proof.column("steps")[0].as_py()
        out = {c: block.column(c) for c in ("doc_id", "leaf", "leaf_now")}
        for c in ("subroot", "root"):
            out[c] = pa.array(proof.column(c).to_pylist() * len(steps), pa.string())
        out["steps"] = pa.array([own + above for own in steps], pa.list_(pa.struct(STEP_FIELDS)))
        return pa.table(out)

    return (
        leaves.groupBy(*BLOCK).cogroup(proofs.groupBy(*BLOCK))
        .applyInArrow(run, f"doc_id long, leaf string, leaf_now string, subroot string, root string, steps {STEPS}")
    )
