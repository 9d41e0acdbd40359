"""MinHash near-dedup: BagMinHash signatures over multisets of five-word shingles, banding, exact verification.

Two texts are linked when the weighted Jaccard similarity of their shingle multisets (sum of smaller over sum of
larger counts) is at least ``threshold``; classes are the connected components of the links.

* Texts that are equal after lower-casing and up to white space form one node; only nodes are compared.
* A node's signature is cut into bands; nodes that share a band's key meet in a bucket.  First every bucket compares
  its most connected member (the one that meets most others over all buckets) with all others: one comparison per
  member, however large a group of near copies is.  Links are verified on the multisets and merged to components.
* Buckets that still hold several components are cut into blocks of bounded size by a hash of the member; a task
  takes two blocks and compares members of different components, each pair only in the first band it shares.  It sends
  the links that joined something, at most one per member.  So no link that could join two components is left out, and
  no group is ever held, ordered or sent whole.
* Pairs whose sizes rule the threshold out, or whose signatures agree far too little (six standard deviations), are
  dropped before their multisets are compared.

Null texts count as empty; all texts without words are one class.  A text of fewer than five words is one shingle.
Repeated rows and ids are kept: one result row per input row.  The class id is the smallest ``doc_id`` of the class
(null if no row of it has one).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointgate.llm.bagminhash import signatures
from pointgate.llm.components import connected
from pointgate.llm.text import hash_words, materialise, mix, pieces, row_of, split_words, text_column, texts_of

SHINGLE = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class NearOptions:
    threshold: float = 0.8
    bands: int = 24
    rows: int = 5
    block_bytes: int = 2_000_000

    @property
    def size(self) -> int:
        return self.bands * self.rows

    @property
    def least_agreement(self) -> float:
        return self.threshold - 6 * (self.threshold * (1 - self.threshold) / self.size) ** 0.5


def shingles(texts: pa.Array) -> tuple[list[np.ndarray], list[bytes]]:
    """Per text the hashes of its shingles in order, and a key of its word sequence."""
    offsets, codes, distinct = split_words(texts)
    words = hash_words([w.lower() for w in distinct], 3)[codes] if len(codes) else np.zeros(0, np.uint64)
    rolled = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            rolled = rolled * _FACTOR + words[k : k + len(rolled)]
    rolled = mix(rolled)
    found, keys = [], []
    for begin, end in zip(offsets[:-1], offsets[1:]):
        raw = words[begin:end].tobytes()
        keys.append(hashlib.blake2b(raw, digest_size=16).digest())
        if end - begin >= SHINGLE:
            found.append(rolled[begin : end - SHINGLE + 1])
        elif end > begin:
            found.append(np.frombuffer(hashlib.blake2b(raw, digest_size=8).digest(), np.uint64))
        else:
            found.append(np.zeros(0, np.uint64))
    return found, keys


def signed(docs: DataFrame, options: NearOptions) -> DataFrame:
    """doc_id, tie (hash of the text), node, number of shingles, band keys and 16-bit signature components of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = np.arange(options.bands, dtype=np.uint64) * _FACTOR
        for piece in pieces(batches):
            found, keys = shingles(text_column(piece))
            counted = [np.unique(f, return_counts=True) for f in found]
            elements = np.concatenate([c[0] for c in counted])
            weights = np.concatenate([c[1] for c in counted])
            owners = row_of(np.concatenate([[0], np.cumsum([len(c[0]) for c in counted])]))
            made = signatures(elements, weights, owners, len(found), options.size)
            key = np.tile(band, (len(found), 1))
            with np.errstate(over="ignore"):
                for k in range(options.rows):
                    key = mix(key * _FACTOR + made[:, k :: options.rows].astype(np.uint64))
            low = made.astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("tie"),
                    pa.array(keys, pa.binary()),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([k if len(f) else [] for k, f in zip(key.astype(np.int64), found)], pa.list_(pa.int64())),
                    pa.array([row.tobytes() for row in low], pa.binary()),
                ],
                ["doc_id", "tie", "node", "n", "bands", "signature"],
            )

    schema = "doc_id long, tie long, node binary, n long, bands array<long>, signature binary"
    return texts_of(docs).withColumn("tie", F.xxhash64("text")).mapInArrow(run, schema)


def multisets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and its sorted shingle hashes (repeats included), for the texts of ``wanted`` (doc_id, node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found, keys = shingles(text_column(piece))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array([np.sort(f).tobytes() for f in found], pa.binary())],
                ["node", "bag"],
            )

    texts = texts_of(docs).join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    made = texts.mapInArrow(run, "node binary, bag binary")
    # an id that is repeated with other texts brings other nodes along
    return made.join(wanted.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.max("bag").alias("bag"))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted multisets."""
    if len(a) > len(b):
        a, b = b, a
    nth = np.arange(len(a)) - np.searchsorted(a, a, side="left")
    return int((nth < np.searchsorted(b, a, side="right") - np.searchsorted(b, a, side="left")).sum())


def agreeing(pairs: DataFrame, nodes: DataFrame, options: NearOptions) -> DataFrame:
    """Pairs (a, b) that sizes and signatures leave possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            sides = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, options.size)
                for c in ("sa", "sb")
            ]
            keep = (sides[0] == sides[1]).mean(axis=1) >= options.least_agreement
            kept = batch.select(["a", "b"]).filter(pa.array(keep))
            yield kept

    side = nodes.select("node", "n", "signature")
    left = side.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    right = side.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
    sized = pairs.join(left, "a").join(right, "b")
    sized = sized.where(F.least("na", "nb") >= F.lit(options.threshold) * F.greatest("na", "nb"))
    return sized.select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary")


def verified(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose multisets reach the threshold, with their similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for x, y in zip(batch.column("bag_a"), batch.column("bag_b")):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = overlap(a, b)
                alike.append(both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0)
            keep = pa.array([s >= threshold for s in alike], pa.bool_())
            whole = pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(alike, pa.float64())], ["a", "b", "similarity"]
            )
            yield whole.filter(keep)

    left = bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))
    right = bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "bag_a", "bag_b")
    return joined.mapInArrow(run, "a binary, b binary, similarity double")


def meetings(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (bucket, node, members) of buckets with several nodes, and the leader of each bucket."""
    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = materialise(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "sizes")
    shared = materialise(entries.join(sizes, "bucket"), "meetings")
    reach = shared.groupBy("node").agg(F.sum("members").alias("reach"))
    leaders = (
        shared.join(reach, "node").groupBy("bucket").agg(F.max(F.struct("reach", "node"))["node"].alias("leader"))
    )
    return shared, materialise(leaders, "leaders")


def near_links(docs: DataFrame, options: NearOptions = NearOptions()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rows with their node; verified links (a, b) that connect every class; each linked node's component."""
    rows = materialise(signed(docs, options), "signatures")
    nodes = materialise(
        rows.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.max("n").alias("n"),
            F.max("bands").alias("bands"), F.max("signature").alias("signature"),
        ),
        "nodes",
    )
    shared, leaders = meetings(nodes)
    stars = (
        shared.join(leaders, "bucket").where("leader != node")
        .select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    )
    possible = materialise(agreeing(stars, nodes, options), "pairs")
    wanted = (
        possible.select(F.col("a").alias("node")).union(possible.select("b"))
        .union(shared.where("members > 2").select("node")).distinct()
    )
    bags = materialise(multisets(docs, nodes.join(wanted, "node").select("doc_id", "node")), "multisets")
    links = materialise(verified(possible, bags, options.threshold), "star-links").select("a", "b")
    components = connected(links)
    entries = open_entries(shared, components)
    if not entries.isEmpty():
        more = materialise(block_links(entries, leaders, nodes, bags, options), "block-links")
        if not more.isEmpty():
            links = links.union(more)
            components = connected(links)
    return rows, links, components


def open_entries(shared: DataFrame, components: DataFrame) -> DataFrame:
    """Entries (bucket, node, component) of buckets that still hold several components.

    A bucket of two nodes is settled by its star.
    """
    labelled = (
        shared.where("members > 2").select("bucket", "node")
        .join(components, "node", "left")
        .select("bucket", "node", F.coalesce("component", "node").alias("component"))
    )
    mixed = materialise(
        labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo != hi").select("bucket"),
        "mixed",
    )
    return materialise(labelled.join(mixed, "bucket"), "open")


def block_links(
    entries: DataFrame, leaders: DataFrame, nodes: DataFrame, bags: DataFrame, options: NearOptions
) -> DataFrame:
    """Links between components inside open buckets, each task holding two blocks of one bucket."""
    weight = F.col("n") * 8 + options.size * 2 + 400
    leads = leaders.withColumnRenamed("leader", "node").withColumn("leads", F.lit(True))
    sized = materialise(
        entries.join(nodes.select("node", "n"), "node").withColumn("bytes", weight).drop("n")
        .join(leads, ["bucket", "node"], "left").withColumn("leads", F.coalesce("leads", F.lit(False))),
        "open-sizes",
    )
    counts = materialise(
        sized.groupBy("bucket").agg(F.ceil(F.sum("bytes") / options.block_bytes).cast("int").alias("count")), "blocks"
    )
    units = (
        sized.join(counts, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("count")).cast("int"))
        # unit (low, high): all pairs of blocks, a block with itself included
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
        .select("bucket", "node", "component", "leads", "block", F.least("block", "other").alias("low"),
                F.greatest("block", "other").alias("high"))
    )
    full = units.join(nodes.select("node", "bands", "signature"), "node").join(bags, "node")

    def run(table: pa.Table) -> pa.Table:
        found = settle(table, options)
        return pa.table(
            {"a": pa.array([f[0] for f in found], pa.binary()), "b": pa.array([f[1] for f in found], pa.binary())}
        )

    return full.groupBy("bucket", "low", "high").applyInArrow(run, "a binary, b binary").distinct()


def settle(table: pa.Table, options: NearOptions) -> list[tuple[bytes, bytes]]:
    """The links among one or two blocks of a bucket that join components."""
    bucket = table.column("bucket")[0].as_py()
    names = table.column("node").to_pylist()
    blocks = table.column("block").to_numpy()
    crossing = blocks.min() != blocks.max()
    labels = table.column("component").to_pylist()
    number = {c: k for k, c in enumerate(dict.fromkeys(labels))}
    own = np.array([number[c] for c in labels])
    root = list(range(len(number)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    count = len(names)
    bags = [np.frombuffer(b, np.uint64) for b in table.column("bag").to_pylist()]
    sizes = np.array([len(b) for b in bags])
    marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(count, options.size)
    keys = table.column("bands").combine_chunks().flatten().to_numpy().reshape(count, options.bands)
    band = int(np.flatnonzero(keys[0] == bucket)[0])
    leads = table.column("leads").to_numpy()
    alike: list[np.ndarray] = []
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    for i in range(count - 1):
        rest = np.arange(i + 1, count)
        rest = rest[(own[rest] != own[i]) & ~(leads[rest] | leads[i])]  # a leader met everyone already
        if crossing:
            rest = rest[blocks[rest] != blocks[i]]
        rest = rest[np.minimum(sizes[rest], sizes[i]) >= options.threshold * np.maximum(sizes[rest], sizes[i])]
        if not len(rest):
            continue
        agree = (marks[rest] == marks[i]).mean(axis=1)
        first = (keys[rest] == keys[i]).argmax(axis=1) == band
        keep = first & (agree >= options.least_agreement)
        alike.append(agree[keep].astype(np.float32))
        left.append(np.full(int(keep.sum()), i, np.int32))
        right.append(rest[keep].astype(np.int32))
    found = []
    if not left:
        return found
    # the most alike first, so that most others are joined when their turn comes
    order = np.argsort(-np.concatenate(alike), kind="stable")
    firsts, seconds = np.concatenate(left)[order], np.concatenate(right)[order]
    for i, j in zip(firsts, seconds):
        a, b = top(own[i]), top(own[j])
        if a != b:
            both = overlap(bags[i], bags[j])
            if both >= options.threshold * (sizes[i] + sizes[j] - both):
                root[max(a, b)] = min(a, b)
                found.append((names[i], names[j]))
    return found


def near_classes(docs: DataFrame, options: NearOptions = NearOptions()) -> DataFrame:
    """doc_id, class_id and node for every row of ``docs``."""
    rows, _, components = near_links(docs, options)
    placed = placed_rows(rows, components)
    ids = materialise(placed.groupBy("component").agg(F.min("doc_id").alias("class_id")), "class-ids")
    return placed.join(ids, "component").select("doc_id", "class_id", "node")


def placed_rows(rows: DataFrame, components: DataFrame) -> DataFrame:
    return rows.select("doc_id", "tie", "node").join(components, "node", "left").select(
        "doc_id", "tie", "node", F.coalesce("component", "node").alias("component")
    )


def one_of_each(docs: DataFrame, options: NearOptions = NearOptions()) -> DataFrame:
    """One row of ``docs`` for each class, with all columns: that of the smallest ``doc_id``.

    Where the smallest id repeats with several texts of the class, the text with the smallest key stays; rows that
    repeat it are one row.  A row without an id stays only for a class in which no row has one.
    """
    found, _, components = near_links(docs, options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "tie")).alias("first")
    keep = materialise(
        placed_rows(found, components).groupBy("component").agg(first).select(
            F.col("first.doc_id").alias("keep_id"), F.col("first.tie").alias("keep_tie")
        ),
        "kept",
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("row_id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("row_tie"),
    )
    same = F.col("row_id").eqNullSafe(F.col("keep_id")) & (F.col("row_tie") == F.col("keep_tie"))
    kept = rows.join(keep, same, "left_semi").dropDuplicates(["row_id", "row_tie"])
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
