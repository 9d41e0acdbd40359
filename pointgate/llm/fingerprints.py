"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

A text's shingles are its runs of five words between white space (a shorter text is one shingle).  Each shingle is
hashed once; the leading bits choose one of 256 bins and a bin keeps the smallest hash.  An empty bin looks at the
other bins in an order of its own, the same for all texts, and takes over the first that is not empty.  Of each bin
four bits are kept, sixteen bins to a 64-bit word.  Two fingerprints agree in a bin by chance once in sixteen times;
``likeness`` takes that out and estimates the Jaccard similarity of the shingle sets.

Built from DataFrame functions alone: everything about a text is worked out inside its row, so no shingle is ever
shuffled.  Null texts count as empty.  An empty text (or only white space) has an empty fingerprint, alike 1 to
another empty one and 0 to any other.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointgate.llm.neighbours import next_ids
from pointgate.llm.text import materialise, prepare

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
LOW_BITS = 4
WORDS = BINS * LOW_BITS // 64
_PER_WORD = 64 // LOW_BITS
_PROBES = 6


def let(value: Column, body) -> Column:
    """Name a value inside an expression, so that it is worked out once."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column) -> Column:
    """One hash per run of five words; one hash for a shorter text; none for an empty one."""
    words = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")

    def over(hashes: Column) -> Column:
        run = F.xxhash64(*[F.get(hashes, F.lit(k)) for k in range(SHINGLE - 1)])  # for texts of up to four words
        many = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - F.lit(SHINGLE)),
            lambda i: F.xxhash64(*[F.get(hashes, i + F.lit(k)) for k in range(SHINGLE)]),
        )
        return F.when(F.size(hashes) >= SHINGLE, many).otherwise(F.array(run))

    full = let(F.transform(words, lambda w: F.xxhash64(w)), over)
    return F.when(F.length(F.trim(F.regexp_replace(text, r"\s+", " "))) > 0, full).otherwise(
        F.array().cast("array<bigint>")
    )


def bin_of(value: Column) -> Column:
    """The leading bits of a hash, in the order that signed comparison gives."""
    return (F.shiftright(value, 64 - BIN_BITS) + F.lit(BINS // 2)).cast("int")


def smallest_per_bin(hashes: Column) -> Column:
    """The smallest hash of each bin that has any, by bin."""

    def firsts(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(ordered, i - F.lit(1)))),
        )

    return let(F.sort_array(hashes), firsts)


def spread(minima: Column) -> Column:
    """All bins in order, null where empty."""

    def placed(pair: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.lit(BINS)),
            lambda b: F.get(pair["v"], F.get(pair["p"], b - F.lit(1)) - F.lit(1)),
        )

    def looked_up(values: Column) -> Column:
        own = F.transform(values, bin_of)
        # position in the list of minima for each bin, 0 where there is none
        return let(
            own,
            lambda bins: let(
                F.struct(
                    values.alias("v"),
                    F.transform(
                        F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.array_position(bins, b).cast("int")
                    ).alias("p"),
                ),
                placed,
            ),
        )

    return let(minima, looked_up)


def probe(target: Column, attempt: int) -> Column:
    return F.pmod(F.xxhash64(target, F.lit(attempt)), F.lit(BINS)).cast("int")


def densified(bins: Column) -> Column:
    """Fill each empty bin from the first full bin in the order of its own probes, then of hashes of (bin, other)."""

    def fill(own: Column) -> Column:
        def rest(b: Column) -> Column:
            others = F.transform(
                F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.get(own, j).isNotNull()),
                lambda j: F.struct(F.xxhash64(b, F.lit(-1), j).alias("r"), F.get(own, j).alias("v")),
            )
            return F.array_min(others)["v"]

        return F.transform(
            own,
            lambda v, b: F.coalesce(v, *[F.get(own, probe(b, t)) for t in range(_PROBES)], rest(b)),
        )

    return let(bins, fill)


def packed(bins: Column) -> Column:
    """Low-order bits of all bins as 64-bit words, the first bin highest in the first word.

    The bits are those of a hash of minimum and bin: copies of one minimum must not agree by chance in all their bins.
    """
    mask = F.lit((1 << LOW_BITS) - 1).cast("bigint")
    low = F.transform(bins, lambda v, b: F.xxhash64(v, b).bitwiseAND(mask))

    def pack(own: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.lit(BINS), F.lit(_PER_WORD)),
            lambda begin: F.aggregate(
                F.slice(own, begin, F.lit(_PER_WORD)),
                F.lit(0).cast("bigint"),
                lambda word, bits: F.shiftleft(word, LOW_BITS).bitwiseOR(bits),
            ),
        )

    return let(low, pack)


def fingerprint_words(text: Column) -> Column:
    """The packed fingerprint of a text as an array of 64-bit words; an empty array for an empty text."""

    def of(minima: Column) -> Column:
        return F.when(F.size(minima) == 0, F.array().cast("array<bigint>")).otherwise(packed(densified(spread(minima))))

    return let(smallest_per_bin(shingle_hashes(text)), of)


def as_hex(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.lower(F.lpad(F.hex(w), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, chance agreement taken out."""
    ones = F.lit(int("1" * (64 // LOW_BITS), 16)).cast("bigint")  # lowest bit of each bin's group

    def differing(x: Column, y: Column) -> Column:
        def count(d: Column) -> Column:
            half = d.bitwiseOR(F.shiftrightunsigned(d, 1))
            return F.bit_count(half.bitwiseOR(F.shiftrightunsigned(half, 2)).bitwiseAND(ones))

        return count(x.bitwiseXOR(y))

    apart = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda total, n: total + n)
    chance = 1.0 / (1 << LOW_BITS)
    share = (F.lit(float(BINS)) - apart) / F.lit(float(BINS))
    estimate = F.greatest(F.lit(0.0), (share - F.lit(chance)) / F.lit(1.0 - chance))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(estimate)
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint words of every row.  One pass, no shuffle."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint_words(text).alias("words"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness and that to the next document.

    The edited text has its last ``floor(n / 3)`` code points replaced by the first as many of the next document in
    descending ``doc_id`` (after the last: the first).  Rows without an id have no next document and are edited with
    an empty one; of rows that share an id, the smallest text stands for the id as a neighbour.

    Only the borrowed beginnings travel besides the texts, and of each result its fingerprint.
    """
    prepare(docs.sparkSession)
    doc_id = F.col("doc_id")
    if docs.schema["doc_id"].dataType.simpleString() != "bigint":  # a plain column keeps the exchanges below alike
        doc_id = doc_id.cast("long").alias("doc_id")
    rows = docs.select(doc_id, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chars = rows.select("doc_id", F.length("text").alias("n")).groupBy("doc_id").agg(F.max("n").alias("n"))
    following = next_ids(chars)
    # per lender: who borrows and how much at most
    wanted = following.join(chars, "doc_id").select(
        F.col("next_id").alias("doc_id"), F.col("doc_id").alias("borrower"), F.expr("n div 3").cast("int").alias("need")
    )
    # Both joins below read the same exchange of (doc_id, text): the texts are shuffled once.
    named = rows.where("doc_id is not null")
    lent = (
        named.join(wanted, "doc_id")
        .select(F.col("borrower").alias("doc_id"), F.expr("substring(text, 1, need)").alias("lent"))
        .groupBy("doc_id")
        .agg(F.min("lent").alias("lent"))
    )
    size = F.length("text")
    keep = size - F.floor(size / 3).cast("int")
    borrowed = F.substring(F.coalesce(F.col("lent"), F.lit("")), F.lit(1), F.floor(size / 3).cast("int"))
    alone = rows.where("doc_id is null").withColumn("lent", F.lit(""))
    joined = named.join(lent, "doc_id", "left").unionByName(alone).select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        "text",
        F.concat(F.substring("text", F.lit(1), keep), borrowed).alias("edited"),
    )
    made = materialise(
        joined.select(
            "doc_id",
            "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            fingerprint_words(F.col("text")).alias("words"),
            fingerprint_words(F.col("edited")).alias("edited_words"),
        ),
        "fingerprints",
    )
    near = (
        following.join(
            made.groupBy("doc_id").agg(F.min(F.struct(F.size("words"), "words"))["words"].alias("next_words"))
            .withColumnRenamed("doc_id", "next_id"),
            "next_id",
        ).drop("next_id")
    )
    empty = F.array().cast("array<bigint>")
    return made.join(near, "doc_id", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_hex(F.col("words")).alias("fingerprint"),
        as_hex(F.col("edited_words")).alias("edited_fingerprint"),
        likeness(F.col("words"), F.col("edited_words")).alias("near_edited"),
        likeness(F.col("words"), F.coalesce("next_words", empty)).alias("near_next"),
    )
