"""Bottom-k sketches of shingle hashes, in DataFrame functions only.

A fingerprint is the k smallest distinct 64-bit hashes of a text's shingles of five words (of fewer words, one
shingle of all). Fingerprints of parts merge into the fingerprint of the whole: the k smallest of their union.
Of two fingerprints, the k smallest of the union are a random sample of the union of both shingle sets; the
share that both have estimates the resemblance (exactly where no sketch is full).

Defined cases: null and empty texts and texts without words have an empty fingerprint; two empty fingerprints
resemble each other by 1, an empty and another one by 0; equal texts have equal fingerprints; a single
document is its own next one; equal and null doc_ids are ordered by their texts, null ids first; an empty table gives an
empty result; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
WIDTH = 5


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The k smallest shingle hashes, ascending. ``text`` may be any expression; it is evaluated once."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"\s+"), "")

    def of(words: Column) -> Column:
        rolled = F.transform(
            F.sequence(F.lit(0), F.size(words) - width), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)])
        )
        hashes = F.when(F.size(words) >= width, rolled).when(
            F.size(words) > 0, F.array(F.xxhash64(words))
        ).otherwise(F.array().cast("array<long>"))
        return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)

    return F.get(F.transform(F.array(words), of), F.lit(0))


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), ",")


def _both(a: Column, b: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of two shingle sets."""
    sample = _both(a, b, k)
    shared = F.size(F.array_intersect(sample, F.array_intersect(a, b)))
    return F.when(F.size(sample) == 0, 1.0).otherwise(shared / F.size(sample))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: (k - 1) / the share of the hash range below the k-th."""
    below = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / below)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    union = distinct_shingles(_both(a, b, k), k)
    share = resemblance(a, b, k) * union / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), share))


def merged(parts: DataFrame, by: str, hashes: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each ``by``: distinct hashes first, then the k smallest, kept to k rows in every task."""
    alone = parts.select(by, F.explode(hashes).alias("h")).distinct()
    ranked = alone.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy("h"))).filter(F.col("r") <= k)
    return ranked.groupBy(by).agg(F.sort_array(F.collect_list("h")).alias(hashes))


def _ranges(docs: DataFrame, parts: int) -> Column:
    """The number of the doc_id's range; the bounds are percentiles, at most ``parts`` numbers on the driver."""
    shares = [k / parts for k in range(1, parts)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 100 * parts).alias("b")).first().b or [0]
    ordered = F.array(*[F.lit(b).cast("long") for b in sorted(set(bounds))])
    return F.coalesce(F.size(F.filter(ordered, lambda b: b < F.col("doc_id"))), F.lit(0))


def with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, text, sketch, next_text, next_sketch in the cyclic order of doc_id.

    Each range of doc_id is ordered by itself; a range's last document takes the first of the next range.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    ranged = plain.withColumn("range", _ranges(plain, max(2, min(1000, 2 * parts))))
    rows = ranged.repartition("range").withColumn("sketch", sketch(F.col("text"), k))
    order = Window.partitionBy("range").orderBy(F.asc_nulls_first("doc_id"), "text")
    rows = rows.withColumn("follower", F.lead(F.struct("text", "sketch")).over(order))
    # One text for each range: its first document's, found by id before any text is moved.
    first = ranged.groupBy("range").agg(F.min("doc_id").alias("least"), F.bool_or(F.col("doc_id").isNull()).alias("some_null"))
    first = first.select(F.col("range").alias("at"), F.when(~F.col("some_null"), F.col("least")).alias("first_id"))
    heads = (
        ranged.join(F.broadcast(first), (F.col("range") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy("range").agg(F.min("text").alias("head"))
    )
    across = Window.orderBy("range")
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(
        "range", F.coalesce(F.lead("head").over(across), F.first("head").over(whole)).alias("head")
    )
    return rows.join(heads, "range").select(
        "doc_id", "text", "sketch",
        F.coalesce("follower.text", "head").alias("next_text"),
        F.when(F.col("follower").isNotNull(), F.col("follower.sketch")).otherwise(sketch(F.col("head"), k)).alias("next_sketch"),
    )


def fingerprint_documents(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document's, and their likeness.

    The edited text has its last quarter (in code points, rounded down) replaced by as many of the next
    document's first code points.
    """
    n = F.char_length("text")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - F.floor(n / 4).cast("int")), F.substring(F.col("next_text"), F.lit(1), F.floor(n / 4).cast("int"))
    )
    rows = with_next(docs, k).withColumn("edited", edited)
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), k))
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("shingles"),
        containment(F.col("sketch"), F.col("edited_sketch"), k).alias("contained_in_edited"),
    )
