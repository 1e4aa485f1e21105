"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A seed is a mask over consecutive words: its 1-places are hashed, its 0-places may differ. Seeds of the texts
meet seeds of the benchmark items; a hit aligns the text with the whole item. The alignment is verified: in
some window of 20 places (the whole item if it is shorter) at least 80 % of the words must be equal. So
passages with substituted words are found and chance hits are not.

From 17 words on, whichever fifth of a window's words is substituted, some mask has a hit. Items of 7 to 16 words
also have three neighbouring words as a seed: so many substitutions as leave 80 % equal cannot touch all of an item's
threes that do not overlap. Items of 1 to 6 words are one seed each and must stand in the text whole.

Words are runs of letters and digits in lower case.

Defined cases: null and empty texts and items, and those without words, match nothing; repeated rows are each judged;
rows with a null doc_id or a repeated one are told apart by their text; items with a null item_id count as others do;
items of one item_id (or none) with several texts are each compared, and the best alignment is given; empty tables give an
empty result; only doc_id and text (item_id and text) are read, and only hits' columns are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.llm.jaccard import text_key

MASKS = ("1111011", "110110011", "1010110101", "11001010011")
WINDOW = 20
LEAST_EQUAL = 0.8
WHOLE_BELOW = 7  # items of fewer words must be found whole
THREES_BELOW = 17  # items of fewer words also have seeds of three neighbouring words
BROADCAST_SEEDS = 1_000_000  # 32 bytes each: some tens of MB as a hash table; beyond it a shuffled join


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _masks(lengths: list[int]) -> list[str]:
    """The masks that items need: those of long ones, threes for items under 17 words, and one for each length under 7."""
    masks = list(MASKS)
    if any(WHOLE_BELOW <= n < THREES_BELOW for n in lengths):
        masks.append("111")
    return masks + ["1" * n for n in lengths if 0 < n < WHOLE_BELOW]


def _seeds(at: Column, hashes: Column, masks: list[str]) -> Column:
    """The hashes of all masks laid at one place. At a text's end, what is left of a mask matches no whole one."""
    made = []
    for mask in masks:
        places = [F.get(hashes, at + k) for k, bit in enumerate(mask) if bit == "1"]
        made.append(F.xxhash64(F.lit(mask), *places))
    return F.array(*made)


def _laid(rows: DataFrame, masks: list[str]) -> DataFrame:
    """A row for each place and mask: the columns, ``at`` and ``seed``."""
    span = min(map(len, masks))
    places = F.when(F.size("hashes") >= span, F.sequence(F.lit(0), F.size("hashes") - span))
    return rows.withColumn("at", F.explode(places)).withColumn("seed", F.explode(_seeds(F.col("at"), F.col("hashes"), masks)))


def _item_seeds(bench: DataFrame, masks: list[str]) -> DataFrame:
    """(seed, item_key, item_at, words): the masks that an item of its length has, where they fit into it whole."""
    words, mask, at = F.size("hashes"), F.get(F.array(*map(F.lit, masks)), F.col("number")), F.col("at")
    long = (words >= WHOLE_BELOW) & (F.col("number") < len(MASKS))
    three = (words >= WHOLE_BELOW) & (words < THREES_BELOW) & (mask == "111") & (F.col("number") == len(MASKS))
    whole = (words < WHOLE_BELOW) & (F.length(mask) == words) & (F.col("number") >= len(MASKS))
    placed = bench.withColumn("at", F.explode(F.sequence(F.lit(0), words - 1)))
    laid = placed.select("*", F.posexplode(_seeds(at, F.col("hashes"), masks)).alias("number", "seed"))
    return (
        laid.filter((at + F.length(mask) <= words) & (long | three | whole))
        .select("seed", "item_key", at.alias("item_at"), words.alias("words"))
        .distinct()
    )


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, equal, compared) of every text and item that overlap; the best alignment."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"),
        word_hashes(F.col("text")).alias("hashes"),
    )
    bench = items.select(
        F.col("item_id").cast("long").alias("item_id"), text_key(F.col("text")).alias("item_key"), word_hashes(F.col("text")).alias("hashes")
    ).filter(F.size("hashes") > 0).dropDuplicates(["item_id", "item_key"])
    short = bench.filter(F.size("hashes") < THREES_BELOW).select(F.size("hashes").alias("n")).distinct()
    masks = _masks(sorted(r.n for r in short.collect()))  # at most 16 numbers
    seeds = _item_seeds(bench, masks)
    if seeds.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    start = F.col("at") - F.col("item_at")  # the text's place under the item's first word; may be negative
    hits = (
        _laid(texts, masks)
        .join(seeds, "seed")
        .select(
            "doc_id", "text_key", "item_key", start.alias("start"),
            F.slice("hashes", F.greatest(start, F.lit(0)) + 1, F.col("words") + F.least(start, F.lit(0))).alias("piece"),
        )
        .groupBy("doc_id", "text_key", "item_key", "start")
        .agg(F.first("piece").alias("piece"))
    )
    aligned = hits.join(bench, "item_key")
    skipped = F.greatest(-F.col("start"), F.lit(0))
    equal = F.transform(
        F.sequence(F.lit(0), F.size("hashes") - 1),
        lambda k: F.coalesce(
            F.get("piece", k - skipped).eqNullSafe(F.get("hashes", k)) & (k >= skipped), F.lit(False)
        ).cast("int"),
    )
    compared = F.least(F.lit(WINDOW), F.size("equal"))
    best = F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.size("equal") - compared + 1),
            lambda k: F.aggregate(F.slice("equal", k, compared), F.lit(0), lambda a, e: a + e),
        )
    )
    share = F.when(F.col("compared") < WHOLE_BELOW, 1.0).otherwise(LEAST_EQUAL)
    found = (
        aligned.select("doc_id", "text_key", "item_id", equal.alias("equal"))
        .select("doc_id", "text_key", "item_id", best.alias("equal"), compared.alias("compared"))
        .filter(F.col("equal") >= share * F.col("compared"))
    )
    order = F.struct((F.col("equal") / F.col("compared")).alias("share"), "equal", "compared")
    found = found.groupBy("doc_id", "text_key", "item_id").agg(F.max(order).alias("best"))
    return found.select("doc_id", "text_key", "item_id", F.col("best.equal").alias("equal"), F.col("best.compared").alias("compared"))


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text overlaps an item; all columns stay as they are."""
    found = contaminated(docs, items).select(F.col("doc_id").alias("_hit_id"), F.col("text_key").alias("_hit_key")).distinct()
    return docs.join(
        found,
        docs["doc_id"].cast("long").eqNullSafe(found["_hit_id"]) & (text_key(docs["text"]) == found["_hit_key"]),
        "left_anti",
    )
