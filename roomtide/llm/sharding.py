"""Sharding by Karmarkar-Karp differencing: indivisible groups of equal texts, shards of near-equal bytes.

A partial partition is a vector of shard sums. Differencing takes the two partial partitions of the largest
spread and adds them in opposite order, the largest sum to the smallest, until one is left. It is done in parts, so that
no task holds all groups: first over the large groups, those of more than a shard's share of a bucket, of which there are
at most as many as shards times buckets; then over the groups of each bucket, by the hash of their text; last over the
buckets' partial partitions. What the large groups leave uneven only many small ones can fill: their partial partition is
dealt to as many buckets as hold twice what is missing, and is differenced there along with the groups. A bucket has some
10,000 groups, so the number of buckets goes with the data and not with a setting.

Law ``bytes``: a text counts its UTF-8 bytes plus 1. Defined cases: null and empty texts are one group of
size 1 a row; repeated rows each count and take a slot each; equal doc_ids with different texts are placed by
their texts; an empty table gives an empty result; only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomtide.llm.support import ship, stored

GROUPS_PER_BUCKET = 10_000
ROWS_PER_LOT = 20_000


def difference(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp over rows of shard sums.

    Returns for each row the shard that each of its places ends in (rows x shards), and the final sums.
    """
    count, shards = vectors.shape
    place = np.tile(np.arange(shards, dtype=np.int16), (count, 1))
    if count == 0:
        return place, np.zeros(shards, np.int64)
    # A node's sums are kept in ascending order; order[node] says which of the parts' places stand there.
    first = np.argsort(vectors, axis=1, kind="stable")
    sums = [row[o] for row, o in zip(vectors, first)]
    queue = [(int(row[0] - row[-1]), node) for node, row in enumerate(sums)]
    heapify(queue)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(queue) > 1:
        _, a = heappop(queue)
        _, b = heappop(queue)
        joined = sums[a] + sums[b][::-1]
        order = np.argsort(joined, kind="stable")
        sums.append(joined[order])
        sums[a] = sums[b] = None
        merges.append((a, b, order))
        top = sums[-1]
        heappush(queue, (int(top[0] - top[-1]), count + len(merges) - 1))
    # From the top down: where does each node's ascending place end?
    ends: list[np.ndarray | None] = [None] * (count + len(merges))
    ends[-1] = np.arange(shards, dtype=np.int16)
    for step in range(len(merges) - 1, -1, -1):
        a, b, order = merges[step]
        joined = np.empty(shards, np.int16)
        joined[order] = ends[count + step]
        ends[a], ends[b], ends[count + step] = joined, joined[::-1], None if step < len(merges) - 1 else ends[-1]
    for row in range(count):
        place[row, first[row]] = ends[row]
    return place, sums[-1]


def _bucket_shards(shards: int, uneven: dict[int, list[int]]):
    """Groups (bucket, group, bytes) sorted by bucket -> (bucket, group, part, bytes).

    ``uneven`` gives buckets a partial partition to fill up; their parts are numbered as its places.
    """

    def solve(rows: pa.Table) -> pa.RecordBatch:
        sizes = rows["bytes"].to_numpy()
        given = uneven.get(rows["bucket"][0].as_py())
        vectors = np.zeros((len(sizes) + (given is not None), shards), np.int64)
        vectors[: len(sizes), -1] = sizes
        if given is not None:
            vectors[-1] = given
        place, _ = difference(vectors)
        part = place[: len(sizes), -1]
        if given is not None:
            part = np.argsort(place[-1])[part]
        return pa.RecordBatch.from_arrays(
            [rows["bucket"].combine_chunks(), rows["group"].combine_chunks(),
             pa.array(part.astype(np.int32)), rows["bytes"].combine_chunks()],
            ["bucket", "group", "part", "bytes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            buckets = held["bucket"].to_numpy()
            bounds = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                yield solve(held.slice(a, b - a))
            held = held.slice(bounds[-1])
        if held is not None and held.num_rows:
            yield solve(held)

    return run


def _large_shards(shards: int):
    """Groups (group, bytes) -> (bucket -1, group, part, bytes), differenced in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((b, g) for batch in batches for g, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        vectors = np.zeros((len(rows), shards), np.int64)
        vectors[:, -1] = [b for b, _ in rows]
        place, _ = difference(vectors)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1] * len(rows), pa.int64()), pa.array([g for _, g in rows], pa.binary()),
             pa.array(place[:, -1].astype(np.int32)), pa.array([b for b, _ in rows], pa.int64())],
            ["bucket", "group", "part", "bytes"],
        )

    return run


def _combine(shards: int):
    """Partial partitions (key, sums) -> (key, part, shard)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b, s) for batch in batches for b, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        rows.sort()
        place, _ = difference(np.array([s for _, s in rows], np.int64).reshape(len(rows), shards))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([b for b, _ in rows], np.int64), shards)),
             pa.array(np.tile(np.arange(shards, dtype=np.int32), len(rows))),
             pa.array(place.reshape(-1).astype(np.int32))],
            ["key", "part", "shard"],
        )

    return run


GROUPS = "bucket long, group binary, part int, bytes long"


def _differenced(sizes: DataFrame, total: int, shards: int, buckets: int) -> tuple[DataFrame, int]:
    """Each group's bucket (-1 for large ones) and part, and how many buckets have filled up the large groups' parts."""
    share = total // (shards * buckets)
    large = sizes.where(F.col("bytes") > share).select("group", "bytes").coalesce(1).mapInArrow(_large_shards(shards), GROUPS)
    large = stored(large, "large_groups")
    sums = np.zeros(shards, np.int64)
    for row in large.groupBy("part").agg(F.sum("bytes").alias("bytes")).collect():  # a row for each shard
        sums[row.part] = row.bytes
    missing, left = int((sums.max() - sums).sum()), total - int(sums.sum())
    fillers = min(buckets, -(-2 * missing * buckets // left)) if left else 0
    dealt = {b: (sums // fillers + (sums % fillers if b == 0 else 0)).tolist() for b in range(fillers)}
    small = (
        sizes.where(F.col("bytes") <= share)
        .withColumn("bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)))
        .select("bucket", "group", "bytes")
        .repartition("bucket")
        .sortWithinPartitions("bucket", F.desc("bytes"), "group")
        .mapInArrow(_bucket_shards(shards, dealt), GROUPS)
    )
    return stored(small.unionByName(large), "groups"), fillers


def shard_rows(docs: DataFrame, shards: int = 16, buckets: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row.

    ``buckets`` sets how many parts difference their groups apart; by default one for each 10,000 groups.
    """
    spark = docs.sparkSession
    ship(spark)
    whole = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(whole) + 1).cast("long").alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(whole, 256)).alias("group"),
        ),
        "rows",
    )
    sizes = stored(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "group_sizes")
    found = sizes.agg(F.count(F.lit(1)).alias("groups"), F.sum("bytes").alias("bytes"), F.sum("n").alias("rows")).first()
    groups, fillers = _differenced(sizes, found.bytes or 0, shards, buckets or max(1, -(-found.groups // GROUPS_PER_BUCKET)))
    key = F.when(F.col("bucket") < fillers, F.lit(-1)).otherwise(F.col("bucket")).cast("long")
    groups = groups.withColumn("key", key)
    vectors = (
        groups.groupBy("key", "part").agg(F.sum("bytes").alias("bytes"))
        .groupBy("key")
        .agg(F.map_from_entries(F.collect_list(F.struct("part", "bytes"))).alias("m"))
        .select("key", F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda p: F.coalesce(F.try_element_at("m", p), F.lit(0).cast("long"))).alias("sums"))
    )
    final = stored(vectors.coalesce(1).mapInArrow(_combine(shards), "key long, part int, shard int"), "final")
    placed = groups.join(final, ["key", "part"]).select("group", "shard")
    # Slots: rows are counted by an even key, not by the text, so that a hot text is no hot task.
    lots = max(1, (found.rows or 0) // ROWS_PER_LOT)
    lot = F.pmod(F.xxhash64("doc_id", "group"), F.lit(lots))
    dealt = stored(rows.join(placed, "group").withColumn("lot", lot), "dealt")
    counts = dealt.groupBy("shard", "lot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "lot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "lot").orderBy("doc_id", "group")
    return (
        dealt.withColumn("within", F.row_number().over(within))
        .join(offsets, ["shard", "lot"])
        .select(
            "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("within") - 1).cast("long").alias("slot"),
        )
    )
