"""Set-similarity join by parity sketches, and the near-duplicate classes it gives.

1. Each text becomes its set of word shingles. Equal sets become one node.
2. Each node gives the signatures of its size bands (``parity``): linked nodes share one. They meet by
   signature in a shuffle; signatures of a single node go.
3. Where nodes meet, sketches rule out the pairs that differ in too many bits. Each node offers its nearest
   partners outside its own class; the offered pairs are verified on their whole sets. What was offered in
   part only is offered again, four times as wide, under the classes found so far. So a family of near copies
   needs few pairs, and every pair that could still join two classes is verified.

Links are exact: 100 * |A n B| >= percent * |A u B| on sets of 64-bit shingle hashes.

Defined cases: null and empty texts and texts without words have empty sets and link with nothing; a text of
fewer words than a shingle is one shingle; repeated rows and equal texts are one class; a null doc_id is
in the class of its text and is never the class id unless all ids are null; an empty table gives an empty
result; only doc_id and the text column are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomtide.llm import parity
from roomtide.llm.components import components
from roomtide.llm.support import column_rows, ship, stored

NO_NODE = 0
FIRST_OFFERS = 2
BLOCK = 4096
BROADCAST_ROWS = 2_000_000  # 8-byte ids: some tens of MB as a hash table; beyond it a shuffled join


def _node(tokens: np.ndarray) -> int:
    """64 bits for a whole set; 0 for the empty one."""
    return int.from_bytes(parity.digest(tokens)[:8], "little", signed=True) or 1 if len(tokens) else NO_NODE


def sketch_table(docs: DataFrame, width: int, percent: int, text: str = "text") -> DataFrame:
    """doc_id, text_key, n_shingles, node, signatures, sketch of each document."""
    known = parity.bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, texts in column_rows(batches, "doc_id", "text_key", "text"):
            sets = [parity.shingle_set(t, width) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) for s in sets], pa.int64()),
                    pa.array([known.signatures(s).view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([parity.dense_sketch(s).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                ],
                ["doc_id", "text_key", "n_shingles", "node", "signatures", "sketch"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col(text)).alias("text_key"), F.col(text).cast("string").alias("text")
    ).mapInArrow(run, "doc_id long, text_key long, n_shingles long, node long, signatures array<long>, sketch binary")


def _sets(docs: DataFrame, width: int, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (texts,) in column_rows(batches, "text"):
            sets = [parity.shingle_set(t, width) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_node(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["node", "tokens"],
            )

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "node long, tokens array<long>")


def _offers(meetings: DataFrame, percent: int, limit: int) -> DataFrame:
    """(a, b, run, more) from rows (run, node, label, n_shingles, sketch); a run's rows pass in one stream."""

    def close(run, nodes, labels, sizes, sketches, out):
        if len(nodes) < 2 or (labels == labels[0]).all():
            return
        sketches = [np.frombuffer(s, "<u8") for s in sketches]
        for place, partners, more in parity.close_partners(sizes, labels, sketches, percent, limit):
            for partner in partners:
                out.append((min(nodes[place], nodes[partner]), max(nodes[place], nodes[partner]), run, more))

    def emit(out):
        columns = list(zip(*out)) if out else [[], [], [], []]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types)], ["a", "b", "run", "more"]
        )

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            runs = rows["run"].to_numpy()
            starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]]) if len(runs) else np.array([0])
            held = rows.slice(starts[-1])
            if len(starts) > 1:
                _split(rows, runs, starts, close, out)
            if len(out) > 50_000:
                yield emit(out)
                out = []
        if held is not None and held.num_rows:
            _split(held, held["run"].to_numpy(), np.array([0, held.num_rows]), close, out)
        yield emit(out)

    def _split(rows, runs, bounds, close, out):
        nodes, labels, sizes = (rows[c].to_numpy() for c in ("node", "label", "n_shingles"))
        sketches = rows["sketch"].slice(0, bounds[-1]).to_pylist()
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            close(int(runs[a]), nodes[a:b].tolist(), labels[a:b], sizes[a:b], sketches[a:b], out)

    return (
        meetings.select("run", "node", "label", "n_shingles", "sketch")
        .repartition("run")
        .sortWithinPartitions("run", "node")
        .mapInArrow(run_all, "a long, b long, run long, more boolean")
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    common = F.size(F.array_intersect("ta", "tb"))
    return (
        pairs.join(left, "a").join(right, "b")
        .withColumn("common", common)
        .filter(100 * F.col("common") >= percent * (F.size("ta") + F.size("tb") - F.col("common")))
        .select("a", "b")
    )


def _meetings(nodes: DataFrame) -> DataFrame:
    """Rows (run, node) of signatures that two nodes have at least. A large run is dealt in blocks: each pair
    of blocks is a run of its own, so that no task holds more than two blocks."""
    by_key = Window.partitionBy("key")
    met = (
        nodes.select("node", F.explode("signatures").alias("key"))
        .withColumn("met", F.count("*").over(by_key))
        .filter("met > 1")
    )
    blocks = F.ceil(F.col("met") / BLOCK)
    return (
        met.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("run"), "node")
    )


def text_key(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _classes(docs: DataFrame, width: int, percent: int, text: str) -> tuple[DataFrame, DataFrame]:
    """The documents' sketches, and (node, component, first_id) of every node: nodes of a class have one component."""
    ship(docs.sparkSession)
    sketches = stored(sketch_table(docs, width, percent, text), "sketches")
    worded = sketches.filter(F.col("node") != NO_NODE)
    nodes = worded.groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("signatures").alias("signatures")
    )
    meetings = stored(_meetings(nodes.select("node", "signatures")), "meetings")
    candidates = meetings.select("node").distinct()
    members = worded.join(candidates, "node", "left_semi")
    one_sketch = stored(
        members.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
        ),
        "candidates",
    )
    holders = one_sketch.select(F.col("doc_id").alias("holder"))
    if one_sketch.count() <= BROADCAST_ROWS:
        holders = F.broadcast(holders)
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).join(
        holders, F.col("doc_id").eqNullSafe(F.col("holder")), "left_semi"
    )
    sets = stored(
        _sets(held, width, text).join(one_sketch.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets"
    )

    runs, limit, tested, links, labels = meetings, FIRST_OFFERS, None, None, None
    while True:
        rows = runs.join(one_sketch.select("node", "n_shingles", "sketch"), "node")
        if labels is None:
            rows = rows.withColumn("label", F.col("node"))
        else:
            rows = rows.join(labels.withColumnRenamed("component", "label"), "node", "left").withColumn(
                "label", F.coalesce("label", "node")
            )
        offers = stored(_offers(rows, percent, limit), "offers")
        pairs = offers.select("a", "b").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        found = stored(_verified(pairs, sets, percent), "links")
        links = found if links is None else links.union(found)
        labels = stored(components(links), "labels")
        partly = offers.filter("more").select("run").distinct()
        if partly.isEmpty():
            break
        runs = stored(runs.join(partly, "run", "left_semi"), "meetings")
        tested = offers.select("a", "b") if tested is None else tested.union(offers.select("a", "b"))
        limit *= 4

    grouped = worded.groupBy("node").agg(F.min("doc_id").alias("first_id")).join(labels, "node", "left")
    return sketches, grouped.withColumn("component", F.coalesce("component", "node"))


def near_duplicate_classes(docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the least doc_id that links lead to."""
    sketches, nodes = _classes(docs, width, percent, text)
    least = nodes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = nodes.join(least, "component").select("node", "component_id")
    return sketches.select("doc_id", "n_shingles", "node").join(classes, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each_class(docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate class, the one of the least doc_id; of equal ones, any.

    Rows without words are in no class and all stay.
    """
    sketches, nodes = _classes(docs, width, percent, text)
    order = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "text_key")
    rows = sketches.filter(F.col("node") != NO_NODE).join(nodes.select("node", "component"), "node")
    rows = stored(rows.groupBy("component", "doc_id", "text_key").agg(F.count("*").alias("n")), "class-rows")
    kept = rows.groupBy("component").agg(F.min(order).alias("kept"))
    judged = rows.join(kept, "component").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "n", (order == F.col("kept")).alias("stays")
    )
    gone = judged.filter(~F.col("stays")).select("_id", "_key")
    repeated = judged.filter(F.col("stays") & (F.col("n") > 1)).select("_id", "_key")
    gone, repeated = (F.broadcast(p) if p.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else p for p in (gone, repeated))

    def same(other: DataFrame):
        """Both sides by name of their table: the documents may have any columns of their own."""
        return docs["doc_id"].cast("long").eqNullSafe(other["_id"]) & (text_key(docs[text]) == other["_key"])

    left = docs.join(gone, same(gone), "left_anti")
    alone = left.join(repeated, same(repeated), "left_anti")
    return alone.unionByName(left.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", text]))
