"""The trie of conversations that begin alike: every distinct sequence of first turns is a node.

A turn is known by a digest of its role and text. A conversation is laid on rows of eight positional columns of turn
ids; ``GROUP BY ... ROLLUP`` over these columns aggregates all prefixes of a row together, and ``grouping_id`` tells how
many turns a group has. A conversation longer than eight turns goes on in further rows, each keyed by the digest of
all turns before it, which is the node that the row before ends in.

The nodes with the same smallest member follow each other on that conversation's way, so they form a chain, and a
node's name is (conv_id, depth). What a subtree holds is summed along chains; sums of whole chains go to the chains
they hang on by pointer doubling, so the number of joins grows with the logarithm of how deep chains hang on chains.

Defined cases: rows with a null conv_id belong to no conversation and make no node; null roles and texts are empty;
turns are ordered null first, equal turns by role, then text, and repeated rows are turns of their own; a conversation
without turns is a member of the root; no conversations give no nodes; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.llm.support import column_rows, ship, stored
from roomtide.llm.turns import CRC32, numbered, running

WORDS = r"[^\x20\x09-\x0D]+"
WIDTH = 8  # positional columns of a row
FAMILY, MOST_SHARED = 20, 3
IDS_PER_CHUNK = 4096
SUMS = ["s1", "s2", "s3", "s4"]
COLUMNS = [f"t{i}" for i in range(1, WIDTH + 1)]


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes that tell (role, text) apart, and the text's number of words in four more."""
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    return F.concat(digest, F.unhex(F.lpad(F.hex(F.regexp_count(text, F.lit(WORDS)).cast("long")), 8, "0")))


def _words(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, 17, 4)), 16, 10).cast("long")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, id) of every turn of every conversation."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    turns = turns.withColumn("id", turn_id(F.col("role"), F.col("text")))
    return numbered(turns, ["role", "text"], "ordered_turns", drop=["turn", "role", "text"])


def with_shared_openings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, position, id, length) and lengths (conv_id, length) of the rebuilt conversations.

    Conversation c takes the first crc32(c) % 4 turns of conversation c - c % 20, then its own after as many.
    """
    heads = (
        turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("position") <= MOST_SHARED))
        .groupBy(F.col("conv_id").alias("donor"))
        .agg(F.sort_array(F.collect_list(F.struct("position", "id"))).getField("id").alias("head"))
    )
    own = turns.groupBy("conv_id").agg(F.max("position").alias("own"))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    plan = own.withColumns({"donor": F.col("conv_id") - F.col("conv_id") % FAMILY, "shared": shared}).join(heads, "donor", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("shared")), F.array().cast("array<binary>"))
    plan = plan.withColumn("head", head).withColumn(
        "length", F.size("head") + F.greatest(F.col("own") - F.col("shared"), F.lit(0))
    )
    plan = stored(plan.select("conv_id", "shared", "head", "length"), "rebuilding")
    given = plan.select("conv_id", F.posexplode("head").alias("at", "id"), "length")
    kept = turns.join(plan.select("conv_id", "shared", F.size("head").alias("given"), "length"), "conv_id")
    kept = kept.where(F.col("position") > F.col("shared"))
    rebuilt = given.select("conv_id", (F.col("at") + 1).cast("long").alias("position"), "id", "length").unionByName(
        kept.select("conv_id", (F.col("position") - F.col("shared") + F.col("given")).alias("position"), "id", "length")
    )
    return rebuilt, plan.select("conv_id", "length")


def _parts(digest: Column) -> list[Column]:
    """A hexadecimal MD5 as four numbers of 32 bits, which may be summed."""
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _block_digest(block: Column, ids: Column) -> Column:
    return F.md5(F.concat(block.cast("string"), F.lit(":"), F.array_join(F.transform(ids, F.hex), "")).cast("binary"))


def _key(block: Column, sums: list[Column], ids: Column) -> Column:
    """Names the sequence of all turns before a block and the ``ids`` in it. A full block has the next one's empty key."""
    full = F.size(ids) == WIDTH
    at = F.when(full, block + 1).otherwise(block)
    own = _parts(_block_digest(block, ids))
    total = [F.when(full, s + part).otherwise(s) for s, part in zip(sums, own)]
    rest = F.when(full, F.lit("")).otherwise(F.array_join(F.transform(ids, F.hex), ""))
    return F.md5(F.concat_ws(":", at, *total, rest).cast("binary"))


def column_blocks(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row of at most eight turn ids for each (conv_id, block), with the sums that name all turns before it.

    A conversation without turns has one empty block.
    """
    block = F.floor((F.col("position") - 1) / WIDTH)
    rows = (
        turns.groupBy("conv_id", block.alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("position", "id"))).getField("id").alias("ids"), F.max("length").alias("length"))
        .select("conv_id", "block", "ids", "length")
    )
    empty = lengths.where(F.col("length") == 0).select(
        "conv_id", F.lit(0).cast("long").alias("block"), F.array().cast("array<binary>").alias("ids"), F.col("length").cast("long")
    )
    rows = rows.unionByName(empty)
    digests = rows.withColumn("_digest", _block_digest(F.col("block"), F.col("ids")))
    digests = digests.withColumns(dict(zip(SUMS, _parts(F.col("_digest"))))).drop("_digest")
    summed = running(digests, "conv_id", "block", SUMS)
    return summed.select("conv_id", "block", "ids", "length", *[F.col(f"before_{s}").alias(s) for s in SUMS])


def _prefixes(blocks: DataFrame) -> DataFrame:
    """Every distinct prefix: its smallest member, depth, members, last turn's words, own key and the key before.

    ``continues``: the smallest member has more turns.
    """
    laid = blocks.select("conv_id", "block", "length", *SUMS, *[F.get("ids", F.lit(i)).alias(c) for i, c in enumerate(COLUMNS)])
    here = " ".join(
        f"WHEN {WIDTH - d} THEN {f'{COLUMNS[d - 1]} IS NOT NULL' if d else 'block = 0'}" for d in range(WIDTH + 1)
    )
    grouped = blocks.sparkSession.sql(
        f"""SELECT block, {', '.join(SUMS + COLUMNS)}, CAST({WIDTH} - bit_count(grouping_id()) AS INT) AS taken,
                   count(*) AS n_convs, min(conv_id) AS conv_id, min_by(length, conv_id) AS length
            FROM {{laid}}
            GROUP BY block, {', '.join(SUMS)}, ROLLUP({', '.join(COLUMNS)})
            HAVING CASE bit_count(grouping_id()) {here} END""",
        laid=laid,
    )
    sums = [F.col(s) for s in SUMS]
    ids = F.slice(F.array(*COLUMNS), F.lit(1), F.col("taken"))
    shorter = F.slice(F.array(*COLUMNS), F.lit(1), F.greatest(F.col("taken") - 1, F.lit(0)))
    depth = F.col("block") * WIDTH + F.col("taken")
    return grouped.withColumns({"_ids": ids, "_shorter": shorter, "depth": depth}).select(
        "conv_id", "depth", "n_convs",
        (F.col("length") > F.col("depth")).alias("continues"),
        F.when(F.col("taken") > 0, _words(F.get("_ids", F.col("taken") - 1))).otherwise(0).alias("words"),
        _key(F.col("block"), sums, F.col("_ids")).alias("key"),
        F.when(F.col("depth") > 0, _key(F.col("block"), sums, F.col("_shorter"))).alias("parent_key"),
    )


def _chain_totals(chains: DataFrame, root: int | None) -> DataFrame:
    """Sums of ``leaves`` and ``saved`` over each chain (conv_id) and all chains that hang on it, by pointer doubling.

    ``up`` is the chain that a chain hangs on; only that of ``root`` is null. What has come to the root has nothing
    above it and needs no look, which keeps the most frequent pointer out of the join.
    """
    state = stored(chains.select("conv_id", "up", "leaves", "saved"), "chains")
    while state.where(F.col("up").isNotNull()).limit(1).count():
        climbing = state.where(F.col("up").isNotNull())
        given = climbing.groupBy(F.col("up").alias("conv_id")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        above = climbing.select(F.col("conv_id").alias("up"), F.col("up").alias("next"))
        sums = state.join(given, "conv_id", "left").select(
            "conv_id", "up", *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")]
        )
        arrived = F.col("up").isNull() | (F.col("up") == F.lit(root))
        done = sums.where(arrived).select("conv_id", F.lit(None).cast("long").alias("up"), "leaves", "saved")
        going = sums.where(~arrived).join(above, "up", "left").select("conv_id", F.col("next").alias("up"), "leaves", "saved")
        state = stored(done.unionByName(going), "chains")
    return state.select("conv_id", "leaves", "saved")


def ends(blocks: DataFrame) -> DataFrame:
    """(key, ends_sha256): the digest of the comma-joined ids, ascending, of the conversations that end in a node.

    Ids are gathered in chunks of at most 4,096, and a node's chunks pass through one hash in order, never held together.
    """
    last = blocks.where(F.col("block") == F.floor(F.greatest(F.col("length") - 1, F.lit(0)) / WIDTH))
    keyed = last.select("conv_id", _key(F.col("block"), [F.col(s) for s in SUMS], F.col("ids")).alias("key"))
    chunks = keyed.groupBy("key", F.floor(F.col("conv_id") / IDS_PER_CHUNK).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("members")
    )
    ship(blocks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for keys, members in column_rows(batches, "key", "members"):
            done = []
            for key, part in zip(keys, members):
                if key == current:
                    digest.update(b"," + part.encode())
                else:
                    if current is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = key, hashlib.sha256(part.encode())
            yield _pairs(done)
        yield _pairs([] if current is None else [(current, digest.hexdigest())])

    return chunks.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(run, "key string, ends_sha256 string")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["key", "ends_sha256"]
    )


def prefix_nodes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every node of the trie of ``turns`` (conv_id, position, id, length); ``lengths`` names all conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    blocks = stored(column_blocks(turns, lengths), "blocks")
    nodes = stored(_prefixes(blocks), "nodes")
    tops = nodes.groupBy("conv_id").agg(F.min_by("parent_key", "depth").alias("parent_key"), F.min("depth").alias("depth"))
    first = nodes.where(F.col("depth") == 0).select("conv_id").first()  # the root is one row, or none
    root = first.conv_id if first else None
    # A node that millions of chains hang on has its key once on its own side; adaptive skew handling splits the other.
    at = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"), F.col("depth").alias("parent_depth"))
    shallow = tops.where(F.col("depth") == 1).select(
        "conv_id", "depth", F.lit(root).cast("long").alias("parent"), F.lit(0).cast("long").alias("parent_depth")
    )
    deep = tops.where(F.col("depth") > 1).join(at, "parent_key").select("conv_id", "depth", "parent", "parent_depth")
    hung = stored(shallow.unionByName(deep), "hung_chains")

    held = hung.groupBy(F.col("parent").alias("conv_id"), F.col("parent_depth").alias("depth")).agg(F.count(F.lit(1)).alias("hung"))
    counted = nodes.join(held, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "n_convs", "key",
        (F.coalesce("hung", F.lit(0)) + F.col("continues").cast("long")).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    counted = stored(counted.withColumn("leaves", (F.col("n_children") == 0).cast("long")), "counted_nodes")
    chains = counted.groupBy("conv_id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    up = hung.select("conv_id", F.col("parent").alias("up"))
    totals = _chain_totals(chains.join(up, "conv_id", "left"), root)

    below = hung.join(totals, "conv_id").groupBy(F.col("parent").alias("conv_id"), F.col("parent_depth").alias("depth")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
    )
    weighed = counted.join(below, ["conv_id", "depth"], "left").withColumns(
        {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")}
    )
    summed = running(weighed, "conv_id", "depth", ["leaves", "saved"], after=True)
    named = summed.join(hung.select("conv_id", "depth", "parent"), ["conv_id", "depth"], "left").join(ends(blocks), "key", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return named.select(
        "conv_id", F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", F.col("after_leaves").alias("n_leaves"), F.col("after_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    turns = ordered_turns(conversations)
    lengths = turns.groupBy("conv_id").agg(F.max("position").alias("length"))
    return prefix_nodes(turns.join(lengths, "conv_id"), lengths)


def shared_opening_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations that share openings within families of twenty ids."""
    return prefix_nodes(*with_shared_openings(ordered_turns(conversations)))


ORACLE_SQL = f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
           {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
    FROM conversations WHERE conv_id IS NOT NULL),
original AS (SELECT conv_id, list(said ORDER BY pos) AS said FROM turns GROUP BY conv_id),
rebuilt AS (
    SELECT o.conv_id, list_concat(coalesce(d.said, [])[:h], o.said[h + 1:]) AS said
    FROM (SELECT *, ({CRC32.format(text="conv_id::VARCHAR")} % 4)::INT AS h FROM original) o
    LEFT JOIN original d ON d.conv_id = o.conv_id - o.conv_id % 20),
prefixes AS (
    SELECT conv_id, said[:depth] AS way, depth, depth = len(said) AS at_end
    FROM (SELECT conv_id, said, unnest(range(len(said) + 1)) AS depth FROM rebuilt)),
nodes AS (
    SELECT way, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE at_end), '')) AS ends_sha256,
           CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(way[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS words
    FROM prefixes GROUP BY way, depth),
linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.way = n.way[:n.depth - 1]),
children AS (
    SELECT n.conv_id, n.depth, count(c.conv_id) AS n_children
    FROM linked n LEFT JOIN linked c ON c.parent_conv_id = n.conv_id AND c.depth = n.depth + 1 GROUP BY n.conv_id, n.depth),
under AS (
    SELECT t.conv_id, t.depth, sum((n.n_convs - 1) * n.words) AS saved_tokens, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves
    FROM nodes t JOIN (SELECT *, unnest(range(depth + 1)) AS above FROM nodes) n ON n.above = t.depth AND n.way[:n.above] = t.way
    JOIN children k ON k.conv_id = n.conv_id AND k.depth = n.depth GROUP BY t.conv_id, t.depth)
SELECT l.conv_id::BIGINT AS conv_id, l.depth::BIGINT AS depth, l.parent_conv_id::BIGINT AS parent_conv_id,
       l.n_convs::BIGINT AS n_convs, k.n_children::BIGINT AS n_children, u.n_leaves::BIGINT AS n_leaves,
       u.saved_tokens::BIGINT AS saved_tokens, l.ends_sha256
FROM linked l JOIN children k USING (conv_id, depth) JOIN under u USING (conv_id, depth)
"""
