"""Repair of conversations by the cheapest edits, found by Hirschberg's divide and conquer in linear space.

A repaired conversation's roles read ``(s?(ua)+)?``, which an automaton of four states accepts: begin, after a system
turn, after a user turn, after an assistant turn. Rows are kept (0), given another role (2) or deleted (3), empty turns
are inserted (2), and a truncated row that stays costs 1. A forward pass keeps, for each state, the least cost and the
rank of its least edit sequence among the four; a backward pass keeps the least cost to the end. Where the two meet in
the middle of the rows, the state of least sum and, among equals, of least rank is on the best way, and both halves are
solved alike. Ranks decide ties exactly: an edit sequence up to a row ends with that row's own edit, so no sequence to a
state is the beginning of another's.

Conversations of any length: rows are dealt in runs of at most 8,192 neighbours. A run is summed up by the costs and
ranks from each state to each state; the same method over these summaries finds the states between runs, and then runs
are solved apart. Texts pass through the digest as a stream, so a conversation is never held whole; its digest and its
audit are one value each, as the result asks.

Defined cases: a null conv_id is a conversation of its own, with null as its conv_id; null roles and texts are one
space; rows are ordered by turn (null first), equal turns by role, then text; repeated rows are rows of their own, and
of equal role and text the later ones are duplicates; roles count by their first character, and roles that begin
otherwise than with s, u or a can only be changed or deleted; a conversation without rows gives zeros and empty texts;
gaps that exceed a long are null; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.llm.support import column_rows, ship, stored
from roomtide.llm.turns import CRC32, in_order

BEGIN, SYSTEM, USER, ASSISTANT = STATES = range(4)
FAR = 1 << 60
RUN_ROWS = 8192
BLANK = r"[\x20\x09-\x0D]"
CLASSES = "suao"  # first characters of roles; o: any other
KEPT, CUT, GONE = range(3)  # whole, truncated, to be deleted
CODES = "abcdefghijkl"  # class * 3 + condition
LEGAL = {"su", "ua", "au"}
NAMES = {USER: "user", ASSISTANT: "assistant"}


def emit(state: int, role: str) -> int | None:
    """The state after a turn of a role (s, u, a), or None where it may not come."""
    if role == "s":
        return SYSTEM if state == BEGIN else None
    if role == "u":
        return USER if state != USER else None
    return ASSISTANT if state == USER and role == "a" else None


def next_role(state: int) -> str:
    """The only role that may be inserted, or given to a row, after a state."""
    return "a" if state == USER else "u"


def _row_edits(code: str) -> list[list[tuple[int, str]]]:
    """[from][to]: the least cost and least edits of inserts before a row and the row's own edit."""
    kind, condition = divmod(CODES.index(code), 3)
    best = [[(FAR, "")] * 4 for _ in STATES]
    for start in STATES:
        state, inserts = start, ""
        for _ in range(3):
            ways = [(state, 3, "D")]
            if condition != GONE:
                cut = int(condition == CUT)
                ways += [(emit(state, CLASSES[kind]), cut, "K"), (emit(state, next_role(state)), 2 + cut, "R")]
            for end, cost, edit in ways:
                if end is not None:
                    best[start][end] = min(best[start][end], (cost + 2 * len(inserts), inserts + edit))
            state, inserts = emit(state, next_role(state)), inserts + "I"
    return best


ROW_EDITS = {code: _row_edits(code) for code in CODES}
TAILS = {BEGIN: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}  # inserts after the last row

Vector = tuple[tuple[int, ...], tuple[int, ...]]


def start_at(state: int) -> Vector:
    return tuple(0 if s == state else FAR for s in STATES), (0,) * 4


def forward(vector: Vector, item) -> Vector:
    """Costs and ranks after an item; ``item[from][to]`` is (cost, order among equal costs from one state)."""
    costs, ranks = vector
    found = []
    for end in STATES:
        ways = [(costs[s] + item[s][end][0], ranks[s], item[s][end][1]) for s in STATES if costs[s] < FAR and item[s][end][0] < FAR]
        found.append(min(ways) if ways else (FAR, 4, ""))
    order = sorted({w[1:] for w in found if w[0] < FAR})
    return tuple(w[0] for w in found), tuple(order.index(w[1:]) if w[0] < FAR else 4 for w in found)


def backward(costs: tuple[int, ...], item) -> tuple[int, ...]:
    """Least costs to the end from before an item, given those from after it."""
    return tuple(min(FAR, min(item[s][end][0] + costs[end] for end in STATES)) for s in STATES)


class Remembered:
    """``forward`` and ``backward`` over row codes. Vectors differ in few ways once their least cost is taken off."""

    def __init__(self):
        self.ahead, self.back = {}, {}

    def forward(self, vector: Vector, codes: str) -> Vector:
        costs, ranks = vector
        base = 0
        for code in codes:
            key = (costs, ranks, code)
            found = self.ahead.get(key)
            if found is None:
                new, new_ranks = forward((costs, ranks), ROW_EDITS[code])
                least = min(new)
                found = self.ahead[key] = (least, tuple(c - least if c < FAR else FAR for c in new), new_ranks)
            base += found[0]
            costs, ranks = found[1], found[2]
        return tuple(c + base if c < FAR else FAR for c in costs), ranks

    def backward(self, costs: tuple[int, ...], codes: str) -> tuple[int, ...]:
        base = 0
        for code in reversed(codes):
            key = (costs, code)
            found = self.back.get(key)
            if found is None:
                new = backward(costs, ROW_EDITS[code])
                least = min(new)
                found = self.back[key] = (least, tuple(c - least if c < FAR else FAR for c in new))
            base += found[0]
            costs = found[1]
        return tuple(c + base if c < FAR else FAR for c in costs)


class Items:
    """The same over summaries of runs."""

    def forward(self, vector: Vector, items) -> Vector:
        for item in items:
            vector = forward(vector, item)
        return vector

    def backward(self, costs: tuple[int, ...], items) -> tuple[int, ...]:
        for item in reversed(items):
            costs = backward(costs, item)
        return costs


def crossings(passes, items, first: int, last: int) -> list[int]:
    """The state after each item but the last, on the least way from ``first`` to ``last``."""
    if len(items) < 2:
        return []
    half = len(items) // 2
    costs, ranks = passes.forward(start_at(first), items[:half])
    rest = passes.backward(start_at(last)[0], items[half:])
    at = min(STATES, key=lambda s: (costs[s] + rest[s], ranks[s]))
    return crossings(passes, items[:half], first, at) + [at] + crossings(passes, items[half:], at, last)


def last_state(vector: Vector) -> tuple[int, int]:
    """The state after the last row on the best whole way, and the way's cost with its last inserts."""
    costs, ranks = vector
    at = min(STATES, key=lambda s: (costs[s] + 2 * len(TAILS[s]), ranks[s]))
    return at, costs[at] + 2 * len(TAILS[at])


def solve(passes: Remembered, codes: str, first: int, last: int) -> list[str]:
    """The edits of each row of a run."""
    ways = [first, *crossings(passes, codes, first, last), last]
    return [ROW_EDITS[code][a][b][1] for code, a, b in zip(codes, ways, ways[1:])]


def _illegal(classes: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(classes, classes[1:]))


def _classes(codes: str) -> str:
    return "".join(CLASSES[CODES.index(c) // 3] for c in codes)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id as text, '' for null; turn, role, text): rows with the faults that their crc32 says."""
    rows = conversations.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    name = F.concat(F.coalesce("conv", F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(name.cast("binary")) % 20
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.withColumn("fault", fault).where(F.col("fault") != 0)
    return rows.select(
        F.coalesce("conv", F.lit("")).alias("conv_id"), "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("_"),
    ).drop("_")


def _judged(rows: DataFrame) -> DataFrame:
    """(conv_id, at, turn, kind, blank, duplicate, truncated, code) of each row."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(rf"[.!?]{BLANK}*\z")
    kind = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in CLASSES[:3]]), F.substring("role", 1, 1)), F.lit(0))
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    found = rows.select(
        "conv_id", "at", "turn", F.when(kind == 0, 3).otherwise(kind - 1).cast("int").alias("kind"),
        blank.alias("blank"), whole.alias("whole"), said.alias("said"),
    )
    again = found.where(~F.col("blank")).groupBy("conv_id", "said").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("times"))
    met = found.join(again.where(F.col("times") > 1).drop("times"), ["conv_id", "said"], "left")
    duplicate = ~F.col("blank") & F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    truncated = ~F.col("blank") & ~F.col("duplicate") & ~F.col("whole")
    condition = F.when(F.col("blank") | F.col("duplicate"), GONE).when(F.col("truncated"), CUT).otherwise(KEPT)
    return met.withColumn("duplicate", duplicate).withColumn("truncated", truncated).select(
        "conv_id", "at", "turn", "blank", "duplicate", "truncated",
        F.substring(F.lit(CODES), F.col("kind") * 3 + condition + 1, F.lit(1)).alias("code"),
    )


SUMMARY = "conv_id string, run long, costs array<long>, ranks array<int>, inner int, ends string"
FOUND = "conv_id string, cost long, illegal long, tail string, runs array<long>, bounds array<int>"


def _summaries(runs: DataFrame) -> DataFrame:
    """Costs and ranks of each run from each state to each state, its illegal neighbours and its end classes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = Remembered()
        for convs, numbers, texts in column_rows(batches, "conv_id", "run", "codes"):
            vectors = [[passes.forward(start_at(s), codes) for s in STATES] for codes in texts]
            classes = [_classes(codes) for codes in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(convs, pa.string()), pa.array(numbers, pa.int64()),
                    pa.array([[c for v in four for c in v[0]] for four in vectors], pa.list_(pa.int64())),
                    pa.array([[r for v in four for r in v[1]] for four in vectors], pa.list_(pa.int32())),
                    pa.array([_illegal(c) for c in classes], pa.int32()),
                    pa.array([c[0] + c[-1] for c in classes], pa.string()),
                ],
                ["conv_id", "run", "costs", "ranks", "inner", "ends"],
            )

    return runs.select("conv_id", "run", "codes").mapInArrow(work, SUMMARY)


def _bounds(summaries: DataFrame) -> DataFrame:
    """The states between a conversation's runs. It holds a row of 32 numbers for each 8,192 rows of a conversation."""
    fields = ["run", "costs", "ranks", "inner", "ends"]
    gathered = summaries.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("parts"))
    gathered = gathered.select("conv_id", *[F.col(f"parts.{f}").alias(f) for f in fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = Items()
        for convs, numbers, costs, ranks, inner, ends in column_rows(batches, "conv_id", *fields):
            rows = []
            for conv, runs, c, r, within, edges in zip(convs, numbers, costs, ranks, inner, ends):
                items = [
                    [[(one[4 * s + e], order[4 * s + e]) for e in STATES] for s in STATES] for one, order in zip(c, r)
                ]
                last, cost = last_state(passes.forward(start_at(BEGIN), items))
                between = [BEGIN, *crossings(passes, items, BEGIN, last), last]
                illegal = sum(within) + sum(a[1] + b[0] not in LEGAL for a, b in zip(edges, edges[1:]))
                rows.append((conv, cost, illegal, TAILS[last], runs, between))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)],
                ["conv_id", "cost", "illegal", "tail", "runs", "bounds"],
            )

    return gathered.mapInArrow(work, FOUND)


def _edits(runs: DataFrame, bounds: DataFrame) -> DataFrame:
    """(conv_id, run, first, edits): for each run the edits of its rows."""
    each = bounds.select("conv_id", F.posexplode("runs").alias("i", "run"), "bounds").select(
        "conv_id", "run", F.get("bounds", F.col("i")).alias("enter"), F.get("bounds", F.col("i") + 1).alias("leave")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = Remembered()
        for convs, numbers, firsts, texts, enter, leave in column_rows(batches, "conv_id", "run", "first", "codes", "enter", "leave"):
            solved = [solve(passes, *way) for way in zip(texts, enter, leave)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(convs, pa.string()), pa.array(numbers, pa.int64()), pa.array(firsts, pa.int64()),
                    pa.array(solved, pa.list_(pa.string())),
                ],
                ["conv_id", "run", "first", "edits"],
            )

    met = runs.join(each, ["conv_id", "run"]).select("conv_id", "run", "first", "codes", "enter", "leave")
    return met.mapInArrow(work, "conv_id string, run long, first long, edits array<string>")


class Repaired:
    """Lines of one repaired conversation, from rows and their edits in order."""

    def __init__(self):
        self.state = BEGIN

    def inserted(self, edits: str) -> Iterator[str]:
        for edit in edits:
            if edit == "I":
                self.state = emit(self.state, next_role(self.state))
                yield f"{NAMES[self.state]}:"

    def lines(self, edits: str, role: str, text: str) -> Iterator[str]:
        yield from self.inserted(edits)
        if edits[-1] == "K":
            self.state = emit(self.state, role[:1])
            yield f"{role}:{text}"
        elif edits[-1] == "R":
            self.state = emit(self.state, next_role(self.state))
            yield f"{NAMES[self.state]}:{text}"


def repaired_lines(rows: DataFrame, edits: DataFrame, tails: DataFrame, digest: bool) -> DataFrame:
    """Conversations as repaired: (conv_id, line number, line), or with ``digest`` (conv_id, repaired_sha256) of the lines.

    The edits of a run come before its rows in one stream, in which each conversation's rows stand in order.
    """
    empty = {"role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "edits": F.lit(None).cast("array<string>")}
    columns = ["conv_id", "at", "kind", "role", "text", "edits"]
    tables = [
        rows.withColumns({"kind": F.lit(1), "edits": empty["edits"]}),
        edits.withColumns({"at": F.col("first"), "kind": F.lit(0), "role": empty["role"], "text": empty["text"]}),
        tails.withColumns(
            {"at": F.lit((1 << 63) - 1), "kind": F.lit(2), "role": empty["role"], "text": empty["text"], "edits": F.array("tail")}
        ),
    ]
    one, two, three = (t.select(*columns) for t in tables)
    stream = one.unionByName(two).unionByName(three).repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, repaired, coming, number, hashed = None, None, None, 0, None
        for convs, kinds, roles, texts, edits in column_rows(batches, *[c for c in columns if c != "at"]):
            done = []
            for key, kind, role, text, given in zip(convs, kinds, roles, texts, edits):
                if key != conv:
                    conv, repaired, number, hashed = key, Repaired(), 0, hashlib.sha256()
                if kind == 0:
                    coming = iter(given)
                    continue
                lines = repaired.lines(next(coming), role, text) if kind == 1 else repaired.inserted(given[0])
                for line in lines:
                    if digest:
                        hashed.update((("\n" if number else "") + line).encode("utf-8", "surrogatepass"))
                    else:
                        done.append((key, number, line))
                    number += 1
                if digest and kind == 2:
                    done.append((key, 0, hashed.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in done], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.string()))],
                ["conv_id", "number", "line"],
            )

    out = stream.mapInArrow(work, "conv_id string, number long, line string")
    return out.select("conv_id", F.col("line").alias("repaired_sha256")) if digest else out


class Repair:
    """Cheapest edits of rows (conv_id as text, turn, role, text), with every intermediate table written once."""

    def __init__(self, rows: DataFrame):
        ship(rows.sparkSession)
        self.rows = in_order(rows, ["role", "text"], "repair_rows")
        self.judged = stored(_judged(self.rows), "repair_judged")
        run = F.floor(F.col("at") / RUN_ROWS)
        codes = F.sort_array(F.collect_list(F.struct("at", "code")))
        self.runs = stored(
            self.judged.groupBy("conv_id", run.alias("run")).agg(
                F.min("at").alias("first"), F.array_join(F.transform(codes, lambda c: c["code"]), "").alias("codes")
            ),
            "repair_runs",
        )
        self.bounds = stored(_bounds(_summaries(self.runs)), "repair_bounds")
        self.edits = stored(_edits(self.runs, self.bounds), "repair_edits")

    def counts(self) -> DataFrame:
        turns = F.count_distinct("turn")
        gaps = F.try_add(F.try_subtract(F.max("turn"), F.min("turn")), 1 - turns)
        none = F.count("turn") == 0
        return self.judged.groupBy("conv_id").agg(
            F.when(none, F.lit(0).cast("long")).otherwise(gaps).alias("gaps"),
            *[F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")],
        )

    def audits(self) -> DataFrame:
        parts = F.sort_array(F.collect_list(F.struct("run", F.array_join("edits", "").alias("part"))))
        rows = self.edits.groupBy("conv_id").agg(F.array_join(parts.getField("part"), "").alias("_audit"))
        return rows.join(self.bounds, "conv_id").select("conv_id", "illegal", "cost", F.concat("_audit", "tail").alias("audit"))

    def lines(self, digest: bool = False) -> DataFrame:
        return repaired_lines(self.rows.select("conv_id", "at", "role", "text"), self.edits, self.bounds.select("conv_id", "tail"), digest)


def repair_report(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table, damaged and repaired."""
    repair = Repair(damaged(conversations))
    every = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    every = every.withColumn("conv_id", F.coalesce(F.col("id").cast("string"), F.lit("")))
    met = every.join(repair.counts(), "conv_id", "left").join(repair.audits(), "conv_id", "left").join(repair.lines(True), "conv_id", "left")
    has_rows = F.col("audit").isNotNull()
    zero = lambda c: F.when(has_rows, F.col(c)).otherwise(F.lit(0).cast("long")).alias(c)
    return met.select(
        F.col("id").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


ORACLE_SQL = f"""
WITH RECURSIVE source AS (
    SELECT coalesce(conv_id::VARCHAR, '') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {CRC32.format(text="(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS fault
    FROM conversations),
faulty AS (
    SELECT conv, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM source WHERE fault <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS pos FROM faulty),
judged AS (
    SELECT *, role[1] AS letter, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
           row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 AS again,
           NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS cut,
           lag(role[1]) OVER (PARTITION BY conv ORDER BY pos) || role[1] AS pair
    FROM placed),
counted AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
           count(*) FILTER (WHERE NOT blank AND again) AS duplicate,
           count(*) FILTER (WHERE NOT blank AND NOT again AND cut) AS truncated,
           count(*) FILTER (WHERE pos > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows
    FROM judged GROUP BY conv),
states(q) AS (VALUES (0), (1), (2), (3)),
arcs(a, letter, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
names(letter, name) AS (VALUES ('u', 'user'), ('a', 'assistant')),
one AS (SELECT a, b, name FROM arcs JOIN names USING (letter)),
inserts AS (
    SELECT q AS a, q AS b, 0 AS k, '' AS edits, []::VARCHAR[] AS lines FROM states
    UNION ALL SELECT a, b, 1, 'I', [name || ':'] FROM one
    UNION ALL SELECT x.a, y.b, 2, 'II', [x.name || ':', y.name || ':'] FROM one x JOIN one y ON x.b = y.a),
moves AS (
    SELECT 'D' AS edit, q AS a, q AS b, '' AS letter, '' AS name FROM states
    UNION ALL SELECT 'K', a, b, letter, '' FROM arcs
    UNION ALL SELECT 'R', a, b, letter, name FROM arcs JOIN names USING (letter)),
ways AS (
    SELECT conv, 0::BIGINT AS pos, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM counted
    UNION ALL
    SELECT conv, pos, state, cost, audit, lines FROM (
        SELECT *, row_number() OVER (PARTITION BY conv, state ORDER BY cost, audit) AS nth FROM (
            SELECT w.conv, r.pos, m.b AS state, w.audit || i.edits || m.edit AS audit,
                   w.cost + 2 * i.k + CASE m.edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 + r.cut::INT ELSE r.cut::INT END AS cost,
                   w.lines || i.lines || CASE m.edit WHEN 'D' THEN [] WHEN 'R' THEN [m.name || ':' || r.text]
                                         ELSE [r.role || ':' || r.text] END AS lines
            FROM ways w JOIN judged r ON r.conv = w.conv AND r.pos = w.pos + 1 JOIN inserts i ON i.a = w.state
            JOIN moves m ON m.a = i.b AND (m.edit = 'D' OR NOT (r.blank OR r.again) AND (m.edit = 'R' OR m.letter = r.letter))))
    WHERE nth = 1),
ended AS (
    SELECT w.conv, w.cost + 2 * i.k AS cost, w.audit || i.edits AS audit, w.lines || i.lines AS lines,
           row_number() OVER (PARTITION BY w.conv ORDER BY w.cost + 2 * i.k, w.audit || i.edits) AS nth
    FROM ways w JOIN counted c ON c.conv = w.conv AND c.n_rows = w.pos
    JOIN inserts i ON i.a = w.state AND (i.b = 3 OR i.b = 0))
SELECT s.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
       coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
       coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.cost, 0)::BIGINT AS cost, coalesce(e.audit, '') AS audit,
       sha256(coalesce(array_to_string(e.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) s
LEFT JOIN counted c ON c.conv = coalesce(s.conv_id::VARCHAR, '') LEFT JOIN ended e ON e.conv = c.conv AND e.nth = 1
"""
