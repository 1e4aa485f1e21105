"""Tables that grow by micro-batches, in month folders, folded by levels, with a manifest for each month.

A table ``T`` has three folders: ``T`` holds the batches as they came (yyyymm=M/batch_id=N), ``T_runs`` what has been
folded (run=R/yyyymm=M), ``T_manifest`` small JSON files (yyyymm=M/version). A month's newest manifest names its runs and
the last batch that they hold, so a reader takes these runs and the batches behind, and sees each row once at any time.

Folding writes the new batches of a month as a run of level 0. When a level has seven runs, they go with the new
batches into one run of the next level, so a row is written again about log8(n) times for n folds. Months without new
batches are not touched. What only readers of the manifest before the last may still need is deleted by the next
fold or drop.

One fold or drop of a table at a time; readers and the stream need not wait for it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from roomtide.sinks.folders import child_names, delete_folder, read_text, write_text

MONTH = "yyyymm="
BATCH = "batch_id="
FANOUT = 8  # runs of a level that make one of the next
NOTHING = {"upto": -1, "runs": []}


def _clean(path: str) -> str:
    return path.rstrip("/")


def _months(spark: SparkSession, path: str) -> list[str]:
    return sorted(n for n in child_names(spark, path) if n.startswith(MONTH))


def _versions(spark: SparkSession, path: str, month: str) -> list[str]:
    """The manifests of a month, newest first."""
    return sorted((n for n in child_names(spark, f"{_clean(path)}_manifest/{month}") if n.isdigit()), reverse=True)


def manifests(spark: SparkSession, path: str) -> dict[str, dict]:
    """The newest manifest of every month that has one."""
    found = {}
    for month in _months(spark, f"{_clean(path)}_manifest"):
        versions = _versions(spark, path, month)
        if versions:
            found[month] = json.loads(read_text(spark, f"{_clean(path)}_manifest/{month}/{versions[0]}"))
    return found


def _batches(spark: SparkSession, path: str, month: str) -> list[int]:
    names = child_names(spark, f"{_clean(path)}/{month}")
    return sorted(int(n.removeprefix(BATCH)) for n in names if n.startswith(BATCH))


def open_batches(spark: SparkSession, path: str, known: dict[str, dict]) -> dict[str, list[int]]:
    """For each month the batches that no run holds."""
    found = {m: [b for b in _batches(spark, path, m) if b > known.get(m, NOTHING)["upto"]] for m in _months(spark, path)}
    return {m: b for m, b in found.items() if b}


def _read(spark: SparkSession, base: str, folders: list[str], columns: T.StructType) -> DataFrame:
    rows = spark.read.schema(columns).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
    return rows.select(*columns.names)


def _rows_of(spark: SparkSession, path: str, runs: list[str], batches: dict[str, list[int]], columns: T.StructType) -> DataFrame:
    parts = []
    if runs:
        parts.append(_read(spark, f"{_clean(path)}_runs", runs, columns))
    folders = [f"{m}/{BATCH}{b}" for m, numbers in batches.items() for b in numbers]
    if folders:
        parts.append(_read(spark, _clean(path), folders, columns))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], columns)


def read_months(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """The rows of a table; ``columns`` includes the month column ``yyyymm``."""
    known = manifests(spark, path)  # before the batches: what is folded in between is still there
    batches = open_batches(spark, path, known)
    return _rows_of(spark, path, [r["path"] for m in known.values() for r in m["runs"]], batches, columns)


def _publish(spark: SparkSession, path: str, month: str, manifest: dict) -> None:
    versions = _versions(spark, path, month)
    number = int(versions[0]) + 1 if versions else 0
    write_text(spark, f"{_clean(path)}_manifest/{month}/{number:012d}", json.dumps(manifest))


def _tidy(spark: SparkSession, path: str) -> None:
    """Delete what neither of a month's two newest manifests lets a reader use, and the older manifests."""
    path = _clean(path)
    used, folded = set(), {}
    for month in _months(spark, f"{path}_manifest"):
        versions = _versions(spark, path, month)
        for version in versions[2:]:
            delete_folder(spark, f"{path}_manifest/{month}/{version}")
        kept = [json.loads(read_text(spark, f"{path}_manifest/{month}/{v}")) for v in versions[:2]]
        used.update(r["path"] for manifest in kept for r in manifest["runs"])
        folded[month] = kept[-1]["upto"] if len(kept) == 2 else -1
    for run in child_names(spark, f"{path}_runs"):
        months = _months(spark, f"{path}_runs/{run}")
        gone = [m for m in months if f"{run}/{m}" not in used]
        for month in gone:
            delete_folder(spark, f"{path}_runs/{run}/{month}")
        if len(gone) == len(months):
            delete_folder(spark, f"{path}_runs/{run}")
    for month, upto in folded.items():
        numbers = _batches(spark, path, month)
        for number in numbers:
            if number <= upto:
                delete_folder(spark, f"{path}/{month}/{BATCH}{number}")
        if numbers and numbers[-1] <= upto:
            delete_folder(spark, f"{path}/{month}")


def _taken(runs: list[dict]) -> tuple[list[dict], int]:
    """The runs that are due to be folded with new batches, and the level of what comes out."""
    taken, level = [], 0
    while len(full := [r for r in runs if r["level"] == level]) >= FANOUT - 1:
        taken, level = taken + full, level + 1
    return taken, level


def fold_months(spark: SparkSession, path: str, columns: T.StructType, upto: int,
                write: Callable[[DataFrame], DataFrame], whole: Iterable[str] = ()) -> list[str]:
    """Fold the batches up to ``upto`` into runs; gives the months that changed.

    ``write`` prepares a month's rows for being written: sorts, merges or drops some. ``upto`` must be a batch that the
    stream has finished. The months ``whole`` (as folder names) are folded with all their runs, new batches or not.
    """
    known, whole = manifests(spark, path), set(whole)
    batches = {m: [b for b in numbers if b <= upto] for m, numbers in open_batches(spark, path, known).items()}
    batches = {m: numbers for m, numbers in batches.items() if numbers}
    months = sorted(batches.keys() | {m for m in whole if known.get(m, NOTHING)["runs"]})
    if not months:
        return []
    plan = {}
    for month in months:
        runs = known.get(month, NOTHING)["runs"]
        plan[month] = (runs, max([r["level"] for r in runs], default=0)) if month in whole else _taken(runs)
    run = f"run={upto}-{uuid.uuid4().hex[:12]}"
    rows = _rows_of(spark, path, [r["path"] for taken, _ in plan.values() for r in taken], batches, columns)
    write(rows).write.option("compression", "zstd").partitionBy("yyyymm").parquet(f"{_clean(path)}_runs/{run}")
    written = set(_months(spark, f"{_clean(path)}_runs/{run}"))
    for month, (taken, level) in plan.items():
        before = known.get(month, NOTHING)
        runs = [r for r in before["runs"] if r not in taken]
        if month in written:
            runs.append({"path": f"{run}/{month}", "level": level})
        _publish(spark, path, month, {"upto": max([before["upto"], *batches.get(month, [])]), "runs": runs})
    _tidy(spark, path)
    return months


def drop_months(spark: SparkSession, path: str, chosen: Callable[[str], bool]) -> list[str]:
    """Take the months whose value (as ``202401``) is ``chosen`` out of a table; gives those that had rows.

    Readers that begin afterwards see none of their rows. The files go with the next drop, since a reader may be at
    them. A batch that brings rows of such a month later makes it a month again.
    """
    known = manifests(spark, path)
    batches = open_batches(spark, path, known)
    full = {m for m, manifest in known.items() if manifest["runs"]} | batches.keys()
    gone = sorted(m for m in full if chosen(m.removeprefix(MONTH)))
    for month in sorted(full | known.keys()):
        if not chosen(month.removeprefix(MONTH)):
            continue
        empty = {"upto": max([known.get(month, NOTHING)["upto"], *batches.get(month, [])]), "runs": []}
        versions = _versions(spark, path, month)
        if len(versions) < 2 or month in gone or json.loads(read_text(spark, f"{_clean(path)}_manifest/{month}/{versions[1]}")) != empty:
            _publish(spark, path, month, empty)  # a second time for those dropped before: nobody needs their files now
    _tidy(spark, path)
    return [m.removeprefix(MONTH) for m in gone]


def finished_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that a stream with this checkpoint has finished; -1 if none."""
    names = child_names(spark, f"{_clean(checkpoint)}/commits")
    return max((int(n) for n in names if n.isdigit()), default=-1)
