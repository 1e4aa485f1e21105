"""Text lines to envelopes, with bad lines set apart."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomtide.functions.casts import event_time
from roomtide.schemas import ENVELOPE, ENVELOPE_COLUMNS

CORRUPT = "_corrupt_record"
WITH_CORRUPT = T.StructType([*ENVELOPE.fields, T.StructField(CORRUPT, T.StringType())])
MALFORMED, UNDATED = "malformed_json", "bad_timestamp"


def parse_envelopes(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Each line's envelope, its text as ``raw``, and ``problem``: NULL, ``MALFORMED`` or ``UNDATED``.

    ``data`` stays the text it was. Missing envelope fields are NULL; blank lines are skipped. ``keep`` names further
    columns of the input that stay.
    """
    lenient = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # The one-row generator keeps Spark from parsing again for each filter on a parsed column.
    parsed = lines.select(*keep, F.col(column).cast("string").alias("raw")).withColumn(
        "e", F.explode(F.array(F.from_json("raw", WITH_CORRUPT, lenient)))
    )
    malformed = F.col("e").isNull() | F.col(f"e.{CORRUPT}").isNotNull()
    blank = malformed & (F.length(F.trim("raw")) == 0)
    undated = event_time(F.col("e.received_at")).isNull()
    problem = F.when(malformed, MALFORMED).when(undated, UNDATED)
    return parsed.where(~blank).select(*keep, "raw", *[f"e.{c}" for c in ENVELOPE_COLUMNS], problem.alias("problem"))


def good(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("problem").isNull()).select(*ENVELOPE_COLUMNS)


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("problem").isNotNull()).select("raw", F.col("problem").alias("reason"))


def well_formed(parsed: DataFrame, include_malformed: bool = False) -> DataFrame:
    """What totals count: every parsed line, undated ones too.

    ``include_malformed`` adds the unreadable lines as all-NULL rows, as a lenient JSON scan shows them.
    """
    unreadable = F.col("problem").eqNullSafe(MALFORMED)
    if not include_malformed:
        return parsed.where(~unreadable).select(*ENVELOPE_COLUMNS)
    return parsed.select(*[F.when(~unreadable, F.col(c)).alias(c) for c in ENVELOPE_COLUMNS])


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Parsed lines of a local or shared JSONL file or folder."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no event file at {path}") from problem
        raise
    return parse_envelopes(lines)
