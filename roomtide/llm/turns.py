"""Conversation turns in order, whatever the length of a conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomtide.llm.support import stored

RUN = 4096  # rows that one window may hold

# crc32 of an ASCII text, bit by bit: the polynomial 0xEDB88320 is a fixed value.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"""


def in_order(rows: DataFrame, ties: list[str], name: str, drop: list[str] = ()) -> DataFrame:
    """``rows`` with ``at``, a whole number that rises in each conv_id by turn (nulls first), then by the columns ``ties``.

    The rows are dealt in ranges of that order, so a conversation may cover any number of partitions; ``at`` is the
    partition's number (from bit 33 on) and the place in it. Rows that agree in all of the order's columns are
    neighbours. The result is a written table without the columns ``drop``, so ``at`` stays as it is.
    """
    order = ["conv_id", "turn", *ties]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(placed.withColumn("at", F.monotonically_increasing_id()).drop(*drop), name)


def numbered(rows: DataFrame, ties: list[str], name: str, drop: list[str] = ()) -> DataFrame:
    """``rows`` with ``position``, from 1 on in each conv_id, in the order of ``in_order``.

    What a partition holds of a conversation is counted, and only these counts meet. A null conv_id is a conversation
    of its own.
    """
    placed = in_order(rows, ties, name, drop).withColumn("_part", F.shiftrightunsigned("at", 33))
    pieces = placed.groupBy("conv_id", "_part").agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select(
        F.col("conv_id").alias("_conv"), F.col("_part").alias("_piece"),
        (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    met = placed.join(pieces, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_part") == F.col("_piece")))
    return met.withColumn("position", F.col("at") + F.col("_shift")).drop("at", "_part", "_conv", "_piece", "_shift")


def running(rows: DataFrame, key: str, place: str, values: list[str], after: bool = False) -> DataFrame:
    """``rows`` with sums of ``values``, named ``before_...``, over the earlier places of the same key.

    With ``after`` the sums run over this place and the later ones instead, and are named ``after_...``. Places are
    whole numbers, unique in a key. Windows hold a run of 4,096 places, or one row for each run of a key.
    """
    by = (lambda c: F.col(c).desc()) if after else F.col
    label = "after" if after else "before"
    runs = rows.withColumn("_run", F.floor(F.col(place) / RUN))
    sums = runs.groupBy(key, "_run").agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    outer = Window.partitionBy(key).orderBy(by("_run")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col(key).alias("_key"), F.col("_run").alias("_of"),
        *[F.coalesce(F.sum(f"_s_{v}").over(outer), F.lit(0)).alias(f"_t_{v}") for v in values],
    )
    inner = Window.partitionBy(key, "_run").orderBy(by(place)).rowsBetween(Window.unboundedPreceding, 0 if after else -1)
    runs = runs.withColumns({f"_i_{v}": F.coalesce(F.sum(v).over(inner), F.lit(0)) for v in values})
    met = runs.join(sums, (F.col(key) == F.col("_key")) & (F.col("_run") == F.col("_of")))
    summed = met.withColumns({f"{label}_{v}": F.col(f"_i_{v}") + F.col(f"_t_{v}") for v in values})
    return summed.drop("_run", "_key", "_of", *[f"_{k}_{v}" for v in values for k in "it"])


