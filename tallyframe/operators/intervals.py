"""Points in intervals, for tables of any size on both sides.

Every interval lies on the level whose bins are at least as long as itself, so it touches two bins at most, however
long it is; a point is looked up once on each level that occurs. Bin numbers make it an equi-join, which Spark can
sort, merge and split; the exact test follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins of a level are this many bits longer than those of the level below.
STEP = 2
_TOP = 64 // STEP


def position(col: Column, kind: str) -> Column:
    """A date, time stamp or whole number as a long that keeps its order."""
    if kind == "date":
        return F.unix_date(col).cast("long")
    if kind.startswith("timestamp"):
        return F.unix_micros(col.cast("timestamp"))
    return col.cast("long")


def _level(length: Column) -> Column:
    """The lowest level whose bins hold ``length`` positions: bits of the length, rounded up to whole steps."""
    bits = F.length(F.bin(length))
    return F.ceil(bits / F.lit(STEP)).cast("int")


def _bin(at: Column, level: Column) -> Column:
    return F.call_function("shiftright", at, (level * STEP).cast("int"))


def containment_join(
    points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, keys: Sequence[str] = (),
) -> DataFrame:
    """All pairs of a point and an interval with ``start <= at <= end`` (and equal keys); columns of both sides.

    ``at``, ``start`` and ``end`` are dates, time stamps or whole numbers of one type. Open ends (NULL) reach to the end of
    time; such intervals lie on the top level, where all points of a key meet them. Points without a place, intervals
    without a start and intervals that end before they start match nothing. The sides share no column names but the keys.
    The levels that occur are asked for once: at most 32 numbers.
    """
    kind = points.schema[at].dataType.simpleString()
    lo, hi = position(F.col(start), kind), position(F.col(end), kind)
    laid = intervals.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) <= F.col(end)))).withColumns({
        "_level": F.when(F.col(end).isNull(), F.lit(_TOP)).otherwise(F.least(_level(hi - lo + 1), F.lit(_TOP))), "_lo": lo, "_hi": hi})
    first = _bin(F.col("_lo"), F.col("_level"))
    bins = F.when(F.col("_level") == _TOP, F.array(F.lit(0).cast("long"))).otherwise(
        F.array_distinct(F.array(first, _bin(F.col("_hi"), F.col("_level")))))
    spread = laid.withColumn("_bin", F.explode(bins)).drop("_lo", "_hi")
    levels = sorted(r["_level"] for r in laid.select("_level").distinct().collect())
    here = points.where(F.col(at).isNotNull()).withColumn("_at", position(F.col(at), kind))
    here = here.withColumn("_level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")))
    here = here.withColumn("_bin", F.when(F.col("_level") == _TOP, F.lit(0).cast("long")).otherwise(_bin(F.col("_at"), F.col("_level")))).drop("_at")
    met = here.join(spread, [*keys, "_level", "_bin"])
    return met.where((F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) <= F.col(end)))).drop("_level", "_bin")
