"""Sums of doubles that do not depend on the order of the rows.

A floating sum depends on the order of its additions, so a plain ``sum``
changes with the number of tasks.  Here the order is part of the definition,
and equal rows give equal sums on any cluster:

1. Equal values are added one by one in runs of ``RUN``, runs of runs alike.
2. Distinct values are added in ascending order within cells of ``CELL``,
   the sums of cells in ascending order within wider cells, and so on.

Every step is an aggregate of bounded groups over fewer rows than the step
before; the first one counts equal values on the map side, so a product with
a billion equal charges is one row after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Additions in one run; the digits of a count in this base are runs of runs.
RUN = 1000
DIGITS = 4
#: Width of the first cells, which hold ten thousand charges of nine decimals;
#: ``STEP`` cells fill one of the next level.
CELL = 1e-5
STEP = 10_000
LEVELS = 5


def _repeated(x: Column, times: Column) -> Column:
    """``x`` added ``times`` times to 0, one after another."""
    return F.aggregate(F.array_repeat(x, times.cast("int")), F.lit(0.0), lambda a, b: a + b)


def copies_sum(df: DataFrame, value: str, count: str, out: str) -> DataFrame:
    """``out``: the sum of ``count`` copies of ``value``."""
    df = df.withColumns({"_unit": F.col(value), "_left": F.col(count), out: F.lit(0.0)})
    for _ in range(DIGITS):
        more = F.col("_left") >= RUN
        df = df.select(
            *[c for c in df.columns if c not in (out, "_unit", "_left")],
            (F.col(out) + _repeated(F.col("_unit"), F.col("_left") % RUN)).alias(out),
            F.when(more, _repeated(F.col("_unit"), F.lit(RUN))).otherwise(F.lit(0.0)).alias("_unit"),
            F.floor(F.col("_left") / RUN).alias("_left"),
        )
    return df.drop("_unit", "_left")


def stable_sum(df: DataFrame, keys: list[str], value: str, total: str = "total", count: str = "n") -> DataFrame:
    """(keys, total, count) of the rows whose ``value`` is not null."""
    rows = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    rows = copies_sum(rows, "_v", "_n", "_s").select(*keys, "_v", "_s", "_n")
    for level in range(LEVELS):
        width = STEP if level else CELL
        rows = rows.withColumn("_at", F.floor(F.col("_v") / F.lit(float(width))).cast("double"))
        rows = _folded(rows, [*keys, "_at"]).withColumnRenamed("_at", "_v")
    return _folded(rows, keys).select(*keys, F.col("_s").alias(total), F.col("_n").alias(count))


def _folded(rows: DataFrame, by: list[str]) -> DataFrame:
    """The sums of each group in ascending order of ``_v``."""
    parts = F.sort_array(F.collect_list(F.struct("_v", "_s")))
    add = F.aggregate(parts, F.lit(0.0), lambda a, p: a + p["_s"])
    return rows.groupBy(*by).agg(add.alias("_s"), F.sum("_n").alias("_n"))
