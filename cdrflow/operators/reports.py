"""Business reports over invoices and rated records.

Each report is a partial/final hash aggregation followed by a global sort of
the (small) aggregated result.  Sorts carry the grouping key as a tie-break
so the order is total and reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdrflow.functions.money import floor_cents, half_up_average
from cdrflow.operators.billing import rated_only
from cdrflow.operators.stable_sum import stable_sum
from cdrflow.sources.files import stage_table


def _sum(col: str, money: str) -> F.Column:
    s = F.sum(col)
    return s if money == "double" else s.cast("decimal(38,5)")


def top_customers(invoices: DataFrame, money: str = "decimal") -> DataFrame:
    """Subscribers with data charges, by data charges (money, despite the
    column name ``total_data_usage``) and total amount due."""
    return (
        invoices.filter(F.col("data_total") > 0)
        .groupBy("customer_id")
        .agg(
            _sum("data_total", money).alias("total_data_usage"),
            F.sum("amount_due").alias("total_amount_due"),
        )
        .orderBy(F.desc("total_data_usage"), F.asc("customer_id"))
    )


def revenue_by_plan(invoices: DataFrame) -> DataFrame:
    """Revenue including tax per rate plan, largest first."""
    return (
        invoices.groupBy("rate_plan_id")
        .agg(F.sum("amount_due").alias("revenue_TTC"))
        .orderBy(F.desc("revenue_TTC"), F.asc_nulls_last("rate_plan_id"))
    )


def revenue_by_region_plan(invoices: DataFrame) -> DataFrame:
    """Revenue per region and plan: region ascending, revenue descending."""
    return (
        invoices.groupBy("region", "rate_plan_id")
        .agg(F.sum("amount_due").alias("revenue_TTC"))
        .orderBy(F.asc("region"), F.desc("revenue_TTC"), F.asc_nulls_last("rate_plan_id"))
    )


def product_cost(rated: DataFrame, money: str = "decimal") -> DataFrame:
    """Per product: total charge floored to cents, record count, average charge.

    With exact money the average is rounded half up to 6 digits.  With
    ``money="double"`` the charges are added in a defined order, so that the
    floating total and the plain double average, like the reference's, are the
    same on any number of tasks.
    """
    rated = rated_only(rated)
    if money == "double":
        agg = stable_sum(rated, ["product_code"], "cost", "_total", "record_count")
        avg = F.col("_total") / F.col("record_count")
    else:
        agg = rated.groupBy("product_code").agg(F.sum("cost").alias("_total"), F.count(F.lit(1)).alias("record_count"))
        avg = half_up_average(F.col("_total"), F.col("record_count"), 6)
    return agg.select(
        "product_code",
        floor_cents(F.col("_total")).alias("total_cost"),
        "record_count",
        avg.alias("avg_cost_per_record"),
    ).orderBy(F.desc("total_cost"), F.asc("product_code"))


def ranked(ordered: DataFrame) -> DataFrame:
    """A globally sorted frame with each row's place, 1 first, as ``rank``.

    The sort is by range, so partitions follow each other: a row's place is its
    number in its partition plus the rows of those before.  One row a partition
    is summed up; no task sees all rows.
    """
    number = F.monotonically_increasing_id()
    placed = ordered.withColumns(
        {"_part": F.shiftright(number, 33).cast("int"), "_in": number.bitwiseAND(F.lit((1 << 33) - 1))}
    )
    placed = stage_table(placed, "ranked")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    joined = placed.join(starts, "_part")
    return joined.select(*ordered.columns, (F.col("_start") + F.col("_in") + 1).alias("rank"))
