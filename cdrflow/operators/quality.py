"""Data-quality checks re-aimed from the reference's database constraints.

Primary keys and NOT NULL columns become ``key_violations`` and
``null_violations``; foreign keys and the rating stage's unmatched records
become ``orphans``.  All are distributed aggregations or anti joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with a NULL in any of ``cols``."""
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return df.filter(cond)


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``child`` whose (non-NULL) key has no row in ``parent``.

    A NULL key is not an orphan (SQL foreign-key semantics).  Duplicate parent
    keys do not change an anti join, so the parent is not de-duplicated
    (which would cost a shuffle).
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return child.filter(present).join(parent.select(*keys), on=keys, how="left_anti")


def key_and_null_checks(df: DataFrame, table: str, keys: list[str], required: list[str]) -> DataFrame:
    """Two summary rows (duplicate_key, null_required) from ONE pass: the
    per-key aggregation that finds duplicate keys also counts rows with a
    NULL in ``required``.  A NULL key counts as a key (like ``key_violations``)."""
    null_row = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(null_row, F.lit(1))).alias("_nulls")
    )
    totals = per_key.agg(
        F.count(F.when(F.col("_n") > 1, F.lit(1))).alias("_dup"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).cast("bigint").alias("_null_rows"),
    )
    rows = F.array(
        F.struct(
            F.lit("duplicate_key").alias("check_name"),
            F.lit(f"{table}:{','.join(keys)}").alias("target"),
            F.col("_dup").alias("violations"),
        ),
        F.struct(
            F.lit("null_required").alias("check_name"),
            F.lit(f"{table}:{','.join(required)}").alias("target"),
            F.col("_null_rows").alias("violations"),
        ),
    )
    return totals.select(F.explode(rows).alias("r")).select("r.*")


def summarize(name: str, table: str, df: DataFrame) -> DataFrame:
    """One row (check_name, target, violations) for a violations frame."""
    return df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("check_name"), F.lit(table).alias("target"), "violations"
    )


def orphan_counts(name: str, child: DataFrame, parent: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Orphan rows grouped by their key value ``label``."""
    return (
        orphans(child, parent, keys)
        .groupBy(F.col(label).cast("string").alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("check_name"), "key", "rows")
    )


def cdr_orphan_report(
    keyed: DataFrame,
    eligible_subs: DataFrame,
    catalog: DataFrame,
    plans: DataFrame,
    trusted_dims: bool = False,
) -> DataFrame:
    """Per (check, key): CDRs whose product is not in the catalog, whose payer
    is not an eligible subscriber, or whose known product has no tariff row
    for the subscriber's plan - all three in ONE pass over the CDRs.

    ``keyed`` is the mediated feed with ``customer_id``; ``eligible_subs``
    has (customer_id, rate_plan_id) with unique keys.  The feed is left-joined
    to the three dimensions (the joins keep every CDR), each row emits the
    checks it fails, and one partial/final aggregation counts them.  The
    dimensions are joined like in rating (``trusted_dims``: the built-in seed
    tables).
    """
    from cdrflow.operators.joins import join_dimension

    subs = eligible_subs.select("customer_id", "rate_plan_id", F.lit(True).alias("_eligible"))
    cat = catalog.select("product_code", "rate_type")
    tar = plans.select("rate_plan_id", "product_code", F.lit(True).alias("_tariff"))
    j = join_dimension(keyed.select("record_type", "customer_id", "product_code"), subs, "customer_id", "left")
    j = join_dimension(j, cat, "product_code", "left", trusted_small=trusted_dims)
    j = join_dimension(j, tar, ["rate_plan_id", "product_code"], "left", trusted_small=trusted_dims)
    eligible = F.coalesce(F.col("_eligible"), F.lit(False))

    def check(cond, name, key):
        return F.when(cond, F.struct(F.lit(name).alias("check_name"), key.cast("string").alias("key")))

    failed = F.array(
        check(F.col("product_code").isNotNull() & F.col("rate_type").isNull(), "cdr_product_not_in_catalog", F.col("product_code")),
        check(F.col("customer_id").isNotNull() & ~eligible, "cdr_payer_not_eligible", F.col("record_type")),
        check(eligible & F.col("rate_type").isNotNull() & F.col("_tariff").isNull(), "known_product_without_tariff", F.col("product_code")),
    )
    return (
        j.select(F.explode(failed).alias("c"))
        .where(F.col("c").isNotNull())
        .groupBy("c.check_name", "c.key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
