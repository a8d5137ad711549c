"""Rating: match CDRs to subscribers and tariffs and price each record.

Plan shape (see ``explain``): the mediated scan is joined to eligible
subscribers on ``customer_id`` (broadcast while the subscription table is
small by its files' size, sort-merge with AQE skew splitting beyond that), then
to the catalog and the tariff rows, both broadcast because they are a few
rows of configuration.  The rest is one projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdrflow.functions.tariff import billable_units as units_expr
from cdrflow.functions.reuse import per_jvm
from cdrflow.functions.tariff import charge
from cdrflow.operators.joins import join_dimension
from cdrflow.params import Params
from cdrflow.schemas import EVENT_TIME, PRICE


def in_months(df: DataFrame, months, col: str = "timestamp") -> DataFrame:
    """Records whose event time falls in one of the ``yyyy-MM`` months.

    Written as half-open time ranges so the predicate reaches the Parquet
    scan (row-group min/max statistics skip other months); with a dynamic
    partition overwrite of ``billing_period`` only these months are re-rated.
    """
    import datetime as dt

    cond = None
    for m in months:
        start = dt.datetime.strptime(m, "%Y-%m")
        end = dt.datetime(start.year + (start.month == 12), start.month % 12 + 1, 1)
        c = (F.col(col) >= F.lit(start).cast(EVENT_TIME)) & (F.col(col) < F.lit(end).cast(EVENT_TIME))
        cond = c if cond is None else cond | c
    return df if cond is None else df.filter(cond)


def with_customer_id(mediated: DataFrame) -> DataFrame:
    """Subscriber key of the paying party: caller (voice), sender (sms), user (data)."""
    rt = F.col("record_type")
    key = (
        F.when(rt == "voice", F.col("caller_id"))
        .when(rt == "sms", F.col("sender_id"))
        .otherwise(F.col("user_id"))
    )
    return mediated.withColumn("customer_id", key)


def keyed_records(mediated: DataFrame) -> DataFrame:
    """The columns that rating needs, with the subscriber key."""
    return with_customer_id(
        mediated.select(
            "record_ID",
            "record_type",
            "timestamp",
            "caller_id",
            "sender_id",
            "user_id",
            "duration_sec",
            "data_volume_mb",
            "product_code",
            "rating_status",
        )
    )


def eligible(subscriptions: DataFrame, columns: tuple[str, ...] = ("customer_id", "rate_plan_id")) -> DataFrame:
    """Active postpaid subscriptions, projected (filter and columns push down)."""
    return subscriptions.filter(
        (F.col("status") == "active") & (F.col("subscription_type") == "postpaid")
    ).select(*columns)


def join_plan(
    keyed: DataFrame,
    subscriptions: DataFrame,
    salt_buckets: int | None = None,
) -> DataFrame:
    """CDRs of eligible subscribers only, with their rate plan.

    The planner broadcasts the subscriptions while their stored size is below
    the session's threshold; otherwise it is a sort-merge join whose hot
    subscriber keys AQE splits at run time, or, with ``salt_buckets``, a
    salted join on (customer_id, hash(record_ID) mod buckets).  Store a JDBC
    table as Parquet first: a JDBC scan has no size.
    """
    return join_dimension(
        keyed, eligible(subscriptions), "customer_id", "inner", salt_buckets=salt_buckets, salt_source="record_ID"
    )


def join_catalog(df: DataFrame, catalog: DataFrame, trusted_small: bool = False) -> DataFrame:
    """Rate type and unit of the product (left: unknown products stay)."""
    dim = catalog.select("product_code", "rate_type", "unit")
    return join_dimension(df, dim, "product_code", "left", trusted_small=trusted_small)


def join_tariff(df: DataFrame, plans: DataFrame, trusted_small: bool = False) -> DataFrame:
    """Tariff row of (plan, product) (left: missing rows give NULL tariffs)."""
    dim = plans.select(
        "rate_plan_id",
        "product_code",
        F.col("unit_price").cast(PRICE).alias("unit_price"),
        F.col("free_units").cast("int").alias("free_units"),
        F.col("tier_threshold").cast("int").alias("tier_threshold"),
        F.col("tier_price").cast(PRICE).alias("tier_price"),
    )
    return join_dimension(df, dim, ["rate_plan_id", "product_code"], "left", trusted_small=trusted_small)


def with_billable_units(df: DataFrame) -> DataFrame:
    return df.withColumn("billable_units", _units_column())


@per_jvm
def _units_column():
    return units_expr(F.col("record_type"), F.col("duration_sec"), F.col("data_volume_mb"))


def price(df: DataFrame, boundary: str = "whole_units", money: str = "decimal") -> DataFrame:
    """Cost by rate type, final status and billing period.

    ``rating_status`` is ``unmatched`` when the product has no rate type (not
    in the catalog), else ``rated``; the mediation review flag is kept as a
    boolean.  ``billing_period`` is the ``yyyy-MM`` of the event time.
    """
    first, status = _price_columns(boundary, money)
    return df.withColumns(first).withColumn("rating_status", status)


@per_jvm
def _price_columns(boundary: str, money: str):
    cost = charge(
        F.col("billable_units"),
        F.col("rate_type"),
        F.col("free_units"),
        F.col("tier_threshold"),
        F.col("unit_price"),
        F.col("tier_price"),
        boundary=boundary,
        money_mode=money,
    )
    first = {
        "cost": cost,
        "review_flag": F.col("rating_status") == "needs_review",
        "billing_period": F.date_format(F.col("timestamp"), "yyyy-MM"),
    }
    status = F.when(F.col("cost").isNull(), F.lit("unmatched")).otherwise(F.lit("rated"))
    return first, status


RATED_COLUMNS = [
    "record_ID",
    "record_type",
    "timestamp",
    "customer_id",
    "rate_plan_id",
    "product_code",
    "rate_type",
    "unit",
    "unit_price",
    "free_units",
    "tier_threshold",
    "tier_price",
    "billable_units",
    "cost",
    "rating_status",
    "review_flag",
    "billing_period",
]


def rate(
    mediated: DataFrame,
    subscriptions: DataFrame,
    catalog: DataFrame,
    plans: DataFrame,
    params: Params = Params(),
    dims_trusted_small: bool = False,
) -> DataFrame:
    """Full rating stage: key, J1-J3, units, cost, status, period.

    ``dims_trusted_small=True`` is only for the built-in seed tables (literal
    rows, bounded by construction), which are broadcast as they are; stored
    tables are broadcast by their size.  Building the plan starts no job.
    """
    keyed = keyed_records(mediated)
    joined = join_plan(keyed, subscriptions, salt_buckets=params.join_salt_buckets)
    return rate_joined(joined, catalog, plans, params, dims_trusted_small)


def rate_joined(
    joined: DataFrame, catalog: DataFrame, plans: DataFrame, params: Params = Params(), dims_trusted_small: bool = False
) -> DataFrame:
    """The rating stage behind J1: J2, J3, units, cost, status, period."""
    joined = join_catalog(joined, catalog, trusted_small=dims_trusted_small)
    joined = join_tariff(joined, plans, trusted_small=dims_trusted_small)
    rated = price(with_billable_units(joined), params.boundary, params.money)
    return rated.select(*RATED_COLUMNS)
