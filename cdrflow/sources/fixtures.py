"""Call-detail records and subscribers derived from the driver's tables.

The reference has no input data; its inputs are a random simulator and a
seeded database.  For reproducible tests the same kinds of records, with
the same classes of dirty values, are derived deterministically from the
``events`` table (one CDR per event) and from ``customer``/``nation``/
``region`` (one subscriber per customer).  The rules are listed in
FIXTURES.md section 3; the oracle SQL repeats them in DuckDB.

Everything is a narrow projection of the input: no shuffle, no driver work.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrflow import schemas
from cdrflow.functions.reuse import per_jvm


def _digits(col: Column, n: int) -> Column:
    """At least ``n`` digits; a longer number keeps all of them (lpad alone
    would cut it, and different keys would become equal)."""
    text = col.cast("string")
    return F.when(F.length(text) >= n, text).otherwise(F.lpad(text, n, "0"))


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table, set up once per session.

    The driver tables are read-only, so the scan (file listing, footer
    schema) is reused across queries like a registered table.
    """
    from cdrflow.session import session_cache

    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    cache = session_cache(spark)
    key = ("scan", path)
    if key not in cache:
        cache[key] = spark.read.parquet(path)
    return cache[key]


def cdrs_from_events(events: DataFrame) -> DataFrame:
    """One raw CDR per event, in the wire schema (``schemas.RAW_CDR``)."""
    return events.select(*_cdr_columns())


@per_jvm
def _cdr_columns() -> list[Column]:
    e = F.col("event_id")
    v = F.col("value")
    kind = (
        F.when(F.col("event_type") == "signup", F.lit("sms"))
        .when(F.col("event_type") == "view", F.lit("data"))
        .otherwise(F.lit("voice"))
    )
    record_type = F.when(e % 97 == 0, F.lit(None).cast("string")).otherwise(kind)
    days = (F.lit(31) * (e % 3)).cast("int")
    ts = F.when(e % 19 == 0, F.lit(None).cast(schemas.EVENT_TIME)).otherwise(
        F.col("ts").cast(schemas.EVENT_TIME) + F.make_dt_interval(days)
    )
    cell = F.when(e % 10 < 3, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("CELL_"), _digits(e % 20 + 1, 2))
    )
    tech = (
        F.when(e % 8 == 0, "2G").when(e % 8 == 1, "3G").when(e % 8 == 2, "4G")
        .when(e % 8 == 3, "5G").when(e % 8 == 4, "LTE").when(e % 8 == 5, "NR")
        .when(e % 8 == 6, "UMTS")
    )
    payer = (
        F.when(e % 41 == 0, F.lit(None).cast("string"))
        .when(e % 43 == 0, F.concat(F.lit("X"), _digits(e, 11)))
        .when(e % 47 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("2126"), _digits(F.col("user_id"), 8)))
    )
    other = (
        F.when(e % 53 == 0, F.lit(None).cast("string"))
        .when(e % 59 == 0, F.lit("junk"))
        .when(e % 61 == 0, F.lit(""))
        .when(e % 5 == 0, F.concat(F.lit("44"), _digits(e, 10)))
        .otherwise(F.concat(F.lit("2127"), _digits(e, 8)))
    )
    base = F.floor(v)
    duration = (
        F.when(e % 10 == 1, F.lit(None)).when(e % 10 == 2, -(base + 10)).otherwise(base + 10)
    ).cast("int")
    volume = F.when(e % 9 == 0, F.lit(None)).otherwise((v * 10).cast("decimal(12,2)")).cast("double")
    session = (
        F.when(e % 10 == 4, F.lit(None)).when(e % 10 == 6, F.lit(-60)).otherwise(base + 60)
    ).cast("int")
    product = (
        F.when((e % 5 == 0) | (e % 5 == 1), F.lit("DATA_ULTRA"))
        .when(e % 5 == 2, F.lit("DATA_STD"))
        .otherwise(F.lit("DATA_PLUS"))
    )

    def only(kind_name: str, col: Column) -> Column:
        return F.when(kind == kind_name, col)

    return [
        e.cast("string").alias("record_ID"),
        record_type.alias("record_type"),
        ts.alias("timestamp"),
        cell.alias("cell_id"),
        tech.alias("technology"),
        only("voice", payer).alias("caller_id"),
        only("voice", other).alias("callee_id"),
        only("voice", duration).alias("duration_sec"),
        only("sms", payer).alias("sender_id"),
        only("sms", other).alias("receiver_id"),
        only("data", payer).alias("user_id"),
        only("data", volume).alias("data_volume_mb"),
        only("data", session).alias("session_duration_sec"),
        only("data", product).alias("product_code"),
    ]


def subscribers_from_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One subscription per customer (``schemas.SUBSCRIPTIONS``)."""
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    plan = (
        F.when(k % 13 == 3, F.lit(None).cast("string"))
        .when(seg.isin("AUTOMOBILE", "BUILDING"), F.lit("Gold"))
        .when(seg.isin("FURNITURE", "MACHINERY"), F.lit("Silver"))
        .when(seg == "HOUSEHOLD", F.lit("Titanium"))
    )
    geo = nation.select("n_nationkey", "n_regionkey").join(
        region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey", "left"
    )
    return customer.join(
        geo.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey", "left"
    ).select(
        F.concat(F.lit("2126"), _digits(k, 8)).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), (k % 365).cast("int")).alias("activation_date"),
        F.when(k % 11 == 5, F.lit("prepaid")).otherwise(F.lit("postpaid")).alias("subscription_type"),
        F.when(k % 10 == 7, F.lit("suspended")).otherwise(F.lit("active")).alias("status"),
        F.col("r_name").alias("region"),
        plan.alias("rate_plan_id"),
    )


def _derived(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table defined once per session."""
    from cdrflow.session import session_cache

    cache = session_cache(spark)
    key = ("derived", sf_dir, name)
    if key not in cache:
        cache[key] = build()
    return cache[key]


def fixture_cdrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CDR feed derived from ``events``, staged once per session.

    It stands in for the CDR source table: written as a Parquet table in the
    shared checkpoint folder and scanned by every query from there.  Only a
    table with fewer splits than the cluster has cores is spread over them.
    """
    from cdrflow.sources.files import stage_table

    def build():
        from cdrflow.session import parallelism

        events = load_table(spark, sf_dir, "events")
        try:
            splits = events.rdd.getNumPartitions()
        except Exception:  # no RDD API (Spark Connect)
            splits = 0
        cores = parallelism(spark)
        spread = cores if splits < cores else None
        return stage_table(cdrs_from_events(events), "cdr-feed", partitions=spread, key="record_ID")

    return _derived(spark, sf_dir, "cdrs", build)


def fixture_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriptions derived from customer/nation/region, staged once per
    session as a Parquet table (the stand-in for the subscription table)."""
    from cdrflow.sources.files import stage_table

    def build():
        subs = subscribers_from_customers(
            load_table(spark, sf_dir, "customer"),
            load_table(spark, sf_dir, "nation"),
            load_table(spark, sf_dir, "region"),
        )
        return stage_table(subs, "subscriptions")

    return _derived(spark, sf_dir, "subscribers", build)


def fixture_messages_dir(spark: SparkSession, sf_dir: str) -> str:
    """The CDR feed as JSON-lines message files (the stream's wire format),
    written once per session under the checkpoint folder; returns the path."""
    from cdrflow.session import scratch_path, session_cache
    from cdrflow.sources.cdr_json import write_cdr_messages

    cache = session_cache(spark)
    key = ("messages", sf_dir)
    if key not in cache:
        path = scratch_path(spark, "cdr-messages")
        write_cdr_messages(fixture_cdrs(spark, sf_dir), fmt="text", path=path)
        cache[key] = path
    return cache[key]
