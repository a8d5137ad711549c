"""Dimension tables: product catalog, rate plans, subscriptions.

The catalog and the rate plans are the reference's seed rows.  They are a
few rows of configuration (products x plans), so they are built as literal
DataFrames and may be broadcast without a size check.  Subscriptions come
from an external table of any size (``read_dim``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrflow import schemas

# The reference's product catalog seed rows
# (product_code, service_type, unit, rate_type, description).
PRODUCT_CATALOG_ROWS = [
    ("DATA_STD", "data", "MB", "flat", None),
    ("DATA_ULTRA", "data", "MB", "tiered", None),
    ("SMS_STD", "sms", "sms", "flat", None),
    ("VOICE_INT", "voice", "second", "flat", None),
    ("VOICE_NAT", "voice", "second", "flat", None),
]

# The reference's rate plan seed rows
# (rate_plan_id, product_code, service_type, unit_price, free_units,
#  tier_threshold, tier_price).
RATE_PLAN_ROWS = [
    ("Gold", "DATA_STD", "data", 0.008, 200, None, None),
    ("Gold", "DATA_ULTRA", "data", 0.003, 250, 1000, 0.001),
    ("Gold", "SMS_STD", "sms", 0.075, 1, None, None),
    ("Gold", "VOICE_INT", "voice", 0.180, 10, None, None),
    ("Gold", "VOICE_NAT", "voice", 0.035, 60, None, None),
    ("Silver", "DATA_STD", "data", 0.010, 100, None, None),
    ("Silver", "DATA_ULTRA", "data", 0.005, 200, 500, 0.002),
    ("Silver", "SMS_STD", "sms", 0.100, 0, None, None),
    ("Silver", "VOICE_INT", "voice", 0.250, 0, None, None),
    ("Silver", "VOICE_NAT", "voice", 0.050, 30, None, None),
    ("Titanium", "DATA_STD", "data", 0.005, 300, None, None),
    ("Titanium", "DATA_ULTRA", "data", 0.002, 512, 2048, 0.001),
    ("Titanium", "SMS_STD", "sms", 0.050, 3, None, None),
    ("Titanium", "VOICE_INT", "voice", 0.120, 30, None, None),
    ("Titanium", "VOICE_NAT", "voice", 0.020, 120, None, None),
]


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, Decimal)):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def literal_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small literal table as an inline ``VALUES`` relation.

    It lives in the plan itself (a local relation on the JVM side): no
    Python workers, no scan, and a broadcast of it needs no Spark job.
    """
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    names = [f.name for f in schema.fields]
    cols = ", ".join(f"CAST(col{i + 1} AS {f.dataType.simpleString()}) AS {f.name}" for i, f in enumerate(schema.fields))
    df = spark.sql(f"SELECT {cols} FROM VALUES {values}")
    return df.select(*names)


def _local(spark: SparkSession, name: str, rows, schema) -> DataFrame:
    """A literal table, built once per session."""
    from cdrflow.session import session_cache

    cache = session_cache(spark)
    key = ("literal", name)
    if key not in cache:
        cache[key] = literal_table(spark, rows, schema)
    return cache[key]


def product_catalog(spark: SparkSession) -> DataFrame:
    return _local(spark, "product_catalog", PRODUCT_CATALOG_ROWS, schemas.PRODUCT_CATALOG)


def rate_plans(spark: SparkSession) -> DataFrame:
    rows = [
        (plan, prod, svc, Decimal(str(price)), free, thr, None if tier is None else Decimal(str(tier)))
        for plan, prod, svc, price, free, thr, tier in RATE_PLAN_ROWS
    ]
    return _local(spark, "rate_plans", rows, schemas.RATE_PLANS)


def typed_rate_plans(df: DataFrame) -> DataFrame:
    """Numeric cast on load: prices to DECIMAL(6,3), allowances to int."""
    return df.select(
        "rate_plan_id",
        "product_code",
        "service_type",
        F.col("unit_price").cast(schemas.PRICE).alias("unit_price"),
        F.col("free_units").cast("int").alias("free_units"),
        F.col("tier_threshold").cast("int").alias("tier_threshold"),
        F.col("tier_price").cast(schemas.PRICE).alias("tier_price"),
    )


def range_predicates(column: str, low: str, high: str, parts: int) -> list[str]:
    """``parts`` WHERE clauses that split a table into ranges of a string key,
    which a key index can serve; disjoint and covering every row.

    The bounds lie evenly between the numbers ``low`` and ``high`` (of equal
    length, e.g. ``212600000000`` and ``212799999999``); the first range also takes
    everything below and NULL, the last everything above.
    """
    if len(low) != len(high) or int(low) > int(high):
        raise ValueError("low and high must be numbers of one length, in order")
    width = len(low)
    span = int(high) - int(low) + 1
    cuts = sorted({f"{int(low) + span * k // parts:0{width}d}" for k in range(1, parts)})
    if not cuts:
        return ["1 = 1"]
    first = f"({column} < '{cuts[0]}' OR {column} IS NULL)"
    inner = [f"({column} >= '{a}' AND {column} < '{b}')" for a, b in zip(cuts, cuts[1:])]
    return [first, *inner, f"{column} >= '{cuts[-1]}'"]


def read_dim(
    spark: SparkSession,
    name: str,
    source: str = "jdbc",
    options: dict[str, str] | None = None,
    path: str | None = None,
    predicates: list[str] | None = None,
) -> DataFrame:
    """Read a dimension table from JDBC or a file format.

    A large JDBC table is read in parallel: with a numeric key pass
    ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions`` in
    ``options``; with a string key (``customer_id``) pass ``predicates``
    (e.g. ``range_predicates``), one partition per clause.
    Filters and column selections on the result are pushed into the
    database query by Spark.
    """
    opts = dict(options or {})
    if source == "jdbc" and predicates:
        url = opts.pop("url")
        opts.pop("dbtable", None)
        df = spark.read.jdbc(url, name, predicates=predicates, properties=opts)
    elif source == "jdbc":
        opts.setdefault("dbtable", name)
        df = spark.read.format("jdbc").options(**opts).load()
    else:
        df = spark.read.format(source).options(**opts).load(path or name)
    if name == "rate_plans":
        df = typed_rate_plans(df)
    return df


def insert_absent(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``existing`` plus rows of ``incoming`` whose key is not there yet.

    Same effect as ``INSERT ... ON CONFLICT (keys) DO NOTHING`` applied to the
    whole batch: duplicates inside ``incoming`` keep one row (the smallest by
    all columns, so the result is deterministic), existing rows are never
    changed.  Both sides shuffle once on the key; the anti join and the
    de-duplication share that partitioning.
    """
    cols = existing.columns
    others = [c for c in cols if c not in keys]
    first_per_key = incoming.select(*cols).groupBy(*keys).agg(
        F.min(F.struct(*[F.col(c) for c in others])).alias("_row")
    )
    new_rows = first_per_key.join(existing.select(*keys), on=keys, how="left_anti").select(
        *keys, "_row.*"
    )
    return existing.unionByName(new_rows.select(*cols))
