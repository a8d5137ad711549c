"""Dimension reads over JDBC, binary message values, parameters, double money end to end."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdrflow.params import FIXTURE_MONTHS, FIXTURE_PARAMS, Params
from cdrflow.plans.stages import fixture_stages, run_batch
from cdrflow.sources import dims, files
from cdrflow.sources.cdr_json import decode_cdr, encode_cdr
from cdrflow.sources.fixtures import fixture_cdrs
from sf_dirs import SF_SMALL


def test_read_dim_over_jdbc_casts_tariffs(spark):
    url = f"jdbc:derby:memory:dims_{os.getpid()};create=true"
    opts = {"url": url, "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    # a tariff table whose numeric columns arrive as double / bigint
    raw = dims.rate_plans(spark).select(
        "rate_plan_id", "product_code", "service_type",
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("free_units").cast("bigint").alias("free_units"),
        F.col("tier_threshold").cast("bigint").alias("tier_threshold"),
        F.col("tier_price").cast("double").alias("tier_price"),
    )
    try:
        files.write_jdbc(raw, "RATE_PLANS", opts)
    except Exception as e:  # pragma: no cover
        pytest.skip(f"embedded Derby unavailable: {e}")
    got = dims.read_dim(spark, "RATE_PLANS", "jdbc", opts)
    got = got.toDF(*[c.lower() for c in got.columns])
    typed = dims.typed_rate_plans(got)
    assert dict(typed.dtypes)["unit_price"] == "decimal(6,3)" and dict(typed.dtypes)["free_units"] == "int"
    assert typed.exceptAll(dims.rate_plans(spark)).count() == 0


def test_decode_binary_values(spark):
    cdrs = fixture_cdrs(spark, SF_SMALL)
    msgs = encode_cdr(cdrs).select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    assert dict(msgs.dtypes)["value"] == "binary"
    back = decode_cdr(msgs)
    assert back.exceptAll(cdrs).count() == 0


def test_params_validation():
    with pytest.raises(ValueError):
        Params(boundary="nearest")
    with pytest.raises(ValueError):
        Params(billing_month="2024/02")
    with pytest.raises(ValueError):
        Params(discount=Decimal("0.0000001"))
    assert Params(discount=Decimal("0.055")).discount == Decimal("0.055")


def test_double_money_end_to_end(spark, tmp_dir):
    exact = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    dbl = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS.with_(money="double"))
    paths = run_batch(dbl, f"{tmp_dir}/dbl", months=list(FIXTURE_MONTHS))
    inv = files.read_invoices(spark, paths["invoice"], "double")
    assert dict(inv.dtypes)["amount_due"] == "double"
    want = {(r.customer_id, r.billing_period): r.amount_due for r in exact.invoices(FIXTURE_MONTHS).collect()}
    got = {(r.customer_id, r.billing_period): r.amount_due for r in inv.collect()}
    assert set(got) == set(want)
    # double money may differ from exact money by a rounding step, never more
    assert max(abs(float(want[k]) - got[k]) for k in want) <= 0.0100001


def test_subscriptions_read_in_parallel_by_key_range(spark):
    from cdrflow.sources.fixtures import fixture_subscribers

    url = f"jdbc:derby:memory:subs_{os.getpid()};create=true"
    opts = {"url": url, "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    subs = fixture_subscribers(spark, SF_SMALL).select("customer_id", "status", "subscription_type", "rate_plan_id")
    extra = spark.createDataFrame([("X1A", "active", "postpaid", "Gold")], subs.schema)
    try:
        files.write_jdbc(subs.unionByName(extra), "SUBS", {**opts, "createTableColumnTypes": "customer_id VARCHAR(32)"})
    except Exception as e:  # pragma: no cover
        pytest.skip(f"embedded Derby unavailable: {e}")
    # Spark created the Derby column quoted, lower case
    preds = dims.range_predicates('"customer_id"', "212600000000", "212600000200", 7)
    par = dims.read_dim(spark, "SUBS", "jdbc", opts, predicates=preds)
    assert par.rdd.getNumPartitions() == len(preds) == 7
    whole = dims.read_dim(spark, "SUBS", "jdbc", opts)
    assert par.count() == whole.count() == subs.count() + 1
    assert par.exceptAll(whole).count() == 0


def test_long_keys_are_not_cut(spark):
    from cdrflow.sources.fixtures import cdrs_from_events, subscribers_from_customers

    events = spark.createDataFrame(
        [(k, 1234567890 + k, "click", 1.0) for k in (3, 4)], "event_id long, user_id long, event_type string, value double"
    ).withColumn("ts", F.lit("2024-01-05 10:00:00").cast("timestamp_ntz"))
    assert {r.caller_id for r in cdrs_from_events(events).collect()} == {"21261234567893", "21261234567894"}
    customer = spark.createDataFrame(
        [(1234567890 + k, "n", "BUILDING", 0) for k in (0, 1)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey int"
    )
    nation = spark.createDataFrame([(0, 0)], "n_nationkey int, n_regionkey int")
    region = spark.createDataFrame([(0, "r")], "r_regionkey int, r_name string")
    ids = {r.customer_id for r in subscribers_from_customers(customer, nation, region).collect()}
    assert ids == {"21261234567890", "21261234567891"}


def test_runtime_settings_reach_an_existing_session(spark):
    from cdrflow.session import RUNTIME_CONF, apply_runtime_conf

    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
    apply_runtime_conf(spark.newSession())
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    fresh = spark.newSession()
    apply_runtime_conf(fresh)
    assert all(fresh.conf.get(k) == v for k, v in RUNTIME_CONF.items() if k not in given)
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def test_cluster_without_a_shared_folder_is_an_error():
    from cdrflow.session import ensure_checkpoint_dir

    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf({"spark.master": "yarn"}), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_cluster_conf_sizes_partitions():
    from cdrflow.session import cluster_conf

    big = cluster_conf(100 * 1024**4, 8000)  # 100 TB on 1000 executors x 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024**2)
    small = cluster_conf(10 * 1024**2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
