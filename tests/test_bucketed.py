"""Bucketed stage tables: no exchange in the rating join and the sums, same invoices."""

import re

import pytest
from pyspark.sql import functions as F

from cdrflow.params import FIXTURE_MONTHS, FIXTURE_PARAMS
from cdrflow.plans.stages import fixture_stages
from cdrflow.sources.bucketed import BucketedStore
from sf_dirs import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


@pytest.fixture()
def no_broadcast(spark):
    """Dimensions too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _store(spark, root, name, st, mediated=None, n=8):
    store = BucketedStore(spark, root, n, name)
    store.store_subscriptions(st.subscriptions)
    store.store_records(st.mediated() if mediated is None else mediated)
    store.rate(st.catalog, st.plans, st.params, dims_trusted_small=True)
    return store


def test_join_and_sums_without_an_exchange(spark, tmp_dir, no_broadcast):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    store = _store(spark, f"{tmp_dir}/b", "t_plain", st)
    records = store.records().filter(F.col("event_month") == "2024-02")
    rated = store.rated_of(records, st.catalog, st.plans, st.params, dims_trusted_small=True)
    plan = _plan(rated)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan
    assert "event_month" in re.search(r"PartitionFilters: \[(.*?)\]", plan).group(1)
    sums = _plan(store.subtotals(["2024-02"]))
    assert "HashAggregate" in sums and "Exchange" not in sums
    # Only the sums of subscribers kept apart are shuffled, after their partial step.
    invoices = _plan(store.invoices(["2024-02"], FIXTURE_PARAMS))
    assert len(re.findall("Exchange hashpartitioning", invoices)) == 1
    want = st.invoices(FIXTURE_MONTHS)
    assert _rows(store.invoices(FIXTURE_MONTHS, FIXTURE_PARAMS)) == _rows(want)


def test_subscriber_with_a_third_of_the_records_is_kept_apart(spark, tmp_dir, no_broadcast):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    usual = st.mediated()
    hot = st.subscriptions.filter("status = 'active' and subscription_type = 'postpaid'").agg(F.min("customer_id")).first()[0]
    third = F.pmod(F.xxhash64("record_ID"), F.lit(3)) == 0
    skewed = usual.withColumns({c: F.when(third, hot).otherwise(F.col(c)) for c in ("caller_id", "sender_id", "user_id")})
    skewed = skewed.withColumns(
        {c: F.when(F.col("record_type") == k, F.col(c)) for c, k in (("caller_id", "voice"), ("sender_id", "sms"), ("user_id", "data"))}
    )
    store = _store(spark, f"{tmp_dir}/b", "t_hot", st, skewed, n=16)
    assert hot not in {r[0] for r in store.records().select("customer_id").distinct().collect()}
    assert store.rated_apart().filter(F.col("customer_id") == hot).count() > 0
    months = store._large().groupBy("event_month").count().collect()
    assert months and all(r["count"] < 16 for r in months)
    per_bucket = store.records().groupBy("event_month", F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_bucket < skewed.count() / 6  # no bucket holds the hot third
    assert _rows(store.invoices(FIXTURE_MONTHS, FIXTURE_PARAMS)) == _rows(st.invoices(FIXTURE_MONTHS, rated=st.rated(skewed)))


def test_another_session_opens_the_tables_and_one_month_is_replaced(spark, tmp_dir):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    _store(spark, f"{tmp_dir}/b", "t_first", st)
    other = BucketedStore(spark, f"{tmp_dir}/b", 8, "t_second")  # the files under another name
    assert _rows(other.invoices(["2024-02"], FIXTURE_PARAMS)) == _rows(st.invoices(["2024-02"]))
    fewer = st.mediated().filter((F.col("event_month") if "event_month" in st.mediated().columns else F.date_format("timestamp", "yyyy-MM")) == "2024-02")
    fewer = fewer.filter("record_type = 'voice'")
    other.store_records(fewer)
    other.rate(st.catalog, st.plans, st.params, months=["2024-02"], dims_trusted_small=True)
    got = other.invoices(FIXTURE_MONTHS, FIXTURE_PARAMS)
    want = st.invoices(FIXTURE_MONTHS).filter("billing_period <> '2024-02'").unionByName(
        st.invoices(["2024-02"], rated=st.rated(fewer)))
    assert _rows(got) == _rows(want)


def test_empty_tables(spark, tmp_dir):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    store = _store(spark, f"{tmp_dir}/b", "t_empty", st, st.mediated().filter("false"), n=4)
    got = store.invoices(["2024-02"], FIXTURE_PARAMS)
    assert got.filter("amount_due <> 0").count() == 0 and got.count() == st.invoices(["2024-02"]).count()
