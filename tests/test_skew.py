"""A subscriber with a third of all records: same results whatever the join
strategy, and the plans that carry the skew."""


from pyspark.sql import functions as F

from cdrflow.operators import billing, dedup, rating
from cdrflow.params import FIXTURE_PARAMS
from cdrflow.plans.stages import fixture_stages
from sf_dirs import SF_SMALL

HOT = "212600000007"


def _skewed(spark):
    """Fixture CDRs where every third record belongs to one subscriber."""
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    hot = F.col("record_ID").cast("long") % 3 == 0
    st.raw = st.raw.withColumns(
        {c: F.when(hot & F.col(c).isNotNull(), F.lit(HOT)).otherwise(F.col(c)) for c in ("caller_id", "sender_id", "user_id")}
    )
    return st


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_hot_key_share(spark):
    st = _skewed(spark)
    keyed = rating.with_customer_id(st.mediated())
    total = keyed.count()
    hot = keyed.filter(F.col("customer_id") == HOT).count()
    assert hot * 4 > total  # about a third of all records


def test_join_strategies_agree(spark):
    st = _skewed(spark)
    base = _rows(billing.invoice_totals(st.rated(), FIXTURE_PARAMS))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # subscriptions too large to broadcast: sort-merge join (AQE splits the hot key)
        smj = st.rated(params=FIXTURE_PARAMS)
        plan = smj._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert _rows(billing.invoice_totals(smj, FIXTURE_PARAMS)) == base
        salted = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS.with_(join_salt_buckets=8))
        salted.raw = st.raw
        splan = salted.rated()._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in splan and "_salt" in splan
        assert _rows(billing.invoice_totals(salted.rated(), FIXTURE_PARAMS)) == base
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_aggregations_pre_aggregate_before_shuffle(spark):
    st = _skewed(spark)
    plan = billing.invoice_subtotals(st.rated())._jdf.queryExecution().executedPlan().toString()
    # partial aggregate below the exchange, final above it
    assert plan.count("HashAggregate") >= 2
    feed = st.mediated().withColumn("batch_id", F.lit(0).cast("long"))
    dplan = dedup.dedup_records(feed.unionByName(feed), "record_ID", "batch_id")._jdf.queryExecution().executedPlan().toString()
    assert dplan.count("Aggregate") >= 2


def test_aqe_splits_the_hot_subscriber_before_billing(spark):
    """Beyond the broadcast limit J1 is a sort-merge join and billing reuses its
    partitioning; AQE must still split the hot key (forceOptimizeSkewedJoin)."""
    st = _skewed(spark)
    base = _rows(billing.invoice_totals(st.rated(), FIXTURE_PARAMS))
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    prev = {k: spark.conf.get(k, None) for k in confs}
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        inv = billing.invoice_totals(st.rated(), FIXTURE_PARAMS)
        assert _rows(inv) == base
        assert "skew=true" in inv._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
