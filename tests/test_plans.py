"""Plan-shape regressions: what the physical plans must keep at scale."""

import pytest

from cdrflow.operators import mediation
from cdrflow.params import FIXTURE_PARAMS
from cdrflow.plans.stages import fixture_stages
from cdrflow.sources.cdr_json import read_cdr_stream
from sf_dirs import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rating_is_one_stage_when_dimensions_broadcast(spark):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    plan = _plan(st.rated())
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 3


def test_feed_scan_gets_filters_and_pruned_columns(spark):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    plan = _plan(st.rated())
    scan = [line for line in plan.splitlines() if "cdr-feed" in line][0]
    assert "PushedFilters: [IsNotNull(record_type), IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in scan
    assert "cell_id" not in scan.split("ReadSchema:")[1]  # rating never reads the cell


def test_month_invoice_filters_below_aggregation(spark):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = _plan(st.invoices())
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "partial_sum" in plan  # map-side combine before the shuffle
    # the month bounds the event times of the feed's scan
    scan = [line for line in plan.splitlines() if "cdr-feed" in line][0]
    pushed = scan.split("PushedFilters:")[1]
    assert "GreaterThanOrEqual(timestamp,2024-02-01T00:00)" in pushed and "LessThan(timestamp,2024-03-01T00:00)" in pushed


def test_building_the_rating_plan_starts_no_job(spark):
    from cdrflow.operators import rating

    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    spark.sparkContext.setJobGroup("build-only", "")
    try:
        rated = rating.rate(st.mediated(), st.subscriptions, st.catalog, st.plans, FIXTURE_PARAMS)
        st.invoices()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs
    plan = _plan(rated)
    assert plan.count("BroadcastHashJoin") == 3 and "SinglePartition" not in plan


def test_each_number_is_matched_once(spark):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    optimized = st.mediated()._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("RLIKE") <= 2
    audit = mediation.audit_metrics()
    assert not any("RLIKE" in str(c).upper() for c in audit)


def test_kafka_without_connector_says_so(spark):
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_cdr_stream(spark, "kafka", {"kafka.bootstrap.servers": "localhost:1"})


def test_orphan_report_scans_the_feed_once(spark):
    import __spark_entry__ as entry

    df = entry.queries()["dq_orphans"](spark, SF_SMALL)
    plan = _plan(df)
    assert sum("cdr-feed" in line for line in plan.splitlines() if "FileScan" in line or "Scan parquet" in line) == 1
