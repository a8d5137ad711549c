"""Billing and reporting: hand-made invoices and invariants on the fixture."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cdrflow.operators import billing, reports
from cdrflow.params import FIXTURE_PARAMS, Params
from cdrflow.plans.stages import fixture_stages
from cdrflow.schemas import RATED, SUBSCRIPTIONS
from sf_dirs import SF_SMALL


def _rated(spark, rows):
    names = RATED.fieldNames()
    base = dict.fromkeys(names)
    return spark.createDataFrame([tuple({**base, **r}[c] for c in names) for r in rows], RATED)


def _subs(spark, rows):
    return spark.createDataFrame(rows, SUBSCRIPTIONS)


def _sms(i, cost, money="decimal"):
    return {"record_ID": str(i), "record_type": "sms", "customer_id": "c1", "rate_plan_id": "Silver",
            "product_code": "SMS_STD", "rate_type": "flat", "cost": Decimal(cost), "rating_status": "rated",
            "billing_period": "2024-02"}


def test_nine_silver_sms_decimal_090_double_089(spark):
    rated = _rated(spark, [_sms(i, "0.1") for i in range(9)])
    exact = reports.product_cost(rated).first()
    assert exact.total_cost == Decimal("0.90") and exact.record_count == 9
    dbl = reports.product_cost(rated.withColumn("cost", F.col("cost").cast("double")), "double").first()
    assert float(dbl.total_cost) == 0.89


def test_fee_rule_and_half_up(spark):
    day = dt.date(2024, 1, 1)
    subs = _subs(spark, [
        ("c1", "A", day, "postpaid", "active", "R", "Gold"),
        ("c2", "B", day, "postpaid", "active", "R", "Gold"),
        ("c3", "C", day, "postpaid", "active", "R", None),
        ("c4", "D", day, "prepaid", "active", "R", "Gold"),
    ])
    rows = [
        {**_sms(1, "0"), "customer_id": "c3"},                       # usage of cost 0 pays the fee
        {**_sms(2, "8.77193"), "customer_id": "c2", "record_type": "voice"},
        {**_sms(3, "5"), "customer_id": "c4"},                       # not eligible
        {**_sms(4, "7"), "customer_id": "c2", "rating_status": "unmatched", "cost": None},
    ]
    inv = {r.customer_id: r for r in billing.invoices_for_month(_rated(spark, rows), subs, Params(billing_month="2024-02")).collect()}
    assert set(inv) == {"c1", "c2", "c3"}
    assert inv["c1"].amount_due == 0 and inv["c1"].discount_pct == Decimal("0.05")  # no usage: no fee
    assert inv["c3"].amount_due == Decimal("1.00")
    # 8.77193 * 0.95 * 1.2 + 1 = 10.9999...: exact half-up to cents
    assert inv["c2"].voice_total == Decimal("8.77193")
    want = (Decimal("8.77193") * Decimal("0.95") * Decimal("1.20") + 1).quantize(Decimal("0.01"), "ROUND_HALF_UP")
    assert inv["c2"].amount_due == want


def test_invariants_on_fixture(spark):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    rated = st.rated().cache()
    sub = billing.invoice_subtotals(rated).agg(
        F.sum(F.col("voice_total") + F.col("sms_total") + F.col("data_total") - F.col("amount_before_tax"))
    ).first()[0]
    assert sub == 0
    statuses = {r.rating_status: r["count"] for r in rated.groupBy("rating_status").count().collect()}
    joined = st.rated().count()
    assert sum(statuses.values()) == joined
    inv = st.invoices()
    plan = {r.rate_plan_id: r.revenue_TTC for r in reports.revenue_by_plan(inv).collect()}
    region = reports.revenue_by_region_plan(inv).groupBy("rate_plan_id").agg(F.sum("revenue_TTC").alias("s")).collect()
    assert {r.rate_plan_id: r.s for r in region} == plan
    rated.unpersist()


def test_report_orders(spark):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    rows = reports.revenue_by_region_plan(st.invoices()).collect()
    keys = [(r.region, -r.revenue_TTC) for r in rows]
    assert keys == sorted(keys)
    tops = [r.total_data_usage for r in reports.top_customers(st.invoices()).collect()]
    assert tops == sorted(tops, reverse=True) and len(tops) > 0


def test_month_filter_prunes_partitions(spark, tmp_dir):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    path = f"{tmp_dir}/rated"
    st.rated().write.partitionBy("billing_period").parquet(path)
    from cdrflow.sources.files import read_rated
    rated = read_rated(spark, path)
    plan = billing.invoices_for_month(rated, st.subscriptions, FIXTURE_PARAMS)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(billing_period" in plan and "2024-02" in plan


def test_repeated_month_is_billed_once(spark):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    once = billing.invoices_for_months(st.rated(), st.subscriptions, ["2024-02"], FIXTURE_PARAMS)
    twice = billing.invoices_for_months(st.rated(), st.subscriptions, ["2024-02", "2024-02"], FIXTURE_PARAMS)
    assert twice.count() == once.count()
