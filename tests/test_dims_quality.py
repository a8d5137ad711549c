"""Dimension loads and data-quality checks."""

import datetime as dt
from decimal import Decimal

from cdrflow.operators import quality, rating
from cdrflow.params import Params
from cdrflow.schemas import MEDIATED, SUBSCRIPTIONS
from cdrflow.sources import dims


def test_seed_rows(spark):
    assert dims.product_catalog(spark).count() == 5
    plans = dims.rate_plans(spark)
    assert plans.count() == 15
    assert quality.key_violations(plans, ["rate_plan_id", "product_code"]).count() == 0
    gold_ultra = plans.filter("rate_plan_id = 'Gold' AND product_code = 'DATA_ULTRA'").first()
    assert gold_ultra.unit_price == Decimal("0.003") and gold_ultra.tier_threshold == 1000


def test_insert_absent_keeps_existing_and_dedups(spark):
    schema = "k string, v string"
    existing = spark.createDataFrame([("a", "old")], schema)
    incoming = spark.createDataFrame([("a", "new"), ("b", "x2"), ("b", "x1"), ("c", "z")], schema)
    got = sorted(tuple(r) for r in dims.insert_absent(existing, incoming, ["k"]).collect())
    assert got == [("a", "old"), ("b", "x1"), ("c", "z")]


def test_orphans_and_violations(spark):
    day = dt.date(2024, 1, 1)
    subs = spark.createDataFrame([
        ("1", "A", day, "postpaid", "active", "R", "Gold"),
        ("1", "A2", day, "postpaid", "active", "R", "Gold"),       # duplicate key
        ("2", "B", day, "postpaid", "active", "R", "Platinum"),    # unknown plan
        ("3", "C", day, "postpaid", "active", "R", None),          # NULL plan: not an orphan
    ], SUBSCRIPTIONS)
    plans = dims.rate_plans(spark)
    assert [tuple(r) for r in quality.key_violations(subs, ["customer_id"]).collect()] == [("1", 2)]
    orph = quality.orphan_counts("plan", subs, plans, ["rate_plan_id"], "rate_plan_id").collect()
    assert [(r.key, r.rows) for r in orph] == [("Platinum", 1)]
    extra = spark.createDataFrame(
        [("Gold", "FAX", "fax", Decimal("0.1"), 0, None, None)], plans.schema)
    bad = quality.orphans(plans.unionByName(extra), dims.product_catalog(spark), ["product_code"])
    assert [r.product_code for r in bad.collect()] == ["FAX"]


def test_unknown_plan_rates_zero_and_checked_broadcast(spark):
    day = dt.date(2024, 1, 1)
    subs = spark.createDataFrame([("212612345678", "A", day, "postpaid", "active", "R", "Platinum")], SUBSCRIPTIONS)
    names = MEDIATED.fieldNames()
    row = dict.fromkeys(names)
    row.update(record_ID="1", timestamp=dt.datetime(2024, 2, 3), caller_id="212612345678", callee_id="UNK",
               duration_sec=90, product_code="VOICE_NAT", rating_status="ready", record_type="voice")
    med = spark.createDataFrame([tuple(row[c] for c in names)], MEDIATED)
    out = rating.rate(med, subs, dims.product_catalog(spark), dims.rate_plans(spark), Params(), dims_trusted_small=False).first()
    assert out.rating_status == "rated" and out.cost == 0 and out.billable_units == 90


def test_key_and_null_checks_in_one_pass(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", None), ("b", "y"), (None, "z"), (None, "w"), ("c", None)], "k string, v string"
    )
    got = {(r.check_name, r.target): r.violations for r in quality.key_and_null_checks(df, "t", ["k"], ["v"]).collect()}
    assert got == {("duplicate_key", "t:k"): 2, ("null_required", "t:v"): 2}  # keys a and NULL; two NULL values
    # same answers as the separate checks
    assert quality.key_violations(df, ["k"]).count() == 2
    assert quality.null_violations(df, ["v"]).count() == 2
