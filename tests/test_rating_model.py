"""Property test: rating and month invoices against a plain Python model."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cdrflow import schemas
from cdrflow.operators import billing, rating
from cdrflow.params import Params
from cdrflow.sources import dims

CUSTOMERS = ["212600000001", "212600000002", "212600000003", "212600000004"]
PARAMS = Params(billing_month="2024-02")
CATALOG = {r[0]: r[3] for r in dims.PRODUCT_CATALOG_ROWS}
TARIFF = {(r[0], r[1]): r for r in dims.RATE_PLAN_ROWS}

subscriber = st.tuples(
    st.sampled_from(["active", "suspended"]),
    st.sampled_from(["postpaid", "prepaid"]),
    st.sampled_from(["Gold", "Silver", "Titanium", None, "Platinum"]),
    st.sampled_from(["R1", "R2", None]),
)
cdr = st.fixed_dictionaries({
    "record_type": st.sampled_from(["voice", "sms", "data"]),
    "who": st.sampled_from(CUSTOMERS + ["212699999999"]),
    "month": st.sampled_from([1, 2]),
    "duration_sec": st.sampled_from([1, 30, 61, 600]),
    "voice_product": st.sampled_from(["VOICE_NAT", "VOICE_INT"]),
    "data_product": st.sampled_from(["DATA_STD", "DATA_ULTRA", "DATA_PLUS", None]),
    "data_volume_mb": st.sampled_from([None, Decimal("0.00"), Decimal("99.70"), Decimal("250.50"), Decimal("1000.90"), Decimal("3000.00")]),
    "review": st.booleans(),
})


def cost_of(units, rt, free, thr, p1, p2):
    free, thr = free or 0, thr or 0
    p1, p2 = Decimal(str(p1 or 0)), Decimal(str(p2 or 0))
    cmp = Decimal(int(units))
    if rt == "flat":
        c = Decimal(0) if cmp <= free else (units - free) * p1
    elif cmp <= free:
        c = Decimal(0)
    elif cmp <= thr:
        c = (units - free) * p1
    else:
        c = (thr - free) * p1 + (units - thr) * p2
    return c.quantize(Decimal("0.00001"))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(subs=st.lists(subscriber, min_size=4, max_size=4), cdrs=st.lists(cdr, min_size=1, max_size=50))
def test_rating_and_invoices_match_model(spark, subs, cdrs):
    day = dt.date(2024, 1, 1)
    sub_rows = [(c, f"N{i}", day, t, s, reg, plan) for i, (c, (s, t, plan, reg)) in enumerate(zip(CUSTOMERS, subs))]
    subs_df = spark.createDataFrame(sub_rows, schemas.SUBSCRIPTIONS)
    med_rows = []
    for i, r in enumerate(cdrs):
        row = dict.fromkeys(schemas.MEDIATED_COLUMNS)
        rt = r["record_type"]
        row.update(record_ID=str(i), record_type=rt, timestamp=dt.datetime(2024, r["month"], 10, 8, 0),
                   rating_status="needs_review" if (rt == "data" and r["review"]) else "ready")
        if rt == "voice":
            row.update(caller_id=r["who"], duration_sec=r["duration_sec"], product_code=r["voice_product"])
        elif rt == "sms":
            row.update(sender_id=r["who"], product_code="SMS_STD")
        else:
            row.update(user_id=r["who"], data_volume_mb=r["data_volume_mb"], product_code=r["data_product"])
        med_rows.append(tuple(row[c] for c in schemas.MEDIATED_COLUMNS))
    med = spark.createDataFrame(med_rows, schemas.MEDIATED)
    rated = rating.rate(med, subs_df, dims.product_catalog(spark), dims.rate_plans(spark), PARAMS)
    got = {r.record_ID: (r.cost, r.rating_status) for r in rated.collect()}

    # model
    eligible = {c: (plan, reg) for c, _, _, t, s, reg, plan in sub_rows if s == "active" and t == "postpaid"}
    want, totals = {}, {}
    for i, r in enumerate(cdrs):
        rt, who = r["record_type"], r["who"]
        if who not in eligible:
            continue
        plan = eligible[who][0]
        prod = {"voice": r["voice_product"], "sms": "SMS_STD", "data": r["data_product"]}[rt]
        rate_type = CATALOG.get(prod)
        if rate_type is None:
            want[str(i)] = (None, "unmatched")
            continue
        units = {"voice": Decimal(r["duration_sec"]), "sms": Decimal(1),
                 "data": r["data_volume_mb"] if r["data_volume_mb"] is not None else Decimal(0)}[rt]
        t = TARIFF.get((plan, prod))
        c = cost_of(units, rate_type, *(t[4], t[5], t[3], t[6]) if t else (None, None, None, None))
        want[str(i)] = (c, "rated")
        if r["month"] == 2:
            tot = totals.setdefault(who, {"voice": Decimal(0), "sms": Decimal(0), "data": Decimal(0)})
            tot[rt] += c
    assert got == want

    inv = {r.customer_id: r for r in billing.invoices_for_month(rated, subs_df, PARAMS).collect()}
    assert set(inv) == set(eligible)
    for cust, (plan, reg) in eligible.items():
        r = inv[cust]
        assert (r.rate_plan_id, r.region, r.billing_period) == (plan, reg, "2024-02")
        if cust not in totals:
            assert r.amount_due == 0 and r.amount_before_tax == 0
            continue
        t = totals[cust]
        before = t["voice"] + t["sms"] + t["data"]
        assert (r.voice_total, r.sms_total, r.data_total, r.amount_before_tax) == (t["voice"], t["sms"], t["data"], before)
        due = (before * Decimal("0.95") * Decimal("1.20") + 1).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert r.amount_due == due
