"""Property tests: Spark column arithmetic against a Python Decimal model.

Each example is a batch of rows evaluated in one Spark job.
"""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdrflow.functions.money import half_up_average
from cdrflow.functions.tariff import charge
from cdrflow.operators.billing import price_invoice
from cdrflow.params import Params

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

cents = st.integers(min_value=0, max_value=10**8).map(lambda v: Decimal(v).scaleb(-2))
price = st.integers(min_value=0, max_value=9999).map(lambda v: Decimal(v).scaleb(-3))
tariff_row = st.tuples(
    cents,
    st.sampled_from(["flat", "tiered", None]),
    st.one_of(st.none(), st.integers(min_value=0, max_value=5000)),
    st.one_of(st.none(), st.integers(min_value=0, max_value=20000)),
    st.one_of(st.none(), price),
    st.one_of(st.none(), price),
)


def model_charge(u, rt, free, thr, p1, p2, whole):
    if rt not in ("flat", "tiered"):
        return None
    free, thr = free or 0, thr or 0
    p1, p2 = p1 or Decimal(0), p2 or Decimal(0)
    cmp = Decimal(int(u)) if whole else u
    if rt == "flat":
        c = Decimal(0) if cmp <= free else (u - free) * p1
    elif cmp <= free:
        c = Decimal(0)
    elif cmp <= thr:
        c = (u - free) * p1
    else:
        c = (thr - free) * p1 + (u - thr) * p2
    return c.quantize(Decimal("0.00001"))


@SETTINGS
@given(rows=st.lists(tariff_row, min_size=1, max_size=40), whole=st.booleans())
def test_charge_matches_decimal_model(spark, rows, whole):
    df = spark.createDataFrame(
        rows, "u decimal(12,2), rt string, free int, thr int, p1 decimal(6,3), p2 decimal(6,3)"
    )
    boundary = "whole_units" if whole else "exact"
    out = df.select(
        "*", charge(F.col("u"), F.col("rt"), F.col("free"), F.col("thr"), F.col("p1"), F.col("p2"), boundary).alias("c")
    ).collect()
    for r in out:
        assert r.c == model_charge(r.u, r.rt, r.free, r.thr, r.p1, r.p2, whole), r


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(min_value=-(10**12), max_value=10**12), st.integers(min_value=1, max_value=10**7)),
                     min_size=1, max_size=40))
def test_half_up_average_is_exact(spark, rows):
    data = [(Decimal(t).scaleb(-5), c) for t, c in rows]
    df = spark.createDataFrame(data, "t decimal(28,5), c bigint")
    out = df.select("t", "c", half_up_average(F.col("t"), F.col("c"), 6).alias("a")).collect()
    for r in out:
        want = (r.t / Decimal(r.c)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
        assert r.a == float(want), (r, want)


@SETTINGS
@given(totals=st.lists(st.integers(min_value=0, max_value=10**10).map(lambda v: Decimal(v).scaleb(-5)), min_size=1, max_size=40),
       disc=st.sampled_from(["0.05", "0.10", "0.055", "0"]), vat=st.sampled_from(["0.20", "0.07", "0.195"]))
def test_invoice_pricing_matches_model(spark, totals, disc, vat):
    p = Params(discount=Decimal(disc), vat=Decimal(vat))
    df = spark.createDataFrame([(t,) for t in totals], "amount_before_tax decimal(18,5)")
    for r in price_invoice(df, p).collect():
        after = r.amount_before_tax * (1 - Decimal(disc))
        tax = after * Decimal(vat)
        assert r.after_discount == after and r.tax == tax
        assert r.amount_due == (after + tax + 1).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
