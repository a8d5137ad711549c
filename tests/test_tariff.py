"""Tariff boundaries for every plan x {flat, tiered} product, both boundary modes."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdrflow.functions.tariff import charge
from cdrflow.sources.dims import PRODUCT_CATALOG_ROWS, RATE_PLAN_ROWS

RATE_TYPE = {r[0]: r[3] for r in PRODUCT_CATALOG_ROWS}


def expected(units, rate_type, free, thr, p1, p2, whole):
    cmp = Decimal(int(units)) if whole else units
    free = free or 0
    thr = thr or 0
    p1 = p1 or Decimal(0)
    p2 = p2 or Decimal(0)
    if rate_type == "flat":
        return Decimal(0) if cmp <= free else (units - free) * p1
    if cmp <= free:
        return Decimal(0)
    if cmp <= thr:
        return (units - free) * p1
    return (thr - free) * p1 + (units - thr) * p2


def boundary_units(free, thr):
    pts = [free - 1, free, Decimal(free) + Decimal("0.7")]
    if thr is not None:
        pts += [thr, Decimal(thr) + Decimal("0.5"), thr + 1]
    return [Decimal(p).quantize(Decimal("0.01")) for p in pts if p >= 0]


@pytest.mark.parametrize("boundary", ["whole_units", "exact"])
def test_boundaries(spark, boundary):
    rows = []
    for plan, prod, _svc, price, free, thr, tier in RATE_PLAN_ROWS:
        for u in boundary_units(free, thr):
            rows.append((plan, prod, RATE_TYPE[prod], u, free, thr, Decimal(str(price)), None if tier is None else Decimal(str(tier))))
    df = spark.createDataFrame(
        rows,
        "plan string, prod string, rt string, u decimal(12,2), free int, thr int, p1 decimal(6,3), p2 decimal(6,3)",
    )
    out = df.select(
        "*",
        charge(F.col("u"), F.col("rt"), F.col("free"), F.col("thr"), F.col("p1"), F.col("p2"), boundary=boundary).alias("cost"),
    ).collect()
    assert len(out) == len(rows) >= 50
    for r in out:
        want = expected(r.u, r.rt, r.free, r.thr, r.p1, r.p2, boundary == "whole_units")
        assert r.cost == want.quantize(Decimal("0.00001")), (r, want)


def test_whole_units_fraction_over_allowance_is_free(spark):
    # 100.7 MB against 100 free units: whole units compare equal, charge 0;
    # exact comparison charges the 0.7 MB.
    df = spark.createDataFrame([(Decimal("100.70"),)], "u decimal(12,2)")
    args = (F.col("u"), F.lit("flat"), F.lit(100), F.lit(None).cast("int"), F.lit(Decimal("0.010")), F.lit(None).cast("decimal(6,3)"))
    whole = df.select(charge(*args, boundary="whole_units")).first()[0]
    exact = df.select(charge(*args, boundary="exact")).first()[0]
    assert whole == Decimal("0")
    assert exact == Decimal("0.00700")


def test_unknown_rate_type_is_null_and_missing_tariff_is_zero(spark):
    df = spark.createDataFrame([(Decimal("5"), None), (Decimal("5"), "flat")], "u decimal(12,2), rt string")
    null = F.lit(None)
    got = df.select(
        charge(F.col("u"), F.col("rt"), null.cast("int"), null.cast("int"), null.cast("decimal(6,3)"), null.cast("decimal(6,3)"))
    ).collect()
    assert got[0][0] is None
    assert got[1][0] == Decimal("0")


def test_double_money_mode(spark):
    df = spark.createDataFrame([(Decimal("30.00"),)], "u decimal(12,2)")
    got = df.select(
        charge(F.col("u"), F.lit("flat"), F.lit(0), F.lit(None).cast("int"), F.lit(Decimal("0.100")),
               F.lit(None).cast("decimal(6,3)"), money_mode="double").alias("c")
    )
    assert dict(got.dtypes)["c"] == "double"
    assert abs(got.first()[0] - 3.0) < 1e-9
