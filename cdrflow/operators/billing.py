"""Billing: monthly invoice per subscriber with discount, tax and fee.

``invoice_subtotals`` is one hash aggregation on (customer_id,
billing_period) with a partial (map-side) step, so a subscriber with a huge
share of the traffic is pre-summed inside every map task before the
shuffle.  The month invoice then joins eligible subscribers to those sums;
both sides are keyed by subscriber and have one row per subscriber.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdrflow.functions.money import dec
from cdrflow.operators.rating import eligible
from cdrflow.params import Params
from cdrflow.schemas import MONEY

INVOICE_COLUMNS = [
    "customer_id",
    "billing_period",
    "region",
    "rate_plan_id",
    "voice_total",
    "sms_total",
    "data_total",
    "amount_before_tax",
    "discount_pct",
    "after_discount",
    "tax",
    "amount_due",
]


def rated_only(rated: DataFrame) -> DataFrame:
    return rated.filter(F.col("rating_status") == "rated")


def invoice_subtotals(rated: DataFrame, money: str = "decimal") -> DataFrame:
    """Per subscriber and month: voice, sms and data charges and their total."""
    cost = F.col("cost")
    zero = F.lit(0.0) if money == "double" else F.lit(0).cast(MONEY)
    rt = F.col("record_type")

    def total(c):
        s = F.sum(c)
        return s if money == "double" else s.cast(MONEY)

    return (
        rated_only(rated)
        .groupBy("customer_id", "billing_period")
        .agg(
            total(F.when(rt == "voice", cost).otherwise(zero)).alias("voice_total"),
            total(F.when(rt == "sms", cost).otherwise(zero)).alias("sms_total"),
            total(F.when(rt == "data", cost).otherwise(zero)).alias("data_total"),
            total(cost).alias("amount_before_tax"),
        )
    )


def price_invoice(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Discount on the subtotal, VAT on the discounted amount, plus the fee;
    the amount due is rounded half up to cents."""
    if params.money == "double":
        disc, vat, fee = F.lit(float(params.discount)), F.lit(float(params.vat)), F.lit(float(params.fee))
        one = F.lit(1.0)
    else:
        disc, vat, fee, one = dec(params.discount), dec(params.vat), dec(params.fee), dec(1)
    after = F.col("amount_before_tax") * (one - disc)
    tax = after * vat
    return df.withColumns(
        {
            "discount_pct": disc,
            "after_discount": after,
            "tax": tax,
            "amount_due": F.round(after + tax + fee, 2),
        }
    )


def invoice_totals(rated: DataFrame, params: Params = Params()) -> DataFrame:
    return price_invoice(invoice_subtotals(rated, params.money), params)


def zero_fill(df: DataFrame, params: Params) -> DataFrame:
    """Eligible subscribers without usage: every amount 0, discount as usual,
    no fee."""
    if params.money == "double":
        zero, disc = F.lit(0.0), F.lit(float(params.discount))
    else:
        zero, disc = F.lit(0), dec(params.discount)
    schema = df.schema
    fills = {
        c: F.coalesce(F.col(c), zero.cast(schema[c].dataType))
        for c in ("voice_total", "sms_total", "data_total", "amount_before_tax", "after_discount", "tax", "amount_due")
    }
    fills["discount_pct"] = F.coalesce(F.col("discount_pct"), disc.cast(schema["discount_pct"].dataType))
    return df.withColumns(fills)


def invoices_for_months(
    rated: DataFrame,
    subscriptions: DataFrame,
    months: Sequence[str],
    params: Params = Params(),
) -> DataFrame:
    """One invoice row per eligible subscriber and billing month.

    The months are a short parameter list; each subscriber row is repeated
    once per month with ``explode`` (a generator, not a join), then the
    month totals are attached with a left join on (customer_id,
    billing_period).  The month filter sits below the aggregation, so with
    a month-partitioned rated table only those partitions are read.
    """
    months = list(dict.fromkeys(months))  # a month listed twice is billed once
    if not months:
        raise ValueError("at least one billing month is required")
    subs = eligible(subscriptions, ("customer_id", "region", "rate_plan_id"))
    if len(months) == 1:
        subs = subs.withColumn("billing_period", F.lit(months[0]))
    else:
        subs = subs.withColumn("billing_period", F.explode(F.array(*[F.lit(m) for m in months])))
    month_rated = rated.filter(F.col("billing_period").isin(*months))
    totals = invoice_totals(month_rated, params)
    joined = subs.join(totals, on=["customer_id", "billing_period"], how="left")
    return zero_fill(joined, params).select(*INVOICE_COLUMNS)


def invoices_for_month(
    rated: DataFrame, subscriptions: DataFrame, params: Params = Params(), month: str | None = None
) -> DataFrame:
    return invoices_for_months(rated, subscriptions, [month or params.billing_month], params)
