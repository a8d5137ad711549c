"""Billable units and the flat / tiered charge formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cdrflow.functions.money import money
from cdrflow.schemas import PRICE, UNITS


def billable_units(record_type: Column, duration_sec: Column, data_volume_mb: Column) -> Column:
    """Voice: whole seconds (missing or negative -> 0); sms: 1; data: MB (missing -> 0)."""
    seconds = F.when(duration_sec.isNull() | (duration_sec < 0), F.lit(0)).otherwise(duration_sec)
    return (
        F.when(record_type == "voice", F.ceil(seconds).cast(UNITS))
        .when(record_type == "sms", F.lit(1).cast(UNITS))
        .otherwise(F.coalesce(data_volume_mb.try_cast(UNITS), F.lit(0).cast(UNITS)))
    )


def charge(
    units: Column,
    rate_type: Column,
    free_units: Column,
    tier_threshold: Column,
    unit_price: Column,
    tier_price: Column,
    boundary: str = "whole_units",
    money_mode: str = "decimal",
) -> Column:
    """Charge of one record; NULL when the product has no known rate type.

    flat:   units <= free ? 0 : (units - free) * price
    tiered: units <= free ? 0
            : units <= threshold ? (units - free) * price
            : (threshold - free) * price + (units - threshold) * tier_price

    With ``boundary="whole_units"`` the two comparisons look at whole units
    only (100.7 MB against 100 free units is free) while the arithmetic keeps
    the fraction; ``"exact"`` compares the decimal value.  Missing tariff
    fields count as 0 (a known product without a tariff row costs nothing).
    """
    free = F.coalesce(free_units, F.lit(0))
    threshold = F.coalesce(tier_threshold, F.lit(0))
    if money_mode == "double":
        u = units.cast("double")
        price = F.coalesce(unit_price.cast("double"), F.lit(0.0))
        price2 = F.coalesce(tier_price.cast("double"), F.lit(0.0))
    else:
        u = units
        price = F.coalesce(unit_price.cast(PRICE), F.lit(0).cast(PRICE))
        price2 = F.coalesce(tier_price.cast(PRICE), F.lit(0).cast(PRICE))
    cmp = F.floor(units) if boundary == "whole_units" else units
    flat = F.when(cmp <= free, F.lit(0)).otherwise((u - free) * price)
    tiered = (
        F.when(cmp <= free, F.lit(0))
        .when(cmp <= threshold, (u - free) * price)
        .otherwise((threshold - free) * price + (u - threshold) * price2)
    )
    cost = F.when(rate_type == "flat", money(flat, money_mode)).when(
        rate_type == "tiered", money(tiered, money_mode)
    )
    return cost
