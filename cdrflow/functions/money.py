"""Exact decimal money helpers.

Charges are ``DECIMAL(22,9)``, which holds units (6 decimals) times price (3)
unrounded; every step of an invoice keeps its natural
decimal scale and only the finished amount is rounded (half up).  Finished
amounts leave the engine as double through ``to_output``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from cdrflow.schemas import MONEY


def dec(value) -> Column:
    """Decimal literal with the scale written in ``value`` (``0.20`` -> scale 2)."""
    return F.lit(Decimal(str(value)))


def money(col: Column, mode: str = "decimal") -> Column:
    """Cast a charge to the money type of the run."""
    return col.cast("double") if mode == "double" else col.cast(MONEY)


def floor_cents(col: Column) -> Column:
    """Truncate to whole cents: ``floor(x * 100) / 100``."""
    return F.floor(col * F.lit(100)) / F.lit(100)


def half_up_average(total: Column, count: Column, scale: int = 6) -> Column:
    """``total / count`` rounded half up to ``scale`` digits, exactly, as double.

    Works in integer units of the money scale so that no intermediate rounding
    can move a value across a half unit.
    """
    units = (total * F.lit(10**MONEY.scale)).cast("decimal(38,0)")
    per = count * F.lit(10 ** (MONEY.scale - scale))
    mag = F.call_function("div", F.abs(units) * F.lit(2) + per, per * F.lit(2))
    signed = F.when(units < 0, -mag).otherwise(mag)
    return signed.cast("double") / F.lit(float(10**scale))


def to_output(col: Column) -> Column:
    """Finished amount as double (query boundary)."""
    return col.cast("double")
