"""Run parameters shared by the stages.

Defaults follow the reference: freshness against today's date, a 5 %
discount, 20 % VAT on the discounted amount and a fixed fee of 1 per
invoice with usage.  Money is exact decimal unless ``money="double"`` is
asked for (reproduces the reference's floating-point cents).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from decimal import Decimal

BOUNDARIES = ("whole_units", "exact")
MONEY_MODES = ("decimal", "double")
MSISDN_MODES = ("compat", "strict")


@dataclass(frozen=True)
class Params:
    # Freshness cut-off: records dated before this day are dropped.  None means
    # ``current_date()`` of the session, as in a live stream.
    as_of: dt.date | None = None
    billing_month: str = "2025-06"
    discount: Decimal = Decimal("0.05")
    vat: Decimal = Decimal("0.20")
    fee: Decimal = Decimal("1")
    # "whole_units": allowance and tier limits compare whole units (the
    # fraction still counts in the charge); "exact": compare the decimal value.
    boundary: str = "whole_units"
    money: str = "decimal"
    # "compat" accepts the empty number like the reference's pattern does;
    # "strict" rejects it.
    msisdn_mode: str = "compat"
    # Salt the CDR x subscription join into this many buckets (None: broadcast
    # by size, else sort-merge with AQE skew-join splitting).
    join_salt_buckets: int | None = None
    # Price each record once even when it was delivered several times.
    dedup: bool = False

    def __post_init__(self) -> None:
        if self.boundary not in BOUNDARIES:
            raise ValueError(f"boundary must be one of {BOUNDARIES}")
        if self.money not in MONEY_MODES:
            raise ValueError(f"money must be one of {MONEY_MODES}")
        if self.msisdn_mode not in MSISDN_MODES:
            raise ValueError(f"msisdn_mode must be one of {MSISDN_MODES}")
        dt.datetime.strptime(self.billing_month, "%Y-%m")
        for name in ("discount", "vat", "fee"):
            value = Decimal(str(getattr(self, name)))
            if value.as_tuple().exponent < -6:
                raise ValueError(f"{name} may have at most 6 decimals")

    def with_(self, **changes) -> "Params":
        return replace(self, **changes)


# Parameters of the test fixtures derived from the driver tables.
FIXTURE_PARAMS = Params(as_of=dt.date(2024, 1, 2), billing_month="2024-02")
FIXTURE_MONTHS = ("2024-01", "2024-02", "2024-03", "2024-04")
