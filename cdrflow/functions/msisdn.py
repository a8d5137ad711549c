"""Number-plan validity of a subscriber number (MSISDN without '+')."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's number plan, whitespace
# removed: Morocco 2126/2127 + 8 digits, then USA/Canada, UK, Germany,
# Australia, China, India, Portugal, Brazil, Belgium, Turkey.  The reference's
# pattern ends in an empty alternative, so the empty string is accepted.
MSISDN_PATTERN_COMPAT = r"^(212[67]\d{8}|1\d{10}|44\d{10}|49\d{11}|61\d{9}|86\d{11}|91\d{10}|351\d{9}|55\d{11}|32\d{9}|90\d{10}|)$"
MSISDN_PATTERN_STRICT = r"^(212[67]\d{8}|1\d{10}|44\d{10}|49\d{11}|61\d{9}|86\d{11}|91\d{10}|351\d{9}|55\d{11}|32\d{9}|90\d{10})$"


def msisdn_pattern(mode: str = "compat") -> str:
    if mode == "compat":
        return MSISDN_PATTERN_COMPAT
    if mode == "strict":
        return MSISDN_PATTERN_STRICT
    raise ValueError(f"unknown msisdn mode {mode!r}")


def is_valid_msisdn(col: Column | str, mode: str = "compat") -> Column:
    """True when the number matches one of the plans; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(msisdn_pattern(mode))
