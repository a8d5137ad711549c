"""Column expressions: pure ``Column -> Column`` builders, all JVM-side."""

from cdrflow.functions.msisdn import MSISDN_PATTERN_COMPAT, MSISDN_PATTERN_STRICT, is_valid_msisdn
from cdrflow.functions.cleaning import normalize_technology, voice_product
from cdrflow.functions.money import dec, floor_cents, half_up_average, to_output
from cdrflow.functions.tariff import billable_units, charge

__all__ = [
    "MSISDN_PATTERN_COMPAT",
    "MSISDN_PATTERN_STRICT",
    "is_valid_msisdn",
    "normalize_technology",
    "voice_product",
    "dec",
    "floor_cents",
    "half_up_average",
    "to_output",
    "billable_units",
    "charge",
]
