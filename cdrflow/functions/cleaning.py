"""Value normalisation used by mediation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNK"
DEFAULT_TECHNOLOGY = "4G"

# Fixed values (vendor radio names mapped to generations, as in the reference).
TECHNOLOGY_ALIASES = {"LTE": "4G", "NR": "5G", "UMTS": "3G"}


def normalize_technology(col: Column) -> Column:
    """Missing technology becomes 4G; LTE/NR/UMTS become 4G/5G/3G."""
    filled = F.coalesce(col, F.lit(DEFAULT_TECHNOLOGY))
    out = None
    for alias, generation in TECHNOLOGY_ALIASES.items():
        out = (F.when if out is None else out.when)(filled == alias, F.lit(generation))
    return out.otherwise(filled)


def voice_product(callee: Column) -> Column:
    """VOICE_NAT for Moroccan (212...) or unknown callees, else VOICE_INT.

    Decided on the first three characters of the cleaned callee, so an empty
    callee (accepted by the compat number plan) is international.
    """
    prefix = F.substring(callee, 1, 3)
    return (
        F.when(prefix == F.lit(UNKNOWN), F.lit("VOICE_NAT"))
        .when(prefix != F.lit("212"), F.lit("VOICE_INT"))
        .otherwise(F.lit("VOICE_NAT"))
    )
