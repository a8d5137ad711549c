"""DataFrame -> DataFrame operators of the four stages."""

from cdrflow.operators import billing, dedup, joins, mediation, quality, rating, reports

__all__ = ["billing", "dedup", "joins", "mediation", "quality", "rating", "reports"]
