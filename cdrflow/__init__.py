"""cdrflow: call-detail-record mediation, rating, billing and reporting on Spark.

The stages as DataFrame -> DataFrame functions::

    from cdrflow import Params, admit, mediate, rate, invoices_for_month
    mediated = mediate(admit(decoded_cdrs, as_of))
    rated = rate(mediated, subscriptions, catalog, tariffs, Params(billing_month="2025-06"))
    invoices = invoices_for_month(rated, subscriptions, Params(billing_month="2025-06"))
"""

from cdrflow.params import Params
from cdrflow.operators.billing import invoice_totals, invoices_for_month, invoices_for_months
from cdrflow.operators.mediation import admit, mediate
from cdrflow.operators.rating import rate
from cdrflow.plans.stages import Stages

__version__ = "0.1.0"
__all__ = [
    "Params",
    "Stages",
    "admit",
    "invoice_totals",
    "invoices_for_month",
    "invoices_for_months",
    "mediate",
    "rate",
    "__version__",
]
