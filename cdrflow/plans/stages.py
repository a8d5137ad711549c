"""Stage plans: the four stages composed over inputs, lazily.

``Stages`` holds the inputs (raw CDR feed, subscriptions, catalog, tariffs)
and the run parameters and exposes each stage's output as a DataFrame; no
action runs until the caller asks for rows or writes.  ``run_batch`` writes
the stage hand-over tables like the reference does (mediated -> rated ->
invoice -> reports), each stage reading the previous stage's files, which
also cuts the lineage between stages.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrflow.operators import billing, dedup, mediation, rating, reports
from cdrflow.params import FIXTURE_PARAMS, Params
from cdrflow.sources import dims, files
from cdrflow.sources.fixtures import fixture_cdrs, fixture_subscribers


@dataclass
class Stages:
    raw: DataFrame
    subscriptions: DataFrame
    catalog: DataFrame
    plans: DataFrame
    params: Params = field(default_factory=Params)
    # True only when catalog and plans are the built-in seed tables.
    dims_trusted_small: bool = False
    # Stage plans defined so far (lazy DataFrames, not data), keyed by name.
    # Only used when ``reuse_plans`` is set: then the inputs must not be
    # replaced after the first call.
    reuse_plans: bool = False
    _plans: dict = field(default_factory=dict, repr=False)

    def _plan(self, key, build):
        if not self.reuse_plans:
            return build()
        if key not in self._plans:
            self._plans[key] = build()
        return self._plans[key]

    # -- mediation
    def admitted(self) -> DataFrame:
        return self._plan("admitted", lambda: mediation.admit(self.raw, self.params.as_of))

    def mediated(self) -> DataFrame:
        return self._plan("mediated", lambda: mediation.mediate(self.admitted(), self.params.msisdn_mode))

    # -- rating
    def rated(self, mediated: DataFrame | None = None, params: Params | None = None) -> DataFrame:
        p = params or self.params
        if mediated is None and params is None:
            return self._plan("rated", lambda: self._rate(self.mediated(), p))
        return self._rate(self.mediated() if mediated is None else mediated, p)

    def _rate(self, mediated: DataFrame, p: Params) -> DataFrame:
        if p.dedup:
            mediated = dedup.first_deliveries(mediated)
        return rating.rate(mediated, self.subscriptions, self.catalog, self.plans, p, self.dims_trusted_small)

    # -- billing
    def invoices(self, months: Sequence[str] | None = None, rated: DataFrame | None = None) -> DataFrame:
        months = list(months or [self.params.billing_month])

        def build():
            # The months bound the event times of the feed's scan, not only the rated rows.
            r = rated if rated is not None else self._rate(rating.in_months(self.mediated(), months), self.params)
            return billing.invoices_for_months(r, self.subscriptions, months, self.params)

        return self._plan(("invoices", tuple(months)), build) if rated is None else build()

    # -- reports
    def reports(self, invoices: DataFrame | None = None, rated: DataFrame | None = None) -> dict[str, DataFrame]:
        inv = self.invoices() if invoices is None else invoices
        r = self.rated() if rated is None else rated
        return {
            "sortedCustomersByInvoices": reports.top_customers(inv, self.params.money),
            "revenueByPlan": reports.revenue_by_plan(inv),
            "planByRegion": reports.revenue_by_region_plan(inv),
            "product_cost_analysis": reports.product_cost(r, self.params.money),
        }


def fixture_stages(
    spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS, reuse_plans: bool = False
) -> Stages:
    """Stages over the CDRs and subscribers derived from the driver tables."""
    return Stages(
        raw=fixture_cdrs(spark, sf_dir),
        subscriptions=fixture_subscribers(spark, sf_dir),
        catalog=dims.product_catalog(spark),
        plans=dims.rate_plans(spark),
        params=params,
        dims_trusted_small=True,  # literal seed rows
        reuse_plans=reuse_plans,
    )


def shared_fixture_stages(spark: SparkSession, sf_dir: str, params: Params = FIXTURE_PARAMS) -> Stages:
    """One ``Stages`` per (session, sf_dir, params) whose stage plans are
    defined once and shared by every query, like views registered once.
    Executing a query still runs its whole plan."""
    from cdrflow.session import session_cache

    cache = session_cache(spark)
    key = ("stages", sf_dir, params)
    if key not in cache:
        cache[key] = fixture_stages(spark, sf_dir, params, reuse_plans=True)
    return cache[key]


def run_batch(stages: Stages, out_dir: str, batch_id: int = 0, months: Sequence[str] | None = None) -> dict[str, str]:
    """Write every stage's table under ``out_dir`` (a shared file system path).

    Each write replaces the partitions that it has rows for and empties those
    it stands for but has none (the batch's months, every rated month, the
    billed months), so a re-run leaves exactly what it produced.  With
    ``params.dedup`` a record that several batches delivered is priced once.
    Returns the paths.
    """
    spark = stages.raw.sparkSession
    root = out_dir.rstrip("/")
    paths = {
        "mediated": f"{root}/mediated_data",
        "rated": f"{root}/rated_data",
        "invoice": f"{root}/invoice",
        "report": f"{root}/report",
    }
    files.replace_batch(stages.mediated(), paths["mediated"], batch_id)
    mediated = files.read_mediated(spark, paths["mediated"])
    money = stages.params.money
    files.write_rated(stages.rated(mediated), paths["rated"], money)
    rated = files.read_rated(spark, paths["rated"], money)
    billed = list(months or [stages.params.billing_month])
    files.write_invoices(stages.invoices(billed, rated=rated), paths["invoice"], money, months=billed)
    invoices = files.read_invoices(spark, paths["invoice"], money)
    month_filter = F.col("billing_period").isin(*billed)
    for name, df in stages.reports(invoices.filter(month_filter), rated).items():
        files.write_report(df, f"{paths['report']}/{name}.csv", single_file=name in files.BOUNDED_REPORTS)
    return paths
