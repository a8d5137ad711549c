"""Rating and billing batch by batch, each batch once.

``add_batch`` rates one mediated batch, stores its rated records under the
batch's label and adds their sums to the invoice totals.  Only the buckets of
subscribers that the batch has records of are read, added up and priced again;
all others stay as they are.  A batch that is run again changes nothing: its
rated records replace themselves, and the totals know its label.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow import schemas
from cdrflow.operators import billing, rating
from cdrflow.params import Params
from cdrflow.sources.files import conform, write_partitioned
from cdrflow.sources.merge_store import MergeStore

AMOUNTS = ["voice_total", "sms_total", "data_total", "amount_before_tax"]
TOTALS = T.StructType([f for f in schemas.INVOICE.fields if f.name not in ("region", "rate_plan_id")])
RATED = T.StructType([*schemas.RATED.fields[:-1], T.StructField("load", T.StringType()), schemas.RATED["billing_period"]])


@dataclass(frozen=True)
class IncrementalBilling:
    """Rated records and invoice totals under ``root``, kept up batch by batch
    (exact decimal money)."""

    spark: SparkSession
    root: str
    params: Params = Params()
    n_buckets: int = 64

    @property
    def totals(self) -> MergeStore:
        return MergeStore(self.spark, f"{self.root}/totals", TOTALS, ("customer_id",), self.n_buckets)

    def rated(self) -> DataFrame:
        return self.spark.read.schema(RATED).parquet(f"{self.root}/rated")

    def add_batch(
        self, mediated: DataFrame, label: str, subscriptions: DataFrame, catalog: DataFrame, plans: DataFrame,
        dims_trusted_small: bool = False,
    ) -> list[int]:
        """Rate and bill one batch; the buckets of subscribers whose totals changed.

        A batch that dies on the way is run again under its label.
        """
        if self.totals.applied(label):
            return []
        rated = rating.rate(mediated, subscriptions, catalog, plans, self.params, dims_trusted_small)
        out = conform(rated.withColumn("load", F.lit(label)), RATED)
        write_partitioned(out, f"{self.root}/rated", ["load", "billing_period"])
        mine = self.rated().filter(F.col("load") == label)
        return self.totals.merge(billing.invoice_totals(mine, self.params), self._added, label)

    def _added(self, stored: DataFrame, more: DataFrame) -> DataFrame:
        """Sums of sums, priced again."""
        both = stored.select("customer_id", "billing_period", *AMOUNTS).unionByName(
            more.select("customer_id", "billing_period", *AMOUNTS)
        )
        sums = both.groupBy("customer_id", "billing_period").agg(
            *(F.sum(a).cast(schemas.MONEY).alias(a) for a in AMOUNTS)
        )
        return billing.price_invoice(sums, self.params)

    def invoices(self, subscriptions: DataFrame, months: Sequence[str]) -> DataFrame:
        """B2 from the stored totals, equal to billing all rated records at once."""
        months = list(dict.fromkeys(months))
        subs = rating.eligible(subscriptions, ("customer_id", "region", "rate_plan_id"))
        subs = subs.withColumn("billing_period", F.explode(F.array(*map(F.lit, months))))
        totals = self.totals.read().filter(F.col("billing_period").isin(months))
        joined = subs.join(totals, ["customer_id", "billing_period"], "left")
        return billing.zero_fill(joined, self.params).select(*billing.INVOICE_COLUMNS)
