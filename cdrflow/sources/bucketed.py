"""Stage tables bucketed by subscriber, for joins that shuffle nothing.

CDRs, rated records and subscriptions are stored in the same number of
buckets of ``customer_id``.  A task then reads the same bucket of both sides:
the monthly rating join and the invoice sums need no exchange, however large
the subscription table is.  The records are shuffled once, when they are
stored, instead of in each monthly run and re-run.

A bucket cannot be split while it is read, so subscribers with more than a
bucket's share of the records are kept apart, in files that any number of
tasks can read.  There are at most ``n_buckets`` of them, whatever the data;
their few subscriptions are broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow import schemas
from cdrflow.operators import billing, rating
from cdrflow.params import Params
from cdrflow.sources.files import conform, event_month, write_partitioned

KEY = "customer_id"

#: What rating needs of a mediated record, with its subscriber and month.
KEYED = T.StructType(
    [f for f in schemas.MEDIATED.fields if f.name in (
        "record_ID", "timestamp", "caller_id", "sender_id", "user_id", "duration_sec", "data_volume_mb", "product_code",
        "rating_status", "record_type")]
    + [T.StructField(KEY, T.StringType()), T.StructField("event_month", T.StringType())]
)
_LARGE = T.StructType([KEYED[KEY], KEYED["event_month"]])


@dataclass(frozen=True)
class BucketedStore:
    """The bucketed tables under one folder.

    ``name`` prefixes the table names in the session's catalog; the files and
    the number of buckets are all that lasts, so another session opens the
    same tables by the same arguments.
    """

    spark: SparkSession
    root: str
    n_buckets: int
    name: str = "cdrflow"

    # -- tables

    def _open(self, what: str, schema: T.StructType, partition: str | None = None) -> str:
        """Register a bucketed table over its folder, with the partitions that are there; its name."""
        table = f"{self.name}_{what}"
        if self.spark.catalog.tableExists(table):
            return table
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f"PARTITIONED BY ({partition})" if partition else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {parts} "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.n_buckets} BUCKETS LOCATION '{self.root}/{what}'"
        )
        if partition:
            # The folder must be there to be looked through; this writes no file of rows.
            none = self.spark.createDataFrame([], schema)
            none.write.mode("append").partitionBy(partition).parquet(f"{self.root}/{what}")
            self.spark.catalog.recoverPartitions(table)
        return table

    def _replace(self, df: DataFrame, what: str, schema: T.StructType, partition: str | None = None) -> None:
        """Replace the table, or only the partitions that ``df`` has rows for."""
        table = self._open(what, schema, partition)
        mode = "dynamic" if partition else "static"
        before = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        try:
            conform(df, schema).write.insertInto(table, overwrite=True)
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
        self.spark.catalog.refreshTable(table)

    def _plain(self, what: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{what}")

    # -- storing

    def store_subscriptions(self, subscriptions: DataFrame) -> None:
        self._replace(subscriptions.repartition(self.n_buckets, KEY), "subscriptions", schemas.SUBSCRIPTIONS)

    def store_records(self, mediated: DataFrame) -> None:
        """Store mediated records by subscriber; months in ``mediated`` replace
        the stored ones, and which subscribers are kept apart is decided anew
        for each month."""
        keyed = rating.keyed_records(mediated).filter(F.col(KEY).isNotNull()).withColumn("event_month", event_month())
        counts = keyed.groupBy("event_month", KEY).agg(F.count(F.lit(1)).alias("n"))
        limit = counts.groupBy("event_month").agg((F.sum("n") / self.n_buckets).alias("share"))
        large = counts.join(limit, "event_month").filter(F.col("n") > F.col("share")).select("event_month", KEY)
        months = [r[0] for r in limit.select("event_month").collect()]
        # Fewer than n_buckets rows a month: each has more than 1 / n_buckets of the month's records.
        write_partitioned(conform(large, _LARGE), f"{self.root}/large", ["event_month"], replace=months)
        kept = self._large().filter(F.col("event_month").isin(months))
        rest = keyed.join(F.broadcast(kept), ["event_month", KEY], "left_anti")
        self._replace(rest.repartition(self.n_buckets, KEY), "records", KEYED, "event_month")
        apart = keyed.join(F.broadcast(kept), ["event_month", KEY], "left_semi")
        write_partitioned(conform(apart, KEYED), f"{self.root}/records_apart", ["event_month"], replace=months)

    def _large(self) -> DataFrame:
        return self._plain("large", _LARGE)

    # -- reading

    def subscriptions(self) -> DataFrame:
        return self.spark.table(self._open("subscriptions", schemas.SUBSCRIPTIONS))

    def records(self) -> DataFrame:
        return self.spark.table(self._open("records", KEYED, "event_month"))

    def rated(self) -> DataFrame:
        return self.spark.table(self._open("rated", schemas.RATED, "billing_period"))

    def rated_apart(self) -> DataFrame:
        return self._plain("rated_apart", schemas.RATED)

    # -- stages

    def rate(
        self, catalog: DataFrame, plans: DataFrame, params: Params = Params(), months: list[str] | None = None,
        dims_trusted_small: bool = False,
    ) -> None:
        """Rate the stored months (or some of them) into the rated tables.

        J1 reads equal buckets of both sides, and the result is written in the
        same buckets: no record is shuffled.
        """
        if not months:  # a month may have no bucketed records at all, or none apart
            stored = self.records().select("event_month").unionByName(self._large().select("event_month"))
            months = [r[0] for r in stored.distinct().collect()]
        where = F.col("event_month").isin(months)
        self._replace(
            self.rated_of(self.records().filter(where), catalog, plans, params, dims_trusted_small),
            "rated", schemas.RATED, "billing_period",
        )
        few = rating.eligible(self.subscriptions()).join(
            F.broadcast(self._large().filter(where).select(KEY).distinct()), KEY, "left_semi"
        )
        apart = self._plain("records_apart", KEYED).filter(where)
        joined = apart.join(F.broadcast(few), KEY)  # at most a row for each subscriber kept apart
        rated = rating.rate_joined(joined, catalog, plans, params, dims_trusted_small)
        write_partitioned(conform(rated, schemas.RATED), f"{self.root}/rated_apart", ["billing_period"], replace=months)

    def rated_of(self, records: DataFrame, catalog, plans, params: Params = Params(), dims_trusted_small=False) -> DataFrame:
        joined = rating.join_plan(records, self.subscriptions())
        return rating.rate_joined(joined, catalog, plans, params, dims_trusted_small)

    def subtotals(self, months: list[str], params: Params = Params()) -> DataFrame:
        """A1 of the bucketed records: the buckets are whole, so the sums need no exchange."""
        return billing.invoice_subtotals(self.rated().filter(F.col("billing_period").isin(months)), params.money)

    def invoices(self, months: list[str], params: Params = Params()) -> DataFrame:
        """Invoices of all eligible subscribers for ``months``.

        A subscriber's months are put into one row, so the bucketed tables
        join on the subscriber alone.  The sums of those kept apart are
        combined before a shuffle of at most n_buckets rows a month and
        broadcast.
        """
        months = list(dict.fromkeys(months))
        amounts = ["voice_total", "sms_total", "data_total", "amount_before_tax"]
        by_month = F.map_from_entries(F.collect_list(F.struct("billing_period", F.struct(*amounts))))
        sums = self.subtotals(months, params).groupBy(KEY).agg(by_month.alias("_sums"))
        apart = billing.invoice_subtotals(self.rated_apart().filter(F.col("billing_period").isin(months)), params.money)
        apart = apart.select(KEY, "billing_period", F.struct(*amounts).alias("_apart"))
        subs = rating.eligible(self.subscriptions(), (KEY, "region", "rate_plan_id"))
        rows = subs.join(sums, KEY, "left").withColumn("billing_period", F.explode(F.array(*map(F.lit, months))))
        rows = rows.join(F.broadcast(apart), [KEY, "billing_period"], "left")
        both = F.coalesce(F.element_at("_sums", F.col("billing_period")), F.col("_apart"))
        rows = rows.withColumn("_both", both).select(
            KEY, "billing_period", "region", "rate_plan_id", *(F.col(f"_both.{a}").alias(a) for a in amounts)
        )
        return billing.zero_fill(billing.price_invoice(rows, params), params).select(*billing.INVOICE_COLUMNS)
