"""Stage hand-over tables: Parquet in/out, CSV reports, JDBC invoices."""

from __future__ import annotations

import logging
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow import schemas

log = logging.getLogger(__name__)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema``, in its order, cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_mediated(spark: SparkSession, path: str) -> DataFrame:
    """Mediated CDRs, partitioned ``event_month=/record_type=/stream_id=/batch_id=``."""
    return spark.read.schema(schemas.MEDIATED_STORED).parquet(path)


def read_rated(spark: SparkSession, path: str, money: str = "decimal") -> DataFrame:
    """Rated CDRs, partitioned ``billing_period=yyyy-MM`` (read as string)."""
    return spark.read.schema(schemas.storage_schema(schemas.RATED, money)).parquet(path)


def read_invoices(spark: SparkSession, path: str, money: str = "decimal") -> DataFrame:
    return spark.read.schema(schemas.storage_schema(schemas.INVOICE, money)).parquet(path)


def write_partitioned(
    df: DataFrame, path: str, partition_by: list[str], mode: str = "overwrite", replace: list[str] | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Write Parquet partitioned by ``partition_by``.

    ``overwrite`` replaces only the partitions present in ``df`` (dynamic
    partition overwrite), so re-running one month or one micro-batch never
    erases the others; ``append`` adds files.  ``replace`` lists values of the
    (single) partition column that this run stands for: one of them that got no
    rows is emptied, so it does not keep what an earlier run left there.
    """
    out = df
    if replace:
        seen = Observation()
        col = F.col(partition_by[0])
        out = df.observe(seen, *(F.count(F.when(col == v, 1)).alias(f"n{k}") for k, v in enumerate(replace)))
    (
        out.write.mode(mode)
        .options(**(options or {}))
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    if replace:
        counts = seen.get
        for k, v in enumerate(replace):
            if not counts[f"n{k}"]:
                _empty_partition(df, path, partition_by[0], v)


def _empty_partition(df: DataFrame, path: str, column: str, value: str) -> None:
    """Replace one partition folder by an empty file (static overwrite)."""
    none = df.drop(column).sparkSession.createDataFrame([], df.drop(column).schema)
    none.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path.rstrip('/')}/{column}={value}")


def event_month(time: str = "timestamp") -> Column:
    """``yyyy-MM`` of an event time, as the stored tables' folders have it."""
    return F.date_format(time, "yyyy-MM")


#: ``stream_id`` of batches that no stream wrote.
BATCH_STREAM = "batch"


def write_mediated(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    for name, value in (("event_month", event_month()), ("stream_id", F.lit(BATCH_STREAM))):
        if name not in df.columns:
            df = df.withColumn(name, value)
    write_partitioned(conform(df, schemas.MEDIATED_STORED), path, schemas.MEDIATED_PARTITIONS, mode)


def ensure_mediated(spark: SparkSession, path: str) -> None:
    """Make the table's folder, so that it can be read before its first batch."""
    write_mediated(spark.createDataFrame([], schemas.MEDIATED_STORED), path, mode="append")


def replace_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch of ``BATCH_STREAM`` so that exactly its rows are stored under
    its number, also where an earlier run of it had rows that are gone."""
    spark = df.sparkSession
    write_mediated(df.withColumn("batch_id", F.lit(batch_id).cast("long")), path)
    own = (F.col("stream_id") == BATCH_STREAM) & (F.col("batch_id") == batch_id)
    # Folder names only: (month, type) of one batch.
    stored = read_mediated(spark, path).filter(own).select("event_month", "record_type").distinct().collect()
    made = {tuple(r) for r in df.select(event_month(), "record_type").distinct().collect()}
    empty = spark.createDataFrame([], T.StructType([f for f in schemas.MEDIATED.fields if f.name != "record_type"]))
    for r in stored:
        if tuple(r) not in made:
            folder = f"event_month={r['event_month']}/record_type={r['record_type']}/stream_id={BATCH_STREAM}/batch_id={batch_id}"
            empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path.rstrip('/')}/{folder}")


def _sized(df: DataFrame, rebalance: bool, col: str) -> DataFrame:
    """With ``rebalance`` the rows are shuffled once so that AQE cuts each
    month into partitions of the advisory size: a few large files per month
    instead of one small file per task and month (costs a shuffle)."""
    return df.hint("rebalance", col) if rebalance else df


def stored_months(spark: SparkSession, path: str) -> list[str]:
    """Billing months that a stage table has folders for."""
    try:
        rows = spark.read.parquet(path).select(F.col("billing_period").cast("string")).distinct().collect()
    except AnalysisException:  # not there yet
        return []
    return sorted(r[0] for r in rows if r[0] is not None)


def write_rated(
    df: DataFrame, path: str, money: str = "decimal", rebalance: bool = False, months: list[str] | None = None
) -> None:
    """Replace the months in ``df``; ``months`` are those that it stands for (default:
    every stored month), which are emptied where it has no rows for them."""
    out = conform(df, schemas.storage_schema(schemas.RATED, money))
    months = stored_months(df.sparkSession, path) if months is None else months
    write_partitioned(_sized(out, rebalance, "billing_period"), path, ["billing_period"], replace=months)


def write_invoices(
    df: DataFrame, path: str, money: str = "decimal", rebalance: bool = False, months: list[str] | None = None
) -> None:
    """Replace the months in ``df``, and empty those of ``months`` that it has no rows for."""
    out = conform(df, schemas.storage_schema(schemas.INVOICE, money))
    write_partitioned(_sized(out, rebalance, "billing_period"), path, ["billing_period"], replace=months)


# Reports whose rows are bounded by configuration (plans, products); regions are
# free text of the subscription table.
BOUNDED_REPORTS = ("revenueByPlan", "product_cost_analysis")


def write_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header, replacing the previous report.

    A globally sorted report is written by range: part files in name order
    hold consecutive ranges, so the order survives without funnelling the
    rows through one task.  ``single_file`` (one task, one file) is for the
    reports whose size is bounded by configuration (``BOUNDED_REPORTS``),
    never for one that grows with the subscriber base.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def stage_table(df: DataFrame, name: str, partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    return a scan of it.

    This cuts the lineage (a lost executor recomputes from the table, not
    from the whole upstream plan) and, with ``partitions``/``key``, lays the
    rows out in that many files so later scans split evenly.
    """
    from cdrflow.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, name)
    out = df
    if partitions:
        out = df.repartition(partitions, key) if key else df.repartition(partitions)
    out.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a row group in clustered files: few enough that statistics tell them apart.
GROUP_ROWS = 20_000


def compact_partitions(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: list[str],
    where=None,
    files_per_partition: int = 1,
    spread_col: str | None = None,
    sort_by: str | None = None,
    options: dict[str, str] | None = None,
    cluster_by: list[str] | None = None,
) -> None:
    """Rewrite the partitions of ``path`` selected by ``where`` into
    ``files_per_partition`` files each (small files from frequent stream
    appends).

    The selected rows are first staged beside the table, on the same file
    system, and the copy is counted against the source before anything is
    replaced; then they are spread over ``files_per_partition`` tasks per
    partition by a hash of ``spread_col`` (so a huge partition is not written
    by one task), sorted by ``sort_by`` if given, and written back with a dynamic
    overwrite that replaces only those partitions.  The copy's path is logged and
    the copy stays: should the write back be cut off, restore the partitions from
    it before a new run.

    With ``cluster_by`` each partition's files hold consecutive ranges of these
    columns, sorted, in row groups of ``GROUP_ROWS``: a filter on the first one
    (a subscriber) then skips most of them by their statistics.  Name a unique
    column last, so that a value with many rows is split between files.
    """
    df = spark.read.schema(schema).parquet(path)
    if where is not None:
        df = df.filter(where)
    copy = f"{path.rstrip('/')}-compact-{uuid.uuid4().hex[:12]}"
    df.write.parquet(copy)
    log.info("compaction of %s: rows staged in %s", path, copy)
    staged = spark.read.schema(schema).parquet(copy)
    rows, copied = df.count(), staged.count()
    if rows != copied:
        raise RuntimeError(f"{copy} holds {copied} of {rows} rows; {path} was not changed")
    if cluster_by:
        n = staged.select(*partition_by).distinct().count() * files_per_partition
        order = [*partition_by, *cluster_by]
        dealt = staged.repartitionByRange(max(1, n), *order).sortWithinPartitions(*order)
        groups = {"parquet.block.row.count.limit": str(GROUP_ROWS)}
        write_partitioned(dealt, path, partition_by, options={**groups, **(options or {})})
        return
    keys = [F.col(c) for c in partition_by]
    if spread_col:
        keys.append(F.pmod(F.xxhash64(F.col(spread_col)), F.lit(files_per_partition)))
    dealt = staged.repartition(*keys)
    if sort_by:
        dealt = dealt.sortWithinPartitions(*partition_by, sort_by)
    write_partitioned(dealt, path, partition_by, options=options)


def write_jdbc(df: DataFrame, table: str, options: dict[str, str], mode: str = "overwrite") -> None:
    """Replace a database table; ``truncate`` keeps its definition and grants.

    At most ``numPartitions`` connections write at a time (default 8).
    """
    opts = {"dbtable": table, "truncate": "true", "numPartitions": "8", "batchsize": "10000", **options}
    df.write.format("jdbc").options(**opts).mode(mode).save()


def read_jdbc(spark: SparkSession, table: str, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(dbtable=table, **options).load()
