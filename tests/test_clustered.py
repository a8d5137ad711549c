"""Stage files clustered by subscriber: reading one subscriber skips the rest."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cdrflow import schemas
from cdrflow.sources import files


def _rated(spark, n):
    hot = F.pmod(F.xxhash64("id"), F.lit(3)) == 0  # one subscriber has a third of all records
    number = F.when(hot, F.lit(7)).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2000)))
    rows = spark.range(n).select(
        F.format_string("r%08d", "id").alias("record_ID"),
        F.format_string("2126%08d", number).alias("customer_id"),
        F.when(F.col("id") % 2 == 0, "2024-01").otherwise("2024-02").alias("billing_period"),
        F.lit(1).alias("cost"), F.lit("rated").alias("rating_status"), F.lit("sms").alias("record_type"),
    )
    return rows.select(
        *[F.col(f.name) if f.name in rows.columns else F.lit(None).alias(f.name) for f in schemas.RATED.fields]
    )


def _scanned(df) -> int:
    """Rows that the scan handed on, of the row groups that it opened."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().get("numOutputRows").get().value()


def test_one_subscriber_skips_most_row_groups(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(files, "GROUP_ROWS", 1000)
    path = f"{tmp_dir}/rated"
    files.write_rated(_rated(spark, 60_000), path)
    one = lambda: files.read_rated(spark, path).filter("customer_id = '212600001500' and billing_period = '2024-01'").select("cost")
    want, before = one().count(), _scanned(one())
    files.compact_partitions(
        spark, path, schemas.RATED, ["billing_period"], files_per_partition=4, cluster_by=["customer_id", "record_ID"]
    )
    spark.catalog.refreshByPath(path)
    assert files.read_rated(spark, path).count() == 60_000
    assert one().count() == want > 0
    assert before > 10_000 and _scanned(one()) <= 2000
    sizes = [pq.ParquetFile(p).metadata for p in glob.glob(f"{path}/billing_period=2024-01/*.parquet")]
    assert all(m.row_group(k).num_rows <= 1000 for m in sizes for k in range(m.num_row_groups))
    # The hot subscriber's third is in several files.
    assert max(m.num_rows for m in sizes) < 15_000 and len(sizes) >= 3
