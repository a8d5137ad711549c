"""Index of the record ids that a mediated store holds.

A table of its own beside the store: one folder per hash bucket of the id,
rows sorted by id in files with Parquet Bloom filters.  A batch looks its ids
up in the buckets that they fall into, so what it reads grows with the batch
and the size of a bucket, not with the store.

A row is a claim: this id was stored by that batch of that stream.  Claims are
written before the records.  A replayed batch does not see its own claims and
those of later batches of its stream, so it decides as it did before, and
claims that it writes again change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.sources.files import compact_partitions, read_mediated

#: Buckets of a new index.  A bucket of a store of 10^11 records and 4,096 of
#: them holds 25 million ids; a batch of few records reads few of them.
BUCKETS = 64
#: Batches of at most so many ids ask for each of them by value, which the Bloom
#: filters and statistics of the files answer.  Larger ones join.  This changes
#: what is read, not what is found.
POINT_IDS = 100

SCHEMA = T.StructType(
    [
        T.StructField("record_ID", T.StringType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("n_buckets", T.IntegerType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)


def index_path(store: str) -> str:
    """Where the index of a store lies: beside it, not in it."""
    return f"{store.rstrip('/')}-ids"


def bucket_of(n_buckets: int, key: str = "record_ID") -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("int")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def _write(claims: DataFrame, path: str, n_buckets: int) -> None:
    """Append (record_ID, stream_id, batch_id): one file a bucket, sorted."""
    out = claims.withColumns({"n_buckets": F.lit(n_buckets), "bucket": bucket_of(n_buckets)})
    # A fixed number of tasks, which the files of a small batch would else not get.
    tasks = min(n_buckets, int(claims.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    (
        out.repartition(tasks, "bucket").sortWithinPartitions("bucket", "record_ID")
        .select(*SCHEMA.names).write.mode("append").partitionBy("bucket")
        .option("parquet.bloom.filter.enabled#record_ID", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )


def ensure_index(spark: SparkSession, store: str, n_buckets: int = BUCKETS) -> int:
    """The number of buckets of the store's index, which is built from the store
    if there is none yet (a store of before, or a lost index)."""
    path = index_path(store)
    # The folder must be there to be read; this writes no rows.
    spark.createDataFrame([], SCHEMA).write.mode("append").partitionBy("bucket").parquet(path)
    known = read_index(spark, path).select("n_buckets").first()
    if known:
        return known[0]
    claims = read_mediated(spark, store).filter(F.col("record_ID").isNotNull())
    _write(claims.select("record_ID", "stream_id", "batch_id"), path, n_buckets)
    return n_buckets


def known_ids(
    ids: DataFrame, store: str, stream: str, epoch_id: int, n_buckets: int,
    buckets: list[int] | None = None, n_ids: int | None = None,
) -> DataFrame:
    """(record_ID) of those ``ids`` (not null) that an earlier batch has claimed.

    Only the buckets of ``ids`` are read.  Claims of this and later epochs of
    the stream are left aside.  A caller that has counted already gives the
    buckets and the number of rows.
    """
    spark = ids.sparkSession
    if buckets is None or n_ids is None:
        # At most a number for each bucket comes to the driver.
        buckets, n_ids = ids.agg(F.collect_set(bucket_of(n_buckets)), F.count(F.lit(1))).first()
    own = (F.col("stream_id") == stream) & (F.col("batch_id") >= epoch_id)
    claims = read_index(spark, index_path(store)).filter(F.col("bucket").isin(buckets) & ~own)
    if 0 < n_ids <= POINT_IDS:
        wanted = F.lit(False)
        for v in {r[0] for r in ids.select("record_ID").collect()}:
            wanted = wanted | (F.col("record_ID") == v)
        return claims.filter(wanted).select("record_ID").distinct()
    return claims.join(ids.select("record_ID"), "record_ID", "left_semi").select("record_ID").distinct()


def claim(ids: DataFrame, store: str, stream: str, epoch_id: int, n_buckets: int) -> None:
    """Record that this batch stores ``ids``."""
    claims = ids.select("record_ID", F.lit(stream).alias("stream_id"), F.lit(epoch_id).cast("long").alias("batch_id"))
    _write(claims, index_path(store), n_buckets)


def compact_index(spark: SparkSession, store: str, buckets: list[int] | None = None) -> None:
    """Rewrite buckets into one sorted file each (while no batch is running)."""
    where = F.col("bucket").isin(buckets) if buckets else None
    compact_partitions(
        spark, index_path(store), SCHEMA, ["bucket"], where, sort_by="record_ID",
        options={"parquet.bloom.filter.enabled#record_ID": "true", "parquet.bloom.filter.adaptive.enabled": "true"},
    )
