"""Replay-safe de-duplication of records by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_records(df: DataFrame, key: str = "record_ID", order_by: str = "batch_id") -> DataFrame:
    """One row per ``key``: the one with the smallest ``order_by`` (earliest
    delivery), ties broken by the whole row.

    A record without a key is identified by all its other values: only an
    exact re-delivery of it is dropped, and the rows without a key are spread
    by their content instead of forming one group.

    A ``min`` over a struct is an ordinary aggregate with a map-side partial
    step: a key that is replayed millions of times is reduced inside each map
    task before the shuffle, and no group is ever collected in one place.
    """
    others = [c for c in df.columns if c not in (key, order_by)]
    return (
        df.groupBy(key, F.when(F.col(key).isNull(), F.struct(*others)).alias("_content"))
        .agg(F.min(F.struct(F.col(order_by), *[F.col(c) for c in others])).alias("_r"))
        .select(key, *[F.col(f"_r.{c}").alias(c) for c in [order_by, *others]])
        .select(*df.columns)
    )


def absent_from(df: DataFrame, stored: DataFrame, key: str, content: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``stored``; rows without a key are
    looked up by their ``content`` columns.

    One anti join on a combined key: the key where there is one, else the
    content, so neither rows without a key nor a key that was delivered
    millions of times (stored once) meet in one group.
    """
    def identity(side: DataFrame) -> DataFrame:
        whole = F.to_json(F.struct(*content), {"ignoreNullFields": "false"})
        return side.withColumn("_identity", F.when(F.col(key).isNotNull(), F.concat(F.lit("k"), F.col(key))).otherwise(whole))

    return identity(df).join(identity(stored).select("_identity"), "_identity", "left_anti").drop("_identity")


def first_deliveries(mediated: DataFrame) -> DataFrame:
    """Stored mediated records, each once: the delivery with the smallest
    (batch_id, stream_id) stays.  A frame without batch numbers is one batch."""
    if "batch_id" not in mediated.columns:
        mediated = mediated.withColumn("batch_id", F.lit(0).cast("long"))
    return dedup_records(mediated, "record_ID", "batch_id")
