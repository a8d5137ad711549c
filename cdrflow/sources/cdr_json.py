"""Stream message codec: JSON call-detail records in, typed columns out."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrflow import schemas

# JSON timestamps as written by a Python producer (``datetime.isoformat()``):
# microseconds, no zone.
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_OPTIONS = {"timestampFormat": JSON_TIMESTAMP_FORMAT, "timestampNTZFormat": JSON_TIMESTAMP_FORMAT}
KEY_SPACE = 1000


_NUMBER = r"^\s*-?\d+(\.\d+)?([eE][+-]?\d+)?\s*$"
_ZONED = r"(?i)\d(Z|[+-]\d{2}(:?\d{2})?)\s*$"
_WITH_TIME = r"\d[T ]\d"


def event_time(text: Column) -> Column:
    """UTC wall-clock time of a message's event time.

    Accepts ISO times with a zone (``Z``, ``+01:00``; converted to UTC), without
    one (taken as they are) and epoch seconds, whole or fractional.  Anything
    else is NULL and dropped by admission.  The result does not depend on the
    session's time zone.
    """
    zoned = text.rlike(_WITH_TIME) & text.rlike(_ZONED)
    micros = F.unix_micros(text.try_cast("timestamp")).cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    seconds = F.when(text.rlike(_NUMBER), F.trim(text).try_cast("decimal(18,6)")).when(zoned, micros.cast("decimal(18,6)"))
    zero = F.lit(0)
    since = F.lit("1970-01-01 00:00:00").cast(schemas.EVENT_TIME) + F.make_dt_interval(zero, zero, zero, seconds)
    return F.when(text.rlike(_NUMBER) | zoned, since).otherwise(text.try_cast(schemas.EVENT_TIME))


def decode_cdr(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse the message value with the fixed CDR schema and flatten it.

    Malformed JSON yields a row of NULLs (dropped later by admission); a
    field of the wrong type (a quoted number, 5.5 for an int) is NULL.  Event
    times come with or without a zone or as epoch seconds (``event_time``).
    ``keep`` names message columns to carry along.
    """
    text = F.col(value_col).cast("string")
    data = df.select(*keep, F.from_json(text, schemas.WIRE_CDR, JSON_OPTIONS).alias("data")).select(*keep, "data.*")
    return data.withColumn("timestamp", event_time(F.col("timestamp")))


def encode_cdr(df: DataFrame) -> DataFrame:
    """Message key and JSON value for each record (the producer's encoding).

    The key is derived from ``record_ID`` (1..1000) so that a re-sent record
    lands in the same topic partition; NULL fields are left out of the JSON.
    """
    cols = [c for c in schemas.RAW_CDR.fieldNames() if c in df.columns]
    return df.select(
        message_key(F.col("record_ID")).alias("key"),
        F.to_json(F.struct(*cols), JSON_OPTIONS).alias("value"),
    )


def message_key(record_id):
    """1 + (first 32 bits of md5(record_ID)) mod 1000, as a string."""
    h = F.conv(F.substring(F.md5(record_id.cast("string")), 1, 8), 16, 10).cast("bigint")
    return (F.pmod(h, F.lit(KEY_SPACE)) + F.lit(1)).cast("string")


def read_cdr_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Streaming source of raw messages with a ``value`` column.

    ``fmt="kafka"`` subscribes to a topic; it needs the Kafka connector on the
    classpath.  The defaults are those of the reference: a new checkpoint
    starts at the latest offset and expired offsets do not stop the stream,
    both of which skip messages silently.  Pass ``startingOffsets=earliest``
    and ``failOnDataLoss=true`` to read a backlog or to be told of a loss.  ``fmt="text"`` reads JSON lines from a directory, one message
    per line, for tests and file drops.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("subscribe", "telecom")
        opts.setdefault("startingOffsets", "latest")
        opts.setdefault("failOnDataLoss", "false")
        try:
            return spark.readStream.format("kafka").options(**opts).load()
        except Exception as e:  # the connector jar is not on the classpath
            if "kafka" in str(e).lower() and "data source" in str(e).lower():
                raise RuntimeError(
                    "the Kafka source needs the spark-sql-kafka connector matching this Spark "
                    "(spark.jars.packages=org.apache.spark:spark-sql-kafka-0-10_<scala>:<spark version>)"
                ) from e
            raise
    if fmt == "text":
        reader = spark.readStream.format("text").options(**opts)
        return reader.load(path)
    raise ValueError(f"unsupported stream format {fmt!r}")


def write_cdr_messages(df: DataFrame, fmt: str = "kafka", options: dict[str, str] | None = None, path: str | None = None) -> None:
    """Publish encoded CDRs: to a Kafka topic, or as JSON lines to ``path``."""
    msgs = encode_cdr(df)
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("topic", "telecom")
        msgs.write.format("kafka").options(**opts).save()
    elif fmt == "text":
        msgs.select("value").write.mode("append").text(path)
    else:
        raise ValueError(f"unsupported sink format {fmt!r}")
