"""Typed schemas of every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(22, 9)      # one rated charge (units x price, unrounded), a subtotal
PRICE = T.DecimalType(6, 3)       # tariff unit price (NUMERIC(6,3) in the DDL)
UNITS = T.DecimalType(18, 6)      # billable units: seconds, messages, MB
VOLUME = T.DecimalType(18, 6)     # data volume in MB, up to six decimals on the wire

# Event times are UTC wall-clock times: TIMESTAMP_NTZ, so no session or process
# time zone can shift them.  The decoder converts zoned and epoch times to UTC
# and takes a time without a zone as it is.
EVENT_TIME = T.TimestampNTZType()

# Wire format of one call-detail record (JSON value of a stream message).
# One wide schema for the three record types; unused columns are absent.
RAW_CDR = T.StructType(
    [
        T.StructField("record_ID", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("timestamp", EVENT_TIME),
        T.StructField("cell_id", T.StringType()),
        T.StructField("technology", T.StringType()),
        T.StructField("caller_id", T.StringType()),
        T.StructField("callee_id", T.StringType()),
        T.StructField("duration_sec", T.IntegerType()),
        T.StructField("sender_id", T.StringType()),
        T.StructField("receiver_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("data_volume_mb", T.DoubleType()),
        T.StructField("session_duration_sec", T.IntegerType()),
        T.StructField("product_code", T.StringType()),
    ]
)

# As it stands in the JSON: the event time is text or a number.
WIRE_CDR = T.StructType(
    [T.StructField(f.name, T.StringType()) if f.name == "timestamp" else f for f in RAW_CDR.fields]
)

# Output of mediation.  Numeric columns stay numeric: a missing volume or a
# bad session length is NULL (the string export adds the "UNK" sentinel).
MEDIATED = T.StructType(
    [
        T.StructField("record_ID", T.StringType()),
        T.StructField("timestamp", EVENT_TIME),
        T.StructField("cell_id", T.StringType()),
        T.StructField("technology", T.StringType()),
        T.StructField("caller_id", T.StringType()),
        T.StructField("callee_id", T.StringType()),
        T.StructField("duration_sec", T.IntegerType()),
        T.StructField("product_code", T.StringType()),
        T.StructField("rating_status", T.StringType()),
        T.StructField("sender_id", T.StringType()),
        T.StructField("receiver_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_duration_sec", T.IntegerType()),
        T.StructField("data_volume_mb", VOLUME),
        T.StructField("record_type", T.StringType()),
    ]
)
MEDIATED_COLUMNS = [f.name for f in MEDIATED.fields]

# Mediated data as stored: partitioned by event month (months prune by folder),
# record type, the stream that wrote it and its micro-batch.
MEDIATED_PARTITIONS = ["event_month", "record_type", "stream_id", "batch_id"]
MEDIATED_STORED = T.StructType(
    [f for f in MEDIATED.fields if f.name != "record_type"]
    + [
        T.StructField("event_month", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

PRODUCT_CATALOG = T.StructType(
    [
        T.StructField("product_code", T.StringType(), False),
        T.StructField("service_type", T.StringType(), False),
        T.StructField("unit", T.StringType(), False),
        T.StructField("rate_type", T.StringType(), False),
        T.StructField("description", T.StringType()),
    ]
)

RATE_PLANS = T.StructType(
    [
        T.StructField("rate_plan_id", T.StringType(), False),
        T.StructField("product_code", T.StringType(), False),
        T.StructField("service_type", T.StringType(), False),
        T.StructField("unit_price", PRICE, False),
        T.StructField("free_units", T.IntegerType()),
        T.StructField("tier_threshold", T.IntegerType()),
        T.StructField("tier_price", PRICE),
    ]
)

SUBSCRIPTIONS = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("customer_name", T.StringType(), False),
        T.StructField("activation_date", T.DateType(), False),
        T.StructField("subscription_type", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("region", T.StringType()),
        T.StructField("rate_plan_id", T.StringType()),
    ]
)

RATED = T.StructType(
    [
        T.StructField("record_ID", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("timestamp", EVENT_TIME),
        T.StructField("customer_id", T.StringType()),
        T.StructField("rate_plan_id", T.StringType()),
        T.StructField("product_code", T.StringType()),
        T.StructField("rate_type", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("unit_price", PRICE),
        T.StructField("free_units", T.IntegerType()),
        T.StructField("tier_threshold", T.IntegerType()),
        T.StructField("tier_price", PRICE),
        T.StructField("billable_units", UNITS),
        T.StructField("cost", MONEY),
        T.StructField("rating_status", T.StringType()),
        T.StructField("review_flag", T.BooleanType()),
        T.StructField("billing_period", T.StringType()),
    ]
)

INVOICE = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("rate_plan_id", T.StringType()),
        T.StructField("voice_total", MONEY),
        T.StructField("sms_total", MONEY),
        T.StructField("data_total", MONEY),
        T.StructField("amount_before_tax", MONEY),
        # Wide enough for rates with up to 6 decimals (Params checks this), so
        # storing an invoice never rounds it.
        T.StructField("discount_pct", T.DecimalType(9, 6)),
        T.StructField("after_discount", T.DecimalType(38, 15)),
        T.StructField("tax", T.DecimalType(38, 21)),
        T.StructField("amount_due", T.DecimalType(20, 2)),
        T.StructField("billing_period", T.StringType()),
    ]
)

# Money columns stored as double when a run uses ``money="double"``.
MONEY_COLUMNS = {
    "cost", "voice_total", "sms_total", "data_total", "amount_before_tax",
    "discount_pct", "after_discount", "tax", "amount_due",
}


def storage_schema(schema: T.StructType, money: str = "decimal") -> T.StructType:
    """The stored form of a stage table for a money mode."""
    if money != "double":
        return schema
    return T.StructType(
        [T.StructField(f.name, T.DoubleType(), f.nullable) if f.name in MONEY_COLUMNS else f for f in schema.fields]
    )
