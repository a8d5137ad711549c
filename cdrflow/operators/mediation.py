"""Mediation: admit, validate and clean raw call-detail records.

The reference splits each micro-batch into three filtered copies (voice,
sms, data), cleans each and unions them back.  Here the same result comes
from ONE pass: a single admission predicate ``(voice & ..) | (sms & ..) |
(data & ..)`` and one ``when`` per output column.  The input is read once,
there is no shuffle and the whole stage is one whole-stage-codegen span.
``clean_voice``/``clean_sms``/``clean_data`` stay available per type and are
built from the very same expressions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdrflow import schemas
from cdrflow.functions.cleaning import UNKNOWN, normalize_technology, voice_product
from cdrflow.functions.msisdn import is_valid_msisdn
from cdrflow.functions.reuse import per_jvm

RECORD_TYPES = ("voice", "sms", "data")

# Columns each record type carries (the others are dropped by the split).
TYPE_COLUMNS = {
    "voice": ["caller_id", "callee_id", "duration_sec", "product_code"],
    "sms": ["sender_id", "receiver_id", "product_code"],
    "data": ["user_id", "data_volume_mb", "session_duration_sec", "product_code"],
}
COMMON_COLUMNS = ["record_ID", "record_type", "timestamp", "cell_id", "technology"]
PAYER = {"voice": "caller_id", "sms": "sender_id", "data": "user_id"}
OTHER_PARTY = {"voice": "callee_id", "sms": "receiver_id"}


# --- admission ---------------------------------------------------------------

def require_fields(df: DataFrame) -> DataFrame:
    """Keep records that have a record type and an event time."""
    return df.filter(F.col("record_type").isNotNull() & F.col("timestamp").isNotNull())


def fresh(df: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Keep records dated ``as_of`` or later (today when None); future dates pass.

    A plain filter, not a watermark: the reference drops late data by date.
    """
    cutoff = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return df.filter(F.to_date(F.col("timestamp")) >= cutoff)


def admit(df: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Required fields present and fresh (``require_fields`` then ``fresh``)."""
    return df.filter(admission_condition(as_of))


def admission_condition(as_of: dt.date | str | None = None) -> Column:
    """The admission predicate of ``admit`` as one column (for metrics)."""
    cutoff = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return (
        F.col("record_type").isNotNull()
        & F.col("timestamp").isNotNull()
        & (F.to_date(F.col("timestamp")) >= cutoff)
    )


# --- split ---------------------------------------------------------------------

def split_by_type(df: DataFrame, record_type: str) -> DataFrame:
    """Records of one type with the other types' columns dropped."""
    keep = COMMON_COLUMNS + TYPE_COLUMNS[record_type]
    return df.filter(F.col("record_type") == record_type).select(
        *[c for c in df.columns if c in keep]
    )


def split_all(df: DataFrame) -> DataFrame:
    """The three splits side by side in one pass: off-type columns become NULL,
    records of any other type vanish."""
    rt = F.col("record_type")
    cols = []
    for c in df.columns:
        owners = [t for t, tc in TYPE_COLUMNS.items() if c in tc]
        if c in COMMON_COLUMNS or not owners:
            cols.append(F.col(c))
        else:
            cols.append(F.when(rt.isin(*owners), F.col(c)).alias(c))
    return df.filter(rt.isin(*RECORD_TYPES)).select(*cols)


# --- shared column expressions -----------------------------------------------

def _by_type(columns: dict[str, str]) -> Column:
    """The column that holds a role (payer, other party) for the row's type."""
    out = None
    for t, c in columns.items():
        out = (F.when if out is None else out.when)(F.col("record_type") == t, F.col(c))
    return out


@per_jvm
def _keep(mode: str) -> Column:
    """Validity of a row of any type: paying party present and well formed,
    and for voice a positive duration (a missing duration drops the record).
    The paying party is chosen first, so its number is matched once."""
    payer = _by_type(PAYER)
    has_duration = (F.col("record_type") != "voice") | (F.col("duration_sec") > 0)
    return F.coalesce(is_valid_msisdn(payer, mode) & has_duration, F.lit(False))


@per_jvm
def _other(mode: str) -> Column:
    """Counterpart number of a voice or sms row; missing or malformed: UNK."""
    other = F.coalesce(_by_type(OTHER_PARTY), F.lit(UNKNOWN))
    return F.when(is_valid_msisdn(other, mode), other).otherwise(F.lit(UNKNOWN))


def _volume() -> Column:
    """The volume at full precision; one that does not fit is missing."""
    return F.col("data_volume_mb").try_cast(schemas.VOLUME)


def _needs_review() -> Column:
    s = F.col("session_duration_sec")
    return _volume().isNull() | s.isNull() | (s < 0)


@per_jvm
def _expressions() -> dict[str, Column]:
    """Output column -> expression, valid on admitted rows that passed
    ``_keep`` and carry the cleaned counterpart number as ``_other``."""
    rt = F.col("record_type")
    is_voice, is_sms, is_data = (rt == "voice"), (rt == "sms"), (rt == "data")
    callee = F.col("_other")
    session = F.col("session_duration_sec")
    return {
        "record_ID": F.col("record_ID"),
        "timestamp": F.col("timestamp"),
        "cell_id": F.coalesce(F.col("cell_id"), F.lit(UNKNOWN)),
        "technology": normalize_technology(F.col("technology")),
        "caller_id": F.when(is_voice, F.col("caller_id")),
        "callee_id": F.when(is_voice, callee),
        "duration_sec": F.when(is_voice, F.col("duration_sec").cast("int")),
        "product_code": F.when(is_voice, voice_product(callee))
        .when(is_sms, F.lit("SMS_STD"))
        .when(is_data, F.col("product_code")),
        "rating_status": F.when(is_data & _needs_review(), F.lit("needs_review")).otherwise(
            F.lit("ready")
        ),
        "sender_id": F.when(is_sms, F.col("sender_id")),
        "receiver_id": F.when(is_sms, F.col("_other")),
        "user_id": F.when(is_data, F.col("user_id")),
        "session_duration_sec": F.when(is_data & (session >= 0), session.cast("int")),
        "data_volume_mb": F.when(is_data, _volume()),
        "record_type": rt,
    }


def _with_missing(df: DataFrame) -> DataFrame:
    """Add wire columns a split frame dropped, as typed NULLs."""
    missing = [f for f in schemas.RAW_CDR.fields if f.name not in df.columns]
    if not missing:
        return df
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


# --- cleaning ------------------------------------------------------------------

@per_jvm
def _mediated_columns() -> list[Column]:
    exprs = _expressions()
    return [exprs[c].alias(c) for c in schemas.MEDIATED_COLUMNS]


def cleaned(flagged: DataFrame, mode: str = "compat") -> DataFrame:
    """Rows of ``with_keep`` that are valid, cleaned.  The counterpart number is
    cleaned in a projection of its own, because three columns use it."""
    return flagged.filter("_keep").withColumn("_other", _other(mode)).select(*_mediated_columns())


def with_keep(admitted: DataFrame, mode: str = "compat") -> DataFrame:
    """Admitted records with the flag ``_keep``: of a known type and valid."""
    return _with_missing(admitted).withColumn("_keep", _keep(mode))


def mediate(admitted: DataFrame, mode: str = "compat") -> DataFrame:
    """Validated, cleaned records of all three types (``schemas.MEDIATED``)."""
    return cleaned(with_keep(admitted, mode), mode)


def _clean_one(df: DataFrame, record_type: str, mode: str) -> DataFrame:
    exprs = _expressions()
    cols = [c for c in schemas.MEDIATED_COLUMNS if c in COMMON_COLUMNS or c in TYPE_COLUMNS[record_type]]
    cols += ["rating_status"]
    ordered = [c for c in schemas.MEDIATED_COLUMNS if c in cols]
    kept = with_keep(df, mode).filter((F.col("record_type") == record_type) & F.col("_keep"))
    return kept.withColumn("_other", _other(mode)).select(*[exprs[c].alias(c) for c in ordered])


def clean_voice(df: DataFrame, mode: str = "compat") -> DataFrame:
    return _clean_one(df, "voice", mode)


def clean_sms(df: DataFrame, mode: str = "compat") -> DataFrame:
    return _clean_one(df, "sms", mode)


def clean_data(df: DataFrame, mode: str = "compat") -> DataFrame:
    return _clean_one(df, "data", mode)


def union_cleaned(voice: DataFrame, sms: DataFrame, data: DataFrame) -> DataFrame:
    """Union by name of the three cleaned frames, missing columns NULL."""
    out = voice.unionByName(sms, allowMissingColumns=True).unionByName(data, allowMissingColumns=True)
    return out.select(*schemas.MEDIATED_COLUMNS)


def export_strings(mediated: DataFrame) -> DataFrame:
    """String export of data records: missing volume / bad session as "UNK".
    Volumes are written like the wire's numbers, without trailing zeros."""
    volume = F.regexp_replace(F.col("data_volume_mb").cast("string"), r"(\.\d+?)0+$", "$1")
    return mediated.select(
        *[c for c in mediated.columns if c not in ("data_volume_mb", "session_duration_sec")],
        F.coalesce(F.col("session_duration_sec").cast("string"), F.lit(UNKNOWN)).alias("session_duration_sec"),
        F.coalesce(volume, F.lit(UNKNOWN)).alias("data_volume_mb"),
    )


# --- audit -----------------------------------------------------------------------

def mediation_audit(admitted: DataFrame, mode: str = "compat") -> DataFrame:
    """Per record type: records admitted and records that survive cleaning.

    One aggregation over the admitted stream instead of separate counts before
    and after cleaning (each of which would re-read the source).
    """
    df = with_keep(admitted, mode)
    keep = F.col("_keep")
    return (
        df.groupBy("record_type")
        .agg(
            F.count(F.lit(1)).alias("admitted"),
            F.count(F.when(keep, F.lit(1))).alias("mediated"),
            F.count(F.when(keep & (F.col("record_type") == "data") & _needs_review(), F.lit(1))).alias(
                "needs_review"
            ),
        )
        .withColumn("dropped", F.col("admitted") - F.col("mediated"))
    )


def audit_metrics() -> list[Column]:
    """Aggregate expressions for ``DataFrame.observe`` over ``with_keep`` rows
    (stream batch metrics); they count flags and match no numbers."""
    keep = F.col("_keep")
    out = [F.count(F.lit(1)).alias("total")]
    for t in RECORD_TYPES:
        out.append(F.count(F.when(F.col("record_type") == t, 1)).alias(f"{t}_in"))
        out.append(F.count(F.when(keep & (F.col("record_type") == t), 1)).alias(f"{t}_out"))
    out.append(F.count(F.when(keep, 1)).alias("mediated"))
    return out
