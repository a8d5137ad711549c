"""Mediation semantics on hand-made rows and on the sf0.001 fixture."""

import datetime as dt

from pyspark.sql import functions as F

from cdrflow import schemas
from cdrflow.operators import mediation
from cdrflow.sources.cdr_json import decode_cdr, encode_cdr
from cdrflow.sources.fixtures import fixture_cdrs
from sf_dirs import SF_SMALL

AS_OF = dt.date(2024, 1, 2)


def _msgs(spark, lines):
    return spark.createDataFrame([(l,) for l in lines], "value string")


def test_decode_garbage_wrong_types_missing_keys(spark):
    lines = [
        "not json at all",
        '{"record_ID": "a", "record_type": "voice", "timestamp": "2024-02-01T10:00:00.000001", "duration_sec": "60"}',
        '{"record_ID": "b", "record_type": "voice", "timestamp": "2024-02-01T10:00:00", "duration_sec": 5.5}',
        '{"record_ID": "c", "record_type": "sms"}',
        '{"record_ID": "d", "record_type": "data", "timestamp": null, "user_id": "212612345678"}',
    ]
    rows = {r.record_ID: r for r in decode_cdr(_msgs(spark, lines)).collect()}
    assert None in rows and rows[None].record_type is None  # garbage -> all NULL
    assert rows["a"].duration_sec is None                  # quoted number
    assert rows["a"].timestamp == dt.datetime(2024, 2, 1, 10, 0, 0, 1)
    assert rows["b"].duration_sec is None                  # 5.5 for an int
    assert rows["c"].timestamp is None                     # missing key
    admitted = mediation.admit(decode_cdr(_msgs(spark, lines)), AS_OF)
    assert sorted(r.record_ID for r in admitted.collect()) == ["a", "b"]


def test_freshness_keeps_today_and_future(spark):
    rows = [(f"{i}", "sms", ts) for i, ts in enumerate(
        [dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2, 0, 0), dt.datetime(2030, 1, 1)])]
    df = spark.createDataFrame(rows, "record_ID string, record_type string, timestamp timestamp_ntz")
    kept = [r.record_ID for r in mediation.fresh(df, AS_OF).collect()]
    assert sorted(kept) == ["1", "2"]


def _raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_CDR)


def test_voice_cleaning_rules(spark):
    ts = dt.datetime(2024, 2, 1)
    base = dict.fromkeys(schemas.RAW_CDR.fieldNames())
    recs = [
        {**base, "record_ID": "ok", "record_type": "voice", "timestamp": ts, "caller_id": "212612345678",
         "callee_id": "447911123456", "duration_sec": 30, "technology": "LTE"},
        {**base, "record_ID": "empty_callee", "record_type": "voice", "timestamp": ts, "caller_id": "212612345678",
         "callee_id": "", "duration_sec": 30},
        {**base, "record_ID": "junk_callee", "record_type": "voice", "timestamp": ts, "caller_id": "212612345678",
         "callee_id": "junk", "duration_sec": 30, "cell_id": "C1"},
        {**base, "record_ID": "zero_dur", "record_type": "voice", "timestamp": ts, "caller_id": "212612345678",
         "duration_sec": 0},
        {**base, "record_ID": "null_dur", "record_type": "voice", "timestamp": ts, "caller_id": "212612345678"},
        {**base, "record_ID": "bad_caller", "record_type": "voice", "timestamp": ts, "caller_id": "X123",
         "duration_sec": 10},
        {**base, "record_ID": "empty_caller", "record_type": "voice", "timestamp": ts, "caller_id": "",
         "duration_sec": 10},
        {**base, "record_ID": "fax", "record_type": "fax", "timestamp": ts, "caller_id": "212612345678",
         "duration_sec": 10},
    ]
    df = _raw(spark, [tuple(r[c] for c in schemas.RAW_CDR.fieldNames()) for r in recs])
    out = {r.record_ID: r for r in mediation.mediate(df).collect()}
    assert set(out) == {"ok", "empty_callee", "junk_callee", "empty_caller"}
    assert out["ok"].product_code == "VOICE_INT" and out["ok"].technology == "4G" and out["ok"].cell_id == "UNK"
    assert out["empty_callee"].callee_id == "" and out["empty_callee"].product_code == "VOICE_INT"
    assert out["junk_callee"].callee_id == "UNK" and out["junk_callee"].product_code == "VOICE_NAT"
    assert out["junk_callee"].cell_id == "C1"
    strict = {r.record_ID: r for r in mediation.mediate(df, "strict").collect()}
    assert set(strict) == {"ok", "empty_callee", "junk_callee"}  # empty caller dropped
    assert strict["empty_callee"].callee_id == "UNK" and strict["empty_callee"].product_code == "VOICE_NAT"


def test_data_review_status_and_export(spark):
    ts = dt.datetime(2024, 2, 1)
    names = schemas.RAW_CDR.fieldNames()
    base = dict.fromkeys(names)
    recs = [
        {**base, "record_ID": "d1", "record_type": "data", "timestamp": ts, "user_id": "212612345678",
         "data_volume_mb": 12.5, "session_duration_sec": 0, "product_code": "DATA_STD"},
        {**base, "record_ID": "d2", "record_type": "data", "timestamp": ts, "user_id": "212612345678",
         "data_volume_mb": None, "session_duration_sec": 60, "product_code": "DATA_STD"},
        {**base, "record_ID": "d3", "record_type": "data", "timestamp": ts, "user_id": "212612345678",
         "data_volume_mb": 1.0, "session_duration_sec": -5, "product_code": "DATA_PLUS"},
    ]
    df = _raw(spark, [tuple(r[c] for c in names) for r in recs])
    m = mediation.mediate(df)
    out = {r.record_ID: r for r in m.collect()}
    assert out["d1"].rating_status == "ready"
    assert out["d2"].rating_status == "needs_review" and out["d2"].data_volume_mb is None
    assert out["d3"].rating_status == "needs_review" and out["d3"].session_duration_sec is None
    exp = {r.record_ID: r for r in mediation.export_strings(m).collect()}
    assert exp["d2"].data_volume_mb == "UNK" and exp["d3"].session_duration_sec == "UNK"
    assert exp["d1"].data_volume_mb == "12.5"


def test_one_pass_equals_split_clean_union(spark):
    admitted = mediation.admit(fixture_cdrs(spark, SF_SMALL), AS_OF)
    one = mediation.mediate(admitted)
    parts = mediation.union_cleaned(
        mediation.clean_voice(mediation.split_by_type(admitted, "voice")),
        mediation.clean_sms(mediation.split_by_type(admitted, "sms")),
        mediation.clean_data(mediation.split_by_type(admitted, "data")),
    )
    assert one.count() > 0
    assert one.exceptAll(parts).count() == 0 and parts.exceptAll(one).count() == 0


def test_audit_counts_add_up(spark):
    admitted = mediation.admit(fixture_cdrs(spark, SF_SMALL), AS_OF)
    audit = {r.record_type: r for r in mediation.mediation_audit(admitted).collect()}
    by_type = {r.record_type: r["count"] for r in mediation.mediate(admitted).groupBy("record_type").count().collect()}
    for t, r in audit.items():
        assert r.mediated == by_type.get(t, 0)
        assert r.admitted == r.mediated + r.dropped


def test_mediation_has_no_shuffle(spark):
    from cdrflow.sources.fixtures import cdrs_from_events

    raw = cdrs_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    admitted = mediation.admit(raw, AS_OF)
    plan = mediation.mediate(admitted)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_encode_roundtrip_and_key_range(spark):
    cdrs = fixture_cdrs(spark, SF_SMALL)
    msgs = encode_cdr(cdrs)
    keys = msgs.select(F.col("key").cast("int").alias("k")).agg(F.min("k"), F.max("k")).first()
    assert 1 <= keys[0] and keys[1] <= 1000
    back = decode_cdr(msgs)
    assert back.exceptAll(cdrs).count() == 0 and cdrs.exceptAll(back).count() == 0
