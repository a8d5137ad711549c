"""Property test: one-pass mediation against a plain Python model of the rules."""

import datetime as dt
import re
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cdrflow import schemas
from cdrflow.functions.msisdn import MSISDN_PATTERN_COMPAT, MSISDN_PATTERN_STRICT
from cdrflow.operators import mediation

AS_OF = dt.date(2024, 1, 2)
NUMBERS = [None, "", "UNK", "junk", "212612345678", "212712345678", "21261234567", "447911123456",
           "12025550123", "4915112345678", "X00000012345", "905321234567", "3247123456"]
TECH = [None, "2G", "3G", "4G", "5G", "LTE", "NR", "UMTS", "WIFI"]
TIMES = [None, dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2, 0, 0), dt.datetime(2024, 3, 5, 12, 30, 1, 5)]

record = st.fixed_dictionaries({
    "record_ID": st.text(alphabet="abc123", min_size=1, max_size=6),
    "record_type": st.sampled_from(["voice", "sms", "data", "fax", None]),
    "timestamp": st.sampled_from(TIMES),
    "cell_id": st.sampled_from([None, "CELL_01"]),
    "technology": st.sampled_from(TECH),
    "caller_id": st.sampled_from(NUMBERS),
    "callee_id": st.sampled_from(NUMBERS),
    "duration_sec": st.sampled_from([None, -5, 0, 1, 61]),
    "sender_id": st.sampled_from(NUMBERS),
    "receiver_id": st.sampled_from(NUMBERS),
    "user_id": st.sampled_from(NUMBERS),
    "data_volume_mb": st.sampled_from([None, 0.0, 12.5, 100.996, 0.000001, 1e13]),
    "session_duration_sec": st.sampled_from([None, -60, 0, 90]),
    "product_code": st.sampled_from([None, "DATA_STD", "DATA_ULTRA", "DATA_PLUS"]),
})


def model(r, mode):
    pat = MSISDN_PATTERN_COMPAT if mode == "compat" else MSISDN_PATTERN_STRICT

    def valid(x):
        return x is not None and re.search(pat, x) is not None

    rt = r["record_type"]
    if rt is None or r["timestamp"] is None or r["timestamp"].date() < AS_OF:
        return None
    payer = {"voice": "caller_id", "sms": "sender_id", "data": "user_id"}.get(rt)
    if payer is None or not valid(r[payer]):
        return None
    if rt == "voice" and not (r["duration_sec"] is not None and r["duration_sec"] > 0):
        return None
    tech = r["technology"] or "4G"
    tech = {"LTE": "4G", "NR": "5G", "UMTS": "3G"}.get(tech, tech)
    out = dict.fromkeys(schemas.MEDIATED_COLUMNS)
    out.update(record_ID=r["record_ID"], timestamp=r["timestamp"], cell_id=r["cell_id"] or "UNK",
               technology=tech, record_type=rt, rating_status="ready")

    def other(x):
        x = "UNK" if x is None else x
        return x if valid(x) else "UNK"

    if rt == "voice":
        callee = other(r["callee_id"])
        prod = "VOICE_NAT" if callee[:3] == "UNK" or callee[:3] == "212" else "VOICE_INT"
        out.update(caller_id=r["caller_id"], callee_id=callee, duration_sec=r["duration_sec"], product_code=prod)
    elif rt == "sms":
        out.update(sender_id=r["sender_id"], receiver_id=other(r["receiver_id"]), product_code="SMS_STD")
    else:
        s, v = r["session_duration_sec"], r["data_volume_mb"]
        v = None if v is None or v >= 1e12 else v  # does not fit: missing
        review = v is None or s is None or s < 0
        out.update(user_id=r["user_id"], product_code=r["product_code"],
                   session_duration_sec=s if s is not None and s >= 0 else None,
                   data_volume_mb=None if v is None else Decimal(str(v)).quantize(Decimal("0.000001")),
                   rating_status="needs_review" if review else "ready")
    return tuple(out[c] for c in schemas.MEDIATED_COLUMNS)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(recs=st.lists(record, min_size=1, max_size=60), mode=st.sampled_from(["compat", "strict"]))
def test_mediate_matches_model(spark, recs, mode):
    names = schemas.RAW_CDR.fieldNames()
    df = spark.createDataFrame([tuple(r[c] for c in names) for r in recs], schemas.RAW_CDR)
    got = sorted((tuple(r) for r in mediation.mediate(mediation.admit(df, AS_OF), mode).collect()), key=repr)
    want = sorted((m for m in (model(r, mode) for r in recs) if m is not None), key=repr)
    assert got == want
