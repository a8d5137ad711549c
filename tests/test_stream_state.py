"""De-duplication in keyed streaming state."""

import json
import os

from cdrflow.params import FIXTURE_PARAMS
from cdrflow.sources import files
from cdrflow.streaming import run_until_done, start_mediation_stream


def _rec(i, ts="2024-03-09T10:00:00", **more):
    rec = {"record_ID": f"r{i}", "record_type": "sms", "timestamp": ts, "sender_id": "212612345678",
           "receiver_id": "447911123456", "cell_id": "C1", "technology": "4G", **more}
    return {k: v for k, v in rec.items() if v is not None}


def _send(spark, root, name, recs, **kw):
    os.makedirs(f"{root}/in", exist_ok=True)
    with open(f"{root}/in/{name}.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    q = start_mediation_stream(spark, f"{root}/out", f"{root}/ckpt", FIXTURE_PARAMS, fmt="text", source_path=f"{root}/in",
                               available_now=True, dedup="state", **kw)
    run_until_done(q, 120)
    return q


def _stored(spark, root):
    return files.read_mediated(spark, f"{root}/out").collect()


def test_restart_from_the_checkpoint_knows_what_came_before(spark, tmp_dir):
    none = _rec(0, record_ID=None)
    _send(spark, tmp_dir, "f1", [_rec(1), _rec(2), _rec(2), none, {**none, "receiver_id": "447911123457"}])
    # Another event time, weeks late, without an id again, and new ones.
    _send(spark, tmp_dir, "f2", [_rec(1, "2024-05-01T00:00:00"), _rec(3), _rec(4, "2024-01-05T10:00:00"), none])
    q = _send(spark, tmp_dir, "f3", [_rec(4), _rec(3), _rec(5)])
    got = _stored(spark, tmp_dir)
    assert sorted((r.record_ID, str(r.timestamp)[:10]) for r in got if r.record_ID) == [
        ("r1", "2024-03-09"), ("r2", "2024-03-09"), ("r3", "2024-03-09"), ("r4", "2024-01-05"), ("r5", "2024-03-09")]
    assert sorted(r.receiver_id for r in got if not r.record_ID) == ["447911123456", "447911123457"]
    state = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert state and any("rocksdb" in k.lower() for k in state[-1]["customMetrics"])
    assert state[-1]["numRowsDroppedByWatermark"] == 0  # nothing is late
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").find("RocksDB") < 0  # the query's own


def test_an_id_is_forgotten_after_the_delay(spark, tmp_dir):
    _send(spark, tmp_dir, "f1", [_rec(1), _rec(2)], dedup_delay="0 seconds")
    _send(spark, tmp_dir, "f2", [_rec(3)], dedup_delay="0 seconds")  # moves the watermark past the first batch
    q = _send(spark, tmp_dir, "f3", [_rec(1), _rec(4)], dedup_delay="0 seconds")
    ids = sorted(r.record_ID for r in _stored(spark, tmp_dir))
    assert ids == ["r1", "r1", "r2", "r3", "r4"]  # twice: the bound of this mode
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert held and held[-1] <= 3


def test_same_records_as_the_store_mode(spark, tmp_dir):
    feed = [[_rec(i) for i in range(0, 40)], [_rec(i, "2024-04-01T00:00:00") for i in range(20, 60)]]
    for mode in ("store", "state"):
        root = f"{tmp_dir}/{mode}"
        os.makedirs(f"{root}/in")
        for k, recs in enumerate(feed):
            with open(f"{root}/in/f{k}.json", "w") as f:
                f.write("\n".join(json.dumps(r) for r in recs))
            q = start_mediation_stream(spark, f"{root}/out", f"{root}/ckpt", FIXTURE_PARAMS, fmt="text",
                                       source_path=f"{root}/in", available_now=True, dedup=mode)
            run_until_done(q, 120)
    rows = [sorted((r.record_ID, str(r.timestamp)) for r in _stored(spark, f"{tmp_dir}/{m}")) for m in ("store", "state")]
    assert rows[0] == rows[1] and len(rows[0]) == 60
