"""The index of stored record ids: what a batch reads, replays, rebuilding."""

import json
import os
import re

from pyspark.sql import functions as F

from cdrflow.operators import mediation
from cdrflow.params import FIXTURE_PARAMS
from cdrflow.sources import files, id_index
from cdrflow.sources.cdr_json import decode_cdr
from cdrflow.streaming import mediation_stream, run_until_done, start_mediation_stream


def _rec(i, ts="2024-03-09T10:00:00"):
    return {"record_ID": f"r{i}", "record_type": "sms", "timestamp": ts, "sender_id": "212612345678",
            "receiver_id": "447911123456", "cell_id": "C1", "technology": "4G"}


def _send(spark, root, name, recs, **kw):
    os.makedirs(f"{root}/in", exist_ok=True)
    with open(f"{root}/in/{name}.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    q = start_mediation_stream(spark, f"{root}/out", f"{root}/ckpt", FIXTURE_PARAMS, fmt="text", source_path=f"{root}/in",
                               available_now=True, dedup=True, **kw)
    run_until_done(q, 120)


def _ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "record_ID string")


def _scan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_batch_reads_only_the_buckets_of_its_ids(spark, tmp_dir):
    store = f"{tmp_dir}/out"
    files.ensure_mediated(spark, store)
    n = id_index.ensure_index(spark, store, 16)
    everything = _ids(spark, [f"r{i}" for i in range(5000)])
    id_index.claim(everything, store, "s", 0, n)
    found = id_index.known_ids(_ids(spark, ["r7", "r8", "new"]), store, "s", 1, n)
    assert sorted(r[0] for r in found.collect()) == ["r7", "r8"]
    assert _buckets_read(found, n) == {r[0] for r in _ids(spark, ["r7", "r8", "new"]).select(id_index.bucket_of(n)).collect()}
    assert "PushedFilters: [Or(" in _scan(found)  # asked by value: the files' Bloom filters answer
    # A batch of many ids joins, and still only in its buckets.
    one = everything.filter(id_index.bucket_of(n) == 3)
    many = id_index.known_ids(one, store, "s", 1, n)
    assert many.count() == one.count() > id_index.POINT_IDS and _buckets_read(many, n) == {3}


def _buckets_read(df, n) -> set[int]:
    """The buckets that the partition filters of the index scan leave."""
    spark = df.sparkSession
    where = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", _scan(df)).group(1)
    where = re.sub(r"#\d+", "", where).replace("isnotnull(bucket), ", "")
    where = re.sub(r"bucket IN \(([\d,]+)\)", r"bucket in (\1)", where)
    return {r[0] for r in spark.range(n).select(F.col("id").cast("int").alias("bucket")).filter(where).collect()}


def test_files_have_bloom_filters_and_are_sorted(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    store = f"{tmp_dir}/out"
    files.ensure_mediated(spark, store)
    n = id_index.ensure_index(spark, store, 4)
    id_index.claim(_ids(spark, [f"r{i}" for i in range(1000)]), store, "s", 0, n)
    parts = glob.glob(f"{id_index.index_path(store)}/bucket=*/*.parquet")
    assert len(parts) == 4
    for p in parts:
        ids = pq.read_table(p, columns=["record_ID"])["record_ID"].to_pylist()
        assert ids == sorted(ids)
        assert _has_bloom_filter(spark, p)


def _has_bloom_filter(spark, path) -> bool:
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    try:
        return reader.getFooter().getBlocks().get(0).getColumns().get(0).getBloomFilterOffset() > 0
    finally:
        reader.close()


def test_own_and_later_epochs_are_left_aside(spark, tmp_dir):
    store = f"{tmp_dir}/out"
    files.ensure_mediated(spark, store)
    n = id_index.ensure_index(spark, store, 4)
    id_index.claim(_ids(spark, ["a"]), store, "s", 3, n)
    id_index.claim(_ids(spark, ["b"]), store, "s", 5, n)
    id_index.claim(_ids(spark, ["c"]), store, "other", 9, n)
    ask = lambda epoch: sorted(r[0] for r in id_index.known_ids(_ids(spark, ["a", "b", "c", "d"]), store, "s", epoch, n).collect())
    assert ask(3) == ["c"] and ask(4) == ["a", "c"] and ask(6) == ["a", "b", "c"]
    assert id_index.known_ids(_ids(spark, []), store, "s", 6, n).count() == 0


def test_replay_after_a_crash_between_claims_and_records(spark, tmp_dir):
    _send(spark, tmp_dir, "f1", [_rec(1), _rec(2)])
    _send(spark, tmp_dir, "f2", [_rec(2, "2024-04-09T10:00:00"), _rec(3)])
    out = f"{tmp_dir}/out"
    stored = sorted((r.record_ID, r.batch_id) for r in files.read_mediated(spark, out).collect())
    assert stored == [("r1", 0), ("r2", 0), ("r3", 1)]
    # The epoch had claimed its ids, but its records were lost: it is run again.
    stream = mediation_stream.stream_id_of(spark, f"{tmp_dir}/ckpt")
    n = id_index.ensure_index(spark, out)
    id_index.claim(_ids(spark, ["r4"]), out, stream, 2, n)
    batch = decode_cdr(spark.createDataFrame([(json.dumps(_rec(4)),), (json.dumps(_rec(1)),)], "value string"))
    write = mediation_stream.mediation_batch_writer(out, FIXTURE_PARAMS, checkpoint=f"{tmp_dir}/ckpt", dedup=True)
    write(mediation.admit(batch, FIXTURE_PARAMS.as_of), 2)
    again = sorted((r.record_ID, r.batch_id) for r in files.read_mediated(spark, out).collect())
    assert again == [*stored, ("r4", 2)]


def test_index_is_built_from_a_store_without_one(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/f1.json", "w") as f:
        f.write("\n".join(json.dumps(_rec(i)) for i in range(3)))
    q = start_mediation_stream(spark, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", FIXTURE_PARAMS, fmt="text",
                               source_path=f"{tmp_dir}/in", available_now=True)
    run_until_done(q, 120)
    _send(spark, tmp_dir, "f2", [_rec(2, "2024-05-01T00:00:00"), _rec(9)], id_buckets=8)
    got = sorted(r.record_ID for r in files.read_mediated(spark, f"{tmp_dir}/out").collect())
    assert got == ["r0", "r1", "r2", "r9"]
    assert id_index.ensure_index(spark, f"{tmp_dir}/out", 99) == 8  # the number it was made with


def test_compaction_keeps_the_claims(spark, tmp_dir):
    store = f"{tmp_dir}/out"
    files.ensure_mediated(spark, store)
    n = id_index.ensure_index(spark, store, 2)
    for epoch in range(4):
        id_index.claim(_ids(spark, [f"r{epoch}-{i}" for i in range(20)]), store, "s", epoch, n)
    index = id_index.index_path(store)
    before = sorted(map(tuple, id_index.read_index(spark, index).collect()))
    id_index.compact_index(spark, store)
    spark.catalog.refreshByPath(index)
    after = id_index.read_index(spark, index)
    assert sorted(map(tuple, after.collect())) == before and len(after.inputFiles()) == 2
