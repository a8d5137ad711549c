"""Tables merged by key bucket, and billing batch by batch on them."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.params import FIXTURE_MONTHS, FIXTURE_PARAMS
from cdrflow.plans.incremental import IncrementalBilling
from cdrflow.plans.stages import fixture_stages
from cdrflow.sources.merge_store import MergeStore
from sf_dirs import SF_SMALL

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])


def _rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def _table(spark, root, n=8):
    return MergeStore(spark, f"{root}/t", SCHEMA, ("k",), n)


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_two_overlapping_loads(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    assert t.read().count() == 0 and t.version() == 0
    t.insert_absent(_df(spark, [(f"a{i}", "old") for i in range(50)]), ["k"])
    before = t.folders()
    written = t.insert_absent(_df(spark, [("a1", "new"), ("b", "x2"), ("b", "x1"), (None, "n")]), ["k"])
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 52 and got["a1"] == "old" and got["b"] == "x1" and got[None] == "n"
    # Only buckets that got rows have new files; the bucket of a1 got none unless it is one of them.
    assert {b for b, f in t.folders().items() if before.get(b) != f} == set(written) and len(written) <= 2
    after = t.folders()
    assert t.insert_absent(_df(spark, [("a1", "new"), ("b", "x0")]), ["k"]) == [] and t.folders() == after


def test_crash_between_write_and_switch(spark, tmp_dir, monkeypatch):
    t = _table(spark, tmp_dir)
    t.insert_absent(_df(spark, [("a", "1"), ("b", "1")]), ["k"], "l1")
    def die(*_):
        raise RuntimeError("lost driver")
    with monkeypatch.context() as m:
        m.setattr(MergeStore, "_switch", die)
        with pytest.raises(RuntimeError, match="lost driver"):
            t.insert_absent(_df(spark, [("a", "2"), ("c", "2")]), ["k"], "l2")
    assert _rows(t.read()) == [("a", "1"), ("b", "1")] and not t.applied("l2")
    t.insert_absent(_df(spark, [("a", "2"), ("c", "2")]), ["k"], "l2")
    assert _rows(t.read()) == [("a", "1"), ("b", "1"), ("c", "2")] and t.applied("l2")


def test_second_merge_from_the_same_version_fails_without_effect(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    t.insert_absent(_df(spark, [("a", "1")]), ["k"])
    with pytest.raises(Exception, match="(?i)already exists"):
        t._write(_df(spark, [("z", "9")]), 0, {}, [0], None)
    assert _rows(t.read()) == [("a", "1")]


def test_a_label_is_applied_once_and_buckets_can_become_empty(spark, tmp_dir):
    t = _table(spark, tmp_dir, 4)
    add = lambda stored, more: stored.unionByName(more)
    t.merge(_df(spark, [("a", "1")]), add, "one")
    assert t.merge(_df(spark, [("a", "1")]), add, "one") == [] and t.read().count() == 1
    t.merge(_df(spark, []), add, "nothing")
    assert t.applied("nothing") and t.read().count() == 1
    t.merge(_df(spark, [("a", "x")]), lambda stored, more: stored.filter("false"), "gone")
    assert t.read().count() == 0 and t.folders() == {}


def test_batch_after_batch_equals_all_at_once(spark, tmp_dir):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    store = IncrementalBilling(spark, f"{tmp_dir}/inc", FIXTURE_PARAMS, 16)
    part = F.pmod(F.xxhash64("record_ID"), F.lit(3))
    add = lambda k: store.add_batch(
        st.mediated().filter(part == k), f"s-{k}", st.subscriptions, st.catalog, st.plans, dims_trusted_small=True)
    for k in range(2):
        add(k)
        want = st.invoices(FIXTURE_MONTHS, rated=st.rated(st.mediated().filter(part <= k)))
        assert _rows(store.invoices(st.subscriptions, FIXTURE_MONTHS)) == _rows(want)
    folders = store.totals.folders()
    assert add(1) == [] and store.totals.folders() == folders  # a repeated batch
    assert store.rated().count() == st.rated(st.mediated().filter(part <= 1)).count()
    # A batch of one subscriber reads and writes one bucket.
    one = st.rated().filter("rating_status = 'rated'").agg(F.min("customer_id")).first()[0]
    mine = st.mediated().filter(F.coalesce("caller_id", "sender_id", "user_id") == one)
    touched = store.add_batch(mine, "extra", st.subscriptions, st.catalog, st.plans, dims_trusted_small=True)
    assert len(touched) == 1 and {b for b, f in store.totals.folders().items() if folders.get(b) != f} == set(touched)


def test_batch_that_died_is_run_again(spark, tmp_dir, monkeypatch):
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    store = IncrementalBilling(spark, f"{tmp_dir}/inc", FIXTURE_PARAMS, 4)
    args = (st.mediated(), "b", st.subscriptions, st.catalog, st.plans, True)
    def die(*_):
        raise RuntimeError("lost driver")
    with monkeypatch.context() as m:
        m.setattr(MergeStore, "_switch", die)
        with pytest.raises(RuntimeError):
            store.add_batch(*args)
    store.add_batch(*args)
    assert store.rated().count() == st.rated().count()
    assert _rows(store.invoices(st.subscriptions, ["2024-02"])) == _rows(st.invoices(["2024-02"]))
