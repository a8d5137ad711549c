"""The staged command line end to end on the sf0.001 fixture."""

import os

from cdrflow.cli import main
from cdrflow.params import FIXTURE_MONTHS
from cdrflow.sources.cdr_json import write_cdr_messages
from cdrflow.sources.fixtures import fixture_cdrs, fixture_subscribers
from sf_dirs import SF_SMALL


def test_stages_via_cli(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    write_cdr_messages(fixture_cdrs(spark, SF_SMALL), fmt="text", path=src)
    fixture_subscribers(spark, SF_SMALL).write.parquet(f"{tmp_dir}/subs")
    common = ["--as-of", "2024-01-02"]
    main(["stream", *common, "--source", "text", "--path", src, "--out", f"{tmp_dir}/mediated",
          "--checkpoint", f"{tmp_dir}/ckpt", "--available-now", "--timeout", "120",
          "--source-option", "maxFilesPerTrigger=2"])
    batches = {r.batch_id for r in spark.read.parquet(f"{tmp_dir}/mediated").select("batch_id").distinct().collect()}
    n_files = len([f for f in os.listdir(src) if f.endswith(".txt")])
    assert len(batches) == (n_files + 1) // 2  # two message files per micro-batch
    main(["rate", *common, "--mediated", f"{tmp_dir}/mediated", "--out", f"{tmp_dir}/rated",
          "--subscriptions", f"{tmp_dir}/subs"])
    main(["bill", *common, "--rated", f"{tmp_dir}/rated", "--out", f"{tmp_dir}/invoice",
          "--subscriptions", f"{tmp_dir}/subs", "--months", ",".join(FIXTURE_MONTHS)])
    main(["report", *common, "--invoice", f"{tmp_dir}/invoice", "--rated", f"{tmp_dir}/rated",
          "--out", f"{tmp_dir}/report", "--month", "2024-02"])
    for name in ["revenueByPlan", "planByRegion", "product_cost_analysis"]:
        d = f"{tmp_dir}/report/{name}.csv"
        parts = [p for p in os.listdir(d) if p.endswith(".csv")]
        assert len(parts) == 1
        assert len(open(f"{d}/{parts[0]}").read().splitlines()) >= 2
    # the per-customer report stays distributed; its part files, read in name
    # order, are sorted by data charges
    d = f"{tmp_dir}/report/sortedCustomersByInvoices.csv"
    vals = []
    for part in sorted(p for p in os.listdir(d) if p.endswith(".csv")):
        vals += [float(line.split(",")[1]) for line in open(f"{d}/{part}").read().splitlines()[1:]]
    assert vals and vals == sorted(vals, reverse=True)
    before = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/mediated").collect())
    main(["compact", "--table", "mediated", "--path", f"{tmp_dir}/mediated", "--where", "batch_id = 0",
          "--files-per-partition", "2"])
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/mediated").collect()) == before
    inv = spark.read.parquet(f"{tmp_dir}/invoice")
    assert sorted(r.billing_period for r in inv.select("billing_period").distinct().collect()) == list(FIXTURE_MONTHS)


def test_stream_dedup_by_index_and_by_state(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    cdrs = fixture_cdrs(spark, SF_SMALL).filter("record_ID % 10 = 0")
    for _ in range(2):
        write_cdr_messages(cdrs, fmt="text", path=src)  # every message twice
    for mode in ("store", "state"):
        out = f"{tmp_dir}/{mode}"
        main(["stream", "--as-of", "2024-01-02", "--source", "text", "--path", src, "--out", out, "--checkpoint", f"{out}-ckpt",
              "--available-now", "--timeout", "240", "--dedup", "--dedup-mode", mode, "--id-buckets", "4", "--dedup-delay", "1 day"])
    ids = {m: sorted(r[0] for r in spark.read.parquet(f"{tmp_dir}/{m}").select("record_ID").collect()) for m in ("store", "state")}
    assert ids["store"] == ids["state"] and len(set(ids["store"])) == len(ids["store"]) > 0
    main(["compact", "--table", "ids", "--path", f"{tmp_dir}/store"])
    index = spark.read.parquet(f"{tmp_dir}/store-ids")
    assert sorted(r[0] for r in index.select("record_ID").collect()) == ids["store"]
    assert {r[0] for r in index.select("n_buckets").collect()} == {4}


def test_show_previews_rows(spark, tmp_dir, capsys):
    main(["demo", "--sf-dir", SF_SMALL, "--out", f"{tmp_dir}/demo"])
    capsys.readouterr()
    main(["show", "--table", "rated", "--path", f"{tmp_dir}/demo/rated_data", "-n", "3",
          "--where", "rating_status = 'rated'"])
    out = capsys.readouterr().out
    assert "only showing top 3 rows" in out and "rated" in out


def test_demo_matches_lazy_plan(spark, tmp_dir):
    from cdrflow.operators import reports
    from cdrflow.params import FIXTURE_PARAMS
    from cdrflow.plans.queries import finish
    from cdrflow.plans.stages import fixture_stages

    main(["demo", "--sf-dir", SF_SMALL, "--out", f"{tmp_dir}/demo"])
    d = f"{tmp_dir}/demo/report/revenueByPlan.csv"
    got = spark.read.option("header", True).schema("rate_plan_id string, revenue_TTC double").csv(d)
    st = fixture_stages(spark, SF_SMALL, FIXTURE_PARAMS)
    want = finish(reports.revenue_by_plan(st.invoices(FIXTURE_MONTHS)))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_incremental_rating_by_month(spark, tmp_dir):
    from cdrflow.operators import rating
    from cdrflow.sources import files

    src = f"{tmp_dir}/in"
    write_cdr_messages(fixture_cdrs(spark, SF_SMALL), fmt="text", path=src)
    fixture_subscribers(spark, SF_SMALL).write.parquet(f"{tmp_dir}/subs")
    common = ["--as-of", "2024-01-02"]
    main(["stream", *common, "--source", "text", "--path", src, "--out", f"{tmp_dir}/mediated",
          "--checkpoint", f"{tmp_dir}/ckpt", "--available-now", "--timeout", "120"])
    rate = ["rate", *common, "--mediated", f"{tmp_dir}/mediated", "--out", f"{tmp_dir}/rated",
            "--subscriptions", f"{tmp_dir}/subs"]
    main(rate)
    full = files.read_rated(spark, f"{tmp_dir}/rated")
    before = sorted(tuple(r) for r in full.collect())
    main([*rate, "--months", "2024-02"])  # re-rate one month only
    after = sorted(tuple(r) for r in files.read_rated(spark, f"{tmp_dir}/rated").collect())
    assert after == before
    main([*rate, "--months", "2024-02", "--rebalance"])  # same rows, sized files
    month = f"{tmp_dir}/rated/billing_period=2024-02"
    assert len([f for f in os.listdir(month) if f.endswith(".parquet")]) == 1
    assert sorted(tuple(r) for r in files.read_rated(spark, f"{tmp_dir}/rated").collect()) == before
    mediated = files.read_mediated(spark, f"{tmp_dir}/mediated")
    plan = rating.in_months(mediated, ["2024-02"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThan(timestamp" in plan


def test_rate_with_dimension_files_matches_builtin(spark, tmp_dir):
    from cdrflow.sources import dims, files

    src = f"{tmp_dir}/in"
    write_cdr_messages(fixture_cdrs(spark, SF_SMALL), fmt="text", path=src)
    fixture_subscribers(spark, SF_SMALL).write.parquet(f"{tmp_dir}/subs")
    dims.product_catalog(spark).write.parquet(f"{tmp_dir}/catalog")
    dims.rate_plans(spark).write.parquet(f"{tmp_dir}/plans")
    common = ["--as-of", "2024-01-02"]
    main(["stream", *common, "--source", "text", "--path", src, "--out", f"{tmp_dir}/mediated",
          "--checkpoint", f"{tmp_dir}/ckpt", "--available-now", "--timeout", "120"])
    base = ["rate", *common, "--mediated", f"{tmp_dir}/mediated", "--subscriptions", f"{tmp_dir}/subs"]
    main([*base, "--out", f"{tmp_dir}/rated_builtin"])
    main([*base, "--out", f"{tmp_dir}/rated_files", "--catalog", f"{tmp_dir}/catalog", "--rate-plans", f"{tmp_dir}/plans"])
    a = files.read_rated(spark, f"{tmp_dir}/rated_builtin")
    b = files.read_rated(spark, f"{tmp_dir}/rated_files")
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
