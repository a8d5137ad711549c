"""Command line: the four stages as separate jobs, like the reference's scripts.

    python -m cdrflow stream  --source kafka --kafka-servers host:9092 --out mediated_data --checkpoint ckpt
                              --source-option maxOffsetsPerTrigger=5000000 --trigger "30 seconds"
    python -m cdrflow rate    --mediated mediated_data --out rated_data --subscriptions jdbc --jdbc-url ...
    python -m cdrflow bill    --rated rated_data --out invoice --month 2025-06 --subscriptions subs.parquet
    python -m cdrflow report  --invoice invoice --rated rated_data --out report --month 2025-06
    python -m cdrflow compact --table mediated --path mediated_data --where "batch_id < 1000"
    python -m cdrflow demo    --sf-dir /root/testdata/sf0.01 --out /shared/cdrflow-demo

Paths must be on a file system every executor sees (HDFS, object store).
Dimension tables come from JDBC (``--subscriptions jdbc``), from Parquet
(a path), or, for catalog and tariffs, from the built-in seed rows.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrflow.operators import billing, dedup, rating, reports
from cdrflow.params import FIXTURE_MONTHS, FIXTURE_PARAMS, Params
from cdrflow.plans.stages import fixture_stages, run_batch
from cdrflow.session import apply_runtime_conf, get_session
from cdrflow.sources import dims, files, id_index
from cdrflow.streaming import run_until_done, start_mediation_stream
from cdrflow.streaming.mediation_stream import DEDUP_DELAY


def _params(a) -> Params:
    return Params(
        as_of=dt.date.fromisoformat(a.as_of) if getattr(a, "as_of", None) else None,
        billing_month=getattr(a, "month", None) or Params().billing_month,
        discount=Decimal(a.discount),
        vat=Decimal(a.vat),
        fee=Decimal(a.fee),
        boundary=a.boundary,
        money=a.money,
        msisdn_mode=a.msisdn_mode,
        join_salt_buckets=a.join_salt_buckets,
        dedup=a.dedup,
    )


def _jdbc(a) -> dict[str, str]:
    opts = {"url": a.jdbc_url}
    if a.jdbc_user:
        opts["user"] = a.jdbc_user
    if a.jdbc_password:
        opts["password"] = a.jdbc_password
    if a.jdbc_driver:
        opts["driver"] = a.jdbc_driver
    return opts


def _dim(spark: SparkSession, a, source: str, table: str) -> DataFrame:
    if source == "builtin":
        return dims.product_catalog(spark) if table == "product_catalog" else dims.rate_plans(spark)
    if source == "jdbc":
        preds = None
        if table == "customer_subscriptions" and a.jdbc_partitions > 1:
            low, _, high = a.jdbc_key_range.partition(":")
            preds = dims.range_predicates("customer_id", low, high, a.jdbc_partitions)
        # One read of the database; the copy also has a size for the planner.
        return files.stage_table(dims.read_dim(spark, table, "jdbc", _jdbc(a), predicates=preds), table)
    df = spark.read.parquet(source)
    return dims.typed_rate_plans(df) if table == "rate_plans" else df


def cmd_stream(spark, a):
    opts = {}
    if a.source == "kafka":
        opts = {
            "kafka.bootstrap.servers": a.kafka_servers,
            "subscribe": a.topic,
            "startingOffsets": a.starting_offsets,
            "failOnDataLoss": str(a.fail_on_data_loss).lower(),
        }
    for kv in a.source_option or []:
        key, _, value = kv.partition("=")
        opts[key] = value
    q = start_mediation_stream(
        spark, a.out, a.checkpoint, _params(a), fmt=a.source, source_options=opts, source_path=a.path,
        available_now=a.available_now, processing_time=a.trigger, dedup=a.dedup and a.dedup_mode,
        id_buckets=a.id_buckets, dedup_delay=a.dedup_delay,
        on_metrics=lambda epoch, m: print(json.dumps({"batch": epoch, **m}), flush=True),
    )
    run_until_done(q, a.timeout)


def cmd_rate(spark, a):
    p = _params(a)
    mediated = files.read_mediated(spark, a.mediated)
    months = a.months.split(",") if a.months else None
    if months:
        mediated = rating.in_months(mediated, months)
        mediated = mediated.filter(F.col("event_month").isin(months))
    if p.dedup:
        mediated = dedup.first_deliveries(mediated)
    subs = _dim(spark, a, a.subscriptions, "customer_subscriptions")
    catalog = _dim(spark, a, a.catalog, "product_catalog")
    plans = _dim(spark, a, a.rate_plans, "rate_plans")
    trusted = a.catalog == "builtin" and a.rate_plans == "builtin"
    rated = rating.rate(mediated, subs, catalog, plans, p, dims_trusted_small=trusted)
    files.write_rated(rated, a.out, p.money, rebalance=a.rebalance, months=months)


def cmd_bill(spark, a):
    p = _params(a)
    rated = files.read_rated(spark, a.rated, p.money)
    subs = _dim(spark, a, a.subscriptions, "customer_subscriptions")
    months = a.months.split(",") if a.months else [p.billing_month]
    invoices = billing.invoices_for_months(rated, subs, months, p)
    files.write_invoices(invoices, a.out, p.money, rebalance=a.rebalance, months=months)
    if a.jdbc_table:
        # Written from the stored invoices: the invoice plan runs once.  The
        # database table holds the months just billed, like the reference's.
        invoices = files.read_invoices(spark, a.out, p.money).filter(F.col("billing_period").isin(*months))
        files.write_jdbc(invoices, a.jdbc_table, _jdbc(a))


def cmd_report(spark, a):
    p = _params(a)
    invoices = files.read_invoices(spark, a.invoice, p.money)
    invoices = invoices.filter(F.col("billing_period") == p.billing_month)
    rated = files.read_rated(spark, a.rated, p.money)
    out = a.out.rstrip("/")
    files.write_report(reports.top_customers(invoices, p.money), f"{out}/sortedCustomersByInvoices.csv")
    files.write_report(reports.revenue_by_plan(invoices), f"{out}/revenueByPlan.csv", single_file=True)
    files.write_report(reports.revenue_by_region_plan(invoices), f"{out}/planByRegion.csv")
    files.write_report(reports.product_cost(rated, p.money), f"{out}/product_cost_analysis.csv", single_file=True)


def cmd_compact(spark, a):
    from cdrflow import schemas

    if a.table == "ids":  # the index beside the mediated store at --path
        return id_index.compact_index(spark, a.path)
    table = {
        "mediated": (schemas.MEDIATED_STORED, schemas.MEDIATED_PARTITIONS, "record_ID"),
        "rated": (schemas.storage_schema(schemas.RATED, a.money), ["billing_period"], "record_ID"),
        "invoice": (schemas.storage_schema(schemas.INVOICE, a.money), ["billing_period"], "customer_id"),
    }[a.table]
    where = F.expr(a.where) if a.where else None
    cluster = {"rated": ["customer_id", "record_ID"], "invoice": ["customer_id"]}.get(a.table) if a.cluster else None
    files.compact_partitions(
        spark, a.path, table[0], table[1], where, a.files_per_partition, table[2], cluster_by=cluster
    )


def cmd_show(spark, a):
    """First rows of a stage table (the notebooks' ``show(5)`` previews)."""
    readers = {
        "mediated": lambda: files.read_mediated(spark, a.path),
        "rated": lambda: files.read_rated(spark, a.path, a.money),
        "invoice": lambda: files.read_invoices(spark, a.path, a.money),
        "report": lambda: spark.read.option("header", True).csv(a.path),
    }
    df = readers[a.table]()
    if a.where:
        df = df.filter(F.expr(a.where))
    df.show(a.rows, truncate=False)


def cmd_demo(spark, a):
    params = FIXTURE_PARAMS.with_(boundary=a.boundary, money=a.money, msisdn_mode=a.msisdn_mode)
    paths = run_batch(fixture_stages(spark, a.sf_dir, params), a.out, months=list(FIXTURE_MONTHS))
    print(json.dumps(paths))


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="cdrflow", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--master", default=None, help="Spark master (default: the submitter's)")
    ap.add_argument("--input-gb", type=float, default=None,
                    help="expected input size: sizes shuffle partitions and scan splits (session.cluster_conf)")
    sub = ap.add_subparsers(dest="cmd", required=True)

    def common(p):
        p.add_argument("--as-of", default=None, help="freshness date (default: today)")
        p.add_argument("--discount", default="0.05")
        p.add_argument("--vat", default="0.20")
        p.add_argument("--fee", default="1")
        p.add_argument("--boundary", choices=["whole_units", "exact"], default="whole_units")
        p.add_argument("--money", choices=["decimal", "double"], default="decimal")
        p.add_argument("--msisdn-mode", choices=["compat", "strict"], default="compat")
        p.add_argument("--jdbc-url", default=None)
        p.add_argument("--jdbc-user", default=None)
        p.add_argument("--jdbc-password", default=None)
        p.add_argument("--jdbc-driver", default=None)
        p.add_argument("--jdbc-partitions", type=int, default=0,
                       help="read subscriptions in parallel, in this many ranges of customer_id")
        p.add_argument("--jdbc-key-range", default="212600000000:212799999999", metavar="LOW:HIGH",
                       help="customer_id numbers between which the ranges are cut")
        p.add_argument("--dedup", action="store_true", help="keep one delivery of each record_ID")
        p.add_argument("--broadcast-mb", type=int, default=None,
                       help="largest stored dimension that is broadcast (spark.sql.autoBroadcastJoinThreshold)")
        p.add_argument("--join-salt-buckets", type=int, default=None,
                       help="salt the CDR x subscription join (without AQE, or for extreme skew)")

    s = sub.add_parser("stream", help="mediation stream -> mediated_data")
    common(s)
    s.add_argument("--source", choices=["kafka", "text"], default="kafka")
    s.add_argument("--kafka-servers", default="localhost:9092")
    s.add_argument("--topic", default="telecom")
    s.add_argument("--path", default=None, help="JSON-lines directory for --source text")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--trigger", default=None, help='processing-time trigger, e.g. "10 seconds"')
    s.add_argument("--dedup-mode", choices=["store", "state"], default="store",
                   help="look records up among all stored ones, or in streaming state for --dedup-delay")
    s.add_argument("--dedup-delay", default=DEDUP_DELAY, help='how long state knows an id, e.g. "2 days"')
    s.add_argument("--id-buckets", type=int, default=id_index.BUCKETS,
                   help="buckets of a new index of ids (--dedup); more of them for a larger store")
    s.add_argument("--starting-offsets", default="latest",
                   help="where a new Kafka checkpoint starts; latest skips the backlog, earliest reads it")
    s.add_argument("--fail-on-data-loss", action="store_true", help="stop when Kafka has expired unread offsets")
    s.add_argument("--timeout", type=float, default=None)
    s.add_argument("--source-option", action="append", metavar="KEY=VALUE",
                   help="extra source option, e.g. maxOffsetsPerTrigger=5000000 or maxFilesPerTrigger=100")
    s.set_defaults(fn=cmd_stream)

    r = sub.add_parser("rate", help="mediated_data -> rated_data")
    common(r)
    r.add_argument("--mediated", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--subscriptions", required=True, help="'jdbc' or a Parquet path")
    r.add_argument("--catalog", default="builtin", help="'builtin', 'jdbc' or a Parquet path")
    r.add_argument("--rate-plans", default="builtin", help="'builtin', 'jdbc' or a Parquet path")
    r.add_argument("--months", default=None, help="rate only these yyyy-MM months (others stay as they are)")
    r.add_argument("--rebalance", action="store_true", help="a few large files per month (one extra shuffle)")
    r.set_defaults(fn=cmd_rate)

    b = sub.add_parser("bill", help="rated_data -> invoice (and a JDBC table)")
    common(b)
    b.add_argument("--rated", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--subscriptions", required=True)
    b.add_argument("--month", default=None)
    b.add_argument("--months", default=None, help="comma-separated yyyy-MM list")
    b.add_argument("--jdbc-table", default=None)
    b.add_argument("--rebalance", action="store_true", help="a few large files per month (one extra shuffle)")
    b.set_defaults(fn=cmd_bill)

    p = sub.add_parser("report", help="invoice + rated_data -> CSV reports")
    common(p)
    p.add_argument("--invoice", required=True)
    p.add_argument("--rated", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--month", default=None, help="billing month to report (default: Params.billing_month)")
    p.set_defaults(fn=cmd_report)

    c = sub.add_parser("compact", help="rewrite selected partitions of a stage table into fewer files")
    common(c)
    c.add_argument("--table", choices=["mediated", "rated", "invoice", "ids"], required=True)
    c.add_argument("--path", required=True)
    c.add_argument("--where", default=None, help='partition predicate, e.g. "batch_id < 1000"')
    c.add_argument("--files-per-partition", type=int, default=1)
    c.add_argument("--cluster", action="store_true",
                   help="sort rated records or invoices by subscriber, so that reading one skips the others")
    c.set_defaults(fn=cmd_compact)

    v = sub.add_parser("show", help="preview the first rows of a stage table")
    common(v)
    v.add_argument("--table", choices=["mediated", "rated", "invoice", "report"], required=True)
    v.add_argument("--path", required=True)
    v.add_argument("--where", default=None)
    v.add_argument("-n", "--rows", type=int, default=5)
    v.set_defaults(fn=cmd_show)

    d = sub.add_parser("demo", help="all stages on CDRs derived from the driver tables")
    common(d)
    d.add_argument("--sf-dir", required=True)
    d.add_argument("--out", required=True)
    d.set_defaults(fn=cmd_demo)
    return ap


def main(argv: list[str] | None = None) -> None:
    a = build_parser().parse_args(argv)
    spark = get_session(master=a.master) if a.master else SparkSession.builder.getOrCreate()
    apply_runtime_conf(spark)
    if a.broadcast_mb is not None:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(a.broadcast_mb * 1024 * 1024))
    if a.input_gb:
        from cdrflow.session import cluster_conf, parallelism

        for key, value in cluster_conf(int(a.input_gb * 1024**3), parallelism(spark)).items():
            spark.conf.set(key, value)
    a.fn(spark, a)


if __name__ == "__main__":
    main()
