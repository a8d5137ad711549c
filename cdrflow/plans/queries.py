"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)``, derives the CDR feed and the
subscriptions from the driver tables in ``sf_dir`` and returns a lazy
DataFrame.  Decimal money leaves as double (``finish``) so that results
compare across engines; everything upstream stays exact.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow import schemas
from cdrflow.functions.money import to_output
from cdrflow.functions.msisdn import is_valid_msisdn
from cdrflow.operators import billing, dedup, mediation, quality, rating, reports
from cdrflow.params import FIXTURE_MONTHS, FIXTURE_PARAMS
from cdrflow.plans.stages import Stages, shared_fixture_stages
from cdrflow.session import parallelism, scratch_path
from cdrflow.sources import cdr_json, dims, files
from cdrflow.sources.fixtures import fixture_cdrs, fixture_messages_dir, fixture_subscribers

Query = Callable[[SparkSession, str], DataFrame]


def finish(df: DataFrame) -> DataFrame:
    """Decimals -> double at the query boundary; other columns unchanged."""
    return df.select(
        *[
            to_output(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _st(spark: SparkSession, sf_dir: str, **changes) -> Stages:
    params = FIXTURE_PARAMS.with_(**changes) if changes else FIXTURE_PARAMS
    return shared_fixture_stages(spark, sf_dir, params)


# --- sources ------------------------------------------------------------------------

def q_decode_json(spark, sf_dir):
    """JSON wire text of every CDR, decoded with the fixed schema."""
    msgs = cdr_json.encode_cdr(fixture_cdrs(spark, sf_dir))
    return cdr_json.decode_cdr(msgs)


def q_encode_decode_roundtrip(spark, sf_dir):
    """Message key + JSON value per record; the value decodes back to the
    same record."""
    cdrs = fixture_cdrs(spark, sf_dir)
    cols = schemas.RAW_CDR.fieldNames()
    msgs = cdrs.select(
        F.struct(*cols).alias("orig"),
        cdr_json.message_key(F.col("record_ID")).alias("key"),
        F.to_json(F.struct(*cols), cdr_json.JSON_OPTIONS).alias("value"),
    )
    decoded = cdr_json.decode_cdr(msgs, keep=("orig", "key"))
    decoded = decoded.select("orig", "key", F.struct(*cols).alias("back"))
    same = None
    for c in cols:
        eq = F.col(f"orig.{c}").eqNullSafe(F.col(f"back.{c}"))
        same = eq if same is None else same & eq
    return decoded.select("key", F.col("orig.record_ID").alias("record_ID"), same.alias("roundtrip_ok"))


def q_dim_insert_absent(spark, sf_dir):
    """Insert-if-absent of a re-sent subscription extract.

    The table holds subscribers activated before July 2023; the incoming
    extract is every subscriber (twice, with names in upper case).  Existing
    rows stay as they are; the others are inserted once.
    """
    subs = fixture_subscribers(spark, sf_dir)
    existing = subs.filter(F.col("activation_date") < F.lit("2023-07-01").cast("date"))
    incoming = subs.withColumn("customer_name", F.upper("customer_name"))
    return dims.insert_absent(existing, incoming.unionByName(incoming), ["customer_id"])


def q_dim_merge(spark, sf_dir):
    """S12 stored: two overlapping loads into a table of key buckets.

    The first load holds subscribers activated before July 2023, the second
    every subscriber (twice, with names in upper case); the second is run again.
    """
    from cdrflow.sources.merge_store import MergeStore

    subs = fixture_subscribers(spark, sf_dir)
    table = MergeStore(spark, scratch_path(spark, "subscriptions"), schemas.SUBSCRIPTIONS, ("customer_id",), 2 * parallelism(spark))
    table.insert_absent(subs.filter(F.col("activation_date") < F.lit("2023-07-01").cast("date")), ["customer_id"], "first")
    incoming = subs.withColumn("customer_name", F.upper("customer_name"))
    for _ in range(2):
        table.insert_absent(incoming.unionByName(incoming), ["customer_id"], "second")
    return table.read()


def q_product_dim(spark, sf_dir):
    """The product catalog seed rows with the mediated traffic of each
    product (records and billable units).  A broadcast left join of the
    pre-aggregated traffic onto the catalog."""
    st = _st(spark, sf_dir)
    traffic = rating.with_billable_units(st.mediated()).groupBy("product_code").agg(
        F.count(F.lit(1)).alias("records"), F.sum("billable_units").alias("billable_units")
    )
    out = st.catalog.join(traffic, "product_code", "left").select(
        "product_code", "service_type", "unit", "rate_type",
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("billable_units", F.lit(0).cast(schemas.UNITS)).alias("billable_units"),
    )
    return finish(out)


def q_rate_plan_dim(spark, sf_dir):
    """The typed tariff rows with the records each row priced and
    the charge it produced."""
    st = _st(spark, sf_dir)
    used = billing.rated_only(st.rated()).groupBy("rate_plan_id", "product_code").agg(
        F.count(F.lit(1)).alias("records"), F.sum("cost").alias("charged")
    )
    out = dims.typed_rate_plans(st.plans).join(used, ["rate_plan_id", "product_code"], "left").select(
        "rate_plan_id", "product_code", "service_type", "unit_price", "free_units", "tier_threshold", "tier_price",
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("charged", F.lit(0).cast(schemas.MONEY)).alias("charged"),
    )
    return finish(out)


# --- mediation ------------------------------------------------------------------------

def q_filter_required(spark, sf_dir):
    """Records with a record type and an event time."""
    return mediation.require_fields(fixture_cdrs(spark, sf_dir))


def q_filter_fresh(spark, sf_dir):
    """P1+P2: required fields and freshness (admission)."""
    return _st(spark, sf_dir).admitted()


def q_split_by_type(spark, sf_dir):
    """Admitted records of the three types, other types' columns NULL."""
    return mediation.split_all(_st(spark, sf_dir).admitted())


def _clean(kind):
    fn = {"voice": mediation.clean_voice, "sms": mediation.clean_sms, "data": mediation.clean_data}[kind]

    def q(spark, sf_dir):
        admitted = _st(spark, sf_dir).admitted()
        return finish(fn(mediation.split_by_type(admitted, kind)))

    q.__doc__ = f"P14: cleaned {kind} records."
    return q


def q_mediated(spark, sf_dir):
    """The three cleaned streams in one frame (one pass)."""
    return finish(_st(spark, sf_dir).mediated())


def q_msisdn_validity(spark, sf_dir):
    """Number-plan validity of both parties, compat and strict modes."""
    cdrs = fixture_cdrs(spark, sf_dir)
    payer = F.coalesce("caller_id", "sender_id", "user_id")
    other = F.coalesce("callee_id", "receiver_id")
    return cdrs.select(
        "record_ID",
        "record_type",
        payer.alias("payer"),
        other.alias("other_party"),
        is_valid_msisdn(payer, "compat").alias("payer_valid"),
        is_valid_msisdn(other, "compat").alias("other_valid"),
        is_valid_msisdn(payer, "strict").alias("payer_valid_strict"),
        is_valid_msisdn(other, "strict").alias("other_valid_strict"),
    )


def q_technology_mix(spark, sf_dir):
    """Normalised technology by record type."""
    return (
        _st(spark, sf_dir).mediated().groupBy("record_type", "technology")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def q_voice_product(spark, sf_dir):
    """Voice product from the cleaned callee."""
    admitted = _st(spark, sf_dir).admitted()
    voice = mediation.clean_voice(mediation.split_by_type(admitted, "voice"))
    return voice.select("record_ID", "callee_id", "product_code")


def q_review_queue(spark, sf_dir):
    """Data records flagged for review."""
    m = _st(spark, sf_dir).mediated()
    return finish(
        m.filter(F.col("rating_status") == "needs_review").select(
            "record_ID", "user_id", "product_code", "data_volume_mb", "session_duration_sec", "rating_status"
        )
    )


def q_clean_data_export(spark, sf_dir):
    """Data records in the string export form with the UNK sentinel."""
    m = _st(spark, sf_dir).mediated().filter(F.col("record_type") == "data")
    return mediation.export_strings(m).select(
        "record_ID", "user_id", "product_code", "rating_status", "session_duration_sec", "data_volume_mb"
    )


def q_mediation_audit(spark, sf_dir):
    """Records admitted and kept per type."""
    return mediation.mediation_audit(_st(spark, sf_dir).admitted())


def q_dedup_cdr(spark, sf_dir):
    """T5: a micro-batch delivered twice (at-least-once replay) reduced to one
    copy per record, keeping the first delivery."""
    m = _st(spark, sf_dir).mediated()
    feed = m.withColumn("batch_id", F.lit(0).cast("long")).unionByName(
        m.withColumn("batch_id", F.lit(1).cast("long"))
    )
    return finish(dedup.dedup_records(feed, "record_ID", "batch_id"))


def q_stream_mediation(spark, sf_dir):
    """The CDR feed as JSON messages through the streaming mediation
    (file source, availableNow, a fresh checkpoint each run), read back from
    its Parquet sink."""
    from cdrflow.streaming.mediation_stream import run_until_done, start_mediation_stream

    root = scratch_path(spark, "stream-mediation")
    q = start_mediation_stream(
        spark,
        out_path=f"{root}/out",
        checkpoint=f"{root}/checkpoint",
        params=FIXTURE_PARAMS,
        fmt="text",
        source_path=fixture_messages_dir(spark, sf_dir),
        available_now=True,
    )
    run_until_done(q)
    return finish(files.read_mediated(spark, f"{root}/out").drop("event_month", "stream_id"))


def q_decode_json_times(spark, sf_dir):
    """The event time of every dated CDR in one of four spellings (chosen by
    the id): without a zone, with Z, with an offset, as epoch seconds."""
    cdrs = fixture_cdrs(spark, sf_dir).filter(F.col("timestamp").isNotNull())
    kind = F.col("record_ID").cast("long") % 4
    iso = lambda t: F.replace(t.cast("string"), F.lit(" "), F.lit("T"))
    since = F.col("timestamp") - F.lit("1970-01-01 00:00:00").cast(schemas.EVENT_TIME)
    part = lambda unit: F.extract(F.lit(unit), since).cast("long")
    epoch = ((part("DAY") * 24 + part("HOUR")) * 60 + part("MINUTE")) * 60 + F.floor(F.extract(F.lit("SECOND"), since))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    spelled = (
        F.when(kind == 0, quoted(iso(F.col("timestamp"))))
        .when(kind == 1, quoted(F.concat(iso(F.col("timestamp")), F.lit("Z"))))
        .when(kind == 2, quoted(F.concat(iso(F.col("timestamp") + hour), F.lit("+01:00"))))
        .otherwise(epoch.cast("string"))
    )
    message = F.concat(F.lit('{"record_ID":"'), F.col("record_ID"), F.lit('","timestamp":'), spelled, F.lit("}"))
    return cdr_json.decode_cdr(cdrs.select(message.alias("value"))).select("record_ID", "timestamp")


def q_dedup_cdr_dirty(spark, sf_dir):
    """T5: every seventh record without an id, and every third delivered again in
    a later batch with another cell.  A record with an id keeps its first
    delivery; without one only equal content counts as the same record."""
    number = F.col("record_ID").cast("long")
    m = _st(spark, sf_dir).mediated().withColumn("_n", number)
    first = m.withColumn("batch_id", F.lit(0).cast("long"))
    again = first.unionByName(m.filter("_n % 3 = 0").withColumns({"cell_id": F.lit("CELL_RE"), "batch_id": F.lit(1).cast("long")}))
    feed = again.withColumn("record_ID", F.when(F.col("_n") % 7 != 0, F.col("record_ID"))).drop("_n")
    return finish(dedup.dedup_records(feed.unionByName(feed.filter("batch_id = 0")), "record_ID", "batch_id"))


def _dedup_stream(spark, sf_dir, dedup: str):
    """The feed in two overlapping parts over several micro-batches: every third
    record comes twice, the second time 40 days later by its event time."""
    from cdrflow.streaming.mediation_stream import run_until_done, start_mediation_stream

    root = scratch_path(spark, f"stream-dedup-{dedup}")
    cdrs = fixture_cdrs(spark, sf_dir)
    batch_files = str(max(1, parallelism(spark) // 2))  # the feed has a file a core
    later = F.when(F.col("timestamp") >= F.lit(FIXTURE_PARAMS.as_of), F.col("timestamp") + F.make_dt_interval(F.lit(40)))
    again = F.when(F.col("record_ID") % 3 == 1, F.coalesce(later, "timestamp")).otherwise(F.col("timestamp"))
    parts = (cdrs.filter("record_ID % 3 <> 2"), cdrs.filter("record_ID % 3 <> 0").withColumn("timestamp", again))
    for part in parts:
        cdr_json.write_cdr_messages(part, fmt="text", path=f"{root}/in")
        q = start_mediation_stream(
            spark, out_path=f"{root}/out", checkpoint=f"{root}/checkpoint", params=FIXTURE_PARAMS, fmt="text",
            source_path=f"{root}/in", source_options={"maxFilesPerTrigger": batch_files}, available_now=True, dedup=dedup,
        )
        run_until_done(q)
    return finish(files.read_mediated(spark, f"{root}/out").drop("event_month", "stream_id", "batch_id"))


def q_stream_dedup(spark, sf_dir):
    """Each record is stored once, known by its id among all that the store
    holds; event times jump back and forth, and none is dropped for being late."""
    return _dedup_stream(spark, sf_dir, "store")


def q_stream_dedup_state(spark, sf_dir):
    """The same with keyed streaming state, over a restart of the query."""
    return _dedup_stream(spark, sf_dir, "state")


def _fine(spark, sf_dir) -> Stages:
    """Stages over the same feed with volumes of up to six decimals, some just
    above an allowance (100.996 MB) and some out of range (1e13 MB)."""
    from dataclasses import replace

    st = _st(spark, sf_dir)
    n, wide = F.col("record_ID").cast("long"), "decimal(18,6)"
    micro = (n % 1_000_000).cast(wide) * F.lit(Decimal("0.000001"))
    fine = (F.col("data_volume_mb").cast(wide) + micro).cast("double")
    volume = F.when(n % 17 == 0, F.lit(1e13)).when(n % 23 == 0, F.lit(100.996)).otherwise(fine)
    raw = st.raw.withColumn("data_volume_mb", F.when(F.col("data_volume_mb").isNotNull(), volume))
    return replace(st, raw=raw, reuse_plans=False, _plans={})


def q_billable_units_fine(spark, sf_dir):
    """Billable units at full precision; out-of-range volumes count as
    missing and are flagged for review."""
    r = _fine(spark, sf_dir).rated()
    return finish(r.select("record_ID", "record_type", "product_code", "billable_units", "review_flag"))


def q_rated_cost_fine(spark, sf_dir):
    """R7 on volumes of up to six decimals: limits compare whole units."""
    return finish(_fine(spark, sf_dir).rated().select(*RATED_OUT))


def q_rated_store_roundtrip(spark, sf_dir):
    """Rated records stored by month and read back.  One month is rated
    again with fewer records and one with none: exactly those two change."""
    path = scratch_path(spark, "rated-store")
    rated = _st(spark, sf_dir).rated()
    files.write_rated(rated, path)
    rerun = rated.filter((F.col("billing_period") == "2024-02") & (F.col("record_type") == "voice"))
    files.write_rated(rerun, path, months=["2024-02", "2024-03"])
    return finish(files.read_rated(spark, path).select(*RATED_OUT))


def q_rated_clustered(spark, sf_dir):
    """Rated records stored by month, then clustered by subscriber within
    each month, and read back."""
    path = scratch_path(spark, "rated-clustered")
    files.write_rated(_st(spark, sf_dir).rated(), path)
    files.compact_partitions(
        spark, path, schemas.RATED, ["billing_period"], files_per_partition=2, cluster_by=["customer_id", "record_ID"]
    )
    spark.catalog.refreshByPath(path)
    return finish(files.read_rated(spark, path).select(*RATED_OUT))


def q_report_csv_roundtrip(spark, sf_dir):
    """The revenue report written as CSV with a header and read back."""
    path = f"{scratch_path(spark, 'report')}/revenueByPlan.csv"
    files.write_report(finish(reports.revenue_by_plan(_st(spark, sf_dir).invoices())), path, single_file=True)
    return spark.read.option("header", True).schema("rate_plan_id string, revenue_TTC double").csv(path)


# --- rating ------------------------------------------------------------------------------

def _keyed(st: Stages) -> DataFrame:
    return rating.with_customer_id(st.mediated())


def q_customer_key(spark, sf_dir):
    """Subscriber key of the paying party."""
    return _keyed(_st(spark, sf_dir)).select("record_ID", "record_type", "customer_id")


def q_eligible_customers(spark, sf_dir):
    """Active postpaid subscriptions."""
    return rating.eligible(fixture_subscribers(spark, sf_dir), ("customer_id", "region", "rate_plan_id"))


def q_cdr_with_plan(spark, sf_dir):
    """CDRs of eligible subscribers with their rate plan."""
    st = _st(spark, sf_dir)
    return rating.join_plan(_keyed(st), st.subscriptions).select(
        "record_ID", "customer_id", "rate_plan_id", "product_code"
    )


def q_cdr_with_catalog(spark, sf_dir):
    """Plus the product's rate type and unit."""
    st = _st(spark, sf_dir)
    j = rating.join_catalog(rating.join_plan(_keyed(st), st.subscriptions), st.catalog, st.dims_trusted_small)
    return j.select("record_ID", "customer_id", "rate_plan_id", "product_code", "rate_type", "unit")


def q_cdr_with_tariff(spark, sf_dir):
    """Plus the typed tariff row of (plan, product)."""
    st = _st(spark, sf_dir)
    trusted = st.dims_trusted_small
    j = rating.join_tariff(
        rating.join_catalog(rating.join_plan(_keyed(st), st.subscriptions), st.catalog, trusted), st.plans, trusted
    )
    return finish(
        j.select(
            "record_ID", "customer_id", "rate_plan_id", "product_code", "rate_type",
            "unit_price", "free_units", "tier_threshold", "tier_price",
        )
    )


def q_billable_units(spark, sf_dir):
    """Billable units per rated record."""
    r = _st(spark, sf_dir).rated()
    return finish(r.select("record_ID", "record_type", "product_code", "billable_units"))


RATED_OUT = [
    "record_ID", "record_type", "customer_id", "rate_plan_id", "product_code", "rate_type",
    "billable_units", "cost", "rating_status", "review_flag", "billing_period",
]


def q_rated_cost(spark, sf_dir):
    """R7 (whole-unit boundaries): every joined record with cost and status."""
    return finish(_st(spark, sf_dir).rated().select(*RATED_OUT))


def q_rated_cost_exact(spark, sf_dir):
    """R7 with exact decimal boundaries."""
    return finish(_st(spark, sf_dir, boundary="exact").rated().select(*RATED_OUT))


def q_rated_flat(spark, sf_dir):
    """Records of flat-rated products."""
    r = _st(spark, sf_dir).rated()
    return finish(r.filter(F.col("rate_type") == "flat").select(*RATED_OUT))


def q_rated_tiered(spark, sf_dir):
    """Records of tiered products."""
    r = _st(spark, sf_dir).rated()
    return finish(r.filter(F.col("rate_type") == "tiered").select(*RATED_OUT))


def q_rating_status_mix(spark, sf_dir):
    """Final status by product and review flag."""
    r = _st(spark, sf_dir).rated()
    return r.groupBy("rating_status", "review_flag", "product_code").agg(F.count(F.lit(1)).alias("records"))


def q_usage_by_period(spark, sf_dir):
    """Rated usage per billing month and product."""
    r = billing.rated_only(_st(spark, sf_dir).rated())
    return finish(
        r.groupBy("billing_period", "product_code").agg(
            F.count(F.lit(1)).alias("records"),
            F.sum("billable_units").alias("total_units"),
            F.sum("cost").alias("total_cost"),
        )
    )


# --- billing --------------------------------------------------------------------------------

def q_invoice_subtotals(spark, sf_dir):
    """A1: conditional sums per subscriber and month (all months)."""
    return finish(billing.invoice_subtotals(_st(spark, sf_dir).rated()))


def q_invoice_totals(spark, sf_dir):
    """B1: discount, tax, fee and rounded amount due (all months)."""
    return finish(billing.invoice_totals(_st(spark, sf_dir).rated(), FIXTURE_PARAMS))


def q_invoice_month(spark, sf_dir):
    """One invoice per eligible subscriber for the month."""
    return finish(_st(spark, sf_dir).invoices())


def q_invoice_all_months(spark, sf_dir):
    """B2 over several months."""
    return finish(_st(spark, sf_dir).invoices(FIXTURE_MONTHS))


def _bucketed(spark, sf_dir):
    from cdrflow.sources.bucketed import BucketedStore

    st = _st(spark, sf_dir)
    root = scratch_path(spark, "bucketed")
    store = BucketedStore(spark, root, 2 * parallelism(spark), name=root.rsplit("/", 1)[-1].replace("-", "_"))
    store.store_subscriptions(st.subscriptions)
    store.store_records(st.mediated())
    store.rate(st.catalog, st.plans, st.params, dims_trusted_small=True)
    return store


def q_invoice_bucketed(spark, sf_dir):
    """J1/A1/B2 on tables bucketed by subscriber: records, subscriptions and rated
    records are stored in equal buckets, rated and billed without a shuffle."""
    return finish(_bucketed(spark, sf_dir).invoices(FIXTURE_MONTHS, FIXTURE_PARAMS))


def q_invoice_incremental(spark, sf_dir):
    """The feed rated and billed in three batches, the second of them
    twice; only subscribers with new records are priced again."""
    from cdrflow.plans.incremental import IncrementalBilling

    st = _st(spark, sf_dir)
    store = IncrementalBilling(spark, scratch_path(spark, "incremental"), FIXTURE_PARAMS, 2 * parallelism(spark))
    for k in (0, 1, 1, 2):
        batch = st.mediated().filter(F.pmod(F.xxhash64("record_ID"), F.lit(3)) == k)
        store.add_batch(batch, f"feed-{k}", st.subscriptions, st.catalog, st.plans, dims_trusted_small=True)
    return finish(store.invoices(st.subscriptions, FIXTURE_MONTHS))


# --- reports ----------------------------------------------------------------------------------

def q_top_customers(spark, sf_dir):
    """Subscribers with data charges, by data charges."""
    return finish(reports.top_customers(_st(spark, sf_dir).invoices()))


def q_report_order(spark, sf_dir):
    """O1/O2: the places of all rows of the three sorted reports."""
    inv = _st(spark, sf_dir).invoices()
    none = F.lit(None).cast("string")
    tops = reports.ranked(reports.top_customers(inv)).select(F.lit("customers").alias("report"), F.col("customer_id").alias("k1"), none.alias("k2"), "rank")
    plans = reports.ranked(reports.revenue_by_plan(inv)).select(F.lit("plans"), "rate_plan_id", none, "rank")
    regions = reports.ranked(reports.revenue_by_region_plan(inv)).select(F.lit("regions"), "region", "rate_plan_id", "rank")
    return tops.union(plans).union(regions)


def q_revenue_by_plan(spark, sf_dir):
    """A3/O1: revenue including tax per plan."""
    return finish(reports.revenue_by_plan(_st(spark, sf_dir).invoices()))


def q_revenue_by_region_plan(spark, sf_dir):
    """A4/O2: revenue per region and plan."""
    return finish(reports.revenue_by_region_plan(_st(spark, sf_dir).invoices()))


def q_product_cost(spark, sf_dir):
    """Per product floored total, count and exact average."""
    return finish(reports.product_cost(_st(spark, sf_dir).rated()))


def q_product_cost_double(spark, sf_dir):
    """A5 with the reference's double money (its floating-point cents)."""
    st = _st(spark, sf_dir, money="double")
    return reports.product_cost(st.rated(), "double")


# --- data quality -------------------------------------------------------------------------------

def q_dq_keys(spark, sf_dir):
    """Primary-key and NOT NULL checks as violation counts (one pass per
    table for both checks)."""
    st = _st(spark, sf_dir)
    checks = [
        quality.key_and_null_checks(st.raw, "cdr_feed", ["record_ID"], ["record_type", "timestamp"]),
        quality.key_and_null_checks(
            st.subscriptions, "subscriptions", ["customer_id"],
            ["customer_id", "customer_name", "activation_date", "subscription_type", "status"],
        ),
        quality.summarize(
            "duplicate_key", "rate_plans:rate_plan_id,product_code",
            quality.key_violations(st.plans, ["rate_plan_id", "product_code"]),
        ),
        quality.summarize(
            "duplicate_key", "product_catalog:product_code", quality.key_violations(st.catalog, ["product_code"])
        ),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def q_dq_orphans(spark, sf_dir):
    """Foreign-key style orphans and records that rating cannot price.

    The three CDR checks share one pass over the feed
    (``quality.cdr_orphan_report``); the dimension checks are anti joins of
    the small tables."""
    st = _st(spark, sf_dir)
    elig = rating.eligible(st.subscriptions, ("customer_id", "rate_plan_id"))
    report = quality.cdr_orphan_report(
        _keyed(st), elig, st.catalog, st.plans, trusted_dims=st.dims_trusted_small
    )
    return report.unionByName(
        quality.orphan_counts("subscription_plan_unknown", st.subscriptions, st.plans, ["rate_plan_id"], "rate_plan_id")
    ).unionByName(
        quality.orphan_counts("tariff_product_not_in_catalog", st.plans, st.catalog, ["product_code"], "product_code")
    )


QUERIES: dict[str, Query] = {
    "decode_json": q_decode_json,
    "decode_json_times": q_decode_json_times,
    "encode_decode_roundtrip": q_encode_decode_roundtrip,
    "dim_insert_absent": q_dim_insert_absent,
    "dim_merge": q_dim_merge,
    "product_dim": q_product_dim,
    "rate_plan_dim": q_rate_plan_dim,
    "filter_required": q_filter_required,
    "filter_fresh": q_filter_fresh,
    "split_by_type": q_split_by_type,
    "clean_voice": _clean("voice"),
    "clean_sms": _clean("sms"),
    "clean_data": _clean("data"),
    "mediated": q_mediated,
    "msisdn_validity": q_msisdn_validity,
    "technology_mix": q_technology_mix,
    "voice_product": q_voice_product,
    "review_queue": q_review_queue,
    "clean_data_export": q_clean_data_export,
    "mediation_audit": q_mediation_audit,
    "dedup_cdr": q_dedup_cdr,
    "dedup_cdr_dirty": q_dedup_cdr_dirty,
    "stream_dedup": q_stream_dedup,
    "stream_dedup_state": q_stream_dedup_state,
    "stream_mediation": q_stream_mediation,
    "customer_key": q_customer_key,
    "eligible_customers": q_eligible_customers,
    "cdr_with_plan": q_cdr_with_plan,
    "cdr_with_catalog": q_cdr_with_catalog,
    "cdr_with_tariff": q_cdr_with_tariff,
    "billable_units": q_billable_units,
    "billable_units_fine": q_billable_units_fine,
    "rated_cost": q_rated_cost,
    "rated_cost_fine": q_rated_cost_fine,
    "rated_cost_exact": q_rated_cost_exact,
    "rated_flat": q_rated_flat,
    "rated_tiered": q_rated_tiered,
    "rating_status_mix": q_rating_status_mix,
    "usage_by_period": q_usage_by_period,
    "rated_store_roundtrip": q_rated_store_roundtrip,
    "rated_clustered": q_rated_clustered,
    "invoice_subtotals": q_invoice_subtotals,
    "invoice_totals": q_invoice_totals,
    "invoice_month": q_invoice_month,
    "invoice_all_months": q_invoice_all_months,
    "invoice_bucketed": q_invoice_bucketed,
    "invoice_incremental": q_invoice_incremental,
    "top_customers": q_top_customers,
    "report_order": q_report_order,
    "revenue_by_plan": q_revenue_by_plan,
    "revenue_by_region_plan": q_revenue_by_region_plan,
    "report_csv_roundtrip": q_report_csv_roundtrip,
    "product_cost": q_product_cost,
    "product_cost_double": q_product_cost_double,
    "dq_keys": q_dq_keys,
    "dq_orphans": q_dq_orphans,
}
