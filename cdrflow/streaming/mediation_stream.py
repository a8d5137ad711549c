"""Structured Streaming mediation with a replay-safe sink.

Source -> JSON decode -> admission (required fields, freshness) ->
``foreachBatch``: one mediation pass per micro-batch, written as Parquet
partitioned by (event_month, record_type, stream_id, batch_id).

Exactly-once effect: the checkpoint records which offsets belong to which
epoch; a replayed epoch re-runs ``process`` with the same id and the same
rows, and the dynamic partition overwrite replaces exactly the partitions
that epoch wrote before.  ``stream_id`` is the id that the checkpoint gives the
query, so a second stream, or a new checkpoint, that writes to the same folder
adds its own partitions and never replaces those of another.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cdrflow.operators.dedup import absent_from, dedup_records
from cdrflow.operators.mediation import admission_condition, admit, audit_metrics, cleaned, with_keep
from cdrflow.params import Params
from cdrflow.schemas import MEDIATED_COLUMNS
from cdrflow.session import ensure_checkpoint_dir
from cdrflow.sources import id_index
from cdrflow.sources.cdr_json import decode_cdr, read_cdr_stream
from cdrflow.sources.files import BATCH_STREAM, ensure_mediated, event_month, read_mediated, write_mediated

log = logging.getLogger(__name__)


def stream_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The query id that Spark keeps in the checkpoint's metadata file."""
    text = "".join(r["value"] for r in spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect())
    return json.loads(text)["id"]


def new_records(out: DataFrame, out_path: str, stream: str, epoch_id: int, n_buckets: int) -> DataFrame:
    """``out`` without records that the store already holds from an earlier batch.

    Each record keeps its first delivery.  A record_ID is looked up in the index
    of the store's ids, whatever event time it is sent with; the new ids are
    claimed there.  Records without one are equal in all columns, so of these
    only the folders of the batch's own months and its range of event times are
    read (row groups outside are skipped by their statistics).  Nothing is
    dropped for being late.  What this epoch and later ones of the stream have
    stored is left aside, so a replayed epoch decides as it did before.
    """
    spark = out.sparkSession
    first = dedup_records(out, "record_ID", "batch_id")
    keyed = F.col("record_ID").isNotNull()
    nameless = lambda c: F.when(~keyed, F.col(c))
    # One row: the buckets of the ids, counts, and the months of records without an id.
    facts = out.agg(
        F.collect_set(F.when(keyed, id_index.bucket_of(n_buckets))).alias("buckets"),
        F.count("record_ID").alias("keyed"),
        F.count(F.lit(1)).alias("all"),
        F.min(nameless("timestamp")).alias("start"),
        F.max(nameless("timestamp")).alias("end"),
        F.collect_set(nameless("event_month")).alias("months"),
    ).first()
    ids = out.filter(keyed).select("record_ID").distinct()
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/known-ids-{stream}"
    found = id_index.known_ids(ids, out_path, stream, epoch_id, n_buckets, facts["buckets"], facts["keyed"])
    found.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
    known = spark.read.schema("record_ID string").parquet(folder)
    id_index.claim(ids.join(known, "record_ID", "left_anti"), out_path, stream, epoch_id, n_buckets)
    fresh = first.join(known, "record_ID", "left_anti")  # a null id is in no table of ids
    if facts["keyed"] == facts["all"]:
        return fresh
    stored = read_mediated(spark, out_path)
    near = F.col("event_month").isin(facts["months"]) & F.col("timestamp").between(F.lit(facts["start"]), F.lit(facts["end"]))
    own = (F.col("stream_id") == stream) & (F.col("batch_id") >= epoch_id)
    whole = stored.filter(near & ~keyed & ~own).select(*MEDIATED_COLUMNS)
    return fresh.filter(keyed).unionByName(absent_from(fresh.filter(~keyed), whole, "record_ID", MEDIATED_COLUMNS))


def mediation_batch_writer(
    out_path: str,
    params: Params = Params(),
    on_metrics: Callable[[int, dict], None] | None = None,
    checkpoint: str | None = None,
    dedup: bool = False,
    id_buckets: int = id_index.BUCKETS,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: mediate one micro-batch and write it.

    An empty batch stores and reports nothing.  Counts per type before and after cleaning
    are collected with ``observe`` during the write itself (no extra pass over
    the batch).  With ``dedup`` records that were delivered before are left out;
    ``id_buckets`` is the number of buckets of a new index of ids.
    """
    known: dict[str, int] = {}

    def process(batch: DataFrame, epoch_id: int) -> None:
        stream = stream_id_of(batch.sparkSession, checkpoint) if checkpoint else BATCH_STREAM
        obs = Observation(f"mediation_{epoch_id}")
        observed = with_keep(batch, params.msisdn_mode).observe(obs, *audit_metrics())
        out = cleaned(observed, params.msisdn_mode).withColumns(
            {
                "event_month": event_month(),
                "stream_id": F.lit(stream),
                "batch_id": F.lit(epoch_id).cast("long"),
            }
        )
        if dedup:
            # The batch is read once, into a folder that the next batch reuses;
            # its records are compared from there.
            spark = batch.sparkSession
            folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/micro-batch-{stream}"
            out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
            if not obs.get["total"]:
                return
            if not known:
                ensure_mediated(spark, out_path)
                known["buckets"] = id_index.ensure_index(spark, out_path, id_buckets)
            staged = spark.read.schema(out.schema).parquet(folder)
            out = new_records(staged, out_path, stream, epoch_id, known["buckets"])
            # The shuffle by id has spread every folder over all tasks: a few files a folder instead.
            out = out.hint("rebalance", "event_month", "record_type")
        write_mediated(out, out_path, mode="overwrite")
        metrics = obs.get
        if not metrics["total"]:
            return
        log.info("mediation batch %s: %s", epoch_id, metrics)
        if on_metrics is not None:
            on_metrics(epoch_id, dict(metrics))

    return process


def admitted_stream(raw_messages: DataFrame, params: Params = Params()) -> DataFrame:
    """Decoded and admitted stream.

    Messages decoded and messages admitted per micro-batch (malformed JSON,
    missing type or time, stale records are the difference) are observed on
    the stream itself and reported as ``observedMetrics["cdr_admission"]`` in
    each query progress.  There is no watermark: late records are dropped by
    the freshness date alone.
    """
    decoded = decode_cdr(raw_messages).observe(
        "cdr_admission",
        F.count(F.lit(1)).alias("decoded"),
        F.count(F.when(admission_condition(params.as_of), F.lit(1))).alias("admitted"),
    )
    return admit(decoded, params.as_of)


#: How long re-deliveries are recognised by ``dedup="state"``.
DEDUP_DELAY = "7 days"
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Each batch uploads its changes only; full snapshots follow in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def first_arrivals(stream: DataFrame, delay: str = DEDUP_DELAY) -> DataFrame:
    """The stream without records that came before, no longer than ``delay`` ago.

    Keyed streaming state: an id is held from its first arrival until ``delay``
    has passed, then forgotten, so the state is bounded by the traffic of that
    time, not by the store.  The watermark follows the arrival time of the
    micro-batches, not the event time: a re-delivery is recognised whatever
    event time it carries, and no record is dropped for being late.  A record
    without an id is known by its whole content.
    """
    whole = F.sha2(F.to_json(F.struct(*stream.columns), {"ignoreNullFields": "false"}), 256)
    named = F.concat(F.lit("k"), F.col("record_ID"))
    return (
        stream.withColumns({"_identity": F.coalesce(named, whole), "_arrived": F.current_timestamp()})
        .withWatermark("_arrived", delay)
        .dropDuplicatesWithinWatermark(["_identity"])
        .drop("_identity", "_arrived")
    )


def start_mediation_stream(
    spark: SparkSession,
    out_path: str,
    checkpoint: str,
    params: Params = Params(),
    fmt: str = "kafka",
    source_options: dict[str, str] | None = None,
    source_path: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    dedup: bool | str = False,
    on_metrics: Callable[[int, dict], None] | None = None,
    query_name: str | None = None,
    id_buckets: int = id_index.BUCKETS,
    dedup_delay: str = DEDUP_DELAY,
) -> StreamingQuery:
    """Start the mediation query; the caller awaits or stops it.

    ``dedup`` is False, "store" (or True: a record is looked up among all that
    the table holds, see ``new_records``) or "state" (within ``dedup_delay`` of
    its first arrival, see ``first_arrivals``).  A checkpoint belongs to one of
    these; "state" keeps its ids in RocksDB under the checkpoint.

    ``available_now`` processes what is in the source and stops (tests,
    catch-up runs); otherwise the default micro-batch trigger or
    ``processing_time`` runs until ``stop()``.
    """
    raw = read_cdr_stream(spark, fmt, source_options, source_path)
    stream = admitted_stream(raw, params)
    state = dedup == "state"
    if state:
        stream = first_arrivals(stream, dedup_delay)
    write = mediation_batch_writer(out_path, params, on_metrics, checkpoint, bool(dedup) and not state, id_buckets)
    writer = (
        stream.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return _started(spark, writer, _STATE_CONF if state else {})


def _started(spark: SparkSession, writer, conf: dict[str, str]) -> StreamingQuery:
    """Start a query with settings of its own: it copies the session's at the start."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_until_done(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for a query; stop it on timeout or error and re-raise the error."""
    try:
        finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
        if finished is False:
            query.stop()
    except Exception:
        query.stop()
        raise
    err = query.exception()
    if err is not None:
        raise RuntimeError(f"stream failed: {err}")
