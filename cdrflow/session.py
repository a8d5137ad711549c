"""Spark session defaults and the shared scratch location.

The library never creates a session behind the caller's back: operators
take DataFrames.  ``get_session`` is for tests, ``bench.py`` and the command
line; on a cluster the job submitter owns the session and its settings.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref

from pyspark.sql import SparkSession

# Settings that matter at scale, all of them standard Spark SQL options.
SCALE_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions (a single subscriber may own a third of all CDRs),
    # and turn a sort-merge join into a broadcast join when the measured
    # shuffle output of one side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot subscriber's partition even when that costs an extra
    # shuffle: after J1 the billing aggregate reuses the join's partitioning,
    # and without this AQE would rather keep one task with a third of the
    # data than add the (small, post-partial-aggregation) exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Static broadcast limit used by the planner, same value as the
    # reference's rating stage (10 MiB).
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    # Exact decimal money: fail loudly instead of silently nulling overflow.
    "spark.sql.ansi.enabled": "true",
    # Timestamps are wall-clock event times.
    "spark.sql.session.timeZone": "UTC",
    # Month partitions are rewritten one at a time, never the whole table.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Stage tables at 100 TB: zstd gives markedly smaller files than snappy
    # for the same scan speed.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole-stage codegen fuses a scan, the mediation predicates and the
    # pricing projection into one Java method; HotSpot by default refuses to
    # JIT-compile methods over 8000 bytes of bytecode and interprets them,
    # which made the fused stage 2-3x slower than no codegen at all.  Let the
    # JIT compile them (driver and executors).
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Shuffle and split settings for a run over ``input_bytes`` of CDRs.

    Shuffle partitions start at input / ``target_partition_bytes`` (at least
    twice the cores, so every core has work), and AQE coalesces the small
    ones at run time; each shuffle partition then fits comfortably in an
    executor's execution memory instead of spilling.  Scan splits stay at
    128-256 MB.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    split = 256 * 1024**2 if input_bytes >= 1024**4 else 128 * 1024**2
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


RUNTIME_CONF = {k: v for k, v in SCALE_CONF.items() if k.startswith("spark.sql.")}


def apply_runtime_conf(spark: SparkSession) -> None:
    """Give an existing session the SQL settings above, except those that the
    submitter has set.  JVM options cannot be changed any more; pass
    ``-XX:-DontCompileHugeMethods`` on submission."""
    given = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in RUNTIME_CONF.items():
        if key not in given:
            spark.conf.set(key, value)


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "cdrflow",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the scale settings above.

    ``master`` defaults to ``local[N]`` with N from ``$BENCH_CPUS`` or 8; it is
    only applied when no session exists yet.  Shuffle partitions and driver
    memory are set for a local master only, unless given: on a cluster they
    are the submitter's.
    """
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    local = master.startswith("local") and not master.startswith("local-cluster")
    parts = shuffle_partitions or (cpus if local else None)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    if local:
        builder = builder.config("spark.driver.memory", os.environ.get("CDRFLOW_DRIVER_MEMORY", "8g"))
    # On a cluster the submitter's JVM options stay as they are.
    settings = SCALE_CONF if local else RUNTIME_CONF
    for key, value in {**settings, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if local:
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared file system path
    (HDFS, object store) that survives executor loss; it is read, never
    replaced.  Only when it is unset on a local master (tests) is a temporary
    folder chosen and registered; on a cluster that is an error, because no
    executor would see the others' files.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect: the conf is the only source
            current = None
    if current:
        return current
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(
            f"set spark.checkpoint.dir to a folder that all executors share (master {master or 'unknown'})"
        )
    local = tempfile.mkdtemp(prefix="cdrflow-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(local)
    except Exception:
        pass
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


_SESSION_CACHES: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def application_id(spark: SparkSession) -> str:
    """The Spark application id (also available through Spark Connect)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def parallelism(spark: SparkSession) -> int:
    """Cores available to the application (default parallelism), or the
    shuffle partition count where the SparkContext is not reachable."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect has no SparkContext on the client
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def session_cache(spark: SparkSession) -> dict:
    """A dict that lives as long as ``spark`` (for plans defined once per
    session).  Keyed by the session object and its application id, so a
    stopped and re-created session never sees another session's plans."""
    per_session = _SESSION_CACHES.setdefault(spark, {})
    return per_session.setdefault(application_id(spark), {})
