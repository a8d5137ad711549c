"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrflow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()

# Rows that a Python worker gets at once: texts are long, and a batch is held
# in several forms (Arrow, strings, arrays) at a time.
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application, and
    make the batches that it gets small (unless the session says otherwise).

    Functions that run there are imported by name; this makes them available
    wherever the job was started from.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    if spark.conf.get(_ARROW_ROWS) == "10000":  # the default
        spark.conf.set(_ARROW_ROWS, "500")
    package = Path(__file__).resolve().parent.parent
    bundle = Path(tempfile.mkdtemp()) / f"{package.name}-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(bundle, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(bundle))
    _shipped.add(app)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and scan it again.

    The table is read, not recomputed, by every later job, and a lost
    executor costs no more than the tasks that it was running.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_arrays(spark: SparkSession, value):
    """Broadcast a value whose size the caller has bounded."""
    return spark.sparkContext.broadcast(value)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{stem}_{uuid.uuid4().hex[:6]}"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body).getItem(0)
