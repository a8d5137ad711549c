"""Keyed tables that are merged in place: copy on write by key bucket.

Rows lie in hash buckets of their key.  A merge reads the buckets that its rows
fall into, writes new files of those that change, and then one manifest that
names the folder of every bucket.  Readers follow the newest manifest, so they
see a merge whole or not at all; buckets without new rows are neither read
nor written.  A merge that dies before its manifest leaves files that nothing
names, and is simply run again.

A merge can carry a label (a stream and batch).  The manifests are the ledger
of the labels applied: a label that is there is not applied again.

One merge of a table runs at a time; a second one that started from the same
version finds its manifest taken and fails without effect.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.session import application_id
from cdrflow.sources.dims import insert_absent
from cdrflow.sources.files import conform, stage_table

_MANIFEST = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("folder", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("version", T.LongType()),
    ]
)

_made: set[tuple[str, str]] = set()  # manifest folders that this process has made or seen


@dataclass(frozen=True)
class MergeStore:
    """A table at ``root`` with ``schema``, in ``n_buckets`` buckets of ``bucket_by``.

    ``bucket_by`` are key columns whose equal values belong together.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    bucket_by: tuple[str, ...]
    n_buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.n_buckets)).cast("int")

    # -- manifests: a row for each bucket and version

    def _manifests(self) -> DataFrame:
        path = f"{self.root}/manifest"
        if (mine := (application_id(self.spark), path)) not in _made:
            # The folder must be there to be read; this writes no rows.
            none = self.spark.createDataFrame([], _MANIFEST)
            none.write.mode("append").partitionBy("version").parquet(path)
            _made.add(mine)
        return self.spark.read.schema(_MANIFEST).parquet(path)

    def newest(self) -> tuple[int, dict[int, str]]:
        """The newest version, 0 before the first, and the folder of each bucket that has rows."""
        at = F.collect_list(F.struct("bucket", "folder")).alias("at")  # n_buckets at most
        row = self._manifests().groupBy("version").agg(at).orderBy(F.desc("version")).first()
        return (row.version, {b: f for b, f in row["at"] if f is not None}) if row else (0, {})

    def version(self) -> int:
        return self.newest()[0]

    def folders(self) -> dict[int, str]:
        return self.newest()[1]

    def applied(self, label: str) -> bool:
        return not self._manifests().filter(F.col("label") == label).isEmpty()

    # -- reading

    def read(self, buckets: list[int] | None = None, at: dict[int, str] | None = None) -> DataFrame:
        """The table, or only some buckets of it (of the newest version, or as ``at`` says)."""
        at = self.folders() if at is None else at
        paths = [f"{at[b]}/bucket={b}" for b in sorted(at) if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    # -- merging

    def merge(
        self, incoming: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], label: str | None = None
    ) -> list[int]:
        """Replace each bucket that ``incoming`` has rows for by ``combine(stored,
        incoming)`` of it; the buckets that were written.

        ``combine`` gets the rows of those buckets and must keep rows in their bucket.
        """
        if label is not None and self.applied(label):
            return []
        started, at = self.newest()
        rows = stage_table(conform(incoming, self.schema), "merge-incoming")
        touched = [r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect()]
        if touched:
            self._write(combine(self.read(touched, at), rows), started, at, touched, label)
        elif label is not None:
            self._switch(started, at, label)
        return touched

    def insert_absent(self, incoming: DataFrame, keys: list[str], label: str | None = None) -> list[int]:
        """S12 stored: rows whose key is not there yet.  Only buckets that get rows
        are written; of equal keys in ``incoming`` the smallest row is taken."""
        if label is not None and self.applied(label):
            return []
        started, at = self.newest()
        rows = stage_table(conform(incoming, self.schema), "merge-incoming")
        asked = [r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect()]
        none = self.spark.createDataFrame([], self.schema)
        first = insert_absent(none, rows, keys)
        new = stage_table(first.join(self.read(asked, at).select(*keys), keys, "left_anti").select(*self.schema.names), "merge-new")
        touched = [r[0] for r in new.select(self.bucket().alias("b")).distinct().collect()]
        if touched:
            self._write(self.read(touched, at).unionByName(new), started, at, touched, label)
        elif label is not None:
            self._switch(started, at, label)
        return touched

    def _write(self, rows: DataFrame, started: int, at: dict[int, str], touched: list[int], label: str | None) -> None:
        folder = f"{self.root}/data/{started + 1:012d}-{uuid.uuid4().hex[:12]}"
        out = conform(rows, self.schema).withColumn("bucket", self.bucket())
        tasks = min(self.n_buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        out.repartition(tasks, "bucket").sortWithinPartitions("bucket", *self.bucket_by).write.partitionBy("bucket").parquet(folder)
        found = T.StructType([*self.schema.fields, _MANIFEST["bucket"]])
        left = {r[0] for r in self.spark.read.schema(found).parquet(folder).select("bucket").distinct().collect()}
        kept = {b: f for b, f in at.items() if b not in touched}
        self._switch(started, {**kept, **dict.fromkeys(left, folder)}, label)

    def _switch(self, started: int, at: dict[int, str], label: str | None) -> None:
        """Write the manifest of the next version: one file, there or not."""
        rows = [(b, f, label) for b, f in sorted(at.items())] or [(0, None, label)]
        manifest = self.spark.createDataFrame(rows, "bucket int, folder string, label string").coalesce(1)
        manifest.write.mode("error").parquet(f"{self.root}/manifest/version={started + 1}")
