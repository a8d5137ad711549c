"""Token ids on disk with keyed access: raw id files under a minimal perfect hash.

Writing.  Documents are ranged by key over tasks (the text's hash and the
row's place split a key that many rows share), sorted, encoded and appended as
little-endian ids to one ``.bin`` file per task: nothing but ids, two bytes
each where the vocabulary allows, else four.  Three Parquet tables beside
them are written through Spark's commit protocol: ``entries`` (where each
document lies), ``shards`` (file, first id and width of each shard) and
``index``.  A task that runs twice leaves a file that no table names.

Index.  Entries are dealt by key hash to buckets of about ``BUCKET`` keys.
Each bucket gets a minimal perfect hash: level after level, keys that are
alone in their cell of a bit array set its bit, the others go on to the next
level; the rank of a key's bit is its slot.  A slot holds a fingerprint of 32
bits, the shard, the offset and the length.  A look-up computes the bucket,
the few level bits and the slot; the key itself is not stored, and a wrong
fingerprint means that the key is absent (a stranger passes with 2^-32).

Reading.  Keys go to their buckets, are looked up in arrays, and the places
found are read shard by shard in offset order, neighbours in one request.

Defined results: null and empty texts are documents of the end id alone;
documents with equal keys are numbered by ``occurrence`` (0 first) in file
order, each with its own slot; a null key is a key of its own and stands
first; an empty table gives an empty store, in which every key is absent.
Other columns are ignored.  ``path`` must be a folder that all executors share
and that Arrow's file systems can open (a path or a URI).
"""

from __future__ import annotations

import json
import os
import re
import string
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cdrflow.llm.common import scratch_path
from cdrflow.llm.fit_packing import _byte_letters

BUCKET = 1 << 16  # keys a bucket, on average
GAMMA = 2.0  # cells a key in each level of the hash
MAX_LEVELS = 64
READ_BYTES = 8 << 20  # neighbouring documents are read together up to this

_WORDS = 400_000  # words that each half of what a worker remembers holds
_LONG = 64  # longer ones are not remembered


# -- encoding ---------------------------------------------------------------


@lru_cache(maxsize=2)
def _tokenizer(json_path: str):
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core a task
    return Tokenizer.from_file(json_path)


@lru_cache(maxsize=2)
def word_encoder(json_path: str, width: int) -> "WordEncoder":
    """One of each worker process: its tasks share what is remembered."""
    return WordEncoder(json_path, width)


@lru_cache(maxsize=2)
def vocabulary_width(json_path: str) -> int:
    """Bytes that an id of this vocabulary takes: 2 or 4."""
    with open(json_path, encoding="utf-8") as f:
        spec = json.load(f)
    top = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))], default=0)
    return 2 if top < 1 << 16 else 4


#: Letters and marks whose classes no Unicode version changes: words of these
#: are split here, all others by the tokenizer itself.
_PLAIN = re.compile("[!-~\u00a1-\u012f\u0131-\u024f]+")  # without the dotted capital I
# Fixed value: the pre-tokenizer's pattern of the vocabulary file.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class _Remembered(dict):
    """The ids of words; those of a new word are asked of ``encode``.

    Words are held in two halves of ``_WORDS``: when the newer one is full,
    it becomes the older, and words still in use come back from there.
    """

    def __init__(self, encode):
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= _LONG:
            if len(self) >= _WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class WordEncoder:
    """Encodes texts word by word, remembering the ids of words and pieces.

    For byte-level tokenizers that drop white space, lower the case and split
    words by ``_PIECES``; the merges are the tokenizer's own.  Words with other
    than Latin letters, or with an added token's sign, are encoded by the
    tokenizer as a whole.  A piece is a word whose only piece is itself, so
    both are remembered in one table.
    """

    def __init__(self, json_path: str, width: int):
        import regex

        self.tokenizer, self.kind = _tokenizer(json_path), f"<u{width}"
        self.tokenize, self.letters = self.tokenizer.model.tokenize, _byte_letters()
        self.codes = [i.to_bytes(width, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.split = regex.compile(_PIECES).findall
        self.ids = _Remembered(self._word)

    def __call__(self, texts: list[str]) -> list[bytes]:
        ids, out = self.ids.__getitem__, []
        for t in texts:
            if t.isascii() and "<|" not in t:
                t = t.lower()  # at once; the words of other texts one by one
            out.append(b"".join(map(ids, t.replace("\n", " ").split(" "))))
        return out

    def _word(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word) or "<|" in word:
            return np.asarray(self.tokenizer.encode(word, add_special_tokens=False).ids, self.kind).tobytes()
        plain = word.lower()  # such letters have no other composed form
        if plain.isalpha():
            return self._merged(plain) if plain == word else self.ids[plain]
        stem = plain.rstrip(string.punctuation)
        pieces = [stem, plain[len(stem) :]] if stem.isalpha() else self.split(plain)
        return self._merged(plain) if len(pieces) == 1 else b"".join(map(self.ids.__getitem__, pieces))

    def _merged(self, piece: str) -> bytes:
        signs = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return b"".join([self.codes[t.id] for t in self.tokenize(signs)])


# -- minimal perfect hash ---------------------------------------------------


def _mix(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    """A new 64-bit hash of each key for each level."""
    x = h1 + h2 * np.uint64(2 * level + 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def fingerprints(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return (_mix(h1, h2, MAX_LEVELS) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit keys (two arrays of uint64)."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = np.cumsum(bits, dtype=np.int64) - bits  # set bits before each cell

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> "PerfectHash":
        sizes, arrays, level = [], [], 0
        while len(h1):
            if level == MAX_LEVELS:
                raise ValueError("two keys have the same 128-bit hash")
            size = int(len(h1) * GAMMA) | 7
            cell = (_mix(h1, h2, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(cell, minlength=size) == 1
            arrays.append(alone)
            sizes.append(size)
            left = ~alone[cell]
            h1, h2, level = h1[left], h2[left], level + 1
        return cls(sizes, np.concatenate(arrays).astype(np.uint8) if arrays else np.zeros(0, np.uint8))

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level knows it."""
        out = np.full(len(h1), -1, np.int64)
        open_ = np.arange(len(h1))
        for level, size in enumerate(self.sizes):
            cell = (_mix(h1[open_], h2[open_], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            hit = self.bits[cell] == 1
            out[open_[hit]] = self.rank[cell[hit]]
            open_ = open_[~hit]
        return out


_SLOT = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u4")])


def _pack(h1, h2, shard, offset, length) -> dict:
    """One bucket of the index as a row."""
    perfect = PerfectHash.build(h1, h2)
    slots = np.zeros(len(h1), _SLOT)
    at = perfect.slots(h1, h2)
    for name, values in (("mark", fingerprints(h1, h2)), ("shard", shard), ("offset", offset), ("length", length)):
        slots[name][at] = values
    return {
        "n_keys": len(h1), "sizes": perfect.sizes,
        "bits": np.packbits(perfect.bits).tobytes(), "slots": slots.tobytes(),
    }


def _find(row, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, their slot records) of keys in a bucket's row."""
    sizes = [int(x) for x in row["sizes"]]
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes))
    slots = np.frombuffer(row["slots"], _SLOT)
    at = PerfectHash(sizes, bits).slots(h1, h2)
    known = at >= 0
    known[known] = slots["mark"][at[known]] == fingerprints(h1[known], h2[known])
    return known, slots[at[known]]


def _hashes(key: Column, occurrence: Column) -> list[Column]:
    return [
        F.xxhash64(key, occurrence).alias("h1"),
        F.xxhash64(occurrence, key, F.lit("second")).alias("h2"),
    ]


def _unsigned(values) -> np.ndarray:
    return np.asarray(values, np.int64).view(np.uint64)


# -- files ------------------------------------------------------------------


def _files(path: str):
    """(Arrow file system, path in it) of a path or URI."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        if path.startswith("file:/") and not path.startswith("file://"):
            path = "file://" + path[5:]
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def _with_key(kind: T.DataType, rest: str) -> T.StructType:
    return T.StructType([T.StructField("key", kind), *T.StructType.fromDDL(rest).fields])


# -- writing ----------------------------------------------------------------


def write_store(
    docs: DataFrame, path: str, json_path: str, end_id: int = 1, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode ``docs`` into a store at ``path`` (see the module's docstring)."""
    spark, width = docs.sparkSession, vocabulary_width(json_path)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    ranged = (
        docs.select(F.col(key).alias("key"), body.alias("text"))
        .select("key", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place"))
        .repartitionByRange(n, "key", "tie", "place")
        .sortWithinPartitions("key", "tie", "place")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, name = TaskContext.get().partitionId(), f"ids-{uuid.uuid4().hex}.bin"
        encode, tail = word_encoder(json_path, width), np.asarray([end_id], f"<u{width}").tobytes()
        sink, offset, last, seen = None, 0, object(), 0
        for rows in batches:
            if sink is None:
                files, root = _files(path)
                files.create_dir(f"{root}/payload", recursive=True)
                sink = files.open_output_stream(f"{root}/payload/{name}")
            coded = [c + tail for c in encode(rows.column("text").to_pylist())]
            sizes = np.fromiter((len(c) // width for c in coded), np.int64, len(coded))
            sink.write(b"".join(coded))
            occurrence = np.zeros(len(coded), np.int64)
            for k, v in enumerate(rows.column("key").to_pylist()):
                seen = seen + 1 if v == last else 0
                last, occurrence[k] = v, seen
            n = len(coded)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("key"), pa.array(np.full(n, shard, np.int32)), pa.array([name] * n, pa.string()),
                    pa.array(occurrence), pa.array(offset + np.cumsum(sizes) - sizes), pa.array(sizes),
                ],
                names=["key", "shard", "file", "in_shard", "offset", "n_tokens"],
            )
            offset += int(sizes.sum())
        if sink is not None:
            sink.close()

    kind = ranged.schema["key"].dataType
    schema = _with_key(kind, "shard int, file string, in_shard long, offset long, n_tokens long")
    ranged.select("key", "text").mapInArrow(write, schema).write.parquet(f"{path}/entries")
    entries = spark.read.schema(schema).parquet(f"{path}/entries")
    _write_shards(entries, path, width)
    _write_index(entries, path)


def _write_shards(entries: DataFrame, path: str, width: int) -> None:
    """One row a shard: the ids and the documents of all shards before it."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    per_shard = entries.groupBy("shard", "file").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_ids")
    )
    per_shard.select(
        "shard", "file", "n_docs", "n_ids", F.lit(width).alias("width"),
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first_id"),
    ).write.parquet(f"{path}/shards")


def numbered(entries: DataFrame) -> DataFrame:
    """Entries with ``occurrence``: the place among all entries of the key.

    Only the last key of a shard can go on in the next ones, so one row a
    shard tells how many entries came before.
    """
    sides = entries.groupBy("shard").agg(
        F.min_by(F.struct("key"), "offset").alias("first"), F.max_by(F.struct("key", "in_shard"), "offset").alias("end")
    )
    none = F.lit(0).cast("long")
    marks = sides.select("shard", F.col("first.key").alias("edge"), none.alias("n"), F.lit(True).alias("starts"))
    marks = marks.unionByName(
        sides.select(
            "shard", F.col("end.key").alias("edge"), (F.col("end.in_shard") + 1).alias("n"), F.lit(False).alias("starts")
        )
    )
    before = Window.partitionBy("edge").orderBy("shard").rangeBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("carried", F.sum("n").over(before)).filter(F.col("starts") & (F.col("carried") > 0))
    carried = carried.select(F.col("shard").alias("_shard"), "edge", "carried")
    joined = entries.join(
        carried, (entries["shard"] == carried["_shard"]) & entries["key"].eqNullSafe(carried["edge"]), "left"
    )
    return joined.select(
        *entries.columns, (F.col("in_shard") + F.coalesce("carried", F.lit(0))).alias("occurrence")
    )


_INDEX = "bucket int, n_buckets int, n_keys long, sizes array<long>, bits binary, slots binary"


def _write_index(entries: DataFrame, path: str) -> None:
    n_buckets = max(1, -(-entries.count() // BUCKET))
    keyed = numbered(entries).select(*_hashes(F.col("key"), F.col("occurrence")), "shard", "offset", "n_tokens")

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        row = _pack(
            _unsigned(rows["h1"]), _unsigned(rows["h2"]), rows["shard"].to_numpy(), rows["offset"].to_numpy(),
            rows["n_tokens"].to_numpy(),
        )
        return pd.DataFrame([{"bucket": int(rows["bucket"].iloc[0]), "n_buckets": n_buckets, **row}])

    bucket = F.pmod("h2", F.lit(n_buckets)).cast("int").alias("bucket")
    keyed.select("*", bucket).groupBy("bucket").applyInPandas(build, _INDEX).write.parquet(f"{path}/index")


# -- reading ----------------------------------------------------------------


def locate(keys: DataFrame, path: str, key: str = "doc_id", occurrence: str = "occurrence") -> DataFrame:
    """(key, occurrence, shard, offset, n_tokens) of those ``keys`` that the store has.

    Each distinct key is looked up once, in the bucket of its hash.
    """
    index = keys.sparkSession.read.schema(_INDEX).parquet(f"{path}/index")
    n = index.agg(F.max("n_buckets")).first()[0] or 1
    asked = keys.select(F.col(key).alias("key"), F.col(occurrence).cast("long").alias("occurrence")).distinct()
    asked = asked.select("*", *_hashes(F.col("key"), F.col("occurrence")))
    asked = asked.withColumn("bucket", F.pmod("h2", F.lit(n)).cast("int"))
    out = _with_key(asked.schema["key"].dataType, "occurrence long, shard int, offset long, n_tokens long")
    names = to_arrow_schema(out)

    def look(rows: pa.Table, buckets: pa.Table) -> pa.Table:
        if not rows.num_rows or not buckets.num_rows:
            return names.empty_table()
        row = {c: buckets.column(c)[0].as_py() for c in ("sizes", "bits", "slots")}
        found, slots = _find(row, _unsigned(rows.column("h1")), _unsigned(rows.column("h2")))
        hit = rows.select(["key", "occurrence"]).filter(pa.array(found))
        for name, kind in (("shard", "int32"), ("offset", "int64"), ("length", "int64")):
            hit = hit.append_column("n_tokens" if name == "length" else name, pa.array(slots[name].astype(kind)))
        return hit

    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(look, out)


def read_ids(places: DataFrame, path: str) -> DataFrame:
    """``places`` (as ``locate`` gives) with ``start``, the number of ids of all
    documents before, and ``ids``, little-endian unsigned 32-bit ids as bytes."""
    spark = places.sparkSession
    shards = spark.read.parquet(f"{path}/shards").select("shard", "file", "width", "first_id")
    wanted = places.join(shards, "shard").select(
        "key", "occurrence", "shard", "file", "width", "offset", "n_tokens",
        (F.col("first_id") + F.col("offset")).alias("start"),
    )
    wanted = wanted.repartition("shard").sortWithinPartitions("shard", "offset")
    out = T.StructType([*wanted.schema.fields, T.StructField("ids", T.BinaryType())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = None, None
        for rows in batches:
            if files is None:
                files, root = _files(path)
            shard, width = (rows.column(c).to_numpy() for c in ("shard", "width"))
            at, size = (rows.column(c).to_numpy() * width for c in ("offset", "n_tokens"))
            ids: list[bytes] = []
            for part in np.split(np.arange(rows.num_rows), np.flatnonzero(np.diff(shard)) + 1):
                if not len(part):
                    continue
                name, w = rows.column("file")[int(part[0])].as_py(), int(width[part[0]])
                with files.open_input_file(f"{root}/payload/{name}") as f:
                    for a, b in _runs(at[part], size[part]):
                        start, stop = part[a], part[b - 1]
                        block = f.read_at(int(at[stop] + size[stop] - at[start]), int(at[start]))
                        for k in range(start, stop + 1):
                            raw = block[at[k] - at[start] : at[k] - at[start] + size[k]]
                            ids.append(np.frombuffer(raw, f"<u{w}").astype("<u4").tobytes())
            columns = [*rows.columns, pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names, "ids"])

    return wanted.mapInArrow(fetch, out)


def _runs(at: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches [a, b) of adjacent documents of at most ``READ_BYTES``, or one document."""
    a = 0
    for k in range(1, len(at) + 1):
        if k == len(at) or at[k] != at[k - 1] + size[k - 1] or at[k] + size[k] - at[a] > READ_BYTES:
            yield a, k
            a = k


class KeyedReader:
    """Keyed access without Spark, for a loader: integer keys, constant time each."""

    def __init__(self, path: str):
        import pyarrow.dataset as ds

        self.files, self.root = _files(path)
        self.index = ds.dataset(f"{self.root}/index", filesystem=self.files, format="parquet")
        shards = ds.dataset(f"{self.root}/shards", filesystem=self.files, format="parquet").to_table().to_pylist()
        self.shards = {s["shard"]: s for s in shards}
        self.buckets: dict[int, dict | None] = {}
        n = self.index.head(1, columns=["n_buckets"])["n_buckets"].to_pylist()
        self.n_buckets = n[0] if n else 0

    def _bucket(self, b: int):
        import pyarrow.dataset as ds

        if b not in self.buckets:
            rows = self.index.to_table(filter=ds.field("bucket") == b).to_pylist()
            self.buckets[b] = rows[0] if rows else None
        return self.buckets[b]

    def get(self, key: int, occurrence: int = 0) -> np.ndarray | None:
        """The ids of a document, or None where the store has no such key."""
        h1 = np.array([_spark_hash((key, occurrence))], np.uint64)
        h2 = np.array([_spark_hash((occurrence, key, "second"))], np.uint64)
        row = self._bucket(int(h2.view(np.int64)[0]) % self.n_buckets) if self.n_buckets else None
        if row is None:
            return None
        found, slots = _find(row, h1, h2)
        if not found[0]:
            return None
        shard = self.shards[int(slots["shard"][0])]
        width = shard["width"]
        with self.files.open_input_file(f"{self.root}/payload/{shard['file']}") as f:
            raw = f.read_at(int(slots["length"][0]) * width, int(slots["offset"][0]) * width)
        return np.frombuffer(raw, f"<u{width}").astype(np.uint32)


def _spark_hash(values: tuple) -> int:
    """What ``xxhash64`` of Spark gives for 64-bit integers and strings."""
    import xxhash

    h = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else int(v).to_bytes(8, "little", signed=True)
        h = xxhash.xxh64_intdigest(data, seed=h)
    return h


def stored_documents(spark: SparkSession, docs: DataFrame, json_path: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` to a fresh store and read every document back by its key.

    One row a document: doc_id, start, n_tokens, ids_crc32 (and ``occurrence``,
    0 unless an id repeats).
    """
    path = scratch_path(spark, "token-store")
    write_store(docs, path, json_path, end_id)
    counts = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    keys = counts.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("occurrence"))
    found = read_ids(locate(keys, path), path)
    return found.select(
        F.col("key").alias("doc_id"), "occurrence", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
