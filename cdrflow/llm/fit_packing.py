"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Large-item matching.  Pieces above one third of the capacity are large: a
sequence holds at most two of them, and they are matched greedily (largest
first, each with the largest partner that still fits).  Smaller pieces are
then placed best-fit, largest first, into the remaining gaps; what fits in no
gap opens new sequences.

The plan depends only on how many pieces there are of each length, so it is
made on that histogram (at most ``capacity`` numbers, whatever the corpus
holds) and yields classes of equal sequences.  Pieces of one length are
interchangeable: each gets its rank among them from per-task counters plus a
prefix sum over tasks, and the rank names its sequence and place.  No task or
driver ever holds the pieces themselves.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdrflow.llm.common import broadcast_arrays, staged

CAPACITY = 2048
END = 0  # the id that closes each document


@lru_cache(maxsize=2)
def byte_bpe(json_path: str):
    """Encoder of a byte-level BPE tokenizer file: text -> list of ids.

    The vocabulary and merges are run by tiktoken, which is several times
    faster than the tokenizers library on the same file and gives the same
    ids (tested).  Added tokens of the file are recognised in the text, as
    the tokenizers library does by default.
    """
    import json

    import public_tokenizers
    import tiktoken

    with open(json_path, encoding="utf-8") as f:
        spec = json.load(f)
    unbyte = {c: b for b, c in _byte_letters().items()}
    added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
    ranks = {bytes(unbyte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    codec = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
    )
    return lambda text: codec.encode(text, allowed_special="all")


def _byte_letters() -> dict[int, str]:
    """The printable letter by which byte-level BPE files write each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def pieces_of(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document of n ids; only longer ones are cut and
    the first piece takes the remainder."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def tokenised_pieces(
    docs: DataFrame, json_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, nth): ``nth`` counts the
    pieces of the same length that the task has made before."""
    kind = "array<struct<piece:int,start:long,length:long,ids_crc32:long,task:int,nth:long>>"

    def cut(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode, task = byte_bpe(json_path), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for texts in series:
            rows = []
            for text in texts:
                ids = np.array([*(encode(text) if text else ()), END], "<u4")
                row = []
                for k, (s, n) in enumerate(pieces_of(len(ids), capacity)):
                    crc = zlib.crc32(ids[s : s + n].tobytes())
                    row.append({"piece": k, "start": s, "length": n, "ids_crc32": crc, "task": task, "nth": seen[n]})
                    seen[n] += 1
                rows.append(row)
            yield pd.Series(rows, dtype=object)

    cut_udf = F.pandas_udf(cut, kind).asNondeterministic()
    return docs.select(F.col(id_col), cut_udf(F.col(text_col)).alias("p")).select(
        id_col, F.explode("p").alias("p")
    ).select(id_col, "p.*")


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """[(number of sequences, lengths in each)] for ``histogram`` {length: pieces}.

    Every step uses up one length or one class of gaps, so the work and the
    number of classes depend on the number of lengths, not of pieces.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    gaps: dict[int, list[list]] = defaultdict(list)  # gap -> classes [count, lengths]
    sizes: list[int] = []  # sorted gaps that have a class

    def add(gap: int, count: int, lengths: list[int]) -> None:
        if gap not in gaps or not gaps[gap]:
            insort(sizes, gap)
        gaps[gap].append([count, lengths])

    def take(gap: int, count: int) -> list[tuple[int, list[int]]]:
        """Up to ``count`` sequences with this gap."""
        got = []
        while count and gaps[gap]:
            cls = gaps[gap][-1]
            n = min(count, cls[0])
            got.append((n, cls[1]))
            cls[0] -= n
            count -= n
            if not cls[0]:
                gaps[gap].pop()
        if not gaps[gap]:
            sizes.remove(gap)
        return got

    large = sorted(n for n in left if 3 * n > capacity)
    counts = {n: left.pop(n) for n in large}
    while large:
        n = large[-1]
        c = counts[n]
        at = bisect_left(large, capacity - n + 1) - 1  # largest partner that fits
        if at < 0:
            add(capacity - n, c, [n])
            used = {n: c}
        elif large[at] == n:
            if c > 1:
                add(capacity - 2 * n, c // 2, [n, n])
                used = {n: c - c % 2}
            elif at:
                m = large[at - 1]
                add(capacity - n - m, 1, [n, m])
                used = {n: 1, m: 1}
            else:
                add(capacity - n, 1, [n])
                used = {n: 1}
        else:
            m = large[at]
            k = min(c, counts[m])
            add(capacity - n - m, k, [n, m])
            used = {n: k, m: k}
        for x, k in used.items():
            counts[x] -= k
            if not counts[x]:
                large.remove(x)

    for n in sorted(left, reverse=True):
        c = left[n]
        while c:
            at = bisect_left(sizes, n)
            if at < len(sizes):
                gap = sizes[at]
                for k, lengths in take(gap, c):
                    add(gap - n, k, [*lengths, n])
                    c -= k
            else:
                fit = capacity // n
                if c >= fit:
                    add(capacity - fit * n, c // fit, [n] * fit)
                if c % fit:
                    add(capacity - c % fit * n, 1, [n] * (c % fit))
                c = 0
    return [(count, lengths) for classes in gaps.values() for count, lengths in classes]


def _slots(plan: list[tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first sequence, step, offset).

    A class of c sequences with r pieces of one length in each owns r runs of
    c ranks; the piece at place i of a run lies in the class's i-th sequence.
    """
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    rank: dict[int, int] = defaultdict(int)
    first = 0
    for count, lengths in plan:
        at = 0
        for n in lengths:
            rows[n].append((rank[n], first, at))
            rank[n] += count
            at += n
        first += count
    return {n: np.array(x, np.int64) for n, x in rows.items()}


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset in place of task and nth.

    ``pieces`` must be a written table: task and nth are read twice.
    """
    spark = pieces.sparkSession
    made = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("made"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranks = made.withColumn("rank0", F.coalesce(F.sum("made").over(before), F.lit(0)))
    # At most ``capacity`` rows.
    histogram = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.sum("made").alias("n")).collect()}
    slots = broadcast_arrays(spark, _slots(plan_sequences(histogram, capacity)))
    ranked = pieces.join(ranks, ["length", "task"]).withColumn("rank", F.col("nth") + F.col("rank0"))

    def place(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        table = slots.value
        for lengths, rank in series:
            n, r = lengths.to_numpy(), rank.to_numpy()
            seq, off = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for x in np.unique(n):
                here = n == x
                rows = table[int(x)]
                k = np.searchsorted(rows[:, 0], r[here], side="right") - 1
                seq[here] = rows[k, 1] + r[here] - rows[k, 0]
                off[here] = rows[k, 2]
            yield pd.DataFrame({"sequence_id": seq, "offset": off})

    placed = F.pandas_udf(place, "sequence_id long, offset long")
    keep = [c for c in pieces.columns if c not in ("task", "nth")]
    return ranked.select(*keep, placed("length", "rank").alias("p")).select(*keep, "p.sequence_id", "p.offset")


def pack_documents(
    docs: DataFrame, json_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece with the closing id alone.  Repeated
    rows are packed one by one; null ids are carried; other columns are
    ignored.  An empty table gives an empty result.
    """
    return pack_pieces(staged(tokenised_pieces(docs, json_path, capacity, id_col, text_col), "pieces"), capacity)
