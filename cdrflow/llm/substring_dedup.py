"""Substring dedup: words inside a repeated window of ``WINDOW`` words are removed.

A window is removed where the same word sequence also starts earlier (smaller
id, or the same id and an earlier start), judged on the input as it stands.

The method is suffix automata of reference shards and matching statistics.
Every shard against every document would cost shards x documents, so passages
are routed instead of broadcast, to the only shard that can match them:

1. Each window names an anchor, the ``GRAM``-word run in it with the smallest
   hash.  Equal windows name equal anchors, so matches never cross anchors.
   Neighbouring windows with one anchor form a context (at most
   WINDOW - GRAM + 1 windows).  Only contexts whose anchor occurs again go on.
   What a document repeats of itself is settled before anything is shuffled.
2. Equal contexts are one reference passage, held by its first occurrence; at
   all others every window is removed.  This is an aggregate with map-side
   minima, so a passage that a third of all documents share is one row.
3. The distinct contexts of an anchor are a shard (several make a task's
   input).  In order of first occurrence they are streamed through the
   shard's suffix automaton for their matching statistics and then added to
   it: a window is repeated where the match is ``WINDOW`` words or longer and
   began earlier.  Shards with more than ``MAX_CONTEXTS`` contexts are split into
   single windows, which aggregate by themselves.
4. The repeated windows of a document are merged into maximal spans and cut out.

A document is named by its id and the hash of its text, in this order: texts
that share an id are documents of their own, and nothing is cut from one for
what another holds later.  Rows equal in both are one document given several
times; each copy keeps the same words.

Word sequences are compared by 64-bit hashes of the words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdrflow.llm.common import fresh_name, staged
from cdrflow.llm.words import mix, signed, word_hashes

WINDOW = 20
GRAM = 6
MAX_CONTEXTS = 2000
MAX_BROADCAST_ROWS = 2_000_000  # of 8 to 24 bytes; larger tables are joined by a shuffle

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 4096)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def run_sums(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _power_tables(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return sums, down


def rolling(words: np.ndarray, k: int, sums=None) -> np.ndarray:
    """Hash of each run of ``k`` words, wherever it stands."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    total, down = sums or run_sums(words)
    n = len(words) - k + 1
    return mix((total[k:] - total[:-k])[:n] * down[:n], k)


def split_words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def contexts(words: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """(anchor, context hash, first window, windows) arrays of one document."""
    if len(words) < window:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    sums = run_sums(words)
    grams, windows = rolling(words, gram, sums), rolling(words, window, sums)
    at = sliding_window_view(grams, window - gram + 1).argmin(1) + np.arange(len(windows))
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    count = np.diff(np.append(first, len(windows)))
    # The first and the last window cover all words of the context.
    both = windows[first] * np.uint64(3) + mix(windows[first + count - 1], 1) + count.astype(np.uint64)
    return grams[at[first]], mix(both, 2), first, count


def without_own_repeats(found):
    """The contexts of a document, and the ranges of its windows in contexts that it
    had before: those go whatever the other documents hold.  Neighbouring ranges
    are one, so a text that repeats itself a thousand times is a few rows."""
    anchor, context, start, count = found
    first = np.sort(np.unique(context, return_index=True)[1])
    again = np.ones(len(context), bool)
    again[first] = False
    s, e = start[again], (start + count)[again]
    cut = np.concatenate(([True], s[1:] != e[:-1])) if len(s) else np.zeros(0, bool)
    last = np.append(np.flatnonzero(cut)[1:] - 1, len(s) - 1) if len(s) else np.zeros(0, np.int64)
    return (anchor[first], context[first], start[first], count[first]), (s[cut], e[last])


_CONTEXTS = "struct<anchor:array<long>,context:array<long>,start:array<int>,windows:array<int>>"


def _contexts_of(text: Column, window: int, gram: int) -> Column:
    """Contexts of a text; those without an anchor are ranges of its own repeats."""

    def found(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            rows = []
            for t in texts:
                (a, c, s, n), (own, end) = without_own_repeats(contexts(word_hashes(split_words(t)), window, gram))
                none = [None] * len(own)
                rows.append(
                    (
                        [*signed(a).tolist(), *none], [*signed(c).tolist(), *none],
                        np.concatenate((s, own)).astype(np.int32), np.concatenate((n, end - own)).astype(np.int32),
                    )
                )
            yield pd.DataFrame(rows, columns=["anchor", "context", "start", "windows"])

    return F.pandas_udf(found, _CONTEXTS)(text)


class SuffixAutomaton:
    """Suffix automaton of several word sequences, with the first end of each state."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def _state(self, edges: dict, link: int, length: int, first: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        clone = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.first[q])
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, words: list[int], first: int) -> None:
        """Append a sequence; ``first`` numbers its first word among all added."""
        last = 0
        for k, word in enumerate(words):
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
                continue
            cur = self._state({}, 0, self.length[last] + 1, first + k)
            p = last
            while p != -1 and word not in self.next[p]:
                self.next[p][word] = cur
                p = self.link[p]
            if p != -1:
                q = self.next[p][word]
                self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
            last = cur

    def matches(self, words: list[int], least: int) -> list[int]:
        """For each word the number of the word at which the earliest match of
        ``least`` words ending there ends, or -1 if the longest match is shorter."""
        out, state, size = [], 0, 0
        nxt, link, length = self.next, self.link, self.length
        for word in words:
            while state and word not in nxt[state]:
                state = link[state]
                size = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                size += 1
            else:
                size = 0
            if size < least:
                out.append(-1)
                continue
            while length[link[state]] >= least:
                state = link[state]
                size = length[state]
            out.append(self.first[state])
        return out


def repeated_in_shard(passages: list[tuple], window: int = WINDOW) -> list[list[int]]:
    """For each passage (id, start, words), the ids of any ordered kind, in ascending order, the offsets of
    the windows that occur in an earlier one."""
    automaton, places, out = SuffixAutomaton(), [], []
    for doc, start, words in passages:
        hits = []
        for end, seen in enumerate(automaton.matches(words, window)):
            if seen >= 0:
                d, s = places[seen]
                at = end - window + 1
                if (d, s - window + 1) < (doc, start + at):
                    hits.append(at)
        out.append(hits)
        automaton.add(words, len(places))
        places.extend((doc, start + k) for k in range(len(words)))
    return out


def _name(number: Column, text: Column) -> Column:
    """What tells a document from others: its id and its text's hash."""
    return F.struct(number.cast("long").alias("number"), F.xxhash64(text).alias("text"))


def _if_small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def _shard_hits(passages: DataFrame, window: int) -> DataFrame:
    """(id, start, stop) ranges of repeated windows; ``passages``: anchor, id, start, words."""

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, current = [], None

        def finish(out: list) -> None:
            if len(shard) > 1:
                for (doc, start, _), hits in zip(shard, repeated_in_shard(shard, window)):
                    out.extend((*doc, start + h, start + h + 1) for h in hits)
            shard.clear()

        for batch in batches:
            out: list = []
            columns = (batch[c] for c in ("anchor", "number", "text", "start", "words"))
            for anchor, number, text, start, words in zip(*columns):
                if anchor != current:
                    finish(out)
                    current = anchor
                if not shard or shard[-1][:2] != ((number, text), start):  # else a copy of the row
                    shard.append(((number, text), start, words.tolist()))
            yield pd.DataFrame(out, columns=["number", "text", "start", "stop"])
        out = []
        finish(out)
        yield pd.DataFrame(out, columns=["number", "text", "start", "stop"])

    # All contexts of an anchor come to one task, in order of first occurrence.
    placed = passages.repartition("anchor").sortWithinPartitions("anchor", "id", "start")
    hits = placed.select("anchor", "id.*", "start", "words").mapInPandas(
        stream, "number long, text long, start int, stop int"
    )
    return hits.select(F.struct("number", "text").alias("id"), "start", "stop")


def _merged(ranges: Column, window: int) -> Column:
    """Ranges of window starts as maximal spans of words."""

    def merge(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for rows in series:
            out = []
            for row in rows:
                spans = np.array(sorted((r["start"], r["stop"]) for r in row), np.int64)
                start, stop = spans[:, 0], np.maximum.accumulate(spans[:, 1]) + window - 1
                cut = np.concatenate(([True], start[1:] > stop[:-1]))
                out.append((start[cut].astype(np.int32), stop[np.append(np.flatnonzero(cut)[1:] - 1, len(cut) - 1)].astype(np.int32)))
            yield pd.DataFrame(out, columns=["starts", "stops"])

    return F.pandas_udf(merge, "struct<starts:array<int>,stops:array<int>>")(ranges)


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, starts, stops): for each document with repeated windows, its maximal
    spans of words (numbered from 0, stop exclusive) that they cover; ``id`` is
    a struct of the id (``number``) and the hash of the text (``text``)."""
    texts = docs.filter(F.col(id_col).isNotNull()).select(
        _name(F.col(id_col), F.col(text_col)).alias("id"), F.col(text_col).alias("text")
    )
    every = texts.select("id", _contexts_of(F.col("text"), window, gram).alias("c")).select(
        "id", F.inline(F.arrays_zip("c.anchor", "c.context", "c.start", "c.windows"))
    )
    again = staged(
        every.filter("anchor is not null")
        .groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("anchor", F.lit(True).alias("hit")),
        "repeated-anchors",
    )
    found = every.join(_if_small(again, again.count()), "anchor", "left").filter("hit or anchor is null").drop("hit")
    found = staged(found, "contexts")
    own = found.filter("anchor is null").select("id", "start", (F.col("start") + F.col("windows")).alias("stop"))
    found = found.filter("anchor is not null")
    passages = staged(
        found.groupBy("anchor", "context").agg(
            F.min(F.struct("id", "start")).alias("f"), F.first("windows").alias("windows")
        ).select("anchor", "context", "f.id", "f.start", "windows"),
        "passages",
    )
    copies = found.join(passages.select("context", "id", "start"), ["context", "id", "start"], "left_anti").select(
        "id", "start", (F.col("start") + F.col("windows")).alias("stop")
    )
    shards = staged(passages.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1"), "shards")
    shared = passages.join(_if_small(shards, shards.count()), "anchor")
    by_doc = staged(
        shared.groupBy("id").agg(
            F.collect_list(F.struct("start", "windows", "anchor", "contexts")).alias("wanted"),
            F.count(F.lit(1)).alias("n"),
        ),
        "wanted",
    )
    size = by_doc.agg(F.sum("n")).first()[0] or 0

    def cut(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, wanted in series:
            out = []
            for t, ws in zip(text, wanted):
                words = signed(word_hashes(split_words(t)))
                out.append([words[w["start"] : w["start"] + w["windows"] + window - 1] for w in ws])
            yield pd.Series(out, dtype=object)

    words = F.pandas_udf(cut, "array<array<long>>")
    content = (
        texts.join(_if_small(by_doc, size), "id")
        .select("id", "wanted", words("text", "wanted").alias("words"))
        .select("id", F.inline(F.arrays_zip("wanted", "words")))
        .select("id", "wanted.*", "words")
    )
    content = staged(content, "passage-words")
    hits = _shard_hits(content.filter(F.col("contexts") <= MAX_CONTEXTS), window)
    # A crowded anchor: its windows one by one, the first of each stays.
    single = content.filter(F.col("contexts") > MAX_CONTEXTS).select(
        "id", "start", "words", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("k")
    )
    part = F.slice("words", F.col("k") + 1, F.lit(window))
    single = single.select(
        "id", (F.col("start") + F.col("k")).alias("start"), F.xxhash64(part).alias("h1"), F.xxhash64(F.lit(1), part).alias("h2")
    )
    firsts = single.groupBy("h1", "h2").agg(F.min(F.struct("id", "start")).alias("f")).select("h1", "h2", "f.*")
    crowded = single.join(firsts, ["h1", "h2", "id", "start"], "left_anti").select(
        "id", "start", (F.col("start") + 1).alias("stop")
    )
    ranges = own.unionByName(copies).unionByName(hits).unionByName(crowded)
    spans = ranges.groupBy("id").agg(F.collect_set(F.struct("start", "stop")).alias("r"))
    return staged(spans.select("id", _merged(F.col("r"), window).alias("s")).select("id", "s.*"), "repeated-spans")


def _kept(words: list[bytes], starts, stops) -> list[bytes]:
    out, at = [], 0
    for s, e in zip(starts, stops):
        out += words[at:s]
        at = e
    return out + words[at:]


def _with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` with a column of its spans, whatever columns it has, and its name."""
    size = spans.agg(F.sum(F.size("starts"))).first()[0] or 0
    name = fresh_name(docs, "spans")
    key = fresh_name(docs, "span_id")
    right = spans.select(F.col("id").alias(key), F.struct("starts", "stops").alias(name))
    return docs.join(_if_small(right, size), _name(docs[id_col], docs[text_col]) == F.col(key), "left").drop(key), name


def dedup_documents(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256), one row per row of ``docs``.

    Null, empty and blank texts have no words.  Different texts that share an
    id are documents of their own, in the order of their texts' hashes; rows
    equal in id and text keep the same words.  Rows with a null id lose
    nothing.  Other columns are ignored; an empty table gives an empty result.
    """
    spans = repeated_spans(docs, window, gram, id_col, text_col)
    rows, name = _with_spans(docs.select(id_col, text_col), spans, id_col, text_col)

    def digest(series: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        for text, span in series:
            out = []
            for t, starts, stops in zip(text, span["starts"], span["stops"]):
                words = split_words(t)
                kept = words if starts is None else _kept(words, starts, stops)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256"])

    udf = F.pandas_udf(digest, "n_words long, n_removed long, kept_sha256 string")
    return rows.select(id_col, udf(text_col, name).alias("d")).select(id_col, "d.*")


def strip_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the repeated spans cut out of ``text_col``: the kept words
    joined by one space.  Texts without repeats stay as they are, null and empty
    ones included; repeated ids, null ids and empty tables as in ``dedup_documents``."""
    spans = repeated_spans(docs, window, gram, id_col, text_col)
    rows, name = _with_spans(docs, spans, id_col, text_col)

    def strip(series: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.Series]:
        for text, span in series:
            yield pd.Series(
                [
                    t if t is None or starts is None else b" ".join(_kept(split_words(t), starts, stops)).decode()
                    for t, starts, stops in zip(text, span["starts"], span["stops"])
                ],
                dtype=object,
            )

    return rows.withColumn(text_col, F.pandas_udf(strip, "string")(F.col(text_col), F.col(name))).drop(name)
