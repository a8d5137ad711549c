"""SentencePiece encoding and decoding by vectorised merge rounds.

A text is cut at spaces into words (no piece of a usable vocabulary continues
past a space, which is checked when the model is read).  The distinct words of
a batch that are not known yet become one flat array of symbols.  In each
round the best-ranked pair of every word is found by a segmented minimum, its
leftmost non-overlapping occurrences are merged at once, and the array is
compacted; words without a pair leave the array.  A word for which merging
all occurrences at once could differ from merging them one by one (a merge
creates a pair that ranks as well or better), and any very long word, is
merged one pair at a time with a heap instead, so the ids always equal those
of the library.

The library is used only to read the vocabulary (pieces, scores, types).
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
NONE = np.int64(2**62)
LONG_WORD = 512  # symbols; beyond it a heap is cheaper than rounds over all words
CACHE_WORDS = 400_000  # known words kept per task; cleared when full
_IRREGULAR = re.compile(r" *[^ ]+| +\Z")


class PieceModel:
    """Vocabulary of a BPE model with byte fallback and identity normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        ids = {self.pieces[i]: i for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("the vocabulary has pieces that run past a space")
        self.byte_id = [0] * 256
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(self.pieces[i][3:5], 16)] = i
        # Symbols: piece ids, and private numbers for characters that occur only inside pieces.
        self.symbol = {}
        for c in sorted({c for p in ids for c in p}):
            self.symbol[c] = ids.get(c, n + len(self.symbol))
        self.private = {v: k for k, v in self.symbol.items() if v >= n}
        scores = sorted({sp.get_score(i) for i in plain}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        at = lambda s: self.symbol.get(s) if len(s) == 1 else ids.get(s)
        pairs = {}
        for p, i in ids.items():
            for cut in range(1, len(p)):
                a, b = at(p[:cut]), at(p[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = (rank[sp.get_score(i)], i)
        self.pairs = pairs
        # A character that no piece holds is the symbol ``self.unknown`` + its code point.
        self.unknown = n + len(self.symbol)
        self.width = np.int64(self.unknown + 0x110000)
        keys = np.array([a * int(self.width) + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        values = np.array(list(pairs.values()), np.int64)[order]
        self.ranks, self.merged = values[:, 0], values[:, 1]
        self._hash()
        table = np.arange(0x110000, dtype=np.int64) + self.unknown
        for c, v in self.symbol.items():
            table[ord(c)] = v
        self.table = table
        # What an id stands for in the decoded bytes.
        self.out = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for i in range(n):
            if sp.is_byte(i):
                self.out[i] = bytes([int(self.pieces[i][3:5], 16)])
            elif sp.is_control(i):
                self.out[i] = b""
            elif sp.is_unknown(i):
                self.out[i] = " ⁇ ".encode()
        self.is_byte = [sp.is_byte(i) for i in range(n)]
        self.words: dict[str, tuple[int, ...]] = {}

    def _hash(self) -> None:
        """Open-addressing table over the pair keys for vectorised look-ups."""
        self.bits = max(4, int(len(self.keys) * 4).bit_length())
        size = 1 << self.bits
        self.slot = np.full(size, -1, np.int32)
        place = self._place(self.keys)
        left = np.arange(len(self.keys), dtype=np.int32)
        self.probes = 0
        while len(left):
            free = left[self.slot[place[left]] < 0]
            self.slot[place[free]] = free  # of several, the last one stays
            left = left[self.slot[place[left]] != left]
            place[left] = (place[left] + 1) & (size - 1)
            self.probes += 1

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair in ``ranks`` and ``merged``, or -1."""
        keys = left * self.width + right
        place, mask = self._place(keys), (1 << self.bits) - 1
        got = self.slot[place]
        hit = np.where((got >= 0) & (self.keys[got] == keys), got, -1)
        todo = np.flatnonzero((got >= 0) & (hit < 0))
        for _ in range(self.probes):
            if not len(todo):
                break
            place[todo] = (place[todo] + 1) & mask
            got = self.slot[place[todo]]
            same = (got >= 0) & (self.keys[got] == keys[todo])
            hit[todo[same]] = got[same]
            todo = todo[(got >= 0) & ~same]
        return hit

    # -- encoding ---------------------------------------------------------

    def merge_rounds(self, symbols: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Merged symbols of each word; ``symbols`` holds the words one after another."""
        done: list[np.ndarray | None] = [None] * len(lengths)
        word = np.arange(len(lengths))
        while len(word):
            starts = np.concatenate(([0], np.cumsum(lengths)))
            last = starts[1:] - 1
            pair = np.full(len(symbols), -1, np.int64)
            pair[:-1] = self.find(symbols[:-1], symbols[1:])
            pair[last] = -1
            rank = np.where(pair >= 0, self.ranks[pair], NONE)
            best = np.minimum.reduceat(rank, starts[:-1])
            live = best < NONE
            if not live.all():
                for k in np.flatnonzero(~live):
                    done[word[k]] = symbols[starts[k] : starts[k + 1]]
                keep = np.repeat(live, lengths)
                symbols, pair, rank = symbols[keep], pair[keep], rank[keep]
                word, lengths, best = word[live], lengths[live], best[live]
                if not len(word):
                    break
                starts = np.concatenate(([0], np.cumsum(lengths)))
            owner = np.repeat(np.arange(len(word)), lengths)
            hit = rank == best[owner]
            # Of overlapping occurrences take the 1st, 3rd, ... of each stretch.
            at = np.flatnonzero(hit)
            fresh = np.ones(len(at), bool)
            fresh[1:] = at[1:] != at[:-1] + 1
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - head) % 2 == 0]
            gone = np.zeros(len(symbols), bool)
            gone[at + 1] = True
            merged = symbols.copy()
            merged[at] = self.merged[pair[at]]
            counts = np.bincount(owner[at], minlength=len(word))
            if (counts > 1).any():
                odd = self._may_differ(merged, gone, at, owner, best, counts)
                if len(odd):
                    drop = np.zeros(len(word), bool)
                    drop[odd] = True
                    for k in odd:
                        done[word[k]] = np.array(self.merge_one_by_one(symbols[starts[k] : starts[k + 1]].tolist()))
                    gone |= drop[owner]
                    lengths = np.bincount(owner[~gone], minlength=len(word))[~drop]
                    symbols, word = merged[~gone], word[~drop]
                    continue
            symbols, lengths = merged[~gone], lengths - counts
        return done

    def _may_differ(self, merged, gone, at, owner, best, counts) -> np.ndarray:
        """Words with several merges in which a new pair ranks no worse than the pair just merged."""
        kept = np.flatnonzero(~gone)
        new = np.zeros(len(merged), bool)
        new[at] = True
        a, b = kept[:-1], kept[1:]
        near = (new[a] | new[b]) & (owner[a] == owner[b]) & (counts[owner[a]] > 1)
        a, b = a[near], b[near]
        pair = self.find(merged[a], merged[b])
        worse = (pair >= 0) & (self.ranks[pair] <= best[owner[a]])
        return np.unique(owner[a[worse]])

    def merge_one_by_one(self, symbols: list[int]) -> list[int]:
        """The sequential rule: always the best pair, of equals the leftmost."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i: int, j: int) -> None:
            found = self.pairs.get((symbols[i], symbols[j]))
            if found:
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(n - 1):
            push(i, i + 1)
        alive = [True] * n
        while heap:
            _, i, left, right, to = heapq.heappop(heap)
            if not alive[i] or symbols[i] != left:
                continue
            j = after[i]
            if j >= n or symbols[j] != right:
                continue
            symbols[i], alive[j] = to, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                push(i, after[j])
            if before[i] >= 0:
                push(before[i], i)
        return [s for s, ok in zip(symbols, alive) if ok]

    def _learn(self, fresh: list[str]) -> None:
        words = [SPACE + w.replace(" ", SPACE) for w in fresh]
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.table[points]
        long = lengths > LONG_WORD
        parts: list = [None] * len(words)
        if long.any():
            starts = np.cumsum(lengths) - lengths
            for k in np.flatnonzero(long):
                parts[k] = self.merge_one_by_one(symbols[starts[k] : starts[k] + lengths[k]].tolist())
        short = np.flatnonzero(~long)
        if len(short):
            for k, got in zip(short, self.merge_rounds(symbols[np.repeat(~long, lengths)], lengths[short])):
                parts[k] = got.tolist()
        n = len(self.pieces)
        for w, got in zip(fresh, parts):
            if max(got) >= n:
                got = list(chain.from_iterable(self._spelled(s) if s >= n else (s,) for s in got))
            self.words[w] = tuple(got)

    def _spelled(self, symbol: int) -> list[int]:
        """Byte ids of a character without a piece of its own."""
        c = self.private[symbol] if symbol < self.unknown else chr(symbol - self.unknown)
        return [self.byte_id[b] for b in c.encode()]

    @staticmethod
    def words_of(text: str) -> list[str]:
        """Words after one leading space, each with the further spaces before it."""
        if not text:
            return []
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if text[0] == " " or text[-1] == " " or "  " in text:
            return [w[1:] for w in _IRREGULAR.findall(" " + text)]
        return text.split(" ")

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text (null: none)."""
        at = 0
        while at < len(texts):
            # As many texts as fit the bound on known words, one at least.
            parts, seen, upto = [], set(), at
            while upto < len(texts) and (upto == at or len(seen) < CACHE_WORDS // 4):
                parts.append(self.words_of(texts[upto] or ""))
                seen.update(parts[-1])
                upto += 1
            if len(self.words) > CACHE_WORDS:
                self.words.clear()
            fresh = [w for w in seen if w not in self.words]
            if fresh:
                self._learn(fresh)
            get = self.words.__getitem__
            for words in parts:
                yield list(chain.from_iterable(map(get, words)))
            at = upto

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        if not ids:
            return ""
        data = b"".join(map(self.out.__getitem__, ids))
        try:
            text = data.decode()
        except UnicodeDecodeError:
            text = self._decode_broken(ids)
        first = next((i for i in ids if self.out[i]), None)
        if first is not None and not self.is_byte[first] and self.pieces[first].startswith(SPACE):
            text = text[1:]
        return text

    def _decode_broken(self, ids: list[int]) -> str:
        """Each byte that belongs to no valid character becomes U+FFFD."""
        out, run = [], bytearray()

        def flush() -> None:
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[:size]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                del run[:size]

        for i in ids:
            if self.is_byte[i]:
                run += self.out[i]
            else:
                flush()
                out.append(self.out[i].decode())
        flush()
        return "".join(out)


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    # The known words are many small tuples without cycles: look for cycles rarely.
    gc.set_threshold(200_000, 20, 100)
    return PieceModel(path)


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the whole text's ids, without begin and end ids.

    One row per input row; null and empty texts have no ids; ids are carried as
    they are; other columns are ignored; an empty table gives an empty result.
    A map: nothing is shuffled.
    """

    def encode(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = piece_model(model_path)
        for texts in series:
            yield pd.Series(list(model.encode_batch(texts.tolist())), dtype=object)

    return docs.select(F.col(id_col), F.pandas_udf(encode, "array<int>")(F.col(text_col)).alias("ids"))


def decode_documents(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``; null ids decode to the empty text."""

    def decode(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = piece_model(model_path)
        for rows in series:
            yield pd.Series([model.decode([] if ids is None else list(ids)) for ids in rows], dtype=object)

    return encoded.withColumn("decoded", F.pandas_udf(decode, "string")(F.col(ids_col)))


def piece_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in one
    pass, so that the ids themselves need not leave the task.

    Null and empty texts have no ids and decode to the empty text; repeated rows,
    null ids, other columns and empty tables as in ``encode_documents``.
    """

    def digest(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = piece_model(model_path)
        names = list(map(str, range(len(model.pieces))))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for texts in series:
            rows = [
                (len(ids), sha(",".join(map(names.__getitem__, ids))), sha(model.decode(ids)))
                for ids in model.encode_batch(texts.tolist())
            ]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    udf = F.pandas_udf(digest, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return docs.select(F.col(id_col), udf(F.col(text_col)).alias("d")).select(id_col, "d.*")
