import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from cdrflow.llm import cover_tree, ngram_join, substring_dedup
from cdrflow.llm.components import connected_components
from cdrflow.llm.words import LOWER

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def roots(links, ids):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute_jaccard(rows, percent=90, k=3):
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").encode().translate(LOWER))
        whole = frozenset([tuple(w)] if w else [])
        sets.append((i, frozenset(zip(*(w[j:] for j in range(k)))) if len(w) >= k else whole))
    links = [
        (i, j)
        for k, (i, a) in enumerate(sets)
        for j, b in sets[:k]
        if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b)
    ]
    parts = roots(links, {i for i, _ in sets if i is not None})
    return Counter((i, len(s), parts.get(i)) for i, s in sets)


def _named(i, text):
    """A document: its id, then the hash that Spark's xxhash64 gives for its text."""
    h = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), seed=42)
    return i, h - (1 << 64 if h >> 63 else 0)


def brute_windows(rows, window=20):
    first = {}
    for i, t in (r for r in rows if r[0] is not None):
        w = WORD.findall((t or "").encode())
        for k in range(len(w) - window + 1):
            key, at = tuple(w[k : k + window]), (*_named(i, t), k)
            first[key] = min(first.get(key, at), at)
    out = Counter()
    for i, t in rows:
        w = WORD.findall((t or "").encode())
        gone = set()
        for k in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[k : k + window])] < (*_named(i, t), k):
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def pairs_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def near_copies(spark):
    """A base text, many copies with a few edits, chains of edits, and unrelated rows."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    base = [word() for _ in range(120)]
    rows = [(0, " ".join(base))]
    for _ in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = word()
        rows.append((len(rows), " ".join(words)))
    chain = list(base[:60])
    for _ in range(25):
        chain[rng.randrange(60)] = word()
        rows.append((len(rows), " ".join(chain)))
    for _ in range(60):
        rows.append((len(rows), " ".join(rng.choice(base[:12]) for _ in range(rng.randint(1, 30)))))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_components_of_links(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = roots(links, {x for p in links if p[0] != p[1] for x in p})
    assert got == {i: c for i, c in want.items() if i in got}
    assert all(c == i for i, c in want.items() if i not in got)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("dense", [2, 64])
def test_jaccard_components(near_copies, docs, sf_docs, monkeypatch, dense):
    monkeypatch.setattr(ngram_join, "DENSE", dense)
    for table in (near_copies, docs, sf_docs):
        got = Counter(map(tuple, ngram_join.jaccard_components(table).collect()))
        assert got == brute_jaccard(pairs_of(table))
    got = Counter(map(tuple, ngram_join.jaccard_components(near_copies, 80, 5).collect()))
    assert got == brute_jaccard(pairs_of(near_copies), 80, 5)


def test_jaccard_of_nothing_and_shuffled_ids(near_copies, no_docs, monkeypatch):
    assert ngram_join.jaccard_components(no_docs).count() == 0
    monkeypatch.setattr(ngram_join, "MAX_BROADCAST_IDS", 0)
    got = Counter(map(tuple, ngram_join.jaccard_components(near_copies).collect()))
    assert got == brute_jaccard(pairs_of(near_copies))


def test_one_row_of_each_component_stays(docs):
    kept = ngram_join.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] or -1 for r in kept.collect())
    # 1 and 2 are equal, 7 and 15 are equal and 7 is there twice; null ids stay.
    assert 1 in ids and 2 not in ids and ids.count(7) == 1 and 15 not in ids and ids.count(-1) == 2
    assert {4, 5, 6} <= set(ids)


@pytest.mark.parametrize("limits", [{}, {"MAX_CONTEXTS": 1}, {"MAX_BROADCAST_ROWS": 0}])
def test_repeated_windows(near_copies, docs, sf_docs, no_docs, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(substring_dedup, name, value)
    for table in (near_copies, docs, sf_docs):
        got = Counter(map(tuple, substring_dedup.dedup_documents(table).collect()))
        assert got == brute_windows(pairs_of(table))
    assert substring_dedup.dedup_documents(no_docs).count() == 0


def test_rows_that_share_an_id_lose_only_what_is_repeated(spark):
    rng = random.Random(11)
    text = lambda n=30: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    a, b, c, d = text(), text(), text(), text(50)
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (3, [*text(5), *d]), (3, [*d, *text(9)]), (3, [*text(40), *b[:25]]), (4, d + d)]
    rows = [(i, " ".join(w)) for i, w in rows] + [(2, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(map(tuple, substring_dedup.dedup_documents(docs).collect()))
    assert got == brute_windows(rows)
    left = [r["text"] for r in substring_dedup.strip_repeats(docs).collect()]
    assert " ".join(b) in left and left.count(" ".join(c)) == 2 and left.count(" ".join(a)) == 1


def test_stripped_texts(docs):
    out = substring_dedup.strip_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert texts[1] == before[1] and texts[2] == "" and texts[4] is None and texts[6] == before[6]


def test_automaton_matches_naively():
    rng = random.Random(9)
    for _ in range(60):
        passages = [(d, 0, [rng.randrange(3) for _ in range(rng.randint(1, 25))]) for d in range(5)]
        got = substring_dedup.repeated_in_shard(passages, 4)
        seen = {}
        for (d, s, w), hits in zip(passages, got):
            want = []
            for k in range(len(w) - 3):
                key = tuple(w[k : k + 4])
                if key in seen and seen[key] < d:
                    want.append(k)
            for k in range(len(w) - 3):
                seen.setdefault(tuple(w[k : k + 4]), d)
            assert hits == want


VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("rep", T.StringType()),
        T.StructField("n", T.StringType()),
    ]
)


def brute_vectors(rows, threshold=0.93):
    usable = []
    for i, v, label in rows:
        x = np.array([np.nan if y is None else y for y in v], float) if v is not None else np.zeros(0)
        if i is not None and label is not None and len(x) and np.isfinite(x).all() and x.any():
            x = x / np.abs(x).max()
            usable.append((i, label, x / np.sqrt((x * x).sum())))
    counts, links = defaultdict(int), []
    for k, (i, la, x) in enumerate(usable):
        for j, lb, y in usable[:k]:
            if la == lb and len(x) == len(y) and float(x @ y) >= threshold:
                counts[k] += 1
                counts[next(m for m in range(k) if usable[m][2] is y)] += 1
                links.append((i, j))
    parts = roots(links, {i for i, _, _ in usable})
    out, k = Counter(), 0
    for i, v, label in rows:
        if k < len(usable) and usable[k][0] == i and v is not None and label == usable[k][1] and _same(v, usable[k][2]):
            out[i, counts[k], parts[i], parts[i] == i] += 1
            k += 1
        else:
            out[i, 0, i, True] += 1
    assert k == len(usable)
    return out


def _same(v, unit):
    x = np.array([np.nan if y is None else y for y in v], float)
    if not len(x) or not np.isfinite(x).all() or not x.any() or len(x) != len(unit):
        return False
    x = x / np.abs(x).max()
    return np.array_equal(x / np.sqrt((x * x).sum()), unit)


@pytest.mark.parametrize("shape", [{}, {"block": 16, "max_pivots": 12}, {"block": 16, "max_pivots": 0}])
def test_near_vectors(spark, docs, shape):
    rng = np.random.default_rng(4)
    rows, centres = [], rng.normal(size=(6, 8))
    for k in range(220):
        x = centres[k % 6] + rng.normal(size=8) * rng.choice([0.02, 0.2, 0.6])
        rows.append((1000 - k, [float(np.float32(y)) for y in x], k % 2))
    rows += [(2000 + k, rows[0][1], rows[0][2]) for k in range(5)]
    rows += [(1, None, 0), (2, [0.0] * 8, 0), (3, [float("nan")] * 8, 0), (4, rows[0][1], None), (5, [], 0)]
    rows += [(6, [float("inf")] * 8, 0), (7, [1.0, None], 0), (8, [1.0, 2.0], 0), (9, [2.0, 4.0], 0), (None, rows[0][1], 0)]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS)
    got = Counter(map(tuple, cover_tree.near_duplicates(table, **shape).collect()))
    assert got == brute_vectors(rows)
    assert cover_tree.near_duplicates(table.limit(0)).count() == 0
