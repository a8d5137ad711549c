"""Spelling variants, the token store and the vector codes."""

import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cdrflow.llm import cover_lloyd, gram_variants, token_store

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

# -- spelling variants ------------------------------------------------------


def _near(a: str, b: str) -> bool:
    """One code point inserted, deleted or replaced, by trying all of them."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def _brute_counts(rows, letters="abcdefghijklmnopqrstuvwxyz"):
    import re

    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def _brute_forms(counts):
    near = {w: [] for w in counts}
    for a, b in combinations(sorted(counts), 2):
        if _near(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, ns in near.items():
        best = min(ns, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    rows = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root))
    return rows


def _made_texts(seed: int, n: int):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcdeéñ", k=rng.randint(4, 9))) for _ in range(60)]
    texts = []
    for i in range(n):
        words = []
        for _ in range(60):
            w = rng.choice(stems)
            k = rng.randrange(len(w))
            words.append(rng.choice([w, w, w, w[:k] + w[k + 1 :], w[:k] + rng.choice("abcdeÉ") + w[k:], w[:k] + "x" + w[k + 1 :], w.upper()]))
        texts.append((i, " ".join(words)))
    return [*texts, (n, "granddad " * 20 + "granddat " * 8 + "grandxat " * 3)]  # a form of a form


COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(gram_variants, "MIN_COUNT", 2)  # long grams in a small dictionary
    rows = _made_texts(seed, 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in gram_variants.spelling_variants(docs).select(COLUMNS).collect()}
    want = _brute_forms(_brute_counts(rows))
    assert got == want and sum(1 for r in want if r[3]) > 20 and any(r[5] != r[3] for r in want if r[3])


def test_grams_that_an_edit_leaves_are_within_the_bound():
    """Whatever the dictionary: at most ``affected`` places lose their gram."""
    rng = random.Random(3)
    for _ in range(3000):
        letters = "ab" if rng.random() < 0.5 else "abcd"
        word = "".join(rng.choices(letters, k=rng.randint(5, 12)))
        k, c = rng.randrange(len(word) + 1), rng.choice(letters)
        other = rng.choice([word[:k] + c + word[k:], word[:k] + word[k + 1 :], word[:k] + c + word[k + 1 :]])
        if len(other) < 5 or other == word:
            continue
        words = [word, other, *("".join(rng.choices(letters, k=8)) for _ in range(6))]
        counts = Counter(w[a : a + q] for w in words for q in (2, 3, 4) for a in range(len(w) - q + 1))
        counts = {g: n for g, n in counts.items() if len(g) == 2 or n >= rng.choice([2, 3])}
        for g in [g for g in counts if len(g) > 2 and g[:-1] not in counts]:
            counts.pop(g, None)
        counts = {g: n for g, n in counts.items() if len(g) < 4 or g[:-1] in counts}
        index = gram_variants.GramIndex(counts)
        longest = gram_variants.longest_gram(min(len(word), len(other)))
        mine, seen = index.grams(word, longest)
        theirs, _ = index.grams(other, longest)
        left = sum((Counter(mine) & Counter(theirs)).values())
        bound = index.affected(len(word), seen)
        assert left >= len(mine) - bound and bound < len(mine)
        # And a pair meets in the lists: a rare gram of both, at the same place or one further on.
        a, b = sorted((word, other), key=len)
        met = set(index.rarest(a, longest)) & {(g, p - d) for g, p in index.rarest(b, longest) for d in ((0, 1) if len(b) > len(a) else (0,))}
        if _near(a, b):
            assert met


def test_variants_of_odd_documents(docs, no_docs, spark):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {tuple(r) for r in gram_variants.spelling_variants(docs).select(COLUMNS).collect()}
    assert got == _brute_forms(_brute_counts(rows))
    out = gram_variants.spelling_variants(no_docs)
    assert out.count() == 0 and set(COLUMNS) <= set(out.columns)
    plain = {r.word: r.n for r in gram_variants.word_counts(docs, least_length=1, least_count=1, damage=0).collect()}
    assert plain["one"] >= 3 and "z" * 20000 in plain


# -- token store ------------------------------------------------------------


def _reference(rows):
    """(doc_id, start, n_tokens, crc) by the library, in ascending order of id, null first."""
    tok = Tokenizer.from_file(WORD_BPE)
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_store_of_the_table_equals_the_library(spark, sf_docs):
    got = token_store.stored_documents(spark, sf_docs, WORD_BPE)
    rows = sorted(tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert rows == _reference([(r.doc_id, r.text) for r in sf_docs.select("doc_id", "text").collect()])


def test_store_of_odd_documents(spark, docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = token_store.stored_documents(spark, docs, WORD_BPE).collect()
    want = _reference(rows)
    # Documents of one id may stand in any order among themselves.
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, n, c) for i, _, n, c in want)
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:])) and ends[-1][1] == sum(r[2] for r in want)
    first = {}
    for r in got:
        first[r.doc_id] = min(first.get(r.doc_id, r.start), r.start)
    order = [i for i, _ in sorted(first.items(), key=lambda x: x[1])]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    assert Counter((r.doc_id, r.occurrence) for r in got) == Counter(
        (i, k) for i, n in Counter(i for i, _ in rows).items() for k in range(n))
    empty = token_store.stored_documents(spark, no_docs, WORD_BPE)
    assert empty.count() == 0 and empty.schema["start"].dataType.simpleString() == "bigint"


def test_keyed_access_with_and_without_spark(spark, tmp_path):
    rows = [(i * 7, f"text number {i} " * (i % 5)) for i in range(300)] + [(70, f"another {k}") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = f"{tmp_path}/store"
    token_store.write_store(docs, path, WORD_BPE)
    tok = Tokenizer.from_file(WORD_BPE)
    reader = token_store.KeyedReader(path)
    for i, text in rows[11:300:23]:
        assert reader.get(i).tolist() == [*tok.encode(text, add_special_tokens=False).ids, 1]
    assert reader.get(3) is None and reader.get(7, 1) is None and reader.get(70, 200) is not None
    # A key that is spread over several shards keeps one numbering.
    keys = spark.createDataFrame([(70, k) for k in range(203)] + [(7, 0), (8, 0), (None, 0)], "doc_id long, occurrence long")
    found = token_store.read_ids(token_store.locate(keys, path), path).collect()
    assert sorted((r.key, r.occurrence) for r in found) == [(7, 0), *((70, k) for k in range(201))]
    assert len({r.shard for r in found if r.key == 70}) > 1
    texts = Counter(tuple(np.frombuffer(r.ids, "<u4").tolist()) for r in found if r.key == 70)
    want = Counter(tuple([*tok.encode(t, add_special_tokens=False).ids, 1]) for i, t in rows if i == 70)
    assert texts == want
    raw = sum(f.stat().st_size for f in (tmp_path / "store/payload").glob("*.bin"))
    assert raw == 2 * sum(len(tok.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)  # nothing but ids


def test_perfect_hash_is_minimal_and_knows_strangers():
    rng = np.random.default_rng(1)
    h1, h2 = (rng.integers(0, 2**63, 20_000, dtype=np.uint64) for _ in range(2))
    h1[:50] = h1[50:100]  # equal first halves
    perfect = token_store.PerfectHash.build(h1, h2)
    assert sorted(perfect.slots(h1, h2)) == list(range(20_000))
    assert perfect.bits.sum() == 20_000 and len(perfect.bits) < 5 * 20_000
    row = token_store._pack(h1, h2, np.zeros(20_000), np.arange(20_000), np.ones(20_000))
    known, slots = token_store._find(row, h1, h2)
    assert known.all() and (slots["offset"] == np.arange(20_000)).all()
    s1, s2 = (rng.integers(0, 2**63, 20_000, dtype=np.uint64) for _ in range(2))
    assert not token_store._find(row, s1, s2)[0].any()


def test_word_encoder_equals_the_library():
    tok, encode = Tokenizer.from_file(WORD_BPE), token_store.WordEncoder(WORD_BPE, 2)
    rng = random.Random(2)
    signs = [*"abcdeXYZ'strvemld019 \n\t.,$%|<>éİſßÀÉñøŉǆʼα\x85\xa0²½ª­",
             "é", "<|endoftext|>", "'s", "'ll", "'re", "日本", "\U0001f600"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(20_000)]
    want = [np.asarray(e.ids, "<u2").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert encode(texts) == want


def test_words_in_use_are_merged_once_however_many_others_come(monkeypatch):
    """What is remembered is bounded, and a full table does not cost the words still in use."""
    monkeypatch.setattr(token_store, "_WORDS", 60)
    encode, tok, merged = token_store.WordEncoder(WORD_BPE, 2), Tokenizer.from_file(WORD_BPE), Counter()
    tokenize = encode.tokenize
    monkeypatch.setattr(encode, "tokenize", lambda signs: merged.update([signs]) or tokenize(signs))
    common = ["the", "The", "the,", "straße", "Straße.", "over***", "it's", "(Über)", "7b", "wörterbuch" * 20]
    for k in range(50):
        new = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + j)}q" for j in range(20)]
        texts = [" ".join(common), " ".join(new), " ".join(common[:4] + new[:3]) + "\né" + chr(0x301)]
        want = [np.asarray(e.ids, "<u2").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
        assert encode(texts) == want
    assert len(merged) > 1000 and [merged[w] for w in ("the", "over", "***", ",", "it", "'s", "b")] == [1] * 7
    for half in (encode.ids, encode.ids.older):
        assert len(half) <= 60 and not any(len(w) > token_store._LONG for w in half)


# -- vector codes -----------------------------------------------------------


def _brute_codes(rows, parts=4, entries=256, rounds=4):
    """The definition with plain integers: {vec_id: (code, error)}, codebooks."""
    v = np.array([[int(np.floor(1024 * float(x))) for x in r[1]] for r in rows], object)
    out, books = [], []
    for part in np.split(v, parts, axis=1):
        book = part[:entries].copy()
        for k in range(rounds + 1):
            d = ((part[:, None, :] - book[None]) ** 2).sum(2)
            mine = np.array([min(range(len(book)), key=lambda e: (r[e], e)) for r in d])
            if k < rounds:
                for e in set(mine.tolist()):
                    members = part[mine == e]
                    book[e] = [int(s) // len(members) for s in members.sum(0)]
        out.append((mine, d[np.arange(len(part)), mine]))
        books.append(book)
    codes = ["".join(f"{m[k]:02x}" for m, _ in out) for k in range(len(v))]
    return codes, [int(sum(e[k] for _, e in out)) for k in range(len(v))], books


VECTORS = "vec_id long, embedding array<float>, label int, code string, error long, v string, of int"


def _clustered(seed, n, d=16, clusters=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, d))
    return [(i, (centres[i % clusters] + 0.01 * rng.normal(size=d)).astype("float32").tolist(), i % 3, "c", 1, "v", 2) for i in range(n)]


def _codes(df):
    return sorted(((r.vec_id, r.code, r.error) for r in cover_lloyd.compressed_vectors(df).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_codes_equal_brute_force(spark, seed):
    rows = _clustered(seed, 700)
    codes, errors, _ = _brute_codes(rows)
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = cover_lloyd.compressed_vectors(df).orderBy("vec_id").collect()
    assert [(r.code, r.error) for r in got] == list(zip(codes, errors))
    sums = Counter()
    for r, e in zip(rows, errors):
        sums[r[2]] += e
    assert all(r.label_error == sums[r.vec_id % 3] for r in got) and len({r.codebooks_sha256 for r in got}) == 1


def test_codes_of_odd_rows(spark, docs):
    nan, inf = float("nan"), float("inf")
    rows = _clustered(3, 40)
    odd = [(100, None), (101, []), (102, [0.5] * 15 + [nan]), (103, [0.5] * 15 + [inf]), (104, [0.5] * 15 + [None]), (105, [0.5] * 8)]
    more = [(None, [0.25] * 16, None), (None, [0.25] * 16, None), (5, rows[5][1], None), (200, [0.0] * 16, None), (201, [-0.0] * 16, 7)]
    extra = [(i, v, 1, "c", 1, "v", 2) for i, v in odd] + [(i, v, x, "c", 1, "v", 2) for i, v, x in more]
    df = spark.createDataFrame(rows + extra, VECTORS)
    kept = sorted(rows + extra[len(odd) :], key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    codes, errors, _ = _brute_codes(kept)
    assert _codes(df) == sorted(((r[0], c, e) for r, c, e in zip(kept, codes, errors)), key=repr)
    none = cover_lloyd.compressed_vectors(df.filter("false"))
    assert none.count() == 0 and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert cover_lloyd.compressed_vectors(df.filter("vec_id in (100, 102)")).count() == 0
    with pytest.raises(Exception, match="too large"):
        cover_lloyd.compressed_vectors(spark.createDataFrame([(1, [1e9] * 16, 1, "c", 1, "v", 2)], VECTORS)).collect()
    with pytest.raises(ValueError, match="equal parts"):
        cover_lloyd.compressed_vectors(spark.createDataFrame([(1, [0.5] * 6, 1, "c", 1, "v", 2)], VECTORS))


@pytest.mark.parametrize("scale", [100, 2**26])
def test_tree_assigns_as_all_comparisons_do(scale):
    rng = np.random.default_rng(4)
    for spread in (0, 1, scale // 20, scale):
        base = rng.integers(-scale, scale, (30, 8))
        points = np.repeat(base, 20, 0) + rng.integers(-spread, spread + 1, (600, 8))
        book = np.concatenate([base[:20] + rng.integers(-5, 6, (20, 8)), base[:4]])
        tree = cover_lloyd.build_tree(points)
        entry, off = cover_lloyd.point_entries(cover_lloyd.Tree.load(tree.save()), book)
        d = ((points[:, None, :].astype(object) - book[None].astype(object)) ** 2).sum(2)
        want = [min(range(len(book)), key=lambda e: (r[e], e)) for r in d]
        assert entry.tolist() == want and off.tolist() == [r[e] for r, e in zip(d, want)]
        sums, n = cover_lloyd.entry_sums(tree, book)
        assert n.sum() == 600 and (sums.sum(0) == points.sum(0)).all()


def test_whole_subtrees_are_assigned_where_vectors_cluster():
    """Nested levels with halving radii, and far fewer comparisons than vectors."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-10_000, 10_000, (40, 16))
    points = np.repeat(centres, 25, 0) + rng.integers(-8, 9, (1000, 16))
    tree = cover_lloyd.build_tree(points)
    for k in range(len(tree.centre)):
        mine = tree.points[tree.lo[k] : tree.hi[k]].astype(np.int64)
        far = np.sqrt(((mine - tree.points[tree.centre[k]]) ** 2).sum(1).max())
        assert far <= tree.radius[k] * (1 + 1e-9)
        if tree.hi[k] - tree.lo[k] > cover_lloyd.LEAF and tree.last[k]:
            kids = range(tree.first[k], tree.last[k])
            assert all(tree.radius[c] <= tree.radius[k] / 2 * (1 + 1e-9) for c in kids)
            assert tree.centre[tree.first[k]] == tree.centre[k]  # nested
    lo, hi, _ = cover_lloyd.assign(tree, centres)
    assert (hi - lo).sum() == 1000 and len(lo) < 100
