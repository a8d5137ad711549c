import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cdrflow.llm.fit_packing import byte_bpe, pack_documents, pieces_of, plan_sequences
from cdrflow.llm.sentence_pieces import PieceModel, decode_documents, encode_documents, piece_digests

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_pieces_equal_the_library(library):
    model = PieceModel(PIECES)
    rng = random.Random(1)
    letters = " ▁ab\n\t\r  é日本語😀the ing\x00s<>0x41 =="
    texts = ["", " ", "▁", "  a  b ", "a▁ b", "<s>", "<0x41>", "a" * 2000, " " * 1001, "日本語" * 300, "0" * 33]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(1500)]
    texts += ["".join(chr(rng.randint(160, 0x2FFF)) for _ in range(rng.randint(1, 40))) for _ in range(500)]
    got = list(model.encode_batch(texts))
    assert got == library.encode(texts)
    assert [model.decode(ids) for ids in got] == library.decode(got)
    broken = [[rng.randrange(3, 259) for _ in range(rng.randint(1, 9))] for _ in range(500)]
    assert [model.decode(ids) for ids in broken] == [library.decode(ids) for ids in broken]


def test_piece_digests_of_tables(docs, sf_docs, no_docs, library):
    for table in (docs, sf_docs):
        rows = table.select("doc_id", "text").collect()
        want = Counter()
        for r in rows:
            ids = library.encode(r["text"] or "")
            sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
            want[r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))] += 1
        assert Counter(map(tuple, piece_digests(table, PIECES).collect())) == want
    assert piece_digests(no_docs, PIECES).count() == 0
    back = decode_documents(encode_documents(docs.filter("doc_id = 1"), PIECES), PIECES).first()
    assert back["decoded"] == docs.filter("doc_id = 1").first()["text"]


def test_byte_bpe_equals_the_library():
    library, encode = Tokenizer.from_file(BYTES), byte_bpe(BYTES)
    rng = random.Random(2)
    texts = ["<|endoftext|>", "a<|endoftext|> b", "", "  x \n\n y\t", "日本語😀", "a" * 3000, "it's 12345 we'll"]
    texts += ["".join(chr(rng.choice([rng.randint(0, 126), rng.randint(160, 0x2FFF)])) for _ in range(30)) for _ in range(800)]
    assert [encode(t) for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_of_documents():
    assert pieces_of(1, 4) == [(0, 1)]
    assert pieces_of(4, 4) == [(0, 4)]
    assert pieces_of(9, 4) == [(0, 1), (1, 4), (5, 4)]
    assert pieces_of(8, 4) == [(0, 4), (4, 4)]


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_whole_and_tight(seed):
    rng = random.Random(seed)
    histogram = Counter(min(100, int(rng.lognormvariate(3, 1)) + 1) for _ in range(3000))
    plan = plan_sequences(dict(histogram), 100)
    got = Counter()
    for count, lengths in plan:
        assert sum(lengths) <= 100
        assert sum(3 * n > 100 for n in lengths) <= 2
        for n in lengths:
            got[n] += count
    assert got == histogram
    least = -(-sum(n * c for n, c in histogram.items()) // 100)
    assert sum(c for c, _ in plan) <= 1.02 * least + 1


def test_packed_tables(docs, sf_docs, no_docs):
    library = Tokenizer.from_file(BYTES)
    for table in (docs, sf_docs):
        packed = pack_documents(table, BYTES).collect()
        sequences, want = defaultdict(list), Counter()
        for r in table.select("doc_id", "text").collect():
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
            for k, (s, n) in enumerate(pieces_of(len(ids))):
                want[r["doc_id"], k, s, n, zlib.crc32(struct.pack(f"<{n}I", *ids[s : s + n]))] += 1
        assert Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in packed) == want
        for p in packed:
            sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        for places in sequences.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 2048
    assert pack_documents(no_docs, BYTES).count() == 0
