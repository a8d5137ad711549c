import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from cdrflow.llm.common import staged, table  # noqa: E402
from cdrflow.llm.quality_gam import score_documents  # noqa: E402
from cdrflow.llm.secret_scan import secret_spans  # noqa: E402
from test_dedup import brute_jaccard, brute_windows  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), "stage")
        out.append((name, docs))
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_names_and_columns(stages):
    columns = stages[0][1].columns
    assert [n for n, _ in stages[1:]] == [n for n, _ in corpus_pipeline.STAGES]
    for _, df in stages[1:-1]:
        assert df.columns == columns
        assert df.filter("n_chars <> length(text)").count() == 0


def test_rejected_documents_go_and_good_ones_stay(spark, stages):
    scored = score_documents(stages[0][1], table(spark, SF, "labels")).collect()
    want = Counter(r["doc_id"] for r in scored if r["predicted"])
    assert Counter(i for i, _ in rows(stages[1][1])) == want
    good = {r["doc_id"] for r in table(spark, SF, "labels").filter("quality = 1").collect()}
    assert len(good & want.keys()) >= 0.95 * len(good)


def test_one_document_of_each_group_stays(stages):
    before = rows(stages[1][1])
    want = {i for i, n, part in brute_jaccard(before, 80, 5) if part == i}
    assert sorted(i for i, _ in rows(stages[2][1])) == sorted(want)


def test_repeated_passages_are_cut(stages):
    before = rows(stages[2][1])
    texts = dict(rows(stages[3][1]))
    import hashlib

    for (i, n, gone, digest), count in brute_windows(before).items():
        assert count == 1
        kept = re.findall(rb"[^\x20\x09-\x0D]+", (texts[i] or "").encode())
        assert len(kept) == n - gone and hashlib.sha256(b" ".join(kept)).hexdigest() == digest
        if not gone:
            assert texts[i] == dict(before)[i]


def test_secrets_are_replaced(stages):
    before, after = dict(rows(stages[3][1])), dict(rows(stages[4][1]))
    assert before.keys() == after.keys()
    for i, t in before.items():
        spans = secret_spans(t)
        assert (after[i] == t) == (not spans)
        for s, e, _ in spans:
            assert t[s:e] not in after[i]


def test_sequences_hold_the_remaining_texts(spark, stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter({i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows(stages[4][1])})
    got, sequences = Counter(), defaultdict(int)
    for r in stages[5][1].collect():
        got[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]] += r["length"]
    assert got == want and max(sequences.values()) <= 2048
    assert entry.queries()["pipeline"](spark, SF).count() == stages[5][1].count()


def test_messy_documents_pass_all_stages(spark, docs):
    columns = docs.columns
    kept = staged(corpus_pipeline.STAGES[0][1](spark, docs, SF), "stage")  # rejects by the labels of the table
    assert kept.columns == columns and kept.count() <= docs.count()
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = staged(stage(spark, docs, SF), "stage")
        assert docs.columns == columns
    # One of the equal texts is left, and what has no words is there still.
    ids = Counter(r["doc_id"] for r in docs.collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[7] == 1 and ids[15] == 0 and {4, 5, 6} <= set(ids) and ids[None] == 2
    packed = Counter(r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect())
    assert set(packed) == set(ids)


def test_empty_table_passes_all_stages(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), "stage")
        assert docs.count() == 0


def test_without_labels_nothing_is_rejected(spark, docs):
    from cdrflow.llm.quality_gam import keep_good

    assert keep_good(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == docs.count()
