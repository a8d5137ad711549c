"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; its result is written as Parquet and read again.  All stages but the
last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrflow.llm.common import ship_package, staged, table
from cdrflow.llm.fit_packing import pack_documents
from cdrflow.llm.ngram_join import keep_one_per_component
from cdrflow.llm.quality_gam import keep_good
from cdrflow.llm.secret_scan import redact
from cdrflow.llm.substring_dedup import strip_repeats


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts are scored like any other (all figures 0); repeated
    rows share their fate; without labels of both kinds nothing is rejected.
    An empty table stays empty, as in all stages.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Near copies share at least 80 % of their five-word shingles.  Texts without
    words (null, empty, blank) and rows with a null id stay; of several rows
    with the id that stays one is kept, chosen by a hash of the row.
    """
    ship_package(spark)
    return keep_one_per_component(docs, percent=80, shingle=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier in the corpus are cut out of the texts.

    Null and empty texts and rows with a null id stay as they are.  Different
    texts that share an id are documents of their own.
    """
    ship_package(spark)
    return _recounted(strip_repeats(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; null and empty texts and repeated rows stay."""
    ship_package(spark)
    return _recounted(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and place.

    Null and empty texts are a piece of the closing id alone; repeated rows are
    packed one by one.
    """
    ship_package(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

#: The classifier and the tokenizer have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{k + 1}")
    return docs
