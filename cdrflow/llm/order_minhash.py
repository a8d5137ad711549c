"""Document fingerprints by Order MinHash, in DataFrame functions only.

The k-mers are runs of ``K`` words.  Each occurrence of a k-mer is numbered
(first, second, ...), so repeated k-mers count as different items.  The hash
range is cut into ``CELLS`` cells, each of which stands for one hash function
(one-permutation sketching): in each cell the ``2`` minimal numbered k-mers
are selected, put back into text order and hashed as a tuple.  Moving text
about changes the order and with it the tuples, so the share of equal
entries falls with edit distance, not only with the set of k-mers.

All steps are array functions on one row: no shuffle, no Python.  Hashes and
positions travel packed in one long (40 bits of hash, 24 of position), so
both sorts are over plain longs.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdrflow.llm.common import let

K = 3
CELLS = 32
_CELL_BITS = 5
_POSITION_BITS = 24
_POSITION = (1 << _POSITION_BITS) - 1
EMPTY = "-" * 8
MAX_RANGES = 20_000  # ranges of ids, each ordered by one task (which can spill)


def _packed(hashed: Column, position: Column) -> Column:
    return hashed.bitwiseAND(F.lit(~_POSITION)).bitwiseOR(position.bitwiseAND(F.lit(_POSITION)).cast("long"))


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, _POSITION_BITS)


def _cell(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, 64 - _CELL_BITS)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def _kmers(words: Column) -> Column:
    """Packed hash and position of the k-mer at each word; the last ones are shorter."""
    return F.sort_array(
        F.transform(
            words,
            lambda w, i: _packed(F.xxhash64(w, *(F.get(words, i + j) for j in range(1, K))), i),
        )
    )


def _numbered(kmers: Column) -> Column:
    """The k-mers hashed together with their occurrence number, sorted again."""
    n = F.size(kmers)
    starts = F.filter(
        F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (_hash_of(F.get(kmers, i)) != _hash_of(F.get(kmers, i - 1)))
    )
    counted = let(
        F.concat(starts, F.array(n)),
        lambda s: F.flatten(
            F.transform(F.sequence(F.lit(0), F.size(s) - 2), lambda g: F.sequence(F.lit(0), F.get(s, g + 1) - F.get(s, g) - 1))
        ),
    )
    return F.sort_array(
        F.zip_with(kmers, counted, lambda p, o: _packed(F.xxhash64(_hash_of(p), o), p.bitwiseAND(F.lit(_POSITION))))
    )


def _entry(items: Column, i: Column) -> Column:
    """Hash of the two minimal items of the cell that starts at ``i``, in text order."""

    def ordered(a: Column, b: Column) -> Column:
        swap = a.bitwiseAND(F.lit(_POSITION)) > b.bitwiseAND(F.lit(_POSITION))
        first, second = F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b)
        return F.xxhash64(_hash_of(first), _hash_of(second))

    a, b = F.get(items, i), F.get(items, i + 1)
    value = F.when(_cell(a) == _cell(b), ordered(a, b)).otherwise(F.xxhash64(_hash_of(a)))
    return F.lower(F.lpad(F.hex(value.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))


def _signature(items: Column) -> Column:
    """``CELLS`` entries of 8 hex digits, ``EMPTY`` where the cell has no item."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size(items) - 1),
        lambda i: (i == 0) | (_cell(F.get(items, i)) != _cell(F.get(items, i - 1))),
    )

    def spread(at: Column) -> Column:
        cells = F.transform(at, lambda i: _cell(F.get(items, i)))
        return let(
            cells,
            lambda c: F.concat_ws(
                "",
                F.transform(
                    F.sequence(F.lit(0), F.lit(CELLS - 1)),
                    lambda k: F.when(F.array_contains(c, k.cast("long")), _entry(items, F.get(at, F.array_position(c, k.cast("long")).cast("int") - 1))).otherwise(EMPTY),
                ),
            ),
        )

    return let(starts, spread)


def fingerprint(text: Column) -> Column:
    """Signature string of ``text``; equal texts have equal ones.  Null, empty
    and blank texts have only empty entries."""
    made = let(words_of(text), lambda w: let(_kmers(w), lambda k: let(_numbered(k), _signature)))
    return F.when(F.length(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D]+", " "))) == 0, EMPTY * CELLS).otherwise(made)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries among those that either text has; two texts
    without entries are alike (1.0)."""
    entries = lambda s: F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda i: F.substring(s, i * 8 + 1, F.lit(8)))
    both = F.zip_with(entries(a), entries(b), lambda x, y: F.when((x == EMPTY) & (y == EMPTY), 2).otherwise((x == y).cast("int")))
    return let(
        both,
        lambda e: F.when(F.size(F.filter(e, lambda x: x < 2)) == 0, 1.0).otherwise(
            F.size(F.filter(e, lambda x: x == 1)) / F.size(F.filter(e, lambda x: x < 2))
        ),
    )


def _constant(value, kind: str) -> Column:
    """A literal that stays one node of the plan, however long it is."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _cuts(rows: DataFrame, buckets: int) -> list[int]:
    """At most ``buckets`` - 1 ids that cut the rows into ranges of like size."""
    shares = [k / buckets for k in range(1, buckets)]
    if not shares:
        return []
    # Errors of a tenth of a range do no harm.
    found = F.percentile_approx("id", _constant(shares, "array<double>"), max(10_000, 10 * buckets))
    return sorted(set(rows.agg(found.alias("c")).first()["c"] or []))


def _range_number(id_: Column, cuts: list[int]) -> Column:
    """How many cuts are not above the id, by a look-up in two levels; 0 for null."""
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts)) + 1
    groups = [cuts[k : k + width] for k in range(0, len(cuts), width)]
    heads, parts = _constant([g[0] for g in groups], "array<bigint>"), _constant(groups, "array<array<bigint>>")
    below = lambda bounds: F.size(F.filter(bounds, lambda c: c <= id_))
    group = below(heads)
    number = F.when(group == 0, 0).otherwise((group - 1) * width + below(F.get(parts, group - 1)))
    return F.when(id_.isNull(), 0).otherwise(number)


def with_next(docs: DataFrame, buckets: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, fp, next_text, next_fp) in ascending order of (id, text), the
    last row followed by the first; null texts are empty, null ids come first.

    The ids are cut at quantiles into ``buckets`` ranges and each range is
    ordered by itself.  Each range also receives one guard row, the first row
    of the range that follows, so the order needs no global sort and no join.
    The number of guard rows is the number of ranges.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("bucket", _range_number(F.col("id"), _cuts(rows, buckets)))
    firsts = rows.groupBy("bucket").agg(F.min(F.struct("id", "text")).alias("f"))
    order = Window.orderBy("bucket")  # one row per range
    guards = firsts.select(
        "bucket",
        F.coalesce(F.lead("f").over(order), F.first("f").over(order)).alias("f"),
    ).select(F.lit(None).cast(rows.schema["id"].dataType).alias("id"), F.col("f.text").alias("text"), "bucket", F.lit(1).alias("guard"))
    together = rows.withColumn("guard", F.lit(0)).unionByName(guards)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    marked = together.repartition(parts, "bucket").withColumn("fp", fingerprint(F.col("text")))
    ordered = Window.partitionBy("bucket").orderBy("guard", "id", "text")
    return (
        marked.withColumn("next_text", F.lead("text").over(ordered))
        .withColumn("next_fp", F.lead("fp").over(ordered))
        .filter("guard = 0")
        .select("id", "text", "fp", "next_text", "next_fp")
    )


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last quarter of code points replaced by as many of ``following``."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    One row per input row.  Null texts are empty.  Rows with one id are
    ordered by their text, equal rows follow each other.  Other columns are
    ignored; an empty table gives an empty result.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = with_next(docs, min(3 * parts, MAX_RANGES), id_col, text_col).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    marked = rows.withColumn("edited_fp", fingerprint(F.col("edited")))
    return marked.select(
        F.col("id").alias(id_col),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("fp").alias("fingerprint"),
        F.col("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
