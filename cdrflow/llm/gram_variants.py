"""Spelling variants of words by an index of variable-length grams.

Words are maximal runs of letters, counted over all texts.  Two words are near
when one inserted, deleted or replaced code point makes them equal.

Gram dictionary.  All grams of ``MIN_GRAM`` code points belong to it; a longer
gram of up to ``MAX_GRAM`` does when it is frequent: at least ``MIN_COUNT``
words' places and 1 / ``GRAMS`` of all places, so that each length has at most
``GRAMS`` long grams however many words there are.  Every place of a word
takes the longest gram of the dictionary that starts there; a gram never has
more than m - 2 code points, m being the length of the shorter word of a pair.

Affected grams.  An edit changes the gram of a place only if it touches the
code points that the choice has looked at: the gram itself, and the next code
point where the dictionary goes on.  The greatest number of places that one
edit touches is the word's bound; at most m - 2 of its m - 1 or more grams.

Merging.  Near words share all grams that the edit leaves, at the same place or
one further on.  So among the bound + 1 rarest grams of each word (one order
for all words) there is a common one: only these go to the lists, which are
keyed by gram, place and length and merged by one join.  What meets there is
verified.  Every near pair is found; nothing is cut.

Forms.  A word's form is its near word of largest count, if that is at least
twice its own.  Counts at least double along forms, so following them ends; it
is done by doubling the steps.

Defined results: null and empty texts hold no words; a null id counts as an
empty one in the checksum; repeated rows count again; ties go to the smaller
word in code-point order; an empty table gives no rows.  Texts are handled
whole, of any length.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdrflow.llm.common import broadcast_arrays, let, staged

LETTERS = r"[A-Za-zÀ-ÿ]+"
MIN_GRAM = 2
MAX_GRAM = 4
MIN_COUNT = 8
GRAMS = 50_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# -- words ------------------------------------------------------------------


def word_counts(docs: DataFrame, least_length: int = 5, least_count: int = 3, damage: int = 97) -> DataFrame:
    """(word, n) of the texts; ``damage`` deletes a code point of one run in
    so many, at a place given by the checksum of the id and the run."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(f"({LETTERS})"), F.lit(1))).alias("run"),
    )
    if damage:
        run, h = F.col("run"), F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        cut = lambda at: F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))
        lost = let(F.pmod(h, F.length(run)).cast("int"), cut)
        runs = runs.select(F.when(F.pmod(h, F.lit(damage)) == 0, lost).otherwise(run).alias("word"))
    else:
        runs = runs.select(F.col("run").alias("word"))
    counted = runs.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


# -- grams ------------------------------------------------------------------


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """{gram: how many places of the words it starts at}.

    Bounded: the square of the alphabet for the shortest grams, ``GRAMS`` for
    each greater length.
    """
    def of(q: int) -> Column:
        last = F.length("word") - (q - 1)
        return F.transform(F.sequence(F.lit(1), last), lambda k: F.col("word").substr(k, F.lit(q)))

    lengths = range(MIN_GRAM, MAX_GRAM + 1)
    every = words.select(F.explode(F.concat(*(of(q) for q in lengths))).alias("gram"))
    counts = every.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    places = words.agg(F.sum(F.length("word") - (MIN_GRAM - 1))).first()[0] or 0
    least = max(MIN_COUNT, -(-places // GRAMS))
    kept = counts.filter((F.length("gram") == MIN_GRAM) | (F.col("n") >= least))
    return {r.gram: r.n for r in kept.collect()}


class GramIndex:
    """The dictionary as tasks use it."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        #: Grams that a longer one of the dictionary goes on from.
        self.inner = {g[:-1] for g in counts if len(g) > MIN_GRAM}

    def grams(self, word: str, longest: int) -> tuple[list[str], list[int]]:
        """The gram of each place, and the end of what its choice has looked at."""
        grams, seen = [], []
        for a in range(len(word) - MIN_GRAM + 1):
            b = a + MIN_GRAM
            while b - a < longest and word[a:b] in self.inner and b < len(word) and word[a : b + 1] in self.counts:
                b += 1
            grams.append(word[a:b])
            seen.append(b + 1 if b - a < longest and word[a:b] in self.inner else b)
        return grams, seen

    @staticmethod
    def affected(length: int, seen: list[int]) -> int:
        """The most places whose choice one edit can change."""
        most = 0
        for i in range(length + 1):
            # Code point i replaced or deleted (or one appended: i == length).
            most = max(most, sum(a <= i < seen[a] for a in range(max(0, i - MAX_GRAM), min(i + 1, len(seen)))))
        return most

    def rarest(self, word: str, longest: int) -> list[tuple[str, int]]:
        """(gram, place) of the bound + 1 rarest grams."""
        grams, seen = self.grams(word, longest)
        order = sorted(range(len(grams)), key=lambda a: (self.counts.get(grams[a], 0), grams[a], a))
        return [(grams[a], a) for a in order[: self.affected(len(word), seen) + 1]]


def longest_gram(shorter: int) -> int:
    """The longest gram for pairs whose shorter word has so many code points."""
    return min(MAX_GRAM, shorter - 2)


def list_entries(words: DataFrame) -> DataFrame:
    """(longest, gram, place, word) of every word, once for each gram length that its pairs use."""
    sent = broadcast_arrays(words.sparkSession, gram_dictionary(words))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = GramIndex(sent.value)
        for batch in batches:
            rows: list[tuple] = []
            for word in batch.column("word").to_pylist():
                for longest in sorted({longest_gram(len(word) - 1), longest_gram(len(word))}):
                    if longest >= MIN_GRAM:
                        rows += [(longest, g, a, word) for g, a in index.rarest(word, longest)]
            longest, gram, place, word = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(longest, pa.int32()), pa.array(gram, pa.string()), pa.array(place, pa.int32()), pa.array(word, pa.string())],
                names=["longest", "gram", "place", "word"],
            )

    return words.select("word").mapInArrow(entries, "longest int, gram string, place int, word string")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other) for all pairs of near words, each pair once: the shorter
    word first, of equal lengths the smaller."""
    lists = staged(list_entries(words).withColumn("len", F.length("word")), "gram-lists")
    cap = lambda m: F.least(F.lit(MAX_GRAM), m - 2)
    key = ["longest", "gram", "place", "len"]
    # A word asks among words of its length, and among those one longer, where
    # a gram behind the edit stands one place further on.
    asked = lists.filter(F.col("longest") == cap(F.col("len"))).withColumn(
        "to",
        F.array(
            F.struct(F.col("place"), F.col("len")),
            F.struct(F.col("place"), (F.col("len") + 1).alias("len")),
            F.struct((F.col("place") + 1).alias("place"), (F.col("len") + 1).alias("len")),
        ),
    )
    asked = asked.select("longest", "gram", "word", F.explode("to").alias("to")).select(
        "longest", "gram", F.col("to.place").alias("place"), F.col("to.len").alias("len"), "word"
    )
    held = lists.withColumnRenamed("word", "other")
    longer = F.length("word") < F.col("len")
    met = asked.join(held, key).filter((longer | (F.col("word") < F.col("other"))))
    return met.filter(F.levenshtein("word", "other", 1) == 1).select("word", "other").distinct()


# -- forms ------------------------------------------------------------------


def variant_forms(words: DataFrame, factor: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n) of (word, n)."""
    pairs = staged(near_pairs(words), "near-pairs")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    # The smallest (-count, word): the largest count, ties by code points.
    best = both.join(counts, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("top")
    )
    top_n = -F.col("top.m")
    good = top_n >= factor * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("top.other")).alias("form"), F.when(good, top_n).cast("long").alias("form_n"),
    )


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` with ``root``: the last word on the way over forms."""
    ways = staged(forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = staged(
            ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("went")),
            "roots",
        )
        ways = ahead.select("word", "root")
        if ahead.filter("went").isEmpty():
            break
    return forms.join(ways, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """One row a word: word, n, n_near, form, form_n, root."""
    words = staged(word_counts(docs), "words")
    return with_roots(staged(variant_forms(words), "forms"))
