"""N-gram Jaccard join with filters under several token orders.

A document is the set of its 3-word shingles.  Sets whose Jaccard similarity
reaches the threshold share a token among the first few of each set (the
prefix) under *any* global order of the tokens.  Candidates must pass this under
several orders at once: they are found through the prefix tokens of the first
order, with length and position filters in the same join, and only those whose
prefixes also meet under the second and third order, and which can share enough
tokens by their counts in ``CELLS`` cells, are verified exactly.

All orders put frequent tokens last, the more frequent the later.  Which tokens
count as frequent (those of most documents in a first pass over all of them,
at most ``MAX_FREQUENT``) affects the cost only: the prefix property holds for
every order.

Equal sets are one node.  A posting list in which nodes have few possible
partners yields its pairs.  A dense one (a group of near copies) never does.  Its
node whose prefix is most common, the likely original, becomes a hub and is
compared with all others.  By the triangle inequality two similar nodes are
then either both near the hub or both not close to it:

* both near: they are linked through the hub, or they share an element of their
  differences from the hub (a token they both lack or both add).  These small
  difference sets are joined by prefix filter, for nodes of different components;
* the others form a shorter list, which is treated in the same way.

So a large group of near copies costs a star and a join of its edits, not a
square, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdrflow.llm.common import broadcast_arrays, staged
from cdrflow.llm.components import connected_components
from cdrflow.llm.words import mix, shingles, signed

SHINGLE = 3
PERCENT = 90
ORDERS = (1, 2, 3)  # seeds
FREQUENT = 8  # documents that make a token frequent
MAX_FREQUENT = 500_000
DENSE = 64  # nodes of like size per node of a list from which on it gets a hub
HUB_ROUNDS = 2  # then what is left of the dense lists yields its pairs
CELLS = 256  # of a set's tokens, for a bound of what two sets share
MAX_BROADCAST_IDS = 2_000_000  # numbers of 8 bytes; more are joined by a shuffle


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Tokens of which sets of ``n`` tokens share one with any similar set."""
    return n - -(-percent * n // 100) + 1 if n else 0


def ordered(tokens: np.ndarray, seed: int, frequent=None) -> tuple[np.ndarray, int]:
    """The tokens in the order of ``seed``, frequent ones last and the more
    frequent later, and how many are not frequent."""
    keys = mix(tokens, seed)
    if frequent is None or not len(frequent[0]):
        return tokens[np.argsort(keys)], len(tokens)
    known, classes = frequent
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    late = np.where(known[at] == tokens, classes[at], 0)
    return tokens[np.lexsort((keys, late))], int((late == 0).sum())


def frequent_tokens(
    texts: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted tokens that stand in many documents, counted over all of them, and
    the size class of each (1 or more; counts of like size share one).

    A token that several documents of a batch share is counted wherever it
    stands, others where they stand in a prefix.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [s for s in (shingles(t, shingle) for t in batch["text"]) if len(s)]
            if not sets:
                continue
            tokens, n = np.unique(np.concatenate(sets), return_counts=True)
            first = np.concatenate([ordered(s, ORDERS[0])[0][: prefix_length(len(s), percent)] for s in sets])
            counted = (n > 1) | np.isin(tokens, first)
            yield pd.DataFrame({"token": signed(tokens[counted]), "n": n[counted]})

    rows = (
        texts.select("text")
        .mapInPandas(count, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= FREQUENT)
        .orderBy(F.desc("n"), "token")
        .limit(MAX_FREQUENT)
        .toPandas()
    )
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.log2(rows["n"].to_numpy(np.float64)[order]).astype(np.int64)


_SET = "struct<k1:long,k2:long,n:int,rare:int,prefix:array<long>>"


def _described(text: Column, frequent, percent: int, shingle: int) -> Column:
    def describe(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            rows = []
            for t in texts:
                s = shingles(t, shingle)
                key = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                tokens, rare = ordered(s, ORDERS[0], frequent.value)
                rows.append((key[0], key[1], len(s), rare, signed(tokens[: prefix_length(len(s), percent)])))
            yield pd.DataFrame(rows, columns=["k1", "k2", "n", "rare", "prefix"])

    return F.pandas_udf(describe, _SET)(text)


_SKETCH = "struct<n:int,counts:array<int>,second:array<int>,third:array<int>>"


def _sketches(text: Column, frequent, percent: int, shingle: int) -> Column:
    """What a pair is judged by before its sets are fetched: the prefixes under
    the other orders, as 32-bit numbers, and how many tokens fall into each of
    ``CELLS`` cells."""

    def describe(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            rows = []
            for t in texts:
                s = shingles(t, shingle)
                p = prefix_length(len(s), percent)
                counts = np.bincount((s % np.uint64(CELLS)).astype(np.int64), minlength=CELLS).astype(np.int32)
                late = (ordered(s, o, frequent.value)[0][:p].astype(np.uint32).view(np.int32) for o in ORDERS[1:])
                rows.append((len(s), counts, *late))
            yield pd.DataFrame(rows, columns=["n", "counts", "second", "third"])

    return F.pandas_udf(describe, _SKETCH)(text)


def _tokens(text: Column, shingle: int) -> Column:
    def tokens(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            yield pd.DataFrame({"tokens": [signed(shingles(t, shingle)) for t in texts]})

    return F.pandas_udf(tokens, "struct<tokens:array<long>>")(text)


def _may_link(percent: int) -> Column:
    """Position filter, which implies the length filter.

    If the shared token is the first one that two similar sets share, all
    their common tokens stand from it on: the smaller rest bounds the
    overlap, which must reach percent / (100 + percent) of both sizes.
    """
    rest = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos"))
    return rest * (100 + percent) >= percent * (F.col("a.n") + F.col("b.n"))


def _pairs(left: DataFrame, right: DataFrame, percent: int, also: Column | None = None) -> DataFrame:
    on = (F.col("a.token") == F.col("b.token")) & (F.col("a.node") != F.col("b.node")) & _may_link(percent)
    joined = left.alias("a").join(right.alias("b"), on if also is None else on & also)
    return joined.select(
        F.least("a.node", "b.node").alias("x"), F.greatest("a.node", "b.node").alias("y")
    ).distinct()


def _if_small(ids: DataFrame) -> DataFrame:
    """A written one-column table, marked for broadcast if it has few rows."""
    return F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids


def _of_nodes(pairs: DataFrame, docs: DataFrame, made: Column, name: str) -> DataFrame:
    """(node, s): ``made`` from the text of every node of ``pairs``."""
    ids = staged(pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct(), "candidate-ids")
    chosen = docs.join(_if_small(ids), docs["id"] == ids["node"], "left_semi")
    return staged(chosen.select(F.col("id").alias("node"), made.alias("s")), name)


def _attached(pairs: DataFrame, sets: DataFrame, *fields: str) -> DataFrame:
    """``pairs`` with the named fields of both nodes as ``a`` and ``b``."""
    side = sets.select("node", F.struct(*(F.col(f"s.{f}").alias(f) for f in fields)).alias("s"))
    return pairs.join(side.select(F.col("node").alias("x"), F.col("s").alias("a")), "x").join(
        side.select(F.col("node").alias("y"), F.col("s").alias("b")), "y"
    )


def _verified(pairs: DataFrame, docs: DataFrame, frequent, percent: int, shingle: int) -> DataFrame:
    """(x, y): the pairs whose prefixes also meet under the other orders and that are similar.

    Two sets share at most the smaller count of each cell, summed over cells.
    That bound and the orders are judged on short sketches; whole sets are
    fetched for what is left, which is little more than the links.
    """
    text = F.col("text")
    sketches = _of_nodes(pairs, docs, _sketches(text, frequent, percent, shingle), "candidate-sketches")
    most = F.aggregate(F.zip_with("a.counts", "b.counts", lambda p, q: F.least(p, q)), F.lit(0), lambda t, c: t + c)
    met = _attached(pairs, sketches, "n", "counts", "second", "third").filter(
        (most * (100 + percent) >= percent * (F.col("a.n") + F.col("b.n")))
        & F.arrays_overlap("a.second", "b.second")
        & F.arrays_overlap("a.third", "b.third")
    )
    met = staged(met.select("x", "y"), "met")
    both = _attached(met, _of_nodes(met, docs, _tokens(text, shingle), "candidate-sets"), "tokens")
    shared = F.size(F.array_intersect("a.tokens", "b.tokens"))
    total = F.size("a.tokens") + F.size("b.tokens")
    return both.filter(100 * shared >= percent * (total - shared)).select("x", "y")


def _dense_tokens(lists: DataFrame, percent: int) -> DataFrame:
    """Tokens in whose list a node has more than ``DENSE`` others of like size on average."""
    like = F.floor(F.log(F.col("n").cast("double")) / np.log(100 / percent)).cast("int")
    bins = lists.groupBy("token", like.alias("like")).agg(F.count(F.lit(1)).alias("c"))
    sums = bins.groupBy("token").agg(F.sum(F.col("c") * F.col("c")).alias("pairs"), F.sum("c").alias("size"))
    return sums.filter(F.col("pairs") > DENSE * F.col("size")).select("token")


def _hubs(crowded: DataFrame, percent: int) -> DataFrame:
    """(token, hub): in each list the node whose prefix lies most in long lists.

    Copies that were edited have rare tokens in their prefix, the original has none.
    """
    sizes = crowded.groupBy("token").agg(F.log(F.count(F.lit(1))).alias("size"))
    slots = F.col("n") * (100 - percent) / 100 + 1
    central = (
        crowded.join(sizes, "token").groupBy("node").agg(F.round(F.sum("size") / F.first(slots), 6).alias("central"))
    )
    return crowded.join(central, "node").groupBy("token").agg(
        F.min(F.struct(-F.col("central"), "node")).getField("node").alias("hub")
    )


def _differences(stars: DataFrame, percent: int) -> DataFrame:
    """(hub, h, node, weight, size, pos, elem, seen): the prefix of each near node's difference from its hub.

    ``elem`` is an added token, or the complement of one that the node lacks;
    ``seen`` holds the elements before it.

    With H tokens in the hub, of which a node lacks M and to which it adds R,
    two nodes that share o elements of their differences are similar exactly if
    (100 + p) o >= W1 + W2 - (100 - p) H, where W = 100 M + p R.  As o is at
    most the size of either difference, o >= (W1 - (100 - p) H) / 100, which
    gives the length of the prefix.  Added tokens come first: most are unique.
    """
    lacks, adds = F.array_except("a.tokens", "b.tokens"), F.array_except("b.tokens", "a.tokens")
    made = stars.select(
        F.col("x").alias("hub"), F.size("a.tokens").alias("h"), F.col("y").alias("node"),
        lacks.alias("lacks"), adds.alias("adds"),
    )
    weighed = made.withColumn("weight", 100 * F.size("lacks") + percent * F.size("adds")).withColumn(
        "size", F.size("lacks") + F.size("adds")
    )
    least = F.greatest(F.lit(1), F.ceil((F.col("weight") - (100 - percent) * F.col("h")) / 100).cast("int"))
    all_ = F.concat(F.array_sort("adds"), F.transform(F.array_sort("lacks"), F.bitwise_not))
    return (
        weighed.withColumn("prefix", F.slice(all_, F.lit(1), F.greatest(F.lit(0), F.col("size") - least + 1)))
        .select("hub", "h", "node", "weight", "size", "prefix", F.posexplode("prefix").alias("pos", "elem"))
        .withColumn("seen", F.slice("prefix", F.lit(1), F.col("pos")))
        .drop("prefix")
    )


def _placed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` with the component of their node as ``part``."""
    return rows.join(parts.select(F.col("id").alias("node"), "component"), "node", "left").withColumn(
        "part", F.coalesce("component", "node")
    )


def _edit_stars(placed: DataFrame) -> DataFrame:
    """(x, y): for each shared element the node nearest to the hub with all others of
    different components.  Copies of a copy share its edits and meet in it."""
    leaders = placed.groupBy("hub", "elem").agg(
        F.min(F.struct("weight", "node", "part")).alias("l"), F.count(F.lit(1)).alias("n")
    )
    rows = placed.join(leaders.filter("n > 2"), ["hub", "elem"]).filter("part <> l.part")
    return rows.select(F.least("node", "l.node").alias("x"), F.greatest("node", "l.node").alias("y")).distinct()


def _edit_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """(x, y): near nodes of one hub, in different components, that may be similar
    by their differences; each pair comes from the first element that it shares."""
    shared = F.least(F.col("a.size") - F.col("a.pos"), F.col("b.size") - F.col("b.pos"))
    needed = F.col("a.weight") + F.col("b.weight") - (100 - percent) * F.col("a.h")
    on = (
        (F.col("a.hub") == F.col("b.hub"))
        & (F.col("a.elem") == F.col("b.elem"))
        & (F.col("a.node") < F.col("b.node"))
        & (F.col("a.part") != F.col("b.part"))
        & (shared * (100 + percent) >= needed)
        & ~F.arrays_overlap("a.seen", "b.seen")
    )
    joined = placed.alias("a").join(placed.alias("b"), on)
    return joined.select(F.col("a.node").alias("x"), F.col("b.node").alias("y")).distinct()


def _links(postings: DataFrame, docs: DataFrame, frequent, percent: int, shingle: int) -> DataFrame:
    """(x, y): similar nodes, enough of them to connect every component."""
    lists, links, differences = postings, None, None
    below = F.col("a.node") < F.col("b.node")
    for round_ in range(HUB_ROUNDS + 1):
        dense = staged(_dense_tokens(lists, percent), "dense-tokens")
        last = round_ == HUB_ROUNDS or dense.isEmpty()
        sparse = lists if last else lists.join(dense, "token", "left_anti")
        found = _verified(staged(_pairs(sparse, sparse, percent, below), "candidates"), docs, frequent, percent, shingle)
        if last:
            found = staged(found, "links")
            links = found if links is None else links.unionByName(found)
            break
        crowded = staged(lists.join(dense, "token"), "dense-lists")
        hubs = _hubs(crowded, percent)
        rows = crowded.join(hubs, "token").filter("node <> hub")
        stars = staged(rows.select(F.col("hub").alias("x"), F.col("node").alias("y")).distinct(), "stars")
        # Plain equality decides here: a hub is no candidate of a prefix, it is compared with all.
        common = F.size(F.array_intersect("a.tokens", "b.tokens"))
        total = F.size("a.tokens") + F.size("b.tokens")
        sets = _of_nodes(stars, docs, _tokens(F.col("text"), shingle), "star-sets")
        judged = _attached(stars, sets, "tokens").withColumn("common", common)
        judged = judged.withColumn("union", total - F.col("common"))
        # Similar nodes differ by at most 1 - p/100 in their distance to the hub.
        near, close = 2 * F.col("common") >= F.col("union"), 100 * F.col("common") >= (150 - percent) * F.col("union")
        judged = staged(
            judged.select(
                "x", "y", (100 * F.col("common") >= percent * F.col("union")).alias("link"), close.alias("close"),
                F.when(near, F.col("a")).alias("a"), F.when(near, F.col("b")).alias("b"),
            ),
            "judged-stars",
        )
        found = staged(found.unionByName(judged.filter("link").select("x", "y")), "links")
        links = found if links is None else links.unionByName(found)
        fresh = staged(_differences(judged.filter("a is not null"), percent), "differences")
        differences = fresh if differences is None else differences.unionByName(fresh)
        far = judged.filter(~F.col("close")).select(F.col("x").alias("hub"), F.col("y").alias("node"))
        lists = staged(rows.join(far, ["hub", "node"], "left_semi").drop("hub"), "far-lists")
    if differences is not None:
        for pairs_of in (_edit_stars, lambda placed: _edit_pairs(placed, percent)):
            parts = staged(connected_components(links, "x", "y"), "parts")
            pairs = staged(pairs_of(staged(_placed(differences, parts), "differences")), "edit-pairs")
            links = links.unionByName(staged(_verified(pairs, docs, frequent, percent, shingle), "links"))
    return links


def jaccard_components(
    docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id), one row per row of ``docs``.

    Documents link when 100 * intersection >= percent * union of their
    shingle sets.  Documents without words (null, empty, blank) have 0
    shingles and link with nothing.  Rows that share an id are one node.
    Rows with a null id link with nothing and have a null component.  Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # At most ``MAX_FREQUENT`` tokens with a number each.
    frequent = broadcast_arrays(spark, frequent_tokens(texts, percent, shingle))
    described = texts.select("id", _described(F.col("text"), frequent, percent, shingle).alias("s"))
    known = staged(described.select("id", "s.*"), "shingle-sets")
    nodes = staged(
        known.filter("n > 0 and id is not null")
        .groupBy("k1", "k2")
        .agg(F.min(F.struct("id", "n", "rare", "prefix")).alias("r"))
        .select("k1", "k2", F.col("r.id").alias("node"), "r.n", "r.rare", "r.prefix"),
        "shingle-nodes",
    )
    postings = nodes.select("node", "n", "rare", F.posexplode("prefix").alias("pos", "token"))
    lists = postings.groupBy("token").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("token")
    lists = staged(lists, "shared-tokens")
    shared = staged(postings.join(_if_small(lists), "token", "left_semi"), "postings")
    parts = connected_components(_links(shared, texts, frequent, percent, shingle), "x", "y")
    by_set = (
        nodes.select("k1", "k2", "node")
        .join(parts.select(F.col("id").alias("node"), "component"), "node", "left")
        .select("k1", "k2", F.coalesce("component", "node").alias("set_part"))
    )
    return (
        known.join(by_set, ["k1", "k2"], "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("n") > 0, F.coalesce("set_part", "id")).otherwise(F.col("id")).alias("component_id"),
        )
        .withColumn("component_id", F.when(F.col(id_col).isNotNull(), F.col("component_id")))
    )


def keep_one_per_component(
    docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their component.

    The row with the component's smallest id stays; of several rows with that id
    one stays, chosen by a hash of the row.  Rows without words and rows with
    a null id stay.
    """
    found = staged(jaccard_components(docs, percent, shingle, id_col, text_col), "components")
    # Ids that stand for others, rather than those that stay: they are far fewer.
    gone = staged(
        found.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("gone_id")).distinct(), "gone"
    )
    kept = docs.join(_if_small(gone), docs[id_col] == gone["gone_id"], "left_anti")
    repeated = found.filter(F.col("n_shingles") > 0).groupBy(F.col(id_col).alias("repeated_id")).agg(
        F.count(F.lit(1)).alias("rows_of_id")
    )
    repeated = staged(repeated.filter("rows_of_id > 1 and repeated_id is not null").select("repeated_id"), "repeated-ids")
    if repeated.isEmpty():
        return kept
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    on = docs[id_col] == repeated["repeated_id"]
    one = (
        kept.join(repeated, on, "left_semi")
        .groupBy(F.col(id_col).alias("_key"), (F.length(F.trim(F.col(text_col))) > 0).alias("_words"))
        .agg(F.min_by(row, F.xxhash64(row)).alias("_row"))
        .select("_row.*")
    )
    return kept.join(repeated, on, "left_anti").unionByName(one)
