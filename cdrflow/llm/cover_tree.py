"""Embedding near-dedup by cover trees and dual traversal.

Vectors are compared within their label only.  Equal vectors become one class
with a multiplicity.  On the unit sphere a cosine threshold is a distance
threshold, so the links are the pairs of points within that distance.

Spark holds the top of the tree: labels beyond one block get pivots, every
class goes to the cell of its nearest pivot, and a pair of cells is dropped
when the distance of the pivots exceeds both covering radii plus the
threshold.  The remaining pairs of blocks (a cell, or a part of one that is
too large) are the tasks.  In a task each side is a cover tree, nested levels
of nets with halving radii, and both are traversed together: a pair of nodes
is pruned when its covering radii prove it too far apart, accepted whole when
they prove it close enough, split otherwise, and verified by cosines at the
leaves.  Nothing depends on a sample: the links are exact.

A task returns, for each of its classes, the number of links and a spanning
forest of them, never the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdrflow.llm.common import broadcast_arrays, staged
from cdrflow.llm.components import connected_components

THRESHOLD = 0.93
BLOCK = 2048  # classes on a side of a task
MAX_PIVOTS = 1024  # over all labels; they are broadcast
LEAF = 32
SLACK = 1e-9  # rounding of distances; nearer calls are left to the cosines


class Node:
    """A ball: centre, covering radius, and children or (at a leaf) its rows."""

    __slots__ = ("centre", "radius", "children", "rows")

    def __init__(self, points: np.ndarray, rows: np.ndarray, nominal: float = 2.0):
        self.centre = points[rows[0]]
        far = _distances(points[rows], self.centre)
        self.radius = float(far.max())
        self.rows = rows
        self.children: list[Node] = []
        if len(rows) <= LEAF or self.radius <= SLACK:
            return
        while nominal / 2 >= self.radius:
            nominal /= 2
        nominal /= 2
        # A net of radius ``nominal``, grown from the node's own centre by its farthest rows.
        nearest, owner, centres = far, np.zeros(len(rows), np.int64), 1
        while nearest.max() > nominal:
            if centres * 8 > len(rows):
                return  # the rows do not cluster at this radius: a wide leaf
            d = _distances(points[rows], points[rows[int(nearest.argmax())]])
            closer = d < nearest
            nearest, owner = np.where(closer, d, nearest), np.where(closer, centres, owner)
            centres += 1
        for k in range(centres):
            mine = owner == k
            order = np.argsort(nearest[mine], kind="stable")  # the centre first
            self.children.append(Node(points, rows[mine][order], nominal))


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    diff = points - centre
    return np.sqrt(np.einsum("ij,ij->i", diff, diff))


class Links:
    """Link counts by row and a spanning forest."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.counts = np.zeros(len(weights), np.int64)
        self.parent = np.arange(len(weights))
        self.forest: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.forest.append((x, y))

    def whole(self, left: np.ndarray, right: np.ndarray, same: bool) -> None:
        """Every row of ``left`` with every row of ``right`` (or with every other row)."""
        self.counts[left] += self.weights[right].sum()
        if same:
            self.counts[left] -= self.weights[left]
        else:
            self.counts[right] += self.weights[left].sum()
        for y in right:
            self.join(int(left[0]), int(y))
        if not same:
            for x in left[1:]:
                self.join(int(x), int(right[0]))

    def verified(self, points: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float, same: bool) -> None:
        for at in range(0, len(left), 512):
            part = left[at : at + 512]
            near = points[part] @ points[right].T >= threshold
            if same:
                near[np.arange(len(part)), at + np.arange(len(part))] = False
            i, j = np.nonzero(near)
            if not len(i):
                continue
            self.counts[part] += near @ self.weights[right]
            if not same:
                self.counts[right] += self.weights[part] @ near
            a, b = part[i], right[j]
            for x, y in zip(a.tolist(), b.tolist()):
                if self.parent[x] != self.parent[y]:
                    self.join(x, y)


def dual_traversal(points: np.ndarray, weights: np.ndarray, left: np.ndarray, right: np.ndarray | None, threshold: float) -> Links:
    """Links between the rows ``left`` and ``right`` (None: within ``left``) of unit vectors."""
    links = Links(weights)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    if not len(left) or right is not None and not len(right):
        return links
    first = Node(points, left)
    second = first if right is None else Node(points, right)
    stack = [(first, second)]
    while stack:
        a, b = stack.pop()
        if a is b:
            if 2 * a.radius <= reach - SLACK:
                links.whole(a.rows, a.rows, True)
            elif a.children:
                stack += [(x, y) for i, x in enumerate(a.children) for y in a.children[i:]]
            else:
                links.verified(points, a.rows, a.rows, threshold, True)
            continue
        apart = float(np.sqrt(((a.centre - b.centre) ** 2).sum()))
        if apart - a.radius - b.radius > reach + SLACK:
            continue
        if apart + a.radius + b.radius <= reach - SLACK:
            links.whole(a.rows, b.rows, False)
        elif a.children and (a.radius >= b.radius or not b.children):
            stack += [(x, b) for x in a.children]
        elif b.children:
            stack += [(a, y) for y in b.children]
        else:
            links.verified(points, a.rows, b.rows, threshold, False)
    return links


def _units(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    # Scaled first: squares of very small or large numbers would leave the range.
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _classes(vectors: DataFrame) -> DataFrame:
    """One row per distinct usable vector of a label: key, dim, v, rep, copies."""
    usable = (
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("v").isNotNull()
        & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    return (
        vectors.filter(usable)
        .groupBy("label", "k1", "k2")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
        .withColumn("dim", F.size("v"))
    )


def _with_tasks(classes: DataFrame, threshold: float, block: int, max_pivots: int) -> DataFrame:
    """``classes`` with one row per task (label, dim, left, right) they take part in, and their side."""
    spark = classes.sparkSession
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    sized = classes.join(sizes, ["label", "dim"])
    share = F.lit(2.0) / block
    pivots = (
        sized.filter((F.col("n") > block) & (F.pmod(F.xxhash64("k1", "k2"), F.lit(1 << 30)) < share * (1 << 30)))
        .orderBy(F.desc("n"), "label", "dim", F.xxhash64("k1", "k2"))
        .limit(max_pivots)
        .select("label", "dim", "v")
        .collect()
    )
    by_label: dict = {}
    for r in pivots:
        by_label.setdefault((r["label"], r["dim"]), []).append(r["v"])
    by_label = {k: _units(v) for k, v in by_label.items()}
    shared = broadcast_arrays(spark, by_label)

    def nearest(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for label, dim, v in batches:
            cell, far = np.zeros(len(v), np.int64), np.zeros(len(v))
            for key, rows in pd.Series(range(len(v))).groupby([label.to_numpy(), dim.to_numpy()]).groups.items():
                if key in shared.value:
                    rows = np.asarray(rows)
                    x, p = _units(v.iloc[rows]), shared.value[key]
                    d = np.sqrt(np.maximum(0, 2 - 2 * x @ p.T))
                    cell[rows], far[rows] = d.argmin(1), d.min(1)
            yield pd.DataFrame({"cell": cell, "far": far})

    if by_label:
        cells = F.pandas_udf(nearest, "cell long, far double")
        sized = staged(sized.withColumn("c", cells("label", "dim", "v")).select("*", "c.*").drop("c"), "cells")
        stats = (
            sized.filter(F.col("n") > block)
            .join(F.broadcast(spark.createDataFrame([k for k in by_label], "label long, dim int")), ["label", "dim"])
            .groupBy("label", "dim", "cell")
            .agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"))
            .collect()  # at most ``max_pivots`` rows
        )
    else:
        sized, stats = sized.withColumn("cell", F.lit(0).cast("long")), []
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    layout = {}
    for key, p in by_label.items():
        mine = {r["cell"]: r for r in stats if (r["label"], r["dim"]) == key}
        parts = np.array([-(-mine[c]["n"] // block) if c in mine else 0 for c in range(len(p))])
        radius = np.array([mine[c]["radius"] if c in mine else 0.0 for c in range(len(p))])
        apart = np.sqrt(np.maximum(0, 2 - 2 * p @ p.T))
        # Radii and distances come from dot products here, hence the wider slack.
        near = apart <= radius[:, None] + radius[None, :] + reach + 1e-6
        layout[key] = (parts, np.concatenate(([0], np.cumsum(parts))), near)
    plan = broadcast_arrays(spark, layout)

    def blocks_of(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for label, dim, n, cell, key in batches:
            out = []
            for la, di, size, c, k in zip(label, dim, n, cell, key):
                if (la, di) in plan.value:
                    parts, first, near = plan.value[la, di]
                    own = int(first[c] + k % parts[c])
                    partners = np.concatenate([np.arange(first[x], first[x + 1]) for x in np.flatnonzero(near[c])])
                else:
                    blocks = -(-size // block)
                    own, partners = int(k % blocks), np.arange(blocks)
                out.append([own, *partners.tolist()])
            yield pd.Series(out, dtype=object)

    # The own block, then the blocks to compare it with (itself among them).
    blocks = F.pandas_udf(blocks_of, "array<long>")
    kept = ["label", "dim", "rep", "copies", "v"]
    placed = sized.select(*kept, blocks("label", "dim", "n", "cell", "k1").alias("blocks"))
    own, other = F.element_at("blocks", 1), F.col("other")
    return placed.select(
        *kept, "blocks", F.explode(F.slice("blocks", 2, F.size("blocks") - 1)).alias("other")
    ).select(
        *kept, F.least(own, other).alias("left"), F.greatest(own, other).alias("right"), (own > other).cast("int").alias("side")
    )


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, max_pivots: int = MAX_PIVOTS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Rows with a null label, null id, or a vector that is null, empty, zero or
    has null or non-finite components link with nothing and are their own
    component.  Vectors of different length are not compared.  Repeated rows
    are vectors of their own, linked with each other.  Other columns are
    ignored; an empty table gives an empty result.
    """
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v")
    )
    rows = rows.withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit("second"), "v"))
    classes = staged(_classes(rows), "vector-classes")

    def links_of(key: tuple, task: pd.DataFrame) -> pd.DataFrame:
        points, ids = _units(task["v"]), task["rep"].to_numpy()
        side = task["side"].to_numpy()
        left = np.flatnonzero(side == 0)
        right = None if key[2] == key[3] else np.flatnonzero(side == 1)
        found = dual_traversal(points, task["copies"].to_numpy(), left, right, threshold)
        hit = np.flatnonzero(found.counts)
        a = [ids[x] for x, _ in found.forest]
        b = [ids[y] for _, y in found.forest]
        return pd.concat([
            pd.DataFrame({"a": ids[hit], "b": ids[hit], "n": found.counts[hit]}),
            pd.DataFrame({"a": a, "b": b, "n": 0}),
        ]).astype("int64")

    tasks = _with_tasks(classes, threshold, block, max_pivots)
    links = staged(
        tasks.groupBy("label", "dim", "left", "right").applyInPandas(links_of, "a long, b long, n long"), "vector-links"
    )
    counts = links.filter("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("linked"))
    parts = connected_components(links.filter("a <> b")).select(F.col("id").alias("rep"), "component")
    known = (
        classes.select("label", "k1", "k2", "rep", "copies")
        .join(counts, "rep", "left")
        .join(parts, "rep", "left")
        .select(
            F.col("label").alias("c_label"), F.col("k1").alias("c1"), F.col("k2").alias("c2"),
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    on = (F.col("label") == F.col("c_label")) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))
    out = rows.select("id", "label", "k1", "k2").join(known, on & F.col("id").isNotNull(), "left")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )
