"""Compact codes for vectors: product codebooks trained by Lloyd rounds over cover trees.

Components become integers (``floor(1024 x)``) and a vector is cut into
``PARTS`` equal parts with a codebook each.  Every task cuts its vectors into
chunks and builds one cover tree a chunk and part: nested levels in which a
node's own centre goes on as a child and the covering radius halves.  A
subtree is one stretch of the chunk's order, so cumulative sums give its sum
and size by two look-ups.  The trees are written once and read by all rounds.

A round sends the codebooks (at most ``ENTRIES`` entries a part) to the
tasks.  A node whose centre is at distance d1 of its nearest entry, with
covering radius r, drops every entry beyond d1 + 2r: by the triangle
inequality no vector below is as near to it.  Where one entry is left, the
whole subtree goes to it; only the other nodes descend, down to single (or
equal) vectors, which are compared exactly in integers.  Tasks return one sum
an entry; the driver holds the codebooks and nothing else.

Defined results: vectors that are null, empty, or hold null or non-finite
components are left out, and so are vectors whose length is not that of the
smallest kept id.  Ids are ordered ascending with null last, equal ids by
their components; repeated rows are separate vectors.  With fewer than
``ENTRIES`` vectors a codebook has as many entries; of equal entries the
lowest index wins.  An empty table gives no rows.  Components of 2^17 and more
in magnitude are an error, since squared distances must fit 64 bits, and so is
a length that ``PARTS`` does not divide.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.llm.common import broadcast_arrays, staged

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
CHUNK = 1024  # vectors of a tree
LEAF = 4  # nodes of so few vectors are not divided by radius any more
_LIMIT = 2.0**17


# -- trees ------------------------------------------------------------------


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows: (len(a), len(b))."""
    top = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if 4.0 * a.shape[1] * float(top) ** 2 < 2.0**53:  # every step below is an exact integer
        x, y = a.astype(np.float64), b.astype(np.float64)
        return (x * x).sum(1)[:, None] - 2.0 * (x @ y.T) + (y * y).sum(1)[None, :]
    out = np.empty((len(a), len(b)), np.int64)
    for k, row in enumerate(a):
        out[k] = ((b - row) ** 2).sum(1)
    return out


@dataclass
class Tree:
    """A cover tree of integer points; nodes are in breadth-first order."""

    points: np.ndarray  # in the tree's order
    order: np.ndarray  # points[k] is the chunk's point order[k]
    centre: np.ndarray  # of each node, a place in points
    lo: np.ndarray  # the node's points are points[lo:hi]
    hi: np.ndarray
    first: np.ndarray  # its children are nodes first:last
    last: np.ndarray
    radius: np.ndarray

    def save(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **vars(self))
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> "Tree":
        with np.load(io.BytesIO(raw), allow_pickle=False) as z:
            return cls(**{k: z[k] for k in z.files})


def build_tree(points: np.ndarray) -> Tree:
    """Nodes from the root down: each is covered greedily by centres of half its radius."""
    order = np.arange(len(points))
    nodes: list[list] = [[0, 0, len(points), 0, 0, 0.0]]  # centre (a point), lo, hi, first, last, radius
    k = 0
    while k < len(nodes):
        node = nodes[k]
        centre, lo, hi = node[:3]
        members = order[lo:hi].copy()
        d0 = squared_distances(points[centre : centre + 1], points[members])[0]
        node[5] = float(np.sqrt(float(d0.max()))) * (1 + 1e-12)
        if d0.max() > 0:
            groups = _halved(points, centre, members, d0)
            order[lo:hi] = np.concatenate([g for _, g in groups])
            node[3], node[4] = len(nodes), len(nodes) + len(groups)
            for c, g in groups:
                nodes.append([c, lo, lo + len(g), 0, 0, 0.0])
                lo += len(g)
        k += 1
    place = np.empty(len(points), np.int64)
    place[order] = np.arange(len(points))
    ints = np.array([n[:5] for n in nodes], np.int64)
    c, lo, hi, first, last = ints.T.astype(np.int32)
    return Tree(
        points[order].astype(np.int32), order.astype(np.int32), place[c].astype(np.int32), lo, hi, first, last,
        np.array([n[5] for n in nodes]),
    )


def _halved(points, centre, members, d0) -> list[tuple[int, np.ndarray]]:
    """(centre, members) of the children: every member lies within half the radius of its centre."""
    if len(members) <= LEAF:
        same = d0 == 0
        return [(centre, members[same]), *((m, members[k : k + 1]) for k, m in zip(np.flatnonzero(~same), members[~same]))]
    limit = d0.max() / 4  # squares: a quarter
    near = d0 <= limit
    groups = [(centre, members[near])]
    rest = members[~near]
    close = squared_distances(points[rest], points[rest]) <= limit
    open_ = np.ones(len(rest), bool)
    for k in range(len(rest)):
        if open_[k]:
            mine = close[k] & open_
            open_ &= ~mine
            groups.append((int(rest[k]), rest[mine]))
    return groups


def assign(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, entry) stretches of the tree's order with their nearest entry."""
    found: list[tuple] = []
    nodes, live = np.zeros(1, np.int64), np.ones((1, len(book)), bool)
    while len(nodes):
        far = np.where(live, squared_distances(tree.points[tree.centre[nodes]].astype(np.int64), book), np.inf)
        best = far.argmin(1)  # of equal ones the first
        r = tree.radius[nodes]
        reach = np.sqrt(far.min(1)) + 2 * r
        live = far <= (reach**2 * (1 + 1e-9))[:, None]
        done = (r == 0) | (live.sum(1) == 1)
        at = nodes[done]
        found.append((tree.lo[at], tree.hi[at], best[done]))
        down = nodes[~done]
        n = tree.last[down] - tree.first[down]
        live = np.repeat(live[~done], n, axis=0)
        ends = np.cumsum(n)
        nodes = np.repeat(tree.first[down] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found))


def entry_sums(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum, number) of the points of each entry, from cumulative sums."""
    upto = np.zeros((len(tree.points) + 1, tree.points.shape[1]), np.int64)
    np.cumsum(tree.points, axis=0, dtype=np.int64, out=upto[1:])
    lo, hi, entry = assign(tree, book)
    sums, n = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
    np.add.at(sums, entry, upto[hi] - upto[lo])
    np.add.at(n, entry, hi - lo)
    return sums, n


def point_entries(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each point, in the chunk's order."""
    lo, hi, entry = assign(tree, book)
    back = np.argsort(lo, kind="stable")
    mine = np.repeat(entry[back], (hi - lo)[back])
    off = ((tree.points.astype(np.int64) - book[mine]) ** 2).sum(1)
    out = np.empty((2, len(mine)), np.int64)
    out[:, tree.order] = mine, off
    return out[0], out[1]


# -- Spark ------------------------------------------------------------------


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v): the kept vectors as integers."""

    def whole(x: Column) -> Column:
        x = x.cast("double")
        off = F.raise_error(F.concat(F.lit("a component is too large for exact codes: "), x.cast("string")))
        return F.when(F.abs(x) < _LIMIT, F.floor(x * SCALE)).otherwise(off.cast("long"))

    def usable(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    v = F.col(vector_col)
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(v, usable)
    return vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.when(ok, F.transform(v, whole)).alias("v")
    ).filter(F.col("v").isNotNull())


def _book_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.reshape(-1).tolist()))


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, codes array, error), codebooks (part, entry, component))."""
    spark = vectors.sparkSession
    kept = integer_vectors(vectors, id_col, vector_col, label_col)
    seeds = [r.v for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()]
    out = T.StructType(kept.schema.fields[:2]).add("codes", T.ArrayType(T.IntegerType())).add("error", T.LongType())
    if not seeds:
        return spark.createDataFrame([], out), np.zeros((parts, 0, 0), np.int64)
    width = len(seeds[0])
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    first = np.array([s for s in seeds if len(s) == width], np.int64)
    if len(first) < len(seeds):  # vectors of another length among the smallest ids
        kept = kept.filter(F.size("v") == width)
        first = np.array([r.v for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()])
    books = first.reshape(len(first), parts, -1).swapaxes(0, 1).copy()
    trees = staged(_planted(kept.filter(F.size("v") == width), width, parts), "cover-lloyd")
    for _ in range(rounds):
        books = _next_books(trees, books)
    return _final_codes(trees, books, out), books


def _planted(kept: DataFrame, width: int, parts: int) -> DataFrame:
    """One row a chunk: its ids and labels, and a tree a part."""
    ids, labels = (T.ArrayType(f.dataType) for f in kept.schema.fields[:2])
    schema = T.StructType([T.StructField("ids", ids), T.StructField("labels", labels)])
    schema = schema.add("trees", T.ArrayType(T.BinaryType()))

    def row(table: pa.Table) -> pa.RecordBatch:
        v = table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, parts, width // parts)
        raw = [build_tree(v[:, p]).save() for p in range(parts)]
        sides = [pa.array([table.column(c).to_pylist()], pa.list_(table.schema.field(c).type)) for c in ("vec_id", "label")]
        return pa.RecordBatch.from_arrays([*sides, pa.array([raw], pa.list_(pa.binary()))], names=schema.names)

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            while b.num_rows:
                take = min(CHUNK - n, b.num_rows)
                held.append(b.slice(0, take))
                n, b = n + take, b.slice(take)
                if n == CHUNK:
                    yield row(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield row(pa.Table.from_batches(held))

    return kept.mapInArrow(plant, schema)


def _trees(batch: pa.RecordBatch) -> Iterator[list[Tree]]:
    for raw in batch.column("trees"):
        yield [Tree.load(x.as_py()) for x in raw]


def _next_books(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; entries that nothing chose stay."""
    sent = broadcast_arrays(trees.sparkSession, books)
    size = books.shape[2]

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        sums, n = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for chunk in _trees(batch):
                for p, tree in enumerate(chunk):
                    s, k = entry_sums(tree, books[p])
                    sums[p] += s
                    n[p] += k
        part, entry = np.nonzero(n)
        values = pa.array(sums[part, entry].tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]), values],
            names=["part", "entry", "n", "sums"],
        )

    rows = (
        trees.select("trees").mapInArrow(total, "part int, entry int, n long, sums array<long>")
        .groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(size)))
        .collect()
    )
    books = books.copy()
    for r in rows:
        books[r.part, r.entry] = [r[f"s{k}"] // r.n for k in range(size)]
    sent.unpersist()
    return books


def _final_codes(trees: DataFrame, books: np.ndarray, schema: T.StructType) -> DataFrame:
    sent = broadcast_arrays(trees.sparkSession, books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        for batch in batches:
            for k, chunk in enumerate(_trees(batch)):
                got = [point_entries(tree, books[p]) for p, tree in enumerate(chunk)]
                codes = np.stack([c for c, _ in got], axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[k].values, batch.column("labels")[k].values,
                        pa.array(codes.tolist(), pa.list_(pa.int32())), pa.array(sum(e for _, e in got)),
                    ],
                    names=schema.names,
                )

    return trees.mapInArrow(code, schema)


def compressed_vectors(vectors: DataFrame) -> DataFrame:
    """One row a kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    codes, books = vector_codes(vectors)
    codes = staged(codes, "vector-codes")
    per_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digits = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    digest = hashlib.sha256(_book_text(books).encode()).hexdigest()
    return codes.join(per_label, codes["label"].eqNullSafe(per_label["of"])).select(
        "vec_id", digits.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
