"""Vector code compression: product codes by cover-tree Lloyd rounds in exact integer arithmetic.

Vectors are scaled to integers and cut into equal parts; each part has a codebook that a few Lloyd rounds refine.  Rows
are packed once into blocks, each with one cover tree per part: nested nets of its distinct part vectors, whose
nodes know the radius, the number and the sum of the vectors below them.  A round walks each tree level by level.  With
``d1 <= d2`` the distances of a node's centre to its two nearest entries, every vector below it has the nearest entry
when ``d2 - d1 > 2 * radius`` (triangle inequality): then its whole count and sum go to that entry.  Only the other nodes
descend, and a single vector is compared exactly (ties to the lower index).

The block table is written once; a round reads it, keeps one sum per entry in every task and reduces these with a Spark
aggregate.  Only the codebooks (entries x dimension, fixed by parameters) pass through the driver.

Defined cases: rows whose vector is null, holds null or non-finite components, or has another length than the smallest
kept ``vec_id``'s go (the first two by contract); the length must be a multiple of the parts; a null ``vec_id`` stands
after all others and is coded like any row; equal ids are ordered by their vectors; repeated rows are coded each; null
labels form one group; fewer rows than entries give a smaller codebook; an empty table gives no rows.  Scaled
components must stay below 2^31 in magnitude, otherwise the job fails with a message.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosband.llm.common import written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Rows of one block (and of one cover tree); the nets of a block are chosen from its pairwise distances.
BLOCK_ROWS = 1024
LIMIT = 1 << 31

_BLOCKS = "vec_ids array<long>, labels array<string>, points binary, trees array<binary>"
_SUMS = "part int, entry int, n long, sums array<long>"


# -- integers ------------------------------------------------------------------------------------------------------


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (points x entries), as float64 where that is exact, else as Python integers."""
    d = points.shape[1]
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * d * top * top < 1 << 52:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return (p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)[None, :]
    p, e = points.astype(object), entries.astype(object)
    return np.stack([((p - x) ** 2).sum(1) for x in e], axis=1) if len(e) else np.zeros((len(p), 0), object)


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as integers."""
    out = np.floor(values.astype(np.float64) * scale)
    if len(out) and np.abs(out).max() >= LIMIT:
        raise ValueError(f"scaled components of {LIMIT} or more in magnitude are not supported")
    return out.astype(np.int64)


# -- the cover tree ------------------------------------------------------------------------------------------------


@dataclass
class CoverTree:
    """Nodes in breadth-first order; the children of a node are neighbours, and so are the rows below it.

    ``centre`` is the row that stands for the node, ``radius`` bounds the distance from it to any row below,
    ``first_child`` / ``n_children`` name its children (none: all rows below equal the centre), ``start`` / ``count``
    its rows in ``order`` and ``sums`` their componentwise sum.
    """

    centre: np.ndarray
    radius: np.ndarray
    first_child: np.ndarray
    n_children: np.ndarray
    start: np.ndarray
    count: np.ndarray
    sums: np.ndarray
    order: np.ndarray

    def pack(self) -> bytes:
        nodes = np.stack([self.centre, self.first_child, self.n_children, self.start, self.count]).astype("<i4")
        head = np.array([len(self.centre), len(self.order), self.sums.shape[1]], dtype="<i4")
        return b"".join(
            a.tobytes()
            for a in (head, nodes, self.radius.astype("<f8"), self.sums.astype("<i8"), self.order.astype("<i4"))
        )

    @staticmethod
    def unpack(data: bytes) -> CoverTree:
        n, rows, d = np.frombuffer(data, "<i4", 3).tolist()
        at = 12
        nodes = np.frombuffer(data, "<i4", 5 * n, at).reshape(5, n)
        radius = np.frombuffer(data, "<f8", n, at + 20 * n)
        sums = np.frombuffer(data, "<i8", n * d, at + 28 * n).reshape(n, d)
        order = np.frombuffer(data, "<i4", rows, at + 28 * n + 8 * n * d)
        centre, first_child, n_children, start, count = nodes
        return CoverTree(centre, radius, first_child, n_children, start, count, sums, order)


def _nets(distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Farthest-first order of the points, and each point's distance to those before it (non-increasing).

    The points with a distance above ``s`` are an ``s``-net, and the nets of smaller ``s`` contain those of larger ones.
    """
    n = len(distance)
    order, gap = np.zeros(n, dtype=np.int64), np.full(n, np.inf)
    near = distance[0].copy()
    near[0] = -1.0
    for k in range(1, n):
        i = int(near.argmax())
        order[k], gap[k] = i, near[i]
        np.minimum(near, distance[i], out=near)
        near[i] = -1.0
    return order, gap


def cover_tree(points: np.ndarray) -> CoverTree:
    """The cover tree of the rows of ``points`` (integers); equal rows share a leaf."""
    distinct, inverse, copies = np.unique(points, axis=0, return_inverse=True, return_counts=True)
    inverse, n = inverse.reshape(-1), len(distinct)
    distance = np.sqrt(np.maximum(squared(distinct, distinct).astype(np.float64), 0))
    order, gap = _nets(distance)
    # sizes of the nets: scales halve from the largest gap; a net that adds nothing makes no level
    sizes, scale = [1], gap[1] / 2 if n > 1 else 0.0
    while sizes[-1] < n:
        m = max(int((gap > scale).sum()), sizes[-1])
        if m > sizes[-1]:
            sizes.append(m if n - m > 0 else n)
        scale /= 2
    # parent of every net point one level up: the nearest centre there (itself if it is one already)
    levels = [np.zeros(n if len(sizes) == 1 else sizes[0], dtype=np.int64)[: sizes[0]]]
    for above, m in zip(sizes, sizes[1:], strict=False):
        levels.append(distance[np.ix_(order[:m], order[:above])].argmin(1))
    # breadth-first numbering: nodes of a level sorted by their parent's place
    place = [np.zeros(1, dtype=np.int64)]  # net point -> its place within the level
    arranged = [np.zeros(1, dtype=np.int64)]  # place -> net point
    for parent in levels[1:]:
        rank = np.argsort(place[-1][parent], kind="stable")
        arranged.append(rank)
        where = np.empty(len(rank), dtype=np.int64)
        where[rank] = np.arange(len(rank))
        place.append(where)
    # rows in the order of the last level's nodes, which are the distinct points
    last = arranged[-1]
    node_of_distinct = np.empty(n, dtype=np.int64)
    node_of_distinct[order[last]] = np.arange(n)
    row_order = np.argsort(node_of_distinct[inverse], kind="stable")
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arranged])))
    total, d = int(offsets[-1]), points.shape[1]
    tree = CoverTree(
        np.empty(total, np.int64), np.zeros(total), np.zeros(total, np.int64), np.zeros(total, np.int64),
        np.empty(total, np.int64), np.empty(total, np.int64), np.empty((total, d), np.int64), row_order,
    )
    first_row = np.full(n, len(points), dtype=np.int64)
    np.minimum.at(first_row, inverse, np.arange(len(points)))
    leaf_counts = copies[order[last]]
    bounds = np.concatenate(([0], np.cumsum(leaf_counts)))
    leaf_sums = distinct[order[last]] * leaf_counts[:, None]
    begin = np.arange(n)  # first leaf below each node of the level at hand, from the last level up
    for level in range(len(sizes) - 1, -1, -1):
        at, net = slice(int(offsets[level]), int(offsets[level + 1])), arranged[level]
        if level < len(sizes) - 1:
            parents = place[level][levels[level + 1][arranged[level + 1]]]  # ascending
            first = np.searchsorted(parents, np.arange(len(net)))
            tree.first_child[at] = offsets[level + 1] + first
            tree.n_children[at] = np.diff(np.append(first, len(parents)))
            begin = begin[first]
        tree.centre[at] = first_row[order[net]]
        tree.start[at] = bounds[begin]
        tree.count[at] = np.diff(np.append(tree.start[at], bounds[-1]))
        tree.sums[at] = np.add.reduceat(leaf_sums, begin, axis=0)
        reach = distance[order[last], np.repeat(order[net], np.diff(np.append(begin, n)))]
        tree.radius[at] = np.maximum.reduceat(reach, begin)
    return tree


def assign(tree: CoverTree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes that take one entry as a whole and that entry, and the number of nodes compared.

    The rows below the returned nodes are all rows, each once.
    """
    nodes, chosen, compared = [], [], 0
    active = np.zeros(1, dtype=np.int64)
    while len(active):
        d2 = squared(points[tree.centre[active]], entries)
        compared += len(active)
        best = d2.argmin(1)
        radius = tree.radius[active]
        done = radius == 0
        if not done.all():
            if d2.shape[1] == 1:
                done[:] = True
            else:
                two = np.sqrt(np.partition(d2.astype(np.float64), 1, axis=1)[:, :2])
                # the margin covers the rounding of the roots: a node is only ever split too often
                done |= two[:, 1] - two[:, 0] > 2 * radius + 1e-9 * (1 + two[:, 1])
        nodes.append(active[done])
        chosen.append(best[done])
        rest = active[~done]
        sizes = tree.n_children[rest]
        ahead = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        active = np.repeat(tree.first_child[rest], sizes) + ahead
    return np.concatenate(nodes), np.concatenate(chosen), np.array(compared)


def row_entries(tree: CoverTree, nodes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The entry of every row, from the nodes that were assigned."""
    by_start = np.argsort(tree.start[nodes])
    out = np.empty(len(tree.order), dtype=np.int64)
    out[tree.order] = np.repeat(chosen[by_start], tree.count[nodes][by_start])
    return out


# -- Spark ---------------------------------------------------------------------------------------------------------


def kept(vectors: DataFrame, embedding: str, length: int | None = None) -> DataFrame:
    """``vec_id, label, vector``: the rows whose vector is complete and finite (and of ``length`` components)."""
    v = F.col(embedding)
    unusable = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), v.alias("vector"))
    rows = rows.where(v.isNotNull() & ~unusable)
    return rows if length is None else rows.where(F.size("vector") == length)


def _blocks(rows: DataFrame, parts: int, scale: int, block_rows: int) -> DataFrame:
    """One row per block: ids, labels, integer vectors and the cover tree of every part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                b = batch.slice(at, block_rows)
                points = scaled(b.column(2).flatten().to_numpy(zero_copy_only=False), scale).reshape(b.num_rows, -1)
                trees = [cover_tree(p).pack() for p in np.split(points, parts, axis=1)]
                yield pa.record_batch(
                    [
                        pa.array([b.column(0).to_pylist()], pa.list_(pa.int64())),
                        pa.array([b.column(1).to_pylist()], pa.list_(pa.string())),
                        pa.array([points.astype("<i4").tobytes()], pa.binary()),
                        pa.array([trees], pa.list_(pa.binary())),
                    ],
                    ["vec_ids", "labels", "points", "trees"],
                )

    return written(rows.mapInArrow(run, _BLOCKS))


def _opened(batch: pa.RecordBatch, parts: int):
    """``(ids, labels, part vectors, trees)`` of every block of a batch."""
    for ids, labels, points, trees in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        rows = np.frombuffer(points, "<i4").reshape(len(ids), -1).astype(np.int64)
        yield ids, labels, np.split(rows, parts, axis=1), [CoverTree.unpack(t) for t in trees]


def _round(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one Lloyd round."""
    parts, d = len(books), books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(len(b), dtype=np.int64) for b in books]
        sums = [np.zeros(b.shape, dtype=np.int64) for b in books]
        for batch in batches:
            for _, _, points, trees in _opened(batch, parts):
                for p, tree in enumerate(trees):
                    nodes, chosen, _ = assign(tree, points[p], books[p])
                    np.add.at(n[p], chosen, tree.count[nodes])
                    np.add.at(sums[p], chosen, tree.sums[nodes])
        rows = [(p, e, int(n[p][e]), sums[p][e].tolist()) for p in range(parts) for e in np.flatnonzero(n[p]).tolist()]
        if rows:
            types = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
            columns = zip(*rows, strict=True)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "entry", "n", "sums"])

    partial = blocks.mapInArrow(run, _SUMS)
    total = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(d)]).alias("sums")
    )
    new = [b.copy() for b in books]
    for r in total.collect():  # at most parts x entries rows
        new[r["part"]][r["entry"]] = [s // r["n"] for s in r["sums"]]
    return new


def _coded(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, points, trees in _opened(batch, len(books)):
                codes, error = [], 0
                for p, tree in enumerate(trees):
                    entry = row_entries(tree, *assign(tree, points[p], books[p])[:2])
                    codes.append(entry)
                    away = points[p] - books[p][entry]
                    big = np.abs(away).max(initial=0) >= 1 << 24
                    error = error + ((away.astype(object) if big else away) ** 2).sum(1)
                digits = np.stack(codes, axis=1).astype(">u1" if len(books[0]) <= 256 else ">u2")
                yield pa.record_batch(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(labels, pa.string()),
                        pa.array([row.tobytes().hex() for row in digits], pa.string()),
                        pa.array([int(e) for e in error], pa.int64()),
                    ],
                    ["vec_id", "label", "code", "error"],
                )

    return blocks.mapInArrow(run, "vec_id long, label string, code string, error long")


def first_codebooks(rows: DataFrame, parts: int, entries: int, scale: int) -> list[np.ndarray]:
    """The parts of the vectors of the smallest ids (``entries`` rows: the bound of what comes to the driver)."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not first:
        return []
    length = len(first[0]["vector"])
    if length == 0 or length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    vectors = np.array([r["vector"] for r in first if len(r["vector"]) == length], dtype=np.float64)
    return np.split(scaled(vectors, scale), parts, axis=1)


def books_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


@dataclass
class Codes:
    """Coded rows (``vec_id, label, code, error``) and the final codebook of every part."""

    rows: DataFrame
    books: list[np.ndarray]


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    embedding: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> Codes:
    spark = vectors.sparkSession
    books = first_codebooks(kept(vectors, embedding), parts, entries, scale)
    if not books:
        return Codes(spark.createDataFrame([], "vec_id long, label string, code string, error long"), [])
    length = parts * books[0].shape[1]
    blocks = _blocks(kept(vectors, embedding, length), parts, scale, block_rows)
    for _ in range(rounds):
        books = _round(blocks, books)
    return Codes(_coded(blocks, books), books)


def decoded(codes: Codes, width: int = 2) -> Column:
    """The approximate scaled vector (``array<long>``) that ``code`` stands for."""
    tables = [F.array(*[F.array(*[F.lit(int(x)) for x in e]) for e in b]) for b in codes.books]
    digits = [F.conv(F.substring("code", 1 + width * p, width), 16, 10).cast("int") for p in range(len(tables))]
    return F.flatten(F.array(*[F.get(t, i) for t, i in zip(tables, digits, strict=True)]))


def digest(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``."""
    codes = compress(vectors)
    rows = written(codes.rows)
    by_label = rows.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    joined = rows.join(by_label, F.col("label").eqNullSafe(F.col("__label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(codes.books)).alias("codebooks_sha256"))
