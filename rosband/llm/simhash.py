"""Operator 7: SimHash near-duplicates through a segment-popcount embedding.

Fingerprints: 64 bits over word shingles, bit ``b`` is 1 if it is 1 in more than half of the shingles'
XXH64 values.  Every fingerprint is embedded as the vector of the bit counts of its 32 two-bit
segments (``popcounts`` keeps the whole vector in one 64-bit word).  The Manhattan distance of two
vectors never exceeds the Hamming distance of the fingerprints.

Range join on the grid: the 32 coordinates are dealt to ``2k`` groups.  Vectors at Manhattan distance
``k`` or less differ in at most ``k`` coordinates, so they agree in all coordinates of at least ``k`` groups.
Each choice of ``k`` groups gives every vector one cell; two vectors in range share a cell of some
choice.  Members of a cell are compared by Manhattan distance, the survivors exactly.  A cell is never
compared in one piece: its members are dealt to blocks of bounded size and each pair of blocks is a
task of its own, which returns a spanning forest of the links it found instead of the links.

Components: nodes are distinct fingerprints (copies are one node), joined by min-label contraction
over tables in the shared folder, so a lost executor costs one step.

Defined cases: a null text is an empty text; texts without a word have fingerprint 0 and are linked to
each other; a null doc_id counts as larger than every other and never names a component unless it is
alone (then the component_id is null); repeated rows are repeated in the result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosband.llm.common import text_or_empty, written

#: Members of a block: a task holds two blocks, 8 bytes a member, and their comparison.
BLOCK = 1024
_LAST_ID = (1 << 63) - 1
_ODD = 0x5555555555555555
_ROWS = 1 << 16


def fingerprint(text: str, shingle: int) -> int:
    """The unsigned fingerprint of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = np.array([digest(joined, 42)], dtype="<u8")
    else:
        spans = zip(starts, ends[shingle - 1 :], strict=False)
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), "<u8", len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _ROWS):
        bits = np.unpackbits(hashes[at : at + _ROWS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp`` (a signed long) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(x.as_py() or "", shingle) for x in batch.column("text")), np.uint64, batch.num_rows)
            cols = [batch.column("doc_id"), batch.column("text_hash"), pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text_hash", "fp"])

    keyed = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64(text_or_empty()).alias("text_hash"))
    return keyed.mapInArrow(run, "doc_id long, text_hash long, fp long")


def popcounts(fp: Column) -> Column:
    """Bit counts (0 to 2) of the 32 two-bit segments, two bits each, in one long."""
    low, high = fp.bitwiseAND(F.lit(_ODD)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_ODD))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cell_masks(max_bits: int) -> list[int]:
    """One mask per choice of ``max_bits`` of the ``2 * max_bits`` groups of segments (exact match for 0)."""
    if max_bits == 0:
        return [-1]
    groups = 2 * max_bits
    if groups > 32:
        raise ValueError("at most 16 differing bits")
    cuts = [round(32 * g / groups) for g in range(groups + 1)]
    own = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [_signed(sum(c)) for c in combinations(own, max_bits)]


def _manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of packed vectors whose coordinates are 0, 1 or 2."""
    x = a ^ b
    low, high = x & np.uint64(_ODD), (x >> np.uint64(1)) & np.uint64(_ODD)
    return np.bitwise_count(low) + 2 * np.bitwise_count(high & ~low)


def _forest(fps: np.ndarray, left: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) for members of components of two or more.  ``left``: rows compared with the other rows;
    all true: every pair is compared."""
    n = len(fps)
    odd = np.uint64(_ODD)
    vec = (fps & odd) + ((fps >> np.uint64(1)) & odd)
    link = np.zeros((n, n), dtype=bool)
    a, b = (np.arange(n), np.arange(n)) if left.all() else (np.flatnonzero(left), np.flatnonzero(~left))
    for at in range(0, len(a), 256):
        rows = a[at : at + 256]
        near = _manhattan(vec[rows, None], vec[None, b]) <= max_bits
        i, j = np.nonzero(near)
        ok = np.bitwise_count(fps[rows[i]] ^ fps[b[j]]) <= max_bits
        link[rows[i[ok]], b[j[ok]]] = True
    link |= link.T
    root = np.full(n, -1)
    for s in range(n):
        if root[s] >= 0:
            continue
        front = np.array([s])
        root[s] = s
        while len(front):
            front = np.flatnonzero(link[front].any(axis=0) & (root < 0))
            root[front] = s
    far = np.flatnonzero(root != np.arange(n))
    return fps[far], fps[root[far]]


def _linked(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Edges of every group (cell, p, q); the rows of a group follow each other."""
    held: list[np.ndarray] = []

    def groups(rows: list[np.ndarray], last: bool):
        nonlocal held
        cols = [np.concatenate(x) for x in zip(*rows, strict=True)] if rows else []
        if not cols or not len(cols[0]):
            held = []
            return
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)) + 1
        cuts = [0, *change.tolist(), len(cols[0])]
        if not last:
            held = [tuple(c[cuts[-2] :] for c in cols)]
            cuts.pop()
        else:
            held = []
        for s, e in zip(cuts, cuts[1:], strict=False):
            if e - s == 2:
                x, y = cols[5][s], cols[5][s + 1]
                if int(x ^ y).bit_count() <= max_bits:
                    yield cols[5][s : s + 1], cols[5][s + 1 : e]
            elif e - s > 2:
                yield _forest(cols[5][s:e], cols[4][s:e] == cols[2][s], max_bits)

    def edges(parts):
        got = [x for x in parts if len(x[0])]
        if got:
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*got, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("c", "cell", "p", "q", "own")]
        cols.append(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
        yield from edges(groups([*held, tuple(cols)], last=False))
    yield from edges(groups(held, last=True))


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges ``a, b`` between the distinct fingerprints ``fp``; their components are those of all links
    of ``max_bits`` or fewer differing bits."""
    vec = popcounts(F.col("fp"))
    cells = [F.struct(F.lit(i).alias("c"), vec.bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(cell_masks(max_bits))]
    placed = fps.select("fp", F.inline(F.array(*cells)))
    sizes = placed.groupBy("c", "cell").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    members = (
        placed.join(sizes, ["c", "cell"])
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("c", "cell", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "fp")
    )
    dealt = members.repartition("c", "cell", "p", "q").sortWithinPartitions("c", "cell", "p", "q")
    return dealt.mapInArrow(lambda x: _linked(x, max_bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b): equal roots for connected nodes.

    Each round maps every node to the least of itself and its neighbours (and that one's least in turn)
    and contracts the edges, until none is left; then the maps are followed.  The number of edges falls
    each round by a constant share for keys in random order, as fingerprints are."""
    maps: list[DataFrame] = []
    while True:
        edges = written(edges)
        if edges.isEmpty():
            break
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up")))
        twice = least.select(F.col("a").alias("up"), F.col("up").alias("top"))
        step = written(least.join(twice, "up").select(F.col("a").alias("node"), F.col("top").alias("root")))
        maps.append(step)
        ends = edges.join(step.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        ends = ends.join(step.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        # a node that skipped its parent keeps the bond to it through the edge to that parent
        edges = ends.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[-1]
    for step in reversed(maps[:-1]):
        nxt = out.select(F.col("node").alias("root"), F.col("root").alias("up"))
        out = step.join(nxt, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return out


def _rooted(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fp, first_id, root`` for every distinct fingerprint: equal roots within a component."""
    key = F.coalesce(F.col("doc_id"), F.lit(_LAST_ID))
    classes = written(fps.groupBy("fp").agg(F.min(key).alias("first_id")))
    roots = components(links(classes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    return written(classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))


def groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``."""
    fps = written(fingerprints(docs, shingle).select("doc_id", "fp"))
    rooted = _rooted(fps, max_bits)
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", "fp", F.expr(f"nullif(component_id, {_LAST_ID}L)").alias("component_id")
    )


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, then text hash (one of equal rows).

    Rows are named by doc_id and text hash, so rows with a null or repeated doc_id stand for their own components."""
    names = ["__llm_key", "__llm_hash"]
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID))
    fps = written(fingerprints(docs, shingle))
    first = F.min(F.struct(key.alias("__llm_key"), F.col("text_hash").alias("__llm_hash"))).alias("first")
    kept = fps.join(_rooted(fps, max_bits).select("fp", "root"), "fp").groupBy("root").agg(first).select("first.*")
    keyed = docs.withColumns({"__llm_key": key, "__llm_hash": F.xxhash64(text_or_empty())})
    return keyed.join(kept, names, "left_semi").dropDuplicates(names).select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id``: 3-word shingles, 3 differing bits."""
    return groups(docs, 3, 3).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
