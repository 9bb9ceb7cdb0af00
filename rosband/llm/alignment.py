"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes into two token sequences.  Tokens are linked where their byte ranges overlap; the
components of the links are the groups between the byte offsets at which tokens of both sides end.  Every token points
to its farthest-right overlapping token (the one that ends last, at a tie the right side's), and doubling the
successors, ``next = next[next]``, brings every token to the terminal token of its component in a logarithm of its
length; terminals number the groups.  All tokens of a block of documents are jumped at once.

Scale: a block (documents of ``BLOCK_BYTES`` together, or one longer document) counts its own id pairs first, so the
corpus counts come from one aggregate over distinct pairs of blocks; the totals are joined back to those pairs,
gathered per block (bounded by the block) and looked up by the pair numbers that the block kept for every link, two bytes
each where the block has no more pairs.  Blocks are read back ``BLOCKS_PER_TASK`` a task on average: a batch holds the
blocks of a task, so its memory follows the block and not the input.

Defined cases: a text that is null, empty, or whose joined token bytes on either side differ from the bytes expected has
no tokens: zeros and an empty ``groups_sha256``; repeated rows and ids are rows of their own (and count again);
texts are never cut; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosband.llm.common import written

#: Documents are encoded and jumped together until their texts have this many characters.
BLOCK_BYTES = 1 << 20
#: Blocks of a task (on average) where counts are looked up: a batch of rows there holds all of them.
BLOCKS_PER_TASK = 8
#: ``a_id * SHIFT + b_id`` numbers an id pair.
SHIFT = 1 << 32

_BLOCKS = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs array<long>, counts array<long>, links binary"
)
_DOCS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


# -- tokenizers ----------------------------------------------------------------------------------------------------


class Tokenizers:
    """Encoders of both sides and the bytes of their tokens.

    The left side is the byte-level vocabulary as a rank file; ``tests/llm`` compares it with the same vocabulary's
    merge file over every code point.
    """

    def __init__(self, ranks_path: str, pattern: str, piece_path: str):
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._a = tiktoken.Encoding("left", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = []
        for i in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[list[int]]]:
        """Ids of space + text on the left side and of text on the right side, which adds the space itself."""
        # special tokens' strings are ordinary text: there are none
        a = [self._a.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        return a, self._b.encode(texts, num_threads=1)


# -- alignment -----------------------------------------------------------------------------------------------------


@dataclass
class Groups:
    """Group number of every token, and the links as index pairs (``left[i]``, ``right[i]``)."""

    a_group: np.ndarray
    b_group: np.ndarray
    n_groups: int
    left: np.ndarray
    right: np.ndarray


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> Groups:
    """Groups and links of two token sequences that cover the same bytes, given the ascending offsets of their ends.

    Documents may follow each other: where one ends, both sides end, so no group passes.
    """
    n_a, n_b = len(a_ends), len(b_ends)
    a_starts, b_starts = np.concatenate(([0], a_ends[:-1])), np.concatenate(([0], b_ends[:-1]))
    # the last token of the other side that begins before this one ends
    last_b = np.searchsorted(b_starts, a_ends, "left") - 1
    last_a = np.searchsorted(a_starts, b_ends, "left") - 1
    # nodes: left tokens, then right ones.  The other side's token ends no earlier; ties belong to the right side
    successor = np.empty(n_a + n_b, dtype=np.int64)
    successor[:n_a] = n_a + last_b
    successor[n_a:] = np.where(a_ends[last_a] > b_ends, last_a, n_a + np.arange(n_b)) if n_b else []
    while True:
        jumped = successor[successor]
        if np.array_equal(jumped, successor):
            break
        successor = jumped
    terminal = np.zeros(n_a + n_b, dtype=bool)
    terminal[successor] = True
    number = np.cumsum(terminal) - 1
    group = number[successor]
    first_b = np.searchsorted(b_ends, a_starts, "right")
    width = last_b - first_b + 1
    left = np.repeat(np.arange(n_a), width)
    right = np.arange(len(left)) + np.repeat(first_b - (np.cumsum(width) - width), width)
    return Groups(group[:n_a], group[n_a:], int(terminal.sum()), left, right)


def _suffixed(n: int) -> list[bytes]:
    return [b"%d" % i for i in range(n)]


class GroupText:
    """The text ``a1,a2|b1;a3|b2,b3`` of groups: every token gives its id and the sign that follows it."""

    def __init__(self, n_a: int, n_b: int):
        a, b = _suffixed(n_a), _suffixed(n_b)
        self.pieces = [x + b"," for x in a] + [x + b"|" for x in a] + [x + b"," for x in b] + [x + b";" for x in b]
        self.n_a, self.n_b = n_a, n_b

    def arrange(self, a_ids: np.ndarray, b_ids: np.ndarray, g: Groups) -> tuple[np.ndarray, np.ndarray]:
        """Piece number of all tokens, group by group with the left side first, and each one's group."""
        last_in_a = np.append(np.diff(g.a_group) > 0, True)[: len(a_ids)]
        last_in_b = np.append(np.diff(g.b_group) > 0, True)[: len(b_ids)]
        a_piece = a_ids + np.where(last_in_a, self.n_a, 0)
        b_piece = 2 * self.n_a + b_ids + np.where(last_in_b, self.n_b, 0)
        a_place = np.arange(len(a_ids)) + np.searchsorted(g.b_group, g.a_group, "left")
        b_place = np.arange(len(b_ids)) + np.searchsorted(g.a_group, g.b_group, "right")
        out = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
        out[a_place], out[b_place] = a_piece, b_piece
        return out, a_place

    def text(self, numbers: np.ndarray) -> bytes:
        """The text of some groups, without the last semicolon."""
        return b"".join(map(self.pieces.__getitem__, numbers.tolist()))[:-1]


def _link_type(n_pairs: int) -> str:
    """The type of a block's pair numbers."""
    return "<u2" if n_pairs <= 1 << 16 else "<u4"


def _block(block: int, ids: list, texts: list[str], tok: Tokenizers, a_length, b_length, writer: GroupText) -> dict:
    """All that a block of documents gives: digests per document, its distinct id pairs, and the links as pair numbers."""
    a_all, b_all = tok.encode(texts)
    for i, text in enumerate(texts):
        expected = b" " + text.encode()
        # byte-level tokens tile every text: their lengths tell; pieces may be normalised: their bytes are compared
        same = a_length[a_all[i]].sum() == len(expected) and b"".join(map(tok.b_bytes.__getitem__, b_all[i])) == expected
        if not text or not same:
            a_all[i], b_all[i] = a_all[i][:0], []
    n_a = np.array([len(x) for x in a_all], dtype=np.int64)
    n_b = np.array([len(x) for x in b_all], dtype=np.int64)
    a_ids = np.concatenate(a_all).astype(np.int64)
    b_ids = np.fromiter(chain.from_iterable(b_all), np.int64, int(n_b.sum()))
    g = align(np.cumsum(a_length[a_ids]), np.cumsum(b_length[b_ids]))
    a_doc = np.repeat(np.arange(len(texts)), n_a)
    n_links = np.bincount(a_doc[g.left], minlength=len(texts))
    # groups of a document: from the group of its first token to that of its last
    a_at = np.concatenate(([0], np.cumsum(n_a)))
    b_at = np.concatenate(([0], np.cumsum(n_b)))
    numbers, _ = writer.arrange(a_ids, b_ids, g)
    groups, shas = [], []
    for i in range(len(texts)):
        if n_a[i]:
            groups.append(int(g.a_group[a_at[i + 1] - 1] - g.a_group[a_at[i]] + 1))
            part = writer.text(numbers[a_at[i] + b_at[i] : a_at[i + 1] + b_at[i + 1]])
            shas.append(hashlib.sha256(part).hexdigest())
        else:
            groups.append(0)
            shas.append("")
    pairs, number, counts = np.unique(a_ids[g.left] * SHIFT + b_ids[g.right], return_inverse=True, return_counts=True)
    return {
        "block": block, "doc_ids": ids, "n_a": n_a.tolist(), "n_b": n_b.tolist(), "n_groups": groups,
        "n_links": n_links.tolist(), "groups_sha256": shas, "pairs": pairs.tolist(), "counts": counts.tolist(),
        "links": number.astype(_link_type(len(pairs))).tobytes(),
    }


_LONGS = pa.list_(pa.int64())
_BLOCK_SCHEMA = pa.schema([
    ("block", pa.int64()), ("doc_ids", _LONGS), ("n_a", _LONGS), ("n_b", _LONGS), ("n_groups", _LONGS), ("n_links", _LONGS),
    ("groups_sha256", pa.list_(pa.string())), ("pairs", _LONGS), ("counts", _LONGS), ("links", pa.binary()),
])


def aligned_blocks(
    docs: DataFrame, ranks_path: str, pattern: str, piece_path: str, block_chars: int = BLOCK_BYTES
) -> DataFrame:
    """One row per block of documents: digests, distinct id pairs with their counts, links as pair numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok = Tokenizers(ranks_path, pattern, piece_path)
        a_length = np.array([len(b) for b in tok.a_bytes], dtype=np.int64)
        b_length = np.array([len(b) for b in tok.b_bytes], dtype=np.int64)
        writer = GroupText(len(a_length), len(b_length))
        block, ids, texts, chars = TaskContext.get().partitionId() << 32, [], [], 0

        def out() -> pa.RecordBatch:
            nonlocal block, ids, texts, chars
            row = _block(block, ids, texts, tok, a_length, b_length, writer)
            block, ids, texts, chars = block + 1, [], [], 0
            return pa.record_batch([pa.array([row[f.name]], f.type) for f in _BLOCK_SCHEMA], schema=_BLOCK_SCHEMA)

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(i)
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if chars >= block_chars:
                    yield out()
        if ids:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, _BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair, n, best``: links of every id pair in the corpus, and whether no pair of its right id has more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("x.pairs", "x.counts")
    totals = written(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("n")))
    right = F.col("pair") % F.lit(SHIFT)
    most = totals.groupBy(right.alias("b_id")).agg(F.max("n").alias("most"))
    both = totals.withColumn("b_id", right).join(most, "b_id")
    return both.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _looked_up(blocks: DataFrame) -> DataFrame:
    """``n_best`` and ``count_sum`` per document, from its links' pair numbers and the pairs' counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, n_a, n_b, n_groups, n_links, shas, links, found = batch.columns
            for i in range(len(batch)):
                own = found[i].values  # no value is made a Python object
                pairs = len(own) if own is not None else 0
                n = own.field("n").to_numpy() if pairs else np.zeros(0, np.int64)
                best = own.field("best").to_numpy(zero_copy_only=False).astype(np.int64) if pairs else n
                number = np.frombuffer(links[i].as_buffer(), _link_type(pairs))
                at = np.concatenate(([0], np.cumsum(n_links[i].values.to_numpy())))
                n_best, count_sum = (np.diff(np.concatenate(([0], np.cumsum(x[number])))[at]) for x in (best, n))
                columns = [doc_ids[i].values, n_a[i].values, n_b[i].values, n_groups[i].values, n_links[i].values]
                columns += [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), shas[i].values]
                yield pa.record_batch(columns, [f.split()[0] for f in _DOCS.split(", ")])

    columns = ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "found")
    return blocks.select(*columns).mapInArrow(run, _DOCS)


def digest(docs: DataFrame, ranks_path: str, pattern: str, piece_path: str, block_chars: int = BLOCK_BYTES) -> DataFrame:
    """Per document its tokens, groups and links, and how its links stand among the corpus's id pairs."""
    blocks = written(aligned_blocks(docs, ranks_path, pattern, piece_path, block_chars))
    tasks = max(1, -(-blocks.count() // BLOCKS_PER_TASK))
    each = blocks.select("block", F.posexplode("pairs").alias("pos", "pair"))
    found = each.join(pair_counts(blocks), "pair").repartition(tasks, "block").groupBy("block")
    # as many as the block has distinct pairs, in the order of their numbers
    found = found.agg(F.array_sort(F.collect_list(F.struct("pos", "n", "best"))).alias("found"))
    kept = blocks.drop("pairs", "counts").repartition(tasks, "block")
    return _looked_up(kept.join(found, "block", "left"))
