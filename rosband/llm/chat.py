"""Chat formatting with offset-aligned loss masks.

Every conversation is rendered by one template, ``<turn>role<text>text</turn>`` per turn, encoded once, and the tokens
that carry the assistant's text are marked: the turns' text spans are sorted, so are the token spans, and a binary
search on both ends of every span finds its tokens.

The three marks are the template's control strings and special tokens of the encoding.  Inside roles and texts a
backslash is doubled and a control string gets a backslash after its ``<``, so neither can be taken for a mark;
``parse`` undoes both.  A mark is always a token of its own and nothing is merged across it, hence a conversation may be
rendered and encoded in blocks of whole turns: the blocks' texts and tokens, one after the other, are those of the whole.

Scale: rows are range partitioned by (conversation, turn), so a conversation that holds a third of all rows is rendered
and encoded by many tasks.  Only its digests, which are sequential by definition, are taken by one task, from a stream
of blocks that holds one block at a time.

Defined cases: a null role or text is empty; a conversation without any row gives no row; turns are ordered by ``turn``
(null first), ties by the hash of role and text, then role and text, so that repeated rows stay and their order is
fixed; null ``conv_id`` is a conversation of its own; other columns are ignored; texts are never cut.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosband.llm.common import written

# The template's marks, in the order of their token ids after the vocabulary's.
TURN, TEXT, END = "<turn>", "<text>", "</turn>"

LEARNED_ROLES = ("assistant",)
#: A block of whole turns is rendered and encoded once it has this many characters.
BLOCK_CHARS = 1 << 17

_CONTROL = re.compile(r"\\|<(?=/?turn>|text>)")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_RENDERED = re.compile(f"{TURN}(.*?){TEXT}(.*?){END}", re.DOTALL)

BLOCKS = "conv_id long, part int, block int, first boolean, last boolean, formatted string, ids binary, mask binary"
_PIECES = (
    "conv_id long, part int, block int, whole boolean, n_turns long, formatted_chars long, n_tokens long, "
    "n_loss_tokens long, loss_chars long, turns_sha256 string, loss_sha256 string, turns binary, loss binary"
)
_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "n_tokens long, n_loss_tokens long"
)
_COUNTS = ("n_turns", "formatted_chars", "n_tokens", "n_loss_tokens", "loss_chars")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else "<\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The formatted turns and, per turn, where its escaped text stands (UTF-8 bytes) and its role."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        start = at + len(head.encode())
        end = start + len(body.encode())
        out += (head, body, END)
        spans.append((start, end, role))
        at = end + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text: the inverse of ``render``."""
    return [(unescape(m[1]), unescape(m[2])) for m in _RENDERED.finditer(formatted)]


def span_tokens(ends: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last token that shares a byte with each span; token and span ends are ascending."""
    starts = np.concatenate(([0], ends[:-1]))
    first = np.searchsorted(ends, spans[:, 0], "right")
    last = np.searchsorted(starts, spans[:, 1], "left")
    return first, np.where(spans[:, 1] > spans[:, 0], np.maximum(first, last), first)


class Encoder:
    """Byte-level BPE by a rank file, with the marks as special tokens."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        first = max(ranks.values()) + 1
        marks = {m: first + i for i, m in enumerate((TURN, TEXT, END))}
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens=marks)
        self.length = np.zeros(first + len(marks), dtype=np.int64)
        for token, i in ranks.items():
            self.length[i] = len(token)
        for mark, i in marks.items():
            self.length[i] = len(mark)

    def __call__(self, formatted: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(formatted, allowed_special="all").astype(np.int64)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Byte offsets where the tokens end."""
        return np.cumsum(self.length[ids])


def encoded_block(encoder: Encoder, turns: list[tuple[str, str]], learned: tuple[str, ...]):
    """Formatted text, token ids and the mask (1: the token carries learned text) of some turns."""
    formatted, spans = render(turns)
    ids = encoder(formatted)
    chosen = np.array([(s, e) for s, e, role in spans if role in learned], dtype=np.int64).reshape(-1, 2)
    first, last = span_tokens(encoder.ends(ids), chosen)
    steps = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last, -1)
    return formatted, ids, (np.cumsum(steps[:-1]) > 0).astype(np.uint8)


def masked_texts(encoder: Encoder, formatted: str, ids: np.ndarray, mask: np.ndarray) -> list[str]:
    """The unescaped text under every run of marked tokens, read back from a block."""
    data, ends = formatted.encode(), encoder.ends(ids)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask, [0]))))
    runs = zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
    return [unescape(data[ends[a - 1] if a else 0 : ends[b - 1]].decode()) for a, b in runs]


def ordered(conversations: DataFrame) -> DataFrame:
    """Turns dealt in ranges of (conversation, turn) and sorted; a conversation's rows lie in neighbouring partitions."""
    spark = conversations.sparkSession
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tie", F.xxhash64("role", "text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "conv_id", "turn", "tie")
    return dealt.sortWithinPartitions("conv_id", "turn", "tie", "role", "text").select("conv_id", "role", "text")


def format_blocks(
    conversations: DataFrame,
    ranks_path: str,
    pattern: str,
    learned: tuple[str, ...] = LEARNED_ROLES,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``conv_id, part, block, first, last, formatted, ids, mask``: the formatted conversations in blocks of whole turns.

    The blocks of a conversation follow each other by (part, block); ``ids`` are little-endian unsigned 32-bit
    integers, ``mask`` has a byte per token.  ``first`` / ``last`` tell that the block is at the beginning / end of its
    partition's rows of the conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = Encoder(ranks_path, pattern), TaskContext.get().partitionId()
        schema = pa.schema([
            ("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int32()), ("first", pa.bool_()), ("last", pa.bool_()),
            ("formatted", pa.string()), ("ids", pa.binary()), ("mask", pa.binary()),
        ])
        rows: list[tuple] = []
        conv, turns, chars, block, held = None, [], 0, 0, 0

        def cut(last: bool) -> None:
            nonlocal turns, chars, block, held
            formatted, ids, mask = encoded_block(encoder, turns, learned)
            rows.append((conv, part, block, block == 0, last, formatted, ids.astype("<u4").tobytes(), mask.tobytes()))
            turns, chars, block, held = [], 0, block + 1, held + len(formatted)

        def out() -> pa.RecordBatch:
            nonlocal held
            columns = list(zip(*rows, strict=True))
            rows.clear()
            held = 0
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if turns and c != conv:
                    cut(True)
                    block = 0
                elif chars >= block_chars:
                    cut(False)
                if held >= 16 * block_chars:
                    yield out()
                conv = c
                turns.append((role, text))
                chars += len(role) + len(text)
        if turns:
            cut(True)
        if rows:
            yield out()

    return ordered(conversations).mapInArrow(run, BLOCKS)


def _pieces(blocks: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Digests of the conversations that lie inside one partition; of the others the bytes to be hashed, by block.

    A partition's first and last conversation may go on in its neighbours, so they count among the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path, pattern)
        names = [f.split()[0] for f in _PIECES.split(", ")]
        types = [_ARROW[f.split()[1]] for f in _PIECES.split(", ")]

        def out(pieces: list[dict]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([p.get(k) for p in pieces], t) for k, t in zip(names, types, strict=True)], names)

        def finished(p: dict) -> dict:
            said, loss = hashlib.sha256(p.pop("turns")), hashlib.sha256(p.pop("loss"))
            return {**p, "whole": True, "turns_sha256": said.hexdigest(), "loss_sha256": loss.hexdigest()}

        seen, waiting = 0, None  # conversations so far; one in a single block that may be the partition's last
        for batch in batches:
            ready: list[dict] = []
            for conv, part, block, first, last, formatted, ids, mask in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, mask = np.frombuffer(ids, "<u4").astype(np.int64), np.frombuffer(mask, np.uint8)
                turns, loss = parse(formatted), "".join(masked_texts(encoder, formatted, ids, mask))
                counts = (len(turns), len(formatted), len(ids), int(mask.sum()), len(loss))
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                p = {"conv_id": conv, "part": part, "block": block, "whole": False, "turns": said.encode(), "loss": loss.encode()}
                p.update(zip(_COUNTS, counts, strict=True))
                if first and waiting is not None:
                    ready.append(finished(waiting))
                    waiting = None
                seen += first
                if first and last and seen > 1:
                    waiting = p
                else:
                    ready.append(p)
            if ready:
                yield out(ready)
        if waiting is not None:
            yield out([waiting])

    return blocks.mapInArrow(run, _PIECES)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def _chained(pieces: DataFrame) -> DataFrame:
    """One row per conversation from its pieces in order, hashing one piece at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *_COUNTS]
        conv, open_, counts, turns, loss = None, False, {}, None, None

        def out() -> pa.RecordBatch:
            row = {"conv_id": conv, **counts, "turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()}
            fields = [f.split() for f in _DIGEST.split(", ")]
            return pa.record_batch([pa.array([row[k]], _ARROW[t]) for k, t in fields], [k for k, _ in fields])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in (*names, "turns", "loss")]
            for row in zip(*columns, strict=True):
                if open_ and row[0] != conv:
                    yield out()
                    open_ = False
                if not open_:
                    conv, open_, counts = row[0], True, dict.fromkeys(_COUNTS, 0)
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                counts = {k: counts[k] + v for k, v in zip(_COUNTS, row[1:-2], strict=True)}
                turns.update(row[-2])
                loss.update(row[-1])
        if open_:
            yield out()

    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return dealt.select("conv_id", *_COUNTS, "turns", "loss").mapInArrow(run, _DIGEST)


def digest(
    conversations: DataFrame,
    ranks_path: str,
    pattern: str,
    learned: tuple[str, ...] = LEARNED_ROLES,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Per conversation what its formatted, encoded and masked form gives back when it is read."""
    blocks = format_blocks(conversations, ranks_path, pattern, learned, block_chars)
    pieces = written(_pieces(blocks, ranks_path, pattern))
    names = [f.split()[0] for f in _DIGEST.split(", ")]
    whole = pieces.where("whole").select(*names)
    return whole.unionByName(_chained(pieces.where("NOT whole")).select(*names))


def with_sample(conversations: DataFrame, conv_id: int, text: str) -> DataFrame:
    """``conversations`` and one more, in which a user and then an assistant say ``text``."""
    spark = conversations.sparkSession
    rows = [(conv_id, 0, "user", text), (conv_id, 1, "assistant", text)]
    more = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(more)
