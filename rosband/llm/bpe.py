"""Operator 1: byte-level BPE encoding and decoding by prefix dynamic programming.

For a byte string ``s`` the BPE result of every prefix ``s[:i]`` ends in exactly one token.
That token is found from left to right: it is the only vocabulary token ``t`` that is a suffix of
``s[:i]``, survives the merges by itself, and may follow the last token of ``s[:i - len(t)]``.  Two
tokens may stand side by side when merging their joined bytes gives back the same two tokens; this
property of neighbours is sufficient for a whole token sequence to be the BPE result, because the
first merge that crosses a boundary would also happen on the two neighbours alone.

``PrefixTable`` keeps the last token of every prefix, so appending bytes only extends the table and an
edit re-encodes from the edited byte on.  ``TextEncoding`` lifts this to whole texts: pieces of the
splitting pattern are independent, and a boundary before every space that a non-space follows never
moves, so an edit re-encodes only the stretch between two such boundaries.

Distribution: rows are independent, so the Spark side is one ``mapInArrow`` without a shuffle.  Each
Python worker keeps bounded tables of the stretches and pieces seen most recently.  Executors that
are lost cost a recomputation of their partitions only.

Defined cases: a null text is an empty text; an empty text has no tokens; any length is accepted;
repeated rows and extra columns pass through unchanged.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stretches and pairs of tokens that a worker remembers before it forgets the older half of them.
CACHE_ENTRIES = 500_000
CACHE_PAIRS = 400_000
#: Longer stretches are encoded without being kept.
CACHE_CHARS = 48
#: Rows that a task hands back at a time.
_ROWS = 1000

#: U+0020 before a non-space: the tokens on both sides never depend on each other.
_STRETCH = regex.compile(r" (?=\S)")
_OPEN_SPACE = regex.compile(r" (?=\s|\Z)")


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks from the lines of a ``.tiktoken`` file: base64 of the bytes, then the id."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x.strip())}


class Vocabulary:
    """Ranks, the tokens that end at a place, and which two tokens may be neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.rank = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for b, r in ranks.items():
            self.bytes_of[r] = b
        self.longest = max(map(len, ranks))
        self.sizes = list(map(len, self.bytes_of))
        self._pairs: dict[int, bool] = {}

    @cached_property
    def ends(self) -> dict[bytes, tuple]:
        """Every prefix of a token that BPE can produce -> the tokens it ends in, (length, id), longest first."""
        ranks, out = self.rank, {}
        made = {b: r for b, r in ranks.items() if len(b) == 1 or self.merge(b) == [r]}
        for b in made:
            for k in range(1, len(b) + 1):
                if (p := b[:k]) not in out:
                    out[p] = tuple((len(q), made[q]) for q in (p[i:] for i in range(k)) if q in made)
        return out

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE: join the adjacent pair of lowest rank, leftmost first, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        rank = self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [rank[p] for p in parts]

    def neighbours(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self._pairs.get(key)
        if known is None:
            known = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            if len(self._pairs) >= CACHE_PAIRS:
                _forget(self._pairs)
            self._pairs[key] = known
        return known


def _extend(vocabulary: Vocabulary, s: bytes, last: list[int]) -> None:
    """Bring ``last`` (the last token of each prefix of ``s``) from its length to that of ``s``."""
    ends, pairs = vocabulary.ends, vocabulary._pairs
    start, depth = len(last), 0  # depth: bytes of the longest end of the prefix that begins a token
    for d in range(min(start, vocabulary.longest), 0, -1):
        if s[start - d : start] in ends:
            depth = d
            break
    for end in range(start + 1, len(s) + 1):
        depth += 1
        found = ends.get(s[end - depth : end])
        while found is None:
            depth -= 1
            found = ends.get(s[end - depth : end])
        for size, token in found:
            if size == end:
                break
            key = last[end - size - 1] << 32 | token
            ok = pairs.get(key)
            if ok or ok is None and vocabulary.neighbours(key >> 32, token):
                break
        last.append(token)


def _follow(vocabulary: Vocabulary, last: list[int]) -> list[int]:
    """The tokens, read from the last one backwards."""
    out, end, size = [], len(last), vocabulary.sizes
    while end:
        token = last[end - 1]
        out.append(token)
        end -= size[token]
    out.reverse()
    return out


class PrefixTable:
    """The last token of every prefix of a byte string (one piece of the splitting pattern)."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        """Exact append: the entries so far stay as they are."""
        self.data += data
        _extend(self.vocabulary, self.data, self.last)

    def edit(self, start: int, end: int, replacement: bytes) -> None:
        """Replace ``data[start:end]``; prefixes before ``start`` keep their entries."""
        rest = replacement + self.data[end:]
        self.data = self.data[:start]
        del self.last[start:]
        self.append(rest)

    def tokens(self) -> list[int]:
        """The encoding.  A whole piece that is in the vocabulary is that token, as in the public library."""
        whole = self.vocabulary.rank.get(self.data)
        if whole is not None:
            return [whole]
        return _follow(self.vocabulary, self.last)


def _forget(table: dict) -> None:
    """Drop the older half of a full table."""
    for key in list(islice(table, len(table) // 2)):
        del table[key]


class _Kept(dict):
    """A bounded memory of ``make(key)``."""

    def __init__(self, make, keep):
        super().__init__()
        self.make, self.keep = make, keep

    def __missing__(self, key):
        value = self.make(key)
        if self.keep(key):
            if len(self) >= CACHE_ENTRIES:
                _forget(self)
            self[key] = value
        return value


class Codec:
    """Encodes and decodes whole texts; token ids are little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.pieces = regex.compile(pattern).findall
        self.letters_are_pieces = r"| ?\p{L}+|" in pattern
        self._stretch = _Kept(self._encode_word, lambda word: len(word) <= CACHE_CHARS)

    def _encode_piece(self, piece: str) -> bytes:
        data = piece.encode("utf-8", "surrogatepass")
        whole = self.vocabulary.rank.get(data)
        if whole is not None:
            return _packed([whole])
        last: list[int] = []
        _extend(self.vocabulary, data, last)
        return _packed(_follow(self.vocabulary, last))

    def _encode_stretch(self, stretch: str) -> bytes:
        """All pieces of a stretch; letters behind a space are remembered as the word that they are."""
        out = []
        for piece in self.pieces(stretch):
            if self.letters_are_pieces and piece[0] == " " and piece[1:].isalpha():
                out.append(self._stretch[piece[1:]])
            else:
                out.append(self._encode_piece(piece))
        return b"".join(out)

    def _encode_word(self, word: str) -> bytes:
        """A stretch without its leading space.  Letters alone are one piece with that space."""
        if self.letters_are_pieces and word.isalpha():
            return self._encode_piece(" " + word)
        return self._encode_stretch(" " + word)

    def stretches(self, text: str) -> list[str]:
        """The text cut at every U+0020 before a non-space; all but the first have lost that space."""
        parts = text.split(" ")
        if _OPEN_SPACE.search(text):  # some of those cuts are before white space
            parts = _STRETCH.split(text)
        return parts

    def encode(self, text: str) -> bytes:
        parts = self.stretches(text)
        return self._encode_stretch(parts[0]) + b"".join(map(self._stretch.__getitem__, parts[1:]))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, memoryview(ids).cast("I")))


class TextEncoding:
    """A text with its ids; an edit encodes the touched stretches only, the rest is reused."""

    def __init__(self, codec: Codec, text: str):
        self.codec, self.parts, self.ids = codec, [], []
        self._set(0, 0, codec.stretches(text))

    def _set(self, first: int, last: int, parts: list[str]) -> None:
        self.parts[first:last] = parts
        self.ids[first:last] = [
            self.codec._encode_stretch(p) if first + k == 0 else self.codec._stretch[p] for k, p in enumerate(parts)
        ]

    @property
    def text(self) -> str:
        return " ".join(self.parts)

    def encoded(self) -> bytes:
        return b"".join(self.ids)

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace the code points ``start`` to ``end``; an append is ``edit(n, n, more)``."""
        first, at = 0, 0
        while first + 1 < len(self.parts) and at + len(self.parts[first]) + 1 <= start:
            at += len(self.parts[first]) + 1
            first += 1
        last, upto = first, at
        while last < len(self.parts) and (last == first or upto <= end):
            upto += len(self.parts[last]) + 1
            last += 1
        # one stretch more on both sides: the edit may remove or make a boundary
        if first:
            first -= 1
            at -= len(self.parts[first]) + 1
        last = min(len(self.parts), last + 1)
        old = " ".join(self.parts[first:last])
        new = old[: start - at] + replacement + old[end - at :]
        if first and not new:
            parts = [""]
        else:
            parts = self.codec.stretches(new)
        self._set(first, last, parts)


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


_WORKER: dict[tuple[int, str], Codec] = {}


def _codec(lines: bytes, pattern: str) -> Codec:
    """One codec per Python worker and vocabulary."""
    key = (hash(lines), pattern)
    if key not in _WORKER:
        _WORKER[key] = Codec(Vocabulary(read_ranks(lines)), pattern)
    return _WORKER[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _with_columns(df: DataFrame, names: list[str], source: str, make) -> DataFrame:
    """Add binary columns made from the column ``source``; ``make()`` gives the function of a value to theirs."""
    kept = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType([*kept, *(T.StructField(n, T.BinaryType(), False) for n in names)])
    old = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), _ROWS):
                part = batch.slice(at, _ROWS)
                made = list(zip(*(work(x.as_py()) for x in part.column(source)), strict=True)) or [()] * len(names)
                arrays = [pa.array(m, pa.binary()) for m in made]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in old), *arrays], [*old, *names])

    return df.mapInArrow(run, schema)


def encode(
    df: DataFrame, vocabulary_path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Add the binary column ``ids``: the token ids of ``text``, 4 bytes each, little-endian.  ``decoded`` names a
    further column for the bytes that these ids decode to.

    The vocabulary file (bounded: one line per token) is read on the driver and broadcast.  Columns already
    called so are replaced.
    """
    lines = df.sparkSession.sparkContext.broadcast(_read(vocabulary_path))

    def make():
        codec = _codec(lines.value, pattern)
        if decoded is None:
            return lambda x: (codec.encode(x or ""),)

        def both(x):
            own = codec.encode(x or "")
            return own, codec.decode(own)

        return both

    return _with_columns(df, [ids] if decoded is None else [ids, decoded], text, make)


def decode(df: DataFrame, vocabulary_path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the binary column ``out``: the bytes that the ids stand for (null ids: none)."""
    lines = df.sparkSession.sparkContext.broadcast(_read(vocabulary_path))

    def make():
        codec = _codec(lines.value, pattern)
        return lambda x: (codec.decode(x or b""),)

    return _with_columns(df, [out], ids, make)


def digest(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text: encoded, then decoded from the ids."""
    coded = encode(docs.select("doc_id", "text"), vocabulary_path, pattern, decoded="decoded")
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
