import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rosband.llm import chat

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TRICKY = ["", "\\", "<turn>", "</turn>", "<\\turn>", "\\<text>", "</turn", ">", "a\\n<text>\n\\### Assistant: </turn> ok", " lead", "trail \n", "😀 é漢"]


def want(rows):
    """Per conversation the digests, from the plain rows."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0)
    for c in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=key)]
        loss = "".join(t for role, t in turns if role == "assistant")
        said = "".join(f"{role}\n{t}\n" for role, t in turns)
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def got(df, **more):
    rows = chat.digest(df, RANKS, public_tokenizers.PATTERN, **more).collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_escape_is_reversible_and_hides_marks():
    for a in TRICKY:
        for b in TRICKY:
            turns = [("user", a), ("assistant", b + a), (a, a + b)]
            formatted, spans = chat.render(turns)
            assert chat.parse(formatted) == turns
            assert [formatted.encode()[s:e].decode() for s, e, _ in spans] == [chat.escape(t) for _, t in turns]
            assert sum(formatted.count(m) for m in (chat.TURN, chat.TEXT, chat.END)) == 9


def test_span_tokens_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(50):
        ends = np.cumsum(rng.integers(1, 5, 40))
        cuts = np.sort(rng.integers(0, ends[-1] + 1, 12)).reshape(-1, 2)
        first, last = chat.span_tokens(ends, cuts)
        starts = np.concatenate(([0], ends[:-1]))
        for (s, e), a, b in zip(cuts, first, last, strict=True):
            hit = [i for i in range(40) if starts[i] < e and ends[i] > s and e > s]
            assert list(range(a, b)) == hit


def test_blocks_are_the_whole_conversation():
    rows = [(1, i, ("user", "assistant")[i % 2], TRICKY[i % len(TRICKY)] + f" word {i}") for i in range(60)]
    encoder = chat.Encoder(RANKS, public_tokenizers.PATTERN)
    formatted, ids, mask = chat.encoded_block(encoder, [r[2:] for r in rows], ("assistant",))
    blocks, at = [], 0
    while at < len(rows):
        blocks.append(chat.encoded_block(encoder, [r[2:] for r in rows[at : at + 7]], ("assistant",)))
        at += 7
    assert "".join(b[0] for b in blocks) == formatted
    assert np.concatenate([b[1] for b in blocks]).tolist() == ids.tolist()
    assert np.concatenate([b[2] for b in blocks]).tolist() == mask.tolist()
    assert chat.masked_texts(encoder, formatted, ids, mask) == [r[3] for r in rows if r[2] == "assistant" and r[3]]


@pytest.mark.parametrize("block", [50, 1 << 17])
def test_hot_conversation_and_neighbours(spark, block):
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i} {TRICKY[i % len(TRICKY)]}") for i in range(900)]
    rows += [(c, i, ("system", "user", "assistant")[i % 3], f"{c} {i}") for c in range(20, 200) for i in range(c % 5 + 1)]
    assert got(frame(spark, rows).repartition(5), block_chars=block) == want(rows)


def test_awkward_rows(spark):
    rows = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    rows += [(1, 0, None, None), (1, None, "assistant", "first"), (1, 2, "assistant", None), (None, 0, "assistant", "no id")]
    rows += [(2, 1, "assistant", "again"), (2, 1, "assistant", "again"), (3, 0, "assistant", "x y " * 200_000)]
    df = frame(spark, rows).withColumns({c: F.lit(c) for c in ("part", "block", "ids", "mask", "tie", "first")})
    assert got(df) == want(rows)
    assert got(df.limit(0)) == {}


def test_formatted_blocks_have_offsets_and_masks(spark):
    rows = [(1, 0, "user", "Hi <turn>"), (1, 1, "assistant", "Hello you")]
    blocks = chat.format_blocks(frame(spark, rows), RANKS, public_tokenizers.PATTERN).orderBy("part", "block").collect()
    formatted = "".join(b["formatted"] for b in blocks)
    ids = np.concatenate([np.frombuffer(b["ids"], "<u4") for b in blocks]).astype(np.int64)
    mask = np.concatenate([np.frombuffer(b["mask"], np.uint8) for b in blocks])
    encoder = chat.Encoder(RANKS, public_tokenizers.PATTERN)
    assert formatted == "<turn>user<text>Hi <\\turn></turn><turn>assistant<text>Hello you</turn>"
    assert encoder.ends(ids)[-1] == len(formatted.encode()) and len(mask) == len(ids)
    assert encoder.encoding.decode(ids[mask == 1].tolist()) == "Hello you"


def test_given_table_against_plain_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert got(df) == want([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
