import hashlib

import numpy as np
import public_tokenizers
import tokenizers
from pyspark.sql import functions as F

from rosband.llm import alignment as A

RANKS, PIECE = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
SIDES = (RANKS, public_tokenizers.PATTERN, PIECE)


def merges():
    """The left vocabulary as a merge file."""
    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def brute(rows):
    """Token by token, from the tokenizers' own output."""
    tok, left = A.Tokenizers(*SIDES), merges()
    parts, pair_n = [], {}
    for doc_id, text in rows:
        a, b = ([], []) if not text else (
            left.encode(" " + text, add_special_tokens=False).ids, tok.encode([text])[1][0]
        )
        joined = [b"".join(t[i] for i in x) for t, x in ((tok.a_bytes, a), (tok.b_bytes, b))]
        if not text or any(j != (" " + text).encode() for j in joined):
            a, b = [], []
        spans = []
        for ids, table in ((a, tok.a_bytes), (b, tok.b_bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(out)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, at = [], [0, 0]
        for c in cuts:
            sides = [[], []]
            for k in (0, 1):
                while at[k] < len(spans[k]) and spans[k][at[k]][1] <= c:
                    sides[k].append(str(spans[k][at[k]][2]))
                    at[k] += 1
            groups.append("|".join(",".join(x) for x in sides))
        links = [(x, y) for s, e, x in spans[0] for s2, e2, y in spans[1] if s < e2 and s2 < e] if len(a) < 400 else None
        if links is None:  # long texts: two pointers
            links, j = [], 0
            for s, e, x in spans[0]:
                while spans[1][j][1] <= s:
                    j += 1
                k = j
                while k < len(spans[1]) and spans[1][k][0] < e:
                    links.append((x, spans[1][k][2]))
                    k += 1
        for p in links:
            pair_n[p] = pair_n.get(p, 0) + 1
        text_of = ";".join(groups)
        parts.append((doc_id, len(a), len(b), len(cuts), links, hashlib.sha256(text_of.encode()).hexdigest() if a else ""))
    most = {}
    for (_, y), n in pair_n.items():
        most[y] = max(most.get(y, 0), n)
    return sorted(
        (str(d), a, b, g, len(ls), sum(pair_n[p] == most[p[1]] for p in ls), sum(pair_n[p] for p in ls), sha)
        for d, a, b, g, ls, sha in parts
    )


def got(df, **more):
    return sorted((str(r[0]), *r[1:]) for r in A.digest(df, *SIDES, **more).collect())


def test_given_table_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert got(df) == brute(rows)
    assert got(df.repartition(3), block_chars=500) == brute(rows)


def test_awkward_rows(spark, awkward, empty_docs):
    more = [(20, "<|endoftext|> <s></s> <unk>"), (21, "<0x41> ▁x"), (22, "  two  spaces "), (23, " 　éﬁ"), (24, " ")]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    df = awkward.withColumns({c: F.lit(c) for c in ("block", "pairs", "links", "found")}).unionByName(extra, allowMissingColumns=True)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert got(df) == brute(rows)
    assert got(empty_docs) == []


def test_pointer_jumping_on_random_sequences():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 200):
        for _ in range(20):
            a = np.unique(np.append(rng.integers(1, 3 * n + 1, n), 3 * n + 1))
            b = np.unique(np.append(rng.integers(1, 3 * n + 1, n), 3 * n + 1))
            g = A.align(a, b)
            cuts = np.intersect1d(a, b)
            assert g.n_groups == len(cuts)
            assert g.a_group.tolist() == np.searchsorted(cuts, a).tolist()
            assert g.b_group.tolist() == np.searchsorted(cuts, b).tolist()
            a0, b0 = np.append(0, a[:-1]), np.append(0, b[:-1])
            want = [(i, j) for i in range(len(a)) for j in range(len(b)) if a0[i] < b[j] and b0[j] < a[i]]
            assert list(zip(g.left.tolist(), g.right.tolist(), strict=True)) == want


def test_long_component():
    """One group of 200,000 tokens: the sides never end together before the last byte."""
    a = np.append(np.arange(2, 200_000, 2), 200_000)
    b = np.append(np.arange(1, 200_000, 2), 200_000)
    assert A.align(a, b).n_groups == 1


def test_ranks_and_merges_agree_on_every_code_point():
    """Every character stands in the same class of the pattern on both sides, hence both cut all texts alike."""
    tok, left = A.Tokenizers(*SIDES), merges()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(f"x{c}x {c}1{c}{c} \n" for c in points[at : at + 64]) for at in range(0, len(points), 64)]
    for text, a in zip(texts, left.encode_batch_fast([" " + t for t in texts], add_special_tokens=False), strict=True):
        assert tok._a.encode(" " + text, disallowed_special=()) == a.ids, hex(ord(text[1]))


def test_lookup_holds_a_few_blocks_a_task(spark):
    """However many blocks lie in one partition, a task that looks counts up gets few, with two bytes a link."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").coalesce(1)
    blocks = A.aligned_blocks(df, *SIDES, block_chars=2000).cache()
    for row in blocks.select("links", "n_links").collect():
        assert len(row.links) == 2 * sum(row.n_links)
    n = blocks.count()
    assert n > 4 * A.BLOCKS_PER_TASK
    assert A.digest(df, *SIDES, block_chars=2000).rdd.getNumPartitions() >= n // A.BLOCKS_PER_TASK
    blocks.unpersist()
    assert [A._link_type(n) for n in (0, 1 << 16, (1 << 16) + 1)] == ["<u2", "<u2", "<u4"]
