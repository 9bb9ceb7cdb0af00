import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from rosband.llm import bpe

from .conftest import CLASHES


def run_stages(docs):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(docs.sparkSession, out[-1], None))
    return out


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "mixture", "tokens"]


def test_planted_cases(make_docs):
    def text(i, n=120):
        return " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j % 26)}{chr(97 + j // 26 % 26)}" for j in range(n))

    rows = [(i, text(i), "en", f"s{i % 4}") for i in range(60)]
    rows += [(100, text(3), "en", "s1"), (101, text(3), "en", "s2")]  # exact copies
    rows += [(102, text(4).replace("aaab", "changed", 1), "en", "s0")]  # a near copy
    rows += [(103, "too short", "en", "s1"), (104, "rep eat " * 40, "en", "s1")]  # junk
    _, kept, lines, single, mixed, tokens = run_stages(make_docs(rows))
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    clean = set(range(60))
    assert clean <= set(ids(kept)) and not {103, 104} & set(ids(kept))
    assert ids(lines) == ids(kept)
    assert clean <= set(ids(single)) and len({100, 101} & set(ids(single))) <= 1  # emptied copies are one component
    taken = ids(mixed)
    assert len(taken) == len(set(taken)) and set(taken) <= set(ids(single))
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = bpe.read_ranks(f.read())
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text_of = {r["doc_id"]: r["text"] for r in mixed.collect()}
    rows = tokens.collect()
    assert sorted(r["doc_id"] for r in rows) == taken
    for r in rows:
        assert list(memoryview(bytes(r["ids"])).cast("I")) == public.encode_ordinary(text_of[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(text_of[r["doc_id"]].encode()).hexdigest()


def test_awkward_rows(awkward, empty_docs):
    out = run_stages(awkward)
    for df in out[1:-1]:
        assert df.columns == awkward.columns
        assert all(r[c] == f"extra {c}" for r in df.collect() for c in CLASHES)
    assert out[-1].count() == out[-2].count()
    for df in run_stages(empty_docs)[1:]:
        assert df.collect() == []


def test_run(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.count() > 0 and {"doc_id", "n_tokens", "ids"} <= set(got.columns)
