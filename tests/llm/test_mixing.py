import hashlib
import math
import re
from collections import defaultdict

import pytest

from rosband.llm import mixing


def test_shortages_go_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame(
        [("a", "x", 10), ("a", "y", 100), ("a", "z", 100), ("b", "x", 1000), ("c", "x", 5)], "top string, low string, tokens long"
    )
    from pyspark.sql import functions as F

    got = mixing.budgets(leaves, ["top", "low"], F.lit(300), 1, {})
    q = {(r["top"], r["low"]): r["quota"] for r in got.collect()}
    # c can give 5 of its 100; a and b share 295; in a the leaf x can give 10 of its third
    assert q == {("a", "x"): 10, ("a", "y"): 68, ("a", "z"): 68, ("b", "x"): 147, ("c", "x"): 5}


def test_weights(spark):
    from pyspark.sql import functions as F

    leaves = spark.createDataFrame([("a", 1000), ("b", 1000), ("c", 1000)], "top string, tokens long")
    got = mixing.budgets(leaves, ["top"], F.lit(600), 1, {"top": {"a": 3.0, "b": 2.0}})
    assert {r["top"]: r["quota"] for r in got.collect()} == {"a": 300, "b": 200, "c": 100}


def test_registered_weights_differ(spark):
    from pyspark.sql import functions as F

    tops = ["domain0", "domain1", "domain2", "domain3"]
    leaves = spark.createDataFrame([(t, 10_000) for t in tops], "domain string, tokens long")
    got = mixing.budgets(leaves, ["domain"], F.lit(6500), 1, mixing.WEIGHTS)
    assert {r["domain"]: r["quota"] for r in got.collect()} == dict(zip(tops, (3000, 2000, 1000, 500), strict=True))


def test_mix_follows_its_own_tree(make_docs):
    from pyspark.sql import functions as F

    docs = make_docs([(i, "word " * 10, "en" if i < 60 else "de", f"s{i % 7}") for i in range(120)])
    out = mixing.mix(docs, {"tongue": lambda: F.col("lang")}, epochs=1, weights={"tongue": {"en": 3.0}}, budget_share=0.5)
    assert out.columns == docs.columns
    assert {r["lang"]: r["n"] for r in out.groupBy("lang").agg(F.count("*").alias("n")).collect()} == {"en": 45, "de": 15}


def slow_select(rows, quota, epochs, seed):
    """copies by (doc_id, text) of one leaf."""
    tokens = {r: len((r[1] or "").split()) for r in rows}
    total = sum(tokens[r] for r in rows)
    whole = min(epochs, quota // total) if total else epochs
    rest, used, out = quota - whole * total, 0, {}
    name = lambda r: "" if r[0] is None else str(r[0])
    key = lambda r: (hashlib.md5(f"{seed}:{whole}:{name(r)}".encode()).hexdigest(), hashlib.md5((r[1] or "").encode()).hexdigest())
    for r in sorted(set(rows), key=key):
        used += tokens[r] * rows.count(r)
        out[r] = whole + (1 if whole < epochs and used <= rest else 0)
    return out


@pytest.mark.parametrize(("share", "epochs"), [(0.5, 1), (0.8, 2), (1.7, 3), (5.0, 2), (0.0, 1)])
def test_prefixes_like_brute_force(make_docs, share, epochs):
    rows = [(i, "word " * (1 + i * 7 % 23), "en" if i % 3 else "de", f"src{i % 5}" if i % 2 else "src0") for i in range(300)]
    docs = make_docs(rows)
    got = mixing.select(docs, budget_share=share, epochs=epochs, seed="t").collect()
    leaves = defaultdict(list)
    place = {r["doc_id"]: (r["domain"], r["language"], r["leaf_source"]) for r in got}
    text = {i: t for i, t, _, _ in rows}
    for i in place:
        leaves[place[i]].append((i, text[i]))
    tokens = {k: sum(len(t.split()) for _, t in v) for k, v in leaves.items()}
    budget = math.floor(sum(tokens.values()) * share)

    def fill(budget, groups, depth):
        """Water-filling by raising one level."""
        if depth == 3:
            ((key, _),) = groups.items()
            return {key: math.floor(min(budget, groups[key]))}
        by = defaultdict(dict)
        for k, cap in groups.items():
            by[k[depth]][k] = cap
        caps = {n: sum(g.values()) for n, g in by.items()}
        given, left, open_ = {}, min(budget, sum(caps.values())), sorted(caps, key=caps.get)
        while open_:
            n = open_.pop(0)
            given[n] = min(caps[n], left / (len(open_) + 1))
            left -= given[n]
        out = {}
        for n, g in by.items():
            out |= fill(given[n], g, depth + 1)
        return out

    quota = fill(budget, {k: v * epochs for k, v in tokens.items()}, 0)
    for r in got:
        k = place[r["doc_id"]]
        want = slow_select(leaves[k], quota[k], epochs, "t")[(r["doc_id"], text[r["doc_id"]])]
        assert r["copies"] == want
    if share == 5.0:
        assert {r["copies"] for r in got} == {2}


def test_awkward_rows(awkward, empty_docs):
    got = mixing.digest(awkward).collect()
    assert len(got) == awkward.count()
    want = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in awkward.collect())
    assert sorted(r["n_tokens"] for r in got) == want
    out = mixing.mix(awkward, epochs=1)
    assert out.columns == awkward.columns
    assert out.count() == sum(r["copies"] for r in mixing.select(awkward, epochs=1).selectExpr("copies * rows AS copies").collect())
    everything = mixing.mix(awkward, epochs=1, budget_share=1.0)
    assert everything.count() == awkward.count()
    assert mixing.digest(empty_docs).collect() == [] and mixing.mix(empty_docs).collect() == []
