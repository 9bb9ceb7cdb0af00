import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from rosband.llm import simhash


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, max_bits):
    """Groups of linked values, by comparing all pairs."""
    a = np.array(fps, dtype=np.uint64)
    up = list(range(len(fps)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1 :]) <= max_bits) + i + 1:
            x, y = top(i), top(int(j))
            up[max(x, y)] = min(x, y)
    out = defaultdict(set)
    for i in range(len(a)):
        out[top(i)].add(i)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("text", ["", " \n", "One", "one two", "A b C", "x y z " * 30, "é à ü\tβ\x0bγ ÀÉ", "a\x85b c d"])
def test_fingerprints_like_brute_force(text):
    assert simhash.fingerprint(text, 3) == slow_fingerprint(text)


def test_embedding_is_a_lower_bound():
    rng = random.Random(1)
    for _ in range(500):
        a, b = rng.getrandbits(64), rng.getrandbits(64)
        odd = 0x5555555555555555
        vec = [np.uint64((x & odd) + ((x >> 1) & odd)) for x in (a, b)]
        segments = [[bin(x >> 2 * s & 3).count("1") for s in range(32)] for x in (a, b)]
        want = sum(abs(x - y) for x, y in zip(*segments, strict=True))
        assert simhash._manhattan(*vec) == want <= (a ^ b).bit_count()


@pytest.mark.parametrize("max_bits", [0, 1, 3, 5])
def test_dense_groups_in_blocks(spark, monkeypatch, max_bits):
    monkeypatch.setattr(simhash, "BLOCK", 60)  # hot cells are cut into many pairs of blocks
    rng = random.Random(max_bits)
    base, fps = rng.getrandbits(64), set()
    for _ in range(500):
        x = base
        for _ in range(rng.randint(0, 6)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(200)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    root = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, max_bits)).collect()}
    got = defaultdict(set)
    for i, x in enumerate(signed):
        got[root.get(x, x)].add(i)
    assert sorted(map(sorted, got.values())) == classes(fps, max_bits)


def test_components_of_long_chains(spark):
    rng = random.Random(9)
    names = rng.sample(range(10_000), 300)
    edges = list(zip(names[:200], names[1:200], strict=False)) + list(zip(names[200:], names[201:], strict=False))
    got = simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in got}
    assert len(roots) == 300
    assert len({roots[x] for x in names[:200]}) == 1 and len({roots[x] for x in names[200:]}) == 1
    assert roots[names[0]] != roots[names[250]]


def test_awkward_rows(awkward, empty_docs):
    rows = awkward.select("doc_id", "text").collect()
    fps = [slow_fingerprint(r["text"] or "") for r in rows]
    least = {}
    for group in classes(fps, 3):
        ids = [rows[i]["doc_id"] for i in group if rows[i]["doc_id"] is not None]
        for i in group:
            least[i] = min(ids, default=None)
    want = sorted((str(r["doc_id"]), f"{fps[i]:016x}", str(least[i])) for i, r in enumerate(rows))
    got = sorted((str(r[0]), r[1], str(r[2])) for r in simhash.digest(awkward).collect())
    assert got == want
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(least[group[0]]) for group in classes(fps, 3))
    assert simhash.digest(empty_docs).collect() == [] and simhash.one_of_each(empty_docs).collect() == []


def test_one_row_of_each_component_with_null_and_repeated_ids(make_docs):
    def text(c):
        return " ".join(f"{c}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(80))

    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (7, text("c")), (7, text("d")), (7, text("d")), (8, text("d")),
            (5, text("e")), (9, text("e")), (9, text("f")), (None, text("f"))]
    kept = simhash.one_of_each(make_docs([(i, t, "en", "s") for i, t in rows])).collect()
    want = [(None, "a"), (None, "b"), (7, "c"), (7, "d"), (5, "e"), (9, "f")]
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted((str(i), text(c)) for i, c in want)
