import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosband.llm import vectorcodes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def lloyd(rows, parts=4, entries=256, rounds=4):
    """Brute force over Python integers: {vec_id: (code, error, label_error)} and the codebooks' digest."""
    ok = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    ints = [[int(np.floor(np.float64(np.float32(x)) * 1024)) for x in r[1]] for r in ok]
    order = sorted(range(len(ok)), key=lambda i: (ok[i][0] is None, ok[i][0] or 0, ok[i][1]))
    d = len(ints[0]) // parts
    codes, errors, books = [""] * len(ok), [0] * len(ok), []
    for p in range(parts):
        pts = np.array([v[p * d : (p + 1) * d] for v in ints], dtype=np.int64)
        book = pts[order[:entries]].copy()
        near = lambda: ((pts[:, None, :] - book[None]) ** 2).sum(2).argmin(1)
        for _ in range(rounds):
            a, new = near(), book.copy()
            for e in set(a.tolist()):
                new[e] = pts[a == e].sum(0) // (a == e).sum()
            book = new
        a = near()
        for i, e in enumerate(a.tolist()):
            codes[i] += f"{e:02x}"
            errors[i] += int(((pts[i] - book[e]) ** 2).sum())
        books.append(book)
    text = ",".join(str(x) for b in books for x in b.reshape(-1).tolist())
    by_label = {}
    for r, e in zip(ok, errors, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted((str(r[0]), c, e, by_label[r[2]], sha) for r, c, e in zip(ok, codes, errors, strict=True))


def got(df):
    return sorted((str(r[0]), *r[1:]) for r in V.digest(df).collect())


def test_given_table_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert got(df) == lloyd([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])


def test_awkward_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 8)).astype(np.float32).tolist()
    rows = [(i * 3, base[i % 120], None if i % 7 == 0 else i % 3) for i in range(700)]  # many equal vectors, null labels
    rows += [(None, base[200], 1), (5, base[201], 1), (5, base[202], 1), (5, base[202], 1), (9, [1.0] * 8, 2)]
    rows += [(10, None, 1), (11, [1.0] * 7 + [None], 1), (12, [float("nan")] * 8, 1), (13, [float("inf")] * 8, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("part", "entry", "code", "error", "n", "vector")})
    assert got(df.repartition(3)) == lloyd(rows)
    assert got(df.limit(0)) == []
    assert got(df.where("vec_id in (10, 11, 13)")) == []
    few = [r for r in rows if r[0] is not None and r[0] < 60]
    assert got(spark.createDataFrame(few, SCHEMA)) == lloyd(few)


def test_lengths(spark):
    rows = [(1, [0.5] * 8, 1), (2, [0.25] * 12, 1), (3, [], 1)]
    assert [r[0] for r in got(spark.createDataFrame(rows, SCHEMA))] == ["1"]
    with pytest.raises(ValueError):
        V.digest(spark.createDataFrame([(1, [0.5] * 6, 1)], SCHEMA))


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "line", "one", "large"])
def test_tree_covers_and_assigns_exactly(kind):
    rng = np.random.default_rng(1)
    points = {
        "spread": rng.integers(-900, 900, (400, 6)),
        "clusters": rng.integers(-900, 900, (5, 6))[rng.integers(0, 5, 400)] * 50 + rng.integers(-3, 4, (400, 6)),
        "copies": rng.integers(0, 2, (400, 3)),
        "line": np.arange(400)[:, None] ** 2,
        "one": np.full((400, 2), 7),
        "large": rng.integers(-(1 << 30), 1 << 30, (200, 4)),
    }[kind]
    tree = V.CoverTree.unpack(V.cover_tree(points).pack())
    rows = points[tree.order]
    for i in range(len(tree.centre)):
        below = rows[tree.start[i] : tree.start[i] + tree.count[i]]
        away = np.sqrt(((below - points[tree.centre[i]]).astype(float) ** 2).sum(1))
        assert away.max() <= tree.radius[i] * (1 + 1e-9) and (below.sum(0) == tree.sums[i]).all()
        kids = slice(tree.first_child[i], tree.first_child[i] + tree.n_children[i])
        if tree.n_children[i]:
            assert tree.count[kids].sum() == tree.count[i] and tree.start[kids].min() == tree.start[i]
        else:
            assert tree.radius[i] == 0
    entries = np.concatenate([points[:20], points[:3], rng.integers(-900, 900, (9, points.shape[1]))])
    nodes, chosen, compared = V.assign(tree, points, entries)
    exact = ((points[:, None, :].astype(object) - entries[None].astype(object)) ** 2).sum(2)
    assert V.row_entries(tree, nodes, chosen).tolist() == [min(range(len(entries)), key=lambda e: (r[e], e)) for r in exact]
    if kind in ("copies", "one"):  # equal rows went together
        assert compared < 400
    if kind == "clusters":  # and with entries far apart whole subtrees
        far = points[[int((points // 150 == c).all(1).argmax()) for c in np.unique(points // 150, axis=0)]]
        apart = [far[0]]
        for f in far:
            if min(((f - a) ** 2).sum() for a in apart) > 10_000:
                apart.append(f)
        nodes, chosen, compared = V.assign(tree, points, np.array(apart))
        assert compared < 60 and tree.count[nodes].max() > 20


def test_codes_decode_to_codebook_entries(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    codes = V.compress(df, entries=16, rounds=2)
    both = codes.rows.withColumn("back", V.decoded(codes)).join(df.select("vec_id", "embedding"), "vec_id")
    for r in both.collect():
        x = np.floor(np.array(r["embedding"], dtype=np.float64) * 1024).astype(int)
        assert ((x - np.array(r["back"])) ** 2).sum() == r["error"]
