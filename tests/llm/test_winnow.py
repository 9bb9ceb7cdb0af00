import random
import re

from rosband.llm import winnow

from .conftest import PASSAGE


def plain(text):
    lines, sizes, at = [], [], []
    for n, line in enumerate(text.split("\n")):
        words = re.sub("[0-9]+", "0", line.lower()).split()
        if words:
            lines.append(" ".join(words))
            sizes.append(len(words))
            at.append(n)
    return lines, sizes, at


def windows_of(seq, least):
    lines, sizes, _ = seq
    for a in range(len(lines)):
        total = 0
        for e in range(a, len(lines)):
            total += sizes[e]
            if total >= least:
                yield a, e
                break
        else:
            return


def deleted(docs, least):
    """Line numbers that go, by the definition and without fingerprints."""
    seqs = {i: plain(t) for i, t in sorted(docs.items())}
    first = {}
    for i, seq in seqs.items():
        for a, e in windows_of(seq, least):
            first.setdefault(tuple(seq[0][a : e + 1]), (i, a))
    out = {}
    for i, seq in seqs.items():
        gone, lines = set(), seq[0]
        for a, e in windows_of(seq, least):
            f, fa = first[tuple(lines[a : e + 1])]
            if (f, fa) == (i, a):
                continue
            other, x, y = seqs[f][0], a, e
            while x > 0 and x - 1 - a + fa >= 0 and lines[x - 1] == other[x - 1 - a + fa]:
                x -= 1
            while y + 1 < len(lines) and y + 1 - a + fa < len(other) and lines[y + 1] == other[y + 1 - a + fa]:
                y += 1
            gone.update(range(x, y + 1))
        out[i] = sorted(seq[2][g] for g in gone)
    return out


def test_random_tables_like_brute_force(make_docs):
    rng = random.Random(4)
    vocabulary = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6))) for _ in range(8)] + ["", " "]
    docs = {i: "\n".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 14))) for i in range(150)}
    want = deleted(docs, 10)
    got = {r["doc_id"]: r for r in winnow.dedup(make_docs([(i, t, "en", "s") for i, t in docs.items()]), 10, gone="gone").collect()}
    assert {i: r["gone"] for i, r in got.items()} == want
    assert sum(map(len, want.values())) > 100
    for i, t in docs.items():
        lines = t.split("\n")
        assert got[i]["text"] == "\n".join(x for n, x in enumerate(lines) if n not in set(want[i]))


def test_every_long_window_has_a_mark():
    rng = random.Random(5)
    for _ in range(300):
        hashes = [rng.randint(0, 9) for _ in range(rng.randint(0, 20))]
        sizes = [rng.randint(1, 5) for _ in hashes]
        got = winnow.windows(hashes, sizes, 8)
        place = -1
        for w in got:
            inside = hashes[w["start"] : w["end"] + 1]
            assert w["mark"] == min(inside) and sum(sizes[w["start"] : w["end"] + 1]) >= 8 > sum(sizes[w["start"] : w["end"]])
            at = w["start"] + len(inside) - 1 - inside[::-1].index(min(inside))
            assert w["fresh"] == (at != place)
            place = at


def test_passage_in_many_documents(make_docs):
    rows = [(i, f"own line {chr(97 + i)}\n{PASSAGE.upper() if i % 2 else PASSAGE}\nend", "en", "s") for i in range(8)]
    got = {r["doc_id"]: r["text"] for r in winnow.dedup(make_docs(rows)).collect()}
    assert got[0] == rows[0][1]
    assert all(got[i] == f"own line {chr(97 + i)}" for i in range(1, 8))  # the equal line after it belongs to the run


def test_repeats_within_a_document(make_docs):
    text = "\n".join(["start", PASSAGE, "middle", PASSAGE, PASSAGE])
    assert winnow.dedup(make_docs([(1, text, "en", "s")])).first()["text"] == f"start\n{PASSAGE}\nmiddle"


def test_awkward_rows(awkward, empty_docs):
    got = winnow.dedup(awkward)
    assert got.columns == awkward.columns and got.count() == awkward.count()
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[3]["text"] is None and by_id[2]["text"] == ""
    assert by_id[8]["text"] == f"head\n{PASSAGE}\ntail one" and by_id[9]["text"] == "start\ntail two"
    assert by_id[9]["n_chars"] == len("start\ntail two") and by_id[9]["gone"] == "extra gone"
    assert winnow.digest(awkward).count() == awkward.count()
    assert winnow.digest(empty_docs).collect() == []
