import hashlib
import random
import re

from rosband.llm import passages, winnow


def norm(text):
    return re.sub("[0-9]+", "0", text.lower()).split()


def gone_words(docs, least):
    """Places of the words that go, by the definition."""
    first, out = {}, {}
    for i, t in sorted(docs.items()):
        w, out[i] = norm(t), set()
        for a in range(len(w) - least + 1):
            if tuple(w[a : a + least]) in first:
                out[i].update(range(a, a + least))
            first.setdefault(tuple(w[a : a + least]), i)
    return out


def test_passages_inside_lines_like_brute_force(make_docs):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    shared = [[word() for _ in range(rng.randint(8, 30))] for _ in range(12)]
    docs = {}
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += [word() for _ in range(rng.randint(0, 6))]
            p = rng.choice(shared)
            words += p[rng.randint(0, 4) : len(p) - rng.randint(0, 4)]
        docs[i] = "".join(w + rng.choice([" ", " ", " ", "  ", "\n", "\n\n"]) for w in words)
    docs[200], docs[201] = "ha ha " * 30, "so ha " + "ha " * 12 + "end"
    table = make_docs([(i, t, "en", "s") for i, t in docs.items()])
    got = {r["doc_id"]: r for r in passages.dedup(table, 10, gone="gone", n_words="n").collect()}
    want = gone_words(docs, 10)
    assert sum(map(len, want.values())) > 500
    for i, t in docs.items():
        assert norm(got[i]["text"]) == [w for k, w in enumerate(norm(t)) if k not in want[i]]
        assert got[i]["text"] == t or want[i]
        assert got[i]["n"] == len(want[i])
        at, lines = 0, []
        for n, line in enumerate(t.split("\n")):
            k = len(norm(line))
            if k and set(range(at, at + k)) <= want[i]:
                lines.append(n)
            at += k
        assert got[i]["gone"] == lines


def test_planted_passage_in_the_middle_of_a_line(make_docs):
    passage = " ".join(f"{a}{b}" for a in "klmnopqr" for b in "stuvwxy")[: 51 * 3 - 1]
    assert len(passage.split()) == 51
    first, other = f"one two\nthree {passage} four\nfive", f"six seven {passage.upper()} eight nine\nten"
    docs = make_docs([(1, first, "en", "s"), (2, other, "en", "s"), (3, " ".join(passage.split()[:49]), "en", "s")])
    got = {r["doc_id"]: r for r in passages.dedup(docs, winnow.MIN_WORDS).collect()}
    assert got[1]["text"] == first and got[2]["text"] == "six seven eight nine\nten" and got[2]["n_chars"] == 24
    assert got[3]["text"] == " ".join(passage.split()[:49])
    digest = {r["doc_id"]: r for r in winnow.digest(docs).collect()}
    assert digest[2]["text_sha256"] == hashlib.sha256(b"six seven eight nine\nten").hexdigest()


def test_awkward_rows(awkward, empty_docs):
    got = passages.dedup(awkward, 50)
    assert got.columns == awkward.columns and got.count() == awkward.count()
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[3]["text"] is None and by_id[2]["text"] == "" and by_id[9]["text"] == "start\ntwo"
    assert passages.dedup(empty_docs, 50).collect() == []
