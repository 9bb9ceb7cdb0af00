"""The registered query and the pipeline: runs of lines first, then by words what these leave."""

import random

import numpy as np
import pytest

import corpus_pipeline
from rosband.llm import passages, winnow

from .test_passages import gone_words, norm

STEPS = [lambda docs: corpus_pipeline.lines_stage(docs.sparkSession, docs, None), lambda docs: winnow.digest(docs)]


@pytest.mark.parametrize("step", STEPS, ids=["pipeline", "op8"])
def test_line_hashes_and_extension_come_first(make_docs, monkeypatch, step):
    lines = [" ".join(f"{chr(97 + n)}{c}" for c in "abcdefghijkl") for n in range(7)]
    tail = " ".join(f"z{c}" for c in "abcdefgh")
    one = "\n".join(["own", *lines, tail + " here"])
    two = "\n".join(["other words", "", *lines[:3], " ", *lines[3:], tail + " there"])
    docs = make_docs([(1, one, "en", "s"), (2, two, "en", "s")])
    seen, by_words = [], passages.repeats

    def spy(docs, min_words, known=None):
        found = by_words(docs, min_words, known)
        seen.extend((known, found))
        return found

    monkeypatch.setattr(passages, "repeats", spy)
    got = {r["doc_id"]: r for r in step(docs).collect()}
    known, found = ([(r["key"], [tuple(s) for s in r["spans"]]) for r in x.collect()] for x in seen)
    assert known == [(2, [(2, 2 + 7 * 12 - 50)])]  # one run of seven lines; the line after it differs in its last word
    assert found[0][0] == 2 and max(b for _, b in found[0][1]) == 2 + 7 * 12 + 8 - 50  # the words before it go too
    if "text" in got[2]:
        assert got[2]["text"] == "other words\n\n \nthere" and got[1]["text"] == one
    else:
        assert got[2]["removed_lines"] == "2,3,4,6,7,8,9" and got[2]["n_words_removed"] == 7 * 12 + 8


def test_extension_goes_both_ways():
    def extend(own, first, shift, starts):
        return list(zip(*(x.tolist() for x in winnow.extend(np.array(own), np.array(first), shift, np.array(starts))), strict=True))

    first, own = [9, 1, 2, 3, 4, 5, 8], [7, 7, 1, 2, 3, 4, 5, 6]
    assert extend(own, first, 1, [4]) == [(2, 7)]
    assert extend(own, first, 1, [4, 2, 3]) == [(2, 7)]
    assert extend([1, 1, 1, 1], [1, 1, 1, 1], 1, [1, 2]) == [(1, 4)]
    assert extend([1, 2], [5, 5, 1, 2, 3], -2, [0]) == [(0, 2)]
    assert extend([1, 2, 3, 0, 4, 5], [1, 2, 3, 9, 4, 5], 0, [5, 1]) == [(0, 3), (4, 6)]


def test_lines_and_words_together_like_brute_force(make_docs):
    rng = random.Random(23)
    word = lambda: "".join(rng.choice("abcde") for _ in range(2))
    lines = [" ".join(word() for _ in range(rng.randint(1, 9))) for _ in range(25)]
    docs = {}
    for i in range(120):
        at = [rng.randint(0, 20) for _ in range(rng.randint(0, 4))]
        out = [x for a in at for x in lines[a : a + rng.randint(1, 5)]]
        if rng.random() < 0.4:  # the same words in other lines
            out = "".join(w + rng.choice("   \n") for x in out for w in x.split()).split("\n")
        docs[i] = rng.choice(["", "\n", " ".join(word() for _ in range(4)) + " "]) + "\n".join(out) + rng.choice(["", "\n", " x"])
    got = {
        r["doc_id"]: r
        for r in winnow.dedup_passages(make_docs([(i, t, "en", "s") for i, t in docs.items()]), 10, "gone", "n").collect()
    }
    want = gone_words(docs, 10)
    assert sum(map(len, want.values())) > 500
    for i, t in docs.items():
        assert norm(got[i]["text"]) == [w for k, w in enumerate(norm(t)) if k not in want[i]]
        assert got[i]["n"] == len(want[i])
