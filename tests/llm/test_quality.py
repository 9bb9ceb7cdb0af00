import collections
import re

import pytest

from rosband.llm import quality


def base(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    marked = {j for i in range(len(w) - 7) if n[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marked)


def counts_of(r):
    return r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]


@pytest.mark.parametrize(
    "text",
    ["", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 30, "a\nb\na\n \n \nb c #*", "é " + "a b c d e f g h i " * 3,
     "w\x1cw\x85w \x0b\x0c\r\tz", " ".join("abcdefghijabcdefghk")],
)
def test_base_counts_like_brute_force(text):
    assert quality.text_counts(text)[:5] == base(text)


def body(i, n=40):
    return " ".join(f"d{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(n))


def test_lines_above_the_limit(make_docs):
    menu, footer = "Home | About | Contact 12", "all rights reserved by the site owner and its many good friends"
    rows = [(i, f"{menu}\n{body(i)}", "en", "busy") for i in range(10)]
    rows += [(20, f"{footer}\n{body(20, 30)}", "en", "busy"), (21, f"{footer}\n{body(21, 30)}", "en", "busy")]
    rows += [(30 + i, body(99), "en", "busy") for i in range(9)]  # copies count as one document
    rows += [(50, (menu + "\n") * 5 + "and four more words", "en", "busy"), (60, f"{menu}\n{body(60)}", "en", "calm")]
    docs = make_docs(rows)
    limits = {"min_docs": 5, "share": 0.3}
    got = {r["doc_id"]: r for r in quality.verdicts(docs, **limits).collect()}
    assert got[0]["removed_words"] == 0  # the first document keeps the line
    assert all(got[i]["removed_words"] == 6 and got[i]["removed_at"] == [0] and got[i]["kept"] for i in range(1, 10))
    assert not got[50]["kept"] and got[50]["removed_words"] == 30  # depleted
    assert all(got[i]["kept"] and got[i]["removed_words"] == 0 for i in (20, 21, 30, 38, 60))
    kept = {r["doc_id"]: r for r in quality.keep(docs, **limits).collect()}
    assert set(kept) == {i for i, r in got.items() if r["kept"]}
    assert kept[3]["text"] == body(3) and kept[3]["n_chars"] == len(body(3)) and kept[0]["text"].startswith("Home")


def test_default_limits_do_not_grow_with_the_host(make_docs):
    """A footer in 60 of 1,500 documents goes, and documents that are little else are rejected."""
    footer = "sign up for our letter and never miss what our many good friends write about the town and its people"
    rows = [(i, f"{body(i, 30)}\n{footer}", "en", "large") for i in range(50)]
    rows += [(100 + i, f"{footer}\n{body(200 + i, 4)}", "en", "large") for i in range(10)]
    rows += [(1000 + i, body(500 + i), "en", "large") for i in range(1440)]
    rows += [(5000 + i, f"{footer}\n{body(4000 + i, 4)}", "en", "small") for i in range(quality.MIN_DOCS)]
    got = {r["doc_id"]: r for r in quality.verdicts(make_docs(rows)).collect()}
    n = len(footer.split())
    assert [got[i]["removed_words"] for i in range(50)] == [0] + [n] * 49 and all(got[i]["kept"] for i in range(50))
    assert not any(got[100 + i]["kept"] for i in range(10))  # depleted
    assert all(got[5000 + i]["kept"] and got[5000 + i]["removed_words"] == 0 for i in range(quality.MIN_DOCS))
    assert sum(r["removed_words"] > 0 for r in got.values()) == 59


def test_digits_and_case_are_normalised(make_docs):
    rows = [(i, f"Page {i} OF 99\n{body(i)}", "en", "h") for i in range(6)]
    got = quality.verdicts(make_docs(rows), min_docs=2, share=0.1).collect()
    assert sorted(r["removed_words"] for r in got) == [0, 4, 4, 4, 4, 4]


def test_awkward_rows(awkward, empty_docs):
    got = quality.digest(awkward).collect()
    texts = collections.Counter(base(r["text"] or "") for r in awkward.collect())
    assert collections.Counter(map(counts_of, got)) == texts
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    kept = quality.keep(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(r["kept"] for r in got)
    assert kept.select("host").distinct().collect() == [("extra host",)]
    assert quality.digest(empty_docs).collect() == [] and quality.keep(empty_docs).collect() == []
