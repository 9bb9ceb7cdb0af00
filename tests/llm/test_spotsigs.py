import hashlib

import regex

from rosband.llm import spotsigs

ANCHORS = set(spotsigs.anchor_list())


def spots(text, chain=2):
    words = regex.sub(r"[^\p{L}\p{N}]+", " ", text.lower()).strip(" ").split(" ")
    out = set()
    for i, w in enumerate(words):
        if w in ANCHORS:
            after = [x for x in words[i + 1 :] if x not in ANCHORS][:chain]
            if len(after) == chain:
                out.add((w, *after))
    return out or {("whole", *words)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def check(docs):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    distinct = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = spotsigs.digest(docs).collect()
    assert len(got) == len(rows)
    return distinct, got


def test_whole_table(make_docs):
    texts = ["The cat sat on the mat and the dog ran to the big house with a stone", "", "no spots here", None,
             "a man and a dog in the old house by the sea with the big boat é", "the cat", "x"]
    docs = make_docs([(10 * i, t, "en", "s") for i, t in enumerate(texts)], clashes=True)
    distinct, got = check(docs)
    text = dict(distinct)
    after = {i: distinct[(k + 1) % len(distinct)][0] for k, (i, _) in enumerate(distinct)}
    for r in got:
        t, nxt = text[r["doc_id"]], text[after[r["doc_id"]]]
        h = len(t) // 2
        e = t[: len(t) - h] + nxt[:h]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert abs(r["near_edited"] - jaccard(spots(t), spots(e))) < 1e-12
        assert abs(r["near_next"] - jaccard(spots(t), spots(nxt))) < 1e-12
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (spots(t) == spots(e))


def test_order_over_many_ranges(make_docs):
    docs = make_docs([(i * 7 % 101, f"the text number {i} of a table", "en", "s") for i in range(101)])
    order = {r["key"]: r for r in spotsigs.in_order(docs, parts=9).collect()}
    for k, r in order.items():
        assert r["next_key"] == (k - 1) % 101 and r["prev_key"] == (k + 1) % 101


def test_awkward_rows(awkward, empty_docs, make_docs):
    _, got = check(awkward)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[3][0]["fingerprint"] == by_id[2][0]["fingerprint"] == by_id[6][0]["fingerprint"]  # texts without a word
    assert len(by_id[5]) == 3 and len({r["fingerprint"] for r in by_id[5]}) == 2
    assert spotsigs.digest(empty_docs).collect() == []
    only = spotsigs.digest(make_docs([(1, "the big cat ran in the old house", "en", "s")])).first()
    assert only["near_next"] == 1.0
