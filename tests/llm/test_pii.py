import collections
import hashlib
import random
import re

from pyspark.sql import functions as F

from rosband.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for kind, pattern, least, most in (("card", r"[0-9]([\x20-]?[0-9])+", 13, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m.group())
            if least <= len(digits) <= most and (kind == "phone" or luhn(digits)):
                out.append((kind, *m.span()))
    return out


def check(docs):
    rows = collections.Counter((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())
    want = collections.Counter()
    for (i, t), n in rows.items():
        spans = base(t)
        kinds = collections.Counter(s[0] for s in spans)
        listed = ",".join("%s:%d:%d" % s for s in spans)
        want[(i, *(kinds[k] for k in pii.KINDS), hashlib.sha256(listed.encode()).hexdigest())] += n
    got = pii.digest(docs).collect()
    names = ["doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256"]
    assert collections.Counter(tuple(r[n] for n in names) for r in got) == want
    return got


def test_base_spans_like_brute_force(make_docs):
    rng = random.Random(5)
    parts = ["a", "b@", "@", "c.d", "1", ".", "2", "255", "256", "+1", " ", "-", "(", ")", "4111 1111 1111 1111", "é😀", "_", "%", "\n",
             "x9", "10.0.0.1", "+49 30 123456", "a.b@c.d-e", "00000000000000000255", "4111-1111-1111-1112"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40))), "en", "s") for i in range(800)]
    rows.append((9001, "1 " * 300 + "a@b.c " * 700, "en", "s"))
    rows.append((9002, "a" * 50_000 + "@" + "1" * 50_000 + ".1" * 20_000, "en", "s"))
    check(make_docs(rows))


def test_running_total(spark):
    values = [list(range(n)) for n in (0, 1, 255, 256, 257, 1000)]
    df = spark.createDataFrame([(v,) for v in values], "v array<int>")
    for v, r in zip(values, df.select(pii.running_total(F.col("v")).alias("t")).collect(), strict=True):
        assert r["t"] == [sum(v[:i]) for i in range(len(v))]


def test_contexts_discover_unseen_identifiers(make_docs):
    cards = [f"{n:015d}" for n in range(400000000000000, 400000000000040)]
    cards = [next(c + d for d in "0123456789" if luhn(c + d)) for c in cards]
    rows = [(i, f"please charge visa {c} today and ship order 77{i}123456 tomorrow", "en", "s") for i, c in enumerate(cards)]
    rows += [(100, "they charge visa 400012345678901 today as well", "en", "s")]  # 15 digits, no Luhn: unseen
    rows += [(101, "an order 771234567 tomorrow in clean text", "en", "s"), (102, "no number at all", "en", "s")]
    got = {r["doc_id"]: r for r in check(make_docs(rows))}
    t = rows[40][1]
    at = t.index("4000")
    assert got[100]["spans"] == f"card:{at}:{at + 15}" and got[100]["n_card"] == 0 and got[100]["n_found"] == 1
    assert got[101]["spans"] == "" and got[102]["spans"] == ""
    assert all(r["spans"].count("card") == 1 and r["n_found"] == 0 for i, r in got.items() if i < 40)


def graph_scores(spans, rounds=pii.ROUNDS, prior=pii.PRIOR):
    """The scores of unseen instances by plain loops over patterns and instances."""
    edges = {(side + w, inst, kind) for kind, inst, *words in spans for side, w in zip("<>", words, strict=True) if w}
    own = {(p, i, k) for p, i, k in edges if k}
    seeds = {(p, i) for p, i, k in own}
    kinds = {p: {k for q, _, k in own if q == p} for p, _, _ in own}
    pairs = {(p, k, i) for p, i, _ in edges for k in kinds.get(p, ())}
    score = {(i, k): 0.0 for _, k, i in pairs}
    for _ in range(rounds):
        conf = {}
        for q in {(p, k) for p, k, _ in pairs}:
            mine = [i for p, k, i in pairs if (p, k) == q]
            of = lambda i: float((q[0], i, q[1]) in own) if (q[0], i) in seeds else score[i, q[1]]  # noqa: B023, E731
            conf[q] = sum(map(of, mine)) / (len(mine) + prior)
        for i, k in score:
            left = 1.0
            for p, kk, ii in pairs:
                if (ii, kk) == (i, k) and (p, i) not in seeds:
                    left *= 1 - conf[p, k]
            score[i, k] = 1 - left
    unseen = {(i, k) for p, k, i in pairs if (p, i) not in seeds}
    return {key: v for key, v in score.items() if key in unseen}


def test_graph_scores_like_brute_force(spark):
    rng = random.Random(3)
    spans = [(rng.choice(["email", "card", None, None]), f"i{rng.randrange(30)}", rng.choice(["", "a", "b", "c"]), rng.choice(["", "x", "y", "z"]))
             for _ in range(120)]
    df = spark.createDataFrame(spans, "kind string, instance string, before string, after string")
    got = {(r["instance"], r["kind"]): r["score"] for r in pii.score(df).collect()}
    want = graph_scores(spans)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def planted():
    rows = [(i, f"write to mailbox u{i}@host{i}.org or wait; dial extension +49 30 55{i}0000 after nine", "en", "s") for i in range(12, 40)]
    rows += [
        (100, "Please write to Mailbox john at host, or wait.", "en", "s"),
        (101, "dial extension (030) 44 55 66-77 after nine o'clock", "en", "s"),
        (102, "dial extension phone5551234 after nine", "en", "s"),
        (103, "dial extension number five after nine", "en", "s"),  # no digits
        (104, "write to mailbox john\nat host or wait", "en", "s"),  # two lines
        (105, "write to mailbox " + "a very long walk " * 5 + "or wait", "en", "s"),  # more words than a slot has
        (106, "the mailbox or wait " + "or " * 300, "en", "s"),
        (107, "mailbox" + " " * 100 + "mary at home" + "." * 100 + "or wait", "en", "s"),
        (None, "the mailbox jane at work or wait", "en", "s"),
        (108, "dial extension (030) 44 55 66-77 after nine o'clock", "en", "s"),
        (108, "dial extension (030) 44 55 66-77 after nine o'clock", "en", "s"),
    ]
    return rows


def test_slots_discover_any_shape(make_docs):
    texts = [t for _, t, *_ in planted()]
    got = {r["doc_id"]: r for r in check(make_docs(planted()))}

    def span(kind, value):
        at = next(t for t in texts if value in t).index(value)
        return f"{kind}:{at}:{at + len(value)}"

    assert got[101]["spans"] == got[108]["spans"] == span("phone", "(030) 44 55 66-77")
    assert got[102]["spans"] == span("phone", "phone5551234")
    # "or" stands beside seeds at too few of its places to be a pattern of slots
    assert all(got[i]["spans"] == "" for i in (100, 103, 104, 105, 106, 107, None))
    more = [(i, t.replace("or ", "instead "), lang, s) for i, t, lang, s in planted() if i != 106]
    texts = [t for _, t, *_ in more]
    got = {r["doc_id"]: r for r in check(make_docs(more))}
    assert got[100]["spans"] == span("email", "john at host")
    assert got[107]["spans"] == span("email", "mary at home") and got[None]["spans"] == span("email", "jane at work")
    assert all(got[i]["spans"] == "" for i in (103, 104, 105))
    assert all(r["n_found"] == 0 for i, r in got.items() if i is not None and i < 40)


def test_awkward_rows(awkward, empty_docs):
    assert len(check(awkward)) == awkward.count()
    assert pii.digest(empty_docs).collect() == []
