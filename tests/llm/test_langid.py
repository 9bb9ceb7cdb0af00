import random
import zlib

import pytest

from rosband.llm import langid

SF = "/root/testdata/sf0.001"


def slow_phrases(codes, substrings):
    i = n = 0
    while i < len(codes):
        j = i
        while j < len(codes) and bytes(codes[i : j + 1]) in substrings:
            j += 1
        i, n = max(j, i + 1), n + 1
    return n


@pytest.mark.parametrize("few", [1, 100])
def test_phrases_like_brute_force(few, monkeypatch):
    monkeypatch.setattr(langid, "_FEW", few)
    texts = {"a": ["the cat sat on the mat and that was the cat"], "b": ["der hund und die katze sind da"]}
    parser = langid.Parser(texts)
    rng = random.Random(2)
    some = ["".join(rng.choice("thecatsdrunéo  .") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    codes = [c for x in some if len(c := parser._codes_by(parser.code, x))]
    got = parser.phrases(codes)
    for k, name in enumerate(parser.languages):
        whole = bytes(parser._codes_by(parser.code, "\n".join(texts[name])).tolist())
        assert [slow_phrases(c.tolist(), whole) for c in codes] == got[k].tolist()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = langid.digest(docs).collect()
    assert len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    out = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in out) >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_sample_holds_whole_texts_of_every_language(make_docs):
    rows = [(i, f"short text number {i} " * (1 + i % 3), "en", "s") for i in range(200)]
    rows += [(1000 + i, "lang und mehr " * (500 + i), "de", "s") for i in range(20)]
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    got = langid.learn(make_docs(rows), rows=5, row_chars=50)
    fits = {t for _, t, lang, _ in learned if lang == "en" and len(t) <= 50}
    assert len(got["en"]) == 5 and set(got["en"]) <= fits
    assert got["de"] == [min((t for _, t, lang, _ in learned if lang == "de"), key=len)]


def test_awkward_rows(awkward, empty_docs, make_docs):
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.digest(awkward).collect()}
    assert {(2, "und"), (3, "und"), (6, "und"), (None, "und")} <= got
    assert langid.digest(empty_docs).collect() == []
    none = make_docs([(1, "no labels at all", None, "s"), (2, "x", None, "s")])
    assert {r["lang_pred"] for r in langid.digest(none).collect()} == {"und"}
    one = make_docs([(i, "the only language", "en", "s") for i in range(8)])
    assert {(r["lang_pred"], r["score"]) for r in langid.digest(one).collect()} == {("en", 1.0)}
