import re

import pytest

from rosband.llm import licenses as lic


def accepts(template, text):
    words = lic.words_of(text)
    return lic.compile_template(template).longest(words, 0) == len(words)


def test_optional_and_replaceable_regions():
    t = "a b <<optional>> c <<optional>> d <<end>> <<end>> e <<any 0-2>> f"
    assert accepts(t, "A b, e f") and accepts(t, "a b c e f") and accepts(t, "a b c d e x f") and accepts(t, "a b e x y f")
    assert not accepts(t, "a b d e f") and not accepts(t, "a b e x y z f") and not accepts(t, "a b c") and not accepts(t, "a e f")


@pytest.mark.parametrize("bad", ["<<optional>> a <<end>>", "a <<optional>> b"])
def test_bad_templates(bad):
    with pytest.raises(ValueError):
        lic.compile_template(bad)


def test_templates_accept_their_own_wording():
    for label, templates in lic.TEMPLATES.items():
        for t in templates:
            full = re.sub(r"<<any \d+-(\d+)>>", lambda m: " x" * int(m[1]), re.sub("<<(optional|end)>>", "", t))
            least = t
            while re.search(r"<<optional>>((?!<<optional).)*?<<end>>", least):
                least = re.sub(r"<<optional>>((?!<<optional).)*?<<end>>", "", least)
            least = re.sub(r"<<any (\d+)-\d+>>", lambda m: " x" * int(m[1]), least)
            for text in (full, least):
                assert label in lic.Scanner({}, lic.TEMPLATES).scan(f"see. {text}, end")["labels"].split(",")


def test_mandatory_wording():
    scan = lic.Scanner(lic.PHRASES, lic.TEMPLATES).scan
    assert scan("This work is licensed under the GNU General Public License, version 3.")["labels"] == "gpl-3"
    assert scan("licensed under the GNU General Public License, version 2")["labels"] == ""
    one = scan("x Released under the MIT License; under the MIT license")
    assert (one["n_base"], one["first_word"], one["last_word"], one["base_labels"]) == (2, 2, 6, "mit")


def test_base_like_brute_force(make_docs, awkward, empty_docs):
    texts = ["cc by nc cc by nc", "CC-BY-NC", "under the mit\nlicense Apache License, Version 2.0", "ccé by nc", "", None,
             "apache license version 20", "under the mit license " * 3000]
    docs = make_docs([(i, t, "en", "s") for i, t in enumerate(texts)])
    for r in lic.digest(docs).collect():
        t = re.sub("[A-Z]", lambda m: m.group().lower(), texts[r["doc_id"]] or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
        at = {p: [i for i in range(len(w)) if w[i : i + len(p.split())] == p.split()] for p in lic.PHRASES}
        places = sorted(i for x in at.values() for i in x)
        assert r["n_words"] == len(w) and r["n_base"] == len(places)
        assert (r["first_word"], r["last_word"]) == ((places[0], places[-1]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted(lic.PHRASES[p] for p, x in at.items() if x))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1
    assert lic.digest(awkward).count() == awkward.count()
    assert lic.digest(empty_docs).collect() == []
