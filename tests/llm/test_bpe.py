import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from rosband.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
CHARS = " \n\t a bcd'sre’é漢字😀12  .!?  　ing the"


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return bpe.Vocabulary(bpe.read_ranks(f.read()))


@pytest.fixture(scope="module")
def codec(vocabulary):
    return bpe.Codec(vocabulary, PATTERN)


@pytest.fixture(scope="module")
def public(vocabulary):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary.rank, special_tokens={})


def ids(data):
    return list(memoryview(data).cast("I"))


def random_text(rng, most):
    return "".join(rng.choice(CHARS) for _ in range(rng.randint(0, most)))


def test_random_texts_like_the_public_library(codec, public):
    rng = random.Random(1)
    for _ in range(4000):
        x = random_text(rng, 40)
        assert ids(codec.encode(x)) == public.encode_ordinary(x), x
        assert codec.decode(codec.encode(x)) == x.encode()


def test_long_piece(codec, public):
    x = "abcdefgh" * 5000 + " " * 300 + "9" * 2000
    assert ids(codec.encode(x)) == public.encode_ordinary(x)


def test_last_tokens_are_those_of_the_prefixes(vocabulary):
    data = "überraschungsthingtion".encode()
    table = bpe.PrefixTable(vocabulary, data)
    assert table.last == [vocabulary.merge(data[:i])[-1] for i in range(1, len(data) + 1)]


def test_append_and_edit_of_a_piece(vocabulary):
    table = bpe.PrefixTable(vocabulary, b"ontionre")
    table.append(b"thing")
    assert table.last == bpe.PrefixTable(vocabulary, b"ontionrething").last
    table.edit(3, 6, b"xyz")
    assert table.last == bpe.PrefixTable(vocabulary, b"ontxyzrething").last


def test_edits_of_texts(codec):
    rng = random.Random(2)
    for _ in range(1500):
        x = random_text(rng, 40)
        own = bpe.TextEncoding(codec, x)
        for _ in range(3):
            a = rng.randint(0, len(x))
            b = rng.randint(a, min(len(x), a + 6))
            new = random_text(rng, 8)
            own.edit(a, b, new)
            x = x[:a] + new + x[b:]
            assert own.text == x and own.encoded() == codec.encode(x)


def test_whole_table(spark, awkward, empty_docs, public):
    got = bpe.digest(awkward, PATH, PATTERN).collect()
    want = []
    for row in awkward.select("doc_id", "text").collect():
        t = row["text"] or ""
        enc = public.encode_ordinary(t)
        raw = b"".join(i.to_bytes(4, "little") for i in enc)
        want.append((row["doc_id"], len(enc), hashlib.sha256(raw).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert bpe.digest(empty_docs, PATH, PATTERN).collect() == []
    kept = bpe.encode(awkward, PATH, PATTERN)
    assert kept.columns == [c for c in awkward.columns if c != "ids"] + ["ids"]
