import hashlib
import random

import pytest
from tokenizers import Tokenizer

from pagegraph.llm import bpe
from tests.llm.conftest import values


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.default_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def encoder():
    with open(bpe.default_vocabulary(), "rb") as f:
        return bpe.Encoder(f.read())


def fuzz(seed, n):
    rng = random.Random(seed)
    alphabets = ["abcdefgh", "thea ndreio", "'sdmtlv eran", "0123456789 .,!?", "äöüßéèçñ ", "αβγΣς ", "日本語中文 ", "\U0001f600‍❤ ", " \t\n  "]
    return ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(80))) for _ in range(n)]


CASES = ["", " ", "it's DON'T we'LL they've", "x<|endoftext|>y <|startoftext|>", "<|endoftext", "é Ångström", "İstanbul", "ΟΔΟΣ", "a" * 3000, "supercalifragilistic" * 40]


def test_same_as_the_library(encoder, library):
    texts = CASES + fuzz(3, 800)
    for text, ids in zip(texts, encoder.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text
        assert encoder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_pairs_are_compatible_exactly_if_merging_leaves_them(encoder, library):
    v, rng = encoder.vocabulary, random.Random(4)
    inner, last = sorted(v.inner.items()), sorted(v.last.items())
    for _ in range(300):
        (a, i), (b, j) = rng.choice(inner), rng.choice(last)
        assert v.compatible(i, j) == (v.encode_words([a + b])[a + b] == [i, j])


def test_operators_on_odd_rows(odd, odd_rows, none, clashing, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, text, *_ in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert values(bpe.digests(odd.select("doc_id", "text")), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    encoded = bpe.encode(odd)
    assert encoded.columns == ["doc_id", "lang", "source", "n_chars", "ids"]
    decoded = bpe.decode(encoded.select("doc_id", "ids"))
    assert sorted((i, sha(s)) for i, s in values(decoded, "doc_id", "decoded") if i) == sorted((i, d) for i, _, _, d in want if i)
    assert bpe.encode(none).count() == 0
    assert bpe.encode(clashing).filter("size(ids) > 0").count() == sum(n > 0 for _, n, _, _ in want)
