import hashlib
import random

import numpy as np
import pytest
from arborlens.llm import bpe
from arborlens.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")
ALPHABET = "abcdefgXYZ'’sßẞΣσςİıé éü 123٣½Ⅷ.,!?#$<|>\u0085  ​\u001c\n\t日本語한국어🙂👨‍👩‍👧ﬁǄᴬ힣" + "́̈"


@pytest.fixture(scope="module")
def both():
    return bpe.ForcedBoundaryBpe(vocabulary()), tokenizers.Tokenizer.from_file(vocabulary())


def test_equals_the_library(both):
    own, library = both
    r = random.Random(1)
    texts = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 60))) for _ in range(4000)]
    texts += ["", "  ", "<|endoftext|>", "a<|startoftext|>B <|endoftext|", "it'S I'LL don'T ''s", "a" * 3000, "zq" * 200 + "the" * 100, "Internationalization of the "]
    for text, ids in zip(texts, own.encode_many(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_no_merge_crosses_a_cut(both):
    own, _ = both
    word = "qzxjunabcé"
    parts = own.fragments(word)
    assert len(parts) > 1
    whole = own.encode(word).tolist()
    assert [i for p in parts for i in own._long_fragment(p)] == whole
    assert own._long_fragment(tuple(u for p in parts for u in p)) == whole


def test_memory_is_bounded(both, monkeypatch):
    own = bpe.ForcedBoundaryBpe(vocabulary())
    monkeypatch.setattr(bpe, "CACHE", 50)
    for k in range(20):
        own.encode_many([" ".join(f"word{k}x{i}" for i in range(5))])
        assert len(own.known) <= 50


def test_rows(spark):
    rows = [(1, "Hello, wörld!", 7), (2, None, 8), (3, "", 9), (1, "Hello, wörld!", 7), (None, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(df, vocabulary()).collect()}
    library = tokenizers.Tokenizer.from_file(vocabulary())
    want = set()
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == want
    encoded = bpe.encode(df, vocabulary())
    assert encoded.columns == ["doc_id", "n_tokens", "_n_tokens", "token_ids"]
    assert sorted(len(r.token_ids) for r in encoded.collect()) == sorted(r["_n_tokens"] for r in encoded.collect())
    assert bpe.round_trip(df.limit(0), vocabulary()).count() == 0


def test_common_words_are_encoded_once(both, monkeypatch):
    """However many rare words go by, words that every call holds are never encoded again."""
    own, merge, taken = bpe.ForcedBoundaryBpe(vocabulary()), bpe.ForcedBoundaryBpe._merge, []
    monkeypatch.setattr(bpe, "CACHE", 200)
    monkeypatch.setattr(own, "_merge", lambda *a: (taken.append(len(a[2])), merge(own, *a))[1])
    name = lambda k: "".join(chr(97 + k // 26**i % 26) for i in range(4))
    common = [name(k) for k in range(30)]
    for k in range(40):
        rare = [name(1000 + 20 * k + i) for i in range(20)]
        own.encode_many([" ".join(common), " ".join(rare)])
        assert len(own.known) <= 200
        assert k == 0 or sum(taken) <= 4 * len(rare), k
        taken.clear()


@pytest.mark.parametrize("mixed", [None, lambda h: h % np.uint64(7)])
def test_batches_of_all_kinds(both, monkeypatch, mixed):
    """Plain, odd, empty and special texts together, words of all lengths, few words remembered, and words of one hash."""
    _, library = both
    own = bpe.ForcedBoundaryBpe(vocabulary())
    monkeypatch.setattr(bpe, "CACHE", 300)
    monkeypatch.setattr(bpe, "AT_ONCE", 500)
    if mixed:
        monkeypatch.setattr(bpe, "mix", mixed)
    r = random.Random(2)
    texts = ["x" * n + " " + "é" * n + " " + "=" * n + "'" * (n % 3) + "s" for n in (*range(6, 18), 31, 32, 33, 64, 65, 300)]
    texts += ["", "\n", "a\x00\x00b \x00 \x0b\x0c\x1c\x1f", "we'll They'RE it''s 's'd'vex ''re !'s l'l 'r 'v '", "ªº µ×÷ ß\xad\x80\x85\xa0²¼ ½", "<|endoftext|>", " <|endoftext|> <|startoftext|>'s", "日本 ab", "1234'5'm"]
    texts += ["".join(r.choice("abé'smtdrevl1! \n") for _ in range(r.randint(0, 80))) for _ in range(600)]
    texts += ["".join(chr(r.choice([*range(256), *range(0x20, 0x7F)])) for _ in range(r.randint(0, 60))) for _ in range(600)]
    for _ in range(2):
        r.shuffle(texts)
        for a in range(0, len(texts), 100):
            for text, ids in zip(texts[a : a + 100], own.encode_many(texts[a : a + 100]), strict=True):
                assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
            assert len(own.known) <= 300
