import random
import re

import numpy as np
import pytest
from arborlens.llm import ngram_join
from arborlens.llm.common import hashes_by_text, word_hashes
from arborlens.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {(i, len(s), root(i)) for i, s in sets}


def corpus():
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    passage = [r.choice(vocab) for _ in range(60)]
    rows = []
    for _ in range(60):  # documents with a shared passage
        rows.append([r.choice(vocab) for _ in range(r.randint(0, 120))] + passage * (r.random() < 0.5))
    base = [r.choice(vocab) for _ in range(150)]
    for _ in range(80):  # near copies on both sides of the threshold
        c = list(base)
        for _ in range(r.randint(0, 5)):
            c[r.randrange(len(c))] = "edit" + str(r.randrange(10**6))
        rows.append(c)
    for _ in range(40):  # exact copies
        rows.append(list(base))
    for n in range(8):
        rows += [["To"] * n + ["of"] * n, ["a", "b"] * n]
    texts = [" ".join(x) for x in rows] + [None, "", " \t\n", "One two", "one TWO", "é è", "É è", "x\x1cy z", "word " * 3000]
    return list(enumerate(texts))


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(df).collect()}
    assert got == brute(rows)


def test_repeats_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (3, "A b c d e f"), (None, "a b c d e f"), (9, None)], "doc_id long, text string")
    got = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(df).collect()], key=str)
    assert got == sorted([(5, 2, 3), (5, 2, 3), (3, 2, 3), (None, 2, None), (9, 0, 9)], key=str)
    assert ngram_join.join(df.limit(0)).count() == 0


def test_one_id_with_several_texts(spark):
    rows = [(5, "a b c d e f"), (5, "p q r s t u"), (5, "m n o"), (7, "P q r s t u"), (2, "m n o"), (9, "x y"), (5, "a b c d e f")]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([(5, 2, 5), (5, 2, 5), (5, 1, 2), (7, 2, 5), (2, 1, 2), (9, 1, 9), (5, 2, 5)])


def test_a_passage_that_all_share_makes_no_pairs(spark):
    passage = " ".join(f"p{k}" for k in range(19))
    rows = [(i, passage + "".join(f" o{i}x{k}" for k in range(4))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = spark.sparkContext.broadcast(ngram_join._common_tokens(df))
    groups = ngram_join._sketch(df, held).selectExpr("doc_id as comp", "-1 as blk", "n", "shown", "prefix")
    assert ngram_join._looked_at(groups).count() == 0
    assert {r.component_id for r in ngram_join.join(df).collect()} == set(range(200))


def test_small_blocks_and_parts_give_the_same(spark, monkeypatch):
    rows = corpus()
    for name, value in (("BLOCK_TOKENS", 500), ("QUERY_TOKENS", 400), ("ENTRIES_AT_ONCE", 2), ("BANDS", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    monkeypatch.setattr(ngram_join, "ODD", ngram_join.ODD[:1])
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_bounds_never_exceed_the_truth():
    r = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(r.integers(0, 2**63, r.integers(1, 300), dtype=np.uint64))
        b = np.unique(np.concatenate([a[r.random(len(a)) < 0.8], r.integers(0, 2**63, r.integers(0, 100), dtype=np.uint64)]))
        if len(b):
            assert ngram_join.differing(ngram_join.parity_bits(a), ngram_join.parity_bits(b)) <= len(np.setxor1d(a, b))
    for n in range(1, 500):
        p, q = ngram_join.prefix_sizes(n)
        assert 1 <= q <= p <= n and p == n - -(-3 * n // 4) + 1


@pytest.mark.parametrize("in_a_task", [0, 10_000])
def test_components_of_a_long_chain_and_a_star(spark, in_a_task):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), in_a_task=in_a_task).collect()}
    assert got == {i: 0 for i in range(51)} | {100 + k: 100 for k in range(30)}


def test_word_hashes_tell_words_apart(monkeypatch):
    texts = ["a b\tc\x0bd", None, "", "B a", "é  é", "long" * 40000 + " x"]
    found = hashes_by_text(texts)
    assert [len(f) for f in found] == [4, 0, 0, 2, 2, 2]
    assert found[0][0] == found[3][1] and found[0][1] != found[3][0]
    assert hashes_by_text(texts, fold=True)[3][0] == found[0][1]
    data = b" ".join(b"w%d" % (i % 999) for i in range(5000))
    whole = word_hashes(data)
    monkeypatch.setattr("arborlens.llm.common.CHUNK_CHARS", 400)
    parts = word_hashes(data)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    assert len(set(whole[0].tolist())) == 999


@pytest.mark.parametrize("n", [1, 4, 5, 6])
def test_short_texts_are_one_shingle(n):
    assert len(ngram_join.shingle_sets([" ".join(f"q{i}" for i in range(n))])[0]) == max(1, n - 4)
