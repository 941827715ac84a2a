import hashlib
import random

import pytest
from arborlens.llm import simhash
from pyspark.sql import functions as F


def next_and_edited(rows):
    """Brute force over rows of unique ids: the text of the next row by descending id, and the edited text."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        out[i] = (t, t[: len(t) - half] + following[:half], following)
    return out


def corpus(n=700):
    r = random.Random(2)
    words = [f"term{k}" for k in range(300)] + ["é", "日本語", "🙂"]
    rows = [(r.choice([1, 7, 1000]) * 10_000 + k, " ".join(r.choice(words) for _ in range(r.randint(0, 60)))) for k in range(n)]
    return [*rows, (5, None), (6, ""), (99_999_999, "last one")]


def test_edited_text_and_neighbours_follow_the_ids(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in simhash.sensitivity(df).collect()}
    want = next_and_edited(rows)
    assert set(got) == set(want)
    texts = sorted({x for v in want.values() for x in v})
    prints = {r.text: r.fp for r in simhash.fingerprints(spark.createDataFrame([(t,) for t in texts], "text string"), ["text"], {"fp": F.col("text")}).collect()}
    for i, (text, edited, following) in want.items():
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fp, r.edited_fp, r.next_fp) == (prints[text], prints[edited], prints[following])


def test_buckets_follow_the_rows_not_the_ids(spark):
    ids = [*range(3000), 2**60, 2**62, -(2**62)]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "doc_id long")
    dealt, _ = simhash.in_id_order(df, "doc_id", "b", "l", rows_per_bucket=20)
    sizes = [r["count"] for r in dealt.where("not l").groupBy("b").count().collect()]
    assert sum(sizes) == 3004 and max(sizes) < 80 and len(sizes) > 100
    bounds = list(range(0, 3000, 7))
    got = spark.createDataFrame([(i,) for i in range(-3, 3010)], "k long").select("k", simhash.bucket_of(F.col("k"), bounds).alias("b")).collect()
    assert all(r.b == sum(x <= r.k for x in bounds) for r in got)


def test_whole_blocks():
    assert [simhash.whole_blocks(n) for n in (0, 100_000, 10_000_000, 10**10)] == [2, 2, 2, 3]


def test_likeness_follows_the_edits(spark):
    rows = [x for x in corpus() if x[1] and len(x[1]) > 200]
    found = simhash.sensitivity(spark.createDataFrame(rows, "doc_id long, text string"))
    r = found.agg(F.avg(simhash.likeness(F.col("fp"), F.col("edited_fp"))).alias("edited"), F.avg(simhash.likeness(F.col("fp"), F.col("next_fp"))).alias("other")).first()
    assert r.edited > r.other + 0.1 and abs(r.other - 0.5) < 0.1


def test_odd_tables(spark):
    one = spark.createDataFrame([(3, "only words here")], "doc_id long, text string")
    r = simhash.sensitivity(one).first()
    assert r.fp == r.next_fp and r.edited_sha256 == hashlib.sha256(b"only wordonly wo"[:8] + b"only wo").hexdigest()
    assert simhash.sensitivity(one.limit(0)).count() == 0
    odd = spark.createDataFrame([(3, "a"), (3, "b"), (None, "c"), (3, "a")], "doc_id long, text string")
    assert simhash.sensitivity(odd).count() == 4


@pytest.mark.parametrize(("radius", "extra"), [(3, 2), (3, 1), (0, 1), (5, 3)])
def test_block_tables_find_all_within_the_radius(spark, radius, extra):
    r = random.Random(3)
    prints = [r.getrandbits(64) for _ in range(40)]
    for p in list(prints):
        for _ in range(4):
            q = p
            for b in r.sample(range(64), r.randint(0, radius + 1)):
                q ^= 1 << b
            prints.append(q)
    prints += [0, (1 << 64) - 1]
    df = spark.createDataFrame([(simhash.signed(p),) for p in prints] + [(None,)], "fp long")
    got = [(x.query_fp, x.corpus_fp, x.distance) for x in simhash.neighbours(df, df, radius, extra).collect()]
    want = {(simhash.signed(a), simhash.signed(b), (a ^ b).bit_count()) for a in set(prints) for b in set(prints) if (a ^ b).bit_count() <= radius}
    assert len(got) == len(set(got)) and set(got) == want
