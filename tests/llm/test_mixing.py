import hashlib
import math
from collections import Counter

import pytest
from arborlens.llm import mixing
from pyspark.sql import functions as F


def table(spark):
    rows = [(i, "word " * (i % 7 + 1), "big" if i % 3 else f"s{i % 5}") for i in range(600)]
    rows += [(700, "orphan", None), (701, None, "s0"), (702, "", "empty"), (700, "orphan", None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def expected(rows, weights=None, seed=17):
    chars = Counter()
    for _, t, s in rows:
        chars[s] += len(t or "")
    w = {s: 1.0 if weights is None else weights.get(s, 0.0) for s in chars}
    out = Counter()
    for i, _, s in rows:
        mean = 0 if w[s] <= 0 else 1 if not chars[s] else w[s] / sum(w.values()) * sum(chars.values()) / chars[s]
        u = int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) / 2**52
        k, p = 0, math.exp(-mean)
        c = p
        while c <= u:
            k += 1
            p *= mean / k
            c += p
        out[i] += k
    return out


def test_counts_equal_the_inverted_distribution(spark):
    rows, df = table(spark)
    for weights in (None, {"big": 3.0, "s1": 1.0}):
        got = Counter(r.doc_id for r in mixing.mix(df, weights).collect())
        assert got == +expected(rows, weights)


def test_order_is_a_shuffle_and_columns_stay(spark):
    _, df = table(spark)
    out = mixing.mix(df)
    ids = [r.doc_id for r in out.collect()]
    assert out.columns == df.columns
    assert ids == [r.doc_id for r in mixing.mix(df.repartition(7)).collect()]
    assert ids != sorted(ids)
    keyed = mixing.mix(df.withColumnRenamed("text", "copy"), text="copy", keep_keys=True)
    assert keyed.columns == ["doc_id", "copy", "source", "_copy", "shuffle_key"]
    assert mixing.mix(df.limit(0)).count() == 0


def test_shares_reach_their_targets(spark):
    rows = [(i, "x" * 10, "a" if i % 10 else "b") for i in range(5000)]
    got = Counter(r.source for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    assert abs(got["a"] - 2500) < 250 and abs(got["b"] - 2500) < 700


def test_plan_has_no_python(spark):
    _, df = table(spark)
    plan = mixing.mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def inverse(mean, u):
    """Least k whose cumulative probability exceeds u, each probability from its logarithm."""
    k, c = 0, math.exp(-mean)
    while c <= u:
        k += 1
        c += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
    return k


@pytest.mark.parametrize("mean", [0.1, 50.0, 700.0, 5000.0])
def test_counts_by_mean_equal_inversion_in_logarithms(spark, mean):
    n = 20
    rows = [(i, "x" * 10, "s") for i in range(n)]
    got = Counter(r.doc_id for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), {"s": 1.0}, total=mean * n * 10).collect())
    parts = math.ceil(mean / mixing.MOST_MEAN)
    u = lambda *key: int(hashlib.md5(":".join(map(str, key)).encode()).hexdigest()[:13], 16) / 2**52
    want = {i: sum(inverse(mean / parts, u(17, i) if k == 0 else u("17/part", i, k)) for k in range(parts)) for i in range(n)}
    assert got == +Counter(want)


def test_sources_beyond_the_broadcast_list(spark, monkeypatch):
    rows, df = table(spark)
    monkeypatch.setattr(mixing, "MOST_BROADCAST", 3)
    assert Counter(r.doc_id for r in mixing.mix(df).collect()) == +expected(rows)


def test_large_means_are_drawn_too(spark):
    # exp(-mean) is 0 in double precision from 746 on
    rows = [(i, "x", "small") for i in range(60)] + [(60, "y" * 240_000, "big")]
    got = Counter(r.doc_id for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    counts = [got[i] for i in range(60)]
    mean = 240_060 / 2 / 60
    assert abs(sum(counts) / 60 - mean) < 5 * math.sqrt(mean / 60)
    assert 0.4 * mean < sum((c - mean) ** 2 for c in counts) / 60 < 2 * mean


def test_a_count_of_millions_is_no_row_of_millions(spark):
    df = spark.createDataFrame([(1, "x", "s")], "doc_id long, text string, source string")
    keyed = mixing.mix(df, {"s": 1.0}, total=1_500_000.0, keep_keys=True)
    n, distinct, top = keyed.agg(F.count(F.lit(1)), F.count_distinct("copy"), F.max("copy")).first()
    assert abs(n - 1_500_000) < 6 * math.sqrt(1_500_000) and distinct == n and top >= 2999 * mixing.PART_COPIES
    assert dict(keyed.dtypes)["copy"] == "bigint"
