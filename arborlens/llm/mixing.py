"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixture. With ``total`` characters wanted, a source of
C characters and share w is repeated w * total / C times on average. A document's number of
copies is a Poisson variable of that mean, drawn by inverting the distribution at a uniform
number from the md5 of seed and id: the least k whose cumulative probability exceeds it. A mean
over ``MOST_MEAN`` is split into equal parts of at most that, so that exp(-mean) stays far from 0,
and the count is the sum of a draw for each part, which is a Poisson variable of the whole mean. Each
document is exploded by its parts, and each part by its count, so no row holds more than a part's copies, and
counts of any size fit: copies are numbered from 0 in each part, and parts from multiples of ``PART_COPIES``, as longs. The copies are ordered by the md5 of seed, id and copy,
which shuffles them globally: a sort over even ranges of the md5, so a source that holds a third of
the rows is spread over all tasks, and a text moves once, after its count is drawn.

Null sources form a stratum of their own. Null text counts 0 characters; a source without
characters has mean 1. A source that ``weights`` doesn't name has weight 0 and goes; without
weights all sources weigh the same. Documents of one id get the same count, and exact repeats
tie in order with equal rows. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborlens.llm.common import cut_small, fresh, uniform

#: Sources whose rates are broadcast, at most: those with more than one in so many of the documents.
MOST_BROADCAST = 1000
#: The largest mean that is inverted at once; exp(-745) is the last above 0.
MOST_MEAN = 500.0
#: Numbers of copies that a part has to itself: more than any part draws.
PART_COPIES = 4096


def poisson_cdf(mean: Column) -> Column:
    """Cumulative probabilities at 0, 1, 2, ... far enough that what is left is below any number drawn."""
    ks = F.sequence(F.lit(1), F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int"))
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))
    step = lambda acc, k: F.struct((acc["p"] * mean / k).alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + acc["p"] * mean / k)).alias("c"))
    return F.aggregate(ks, start, step, lambda acc: acc["c"])


def rates(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None, source: str = "source", text: str = "text") -> DataFrame:
    """A row per source: source, n_docs, n_chars, its mean, the equal parts that the mean is split into and the cumulative probabilities of a part."""
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.coalesce(F.char_length(text), F.lit(0))).alias("n_chars"))
    if weights is None:
        weighed = sizes.withColumn("w", F.lit(1.0))
    else:
        named = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, float(v))]) if weights else F.create_map().cast("map<string,double>")
        weighed = sizes.withColumn("w", F.coalesce(F.try_element_at(named, F.col("source").cast("string")), F.lit(0.0)))
    sums = weighed.agg(F.sum("w").alias("all_w"), (F.lit(float(total)) if total is not None else F.sum("n_chars").cast("double")).alias("want"))
    mean = F.when(F.col("w") <= 0, 0.0).when(F.col("n_chars") == 0, 1.0).otherwise(F.col("w") / F.col("all_w") * F.col("want") / F.col("n_chars"))
    # one row of sums beside a row per source
    parted = weighed.join(F.broadcast(sums)).withColumn("mean", mean).withColumn("parts", F.greatest(F.ceil(F.col("mean") / MOST_MEAN), F.lit(1)).cast("int"))
    return parted.withColumn("cdf", poisson_cdf(F.col("mean") / F.col("parts"))).select("source", "n_docs", "n_chars", "mean", "parts", "cdf")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None, seed: int = 17, doc_id: str = "doc_id", source: str = "source", text: str = "text", keep_keys: bool = False) -> DataFrame:
    """docs, each as often as drawn, in shuffled order. keep_keys: add ``copy`` (from 0) and ``shuffle_key``; else the columns of docs alone."""
    names = docs.columns
    cdf, parts, copy, key = fresh(names, "cdf"), fresh(names, "parts"), fresh(names, "copy"), fresh(names, "shuffle_key")
    part, draw = fresh(names, "mix_part"), fresh(names, "mix_draw")
    of, size = fresh(names, "mix_source"), fresh(names, "mix_docs")
    named = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    # sources of over a thousandth of the documents, a thousand rows at most, are joined where the documents lie
    means = cut_small(rates(docs, weights, total, source, text).select(F.col("source").alias(of), F.col("n_docs").alias(size), F.col("parts").alias(parts), F.col("cdf").alias(cdf)))
    least = (means.agg(F.sum(size)).first()[0] or 0) / MOST_BROADCAST
    marked = docs.join(F.broadcast(means.where(F.col(size) > least)), F.col(f"`{source}`").eqNullSafe(F.col(of)), "left")
    rest = marked.where(F.col(parts).isNull()).select(*[F.col(f"`{c}`") for c in names]).join(means.where(F.col(size) <= least), F.col(f"`{source}`").eqNullSafe(F.col(of)))
    joined = marked.where(F.col(parts).isNotNull()).unionByName(rest).drop(of, size)
    each = joined.withColumn(part, F.explode(F.sequence(F.lit(0), F.col(parts) - 1)))
    # the first part is drawn by the number that a mean of one part is inverted at
    drawn = F.when(F.col(part) == 0, uniform(seed, named)).otherwise(uniform(f"{seed}/part", named, F.col(part).cast("string")))
    count = F.size(F.filter(F.col(cdf), lambda c: c <= F.col(draw)))
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1))
    made = each.withColumn(draw, drawn).withColumn(copy, F.explode(numbers)).withColumn(copy, F.col(part).cast("long") * PART_COPIES + F.col(copy))
    copies = made.drop(cdf, parts, part, draw)
    keyed = copies.withColumn(key, F.md5(F.concat_ws(":", F.lit(f"{seed}/order"), named, F.col(copy).cast("string"))))
    # keys are spread evenly, so the bounds of a global sort are known without a sample, and texts move once
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionById(n, F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / float(1 << 32) * n).cast("int")).sortWithinPartitions(key)
    return ordered if keep_keys else ordered.drop(copy, key)
