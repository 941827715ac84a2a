"""Document fingerprints by SimHash, with DataFrame functions only.

Each white-space-separated term of a text has a 64-bit hash (xxhash64) and a weight that grows
with its length, so that the short function words of a language weigh little. A term votes for
each bit: its weight if the hash has the bit, minus its weight if not. The sign of the votes is
the fingerprint. Instead of 64 sums, 32 sums hold two bits each, in the two halves of a long:
(hash >> s) & 0x0000000100000001 times the weight. A half overflows at 2^31 units of weight,
that is texts of some 60 million long terms.

Search: fingerprints are cut into radius + d blocks. Two within the radius agree in at least d
blocks whole, so a table for each choice of d blocks, keyed by their bits, finds all pairs.
More blocks make longer keys, so d follows the number of fingerprints (``whole_blocks``).

Null text counts as empty; a text without terms has the fingerprint 0. Equal texts have equal
fingerprints, repeated rows equal results. Equal ids come in order of their texts.
"""

from __future__ import annotations

import json
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborlens.llm.common import fresh

BITS = 64
BLANKS = r"[\x20\x09-\x0D]+"
PAIR = 0x0000000100000001


def terms(text: Column) -> Column:
    return F.split(text, BLANKS, -1)


def vote_sums(term: Column, when: Column | None = None) -> list[Column]:
    """Aggregates whose sums hold the votes, two bits each, and the sum of all weights; 0 without terms."""
    h, n = F.xxhash64(term), F.least(F.char_length(term), F.lit(12))
    weight = F.when(term == "", 0).otherwise((n * n / 4).cast("int") + 1).cast("long")
    weight = weight if when is None else F.when(when, weight).otherwise(F.lit(0))
    return [F.sum(F.shiftrightunsigned(h, s).bitwiseAND(F.lit(PAIR)) * weight) for s in range(32)] + [F.sum(weight)]


def signs(sums: list[Column]) -> Column:
    """The fingerprint as a long: a bit is set if over half of the weight votes for it."""
    *votes, total = sums
    out = F.lit(0).cast("long")
    for s, v in enumerate(votes):
        low, high = v.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(v, 32)
        out = out.bitwiseOR(F.when(low * 2 > total, F.lit(1 << s).cast("long")).otherwise(F.lit(0).cast("long")))
        bit = (1 << (s + 32)) - (1 << 64 if s == 31 else 0)
        out = out.bitwiseOR(F.when(high * 2 > total, F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return F.coalesce(out, F.lit(0).cast("long"))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def fingerprints(docs: DataFrame, keys: list[str], texts: dict[str, Column]) -> DataFrame:
    """keys, which must tell rows apart, and a fingerprint for each named text; texts never move: only sums do."""
    parts = F.array(*[F.struct(F.lit(k).alias("k"), F.coalesce(t, F.lit("")).alias("t")) for k, t in enumerate(texts.values())])
    each = docs.select(*keys, F.explode(parts).alias("_p")).select(*keys, F.col("_p.k").alias("_k"), F.explode(terms(F.col("_p.t"))).alias("_t"))
    sums = [s.alias(f"_s{i}") for i, s in enumerate(vote_sums(F.col("_t")))]
    one = each.groupBy(*keys, "_k").agg(*sums).select(*keys, "_k", signs([F.col(f"_s{i}") for i in range(33)]).alias("_f"))
    return one.groupBy(*keys).agg(*[F.max(F.when(F.col("_k") == k, F.col("_f"))).alias(name) for k, name in enumerate(texts)])


def tables(radius: int, extra: int) -> list[int]:
    """Masks of the bits that key each table, for fingerprints cut into radius + extra blocks of which extra are whole."""
    n = radius + extra
    if not 0 <= radius < BITS or extra < 1 or n > BITS:
        raise ValueError("radius and extra must make between 1 and 64 blocks")
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, extra)]


def whole_blocks(n: int, radius: int = 3, per_key: int = 4) -> int:
    """The least d from 2 on whose keys of 64 d / (radius + d) bits leave at most per_key of n evenly spread fingerprints to a key."""
    return next((d for d in range(2, 7) if n <= per_key << (BITS * d // (radius + d))), 6)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def neighbours(queries: DataFrame, corpus: DataFrame, radius: int = 3, extra: int = 2, fp: str = "fp") -> DataFrame:
    """All pairs (query_fp, corpus_fp) of distinct fingerprints within the radius, the equal one included.

    Both sides are made distinct first, so copies count once however many there are.
    """
    masks = tables(radius, extra)
    keyed = lambda df, name: df.select(F.col(fp).alias(name)).where(F.col(name).isNotNull()).distinct().select(name, F.posexplode(F.array(*[F.col(name).bitwiseAND(F.lit(signed(m)).cast("long")) for m in masks])).alias("t", "key"))
    q, c = keyed(queries, "query_fp"), keyed(corpus, "corpus_fp")
    distance = F.bit_count(F.col("query_fp").bitwiseXOR(F.col("corpus_fp")))
    # a pair that several tables find is kept from the first of them
    xor = F.col("query_fp").bitwiseXOR(F.col("corpus_fp"))
    first = F.array_min(F.array(*[F.when(xor.bitwiseAND(F.lit(signed(m)).cast("long")) == 0, F.lit(t)) for t, m in enumerate(masks)]))
    # always shuffled: Spark takes the queries' size from before they are copied for each table, and would broadcast too much
    return q.join(c.hint("merge"), ["t", "key"]).where((distance <= radius) & (F.col("t") == first)).select("query_fp", "corpus_fp", distance.cast("int").alias("distance"))


def count_within(docs: DataFrame, fp: str, is_query: Column, radius: int = 3, extra: int = 2) -> DataFrame:
    """For each distinct fingerprint of the query rows (fp): n_within, the rows of docs within the radius, itself included."""
    sizes = docs.groupBy(F.col(fp).alias("corpus_fp")).agg(F.count(F.lit(1)).alias("n"))
    pairs = neighbours(docs.where(is_query), docs, radius, extra, fp)
    return pairs.join(sizes, "corpus_fp").groupBy(F.col("query_fp").alias(fp)).agg(F.sum("n").alias("n_within"))


#: Buckets of ids at most, in groups of GROUP; so many bounds reach the driver, and rows the small table that is broadcast.
MOST_BUCKETS, GROUP = 16_384, 128


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are up to the key: first the group of bounds, then the place in it."""
    groups = [bounds[i : i + GROUP] for i in range(0, len(bounds), GROUP)] or [[]]
    listed = lambda x, kind: F.from_json(F.lit(json.dumps(x)), kind)  # noqa: E731  one literal, however long
    upto = lambda a: F.size(F.filter(a, lambda b: b <= key))
    group = upto(listed([g[0] for g in groups[1:]], "array<bigint>"))
    return F.get(F.transform(F.array(group), lambda g: g * GROUP + upto(F.get(listed(groups, "array<array<bigint>>"), g))), F.lit(0)).cast("long")


def in_id_order(docs: DataFrame, id_col: str, bucket: str, look: str, rows_per_bucket: int = 256) -> tuple[DataFrame, list[Column]]:
    """docs dealt by buckets of ids, with columns bucket and look, and the order of rows in a bucket.

    Ids (longs) are cut into at most MOST_BUCKETS buckets by their quantiles, so no task sees all
    rows, however unevenly ids are spread. The first row by descending id of each bucket is also dealt to the
    bucket before it (that of the highest bucket to the lowest), marked look: so within a bucket a
    window finds every row's next one, after the last the first. Null ids come last; rows of
    one id share a bucket.
    """
    taken = docs.columns
    key, top, to, place = (fresh(taken, x) for x in ("_key", "_top", "_to", "_place"))
    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)).cast("long"))
    n = min(MOST_BUCKETS, max(1, docs.count() // rows_per_bucket))
    shares = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx(ids, F.from_json(F.lit(json.dumps(shares)), "array<double>"), F.lit(10 * n)).alias("b")).first()["b"] if shares else []
    put = docs.withColumn(key, ids).withColumn(bucket, bucket_of(F.col(key), sorted(set(found or []))))
    tops = put.groupBy(bucket).agg(F.max(key).alias(top))
    down = Window.orderBy(F.col(bucket).desc())  # over a row per bucket
    wrap = F.coalesce(F.lag(bucket).over(down), F.min(bucket).over(Window.partitionBy(F.lit(0))))
    # at most MOST_BUCKETS rows of two longs
    both = put.join(F.broadcast(tops.select(F.col(top), wrap.alias(to))), F.col(key) == F.col(top), "left")
    one = lambda b, x: F.struct(F.col(b).alias("b"), F.lit(x).alias("l"))
    places = F.when(F.col(to).isNull(), F.array(one(bucket, False))).otherwise(F.array(one(bucket, False), one(to, True)))
    dealt = both.withColumn(place, F.explode(places)).withColumn(bucket, F.col(f"{place}.b")).withColumn(look, F.col(f"{place}.l")).drop(top, to, place)
    return dealt.select(*taken, bucket, look, key), [F.col(look), F.col(key).desc()]


def edited(text: Column, following: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the first as many, or all, of the following text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def sensitivity(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fp and edited_fp (longs) of the text and of its edited text, next_fp of the next row by descending id.

    Rows of one id are ordered by text. The texts are shuffled once. An empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    dealt, place = in_id_order(rows, "doc_id", "_bucket", "_look")
    w = Window.partitionBy("_bucket").orderBy(*place, "text")
    paired = dealt.withColumn("_next", F.lead("text").over(w)).withColumn("_n", F.row_number().over(w))
    own = paired.withColumn("_edited", F.when(~F.col("_look"), edited(F.col("text"), F.coalesce("_next", F.lit("")))))
    keyed = own.select("_bucket", "_look", "_n", "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"), "text", "_edited")
    made = fingerprints(keyed, ["_bucket", "_look", "_n", "doc_id", "n_chars", "edited_sha256"], {"fp": F.col("text"), "edited_fp": F.col("_edited")})
    following = F.lead("fp").over(Window.partitionBy("_bucket").orderBy("_n"))
    return made.withColumn("next_fp", following).where(~F.col("_look")).drop("_bucket", "_look", "_n")
