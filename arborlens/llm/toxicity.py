"""Toxicity by cumulative-link ordinal regression over sparse text features.

P(grade <= k) = sigmoid(threshold_k - w . x): one weight vector for all the ordered
thresholds. x holds, for each term of a learnt vocabulary that the text has, 1; terms are words
and beginnings of words, so that unseen forms of a telling stem count. The expected severity is
sum_k P(grade > k), from 0 to the highest grade.

Grades are an expression over the labels that the caller gives; where labels only say yes or no,
``severity`` grades the yes rows by words that the other half of the rows taught. The model is
fitted on a bounded sample of labelled ids (``max_labelled``, those of least md5, so the same
ids on every run; rows of one id are one document) and is of bounded size (``max_terms``). Terms
are counted by Spark; the driver sees the chosen terms, and their numbers for each sampled id.

Null or empty texts have no terms; their severity is that of a text without any. Repeated
rows get equal results; an empty table gives an empty result; without labelled rows of two
grades nothing is toxic. Very long texts are scored whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborlens.llm.common import cut, cut_small, fresh, in_chunks

WORD = re.compile(r"[^\W\d_]+").findall
#: Letters of the beginnings of words that are terms beside the words.
STEMS = range(3, 9)
#: Words whose terms a scoring task remembers.
REMEMBERED = 50_000
#: Tasks that the sample's ids are dealt to.
SAMPLE_PARTS = 16


def terms(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return WORD((text or "").lower())


def features(word: str) -> list[str]:
    """The word, and its beginnings of STEMS letters with a hyphen, which no word has."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) >= n)]


@dataclass
class OrdinalModel:
    weights: dict[str, float]
    thresholds: np.ndarray
    known: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False, compare=False)

    def __post_init__(self) -> None:
        #: how the terms begin: most words have none of these beginnings and need no further look
        self.starts = {t.rstrip("-")[: STEMS[0]] for t in self.weights}

    def found(self, text: str | None) -> set[str]:
        """The terms of the model that the text has."""
        out: set[str] = set()
        for word in set(terms(text)):
            if word[: STEMS[0]] in self.starts:
                have = self.known.get(word)
                if have is None:
                    if len(self.known) >= REMEMBERED:
                        self.known.clear()
                    have = self.known[word] = tuple(t for t in features(word) if t in self.weights)
                out.update(have)
        return out

    def exceed(self, text: str | None) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        s = sum(self.weights[t] for t in sorted(self.found(text)))
        return 1 / (1 + np.exp(np.clip(self.thresholds - s, -50, 50)))


def sample(docs: DataFrame, labels: DataFrame, grade: Column, max_labelled: int, text: str = "text") -> DataFrame:
    """(doc_id, grade, term), distinct, the words of a bounded sample of labelled ids; an id without words has one row of a null term. The ids are drawn from the labels before their texts are looked up."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    few = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(grade).cast("int").alias("grade")).where("grade is not null").orderBy(key, "doc_id").limit(max_labelled)
    rows = docs.select("doc_id", F.col(f"`{text}`").alias("text")).join(F.broadcast(few), "doc_id").select("doc_id", "grade", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in in_chunks(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([list(set(terms(t))) for t in texts], pa.list_(pa.string()))], names=["doc_id", "grade", "terms"])

    made = cut(rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("grade", T.IntegerType()), T.StructField("terms", T.ArrayType(T.StringType()))])))
    each = made.select("doc_id", "grade", F.explode_outer("terms").alias("term"))
    # at most max_labelled ids
    again = made.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return each
    return each.join(F.broadcast(again), "doc_id", "left_anti").unionByName(each.join(F.broadcast(again), "doc_id", "left_semi").distinct())


def by_id(rows: DataFrame) -> DataFrame:
    """doc_id, h (its half), grade and words of each id of the sample; the words of an id are some thousands."""
    dealt = rows.repartition(SAMPLE_PARTS, "doc_id")  # a few MB, but much to count
    return dealt.groupBy("doc_id").agg(F.max("grade").alias("grade"), F.collect_list("term").alias("words")).select("doc_id", _half().cast("int").alias("h"), "grade", "words")


def _beginnings() -> Column:
    """The beginnings of the word in the column term, as features has them."""
    return F.transform(F.filter(F.array(*map(F.lit, STEMS)), lambda n: n <= F.char_length("term")), lambda n: F.concat(F.substring(F.col("term"), F.lit(1), n), F.lit("-")))


@dataclass
class Counted:
    """How often terms occur in toxic (a) and other (b) ids of either half of the sample, and how many of these ids there are."""

    terms: DataFrame  # term, a0, b0, a1, b1
    ids: dict[str, int]


def _half() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(2))


def count_terms(rows: DataFrame) -> Counted:
    """rows: see sample. A beginning of words that only one word or one longer beginning has is that one, and left out.

    Tasks count the terms of their ids, so what is shuffled is a row for each task and term.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for b in batches:
            for h, grade, words in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                at = 2 * h + (grade <= 0)
                for term in {f for w in words for f in features(w)}:
                    counts.setdefault(term, [0, 0, 0, 0])[at] += 1
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *[pa.array([c[k] for c in counts.values()], pa.int64()) for k in range(4)]], names=["term", *names])

    names = ["a0", "b0", "a1", "b1"]
    held = by_id(rows)
    counts = cut(held.mapInArrow(run, "term string, " + ", ".join(f"{n} long" for n in names)).groupBy("term").agg(*[F.sum(n).alias(n) for n in names]))
    split = [F.count_if((F.col("grade") > 0 if x == "a" else F.col("grade") <= 0) & (_half() == h)).alias(f"{x}{h}") for h in (0, 1) for x in "ab"]
    ids = rows.groupBy("doc_id").agg(F.max("grade").alias("grade")).agg(*split).first().asDict()
    stem = F.col("term").endswith("-")
    forms = counts.where(~stem).select(F.explode(_beginnings()).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("k"))
    longer = forms.select(F.concat(F.expr("substring(term, 1, length(term) - 2)"), F.lit("-")).alias("term"), F.col("k").alias("k2")).groupBy("term").agg(F.max("k2").alias("k2"))
    beginnings = forms.join(longer, "term", "left").where("k > 1 and k > coalesce(k2, 0)").select("term")
    return Counted(cut_small(counts.where(~stem).unionByName(counts.where(stem).join(beginnings, "term", "left_semi"))), ids)


def telling_terms(counted: Counted, max_terms: int, halves: tuple[int, ...] = (0, 1), false_share: float = 0.05) -> dict[str, bool]:
    """Terms that a grade over 0 depends on by the likelihood-ratio test over the halves, and whether they speak for it or against it.

    The least G squared is not fixed: of all terms tried, as many are kept as leave a share of
    false_share of false ones among the kept (Benjamini and Hochberg), max_terms at most.
    """
    a, b = (sum((F.col(f"{x}{h}") for h in halves), F.lit(0)) for x in "ab")
    n1, n0 = (sum(counted.ids[f"{x}{h}"] for h in halves) for x in "ab")
    if not n1 or not n0:
        return {}
    n = n1 + n0
    cell = lambda c, one, other: F.when(c > 0, c * F.log(c * F.lit(float(n)) / (F.lit(float(one)) * other))).otherwise(0.0)
    g2 = 2 * (cell(a, n1, a + b) + cell(b, n0, a + b) + cell(n1 - a, n1, n - a - b) + cell(n0 - b, n0, n - a - b))
    tried = counted.terms.where(a + b > 0)
    many = tried.count()
    best = tried.select("term", F.round(g2, 9).alias("g2"), (a * F.lit(n0) > b * F.lit(n1)).alias("for")).orderBy(F.desc("g2"), "term").limit(max_terms).collect()
    # the chance of a G squared or more, of one degree of freedom
    kept = [k for k, r in enumerate(best, 1) if math.erfc(math.sqrt(max(r["g2"], 0) / 2)) * many <= false_share * k]
    return {r["term"]: r["for"] for r in best[: max(kept, default=0)]}


def severity(rows: DataFrame, counted: Counted, max_terms: int = 4096) -> DataFrame:
    """rows of yes/no grades as rows of the grades 0, 1 and 2: of the toxic ids, those with more different telling words than the middle one are 2.

    The words that tell are chosen on the other half of the ids, so no id's grade rests on its own label.
    """
    tell = [(t, h) for h in (0, 1) for t, speaks_for in telling_terms(counted, max_terms, (1 - h,)).items() if speaks_for]
    toxic = rows.where("grade > 0")
    words = toxic.select("doc_id", _half().alias("h"), "term", F.explode(F.concat(F.array("term"), _beginnings())).alias("f"))
    # from Arrow: rows of a list would go through Python workers of another kind than mapInArrow's, which stay beside those
    telling = rows.sparkSession.createDataFrame(pa.table({"f": pa.array([t for t, _ in tell], pa.string()), "h": pa.array([h for _, h in tell], pa.int64())}))
    hits = words.join(F.broadcast(telling), ["f", "h"]).groupBy("doc_id").agg(F.count_distinct("term").alias("hits"))
    every = cut_small(toxic.select("doc_id").distinct().join(hits, "doc_id", "left").fillna(0, "hits"))
    middle = every.agg(F.percentile("hits", 0.5)).first()[0] or 0
    more = every.where(F.col("hits") > middle).select("doc_id", F.lit(2).alias("more"))
    return rows.join(F.broadcast(more), "doc_id", "left").withColumn("grade", F.coalesce("more", F.least("grade", F.lit(1)))).drop("more")  # max_labelled ids at most


def loss(w: np.ndarray, theta: np.ndarray, row: np.ndarray, col: np.ndarray, grades: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Penalised log likelihood of the grades, and its gradient by the weights and then the thresholds. Document row[i] has term col[i]."""
    n, k = len(grades), len(theta)
    s = np.bincount(row, w[col], n)
    c = np.concatenate([np.zeros((n, 1)), 1 / (1 + np.exp(-np.clip(theta[None, :] - s[:, None], -50, 50))), np.ones((n, 1))], axis=1)
    at = np.arange(n)
    p = np.maximum(c[at, grades + 1] - c[at, grades], 1e-12)
    d = c * (1 - c)
    up, low = d[at, grades + 1] / p, d[at, grades] / p
    by_w = np.bincount(col, (low - up)[row], len(w)) - l2 * w
    by_theta = np.array([up[grades == j].sum() - low[grades == j + 1].sum() for j in range(k)])
    return float(np.log(p).sum() - l2 / 2 * (w**2).sum()), np.concatenate([by_w, by_theta])


def fit(rows: DataFrame, max_terms: int = 4096, l2: float = 0.02, steps: int = 1500, both_ways: bool = False, yes_no: bool = False) -> OrdinalModel:
    """Maximum likelihood with a ridge penalty, by gradient ascent with running means of gradients and of their squares (Adam). rows: see sample; yes_no: their grades are, and severity is to refine them.

    Terms that speak against a grade are left out unless both_ways: most are common words of a
    language with few toxic labels, and would let its toxic texts pass.
    """
    counted = count_terms(rows)
    tell = [t for t, speaks_for in telling_terms(counted, max_terms).items() if speaks_for or both_ways]
    if not tell:
        return OrdinalModel({}, np.array([50.0]))
    index = {t: i for i, t in enumerate(tell)}

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [sorted({i for w in words for f in features(w) if (i := index.get(f)) is not None}) for words in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(at, pa.list_(pa.int32()))], names=["doc_id", "grade", "at"])

    graded = by_id(severity(rows, counted, max_terms) if yes_no else rows)
    # an id of at most max_terms numbers, and max_labelled ids
    held = sorted(graded.mapInArrow(chosen, T.StructType([graded.schema["doc_id"], T.StructField("grade", T.IntegerType()), T.StructField("at", T.ArrayType(T.IntegerType()))])).collect())
    grades = np.unique([r["grade"] for r in held], return_inverse=True)[1]
    k = int(grades.max())
    row, col = np.repeat(np.arange(len(held)), [len(r["at"]) for r in held]), np.array([i for r in held for i in r["at"]], int)
    w, theta = np.zeros(len(tell)), np.linspace(1, k, k)
    both = np.zeros((2, len(w) + k))
    for step in range(1, steps + 1):
        g = loss(w, theta, row, col, grades, l2)[1] / len(held)
        both = np.array([0.9 * both[0] + 0.1 * g, 0.999 * both[1] + 0.001 * g**2])
        move = 0.05 * both[0] / (1 - 0.9**step) / (np.sqrt(both[1] / (1 - 0.999**step)) + 1e-10)
        w += move[: len(w)]
        theta = np.maximum.accumulate(theta + move[len(w) :] + np.arange(k) * 1e-9)
    return OrdinalModel(dict(zip(tell, w.tolist(), strict=True)), theta)


def score(docs: DataFrame, model: OrdinalModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """docs with expected_severity (0 to the highest grade), severity_grade and toxic: P(grade > 0) is ``least`` or more.

    Names that clash with columns of docs get a leading underscore.
    """
    names = docs.columns
    new = [fresh(names, x) for x in ("expected_severity", "severity_grade", "toxic")]
    schema = T.StructType([*docs.schema.fields, T.StructField(new[0], T.DoubleType()), T.StructField(new[1], T.IntegerType()), T.StructField(new[2], T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in in_chunks(batches, text):
            p = np.array([model.exceed(x) for x in texts])
            columns = [pa.array(p.sum(axis=1)), pa.array((p >= 0.5).sum(axis=1).astype(np.int32)), pa.array(p[:, 0] >= least)]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=schema.names)

    return docs.mapInArrow(run, schema)
