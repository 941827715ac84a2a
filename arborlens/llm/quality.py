"""Quality: rule statistics of each text, base rules, and an isolation forest over them.

The splits of the forest are random and don't look at rows; it is fitted by counting, in tasks, how many rows come
to each leaf, so half of all ids labelled good take part (the other half is kept apart), and junk, which may be common, doesn't look usual.
Unusual rows end in short paths; the score is 2^(-mean path / expected path), from 0 to 1, rounded to DIGITS. The
threshold comes from all good ids of the other half and all bad ones that pass the base
rules, by their exact counts at each score: the least score that loses at most ``max_loss`` of the good, raised half the way to the
next bad one; without good rows it is 1, so nothing is dropped by the forest.

Null text has no words. Texts without words fail the base rules (fewer than 10 words).
Repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborlens.llm.common import cut, fresh, hashes_by_text, in_chunks, window_hashes

SYMBOLS = re.compile(r"[#*$%&|<>]")
WORD_IN = re.compile(r"[^\x20\x09-\x0D]")
SPACES = " \t\n\v\f\r"
#: The statistics that the base rules and the forest see, in order.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5


def repeated_words(words: np.ndarray) -> int:
    """Words in windows of 5 that occur twice or more, given the words' hashes."""
    windows = window_hashes(words, WINDOW)
    if len(windows) < 2 or not (np.diff(np.sort(windows)) == 0).any():
        return 0
    _, back, count = np.unique(windows, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[back] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    cover[at] += 1
    cover[at + WINDOW] -= 1
    return int((np.cumsum(cover) > 0).sum())


def statistics(texts: list[str | None]) -> np.ndarray:
    """The numbers named in BASE, a row for each whole text."""
    rows = []
    for text, words in zip(texts, hashes_by_text(texts), strict=True):
        text = text or ""
        lines = [x for x in text.split("\n") if WORD_IN.search(x)]
        letters = len(text) - sum(map(text.count, SPACES))
        rows.append((len(words), letters, len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated_words(words)))
    return np.array(rows, np.int64).reshape(-1, len(BASE))


def base_failed(s: np.ndarray) -> np.ndarray:
    return (s[:, 0] < 10) | (100 * s[:, 4] > 20 * s[:, 0])


#: Characters of a word on average that count as 1.
LONG_WORD = 20


def features(s: np.ndarray) -> np.ndarray:
    """What the forest splits on, each from 0 to 1: symbols a word, repeated lines and repeated words as shares of the words, and the mean length of words."""
    n = np.maximum(s[:, 0], 1).astype(float)
    return np.minimum(np.column_stack([s[:, 2] / n, s[:, 3] / n, s[:, 4] / n, s[:, 1] / n / LONG_WORD]), 1.0)


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n keys in a random binary tree."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


#: Digits of a score, so that its counts have a bounded number of rows; splits a path has at most.
DIGITS, DEPTH = 5, 10


@dataclass
class IsolationForest:
    """Trees as arrays: the split column (-1: a leaf), its value, the left child (the right one follows), and the path length at a leaf."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    size: int
    threshold: float = 1.0

    @classmethod
    def unfitted(cls, columns: int, trees: int = 100, seed: int = 7) -> IsolationForest:
        """Random splits of the unit box down to DEPTH, not of the range that the rows at hand have: rows unlike all of them end in empty boxes after few splits, even in a column where these are all alike."""
        rng, inner, n = np.random.default_rng(seed), (1 << DEPTH) - 1, (2 << DEPTH) - 1
        made = []
        for _ in range(trees):
            column, value = np.full(n, -1), np.zeros(n)
            low, high = np.zeros((n, columns)), np.ones((n, columns))
            column[:inner] = rng.integers(columns, size=inner)
            share = rng.uniform(size=inner)
            for k, c in enumerate(column[:inner].tolist()):
                value[k] = low[k, c] + share[k] * (high[k, c] - low[k, c])
                low[2 * k + 1 : 2 * k + 3], high[2 * k + 1 : 2 * k + 3] = low[k], high[k]
                high[2 * k + 1, c] = low[2 * k + 2, c] = value[k]
            made.append((column, value, np.append(2 * np.arange(inner) + 1, np.zeros(n - inner, np.int64)), np.zeros(n)))
        return cls(made, 0)

    def counts(self, x: np.ndarray) -> np.ndarray:
        """How many of the rows come to each leaf of each tree. Counts of parts add up to those of the whole."""
        out = np.zeros((len(self.trees), 1 << DEPTH), np.int64)
        every = np.arange(len(x))
        for k, (column, value, _, _) in enumerate(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[every, column[node]] > value[node])
            out[k] = np.bincount(node - (1 << DEPTH) + 1, minlength=1 << DEPTH)
        return out

    def fitted(self, counts: np.ndarray) -> IsolationForest:
        """The forest of the rows with these counts: a node that no two rows reach is a leaf."""
        made = []
        for (column, value, child, _), at in zip(self.trees, counts, strict=True):
            levels = [at]
            while len(levels[0]) > 1:
                levels.insert(0, levels[0].reshape(-1, 2).sum(1))
            rows = np.concatenate(levels)
            depth = np.repeat(np.arange(DEPTH + 1), [len(x) for x in levels])
            made.append((np.where(rows > 1, column, -1), value, child, depth + expected_path(rows)))
        size = int(counts[0].sum()) if len(counts) else 0
        return IsolationForest(made if size else [], size)

    @classmethod
    def grow(cls, x: np.ndarray, trees: int = 100, seed: int = 7) -> IsolationForest:
        shape = cls.unfitted(x.shape[1], trees, seed)
        return shape.fitted(shape.counts(x))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.zeros(len(x))
        total = np.zeros(len(x))
        for column, value, child, path in self.trees:
            node = np.zeros(len(x), np.int64)
            while (inner := column[node] >= 0).any():
                at = node[inner]
                node[inner] = child[at] + (x[inner, column[at]] > value[at])
            total += path[node]
        return np.round(2.0 ** -(total / len(self.trees) / max(float(expected_path(self.size)), 1e-9)), DIGITS)

    def calibrate(self, good: np.ndarray, bad: np.ndarray, max_loss: float) -> IsolationForest:
        """Set the threshold from labelled rows: the least that loses at most max_loss of the good ones, raised half the way to the first bad one above it, so that no bad row that it finds is lost."""
        values, at = np.unique(np.concatenate([self.score(good), self.score(bad)]), return_inverse=True)
        return self.calibrate_counts(values, *(np.bincount(x, minlength=len(values)) for x in (at[: len(good)], at[len(good) :])), max_loss)

    def calibrate_counts(self, values: np.ndarray, good: np.ndarray, bad: np.ndarray, max_loss: float) -> IsolationForest:
        """The same from ascending scores and how many good and bad rows have each."""
        if n := int(good.sum()):
            least = float(values[np.searchsorted(np.cumsum(good), n - int(max_loss * n))])
            above = values[(bad > 0) & (values > least)]
            self.threshold = (least + float(above[0])) / 2 if len(above) else least
        return self


def with_statistics(docs: DataFrame, text: str = "text", forest: IsolationForest | None = None) -> DataFrame:
    """docs with the statistics of BASE and base_failed; with a forest also anomaly and kept. Names that clash get a leading underscore."""
    names = docs.columns
    new = [*BASE, "base_failed", *(("anomaly", "kept") if forest else ())]
    kinds = [T.LongType()] * 5 + [T.BooleanType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(fresh(names, n), k) for n, k in zip(new, kinds, strict=False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in in_chunks(batches, text):
            s = statistics(texts)
            failed = base_failed(s)
            columns = [*(pa.array(s[:, i]) for i in range(5)), pa.array(failed)]
            if forest:
                a = forest.score(features(s))
                columns += [pa.array(a), pa.array(~failed & (a <= forest.threshold))]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=schema.names)

    return docs.mapInArrow(run, schema)


def judged(stats: DataFrame, forest: IsolationForest) -> DataFrame:
    """Rows of with_statistics (without clashing names) with anomaly and kept."""
    schema = T.StructType([*stats.schema.fields, T.StructField("anomaly", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = forest.score(features(_numbers(batch)))
            kept = ~batch.column(batch.schema.get_field_index("base_failed")).to_numpy(zero_copy_only=False) & (a <= forest.threshold)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(a), pa.array(kept)], names=schema.names)

    return stats.mapInArrow(run, schema)


def _numbers(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(batch.schema.get_field_index(n)).to_numpy() for n in BASE])


def _leaf_counts(rows: DataFrame, shape: IsolationForest) -> np.ndarray:
    """Counts of all rows, added up over tasks."""
    leaves = len(shape.trees) << DEPTH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(leaves, np.int64)
        for batch in batches:
            total += shape.counts(features(_numbers(batch))).ravel()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["place", "n"])

    # a row for each leaf of the forest at most
    found = rows.select(*BASE).mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(leaves, np.int64)
    out[found.place.to_numpy(np.int64)] = found.n.to_numpy(np.int64)
    return out.reshape(len(shape.trees), -1)


def fit_statistics(stats: DataFrame, labels: DataFrame, max_loss: float = 0.005) -> IsolationForest:
    """A forest of rows of doc_id, base_failed and the statistics, of those that pass the base rules: grown on the ids labelled good (quality over 0) whose crc32 is even, and calibrated on
    the other good ones and all labelled bad; without good ones it is grown on all ids and drops nothing. Of the rows of one id the one with the least statistics counts."""
    named = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max("quality") > 0).alias("good"))
    least = lambda rows, *more: rows.groupBy("doc_id", *more).agg(F.min(F.struct("base_failed", *BASE)).alias("s")).select("doc_id", *more, "s.*").where("not base_failed")
    rows = cut(least(stats.join(named.hint("merge"), "doc_id"), "good"))
    grown = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    shape = IsolationForest.unfitted(features(np.zeros((1, len(BASE)), np.int64)).shape[1])
    if rows.where("good").isEmpty():
        return shape.fitted(_leaf_counts(least(stats.where("doc_id is not null")), shape))
    forest = shape.fitted(_leaf_counts(rows.where(F.col("good") & grown), shape))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(forest.score(features(_numbers(batch))))], names=["good", "score"])

    scored = rows.where(~(F.col("good") & grown)).select("good", *BASE).mapInArrow(run, "good boolean, score double")
    # a row for each score of DIGITS digits at most
    found = scored.groupBy("score").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).toPandas().sort_values("score")
    return forest.calibrate_counts(*(found[n].to_numpy() for n in ("score", "good", "bad")), max_loss)


def fit(docs: DataFrame, labels: DataFrame, max_loss: float = 0.005) -> IsolationForest:
    """fit_statistics of doc_id and text."""
    return fit_statistics(cut(with_statistics(docs.select("doc_id", "text")).drop("text")), labels, max_loss)
