"""How filters interact: what each would remove at each place of each order.

Every document has a set of filters that it fails, a number of 5 bits. Whatever the order of
the filters, it is removed at the first of them that it fails. A table of 32 sets by 120 orders holds that
first step. Documents are counted by part, label and set (``np.bincount``), each set looks its steps
up, and the counts are added by part, order and step (``np.bincount`` again). A task yields an
array of fixed size for each part that it saw; arrays are summed over tasks place by place.

Which documents fail is found first. A to D look at a text alone. E, an earlier document of equal text anywhere in the table,
compares each id with the least id of its text, known by its SHA-256; texts themselves don't move.

Null text counts as empty, null source as the empty part. A null id is not smaller than another and has no smaller one, so it
never fails E and has no label. Rows of one id and text don't fail E by each other. Several labels of an
id count as their greatest. An empty table gives an empty result. Columns other than id, source and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlens.llm.common import cut, in_chunks

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: The step (0 to 4) at which a set of failed filters ends a document in an order; 5: never.
FIRST = np.array([[next((s for s, f in enumerate(o) if mask >> FILTERS.index(f) & 1), 5) for o in ORDERS] for mask in range(32)])
#: The filter that stands at a step of an order.
FILTER_AT = np.array([[FILTERS.index(f) for f in o] for o in ORDERS])
#: Labels are bits, too: 1 good, 2 toxic. The three counts are of all documents, good ones and toxic ones.
LABELS = [np.ones(4, bool), np.array([0, 1, 0, 1], bool), np.array([0, 0, 1, 1], bool)]
STEPS = len(ORDERS) * 6
#: What a part's array holds: removals by label, order and step, and the number of documents by set.
SIZE = 3 * STEPS + 32
#: Parts whose arrays a task holds at once.
MOST_PARTS = 500
#: Texts with more than one in so many of the rows are joined by a broadcast of theirs, at most as many.
MOST_BROADCAST = 1000

UPPER = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"


def failed_alone(text: str) -> int:
    """The set of filters A to D that a text fails. Bytes are split at ASCII white space alone."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    upper = len(data) - len(data.translate(None, UPPER))
    marks = len(data) - len(data.translate(None, MARKS))
    return (len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * upper > 2 * len(text)) << 2 | (marks > 0) << 3


def flags(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """doc_id, part, mask (A to D) and digest of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in in_chunks(batches):
            masks = pa.array([failed_alone(t or "") for t in texts], pa.int32())
            digests = pa.array([hashlib.sha256((t or "").encode("utf-8", "surrogatepass")).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), masks, digests], names=["doc_id", "part", "mask", "digest"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("part"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def with_copies(rows: DataFrame) -> DataFrame:
    """part, mask with E, and doc_id: E where a smaller id has the digest. Only digests of several ids are joined; those of a thousandth of all rows or more by broadcast, so none gathers in one task."""
    texts = rows.groupBy("digest").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
    several = cut(texts.where("_first < _last").select("digest", "_first", "_n"))
    least = rows.count() / MOST_BROADCAST
    # at most MOST_BROADCAST rows have so many
    hot = F.broadcast(several.where(F.col("_n") > least).select("digest", F.col("_first").alias("_hot")))
    marked = rows.join(hot, "digest", "left")
    rest = marked.where("_hot is null").join(several.where(F.col("_n") <= least).select("digest", F.col("_first").alias("_rest")), "digest", "left")
    each = marked.where("_hot is not null").withColumn("_first", F.col("_hot")).select("doc_id", "part", "mask", "_first")
    every = each.unionByName(rest.select("doc_id", "part", "mask", F.col("_rest").alias("_first")))
    return every.select("doc_id", "part", (F.col("mask") + F.when(F.col("doc_id") > F.col("_first"), 16).otherwise(0)).alias("mask"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask and label bits. Rows without id, which no label can meet, are dealt over all tasks."""
    bits = F.max(F.when(F.col("quality") == 1, 1).otherwise(0)) + 2 * F.max(F.when(F.col("toxic") == 1, 1).otherwise(0))
    by_id = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(bits.cast("int").alias("label"))
    named = rows.where("doc_id is not null").join(by_id, "doc_id", "left").select("part", "mask", F.coalesce("label", F.lit(0)).alias("label"))
    return named.unionByName(rows.where("doc_id is null").select("part", "mask", F.lit(0).alias("label")))


def removals(counts: np.ndarray) -> np.ndarray:
    """The array of a part from its documents by label and set (4 by 32)."""
    out = np.zeros(SIZE, np.int64)
    mask = np.flatnonzero(counts.any(0))
    place = (np.arange(len(ORDERS)) * 6 + FIRST[mask]).ravel()
    for k, chosen in enumerate(LABELS):
        weight = np.repeat(counts[chosen][:, mask].sum(0), len(ORDERS))
        out[k * STEPS : (k + 1) * STEPS] = np.bincount(place, weight, STEPS)  # exact up to 2^53 documents
    out[3 * STEPS :] = counts.sum(0)
    return out


def partial_arrays(rows: DataFrame) -> DataFrame:
    """part and values, an array of SIZE, for each part that a task saw; a part may come again when a task has seen MOST_PARTS others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def told() -> pa.RecordBatch:
            values = [removals(c.reshape(4, 32)) for c in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(values, pa.list_(pa.int64()))], names=["part", "values"])

        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            cell = batch.column(2).to_numpy().astype(np.int64) * 32 + batch.column(1).to_numpy()
            names = coded.dictionary.to_pylist()
            for a in range(0, len(names), MOST_PARTS):
                at = coded.indices.to_numpy().astype(np.int64) - a
                mine = (at >= 0) & (at < MOST_PARTS)
                counted = np.bincount(at[mine] * 128 + cell[mine], minlength=128 * min(MOST_PARTS, len(names) - a)).reshape(-1, 128)
                for name, c in zip(names[a : a + MOST_PARTS], counted, strict=True):
                    held[name] = held[name] + c if name in held else c
                if len(held) >= MOST_PARTS:
                    yield told()
                    held.clear()
        if held:
            yield told()

    return rows.select("part", "mask", "label").mapInArrow(run, "part string, values array<long>")


def report(arrays: DataFrame) -> DataFrame:
    """600 rows for each part from its partial arrays, which are summed place by place."""
    placed = arrays.select("part", F.posexplode("values").alias("at", "v")).groupBy("part", "at").agg(F.sum("v").alias("v"))
    # SIZE numbers a part
    whole = placed.groupBy("part").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("values"))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in names)
    orders, steps = [o for o in ORDERS for _ in FILTERS], list(range(1, 6)) * len(ORDERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                v = values.values.to_numpy()
                removed, good, toxic = (v[k * STEPS : (k + 1) * STEPS].reshape(-1, 6)[:, :5] for k in range(3))
                sets = v[3 * STEPS :]
                fails = np.array([sets[np.arange(32) >> f & 1 == 1].sum() for f in range(5)])
                alone = sets[1 << np.arange(5)]
                shapley = np.bincount(FILTER_AT.ravel(), removed.ravel(), 5).astype(np.int64)
                columns = [sets.sum() - removed.cumsum(1), removed, fails[FILTER_AT] - removed, alone[FILTER_AT], good, toxic, shapley[FILTER_AT]]
                yield pa.RecordBatch.from_arrays([pa.array([part] * 600), pa.array(orders), pa.array(steps, pa.int32()), *[pa.array(c.ravel(), pa.int64()) for c in columns]], names=["part", "filter_order", "step", *names])

    return whole.mapInArrow(run, schema)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    rows = cut(flags(docs, id_col, source, text))  # narrow; read by three steps
    return report(partial_arrays(with_labels(with_copies(rows), labels)))
