"""Language identification by prediction by partial matching (PPM).

Per language a variable-order context tree over bytes: for each context of up to ``order``
bytes the counts of the bytes that followed. The probability of a byte in the longest known
context is its count over (all counts + distinct bytes); what is left over is the escape to
the next shorter context (method C, without exclusion), down to a uniform guess over 256
bytes. With frozen statistics a byte's code length depends on the bytes before it alone, so
each context becomes a row of code lengths, and a text's exact code length is a sum of table
entries. The language with the shortest code wins; equal lengths go to the first name.

Statistics are gathered by Spark over a bounded training text per language: documents of least
md5 of the id until ``max_bytes``, the last of them cut between two code points, and
less of each if there are so many languages that all would have over ``max_total``. No language goes,
however few documents hold it. Texts that are null or have no letter are ``und`` with score 0, and so
is everything when no language can be learnt. All 256 bytes count; those that a language's training
never showed have equal code lengths in it. Very long texts are scored whole, in pieces of bounded memory.
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

from arborlens.llm.common import fresh, in_chunks

UND = "und"
LETTER = re.compile(r"[^\W\d_]")
#: Bytes scored at once.
PIECE = 2_000_000


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m.group().isalpha() for m in LETTER.finditer(text))


@dataclass
class Language:
    """One language's tables. A byte's symbol is its rank among those that training showed; 0 stands for
    every other byte, which is exact: all of these have the same code length after any context."""

    symbol: np.ndarray  # byte -> symbol
    size: int  # symbols
    short: np.ndarray  # context of order - 1 -> row of its longest known suffix
    first: np.ndarray  # context of order - 1 -> its number among the known ones, from 1; 0: unknown
    last: np.ndarray  # that number x the next symbol -> row of the longest known suffix of both
    bits: np.ndarray  # row x symbol -> code length in bits

    @classmethod
    def train(cls, data: bytes, order: int) -> Language:
        raw = np.frombuffer(data, np.uint8)
        used = np.unique(raw)
        symbol = np.zeros(256, np.int64)
        symbol[used] = np.arange(1, len(used) + 1)
        s, a = symbol[raw], len(used) + 1
        rows = np.full((1, a), 1 / 256)
        # short and then longest: context of the order at hand -> row of its longest known suffix, the empty one included
        short = np.zeros(1, np.int64)
        first, last = np.zeros(1, np.int64), np.zeros((2, a), np.int64)
        for o in range(order + 1):
            keys, nxt = np.zeros(max(len(s) - o, 0), np.int64), s[o:]
            for k in range(o if len(nxt) else 0):
                keys = keys * a + s[k : len(s) - o + k]
            seen, back = np.unique(keys, return_inverse=True)
            # the parent of a context is what is left without its first symbol
            parent = short[seen % a ** max(o - 1, 0)]
            counts = np.zeros((len(seen), a))
            np.add.at(counts, (back, nxt), 1)
            total, distinct = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
            own = np.where(counts > 0, counts / np.maximum(total + distinct, 1), distinct / np.maximum(total + distinct, 1) * rows[parent])
            at = len(rows) + np.arange(len(seen))
            rows = np.concatenate([rows, own])
            if o < order:
                wide = short[np.arange(a**o) % a ** max(o - 1, 0)]
                wide[seen] = at
                short = wide
            else:
                known = np.unique(seen // a) if o else np.zeros(1, np.int64)
                first = np.zeros(a ** max(o - 1, 0), np.int64)
                first[known] = np.arange(1, len(known) + 1)
                # without the whole context, the suffix of order - 1: the context's end and the next symbol
                last = np.concatenate([np.zeros((1, a), np.int64), short[(known[:, None] * a + np.arange(a)) % a ** max(o - 1, 0)]]) if o else np.tile(at[:1] if len(at) else 0, (2, a))
                last[first[seen // a], seen % a] = at
        return cls(symbol, a, short.astype(np.int32), first.astype(np.int32), last.astype(np.int32), (-np.log2(rows)).astype(np.float32))

    def length(self, s: np.ndarray, order: int) -> float:
        """Code length of the symbols after the first ``order``, which are context."""
        a, n = self.size, len(s) - order
        head = np.zeros(n, np.int64)
        for k in range(order - 1):
            head = head * a + s[k : n + k]
        end = s[order - 1 : order - 1 + n] if order else np.zeros(n, np.int64)
        number = self.first[head]
        row = self.last[number, end]
        lost = np.flatnonzero(number == 0)
        if order and len(lost):
            row[lost] = self.short[(head[lost] * a + end[lost]) % a ** max(order - 1, 0)]
        return float(self.bits[row, s[order:]].sum(dtype=np.float64))


@dataclass
class PpmTables:
    languages: list[str]
    order: int
    tables: list[Language]

    @classmethod
    def train(cls, texts: dict[str, bytes], order: int = 3) -> PpmTables:
        """texts: the training bytes of each language."""
        languages = sorted(texts)
        return cls(languages, order, [Language.train(texts[x], order) for x in languages])

    def lengths(self, data: bytes) -> np.ndarray:
        """Code length of the bytes in each language, in bits. The first ``order`` bytes are given the context of unseen bytes."""
        total, o = np.zeros(len(self.languages)), self.order
        for start in range(0, len(data), PIECE):
            raw = np.frombuffer(data[max(0, start - o) : start + PIECE], np.uint8)
            for j, table in enumerate(self.tables):
                s = table.symbol[raw]
                total[j] += table.length(np.concatenate([np.zeros(o - start, np.int64), s]) if start < o else s, o)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language, and its share of 2^(-code length) over all languages."""
        if not self.languages or not has_letter(text):
            return UND, 0.0
        bits = self.lengths(text.encode("utf-8", "surrogatepass"))
        best = int(bits.argmin())
        return self.languages[best], float(1 / np.exp2(np.clip(bits[best] - bits, -1000, 0)).sum())


def training_texts(docs: DataFrame, keep: object, max_bytes: int, max_total: int = 2_000_000) -> dict[str, bytes]:
    """Of each language the documents of least md5 of the id, until max_bytes, where the last is cut; the rows are chosen by sizes before any text moves.

    The md5 is a number in [0, 1). Bytes are summed by its powers of two, and of each language
    the least powers that hold max_bytes are kept, or all: a language never goes, however few
    documents hold it, and no language's rows meet in one task however many there are. A row that
    is chosen brings max_bytes code points at most to the driver, one row at a time.
    """
    rows = docs.select("doc_id", "lang", "text").where(keep & F.col("lang").isNotNull() & F.col("text").isNotNull())
    u = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double") / float(2**52)
    power = F.when(u > 0, F.least(F.floor(-F.log2(u)), F.lit(52))).otherwise(52).cast("int")
    # a row per language and power
    sizes = rows.groupBy("lang", power.alias("power")).agg(F.sum(F.octet_length("text")).alias("size")).collect()
    max_bytes = max(1, min(max_bytes, max_total // max(len({r["lang"] for r in sizes}), 1)))
    least: dict[str, int] = {}
    held: dict[str, int] = {}
    for r in sorted(sizes, key=lambda r: -r["power"]):
        if held.get(r["lang"], 0) < max_bytes:
            least[r["lang"]] = r["power"]
            held[r["lang"]] = held.get(r["lang"], 0) + r["size"]
    if not least:
        return {}
    limit = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])[F.col("lang")]
    chosen = rows.where(power >= limit).select("lang", u.alias("u"), "doc_id", F.substring("text", 1, max_bytes).alias("text"))
    texts: dict[str, list[bytes]] = {x: [] for x in least}
    left = dict.fromkeys(least, max_bytes)
    for r in chosen.orderBy("u", "doc_id", "text").toLocalIterator():
        if left[r["lang"]] > 0:
            data = r["text"].encode("utf-8", "surrogatepass")
            whole = len(data) <= left[r["lang"]]
            texts[r["lang"]].append(data if whole else data[: left[r["lang"]]].decode("utf-8", "ignore").encode())
            left[r["lang"]] -= len(data)
        elif not any(v > 0 for v in left.values()):
            break
    return {x: b"\n".join(t) for x, t in texts.items() if t}


def predict(docs: DataFrame, tables: PpmTables, text: str = "text") -> DataFrame:
    """docs with lang_pred and score; names that clash get a leading underscore."""
    names = [fresh(docs.columns, x) for x in ("lang_pred", "score")]
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(tables)  # its size is bounded by max_total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for part, texts in in_chunks(batches, text):
            got = [model.predict(x) for x in texts]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)
