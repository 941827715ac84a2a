"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that are worked on at once, in characters of text.
CHUNK_CHARS = 1_000_000
#: Bytes of an Arrow batch that goes to Python, about. By Spark's own bounds, 10,000 rows and 64 MB, a batch of texts or tokens is tens of MB in the executor and again in its worker.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by BATCH_BYTES; all rows still go, in more batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the cluster's shared checkpoint folder; set one only where none is named (tests, one machine)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a shared folder")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="arborlens-checkpoint-"))


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder's path in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there: cuts lineage, survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    # what led to df is garbage by now; collecting it lets Spark delete its shuffle files during a long run, not only at the end
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


#: Rows of a partition of intermediate tables that are keys, pairs or edges.
SMALL_ROWS = 50_000


def cut_small(df: DataFrame) -> DataFrame:
    """cut() for tables of narrow rows, in partitions of some SMALL_ROWS, so that the next shuffle writes no more files than its rows need."""
    out = cut(df)
    return out.coalesce(max(1, -(-out.count() // SMALL_ROWS)))


def fresh(taken: Iterable[str], name: str) -> str:
    """A column name that clashes with none of those taken (Spark ignores case)."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def in_chunks(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list]]:
    """Arrow batches in slices of about CHUNK_CHARS characters, with the texts as Python strings (None: null)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if not len(column):
            continue
        sizes = np.nan_to_num(np.asarray(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=float))
        step = np.cumsum(sizes) // CHUNK_CHARS
        edges = [0, *(np.flatnonzero(np.diff(step)) + 1), len(column)]
        for a, b in zip(edges, edges[1:], strict=False):
            part = batch.slice(a, b - a)
            yield part, part.column(part.schema.get_field_index(text)).to_pylist()


BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: A random 64-bit number for each byte, 0 for blanks, and powers of a random odd number.
BYTE = np.random.default_rng(20).integers(1, 2**64, 256, dtype=np.uint64)
BYTE[BLANK] = 0
POWER = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(65_535, 0xD1342543DE82EF95, np.uint64)]))
NEXT_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of data, runs of bytes other than the ASCII blanks, and the words' first places.

    A word's hash is the mixed sum of its bytes' numbers times powers by place, worked out for
    all words at once, in pieces that end between words.
    """
    hashes, places, i = [], [], 0
    while i < len(data):
        j = i + CHUNK_CHARS // 2
        if j < len(data):
            found = NEXT_BLANK.search(data, j)
            j = found.start() if found else len(data)
        b = np.frombuffer(data, np.uint8, min(j, len(data)) - i, i)
        word = ~BLANK[b]
        edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
        first, size = edge[::2], edge[1::2] - edge[::2]
        if len(first):
            off = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            value = BYTE[b[word]] * POWER[off & 65_535]
            if size.max() > 65_536:
                value *= (2 * (off >> 16) + 1).astype(np.uint64)
            hashes.append(mix(np.add.reduceat(value, np.cumsum(size) - size) + size.astype(np.uint64)))
            places.append(first + i)
        i = j
    return (np.concatenate(hashes), np.concatenate(places)) if hashes else (np.empty(0, np.uint64), np.empty(0, np.int64))


def hashes_by_text(texts: list[str | None], fold: bool = False) -> list[np.ndarray]:
    """The word hashes of each text; fold: of its form with A-Z in lower case."""
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(coded)
    hashes, places = word_hashes(data.lower() if fold else data)  # of bytes, lower() changes A-Z alone
    ends = np.cumsum([len(c) + 1 for c in coded])
    at = np.searchsorted(places, ends)
    return [hashes[a:b] for a, b in zip([0, *at.tolist()], at.tolist(), strict=False)]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of n words, given the words' hashes; empty for fewer than n."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    mixed, total = mix(words), np.zeros(m, np.uint64)
    # a random odd multiplier for each place: no two sums over subsets of them are equal
    for k, odd in enumerate(np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)):
        total += mixed[k : k + m] * odd
    return mix(total)


def uniform(*parts: object) -> object:
    """A number in [0, 1) from the md5 of the parts, as 52 bits; the same in any SQL engine."""
    key = F.md5(F.concat_ws(":", *[p if hasattr(p, "_jc") else F.lit(str(p)) for p in parts]))
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
