"""Token ids in length-delimited binary records, with a separate index of offsets.

A set of files is a folder:

- ``part-<number>-<attempt>.rec``: records one after another. A record is the length of its payload (unsigned 64 bits),
  the masked CRC-32 of those eight bytes, the payload, and the masked CRC-32 of the payload. All
  numbers are little-endian. A mask turns the checksum right by 15 bits and adds a constant, so that
  checksums of data that hold checksums keep their worth. The payload is a document's ids, 2 bytes each
  where the vocabulary allows it, else 4.
- ``part-<number>-<attempt>.idx``: an entry of INDEX for each record: its document's id, the place of the record
  in the file, its ids, and the ids of the file before it.
- ``manifest.json``: bytes of an id, and for each part, in order, its files, records and ids, and the ids before it.

Files are written by tasks (``spark.write.format("token_records")``), each attempt under a name of its own; the manifest,
which is written when all have ended, names those of the attempts that counted, so a retried task or a
lost executor leaves no record twice. The folder must be one that all executors see, by any path that
pyarrow's file systems open.

The index makes any order of reading cheap. ``read`` goes through the records in their order, in pieces of
some megabytes. ``read(seed=...)`` gives a permutation of all records without a shuffle: each task reads its share of
places of the permutation, looking each record up in the index.

Null ids of documents come first; rows of one id are ordered by the hash of their text, and equal rows next to each other, in any order.
Null text has no ids but the end id. An empty table makes a manifest without parts and reads as no rows. Columns
other than id and text are not looked at. A record whose length or payload doesn't match its checksum
raises an error that names it.
"""

from __future__ import annotations

import json
import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from arborlens.llm.bpe import model_of
from arborlens.llm.common import in_chunks

FORMAT = "token_records"
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("offset", "<u8"), ("tokens", "<u8"), ("start", "<u8")])
#: Fixed values of the mask.
TURN, ADDED = 15, 0xA282EAD8
#: Bytes around a payload.
FRAME = 16
#: Bytes of records that one task reads, about; and text that one part holds.
PIECE_BYTES, PART_BYTES = 32 << 20, 64 << 20
#: What a reader can be asked for.
SCHEMA = "record long, doc_id long, start long, n_tokens long, ids_crc32 long, token_ids array<int>"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> TURN | crc << (32 - TURN)) + ADDED) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return b"".join((length, masked(length).to_bytes(4, "little"), payload, masked(payload).to_bytes(4, "little")))


def payload_of(data: bytes | memoryview, at: int, name: str) -> memoryview:
    """The payload of the record that begins there, checked against both its checksums."""
    length = bytes(data[at : at + 8])
    if masked(length) != int.from_bytes(data[at + 8 : at + 12], "little"):
        raise ValueError(f"{name}: length of the record at {at} is damaged")
    end = at + 12 + int.from_bytes(length, "little")
    payload = data[at + 12 : end]
    if end + 4 > len(data) or masked(payload) != int.from_bytes(data[end : end + 4], "little"):
        raise ValueError(f"{name}: payload of the record at {at} is damaged")
    return payload


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str
    records: int
    tokens: int


class RecordWriter(DataSourceArrowWriter):
    """Writes rows (doc_id long, ids binary), in the order in which a task gets them; parts are ordered by partition."""

    def __init__(self, path: str, width: int):
        self.path, self.width = path, width

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = opened(self.path)
        part = TaskContext.get().partitionId()
        name, at, tokens, records = f"part-{part:08d}-{uuid.uuid4().hex}", 0, 0, 0
        data = index = None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if data is None:
                    data, index = store.open_output_stream(f"{folder}/{name}.rec"), store.open_output_stream(f"{folder}/{name}.idx")
                ids = batch.column(batch.schema.get_field_index("doc_id"))
                payloads = batch.column(batch.schema.get_field_index("ids")).to_pylist()
                sizes = np.fromiter((len(p) for p in payloads), np.int64, len(payloads))
                entries = np.zeros(len(payloads), INDEX)
                entries["has_id"] = ids.is_valid().to_numpy(zero_copy_only=False)
                entries["doc_id"] = ids.fill_null(0).to_numpy()
                entries["tokens"] = sizes // self.width
                entries["start"] = tokens + np.cumsum(sizes // self.width) - sizes // self.width
                entries["offset"] = at + np.cumsum(sizes + FRAME) - sizes - FRAME
                for p in payloads:
                    data.write(frame(p))
                index.write(entries.tobytes())
                at, tokens, records = at + int((sizes + FRAME).sum()), tokens + int(sizes.sum()) // self.width, records + len(payloads)
        finally:
            for f in (data, index):
                if f is not None:
                    f.close()
        return Written(part, name, records, tokens)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = opened(self.path)
        parts, start = [], 0
        for m in sorted((m for m in messages if m is not None and m.records), key=lambda m: m.part):
            parts.append({"name": m.name, "records": m.records, "tokens": m.tokens, "start": start})
            start += m.tokens
        with store.open_output_stream(f"{folder}/manifest.json") as f:
            f.write(json.dumps({"width": self.width, "parts": parts}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = opened(self.path)
        for m in messages:
            for kind in ("rec", "idx") if m is not None and m.records else ():
                store.delete_file(f"{folder}/{m.name}.{kind}")


@dataclass
class Piece(InputPartition):
    """Records first to last - 1, counted over all parts; with a seed, places of the permutation."""

    first: int
    last: int


class RecordReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, seed: int | None, piece_bytes: int):
        self.path, self.names, self.seed, self.piece_bytes = path, [f.name for f in schema.fields], seed, piece_bytes
        self.kinds = {f.name: f.dataType for f in schema.fields}
        store, folder = opened(path)
        with store.open_input_stream(f"{folder}/manifest.json") as f:
            manifest = json.loads(f.read())
        self.width, self.parts = manifest["width"], manifest["parts"]
        self.edges = np.cumsum([0, *(p["records"] for p in self.parts)])

    def partitions(self) -> list[Piece]:
        n, size = int(self.edges[-1]), sum(p["tokens"] * self.width + p["records"] * FRAME for p in self.parts)
        pieces = min(n, max(1, -(-size // self.piece_bytes)))
        if self.seed is not None:
            return [Piece(n * i // pieces, n * (i + 1) // pieces) for i in range(pieces)] or [Piece(0, 0)]
        out = []
        for lo, hi, p in zip(self.edges, self.edges[1:], self.parts, strict=False):
            k = max(1, -(-(p["tokens"] * self.width) // self.piece_bytes))
            out += [Piece(int(lo + (hi - lo) * i // k), int(lo + (hi - lo) * (i + 1) // k)) for i in range(k)]
        return out or [Piece(0, 0)]

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        store, folder = opened(self.path)
        if piece.first >= piece.last:
            return
        if self.seed is None:
            wanted = np.arange(piece.first, piece.last)
        else:
            wanted = permuted(np.arange(piece.first, piece.last), int(self.edges[-1]), self.seed)
        part_of = np.searchsorted(self.edges, wanted, "right") - 1
        # a permutation's share is read by place in the files and put back into its order; a share is some megabytes
        order = np.lexsort((wanted, part_of))
        made: list[tuple[np.ndarray, dict]] = []
        for k in np.unique(part_of):
            mine = order[part_of[order] == k]
            for rows, columns in self._of_part(store, folder, int(k), wanted[mine] - self.edges[k]):
                if self.seed is None:
                    yield self._batch(columns)
                else:
                    made.append((mine[rows], columns))
        if made:
            at = np.argsort(np.concatenate([rows for rows, _ in made]))
            batch = pa.Table.from_batches([self._batch(c) for _, c in made]).combine_chunks()
            yield from batch.take(pa.array(at)).combine_chunks().to_batches(max_chunksize=1000)

    def _of_part(self, store: fs.FileSystem, folder: str, k: int, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, dict]]:
        """The wanted records, by ascending number in the part, in pieces of neighbours that are read at once."""
        p = self.parts[k]
        name = f"{folder}/{p['name']}"
        with store.open_input_file(f"{name}.idx") as f:
            lo, hi = int(numbers[0]), int(numbers[-1]) + 1
            entries = np.frombuffer(f.read_at((hi - lo) * INDEX.itemsize, lo * INDEX.itemsize), INDEX)[numbers - lo]
        sizes = entries["tokens"].astype(np.int64) * self.width + FRAME
        if len(entries) != len(numbers):
            raise ValueError(f"{name}: the index is cut off")
        offsets = entries["offset"].astype(np.int64)
        new = np.append(True, (offsets[1:] != offsets[:-1] + sizes[:-1]))
        group = np.cumsum(new) * (1 << 20) + (np.cumsum(sizes) >> 22)
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        with store.open_input_file(f"{name}.rec") as f:
            for a, b in zip(first, [*first[1:], len(entries)], strict=True):
                begin = int(offsets[a])
                data = memoryview(f.read_at(int(offsets[b - 1] + sizes[b - 1]) - begin, begin))
                payloads = [payload_of(data, int(o) - begin, name) for o in offsets[a:b]]
                if any(len(x) != s - FRAME for x, s in zip(payloads, sizes[a:b].tolist(), strict=True)):
                    raise ValueError(f"{name}: index and records differ")
                e = entries[a:b]
                yield np.arange(a, b), {"record": self.edges[k] + numbers[a:b], "entries": e, "start": p["start"] + e["start"].astype(np.int64), "payloads": payloads}

    def _batch(self, c: dict) -> pa.RecordBatch:
        e = c["entries"]
        wide = lambda x: np.frombuffer(x, f"<u{self.width}").astype("<u4")
        makers = {
            "record": lambda: pa.array(c["record"], pa.int64()),
            "doc_id": lambda: pa.array(e["doc_id"].astype(np.int64), pa.int64(), mask=e["has_id"] == 0),
            "start": lambda: pa.array(c["start"], pa.int64()),
            "n_tokens": lambda: pa.array(e["tokens"].astype(np.int64), pa.int64()),
            "ids_crc32": lambda: pa.array([zlib.crc32(wide(x)) for x in c["payloads"]], pa.int64()),
            "token_ids": lambda: pa.array([wide(x).astype(np.int32) for x in c["payloads"]], pa.list_(pa.int32())),
        }
        return pa.RecordBatch.from_arrays([makers[n]() for n in self.names], names=self.names)


class TokenRecords(DataSource):
    """Options: path; width (bytes of an id, written); seed (read in the order of a permutation); pieceBytes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> RecordReader:
        seed = self.options.get("seed")
        return RecordReader(self.options["path"], schema, None if seed is None else int(seed), int(self.options.get("pieceBytes", PIECE_BYTES)))

    def writer(self, schema: T.StructType, overwrite: bool) -> RecordWriter:
        store, folder = opened(self.options["path"])
        store.create_dir(folder, recursive=True)
        return RecordWriter(self.options["path"], int(self.options.get("width", 4)))


def permuted(places: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A permutation of 0..n-1 at the places: four rounds over the two halves of a number's bits, repeated where the result is n or more."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(seed).integers(0, 2**63, 4, dtype=np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for key in keys:
            h = (right + key) * np.uint64(0x9E3779B97F4A7C15)
            left, right = right, left ^ ((h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - half))
        return left << np.uint64(half) | right

    out = once(places.astype(np.uint64))
    while (far := out >= n).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def encoded(docs: DataFrame, vocabulary: str, end_id: int | None, width: int) -> DataFrame:
    """doc_id and ids (binary, width bytes each) of rows (doc_id, text), in the order of the rows of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = model_of(vocabulary), b"" if end_id is None else end_id.to_bytes(4, "little")
        for part, texts in in_chunks(batches):
            data = [x + end for x in bpe.encode_bytes([t or "" for t in texts])]
            if width == 2:
                narrow = np.frombuffer(b"".join(data), "<u4").astype("<u2").tobytes()
                ends = np.cumsum([len(x) // 2 for x in data]).tolist()
                data = [narrow[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("doc_id")), pa.array(data, pa.binary())], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def in_order(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text by ascending id over partitions of about PART_BYTES of text; rows of one id by the hash of their text, so that an id of many rows is cut like any other."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash").asc()]
    keyed = rows.withColumn("_hash", F.xxhash64("text"))
    return keyed.repartitionByRange(max(1, math.ceil(size / PART_BYTES)), *order).sortWithinPartitions(*order).drop("_hash")


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int | None = 2, id_col: str = "doc_id", text: str = "text") -> None:
    """Encodes whole texts and writes their ids, each text's followed by end_id (None: nothing), by ascending id of the documents."""
    docs.sparkSession.dataSource.register(TokenRecords)
    model = model_of(vocabulary)
    width = 2 if max([*model.by_id, end_id or 0]) < 1 << 16 else 4
    encoded(in_order(docs, id_col, text), vocabulary, end_id, width).write.format(FORMAT).option("path", path).option("width", width).mode("append").save()


def read(spark: SparkSession, path: str, columns: str = SCHEMA, seed: int | None = None, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Rows of the records, of any of the columns of SCHEMA, in the order of the files; with a seed, in that of a permutation of all."""
    spark.dataSource.register(TokenRecords)
    found = spark.read.format(FORMAT).schema(columns).option("path", path).option("pieceBytes", piece_bytes)
    return (found if seed is None else found.option("seed", seed)).load()
