"""LAS point clouds (uncompressed, point formats 0 to 3 and 6 to 8), by the public format description.

A file is read as ranges of records: a task opens the file, reads its header, and then only its own
range, some megabytes at a time. So neither a file's size nor a task's memory is bounded by the other,
and one file of any size is many tasks' work. Asked for columns alone are decoded. Compressed LAZ can't be decoded here.

A cloud is written as one file by all tasks at once: points are numbered first, so each task knows the place of its
records, and the header follows when all have ended. For stores whose files can't be written in the middle there
is ``write_las_parts``: a whole small file for each task. Parquet, clustered by tile, is the form for work between jobs.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from arborlens.sources.files import Counted, Piece, local_path, opened, pieces
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader

# Fixed values of the format: the fields of a point record and what each format adds.
CORE = [("X", "<i4"), ("Y", "<i4"), ("Z", "<i4"), ("intensity", "<u2"), ("flags", "u1"), ("classification", "u1"), ("scan_angle", "i1"), ("user_data", "u1"), ("point_source_id", "<u2")]
WIDE = [("X", "<i4"), ("Y", "<i4"), ("Z", "<i4"), ("intensity", "<u2"), ("flags", "u1"), ("more_flags", "u1"), ("classification", "u1"), ("user_data", "u1"), ("scan_angle", "<i2"), ("point_source_id", "<u2"), ("gps_time", "<f8")]
TIME, COLOUR, INFRARED = [("gps_time", "<f8")], [("r", "<u2"), ("g", "<u2"), ("b", "<u2")], [("infrared", "<u2")]
FORMATS = {0: CORE, 1: CORE + TIME, 2: CORE + COLOUR, 3: CORE + TIME + COLOUR, 6: WIDE, 7: WIDE + COLOUR, 8: WIDE + COLOUR + INFRARED}
SCHEMA = "seq long, x double, y double, z double, intensity int, return_number int, classification int, scan_angle int, user_data int, point_source_id int, gps_time double, r int, g int, b int, file string"
HEADER = struct.Struct("<4sHHIHH8sBB32s32sHHHIIBHI5I3d3d6d")
#: Where versions from 1.4 on hold the number of points in 64 bits, the size of their header, and degrees of a wide scan angle.
COUNT_AT, HEADER_14, ANGLE = 247, 375, 0.006
#: Attributes that are written.
ATTRIBUTES = ("intensity", "classification", "scan_angle", "user_data", "point_source_id", "gps_time", "r", "g", "b")
SEQ_BITS = 36
#: Bytes of a file that one task reads, and records that it holds decoded.
PIECE_BYTES, BLOCK = 64 << 20, 200_000


def header(content: bytes) -> dict:
    v = HEADER.unpack_from(content)
    if v[0] != b"LASF":
        raise ValueError("not a LAS file")
    if v[16] & 0x80 or v[16] not in FORMATS:
        raise ValueError(f"point format {v[16]} can't be read")
    count = v[18]
    if (v[7], v[8]) >= (1, 4) and len(content) >= COUNT_AT + 8:
        count = struct.unpack_from("<Q", content, COUNT_AT)[0] or count
    return {"version": (v[7], v[8]), "offset": v[14], "format": v[16], "record": v[17], "count": count, "scale": v[24:27], "shift": v[27:30], "max": v[30:36:2], "min": v[31:36:2]}


def record_type(h: dict) -> np.dtype:
    names, kinds = zip(*FORMATS[h["format"]], strict=True)
    offsets = np.cumsum([0, *(np.dtype(k).itemsize for k in kinds)])[:-1]
    return np.dtype({"names": names, "formats": kinds, "offsets": offsets, "itemsize": h["record"]})


def column(rows: np.ndarray, h: dict, name: str) -> np.ndarray | None:
    """The values of one column of SCHEMA in decoded records; None where the format has none."""
    if name in ("x", "y", "z"):
        i = "xyz".index(name)
        return rows[name.upper()] * h["scale"][i] + h["shift"][i]
    wide = h["format"] >= 6
    if name == "return_number":
        return rows["flags"] & (15 if wide else 7)
    if name not in rows.dtype.names:
        return None
    if name == "scan_angle" and wide:
        return np.round(rows[name] * ANGLE)
    # the upper bits of a classification in formats up to 5 are flags
    return rows[name] & 31 if name == "classification" and not wide else rows[name]


class LasReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, piece_bytes: int):
        self.path, self.names, self.piece_bytes = path, [f.name for f in schema.fields], piece_bytes

    def partitions(self) -> list[Piece]:
        return pieces(self.path, ".las", self.piece_bytes)

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        store, where = opened(piece.path)
        with store.open_input_file(where) as f:
            h = header(f.read_at(HEADER_14, 0))
            kind, n = record_type(h), h["count"]
            for a in range(n * piece.part // piece.parts, end := n * (piece.part + 1) // piece.parts, BLOCK):
                b = min(end, a + BLOCK)
                data = f.read_at((b - a) * h["record"], h["offset"] + a * h["record"])
                if len(data) < (b - a) * h["record"]:
                    raise ValueError(f"{piece.path}: {n} points announced, but the file ends before")
                rows = np.frombuffer(data, kind)
                yield pa.RecordBatch.from_arrays([self._array(rows, h, name, piece, a) for name in self.names], names=self.names)

    def _array(self, rows: np.ndarray, h: dict, name: str, piece: Piece, first: int) -> pa.Array:
        if name == "seq":
            return pa.array((piece.rank << SEQ_BITS) + np.arange(first, first + len(rows)))
        if name == "file":
            return pa.array([piece.path], pa.string()).take(pa.array(np.zeros(len(rows), np.int32)))
        floating = name in ("x", "y", "z", "gps_time")
        values = column(rows, h, name)
        return pa.nulls(len(rows), pa.float64() if floating else pa.int32()) if values is None else pa.array(values.astype(np.float64 if floating else np.int32))


def packed(columns: dict[str, np.ndarray], shift: list[float], scale: float, form: int) -> np.ndarray:
    """Records of point format 1, or 3 for colours. Missing and null attributes are 0; values beyond a field's range, or a coordinate beyond 32 bits of steps, are an error."""
    rows = np.zeros(len(columns["x"]), np.dtype(FORMATS[form]))
    for i, a in enumerate("xyz"):
        steps = np.round((columns[a] - shift[i]) / scale)
        if not np.all(np.abs(steps) < 2**31):
            raise ValueError(f"{a} is null or too far out for steps of {scale}")
        rows[a.upper()] = steps
    for name in rows.dtype.names:
        if name in columns:
            values, kind = np.nan_to_num(columns[name].astype(float)), rows.dtype[name]
            if kind.kind != "f" and len(values) and (values.min() < np.iinfo(kind).min or values.max() > np.iinfo(kind).max):
                raise ValueError(f"{name} doesn't fit its field")
            rows[name] = values
    return rows


def head(n: int, low: list[float], high: list[float], shift: list[float], scale: float, form: int) -> bytes:
    """A header of version 1.2, or of 1.4 where 32 bits can't hold the count."""
    size = np.dtype(FORMATS[form]).itemsize
    bounds = [v for i in range(3) for v in (high[i], low[i])]
    small = n < 1 << 32
    length = 227 if small else HEADER_14
    out = HEADER.pack(b"LASF", 0, 0, 0, 0, 0, b"", 1, 2 if small else 4, b"", b"arborlens", 1, 1, length, length, 0, form, size, n if small else 0, n if small else 0, 0, 0, 0, 0, scale, scale, scale, *shift, *bounds)
    return out if small else out + struct.pack("<QQI", 0, 0, 0) + struct.pack("<16Q", n, n, *[0] * 14)


class LasWriter(DataSourceArrowWriter):
    """Tasks write their records at their places in a file beside the target; commit adds the header and gives it its name. A task that is tried again writes the same bytes."""

    def __init__(self, path: str, plan: dict):
        self.path, self.plan = path, plan
        self.beside = f"{path}.{uuid.uuid4().hex}.part"
        self.start = 227 if plan["count"] < 1 << 32 else HEADER_14

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Counted:
        p, n = self.plan, 0
        file = os.open(self.beside, os.O_RDWR | os.O_CREAT, 0o644)
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                columns = {name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}
                rows = packed(columns, p["shift"], p["scale"], p["form"])
                for block in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(columns["_i"]) != 1) + 1):
                    os.pwrite(file, rows[block].tobytes(), self.start + int(columns["_i"][block[0]]) * rows.dtype.itemsize)
                n += len(rows)
            os.fsync(file)
        finally:
            os.close(file)
        return Counted(TaskContext.get().partitionId(), n)

    def commit(self, messages: list[Counted | None]) -> None:
        p = self.plan
        written = sum(m.rows for m in messages if m is not None)
        if written != p["count"]:
            raise ValueError(f"{written} of {p['count']} points were written")
        file = os.open(self.beside, os.O_RDWR | os.O_CREAT, 0o644)
        try:
            os.pwrite(file, head(p["count"], p["low"], p["high"], p["shift"], p["scale"], p["form"]), 0)
            os.fsync(file)
        finally:
            os.close(file)
        os.replace(self.beside, self.path)

    def abort(self, messages: list[Counted | None]) -> None:
        if os.path.exists(self.beside):
            os.remove(self.beside)


class LasSource(DataSource):
    """Options: path; pieceBytes (reading); plan (writing, JSON: count, low, high, shift, scale, form)."""

    @classmethod
    def name(cls) -> str:
        return "las_points"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> LasReader:
        return LasReader(self.options["path"], schema, int(self.options.get("pieceBytes", PIECE_BYTES)))

    def writer(self, schema: T.StructType, overwrite: bool) -> LasWriter:
        import json

        return LasWriter(local_path(self.options["path"]), json.loads(self.options["plan"]))


def read_las(spark: SparkSession, path: str, columns: str = SCHEMA, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Points of all .las files below the path, of any of the columns of SCHEMA. seq: rank of the file by path, then place in it."""
    spark.dataSource.register(LasSource)
    return spark.read.format("las_points").schema(columns).option("path", path).option("pieceBytes", piece_bytes).load()


def _numbered(df: DataFrame) -> tuple[DataFrame, dict]:
    """df's written columns with _i, their place from 0 by seq (else in any order), and what a header says."""
    from arborlens.operators.records import number_rows, saved

    wanted = [c for c in ("x", "y", "z", *ATTRIBUTES) if c in df.columns]
    order = [F.col("seq").asc()] if "seq" in df.columns else [F.col(a).asc() for a in "xyz"]
    rows = saved(number_rows(df.select(*wanted, *(["seq"] if "seq" in df.columns else [])), order, "_i", 0).select(*wanted, "_i"))
    s = rows.agg(F.count(F.lit(1)).alias("n"), *[f(a).alias(f"{k}{a}") for a in "xyz" for k, f in (("lo", F.min), ("hi", F.max))]).first()
    low, high = ([float(s[f"{k}{a}"]) if s[f"{k}{a}"] is not None else 0.0 for a in "xyz"] for k in ("lo", "hi"))
    return rows, {"count": s["n"], "low": low, "high": high, "shift": [float(np.floor(v)) for v in low], "form": 3 if {"r", "g", "b"} <= set(wanted) else 1}


def write_las(df: DataFrame, path: str, scale: float = 0.001) -> None:
    """One file, ordered by seq, on a file system that all executors mount; each task writes its own points. Replaces the file when all is written."""
    import json

    if (target := local_path(path)) is None:
        raise ValueError("one file needs a mounted file system; use write_las_parts")
    os.makedirs(os.path.dirname(target), exist_ok=True)
    rows, plan = _numbered(df)
    df.sparkSession.dataSource.register(LasSource)
    rows.write.format("las_points").option("path", path).option("plan", json.dumps(plan | {"scale": scale})).mode("append").save()


def write_las_parts(df: DataFrame, folder: str, scale: float = 0.001, points: int = 1_000_000) -> DataFrame:
    """Whole files of at most so many points each, in order of seq, in a folder of any store; returns their names and counts. A task that is tried again writes the same file."""
    rows, plan = _numbered(df)
    n = max(1, -(-plan["count"] // points))
    store, where = opened(folder)
    store.create_dir(where, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # at most ``points`` rows
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by("_i")
        c = {name: table[name].to_numpy() for name in table.column_names}
        data = packed(c, plan["shift"], scale, plan["form"])
        name = f"part-{int(c['_i'][0]) // points:08d}.las"
        with opened(folder)[0].open_output_stream(f"{where}/{name}") as f:
            f.write(head(len(data), *([float(g(c[a])) for a in "xyz"] for g in (np.min, np.max)), plan["shift"], scale, plan["form"]))
            f.write(data.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(data)], pa.int64())], names=["name", "points"])

    from arborlens.operators.records import saved

    dealt = rows.repartitionById(n, F.expr(f"cast(_i div {points} as int)"))
    return saved(dealt.mapInArrow(run, "name string, points long"))


def write_tiles(df: DataFrame, path: str, size: float) -> None:
    """Parquet clustered by tile, so that row-group statistics and partition pruning do what a spatial index does."""
    from arborlens.operators.points import tiles

    tiled = tiles(df, size).drop("is_buffer")
    # sorted within files, but not dealt by tile alone: a tile with most points is written by many tasks
    tiled.repartitionByRange("tile_x", "tile_y", F.col("x"), F.col("y")).sortWithinPartitions("tile_x", "tile_y").write.mode("overwrite").partitionBy("tile_x", "tile_y").parquet(path)
