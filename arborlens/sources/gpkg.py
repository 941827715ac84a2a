"""GeoPackage layers: SQLite files whose geometries are WKB behind a short header.

On a file system that all executors mount, a layer is read by ranges of row ids: each task opens the file and
looks its own range up in the table's tree, so a large layer is many tasks' work and no task holds a file. Elsewhere files are read whole
by Spark's binary reader (under 2 GB each) and opened in memory, one task a file.

A layer is written as one file. Tasks write parts, small databases of their own rows; when all have ended they are copied into the
file by SQLite, which streams them, and the file takes its name when it is whole.
"""

from __future__ import annotations

import glob
import json
import os
import shutil
import sqlite3
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from arborlens.sources.files import Counted, Piece, listed, local_path
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader

# Fixed values of the format: sizes of the envelope by its code, and the application id "GPKG".
ENVELOPE_BYTES = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}
APPLICATION_ID = 0x47504B47
SQL_TYPES = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(), "BLOB": T.BinaryType()}
INTEGERS, REALS = ("INT", "INTEGER", "MEDIUMINT", "BIGINT", "SMALLINT", "TINYINT"), ("REAL", "DOUBLE", "FLOAT")


def wkb_of(blob: bytes | None) -> bytes | None:
    """The WKB of a geometry blob; null for an empty or foreign one."""
    if not blob or blob[:2] != b"GP" or blob[3] & 0x10:
        return None
    return bytes(blob[8 + ENVELOPE_BYTES[blob[3] >> 1 & 7] :])


def point_of(wkb: bytes | None) -> tuple[float | None, float | None, float | None]:
    """x, y and z of a WKB point; nulls for anything else."""
    if not wkb or len(wkb) < 21:
        return None, None, None
    order = "<" if wkb[0] else ">"
    kind = struct.unpack(order + "I", wkb[1:5])[0]
    has_z = bool(kind & 0x80000000) or kind // 1000 % 10 in (1, 3)
    if kind & 0xFFFF not in (1, 1001, 2001, 3001):
        return None, None, None
    values = struct.unpack(f"{order}{(len(wkb) - 5) // 8}d", wkb[5 : 5 + (len(wkb) - 5) // 8 * 8])
    return values[0], values[1], values[2] if has_z and len(values) > 2 else None


def line_of(wkb: bytes | None) -> list[tuple[float, float]]:
    """The points of a WKB line string, or of the outer ring of a polygon."""
    if not wkb:
        return []
    order = "<" if wkb[0] else ">"
    kind = struct.unpack(order + "I", wkb[1:5])[0]
    at = 5 if kind % 1000 == 2 else 9
    size = 3 if kind // 1000 == 1 else 2
    n = struct.unpack(order + "I", wkb[at : at + 4])[0]
    values = struct.unpack(f"{order}{n * size}d", wkb[at + 4 : at + 4 + 8 * n * size])
    return [(values[i], values[i + 1]) for i in range(0, len(values), size)]


def blob_of(x: float, y: float, srs: int = 0) -> bytes:
    """A point as a geometry blob without envelope."""
    return struct.pack("<2sBBi", b"GP", 0, 1, srs) + struct.pack("<BIdd", 1, 1, x, y)


def _open(content: bytes) -> sqlite3.Connection:
    db = sqlite3.connect(":memory:")
    db.deserialize(content)
    return db


#: Bytes of a file that one task reads, about, and rows that it holds.
PIECE_BYTES, BLOCK = 16 << 20, 20_000
KINDS = {T.LongType(): (pa.int64(), int), T.DoubleType(): (pa.float64(), float), T.BooleanType(): (pa.bool_(), bool), T.BinaryType(): (pa.binary(), bytes), T.StringType(): (pa.string(), str)}


def _open_file(path: str) -> sqlite3.Connection:
    """The file itself, read only; nobody may change it meanwhile."""
    return sqlite3.connect(f"file:{path.replace('?', '%3f').replace('#', '%23')}?mode=ro&immutable=1", uri=True)


def layer_schema(db: sqlite3.Connection, layer: str) -> tuple[T.StructType, str]:
    """The layer's columns, x, y, z and geom_wkb in place of its geometry (but for those that it has as columns), and the geometry's name."""
    geom = (db.execute("select column_name from gpkg_geometry_columns where table_name = ?", (layer,)).fetchone() or ("",))[0]
    fields = []
    for _, name, kind, *_ in db.execute(f'pragma table_info("{layer}")'):
        base = (kind or "").upper().split("(")[0]
        if name != geom:
            fields.append(T.StructField(name, T.LongType() if base in INTEGERS else T.DoubleType() if base in REALS else T.BooleanType() if base == "BOOLEAN" else T.BinaryType() if base == "BLOB" else T.StringType()))
    if not fields:
        raise ValueError(f"no layer {layer}")
    place = [T.StructField(a, T.DoubleType()) for a in ("x", "y", "z")] + [T.StructField("geom_wkb", T.BinaryType())] if geom else []
    held = {f.name.lower() for f in fields}
    return T.StructType([*fields, *(f for f in place if f.name not in held)]), geom


def layer_rows(db: sqlite3.Connection, layer: str, schema: T.StructType, device: str, ids: tuple[int, int] | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of a layer, those of row ids from the first up to the second if given, in batches; columns that it lacks are null."""
    found, geom = layer_schema(db, layer)
    wanted = [f for f in schema.fields if f.name != "device"]
    held = {name for _, name, *_ in db.execute(f'pragma table_info("{layer}")')}
    own = [f.name for f in found.fields if f.name in held and f.name in schema.names]
    chosen = ", ".join(f'"{n}"' for n in own + [geom] * bool(geom)) or "1"
    cursor = db.execute(f'select {chosen} from "{layer}"' + (" where rowid between ? and ?" if ids else ""), ids or ())
    while rows := cursor.fetchmany(BLOCK):
        data = {n: [r[i] for r in rows] for i, n in enumerate(own)}
        if geom:
            shapes = [wkb_of(r[-1]) for r in rows]
            points = [point_of(w) for w in shapes]
            data = {"geom_wkb": shapes} | {a: [p[i] for p in points] for i, a in enumerate("xyz")} | data
        columns = [pa.array([None if v is None else KINDS[f.dataType][1](v) for v in data.get(f.name, [None] * len(rows))], KINDS[f.dataType][0]) for f in wanted]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([device] * len(rows), pa.string())], names=[*(f.name for f in wanted), "device"])


class LayerReader(DataSourceReader):
    def __init__(self, path: str, layer: str, schema: T.StructType, piece_bytes: int):
        self.path, self.layer, self.fields, self.piece_bytes = path, layer, schema.json(), piece_bytes

    def partitions(self) -> list[Piece]:
        return [Piece(rank, file, i, n) for rank, (file, size) in enumerate(listed(self.path, ".gpkg")) for n in [max(1, -(-size // self.piece_bytes))] for i in range(n)]

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        db = _open_file(local_path(piece.path))
        try:
            schema, ids = T.StructType.fromJson(json.loads(self.fields)), None
            if piece.parts > 1:
                # a layer without row ids (a view) can't be cut: its first piece is all of it
                try:
                    low, high = db.execute(f'select min(rowid), max(rowid) from "{self.layer}"').fetchone()
                except sqlite3.OperationalError:
                    low = None
                if low is None and piece.part:
                    return
                if low is not None:
                    span = high - low + 1
                    ids = (low + span * piece.part // piece.parts, low + span * (piece.part + 1) // piece.parts - 1)
            yield from layer_rows(db, self.layer, schema, piece.path, ids)
        finally:
            db.close()


def _spatial(names: list[str]) -> bool:
    return {"x", "y"} <= set(names)


def make_layer(db: sqlite3.Connection, fields: list[T.StructField], layer: str) -> str:
    """An empty layer of points (columns x and y) or of plain rows; returns what inserts a row."""
    names = [f.name for f in fields]
    spatial = _spatial(names)
    plain = [f for f in fields if not (spatial and f.name in ("x", "y"))]
    sql = {T.LongType(): "BIGINT", T.IntegerType(): "INTEGER", T.DoubleType(): "DOUBLE", T.BooleanType(): "BOOLEAN", T.BinaryType(): "BLOB"}
    db.execute(f"pragma application_id = {APPLICATION_ID}")
    db.execute("create table gpkg_spatial_ref_sys (srs_name text, srs_id integer primary key, organization text, organization_coordsys_id integer, definition text, description text)")
    db.execute("insert into gpkg_spatial_ref_sys values ('undefined', 0, 'NONE', 0, 'undefined', null)")
    db.execute("create table gpkg_contents (table_name text primary key, data_type text, identifier text, description text, last_change text, min_x double, min_y double, max_x double, max_y double, srs_id integer)")
    db.execute("create table gpkg_geometry_columns (table_name text, column_name text, geometry_type_name text, srs_id integer, z tinyint, m tinyint)")
    db.execute("insert into gpkg_contents values (?, ?, ?, '', '', null, null, null, null, 0)", (layer, "features" if spatial else "attributes", layer))
    if spatial:
        db.execute("insert into gpkg_geometry_columns values (?, 'geom', 'POINT', 0, 0, 0)", (layer,))
    columns = ["geom BLOB"] * spatial + [f'"{f.name}" {sql.get(f.dataType, "TEXT")}' for f in plain]
    db.execute(f'create table "{layer}" ({", ".join(columns)})')
    return f'insert into "{layer}" values ({", ".join("?" * len(columns))})'


class LayerWriter(DataSourceArrowWriter):
    def __init__(self, path: str, layer: str, schema: T.StructType):
        self.path, self.layer, self.fields = path, layer, schema.json()
        self.beside = f"{path}.{uuid.uuid4().hex}"

    def _schema(self) -> list[T.StructField]:
        return T.StructType.fromJson(json.loads(self.fields)).fields

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Counted:
        fields = self._schema()
        names = [f.name for f in fields]
        part, n = TaskContext.get().partitionId(), 0
        name = f"{self.beside}.{part}.{uuid.uuid4().hex}.part"
        text = lambda v: v if v is None or isinstance(v, (int, float, str, bytes, bytearray)) else str(v)
        db = None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if db is None:
                db = sqlite3.connect(name)
                db.execute("pragma journal_mode = off")  # a part that isn't finished isn't used
                insert = make_layer(db, fields, self.layer)
            values = dict(zip(names, (batch.column(i).to_pylist() for i in range(len(names))), strict=True))
            lead = [[blob_of(x, y) if x is not None and y is not None else None for x, y in zip(values.pop("x"), values.pop("y"), strict=True)]] if _spatial(names) else []
            db.executemany(insert, zip(*lead, *[[text(v) for v in c] for c in values.values()], strict=True))
            n += batch.num_rows
        if db is not None:
            db.commit()
            db.close()
        return Counted(part, n, name)

    def commit(self, messages: list[Counted | None]) -> None:
        whole = f"{self.beside}.part"
        db = sqlite3.connect(whole)
        db.execute("pragma journal_mode = off")
        make_layer(db, self._schema(), self.layer)
        db.commit()
        parts = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.part)
        for m in parts:
            db.execute("attach ? as p", (m.name,))
            db.execute(f'insert into main."{self.layer}" select * from p."{self.layer}" order by rowid')
            db.commit()
            db.execute("detach p")
        db.close()
        os.replace(whole, self.path)
        self._clean()

    def abort(self, messages: list[Counted | None]) -> None:
        self._clean()

    def _clean(self) -> None:
        """Removes all parts, those of attempts that failed too."""
        for name in glob.glob(f"{glob.escape(self.beside)}.*"):
            os.remove(name)


class LayerSource(DataSource):
    """Options: path, layer, pieceBytes."""

    @classmethod
    def name(cls) -> str:
        return "gpkg_layer"

    def reader(self, schema: T.StructType) -> LayerReader:
        return LayerReader(self.options["path"], self.options["layer"], schema, int(self.options.get("pieceBytes", PIECE_BYTES)))

    def writer(self, schema: T.StructType, overwrite: bool) -> LayerWriter:
        return LayerWriter(local_path(self.options["path"]), self.options["layer"], schema)


def read_gpkg(spark: SparkSession, path: str, layer: str, schema: T.StructType | None = None, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """A layer of all .gpkg files below the path, with ``device``, the file's path. The schema is that of the first file by path; columns that a file lacks are null there."""
    device = T.StructField("device", T.StringType())
    if local_path(path) is None or any(c in path for c in "*?[{"):
        return _read_whole(spark, path, layer, schema)
    if schema is None:
        found = listed(path, ".gpkg")
        if not found:
            raise FileNotFoundError(path)
        db = _open_file(local_path(found[0][0]))
        schema, _ = layer_schema(db, layer)
        db.close()
    spark.dataSource.register(LayerSource)
    full = T.StructType([*(f for f in schema.fields if f.name != "device"), device])
    return spark.read.format("gpkg_layer").schema(full).option("path", path).option("layer", layer).option("pieceBytes", piece_bytes).load()


def _read_whole(spark: SparkSession, path: str, layer: str, schema: T.StructType | None) -> DataFrame:
    """The same from a store that isn't mounted: one task a file, which is held in memory."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gpkg").option("recursiveFileLookup", True).load(path)
    if schema is None:
        name = files.agg(F.min("path")).first()[0]  # names only
        if name is None:
            raise FileNotFoundError(path)
        schema, _ = layer_schema(_open(spark.read.format("binaryFile").load(name).first()["content"]), layer)
    full = T.StructType([*schema.fields, T.StructField("device", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for device, content in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                yield from layer_rows(_open(content), layer, full, device)

    return files.select("path", "content").mapInArrow(run, full)


def sequenced(df: DataFrame) -> DataFrame:
    """df with seq: the order of files by path, then of ids in a file."""
    from arborlens.operators.records import number_rows

    return number_rows(df, [F.col("device").asc(), F.col("fid").asc_nulls_last()], "seq", 0)


def write_gpkg(df: DataFrame, path: str, layer: str) -> None:
    """Replaces the file, on a file system that all executors mount, by one with one layer; rows are in the order of df's partitions. With x and y, these are the geometry: a geom_wkb beside them isn't written, z is a plain column."""
    if (target := local_path(path)) is None:
        raise ValueError("a GeoPackage is written to a mounted file system")
    os.makedirs(os.path.dirname(target), exist_ok=True)
    df.sparkSession.dataSource.register(LayerSource)
    df = df.drop("geom_wkb") if _spatial(df.columns) else df
    df.write.format("gpkg_layer").option("path", path).option("layer", layer).mode("append").save()


def write_to_all(df: DataFrame, paths: list[str], layer: str) -> None:
    """The same layer in several files; the rows are computed once, and the file is copied."""
    if not paths:
        return
    write_gpkg(df, paths[0], layer)
    for path in paths[1:]:
        target = local_path(path)
        os.makedirs(os.path.dirname(target), exist_ok=True)
        shutil.copyfile(local_path(paths[0]), beside := f"{target}.{uuid.uuid4().hex}.part")
        os.replace(beside, target)
