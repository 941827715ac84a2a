"""Text formats: CSV and XYZ, white-space tables, GeoJSON, usage logs, zips, templates."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborlens.functions.geometry import Ring


def read_xyz(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    return spark.read.csv(path, sep=sep, schema="x double, y double, z double")


def write_xyz(df: DataFrame, path: str, sep: str = " ") -> None:
    df.select("x", "y", "z").write.mode("overwrite").csv(path, sep=sep)


def read_trajectory(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    return spark.read.csv(path, sep=sep, schema="time double, x double, y double, z double", comment="%")


def read_csv_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The CSV file with a header, or no rows where there is none."""
    try:
        return spark.read.csv(path, header=True, schema=schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T._parse_datatype_string(schema))


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table with a header line and columns separated by white space, by the names and types of the schema."""
    fields = T._parse_datatype_string(schema).fields
    lines = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("v"))
    names = [f.name for f in fields]
    header = F.array(*[F.lit(n) for n in names])
    return lines.where((F.col("v") != header) & (F.size("v") == len(fields))).select(*[F.get("v", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


def read_geojson_rings(spark: SparkSession, path: str) -> list[Ring]:
    """The rings of the first feature's polygon."""
    geometry = "struct<type:string,coordinates:array<array<array<double>>>>"
    row = spark.read.schema(f"features array<struct<geometry:{geometry}>>").json(path, multiLine=True).select(F.get("features", F.lit(0))["geometry"]["coordinates"].alias("c")).first()
    if row is None or row["c"] is None:
        raise ValueError("no polygon")
    return [[(p[0], p[1]) for p in ring] for ring in row["c"]]


def read_usage_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="Time timestamp, Percent double, Cores double, RAM double")


def read_zip_members(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """A row (archive, name, content) for each file in the zips whose name ends with the suffix."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for info in z.infolist():
                        if not info.is_dir() and info.filename.endswith(suffix):
                            yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([info.filename]), pa.array([z.read(info)], pa.binary())], names=["archive", "name", "content"])

    return files.mapInArrow(run, "archive string, name string, content binary")


def read_template(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"]


def write_segments(df: DataFrame, path: str, segment: str = "segment_id") -> None:
    """A folder for each segment. Rows are dealt by segment and by a salt, so that one huge segment isn't one task."""
    df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(8))).repartition(segment, "_salt").drop("_salt").write.mode("overwrite").partitionBy(segment).parquet(path)


def write_metadata(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    df.write.jdbc(url, table, mode="append", properties=properties)
