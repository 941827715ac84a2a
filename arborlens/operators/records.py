"""Records from several devices: union with offsets, latest record, numbering, links.

Row order matters to the census, and DataFrames have none: ``seq``, the ingest order, ends
every ordering. Nulls sort last in both directions unless said otherwise.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, if it names one."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a shared folder")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="arborlens-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """df from the checkpoint folder: rows and partitions stay as they are however often they are read."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As saved(), for large tables: Parquet in the checkpoint folder, which is compressed; partitions may change."""
    path = f"{checkpoint_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_per_key(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each key; null keys are one key. Spark turns this into a limit before the shuffle."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def latest_or_smallest(df: DataFrame, key: str, date: str, size: str, seq: list[str]) -> DataFrame:
    """Of each key the row with the latest date; where no row has a date, the one of smallest ``size``. One window does both."""
    undated = F.col(date).isNull()
    order = [undated.asc(), F.col(date).desc_nulls_last(), F.when(undated, F.col(size)).asc_nulls_last(), *[F.col(s).asc() for s in seq]]
    return first_per_key(df, [key], order)


def latest_then_distinct(df: DataFrame, key: list[str], place: str, date: str, seq: list[str]) -> DataFrame:
    """The latest row per key, and of those the latest per place: two steps, as they are not one key."""
    order = [F.col(date).desc_nulls_last(), *[F.col(s).asc() for s in seq]]
    return first_per_key(first_per_key(df, key, order), [place], order)


def null_count(columns: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(F.col(c).isNull(), 1).otherwise(0) for c in columns], F.lit(0))


def most_complete(df: DataFrame, key: str, columns: list[str], seq: list[Column]) -> DataFrame:
    """Of each key the row with the fewest nulls in the columns."""
    return first_per_key(df, [key], [null_count(columns).asc(), *seq])


def last_record(df: DataFrame, key: str, date: str, status: str, columns: list[str], seq: list[str]) -> DataFrame:
    """The other policy: without any date the only row with a status, else the fewest nulls; else the latest date."""
    w = Window.partitionBy(key)
    dated, with_status = F.count(date).over(w), F.count(status).over(w)
    df = df.withColumn("_dated", dated).withColumn("_status", with_status).withColumn("_nulls", null_count(columns))
    only = F.when((F.col("_dated") == 0) & (F.col("_status") == 1), F.col(status).isNull().cast("int")).otherwise(0)
    order = [F.col(date).desc_nulls_last(), only.asc(), F.when(F.col("_dated") == 0, F.col("_nulls")).asc(), *[F.col(s).asc() for s in seq]]
    return first_per_key(df, [key], order).drop("_dated", "_status", "_nulls")


def mark_duplicates(df: DataFrame, keys: list[Column], name: str = "duplicate", only: Column | None = None) -> DataFrame:
    """Flags all rows whose keys occur more than once; null keys are equal. Rows where ``only``, which the keys must decide, isn't true are never flagged.

    Keys are counted by partial sums and joined back, so a key that many rows have is one row, and
    a join that Spark can split.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    held = df.withColumns({n: F.when(F.lit(True) if only is None else F.coalesce(only, F.lit(False)), F.struct(k.alias("k"))) for n, k in zip(names, keys, strict=True)})
    twice = held.where(" and ".join(f"{n} is not null" for n in names)).groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").withColumn("_hit", F.lit(True)).drop("_n")
    return held.join(twice, names, "left").withColumn(name, F.coalesce("_hit", F.lit(False))).select(*df.columns, name)


def device_offsets(df: DataFrame, device: str, fid: str) -> DataFrame:
    """Per device the sum of the largest ids of the devices before it, by name: a row per device."""
    top = df.groupBy(device).agg(F.max(fid).alias("_top"))
    w = Window.orderBy(device).rowsBetween(Window.unboundedPreceding, -1)  # over a row per device
    return top.select(device, F.coalesce(F.sum("_top").over(w), F.lit(0)).cast("long").alias("offset"))


def union_devices(frames: list[DataFrame]) -> DataFrame:
    """All rows of all devices, which must have the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def add_offsets(df: DataFrame, offsets: DataFrame, device: str, ids: list[str]) -> DataFrame:
    shifted = df.join(offsets, device, "left")
    return shifted.select(*[(F.col(c) + F.coalesce("offset", F.lit(0))).alias(c) if c in ids else F.col(c) for c in df.columns])


def number_rows(df: DataFrame, order: list[Column], name: str, start: Column | int = 1) -> DataFrame:
    """Numbers rows from ``start`` in a total order, without one task that sees all rows.

    Rows are range-partitioned and sorted, and each partition's first number is the count of
    rows before it: a table of a row per partition.
    """
    ranged = saved(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id()))
    part, within = F.shiftright("_m", 33), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    out = ranged.withColumn("_p", part).join(F.broadcast(before), "_p")
    number = (F.col("_before") + within + (F.lit(start) if isinstance(start, int) else start)).cast("long")
    return out.withColumn(name, number).drop("_m", "_p", "_before")


def rekey_duplicates(df: DataFrame, fid: str, order: list[Column], total: list[Column], base: int = 5000, above_all: bool = False) -> DataFrame:
    """The first row of each id keeps it; the others get base + 1, base + 2, ... above_all: start above the largest id."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(fid).orderBy(*order)))
    keep, other = ranked.where("_rank = 1").drop("_rank"), ranked.where("_rank > 1").drop("_rank")
    if above_all:
        base = max(base, df.agg(F.max(fid)).first()[0] or 0)
    new = number_rows(other, total, "_new", base + 1)
    return keep.unionByName(new.withColumn(fid, F.col("_new")).drop("_new").select(keep.columns))


def relink(children: DataFrame, parent: str, ids: DataFrame, old: str, new: str) -> DataFrame:
    """children with ``parent`` mapped from old to new ids; null where the parent is gone."""
    renamed = ids.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    return children.join(renamed, children[parent] == F.col("_old"), "left").select(*[F.col("_new").alias(c) if c == parent else children[c] for c in children.columns])


def without_keys(df: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """Rows whose key is not among the others'; null matches null. A hash or merge join, not a nested loop."""
    keys = other.select(F.col(other_key).alias("_k")).distinct()
    return df.join(keys, df[key].eqNullSafe(F.col("_k")), "left_anti")
