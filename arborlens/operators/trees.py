"""Trees of two clouds of the same plot: which are the same tree, which are gone and which are new."""

from __future__ import annotations

from arborlens.operators.points import XYZ, cell_of
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _of_tree(df: DataFrame, segment: str, name: str) -> DataFrame:
    """A row per tree: its points and its height."""
    held = df.where(F.col(segment).isNotNull()).groupBy(F.col(segment).alias(name))
    return held.agg(F.count(F.lit(1)).alias(f"n_{name}"), (F.max("z") - F.min("z")).alias(f"height_{name}"))


def _filled(df: DataFrame, segment: str, cell: float, name: str) -> DataFrame:
    """The voxels that each tree occupies, each once."""
    places = [cell_of(a, cell).alias(f"_v{a}") for a in XYZ]
    return df.where(F.col(segment).isNotNull()).select(F.col(segment).alias(name), *places).dropna().distinct()


def overlaps(first: DataFrame, second: DataFrame, cell: float, segment: str = "segment_id") -> DataFrame:
    """The voxels that a tree of the first cloud shares with one of the second, for pairs that share any.

    Points are reduced to distinct (voxel, tree) before the join, so a dense tree costs what it fills;
    pairs are as many as trees that meet in a voxel, which is for the cell to keep few.
    """
    keys = [f"_v{a}" for a in XYZ]
    met = _filled(first, segment, cell, "first").join(_filled(second, segment, cell, "second"), keys)
    return met.groupBy("first", "second").agg(F.count(F.lit(1)).alias("shared"))


def match(first: DataFrame, second: DataFrame, cell: float, segment: str = "segment_id") -> DataFrame:
    """A row per tree of either cloud: matched, gone (only in the first) or new (only in the second).

    Two trees are matched where each shares most voxels with the other; of equal ones the smaller id
    counts. ``likeliest`` is the tree of the other cloud that shares most with a gone or new one
    (null: it shares nothing), so trees that grew together or were cut apart by segmentation show.
    ``shared`` belongs to that pair; ``growth`` is the height in the second less that in the first.
    Points without tree count nowhere, those without coordinates fill no voxel. Ids of empty clouds don't occur.
    """
    pairs = overlaps(first, second, cell, segment)

    def best(of: str, other: str) -> Column:
        return F.row_number().over(Window.partitionBy(of).orderBy(F.desc("shared"), F.asc(other)))

    ranked = pairs.withColumns({"_of_first": best("first", "second"), "_of_second": best("second", "first")})
    # a pair that is the best of both is one row of both; any other belongs to one side alone
    sides = F.filter(
        F.array(
            F.when(F.col("_of_first") == 1, F.struct(F.lit(1).alias("side"), F.col("first").alias("tree"), F.col("second").alias("likeliest"))),
            F.when(F.col("_of_second") == 1, F.struct(F.lit(2).alias("side"), F.col("second").alias("tree"), F.col("first").alias("likeliest"))),
        ),
        lambda s: s.isNotNull(),
    )
    mutual = (F.col("_of_first") == 1) & (F.col("_of_second") == 1)
    found = ranked.select("shared", mutual.alias("mutual"), F.explode(sides).alias("s")).select("shared", "mutual", "s.*")
    of = lambda side: found.where(F.col("side") == side).drop("side")
    a, b = _of_tree(first, segment, "first"), _of_tree(second, segment, "second")
    old = a.join(of(1).withColumnRenamed("tree", "first"), "first", "left").withColumn("mutual", F.coalesce("mutual", F.lit(False)))
    new = b.join(of(2).withColumnRenamed("tree", "second"), "second", "left").withColumn("mutual", F.coalesce("mutual", F.lit(False)))
    both = old.where("mutual").join(b, F.col("likeliest") == F.col("second")).select(F.lit("matched").alias("state"), "first", "second", F.lit(None).cast(a.schema["first"].dataType).alias("likeliest"), "shared", "n_first", "n_second", (F.col("height_second") - F.col("height_first")).alias("growth"))
    gone = old.where("not mutual").select(F.lit("gone").alias("state"), "first", "likeliest", F.coalesce("shared", F.lit(0).cast("long")).alias("shared"), "n_first", F.lit(0).cast("long").alias("n_second"))
    come = new.where("not mutual").select(F.lit("new").alias("state"), "second", "likeliest", F.coalesce("shared", F.lit(0).cast("long")).alias("shared"), F.lit(0).cast("long").alias("n_first"), "n_second")
    return both.unionByName(gone, allowMissingColumns=True).unionByName(come, allowMissingColumns=True)
