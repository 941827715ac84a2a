"""Progress and counts."""

from __future__ import annotations

from arborlens.config import CREW_COLOURS, UNMEASURED_COLOUR
from arborlens.functions import errors
from arborlens.operators.records import number_rows
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def progress(df: DataFrame, visited: str, places: int = 2) -> DataFrame:
    """Rows, visited rows (not null) and their percentage."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count(visited).alias("visited")).withColumn("percent", F.round(100 * F.col("visited") / F.col("total"), places))


def error_count(df: DataFrame, dbh: str = "dbh", status: str = "status", codes: str = "error_codes") -> DataFrame:
    return df.agg(F.count_if(F.col(dbh).isNotNull() & F.col(status).isNotNull() & errors.has_error(F.col(codes))).alias("error_count"))


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value; null is no value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def with_group_count(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows with the count of their value; rows of null go. The counts are aggregated before the join, so a frequent value is one row of them."""
    return df.join(counts_by(df, column).withColumnRenamed("n", name), column)


def code_counts(df: DataFrame, codes: str = "error_codes") -> DataFrame:
    return df.select(F.explode(codes).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def flag_counts(df: DataFrame, flag: str) -> DataFrame:
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("n"))


def crew_colour(crew: Column, dbh: Column) -> Column:
    out = F.when(dbh.isNull(), UNMEASURED_COLOUR)
    for name, colour in CREW_COLOURS.items():
        out = out.when(crew == name, colour)
    return out


def palette(place: Column, n: Column) -> Column:
    """The colour, as #RRGGBB, of a place 0 .. n - 1 on a ramp of heat: red over orange to yellow for the first three quarters, and from there to pale yellow."""
    pale = F.floor(n / 4)
    warm = n - pale
    byte = lambda share: F.lpad(F.hex(F.floor(share * 255 + 0.5).cast("long")), 2, "0")
    green = F.when(place >= warm, 1.0).when(warm > 1, place / F.greatest(warm - 1, F.lit(1))).otherwise(0.0)
    blue = F.when(place >= warm, (2 * (place - warm) + 1) / (2 * F.greatest(pale, F.lit(1)))).otherwise(0.0)
    return F.concat(F.lit("#FF"), byte(green), byte(blue))


def counts_with_colour(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value with its colour on the ramp, in the order of values: the bars of a chart, and by a join the points of a map.

    Values are numbered by ranges, so even a column with as many values as rows is no one task's work.
    """
    placed = number_rows(counts_by(df, column), [F.col(column).asc()], "place", 0)
    return placed.join(F.broadcast(placed.agg(F.count(F.lit(1)).alias("_n")))).withColumn("colour", palette(F.col("place"), F.col("_n"))).drop("_n")  # one row beside the others


def metrics(df: DataFrame, dbh: str = "dbh", status: str = "status", codes: str = "error_codes", crew: str = "crew", flags: tuple[str, ...] = ("duplicated_xy", "outside_boundary", "is_new_record")) -> DataFrame:
    """All numbers of a report as one frame (metric, key, n), from one pass over the rows and one exchange of their sums.

    ``total``, ``visited`` (a diameter) and ``errors`` (visited, with a status and an error) have no key and
    are there even for an empty table; ``code`` counts rows of each error, ``crew`` visited rows of each
    crew, ``status`` rows of each status, ``flag`` rows for which a flag holds. Columns that are missing
    give no rows; null is no value.
    """
    has = set(df.columns)
    of = lambda metric, key: F.struct(F.lit(metric).alias("metric"), key.cast("string").alias("key"))
    seen = F.col(dbh).isNotNull() if dbh in has else F.lit(False)
    none = F.lit(None)
    held = [of("total", none), F.when(seen, of("visited", none))]
    if {dbh, status, codes} <= has:
        held.append(F.when(seen & F.col(status).isNotNull() & errors.has_error(F.col(codes)), of("errors", none)))
    if status in has:
        held.append(F.when(F.col(status).isNotNull(), of("status", F.col(status))))
    if crew in has:
        held.append(F.when(seen & F.col(crew).isNotNull(), of("crew", F.col(crew))))
    held += [F.when(F.col(flag), of("flag", F.lit(flag))) for flag in flags if flag in has]
    counted = F.filter(F.array(*held), lambda s: s.isNotNull())
    if codes in has:
        counted = F.concat(counted, F.transform(F.coalesce(F.col(codes), F.array().cast("array<string>")), lambda c: of("code", c)))
    each = df.select(F.explode(counted).alias("m")).select("m.metric", "m.key", F.lit(1).cast("long").alias("n"))
    zero = df.sparkSession.createDataFrame([(m, None, 0) for m in ("total", "visited", "errors")], each.schema)
    return each.unionByName(zero).groupBy("metric", "key").agg(F.sum("n").alias("n"))


def render_template(text: str, values: dict[str, object]) -> str:
    """The text with each placeholder replaced."""
    for name, value in values.items():
        text = text.replace(name, str(value))
    return text
