"""The census from device records to published layers, as one lineage of DataFrames.

merge -> latest records -> numbering and links -> rules -> verified exceptions -> layers.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from arborlens.config import Census
from arborlens.functions import errors
from arborlens.functions.geometry import Ring, within_buffer
from arborlens.operators import naming, records, reports, rules, spatial
from arborlens.sources.gpkg import read_gpkg, sequenced, write_gpkg
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("arborlens.census")


@dataclass(frozen=True)
class Step:
    """A line of the run's log: what ran, whether it was ``done``, ``skipped`` (columns are missing) or ``failed``, and why."""

    name: str
    state: str = "done"
    reason: str = ""


@dataclass
class Result:
    """Checked tables in the library's words; layers bear the site's names."""

    standing: DataFrame
    lying: DataFrame
    skipped_rules: list[str] = field(default_factory=list)
    census: Census = field(default_factory=Census)
    steps: list[Step] = field(default_factory=list)

    def standing_layer(self) -> DataFrame:
        return naming.to_site(self.standing.drop("error_codes", "error", "is_new_record", "duplicated_xy", "outside_boundary"), self.census)

    def errors_layer(self) -> DataFrame:
        return rules.errors_view(self.standing)

    def lying_layer(self) -> DataFrame:
        columns = [c for c in self.lying.columns if c not in ("error_codes", "error", "count_na", "seq")]
        return naming.to_site(records.most_complete(self.lying, "fid", columns, [F.col("seq").asc()]).drop("error_codes", "error", "count_na"), self.census)

    def metrics(self) -> DataFrame:
        """The report's numbers as one frame (metric, key, n)."""
        return reports.metrics(self.standing)

    def log(self) -> DataFrame:
        """The steps in their order, a row each."""
        rows = [(i, s.name, s.state, s.reason) for i, s in enumerate(self.steps)]
        return self.standing.sparkSession.createDataFrame(rows, "step int, name string, state string, reason string")

    def progress(self) -> DataFrame:
        return reports.progress(self.standing, "dbh").join(F.broadcast(reports.error_count(self.standing)))  # one row beside another


def merge(standing: DataFrame, lying: DataFrame, device: str = "device") -> tuple[DataFrame, DataFrame]:
    """Latest records of all devices with new ids 1..n, and lying records whose parents carry these.

    Ids of each device are first moved above those of the devices before it. Lying rows whose
    parent was dropped have a null parent; their number changes only by the choice of latest rows.
    """
    offsets = records.saved(records.device_offsets(standing, device, "fid"))
    standing = records.add_offsets(standing, offsets, device, ["fid"])
    lying = records.add_offsets(lying.drop("count_na"), offsets, device, ["fid", "id_point"])
    latest = records.latest_or_smallest(standing, "uuid", "date", "dbh", ["seq"]).withColumn("is_new_record", F.col("dbh_old").isNull())
    undated = F.col("date").isNull()
    order = [undated.asc(), F.col("date").desc_nulls_last(), F.when(undated, F.col("dbh")).asc_nulls_last(), F.col("seq").asc()]
    numbered = records.saved(records.number_rows(latest, order, "_new"))
    lying = records.latest_then_distinct(lying, ["uuid"], "geom_wkb", "date", ["seq"])
    lying = records.relink(lying, "id_point", numbered.select(F.col("fid").alias("_f"), "_new"), "_f", "_new")
    lying = records.rekey_duplicates(lying, "fid", [F.col("date").asc_nulls_last(), F.col("seq").asc()], [F.col("date").asc_nulls_last(), F.col("fid").asc(), F.col("seq").asc()])
    return numbered.withColumn("fid", F.col("_new")).drop("_new"), lying


def check(standing: DataFrame, lying: DataFrame, census: Census | None = None, boundary: Ring | None = None, verified: DataFrame | None = None) -> Result:
    """Runs all rules of the profile and clears verified exceptions.

    Each step is independent: one that can't be planned (a column of the wrong kind, say) is logged as failed
    and leaves its table as it was, and the others go on. Rules without their columns are skipped and listed.
    """
    census = census or Census()
    steps: list[Step] = []

    def attempt(name: str, step: Callable[[DataFrame], DataFrame], df: DataFrame) -> DataFrame:
        try:
            out = step(df)
            out.schema  # noqa: B018  (plans the step, so that its errors show here)
        except AnalysisException as e:
            reason = (str(e).splitlines() or [""])[0]
            log.error("step failed: %s: %s", name, reason)
            steps.append(Step(name, "failed", reason))
            return df
        log.info("step done: %s", name)
        steps.append(Step(name))
        return out

    def ruled(df: DataFrame, table: str) -> DataFrame:
        """The rules of each group are a step; groups run in the order in which the registry lists them."""
        for group in dict.fromkeys(r.group for r in rules.RULES if r.table == table and r.group in census.profile):
            chosen = [r for r in rules.RULES if r.table == table and r.group == group]
            lacking = {r.code: sorted(set(r.requires) - set(df.columns)) for r in chosen}
            df = attempt(f"rules {group}, {table}", lambda d, c=chosen: rules.evaluate(d, census, table, c)[0], df)
            steps.extend(Step(code, "skipped", f"no column {', '.join(names)}") for code, names in lacking.items() if names)
        return df if "error_codes" in df.columns else df.withColumn("error_codes", F.array().cast("array<string>"))

    if {"x", "y"} <= set(standing.columns):
        axes = [a for a in ("x", "y", "z") if a in standing.columns]
        standing = attempt("near points", lambda d: spatial.mark_near(d, axes, census.duplicate_distance, key="seq"), standing)
    if boundary and "boundary" in census.profile:
        standing = attempt("boundary", lambda d: d.withColumn("outside_boundary", ~within_buffer(F.col("x"), F.col("y"), boundary, census.boundary_buffer)), standing)
    standing, lying = ruled(standing, "standing"), ruled(lying, "lying")
    if "collision" in standing.columns:
        standing = attempt("verified collisions", rules.clear_collisions, standing)
    if verified is not None:
        standing = attempt("verified trees", lambda d: rules.clear_verified(d, verified, "uuid"), standing)
    skipped = [s.name for s in steps if s.state == "skipped"]
    for code in skipped:
        log.warning("rule skipped for lack of columns: %s", code)
    rendered = lambda df: df.withColumn("error", errors.render(F.col("error_codes")))
    return Result(rendered(standing), rendered(lying), skipped, census, steps)


def edited_on(df: DataFrame, days: list[str], date: str = "date") -> DataFrame:
    """Rows edited on one of the days (yyyy-MM-dd), for a report of a day's work."""
    return df.where(F.to_date(date).cast("string").isin(days))


def run(standing: DataFrame, lying: DataFrame, census: Census | None = None, **settings: object) -> Result:
    """From device records with the site's names to checked tables. Merging must succeed; checks are steps of their own."""
    census = census or Census()
    merged = merge(*(naming.to_library(df, census) for df in (standing, lying)))
    result = check(*merged, census, **settings)
    result.steps.insert(0, Step("merge"))
    return result


def run_site(spark: SparkSession, path: str, census: Census, **settings: object) -> Result:
    """The same from the site's layers in all GeoPackages below a path."""
    fid = dict(census.columns).get("fid", "fid")
    if fid.lower() != "fid":
        raise ValueError("a layer's row id is its fid")
    return run(*(sequenced(read_gpkg(spark, path, layer)) for layer in (census.standing_layer, census.lying_layer)), census, **settings)


def publish(result: Result, folder: str) -> None:
    """The three layers as files of their own below a mounted folder."""
    census = result.census
    for name, layer in ((census.standing_layer, result.standing_layer()), (census.lying_layer, result.lying_layer()), (census.errors_layer, result.errors_layer())):
        write_gpkg(layer, f"{folder.rstrip('/')}/{name}.gpkg", name)
