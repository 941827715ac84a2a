"""A site's own names, the run's log, and the report's numbers."""

import pytest
from arborlens.config import Census
from arborlens.operators import naming, reports
from arborlens.plans import census_run
from arborlens.sources.gpkg import read_gpkg, write_gpkg
from pyspark.sql import functions as F

STANDING = "fid long, uid string, drevina string, species_o string, stav string, status_old string, dbh double, dbh_old double, tree_id long, stem_id int, edited timestamp_ntz, x double, y double, date string"
LYING = "fid long, uid string, id_point long, tree_id long, stem_id int, piece_id string, edited timestamp_ntz, geom_wkb binary, date string"
NAMES = (("uuid", "uid"), ("species", "drevina"), ("status", "stav"), ("date", "edited"))


def standing_rows():
    rows = [(1, "a", "FASY", "ABAL", "AI", "AI", 200.0, 190.0, 100001, 1), (2, "b", "FASY", "FASY", "AI", "DB", 200.0, None, 100002, 1), (3, "c", "PIAB", None, "DI", "AI", None, 90.0, 100003, 1)]
    return [(*r, None, 10.0 * r[0], 0.0, f"note {r[0]}") for r in rows]


def test_names_go_and_come_back(spark):
    df = spark.createDataFrame(standing_rows(), STANDING)
    census = Census(columns=NAMES)
    inner = naming.to_library(df, census)
    assert {"uuid", "species", "status", "date", "_site_date"} <= set(inner.columns) and "edited" not in inner.columns
    assert inner.select("_site_date").first()[0] == "note 1"
    back = naming.to_site(inner.withColumn("edited", F.lit(1)), census)
    assert back.columns == [*df.columns, "_edited"] and back.drop("_edited").collect() == df.collect()
    # names that change places, other case, and a listed column that isn't there
    swap = Census(columns=(("dbh", "DBH_OLD"), ("dbh_old", "dbh"), ("height", "h")))
    turned = naming.to_library(df, swap)
    assert [(r.dbh, r.dbh_old) for r in turned.orderBy("fid").collect()] == [(190.0, 200.0), (None, 200.0), (90.0, None)] and "height" not in turned.columns
    assert [c.lower() for c in naming.to_site(turned, swap).columns] == df.columns
    for wrong in ((("dbh", "a"), ("DBH", "b")), (("dbh", "a"), ("height", "A"))):
        with pytest.raises(ValueError):
            Census(columns=wrong)


def test_site_from_files_to_files(spark, tmp_path):
    census = Census(columns=NAMES, standing_layer="S", lying_layer="L")
    # SQLite has no time without a zone: the layer holds text, which the run's orderings take as it is
    text = lambda s: s.replace("timestamp_ntz", "string")
    one, two = str(tmp_path / "in" / "one.gpkg"), str(tmp_path / "in2" / "one.gpkg")
    write_gpkg(spark.createDataFrame(standing_rows(), text(STANDING)), one, "S")
    write_gpkg(spark.createDataFrame([(1, "l", 2, 5, 1, "A", None, b"p", None)], text(LYING)), two, "L")
    frames = [read_gpkg(spark, p, layer).withColumn("seq", F.col("fid")) for p, layer in ((one, "S"), (two, "L"))]
    same = [f.withColumn("device", F.lit("d")) for f in frames]
    result = census_run.run(*same, census)
    assert {"uid", "drevina", "stav", "edited", "date"} <= set(result.standing_layer().columns) and not {"uuid", "species", "status"} & set(result.standing_layer().columns)
    shown = {r.uid: r.error for r in naming.to_site(result.standing, census).collect()}
    assert shown == {"a": "203_zmena_dreviny", "b": "308_Strom_obzivl", "c": ""}
    census_run.publish(result, str(tmp_path / "out"))
    again = read_gpkg(spark, str(tmp_path / "out" / "S.gpkg"), "S")
    assert sorted((r.uid, r.x, r.y, r.z) for r in again.collect()) == [("a", 10.0, 0.0, None), ("b", 20.0, 0.0, None), ("c", 30.0, 0.0, None)] and len(set(again.columns)) == len(again.columns)
    assert sorted(r.error for r in read_gpkg(spark, str(tmp_path / "out" / "ERRORS.gpkg"), "ERRORS").collect()) == ["203_zmena_dreviny", "308_Strom_obzivl"]
    assert read_gpkg(spark, str(tmp_path / "out" / "L.gpkg"), "L").count() == 1
    with pytest.raises(ValueError):
        census_run.run_site(spark, one, Census(columns=(("fid", "id"),)))


def test_log_names_what_failed_and_what_was_skipped(spark):
    df = spark.createDataFrame([(1, "FASY", "ABAL", ["7"])], "fid long, species string, species_o string, tag array<string>").withColumn("seq", F.col("fid"))
    lying = spark.createDataFrame([(1, 5, 1, "A")], "fid long, tree_id long, stem_id int, piece_id string")
    result = census_run.check(df, lying, Census(profile=("site_tags", "core")))
    log = {r["name"]: (r.state, r.reason) for r in result.log().collect()}
    assert log["rules core, standing"] == log["rules core, lying"] == ("done", "")
    assert log["rules site_tags, standing"][0] == "failed" and "DATATYPE_MISMATCH" in log["rules site_tags, standing"][1]
    assert log["308_Strom_obzivl"] == ("skipped", "no column status, status_old") and "308_Strom_obzivl" in result.skipped_rules
    # what failed took nothing with it
    assert result.standing.first()["error"] == "203_zmena_dreviny" and result.lying.first()["error"] == "401_chybne_strom_id"
    assert [r.step for r in result.log().orderBy("step").collect()] == list(range(len(log)))


def test_metrics(spark):
    rows = [("AI", 1.0, ["e1", "e2"], "Red", True), ("AI", None, ["e1"], "Red", None), (None, 2.0, ["e1"], None, False), ("DI", 3.0, None, "Blue", True), ("DI", 3.0, [], "Red", False)]
    df = spark.createDataFrame(rows, "status string, dbh double, error_codes array<string>, crew string, duplicated_xy boolean")
    got = {(r.metric, r.key): r.n for r in reports.metrics(df).collect()}
    assert got == {
        ("total", None): 5, ("visited", None): 4, ("errors", None): 1, ("status", "AI"): 2, ("status", "DI"): 2,
        ("crew", "Red"): 2, ("crew", "Blue"): 1, ("flag", "duplicated_xy"): 2, ("code", "e1"): 3, ("code", "e2"): 1,
    }
    empty = {("total", None): 0, ("visited", None): 0, ("errors", None): 0}
    assert {(r.metric, r.key): r.n for r in reports.metrics(df.where("false")).collect()} == empty
    assert {(r.metric, r.key): r.n for r in reports.metrics(spark.range(2)).collect()} == empty | {("total", None): 2}


@pytest.mark.parametrize(
    ("n", "colours"),
    [(0, []), (1, ["#FF0000"]), (2, ["#FF0000", "#FFFF00"]), (4, ["#FF0000", "#FF8000", "#FFFF00", "#FFFF80"]), (8, ["#FF0000", "#FF3300", "#FF6600", "#FF9900", "#FFCC00", "#FFFF00", "#FFFF40", "#FFFFBF"])],
)
def test_palette(spark, n, colours):
    df = spark.range(n).select(F.concat(F.lit("crew "), F.col("id")).alias("crew"))
    got = reports.counts_with_colour(df.union(df).union(df.limit(0)), "crew").orderBy("place").collect()
    assert [r.colour for r in got] == colours and all(r.n == 2 for r in got) and [r.place for r in got] == list(range(n))
