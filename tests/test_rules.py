from datetime import datetime

import pytest
from arborlens.config import Census
from arborlens.operators import rules
from arborlens.plans import census_run
from pyspark.sql import functions as F

STANDING = "fid long, uuid string, species string, species_o string, status string, status_old string, dbh double, dbh_old double, multi_stem string, tree_id long, stem_id int, tag int, date timestamp_ntz, collision string, x double, y double, device string, seq long"


def tree(i, **changes):
    row = dict(fid=i, uuid=f"u{i}", species="FASY", species_o="FASY", status="AI", status_old="AI", dbh=200.0, dbh_old=190.0, multi_stem="MLT", tree_id=1000 + i, stem_id=1, tag=10 + i, date=None, collision=None, x=100.0 * i, y=0.0, device="a", seq=i)
    return row | changes


def codes(spark, *changes, profile=("core",), verified=None):
    rows = [tree(i, **c) for i, c in enumerate(changes)]
    standing = spark.createDataFrame([tuple(r.values()) for r in rows], STANDING)
    lying = spark.createDataFrame([], "fid long, tree_id long, stem_id int, piece_id string")
    result = census_run.check(standing, lying, Census(profile=profile), verified=verified)
    return [[c[:3] for c in r.error_codes] for r in result.standing.orderBy("fid").collect()]


@pytest.mark.parametrize(
    ("row", "expected"),
    [
        (dict(species="FASY", species_o="ABAL"), ["203"]),
        (dict(species_o=None), []),
        (dict(status_old="DB"), ["308"]),
        (dict(status=None, status_old="DB"), []),
        (dict(multi_stem="SGL", stem_id=2), ["310"]),
        (dict(multi_stem="SGL", stem_id=1), []),
        (dict(status="DI", status_old="DB"), ["311"]),
        (dict(status="DI", status_old="DU"), ["312"]),
        (dict(dbh_old=200.0, dbh=180.0), ["313"]),
        (dict(dbh_old=200.0, dbh=None), []),
        (dict(dbh_old=100.0, dbh=250.0), []),
        (dict(dbh_old=100.0, dbh=251.0), ["314"]),
        (dict(status="DB", status_old="DI", dbh_old=200.0, dbh=180.0), []),
        (dict(dbh_old=200.0, dbh=180.0, collision="Shrinking"), []),
        (dict(dbh_old=200.0, dbh=180.0, collision="Increase"), ["313"]),
    ],
)
def test_one_row_rules(spark, row, expected):
    assert codes(spark, row) == [expected]


def test_rules_over_two_rows(spark):
    assert codes(spark, dict(tree_id=5), dict(tree_id=5)) == [["403"], ["403"]]
    assert codes(spark, dict(tree_id=0), dict(tree_id=0)) == [["403"], ["403"]]
    assert codes(spark, dict(tree_id=None), dict(tree_id=None)) == [[], []]
    assert codes(spark, dict(x=0.0, y=0.0), dict(x=0.005, y=0.0)) == [["002"], ["002"]]
    assert codes(spark, dict(x=0.0, y=0.0), dict(x=0.02, y=0.0)) == [[], []]
    assert codes(spark, dict(x=None, y=None), dict(x=None, y=None)) == [["002"], ["002"]]


def test_site_tags(spark):
    site = ("core", "site_tags")
    assert codes(spark, dict(tag=1501), profile=site) == [["606"]]
    assert codes(spark, dict(tag=None), profile=site) == [["606", "607"]]
    assert codes(spark, dict(tag=7), dict(tag=7), profile=site) == [["608"], ["608"]]
    assert codes(spark, dict(tag=None, status="DB", status_old="DI"), dict(tag=None, status="DB", status_old="DI"), profile=site) == [["606"], ["606"]]


def test_verified_rows_have_no_codes(spark):
    verified = spark.createDataFrame([("u0",), (None,)], "uuid string")
    assert codes(spark, dict(dbh_old=200.0, dbh=180.0), dict(dbh_old=200.0, dbh=180.0), verified=verified) == [[], ["313"]]


def test_lying_rules(spark):
    rows = [(1, 123456, 1, "x"), (2, 12345, 1, "x"), (3, None, 2, "x"), (4, 100000, 1, "x"), (5, 111111, 1, "a"), (6, 111111, 1, "A"), (7, None, None, None), (8, None, None, None)]
    lying = spark.createDataFrame(rows, "fid long, tree_id long, stem_id int, piece_id string")
    checked, skipped = rules.evaluate(lying, Census(), "lying")
    got = {r.fid: [c[:3] for c in r.error_codes] for r in checked.collect()}
    assert skipped == []
    assert got == {1: [], 2: ["401"], 3: ["401"], 4: [], 5: ["402"], 6: ["402"], 7: ["401", "402"], 8: ["401", "402"]}


def test_errors_view_and_skipped_rules(spark):
    df = spark.createDataFrame([(1, "AI", 251.0, 100.0, 0.0, 0.0), (2, None, 251.0, 100.0, 0.0, 0.0), (3, "AI", None, 100.0, 0.0, 0.0)], "fid int, status string, dbh double, dbh_old double, x double, y double")
    checked, skipped = rules.evaluate(df, Census())
    rows = rules.errors_view(checked).collect()
    assert [(r.error, r.solved) for r in rows] == [("314_prirust_nad_150mm", False)]
    assert any(c.startswith("203") for c in skipped)
    assert rules.errors_view(checked.limit(0)).columns == ["error", "x", "y", "solved"]


def test_tag_table(spark):
    table = spark.createDataFrame([(13, 5), (14, 6)], "QuadratID int, TagID int")
    df = spark.createDataFrame([("13", 5), ("13", 6), ("14", 6), ("13", None), (None, 5)], "tag_prefix string, tag int")
    got = [(r.tag_prefix, r.tag, r.tag_known) for r in rules.with_tag_known(df, table).collect()]
    assert sorted(got, key=str) == sorted([("13", 5, True), ("13", 6, False), ("14", 6, False), ("13", None, True), (None, 5, False)], key=str)


def at(day):
    return datetime(2024, 1, day)


def test_merge(spark):
    rows = [
        tree(1, uuid="u1", date=at(1)), tree(2, uuid="u1", date=at(2)),
        tree(3, uuid="u2", date=at(3)), tree(4, uuid="u2", date=at(3)),
        tree(5, uuid="u3", date=None, dbh=1.0), tree(6, uuid="u3", date=at(1), dbh=9.0),
        tree(7, uuid="u4", dbh=30.0), tree(8, uuid="u4", dbh=10.0),
        tree(9, uuid="u5", dbh=None), tree(10, uuid="u5", dbh=11.0),
        tree(1, uuid=None, date=at(4), device="b", seq=11), tree(2, uuid=None, date=at(5), device="b", seq=12),
        tree(3, uuid="u7", date=at(6), device="b", seq=13, dbh_old=None),
        tree(1, uuid="u8", date=at(7), device="c", seq=14),
    ]
    standing = spark.createDataFrame([tuple(r.values()) for r in rows], STANDING)
    lying_rows = [
        (4, "l1", 3, at(1), b"g1", "b", 20), (4, "l2", 1, at(2), b"g2", "a", 21), (14, "l3", 2, at(3), b"g3", "a", 22), (4, "l4", 2, at(2), b"g1", "b", 23), (14, "l5", 2, at(9), b"g5", "a", 24),
    ]
    lying = spark.createDataFrame(lying_rows, "fid long, uuid string, id_point long, date timestamp_ntz, geom_wkb binary, device string, seq long")
    kept, fallen = census_run.merge(standing, lying)
    got = kept.orderBy("fid").collect()
    assert [r.fid for r in got] == list(range(1, len(got) + 1))
    assert [r.seq for r in got] == [14, 13, 12, 3, 2, 6, 8, 10]
    assert [r.is_new_record for r in got][1] is True
    by_seq = {r.seq: r for r in fallen.collect()}
    # device b's ids move by 10; the child of u1's older record has no parent now
    assert by_seq[21].id_point is None and by_seq[22].id_point == 5
    assert by_seq[23].seq == 23 and 20 not in by_seq
    fids = sorted(r.fid for r in by_seq.values())
    assert fids == [4, 14, 5001, 5002]


def test_result_layers(spark):
    standing = spark.createDataFrame([tuple(tree(i, **c).values()) for i, c in enumerate([dict(dbh_old=100.0, dbh=251.0), dict()])], STANDING)
    lying = spark.createDataFrame([(1, "l", None, 123456, 1, "a", None, b"g", "a", 1), (1, "m", None, 123457, 1, None, None, b"h", "a", 2)], "fid long, uuid string, id_point long, tree_id long, stem_id int, piece_id string, date timestamp_ntz, geom_wkb binary, device string, seq long")
    result = census_run.check(standing, lying)
    assert "error_codes" not in result.standing_layer().columns
    assert result.errors_layer().count() == 1
    assert [r.uuid for r in result.lying_layer().collect()] == ["l"]
    row = result.progress().first()
    assert (row.total, row.visited, row.percent, row.error_count) == (2, 2, 100.0, 1)


def test_only_signed_records_give_their_week_an_author(spark):
    from arborlens.operators.authors import infer_authors

    day = lambda n: datetime(2024, 5, n)  # noqa: E731  the 6th is a Monday
    rows = [(1, None, day(6)), (5, "B", day(7)), (10, "A", day(6)), (20, None, day(8)), (30, None, day(20)), (31, None, None)]
    got = infer_authors(spark.createDataFrame(rows, "seq long, crew string, date timestamp_ntz")).collect()
    assert {r.seq: r.crew for r in got} == {1: "A", 5: "B", 10: "A", 20: "B", 30: "unknown_mapper", 31: "unknown_mapper"}
