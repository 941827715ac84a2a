"""The census and point-cloud operators over the driver's tables, each with the same query in SQL.

The tables hold no census, so other columns stand in: order status for a device or status,
price for diameter, the order before for the census before. Nulls are derived, as the tables
have none; numbers that may be null are doubles in results. Ties are broken by columns that make the order total.
"""

from __future__ import annotations

from collections.abc import Callable

from arborlens.config import Census
from arborlens.functions import errors, geometry
from arborlens.functions.text import base_name, between_any, normal_name, six_digits
from arborlens.operators import authors, points, records, reports, spatial
from arborlens.operators.rules import RULES, clear_verified, evaluate, with_tag_known
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINE_ORDER = ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
LINE_SQL = ", ".join(LINE_ORDER)

# --- records -------------------------------------------------------------------------------


@query("""SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r = 1""")
def latest_per_key(spark, d):
    return records.first_per_key(read(spark, d, "orders"), ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc()])


@query("""WITH t AS (SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS edited FROM orders),
a AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY edited DESC, o_orderkey) AS r FROM t WHERE edited IS NOT NULL),
b AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice ASC NULLS LAST, o_orderkey) AS r FROM t WHERE o_custkey NOT IN (SELECT o_custkey FROM a))
SELECT * EXCLUDE r FROM a WHERE r = 1 UNION ALL SELECT * EXCLUDE r FROM b WHERE r = 1""")
def latest_with_fallback(spark, d):
    t = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate")).alias("edited"))
    return records.latest_or_smallest(t, "o_custkey", "edited", "o_totalprice", ["o_orderkey"])


@query("""WITH a AS (SELECT *, row_number() OVER (PARTITION BY source, lang, n_chars ORDER BY doc_id DESC) AS r FROM documents),
b AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) AS q FROM a WHERE r = 1) SELECT doc_id, source, lang, n_chars FROM b WHERE q = 1""")
def dedupe_two_step(spark, d):
    docs = read(spark, d, "documents").withColumn("place", F.xxhash64("text"))
    return records.latest_then_distinct(docs, ["source", "lang", "n_chars"], "text", "doc_id", ["doc_id"]).select("doc_id", "source", "lang", "n_chars")


_HOLES = """SELECT l_orderkey, l_shipdate, l_partkey, l_suppkey, l_extendedprice, nullif(l_linenumber, 1)::DOUBLE AS a, nullif(l_returnflag, 'N') AS b, nullif(l_linestatus, 'O') AS c, l_quantity, l_discount, l_tax FROM lineitem"""


@query(f"""WITH t AS ({_HOLES}) SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, a, b, c FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
(a IS NULL)::INT + (b IS NULL)::INT + (c IS NULL)::INT, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) AS r FROM t) WHERE r = 1""")
def most_complete(spark, d):
    t = read(spark, d, "lineitem").withColumns({"a": F.nullif("l_linenumber", F.lit(1)).cast("double"), "b": F.nullif("l_returnflag", F.lit("N")), "c": F.nullif("l_linestatus", F.lit("O"))})
    order = [F.col(c).asc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")]
    return records.most_complete(t, "l_orderkey", ["a", "b", "c"], order).select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "a", "b", "c")


@query("""WITH t AS (SELECT o_orderkey, o_custkey AS k, nullif(o_orderstatus, 'P') AS status, CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS edited FROM orders),
w AS (SELECT *, count(edited) OVER (PARTITION BY k) AS dated, count(status) OVER (PARTITION BY k) AS st FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY edited DESC NULLS LAST, CASE WHEN dated = 0 AND st = 1 THEN (status IS NULL)::INT ELSE 0 END, CASE WHEN dated = 0 THEN (status IS NULL)::INT + (edited IS NULL)::INT END NULLS FIRST, o_orderkey) AS n FROM w)
SELECT o_orderkey, k, status, edited FROM r WHERE n = 1""")
def last_record(spark, d):
    t = read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate")).alias("edited"))
    return records.last_record(t, "k", "edited", "status", ["status", "edited"], ["o_orderkey"])


@query("""WITH m AS (SELECT o_orderstatus AS device, max(o_orderkey) AS top FROM orders GROUP BY 1),
f AS (SELECT device, coalesce(sum(top) OVER (ORDER BY device ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM m)
SELECT o_orderstatus AS device, o_orderkey + off AS fid, o_custkey FROM orders JOIN f ON device = o_orderstatus""")
def union_offset_devices(spark, d):
    orders = read(spark, d, "orders").select(F.col("o_orderstatus").alias("device"), F.col("o_orderkey").alias("fid"), "o_custkey")
    merged = records.union_devices([orders.where(F.col("device") == s) for s in ("F", "O", "P")])
    return records.add_offsets(merged, records.device_offsets(merged, "device", "fid"), "device", ["fid"])


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_totalprice, o_orderkey) AS fid FROM orders")
def renumber(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return records.number_rows(orders, [F.col("o_orderdate").desc_nulls_last(), F.col("o_totalprice").asc_nulls_last(), F.col("o_orderkey").asc()], "fid").select("o_orderkey", "fid")


@query(f"""WITH t AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_SQL}) AS r FROM lineitem)
SELECT l_orderkey AS fid, l_partkey, l_suppkey, l_extendedprice FROM t WHERE r = 1 UNION ALL
SELECT 5000 + row_number() OVER (ORDER BY l_orderkey, {LINE_SQL}), l_partkey, l_suppkey, l_extendedprice FROM t WHERE r > 1""")
def rekey_duplicates(spark, d):
    t = read(spark, d, "lineitem").withColumn("fid", F.col("l_orderkey"))
    order = [F.col(c).asc_nulls_last() for c in LINE_ORDER]
    return records.rekey_duplicates(t, "fid", order, [F.col("l_orderkey").asc(), *order]).select("fid", "l_partkey", "l_suppkey", "l_extendedprice")


@query("""WITH kept AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS fid FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r = 1)
SELECT k.fid::DOUBLE AS id_point, l_partkey, l_linenumber, l_extendedprice FROM lineitem LEFT JOIN kept k ON l_orderkey = k.o_orderkey""")
def relink_children(spark, d):
    kept = latest_per_key(spark, d).select("o_orderkey")
    ids = records.number_rows(kept, [F.col("o_orderkey").asc()], "fid")
    children = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("id_point"), "l_partkey", "l_linenumber", "l_extendedprice")
    return records.relink(children, "id_point", ids, "o_orderkey", "fid").withColumn("id_point", F.col("id_point").cast("double"))


@query("""WITH c AS (SELECT nullif(c_custkey, 7) AS k, c_name FROM customer), o AS (SELECT DISTINCT CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey END AS k FROM orders)
SELECT k, c_name FROM c WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.k IS NOT DISTINCT FROM c.k)""")
def anti_null_safe(spark, d):
    c = read(spark, d, "customer").select(F.nullif("c_custkey", F.lit(7).cast("bigint")).alias("k"), "c_name")
    o = read(spark, d, "orders").select(F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("ok"))
    return records.without_keys(c, o, "k", "ok")


@query("SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, (o_orderdate IS NULL)::INT + (nullif(o_orderstatus, 'P') IS NULL)::INT AS nulls FROM orders")
def row_null_count(spark, d):
    t = read(spark, d, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return t.select("o_orderkey", "status", records.null_count(["o_orderdate", "status"]).alias("nulls"))


@query("SELECT o_custkey AS fid, c_name FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 100000 AND o_orderstatus IN ('F', 'P')")
def projection_filter(spark, d):
    """Keep-list projection, membership and range predicates that reach the scan."""
    o = read(spark, d, "orders").where((F.col("o_totalprice") > 100000) & F.coalesce(F.col("o_orderstatus").isin("F", "P"), F.lit(False))).select(F.col("o_custkey").alias("fid"))
    return o.join(read(spark, d, "customer").select(F.col("c_custkey").alias("fid"), "c_name"), "fid")


# --- rules ---------------------------------------------------------------------------------


def _census(spark, d):
    """Orders as standing trees: the customer's order before is the census before."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = read(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("fid"),
        F.col("o_custkey").alias("tree_id"),
        F.when(F.col("o_orderstatus") == "F", "AI").when(F.col("o_orderstatus") == "O", "DI").alias("status"),
        F.lag(F.when(F.col("o_orderstatus") == "F", "DB").when(F.col("o_orderstatus") == "O", "DU").otherwise("AI")).over(w).alias("status_old"),
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice") / 100).alias("dbh"),
        (F.lag("o_totalprice").over(w) / 100).alias("dbh_old"),
        F.substring("o_orderpriority", 1, 1).alias("species"),
        F.lag(F.substring("o_orderpriority", 1, 1)).over(w).alias("species_o"),
        F.when(F.col("o_orderkey") % 2 == 0, "SGL").otherwise("MLT").alias("multi_stem"),
        (F.col("o_orderkey") % 3).cast("int").alias("stem_id"),
        F.when(F.col("o_orderkey") % 4 == 0, "Shrinking").when(F.col("o_orderkey") % 4 == 1, "Increase").when(F.col("o_orderkey") % 4 == 2, "Species").alias("collision"),
        F.col("o_totalprice").alias("x"),
        F.col("o_orderkey").cast("double").alias("y"),
    )


_CENSUS_SQL = """WITH w AS (SELECT o_orderkey AS fid, o_custkey AS tree_id, CASE o_orderstatus WHEN 'F' THEN 'AI' WHEN 'O' THEN 'DI' END AS status,
lag(CASE o_orderstatus WHEN 'F' THEN 'DB' WHEN 'O' THEN 'DU' ELSE 'AI' END) OVER v AS status_old, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice / 100 END AS dbh, lag(o_totalprice) OVER v / 100 AS dbh_old,
substr(o_orderpriority, 1, 1) AS species, lag(substr(o_orderpriority, 1, 1)) OVER v AS species_o, CASE WHEN o_orderkey % 2 = 0 THEN 'SGL' ELSE 'MLT' END AS multi_stem, o_orderkey % 3 AS stem_id,
CASE o_orderkey % 4 WHEN 0 THEN 'Shrinking' WHEN 1 THEN 'Increase' WHEN 2 THEN 'Species' END AS collision, o_totalprice AS x, o_orderkey::DOUBLE AS y
FROM orders WINDOW v AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
r AS (SELECT *,
CASE WHEN count(*) OVER (PARTITION BY tree_id, stem_id) > 1 AND tree_id IS NOT NULL THEN '403_stojici_duplicita_STROM_ID-KMEN_ID' END AS e403,
CASE WHEN species <> species_o THEN '203_zmena_dreviny' END AS e203,
CASE WHEN status IN ('AI','AB','DAB','AL','ALM','AU','AC') AND status_old IN ('DB','DI','DU','SH','DP','NN','NIC','BLS') THEN '308_Strom_obzivl' END AS e308,
CASE WHEN multi_stem = 'SGL' AND stem_id > 1 THEN '310_Chyba_v_cetnosti_kmene_nebo_KMEN_ID' END AS e310,
CASE WHEN status = 'DI' AND status_old = 'DB' THEN '311_Z_pahylu_se_stala_souse_zkontroluj_STATUS' END AS e311,
CASE WHEN status_old IN ('DU','SH','DP','BLS') AND status IN ('DI','DB') THEN '312_Reverzni_vyvoj_Statusu_Zkontroluj_STATUS' END AS e312,
CASE WHEN status IN ('AI','AB','DAB','AL','ALM','AU','AC') AND dbh_old > dbh THEN '313_hubnuti_stromu' END AS e313,
CASE WHEN status IN ('AI','AB','DAB','AL','ALM','AU','AC') AND dbh - dbh_old > 150 THEN '314_prirust_nad_150mm' END AS e314 FROM w)"""


@query(f"{_CENSUS_SQL} SELECT fid, concat_ws(' ', e403, e203, e308, e310, e311, e312, e313, e314) AS error FROM r")
def error_codes(spark, d):
    checked, _ = evaluate(_census(spark, d), Census())
    return checked.select("fid", errors.render(F.col("error_codes")).alias("error"))


@query(f"""{_CENSUS_SQL} SELECT fid, concat_ws(' ', e403, CASE WHEN collision IS DISTINCT FROM 'Species' THEN e203 END, CASE WHEN collision IS DISTINCT FROM 'Revive' THEN e308 END, e310, e311, e312,
CASE WHEN collision IS DISTINCT FROM 'Shrinking' THEN e313 END, CASE WHEN collision IS DISTINCT FROM 'Increase' THEN e314 END) AS error FROM r""")
def clear_collisions(spark, d):
    from arborlens.operators.rules import clear_collisions as clear

    checked, _ = evaluate(_census(spark, d), Census())
    return clear(checked).select("fid", errors.render(F.col("error_codes")).alias("error"))


@query(f"""{_CENSUS_SQL} SELECT concat_ws(' ', e403, e203, e308, e310, e311, e312, e313, e314) AS error, x, y, FALSE AS solved FROM r
WHERE dbh IS NOT NULL AND status IS NOT NULL AND concat_ws(' ', e403, e203, e308, e310, e311, e312, e313, e314) <> ''""")
def errors_view(spark, d):
    from arborlens.operators.rules import errors_view as view

    checked, _ = evaluate(_census(spark, d), Census())
    return view(checked)


@query(f"""{_CENSUS_SQL} SELECT code, count(*) AS n FROM (SELECT unnest([e403, e203, e308, e310, e311, e312, e313, e314]) AS code FROM r) WHERE code IS NOT NULL GROUP BY code""")
def code_counts(spark, d):
    return reports.code_counts(evaluate(_census(spark, d), Census())[0])


@query(f"""{_CENSUS_SQL} SELECT count(*) AS error_count FROM r WHERE dbh IS NOT NULL AND status IS NOT NULL AND concat_ws(' ', e403, e203, e308, e310, e311, e312, e313, e314) <> ''""")
def error_count(spark, d):
    return reports.error_count(evaluate(_census(spark, d), Census())[0])


@query(f"""{_CENSUS_SQL} SELECT fid, CASE WHEN tree_id IN (SELECT user_id FROM events WHERE event_type = 'click') THEN '' ELSE concat_ws(' ', e403, e203, e308, e310, e311, e312, e313, e314) END AS error FROM r""")
def verified_clear(spark, d):
    checked, _ = evaluate(_census(spark, d), Census())
    verified = read(spark, d, "events").where(F.col("event_type") == "click").select("user_id")
    return clear_verified(checked, verified, "tree_id").select("fid", errors.render(F.col("error_codes")).alias("error"))


def _one_rule(number: str):
    def run(spark, d):
        rule = [r for r in RULES if r.code.startswith(number) and r.group == "core"]
        checked, _ = evaluate(_census(spark, d), Census(), rules=rule)
        return checked.select("fid", F.get("error_codes", F.lit(0)).alias("code"))

    return run


for _name, _number in {"species_change": "203", "status_revive": "308", "multiplicity": "310", "stump_to_snag": "311", "status_reverse": "312", "shrink": "313", "growth": "314"}.items():
    QUERIES[_name] = _one_rule(_number)
    ORACLE_SQL[_name] = f"{_CENSUS_SQL} SELECT fid, e{_number} AS code FROM r"


@query(f"{_CENSUS_SQL} SELECT fid, dbh_old IS NULL AS is_new_record, dbh - dbh_old AS growth FROM r")
def recruits_and_growth(spark, d):
    return _census(spark, d).select("fid", F.col("dbh_old").isNull().alias("is_new_record"), (F.col("dbh") - F.col("dbh_old")).alias("growth"))


@query("SELECT l_orderkey, nullif(l_linenumber, 3)::DOUBLE AS k, l_partkey, l_extendedprice, count(*) OVER (PARTITION BY l_orderkey, nullif(l_linenumber, 3)) > 1 AS duplicate FROM lineitem")
def duplicate_keys(spark, d):
    t = read(spark, d, "lineitem").select("l_orderkey", F.nullif("l_linenumber", F.lit(3)).cast("double").alias("k"), "l_partkey", "l_extendedprice")
    return records.mark_duplicates(t, [F.col("l_orderkey"), F.col("k")])


@query("SELECT l_orderkey, nullif(l_linenumber, 3)::DOUBLE AS k, l_partkey, l_extendedprice, count(*) OVER (PARTITION BY l_orderkey, nullif(l_linenumber, 3)) > 1 AND nullif(l_linenumber, 3) IS NOT NULL AS duplicate FROM lineitem")
def duplicate_excl_null(spark, d):
    t = read(spark, d, "lineitem").select("l_orderkey", F.nullif("l_linenumber", F.lit(3)).cast("double").alias("k"), "l_partkey", "l_extendedprice")
    return records.mark_duplicates(t, [F.col("l_orderkey"), F.col("k")], only=F.col("k").isNotNull())


@query("SELECT duplicate, count(*) AS n FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS duplicate FROM lineitem) GROUP BY 1")
def duplicate_flag_counts(spark, d):
    t = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return reports.flag_counts(records.mark_duplicates(t, [F.col("l_orderkey"), F.col("l_linenumber")]), "duplicate")


@query("SELECT o_orderkey, NOT regexp_full_match((o_orderkey * 97)::VARCHAR, '[0-9]{6}') AS wrong FROM orders")
def six_digit_id(spark, d):
    return read(spark, d, "orders").select("o_orderkey", (~six_digits(F.col("o_orderkey") * 97)).alias("wrong"))


@query("SELECT p_partkey, nullif(p_size, 7)::DOUBLE AS tag, NOT coalesce((nullif(p_size, 7) BETWEEN 1 AND 10 OR nullif(p_size, 7) BETWEEN 20 AND 30), FALSE) AS wrong, nullif(p_size, 7) IS NULL AND p_brand = 'Brand#1' AS missing FROM part")
def tag_range_and_missing(spark, d):
    p = read(spark, d, "part").select("p_partkey", "p_brand", F.nullif("p_size", F.lit(7)).cast("double").alias("tag"))
    return p.select("p_partkey", "tag", (~between_any(F.col("tag"), ((1, 10), (20, 30)))).alias("wrong"), (F.col("tag").isNull() & (F.col("p_brand") == "Brand#1")).alias("missing"))


@query("SELECT p_partkey, nullif(p_size, 7)::DOUBLE AS tag, count(*) OVER (PARTITION BY p_brand, nullif(p_size, 7)) > 1 AND nullif(p_size, 7) IS NOT NULL AS duplicate FROM part")
def tag_duplicates(spark, d):
    p = read(spark, d, "part").select("p_partkey", "p_brand", F.nullif("p_size", F.lit(7)).cast("double").alias("tag"))
    return records.mark_duplicates(p, [F.col("p_brand"), F.col("tag")], only=F.col("tag").isNotNull()).select("p_partkey", "tag", "duplicate")


_TAG_RULES = {
    "602": "CASE WHEN status_old = 'AI' AND status = 'DI' AND NOT coalesce(tag_status IN (300, 400), FALSE) THEN '602_umrel_nepripustny_TAG_STAV_nebo_spatne_STATUS' END",
    "603": "CASE WHEN tag_status = 300 AND NOT coalesce(status = 'DI', FALSE) THEN '603_Stitek_nemel_byt_odebran_nebo_spatne_STATUS' END",
    "604": "CASE WHEN tag_status = 200 AND dbh_old IS NOT NULL AND dbh_old <> 0 THEN '604_Chyba_TAG_STAV_rekrut_nesmi_mit_stare_DBH' END",
    "605": "CASE WHEN dbh_old IS NOT NULL AND dbh_old <> 0 AND tag_status IN (700, 800) THEN '605_Chyba_TAG_STAV_neni_opozdene_zameren_ma_stare_DBH' END",
}


@query(f"{_CENSUS_SQL}, g AS (SELECT *, (fid % 9 * 100)::INT AS tag_status FROM r) SELECT fid, concat_ws(' ', {', '.join(_TAG_RULES.values())}) AS error FROM g")
def tag_status_rules(spark, d):
    t = _census(spark, d).withColumn("tag_status", (F.col("fid") % 9 * 100).cast("int"))
    checked, _ = evaluate(t, Census(profile=("tags",)), rules=[r for r in RULES if r.code[:3] in _TAG_RULES])
    return checked.select("fid", errors.render(F.col("error_codes")).alias("error"))


@query("""SELECT p_partkey, NOT (k.q IS NOT NULL OR (p_partkey % 20 = 13 AND nullif(p_size, 7) IS NULL)) AS wrong FROM part
LEFT JOIN (SELECT DISTINCT 13 AS q, s_suppkey AS t FROM supplier WHERE s_suppkey % 2 = 0) k ON p_partkey % 20 = k.q AND nullif(p_size, 7) = k.t""")
def tag_table(spark, d):
    p = read(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 20).alias("tag_prefix"), F.nullif("p_size", F.lit(7)).alias("tag"))
    known = read(spark, d, "supplier").select(F.when(F.col("s_suppkey") % 2 == 0, 13).otherwise(14).alias("QuadratID"), F.col("s_suppkey").alias("TagID"))
    return with_tag_known(p, known).select("p_partkey", (~F.col("tag_known")).alias("wrong"))


@query("""SELECT p_partkey, CASE WHEN n IS NULL THEN '201_chybna_drevina_nebo_prvni_vyskyt' WHEN n = 'WARNING' THEN '202_varovani_malocetna_drevina' END AS code FROM part
LEFT JOIN (SELECT DISTINCT p_brand AS b, CASE WHEN substr(p_brand, length(p_brand), 1) IN ('1', '2') THEN 'OK' ELSE 'WARNING' END AS n FROM part WHERE substr(p_brand, length(p_brand), 1) IN ('1', '2', '3')) ON b = p_brand""")
def species_list(spark, d):
    from arborlens.operators.rules import with_species_condition

    p = read(spark, d, "part").withColumn("species", F.col("p_brand"))
    last = F.substring("species", -1, 1)
    listed = p.where(last.isin("1", "2", "3")).select("species", F.when(last.isin("1", "2"), "OK").otherwise("WARNING").alias("condition"))
    checked, _ = evaluate(with_species_condition(p, listed), Census(profile=("species_list",)))
    return checked.select("p_partkey", F.get("error_codes", F.lit(0)).alias("code"))


_STUMPS = {
    "301": ("P", "(height IS NULL OR height = 0)", "301_Pahyl_chybi_vyska"),
    "302": ("P", "decay IS NULL", "302_Pahyl_chybi_rozklad"),
    "303": ("P", "dbh IS NULL", "303_Pahyl_chybi_DBH"),
    "304": ("O", "(decay IS NULL OR decay = '0')", "304_Souse_chybi_rozklad"),
    "305": ("Z", "(height IS NULL OR height = 0)", "305_Chybi_vyska_zlomu_nebo_neni_zlom"),
    "306": ("EZ", "decay IS NOT NULL", "306_Rozklad_je_navic_mozny_pahyl"),
    "307": ("P", "height > 0 AND height < 1.3", "307_PAHYL_vyska_nesplnuje_limit_mozny_PAREZ"),
    "309": ("JE", "TRUE", "309_Opravdu_status_JE_potvrd"),
}


@query(f"""WITH t AS (SELECT o_orderkey AS fid, ['P', 'O', 'Z', 'EZ', 'JE'][(o_orderkey % 5 + 1)::INT] AS status, CASE WHEN o_orderkey % 3 <> 0 THEN (o_custkey % 4 * 0.5)::DOUBLE END AS height,
CASE WHEN o_orderkey % 4 <> 1 THEN (o_custkey % 3)::VARCHAR END AS decay, CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS dbh FROM orders)
SELECT fid, concat_ws(' ', {', '.join(f"CASE WHEN status = '{s}' AND {c} THEN '{code}' END" for s, c, code in _STUMPS.values())}) AS error FROM t""")
def stump_rules(spark, d):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    t = read(spark, d, "orders").select(
        key.alias("fid"),
        F.get(F.array(*map(F.lit, ("P", "O", "Z", "EZ", "JE"))), (key % 5).cast("int")).alias("status"),
        F.when(key % 3 != 0, (cust % 4 * 0.5).cast("double")).alias("height"),
        F.when(key % 4 != 1, (cust % 3).cast("string")).alias("decay"),
        F.when(key % 6 != 0, F.col("o_totalprice")).alias("dbh"),
    )
    checked, _ = evaluate(t, Census(profile=("stumps",)))
    return checked.select("fid", errors.render(F.col("error_codes")).alias("error"))


def _error(checked):
    return errors.render(F.col("error_codes")).alias("error")


_LYING = """WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 <> 0 THEN l_orderkey * 97 END AS tree_id, (l_linenumber % 2)::INT AS stem_id, CASE WHEN l_linenumber % 3 = 0 THEN lower(l_linestatus) ELSE l_linestatus END AS piece_id FROM lineitem)"""


@query(f"""{_LYING} SELECT l_orderkey, l_linenumber, concat_ws(' ', CASE WHEN tree_id IS NULL OR NOT regexp_full_match(tree_id::VARCHAR, '[0-9]{{6}}') THEN '401_chybne_strom_id' END,
CASE WHEN count(*) OVER (PARTITION BY tree_id, stem_id, upper(piece_id)) > 1 THEN '402_lezici_duplicita_STROM_ID-KMEN_ID-KUS_ID' END) AS error FROM t""")
def lying_rules(spark, d):
    line, order = F.col("l_linenumber"), F.col("l_orderkey")
    t = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(order % 7 != 0, order * 97).alias("tree_id"), (line % 2).cast("int").alias("stem_id"), F.when(line % 3 == 0, F.lower("l_linestatus")).otherwise(F.col("l_linestatus")).alias("piece_id"))
    checked, _ = evaluate(t, Census(), table="lying")
    return checked.select("l_orderkey", "l_linenumber", _error(checked))


_TAGS = "WITH t AS (SELECT p_partkey, nullif(p_size, 7) AS tag, CASE WHEN p_partkey % 3 = 0 THEN 'AI' WHEN p_partkey % 3 = 1 THEN 'DB' END AS status, p_partkey % 20 AS tag_prefix, (p_partkey % 2)::INT AS stem_id FROM part)"


def _tagged(spark, d):
    key = F.col("p_partkey")
    return read(spark, d, "part").select("p_partkey", F.nullif("p_size", F.lit(7)).alias("tag"), F.when(key % 3 == 0, "AI").when(key % 3 == 1, "DB").alias("status"), (key % 20).alias("tag_prefix"), (key % 2).cast("int").alias("stem_id"))


@query(f"""{_TAGS} SELECT p_partkey, concat_ws(' ', CASE WHEN NOT coalesce(tag BETWEEN 1 AND 10 OR tag BETWEEN 20 AND 30, FALSE) THEN '606_TAG_mimo_rozsah_povolených_hodnot' END,
CASE WHEN tag IS NULL AND coalesce(status = 'AI', FALSE) THEN '607_Zivy_strom_bez_stitku' END, CASE WHEN tag IS NOT NULL AND count(*) OVER (PARTITION BY tag) > 1 THEN '608_Duplicitni_TAG' END) AS error FROM t""")
def site_tag_rules(spark, d):
    checked, _ = evaluate(_tagged(spark, d), Census(profile=("site_tags",), tag_ranges=((1, 10), (20, 30))))
    return checked.select("p_partkey", _error(checked))


@query(f"""{_TAGS}, k AS (SELECT DISTINCT 13 AS q, s_suppkey AS s FROM supplier WHERE s_suppkey % 2 = 0), j AS (SELECT t.*, k.q FROM t LEFT JOIN k ON tag_prefix = k.q AND tag = k.s)
SELECT p_partkey, concat_ws(' ', CASE WHEN NOT coalesce(tag BETWEEN 1 AND 10 OR tag BETWEEN 20 AND 30, FALSE) THEN '601_cislo_stitku_mimo_povoleny_rozsah' END,
CASE WHEN NOT (q IS NOT NULL OR (tag_prefix = 13 AND tag IS NULL)) THEN '606_Chyba_TAG_mimo_rozsah_povolených_hodnot' END,
CASE WHEN count(*) OVER (PARTITION BY tag_prefix, tag, stem_id) > 1 AND NOT (tag_prefix = 13 AND tag IS NULL AND stem_id = 1) THEN '607_Chyba_duplicitni_TAG' END) AS error FROM j""")
def tag_rules(spark, d):
    known = read(spark, d, "supplier").select(F.when(F.col("s_suppkey") % 2 == 0, 13).otherwise(14).alias("QuadratID"), F.col("s_suppkey").alias("TagID"))
    t = with_tag_known(_tagged(spark, d).drop("status"), known)
    checked, _ = evaluate(t, Census(profile=("tags",), tag_ranges=((1, 10), (20, 30))))
    return checked.select("p_partkey", _error(checked))


@query(f"""{_TAGS} SELECT p_partkey, CASE WHEN NOT ends_with(p_partkey::VARCHAR, tag::VARCHAR) THEN '606_Chyba_TAG_CISLO_se_lisi_od_TAG_KOMPLET_over_v_lese' END AS code FROM t""")
def tag_suffix_rule(spark, d):
    t = _tagged(spark, d).withColumn("tag_complete", F.col("p_partkey").cast("string"))
    checked, _ = evaluate(t, Census(profile=("tag_suffix",)))
    return checked.select("p_partkey", F.get("error_codes", F.lit(0)).alias("code"))


# --- reports -------------------------------------------------------------------------------


@query("SELECT count(*) AS total, count(v) AS visited, round(100 * count(v) / count(*), 2) AS percent FROM (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS v FROM orders)")
def progress(spark, d):
    return reports.progress(read(spark, d, "orders").select(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("v")), "v")


@query("WITH e AS (SELECT event_id, nullif(event_type, 'view') AS crew FROM events) SELECT event_id, crew, n FROM e JOIN (SELECT crew, count(*) AS n FROM e WHERE crew IS NOT NULL GROUP BY crew) USING (crew)")
def crew_counts(spark, d):
    return reports.with_group_count(read(spark, d, "events").select("event_id", F.nullif("event_type", F.lit("view")).alias("crew")), "crew")


@query(f"""{_CENSUS_SQL}, v AS (SELECT *, species AS crew FROM r) SELECT 'total' AS metric, NULL AS key, count(*) AS n FROM v UNION ALL SELECT 'visited', NULL, count(dbh) FROM v
UNION ALL SELECT 'errors', NULL, count(*) FILTER (WHERE dbh IS NOT NULL AND status IS NOT NULL AND concat_ws(' ', e403, e203, e308, e310, e311, e312, e313, e314) <> '') FROM v
UNION ALL SELECT 'crew', crew, count(*) FROM v WHERE dbh IS NOT NULL AND crew IS NOT NULL GROUP BY crew UNION ALL SELECT 'status', status, count(*) FROM v WHERE status IS NOT NULL GROUP BY status
UNION ALL SELECT 'flag', 'is_new_record', count(*) FROM v WHERE dbh_old IS NULL HAVING count(*) > 0
UNION ALL SELECT 'code', code, count(*) FROM (SELECT unnest([e403, e203, e308, e310, e311, e312, e313, e314]) AS code FROM v) WHERE code IS NOT NULL GROUP BY code""")
def report_metrics(spark, d):
    checked, _ = evaluate(_census(spark, d), Census())
    return reports.metrics(checked.withColumns({"crew": F.col("species"), "is_new_record": F.col("dbh_old").isNull()}))


@query("""WITH c AS (SELECT event_type AS crew, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY crew) - 1 AS place, count(*) OVER () AS m FROM c),
h AS (SELECT *, m // 4 AS pale, m - m // 4 AS warm FROM k) SELECT crew, n, place, '#FF' || printf('%02X', floor(255 * CASE WHEN place >= warm THEN 1 WHEN warm > 1 THEN place / (warm - 1) ELSE 0 END + 0.5)::BIGINT)
|| printf('%02X', floor(255 * CASE WHEN place >= warm THEN (2 * (place - warm) + 1) / (2 * pale) ELSE 0 END + 0.5)::BIGINT) AS colour FROM h""")
def crew_bars(spark, d):
    return reports.counts_with_colour(read(spark, d, "events").select(F.col("event_type").alias("crew")), "crew")


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'grey80' WHEN user_id % 4 = 0 THEN 'red' WHEN user_id % 4 = 1 THEN 'violet' WHEN user_id % 4 = 2 THEN 'blue3' END AS colour FROM events""")
def crew_colours(spark, d):
    crew = F.when(F.col("user_id") % 4 == 0, "Cerveny").when(F.col("user_id") % 4 == 1, "Duhovy").when(F.col("user_id") % 4 == 2, "Modry")
    return read(spark, d, "events").select("event_id", reports.crew_colour(crew, F.when(F.col("event_id") % 5 != 0, F.col("value"))).alias("colour"))


@query("""WITH e AS (SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN event_type END AS crew FROM events),
d AS (SELECT ts::DATE AS day, arg_min(crew, event_id) AS c FROM e WHERE crew IS NOT NULL GROUP BY 1),
w AS (SELECT weekofyear(ts) AS wk, arg_min(crew, event_id) AS c FROM e WHERE crew IS NOT NULL GROUP BY 1)
SELECT event_id, ts AS date, coalesce(e.crew, d.c, w.c, 'unknown_mapper') AS crew FROM e LEFT JOIN d ON d.day = e.ts::DATE LEFT JOIN w ON w.wk = weekofyear(ts)""")
def author_inference(spark, d):
    e = read(spark, d, "events").select("event_id", F.col("ts").alias("date"), F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("crew"))
    return authors.infer_authors(e, seq="event_id", normalise=False)


@query("SELECT c_custkey, replace(replace(strip_accents('Červený, ' || c_name), ',', ''), ' ', '') AS crew FROM (SELECT c_custkey, replace(c_name, '#', '') AS c_name FROM customer)")
def normal_names(spark, d):
    return read(spark, d, "customer").select("c_custkey", normal_name(F.concat(F.lit("Červený, "), F.col("c_name"))).alias("crew"))


@query("SELECT event_id, json_extract(props, '$.k')::INT AS k FROM events")
def json_path(spark, d):
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, weekofyear(ts)::INT AS week, strftime(ts, '%Y-%m-%d %H:%M') AS stamp FROM events")
def dates(spark, d):
    return read(spark, d, "events").select("event_id", F.to_date("ts").cast("string").alias("day"), F.weekofyear("ts").alias("week"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("stamp"))


@query("SELECT page_id, CASE WHEN ends_with(b, 'l') THEN substr(b, 1, length(b) - 1) ELSE b END AS name FROM (SELECT page_id, list_last(string_split(url, '/')) AS b FROM pages)")
def path_names(spark, d):
    return read(spark, d, "pages").select("page_id", base_name(F.col("url"), "l").alias("name"))


# --- points --------------------------------------------------------------------------------


def _cloud(spark, d):
    e = F.col("embedding")
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("seq"), *[F.get(e, F.lit(i)).cast("double").alias(a) for i, a in enumerate(points.XYZ)], F.col("label").alias("segment_id"))


_CLOUD = "WITH p AS (SELECT vec_id AS seq, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, label AS segment_id FROM embeddings)"
_TRIANGLE = [(-0.2, -0.2), (0.3, -0.1), (0.0, 0.3), (-0.2, -0.2)]


@query(f"{_CLOUD} SELECT seq, EXISTS (SELECT 1 FROM p b WHERE b.seq <> p.seq AND pow(p.x - b.x, 2) + pow(p.y - b.y, 2) < 0.01 * 0.01) AS duplicated_xy FROM p")
def near_duplicate_points(spark, d):
    return spatial.mark_near(_cloud(spark, d), ["x", "y"], 0.01).select("seq", "duplicated_xy")


@query(f"""{_CLOUD}, n AS (SELECT a.seq, b.seq AS nearest, pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) AS d2 FROM p a JOIN p b ON a.seq % 2 = 0 AND b.seq % 2 = 1 WHERE d2 <= 0.05 * 0.05)
SELECT seq, min_by(nearest, (d2, nearest)) AS nearest, round(sqrt(min(d2)), 6) AS distance FROM n GROUP BY seq""")
def nearest_points(spark, d):
    p = _cloud(spark, d)
    return spatial.nearest(p.where("seq % 2 = 0"), p.where("seq % 2 = 1"), list(points.XYZ), 0.05).withColumn("distance", F.round("distance", 6))


_VOXEL = "floor(x / 0.05)::BIGINT AS i, floor(y / 0.05)::BIGINT AS j, floor(z / 0.05)::BIGINT AS k"


@query(f"{_CLOUD}, v AS (SELECT *, {_VOXEL} FROM p) SELECT min(seq) AS seq, (i + 0.5::DOUBLE) * 0.05::DOUBLE AS x, (j + 0.5::DOUBLE) * 0.05::DOUBLE AS y, (k + 0.5::DOUBLE) * 0.05::DOUBLE AS z, arg_min(segment_id, seq) AS segment_id FROM v GROUP BY i, j, k")
def voxel_center(spark, d):
    return points.voxel_downsample(_cloud(spark, d), 0.05, "center")


@query(f"{_CLOUD}, v AS (SELECT *, {_VOXEL} FROM p) SELECT * EXCLUDE (i, j, k, r) FROM (SELECT *, row_number() OVER (PARTITION BY i, j, k ORDER BY seq) AS r FROM v) WHERE r = 1")
def voxel_first(spark, d):
    return points.voxel_downsample(_cloud(spark, d), 0.05, "first")


@query(f"{_CLOUD}, v AS (SELECT *, {_VOXEL} FROM p) SELECT min(seq) AS seq, round(avg(x), 6) AS x, round(avg(y), 6) AS y, round(avg(z), 6) AS z, arg_min(segment_id, seq) AS segment_id FROM v GROUP BY i, j, k")
def voxel_mean(spark, d):
    v = points.voxel_downsample(_cloud(spark, d), 0.05, "mean")
    return v.select("seq", *[F.round(a, 6).alias(a) for a in points.XYZ], "segment_id")


@query(f"{_CLOUD} SELECT floor(x / 0.1)::BIGINT AS tile_x, floor(y / 0.1)::BIGINT AS tile_y, count(*) AS n FROM p GROUP BY 1, 2")
def tile_counts(spark, d):
    return points.tiles(_cloud(spark, d), 0.1).groupBy("tile_x", "tile_y").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{_CLOUD}, a AS (SELECT *, unnest(range(floor((x - 0.02) / 0.1)::BIGINT, floor((x + 0.02) / 0.1)::BIGINT + 1)) AS tile_x FROM p), b AS (SELECT *, unnest(range(floor((y - 0.02) / 0.1)::BIGINT, floor((y + 0.02) / 0.1)::BIGINT + 1)) AS tile_y FROM a)
SELECT seq, tile_x, tile_y, tile_x <> floor(x / 0.1)::BIGINT OR tile_y <> floor(y / 0.1)::BIGINT AS is_buffer FROM b""")
def tile_buffer(spark, d):
    return points.tiles(_cloud(spark, d), 0.1, 0.02).select("seq", "tile_x", "tile_y", "is_buffer")


@query(f"""{_CLOUD}, e(x1, y1, x2, y2) AS (VALUES (-0.2, -0.2, 0.3, -0.1), (0.3, -0.1, 0.0, 0.3), (0.0, 0.3, -0.2, -0.2))
SELECT seq FROM p WHERE (SELECT count(*) FROM e WHERE (y1::DOUBLE > y) <> (y2::DOUBLE > y) AND x < (x2::DOUBLE - x1::DOUBLE) * (y - y1::DOUBLE) / (y2::DOUBLE - y1::DOUBLE) + x1::DOUBLE) % 2 = 1""")
def crop_polygon(spark, d):
    return points.crop(_cloud(spark, d), [_TRIANGLE]).select("seq")


@query(f"{_CLOUD} SELECT seq, CASE WHEN NOT (x BETWEEN -0.1 AND 0.1 AND y BETWEEN -0.1 AND 0.1) AND sqrt(pow(greatest(abs(x) - 0.1, 0), 2) + pow(greatest(abs(y) - 0.1, 0), 2)) > 0.05 THEN '001_bod_za_hranici_plochy' END AS code FROM p")
def boundary_buffer(spark, d):
    ring = [(-0.1, -0.1), (0.1, -0.1), (0.1, 0.1), (-0.1, 0.1)]
    p = _cloud(spark, d).withColumn("outside_boundary", ~geometry.within_buffer(F.col("x"), F.col("y"), ring, 0.05))
    checked, _ = evaluate(p, Census(profile=("boundary",)))
    return checked.select("seq", F.get("error_codes", F.lit(0)).alias("code"))


@query(f"{_CLOUD} SELECT seq, round(2 * x - y + 1, 9) AS x, round(0.5 * y + z, 9) AS y, round(z - 3, 9) AS z, segment_id FROM p")
def affine(spark, d):
    moved = points.affine(_cloud(spark, d), [[2, -1, 0, 1], [0, 0.5, 1, 0], [0, 0, 1, -3], [0, 0, 0, 1]])
    return moved.select("seq", *[F.round(a, 9).alias(a) for a in points.XYZ], "segment_id")


@query(f"{_CLOUD}, b AS (SELECT (min(x) + max(x)) / 2 AS a, (min(y) + max(y)) / 2 AS b, min(z) AS c FROM p) SELECT seq, round(x - a, 6) AS x, round(y - b, 6) AS y, round(z - c, 6) AS z, segment_id FROM p, b")
def center_cloud(spark, d):
    return points.center_cloud(_cloud(spark, d)).select("seq", *[F.round(a, 6).alias(a) for a in points.XYZ], "segment_id")


@query(f"{_CLOUD}, b AS (SELECT avg(x) AS a, avg(y) AS b, avg(z) AS c FROM p) SELECT seq, round(x - a, 6) AS x, round(y - b, 6) AS y, round(z - c, 6) AS z, segment_id FROM p, b")
def mean_center(spark, d):
    return points.mean_center(_cloud(spark, d)).select("seq", *[F.round(a, 6).alias(a) for a in points.XYZ], "segment_id")


@query(f"{_CLOUD} SELECT seq, x, x AS gps_time FROM p")
def ferry(spark, d):
    return points.ferry(_cloud(spark, d)).select("seq", "x", "gps_time")


@query(f"{_CLOUD} SELECT seq FROM p WHERE seq % 4 = 0")
def decimate(spark, d):
    return points.decimate(_cloud(spark, d), 4).select("seq")


@query(f"{_CLOUD} SELECT * FROM p ORDER BY seq LIMIT 1")
def first_point(spark, d):
    return points.first_point(_cloud(spark, d))


@query(f"{_CLOUD} SELECT count(*) AS n, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, min(z) AS min_z, max(z) AS max_z FROM p")
def cloud_info(spark, d):
    return points.cloud_info(_cloud(spark, d))


@query(f"{_CLOUD} SELECT segment_id, count(*) AS n, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, min(z) AS min_z, max(z) AS max_z, round(max(z) - min(z), 9) AS height FROM p GROUP BY segment_id")
def segment_info(spark, d):
    return points.segment_info(_cloud(spark, d)).withColumn("height", F.round("height", 9))


@query(f"{_CLOUD} SELECT floor(x / 0.1)::BIGINT AS cell_x, floor(y / 0.1)::BIGINT AS cell_y, count(*) AS n FROM p GROUP BY 1, 2")
def density(spark, d):
    return points.density(_cloud(spark, d), 0.1)


@query(f"{_CLOUD} SELECT floor(x / 0.1)::BIGINT AS cell_x, floor(y / 0.1)::BIGINT AS cell_y, min(z) AS z FROM p GROUP BY 1, 2")
def ground(spark, d):
    return points.ground(_cloud(spark, d), 0.1)


@query(f"""{_CLOUD} SELECT seq, CASE WHEN EXISTS (SELECT 1 FROM p b WHERE b.seq <> p.seq AND pow(p.x - b.x, 2) + pow(p.y - b.y, 2) < 0.01 * 0.01) THEN '002_duplicitni_geometrie_bodu' END AS code FROM p""")
def near_point_rule(spark, d):
    checked, _ = evaluate(spatial.mark_near(_cloud(spark, d), ["x", "y"], Census().duplicate_distance), Census())
    return checked.select("seq", F.get("error_codes", F.lit(0)).alias("code"))


_VOXEL2 = "floor(x / 0.2)::BIGINT AS vx, floor(y / 0.2)::BIGINT AS vy, floor(z / 0.2)::BIGINT AS vz"


@query(f"""{_CLOUD}, v AS (SELECT *, {_VOXEL2} FROM p), c AS (SELECT vx, vy, vz, count(*) FILTER (WHERE seq % 3 <> 0)::BIGINT AS n_first, count(*) FILTER (WHERE seq % 3 <> 1)::BIGINT AS n_second FROM v GROUP BY ALL)
SELECT *, CASE WHEN n_second = 0 THEN 'removed' WHEN n_first = 0 THEN 'added' ELSE 'common' END AS state FROM c WHERE n_first + n_second > 0""")
def cloud_difference(spark, d):
    p = _cloud(spark, d)
    return points.difference(p.where("seq % 3 <> 0"), p.where("seq % 3 <> 1"), 0.2)


@query(f"""{_CLOUD}, v AS (SELECT *, (seq % 3)::INT AS c, {_VOXEL2} FROM p), f AS (SELECT vx, vy, vz, arg_min(c, (z, c)) AS c FROM v GROUP BY vx, vy, vz) SELECT seq FROM v JOIN f USING (vx, vy, vz, c)""")
def combine_clouds(spark, d):
    p = _cloud(spark, d)
    return points.combine([p.where(f"seq % 3 = {k}") for k in range(3)], 0.2, F.col("z")).select("seq")


@query(f"""{_CLOUD}, b AS (SELECT min(z) AS lo, max(z) AS hi FROM p) SELECT seq, floor(255 * ((z - lo) / (hi - lo)) + 0.5)::INT AS r, 0 AS g, floor(255 - 255 * ((z - lo) / (hi - lo)) + 0.5)::INT AS b FROM p, b""")
def colour_cloud(spark, d):
    return points.colour_by(_cloud(spark, d), "z").select("seq", "r", "g", "b")


@query(f"{_CLOUD} SELECT seq FROM p WHERE segment_id IN (SELECT segment_id FROM p GROUP BY segment_id HAVING max(z) - min(z) >= 0.6)")
def prune_trees(spark, d):
    return points.prune(_cloud(spark, d), 0.6).select("seq")


@query(f"{_CLOUD} SELECT seq, round(z, 6) AS x, round(x, 6) AS y, round(y, 6) AS z FROM p")
def rotate_cloud(spark, d):
    """A third of a turn about the diagonal carries x to y, y to z and z to x."""
    return points.rotate(_cloud(spark, d), (1, 1, 1), 120).select("seq", *[F.round(a, 6).alias(a) for a in points.XYZ])


@query(f"{_CLOUD} SELECT seq, x - 0 AS sx, y - 0 AS sy, z + 10 AS sz FROM p")
def rays(spark, d):
    return points.with_ray(_cloud(spark, d)).select("seq", "sx", "sy", "sz")


@query(f"{_CLOUD} SELECT seq, segment_id * 65536 + (seq % 256) * 256 + 7 AS colour FROM p")
def split_by_colour(spark, d):
    coloured = _cloud(spark, d).select("seq", F.col("segment_id").alias("r"), (F.col("seq") % 256).alias("g"), F.lit(7).alias("b"))
    return points.segment_of_colour(coloured, "colour").select("seq", "colour")


@query(f"{_CLOUD} SELECT seq, 'low' AS part FROM p WHERE z < 0 UNION ALL SELECT seq, 'high' FROM p WHERE z >= 0")
def split_cloud(spark, d):
    low, high = points.split(_cloud(spark, d), F.col("z") < 0)
    return low.select("seq", F.lit("low").alias("part")).unionByName(high.select("seq", F.lit("high").alias("part")))


@query(f"""{_CLOUD}, l AS (SELECT floor(x / 0.2)::BIGINT AS i, floor(y / 0.2)::BIGINT AS j, floor(z / 0.2)::BIGINT AS k, arg_min(segment_id, seq) AS s FROM p WHERE seq % 4 = 0 GROUP BY 1, 2, 3)
SELECT p.seq, l.s::DOUBLE AS segment_id FROM p LEFT JOIN l ON floor(x / 0.2)::BIGINT = i AND floor(y / 0.2)::BIGINT = j AND floor(z / 0.2)::BIGINT = k""")
def restore_labels(spark, d):
    p = _cloud(spark, d)
    return points.restore(points.decimate(p, 4), p, 0.2, ["segment_id"]).select("seq", F.col("segment_id").cast("double").alias("segment_id"))


@query("""WITH a AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), b AS (SELECT user_id, ts, event_id AS before FROM events WHERE event_type <> 'purchase')
SELECT a.event_id, a.user_id, b.before::DOUBLE AS before FROM a ASOF LEFT JOIN b ON a.user_id = b.user_id AND a.ts >= b.ts""")
def traj_asof(spark, d):
    e = read(spark, d, "events")
    a = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    b = e.where("event_type <> 'purchase'").select("user_id", F.col("ts").alias("t"), F.col("event_id").alias("before"))
    return points.as_of(a, b, "ts", "t", ["before"], ["user_id"]).select("event_id", "user_id", F.col("before").cast("double").alias("before"))


@query("""WITH a AS (SELECT event_id, epoch_us(ts) / 1e6 AS t FROM events WHERE event_type = 'purchase'), b AS (SELECT event_id AS before, epoch_us(ts) / 1e6 AS t, row_number() OVER (PARTITION BY ts ORDER BY event_id DESC) AS r FROM events WHERE event_type <> 'purchase')
SELECT a.event_id, b.before::DOUBLE AS before FROM a ASOF LEFT JOIN (SELECT * FROM b WHERE r = 1) b ON a.t >= b.t""")
def trajectory_by_time(spark, d):
    """One trajectory for all points: no key, time cut into days."""
    e = read(spark, d, "events").select("event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    a, b = e.where("event_type = 'purchase'").select("event_id", "t"), e.where("event_type <> 'purchase'").select(F.col("event_id").alias("before"), F.col("t").alias("u"))
    return points.as_of(a, b, "t", "u", ["before"], [], width=86_400e6).select("event_id", F.col("before").cast("double").alias("before"))


# points near none are kept; the others are gone through in order
@query(f"""{_CLOUD.replace("WITH", "WITH RECURSIVE")}, n AS (SELECT a.seq, list(b.seq) FILTER (WHERE b.seq < a.seq) AS l FROM p a JOIN p b ON a.seq <> b.seq AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) < 0.05 * 0.05 GROUP BY a.seq),
o AS (SELECT seq, coalesce(l, []) AS l, row_number() OVER (ORDER BY seq) AS i FROM n),
r(i, seq, kept) AS (SELECT 0::BIGINT, NULL::BIGINT, []::BIGINT[] UNION ALL SELECT o.i, CASE WHEN NOT list_has_any(r.kept, o.l) THEN o.seq END, CASE WHEN list_has_any(r.kept, o.l) THEN r.kept ELSE list_append(r.kept, o.seq) END FROM r JOIN o ON o.i = r.i + 1)
SELECT seq FROM p WHERE seq NOT IN (SELECT seq FROM n) UNION ALL SELECT seq FROM r WHERE seq IS NOT NULL""")
def thin_cloud(spark, d):
    return spatial.thin(_cloud(spark, d), list(points.XYZ), 0.05).select("seq")


@query(f"""{_CLOUD}, n AS (SELECT a.seq, coalesce((SELECT min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2))) FROM p b WHERE b.seq <> a.seq AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) <= 0.2 * 0.2), 0.2) AS d FROM p a)
SELECT seq FROM n WHERE d <= (SELECT avg(d) + 2 * stddev_pop(d) FROM n)""")
def denoise(spark, d):
    return spatial.without_outliers(_cloud(spark, d), list(points.XYZ), 0.2).select("seq")


# the cloud was moved by a known step, so alignment gives the cloud itself
@query(f"{_CLOUD} SELECT seq, round(x, 3) + 0.0 AS x, round(y, 3) + 0.0 AS y, round(z, 3) + 0.0 AS z FROM p")
def icp_align(spark, d):
    p = _cloud(spark, d)
    moved, _ = points.icp(points.translate(p, 0.004, -0.003, 0.002), p, 0.05, rounds=5)
    return moved.select("seq", *[(F.round(a, 3) + F.lit(0.0)).alias(a) for a in points.XYZ])
