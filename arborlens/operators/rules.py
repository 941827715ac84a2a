"""The registry of validation rules: code, columns it needs, and a condition built of columns.

A rule whose columns are missing is skipped and reported. All rules of a table run in one
projection; those that compare rows (duplicates, near points) are windows or joins added first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from arborlens.config import ALIVE, DEAD, EXCUSES, Census
from arborlens.functions import errors
from arborlens.functions.text import between_any, isin_two_valued, six_digits
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

C = F.col


@dataclass(frozen=True)
class Rule:
    code: str
    requires: tuple[str, ...]
    condition: Callable[[Census], Column]
    group: str = "core"
    table: str = "standing"


def _copies(*keys: Column, only: Column | None = None) -> Column:
    """Whether the keys occur more than once; ``only``: among rows for which that is true, which the keys must decide. The others are spread over all tasks, so that unset keys are no hot key."""
    if only is None:
        return F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    held = F.coalesce(only, F.lit(False))
    spread = F.when(~held, F.rand(7))
    return held & (F.count(F.lit(1)).over(Window.partitionBy(*keys, spread)) > 1)


def _absent(name: str) -> Column:
    """Null or zero; decay is text, so zero is compared as a number where it is one."""
    return C(name).isNull() | F.coalesce(C(name).try_cast("double") == 0, F.lit(False))


def _tag_key() -> Column:
    return F.concat_ws("-", F.coalesce(C("tag_prefix").cast("string"), F.lit("NA")), F.coalesce(C("tag").cast("string"), F.lit("NA")))


# The codes that are published, in the order in which they are listed.
RULES = [
    Rule("002_duplicitni_geometrie_bodu", ("duplicated_xy",), lambda c: C("duplicated_xy")),
    Rule("401_chybne_strom_id", ("tree_id",), lambda c: ~six_digits(C("tree_id").cast("bigint")), table="lying"),
    Rule("402_lezici_duplicita_STROM_ID-KMEN_ID-KUS_ID", ("tree_id", "stem_id", "piece_id"), lambda c: _copies(C("tree_id"), C("stem_id"), F.upper("piece_id")), table="lying"),
    Rule("403_stojici_duplicita_STROM_ID-KMEN_ID", ("tree_id", "stem_id"), lambda c: _copies(C("tree_id"), C("stem_id"), only=C("tree_id").isNotNull())),
    Rule("203_zmena_dreviny", ("species", "species_o"), lambda c: C("species") != C("species_o")),
    Rule("308_Strom_obzivl", ("status", "status_old"), lambda c: C("status").isin(*ALIVE) & C("status_old").isin(*DEAD)),
    Rule("310_Chyba_v_cetnosti_kmene_nebo_KMEN_ID", ("multi_stem", "stem_id"), lambda c: (C("multi_stem") == "SGL") & (C("stem_id") > 1)),
    Rule("311_Z_pahylu_se_stala_souse_zkontroluj_STATUS", ("status", "status_old"), lambda c: (C("status") == "DI") & (C("status_old") == "DB")),
    Rule("312_Reverzni_vyvoj_Statusu_Zkontroluj_STATUS", ("status", "status_old"), lambda c: C("status_old").isin("DU", "SH", "DP", "BLS") & C("status").isin("DI", "DB")),
    Rule("313_hubnuti_stromu", ("status", "dbh", "dbh_old"), lambda c: C("status").isin(*ALIVE) & (C("dbh_old") > C("dbh"))),
    Rule("314_prirust_nad_150mm", ("status", "dbh", "dbh_old"), lambda c: C("status").isin(*ALIVE) & (C("dbh") - C("dbh_old") > c.largest_growth)),
    # one site's tag rules
    Rule("606_TAG_mimo_rozsah_povolených_hodnot", ("tag",), lambda c: ~between_any(C("tag"), c.tag_ranges), group="site_tags"),
    Rule("607_Zivy_strom_bez_stitku", ("tag", "status"), lambda c: C("tag").isNull() & isin_two_valued(C("status"), ALIVE), group="site_tags"),
    Rule("608_Duplicitni_TAG", ("tag",), lambda c: _copies(C("tag"), only=C("tag").isNotNull()), group="site_tags"),
    # the alternative tag module
    Rule("601_cislo_stitku_mimo_povoleny_rozsah", ("tag",), lambda c: ~between_any(C("tag"), c.tag_ranges), group="tags"),
    Rule("602_umrel_nepripustny_TAG_STAV_nebo_spatne_STATUS", ("status", "status_old", "tag_status"), lambda c: C("status_old").isin(*ALIVE) & C("status").isin(*DEAD) & ~isin_two_valued(C("tag_status"), (300, 400)), group="tags"),
    Rule("603_Stitek_nemel_byt_odebran_nebo_spatne_STATUS", ("status", "tag_status"), lambda c: (C("tag_status") == 300) & ~isin_two_valued(C("status"), DEAD), group="tags"),
    Rule("604_Chyba_TAG_STAV_rekrut_nesmi_mit_stare_DBH", ("tag_status", "dbh_old"), lambda c: (C("tag_status") == 200) & C("dbh_old").isNotNull() & (C("dbh_old") != 0), group="tags"),
    Rule("605_Chyba_TAG_STAV_neni_opozdene_zameren_ma_stare_DBH", ("tag_status", "dbh_old"), lambda c: C("dbh_old").isNotNull() & (C("dbh_old") != 0) & isin_two_valued(C("tag_status"), (700, 800)), group="tags"),
    Rule("606_Chyba_TAG_mimo_rozsah_povolených_hodnot", ("tag_known",), lambda c: ~C("tag_known"), group="tags"),
    Rule("607_Chyba_duplicitni_TAG", ("tag_prefix", "tag", "stem_id"), lambda c: _copies(C("tag_prefix"), C("tag"), C("stem_id"), only=F.concat_ws("-", _tag_key(), F.coalesce(C("stem_id").cast("string"), F.lit("NA"))) != "13-NA-1"), group="tags"),
    Rule("606_Chyba_TAG_CISLO_se_lisi_od_TAG_KOMPLET_over_v_lese", ("tag", "tag_complete"), lambda c: ~C("tag_complete").endswith(C("tag").cast("string")), group="tag_suffix"),
    # off by default
    Rule("001_bod_za_hranici_plochy", ("outside_boundary",), lambda c: C("outside_boundary"), group="boundary"),
    Rule("201_chybna_drevina_nebo_prvni_vyskyt", ("species", "species_condition"), lambda c: ~isin_two_valued(C("species_condition"), ("OK", "WARNING")), group="species_list"),
    Rule("202_varovani_malocetna_drevina", ("species_condition",), lambda c: C("species_condition") == "WARNING", group="species_list"),
    Rule("301_Pahyl_chybi_vyska", ("status", "height"), lambda c: (C("status") == "P") & _absent("height"), group="stumps"),
    Rule("302_Pahyl_chybi_rozklad", ("status", "decay"), lambda c: (C("status") == "P") & C("decay").isNull(), group="stumps"),
    Rule("303_Pahyl_chybi_DBH", ("status", "dbh"), lambda c: (C("status") == "P") & C("dbh").isNull(), group="stumps"),
    Rule("304_Souse_chybi_rozklad", ("status", "decay"), lambda c: (C("status") == "O") & _absent("decay"), group="stumps"),
    Rule("305_Chybi_vyska_zlomu_nebo_neni_zlom", ("status", "height"), lambda c: (C("status") == "Z") & _absent("height"), group="stumps"),
    Rule("306_Rozklad_je_navic_mozny_pahyl", ("status", "decay"), lambda c: (C("status") == "EZ") & C("decay").isNotNull(), group="stumps"),
    Rule("307_PAHYL_vyska_nesplnuje_limit_mozny_PAREZ", ("status", "height"), lambda c: (C("status") == "P") & (C("height") > 0) & (C("height") < c.least_snag_height), group="stumps"),
    Rule("309_Opravdu_status_JE_potvrd", ("status",), lambda c: C("status") == "JE", group="stumps"),
]


def evaluate(df: DataFrame, census: Census, table: str = "standing", rules: list[Rule] | None = None) -> tuple[DataFrame, list[str]]:
    """df with error_codes (after those it has), and the codes of rules skipped for lack of columns."""
    chosen = [r for r in (RULES if rules is None else rules) if r.table == table and r.group in census.profile]
    runs = [r for r in chosen if set(r.requires) <= set(df.columns)]
    found = errors.collect([errors.code_when(r.condition(census), r.code) for r in runs])
    old = F.coalesce("error_codes", F.array().cast("array<string>")) if "error_codes" in df.columns else F.array().cast("array<string>")
    return df.withColumn("error_codes", F.concat(old, found)), [r.code for r in chosen if r not in runs]


def clear_collisions(df: DataFrame, codes: str = "error_codes", collision: str = "collision") -> DataFrame:
    """Removes the code that each row's verified collision keyword excuses."""
    cleared = C(codes)
    for keyword, number in EXCUSES.items():
        cleared = F.when(C(collision) == keyword, errors.without(C(codes), number)).otherwise(cleared)
    return df.withColumn(codes, cleared)


def clear_verified(df: DataFrame, verified: DataFrame, key: str, codes: str = "error_codes") -> DataFrame:
    """Removes all codes of rows whose key is verified."""
    keys = verified.select(F.col(verified.columns[0]).alias("_v")).where("_v is not null").distinct().withColumn("_hit", F.lit(True))
    joined = df.join(keys, df[key] == F.col("_v"), "left")
    return joined.withColumn(codes, F.when(F.col("_hit"), F.array().cast("array<string>")).otherwise(C(codes))).drop("_v", "_hit")


def with_species_condition(df: DataFrame, species: DataFrame) -> DataFrame:
    """df with species_condition from a list of (species, condition)."""
    listed = species.select(C("species").alias("_s"), C("condition").alias("species_condition")).dropDuplicates(["_s"])
    return df.join(listed, df["species"] == C("_s"), "left").drop("_s")


def with_tag_known(df: DataFrame, table: DataFrame, quadrat: int = 13) -> DataFrame:
    """df with tag_known: prefix and tag are in the table's rows of the quadrat, or are the sentinel 13-NA."""
    known = table.where(C("QuadratID") == quadrat).select(C("QuadratID").cast("string").alias("_q"), C("TagID").alias("_t")).distinct().withColumn("_known", F.lit(True))
    joined = df.join(known, (df["tag_prefix"].cast("string") == C("_q")) & (df["tag"] == C("_t")), "left")
    return joined.withColumn("tag_known", F.coalesce("_known", F.lit(False)) | (_tag_key() == "13-NA")).drop("_q", "_t", "_known")


def errors_view(df: DataFrame, keep: list[str] | None = None, codes: str = "error_codes", dbh: str = "dbh", status: str = "status") -> DataFrame:
    """Rows that have a diameter, a status and an error: error text, place, and solved = false."""
    shown = df.where(C(dbh).isNotNull() & C(status).isNotNull() & errors.has_error(C(codes)))
    return shown.select(errors.render(C(codes)).alias("error"), *(keep or ["x", "y"]), F.lit(False).alias("solved"))
