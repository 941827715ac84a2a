"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Czech letters with diacritics and the letters without.
ACCENTED = "áčďéěíňóřšťúůýžÁČĎÉĚÍŇÓŘŠŤÚŮÝŽ"
PLAIN = "acdeeinorstuuyzACDEEINORSTUUYZ"


def isin_two_valued(c: Column, values: list | tuple) -> Column:
    """Membership that is false, not null, for null."""
    return F.coalesce(c.isin(*values), F.lit(False))


def strip_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


def normal_name(c: Column) -> Column:
    """A crew's name without accents, punctuation and white space; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.regexp_replace(strip_accents(c), r"\p{Punct}", ""), r"\s", ""), F.lit(""))


def six_digits(c: Column) -> Column:
    """Whether a whole number, or text, is exactly six digits; false for null."""
    return F.coalesce(c.cast("string").rlike("^[0-9]{6}$"), F.lit(False))


def between_any(c: Column, ranges: tuple[tuple[int, int], ...]) -> Column:
    """Whether the number lies in one of the closed ranges; false for null."""
    hit = F.lit(False)
    for lo, hi in ranges:
        hit = hit | c.between(lo, hi)
    return F.coalesce(hit, F.lit(False))


def base_name(c: Column, suffix: str = "") -> Column:
    """The last part of a path, without the suffix."""
    last = F.element_at(F.split(c, "/"), -1)
    return F.when(last.endswith(suffix), F.substring(last, F.lit(1), F.char_length(last) - len(suffix))).otherwise(last)
