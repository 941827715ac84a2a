"""Error codes as arrays of strings in rule order, and their text form.

A rule yields its code or null (passed, or undetermined for lack of data). White space in
the text form is normalised: codes are joined by one blank, no code gives the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_when(condition: Column, code: str) -> Column:
    """The code where the condition is true; null where it is false or unknown."""
    return F.when(condition, F.lit(code))


def collect(codes: list[Column]) -> Column:
    """The codes that apply, in order."""
    return F.array_compact(F.array(*codes)) if codes else F.array().cast("array<string>")


def append(codes: Column, code: Column) -> Column:
    return F.array_compact(F.concat(F.coalesce(codes, F.array().cast("array<string>")), F.array(code)))


def render(codes: Column) -> Column:
    return F.array_join(codes, " ")


def has_error(codes: Column) -> Column:
    return F.size(codes) > 0


def without(codes: Column, number: str) -> Column:
    """The codes but those of the rule with this number."""
    return F.filter(codes, lambda c: ~c.startswith(f"{number}_"))
