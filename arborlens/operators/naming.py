"""A site's names of columns, put into the library's words and back.

A column of the site that happens to bear one of the library's names but means something else is set
aside under another name, and gets its own back at the end.
"""

from __future__ import annotations

from arborlens.config import Census
from pyspark.sql import DataFrame

_ASIDE = "_site_"


def to_library(df: DataFrame, census: Census) -> DataFrame:
    """df with the library's names. Listed columns that df lacks stay missing, so that rules without them are skipped. Names are matched without regard to case, as Spark does."""
    ours = {site.lower(): library for library, site in census.columns}
    taken = {library.lower() for library in ours.values()}
    return df.toDF(*[ours.get(c.lower()) or (f"{_ASIDE}{c}" if c.lower() in taken else c) for c in df.columns])


def to_site(df: DataFrame, census: Census) -> DataFrame:
    """df with the site's names, as they were before ``to_library``; columns made in between keep theirs, behind an underscore where the site has the name already."""
    theirs = {library: site for library, site in census.columns}
    named = [theirs.get(c, c.removeprefix(_ASIDE)) for c in df.columns]
    first = {c for c, n in zip(df.columns, named, strict=True) if c != n}
    held = {n.lower() for c, n in zip(df.columns, named, strict=True) if c in first}
    return df.toDF(*[n if c in first or n.lower() not in held else f"_{n}" for c, n in zip(df.columns, named, strict=True)])
