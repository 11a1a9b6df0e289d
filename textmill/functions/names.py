"""Column names: canonical forms and aliases, resolved when a plan is made."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_name(s: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", s.strip().lower()).strip("_")


def find_column(df: DataFrame, candidates: list[str], required: bool = False) -> Column:
    """The first of candidates that a column of df is called; of columns with the same canonical name, the last."""
    have = {canonical_name(c): c for c in df.columns}
    for name in candidates:
        if canonical_name(name) in have:
            return F.col(f"`{have[canonical_name(name)]}`")
    if required:
        raise ValueError(f"none of {candidates} is among {df.columns}")
    return F.lit("")


def ordered(df: DataFrame, first: list[str]) -> DataFrame:
    """df with the columns of `first` that it has in that order, then its others."""
    return df.select(*[c for c in first if c in df.columns], *[c for c in df.columns if c not in first])


def inserted(df: DataFrame, name: str, value: Column, at: int) -> DataFrame:
    rest = [c for c in df.columns if c != name]
    return df.select(*rest[:at], value.alias(name), *rest[at:])
