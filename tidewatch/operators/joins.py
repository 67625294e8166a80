"""Joins of two tables of the same kind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_on_keys(left: DataFrame, right: DataFrame, keys: list[str], suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Inner join on several keys that together nearly identify a row; columns
    of both sides other than the keys get a suffix.

    Rows of equal keys pair up, as in any inner join, so the output is linear
    in the input only as far as the keys are near unique.  A null key matches nothing."""
    clash = (set(left.columns) & set(right.columns)) - set(keys)

    def named(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*[F.col(f"`{c}`").alias(c + suffix if c in clash else c) for c in df.columns])

    return named(left, suffixes[0]).join(named(right, suffixes[1]), keys, "inner")
