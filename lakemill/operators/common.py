"""Guards shared by operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, needed: Iterable[str], purpose: str) -> None:
    if missing := sorted(set(needed) - set(df.columns)):
        raise ValueError(f"{purpose} needs columns that are missing: {missing}")


def require_rows(df: DataFrame, what: str) -> int:
    n = df.count()
    if not n:
        raise AssertionError(f"{what} is empty")
    return n
