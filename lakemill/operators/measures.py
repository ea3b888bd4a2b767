"""Measures of groups of reviews: one engine for Gold grains and serving tables.

A grouping says what it averages and which dimensions it carries; counts, the
low-star share, means and dimensions are taken in one aggregation.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: stars that count as low
LOW_STARS = 2


@dataclass(frozen=True)
class Grouping:
    """What one row per group holds beside review_count and low_star_rate."""

    keys: tuple[str, ...]
    #: result name to the column that is averaged
    means: dict[str, str] = field(default_factory=dict)
    #: result name to (column, type or None): its least value
    dimensions: dict[str, tuple[str, str | None]] = field(default_factory=dict)
    #: result name to the column whose distinct values are counted
    distinct: dict[str, str] = field(default_factory=dict)
    #: whether a mean of a column that is missing is a NULL (or is left out)
    shim: bool = False


def _source(df: DataFrame, column: str, kind: str | None) -> Column:
    if column not in df.columns:
        return F.lit(None).cast(kind or "string")
    return F.col(column).cast(kind) if kind else F.col(column)


def measure(df: DataFrame, g: Grouping, known: Column | None = None) -> list[Column]:
    """The aggregates of a grouping. Dimensions are taken where ``known`` holds.

    NULL stars count as not low. A column that is also a key is not counted
    here: see :func:`grouped`.
    """
    low = F.when(F.col("stars") <= LOW_STARS, 1.0).otherwise(0.0)
    out = [F.count("review_id").alias("review_count"), F.avg(low).alias("low_star_rate")]
    out += [F.avg(_source(df, c, "double" if c not in df.columns else None)).alias(n) for n, c in g.means.items() if g.shim or c in df.columns]
    for name, (column, kind) in g.dimensions.items():
        value = _source(df, column, kind)
        out.append(F.min(value if known is None else F.when(known, value)).alias(name))
    return out + [F.count_distinct(F.col(c)).alias(n) for n, c in g.distinct.items() if c not in g.keys]


def grouped(df: DataFrame, g: Grouping, known: Column | None = None) -> DataFrame:
    """One row per group in one aggregation.

    The distinct values of a key are one in each group (none for NULL), so
    they are not counted: a grain by place or user has one distinct count and
    no row is expanded for a second one.
    """
    out = df.groupBy(*g.keys).agg(*measure(df, g, known))
    own = {n: F.col(c).isNotNull().cast("long") for n, c in g.distinct.items() if c in g.keys}
    return out.withColumns(own) if own else out


def present(df: DataFrame, columns: Iterable[str], prefix: str = "avg_") -> dict[str, str]:
    """Means of the columns that a frame has."""
    return {f"{prefix}{c}": c for c in columns if c in df.columns}
