"""Gold grains: one specification each, one aggregation for all.

A grain names its keys, how they are derived, and the dimensions that go with
a key; dimensions are taken in the same aggregation as the metrics (the least
non-null value, so that the result does not depend on row order).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.functions.labels import contains_any, sentiment_label
from lakemill.operators.common import require_columns
from lakemill.operators.filters import EMOTION_COLUMNS, SENTIMENT_COLUMNS
from lakemill.operators.measures import Grouping, grouped, present
from lakemill.operators.silver import sample_by_hash

# Metrics that are averaged where the input has them.
METRICS = (
    "stars", "weighted_star", "vader_sentiment_score", "Valence_avg", "Arousal_avg", "Dominance_avg", "word_count", "subjectivity_score",
    "anger_int_avg", "fear_int_avg", "joy_int_avg", "sadness_int_avg",
)
# What describes a place, by result name: source column and type.
PLACE = {
    "business_name": ("name", None), "city": ("city", None), "state": ("state", None), "latitude": ("latitude", "double"), "longitude": ("longitude", "double"),
    "primary_industry": ("primary_industry", None),
}
# Periods of the date grain.
PERIODS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Grain:
    """Keys as (name, expression); ``blank`` says whether keys may be NULL or ''."""

    keys: dict[str, Column]
    needs: tuple[str, ...]
    value: Column
    null_keys: bool = False
    drop_blank: bool = False
    dimensions: dict[str, tuple[str, str | None]] = field(default_factory=dict)
    means: dict[str, str] = field(default_factory=dict)


def grain(level: str, period: str = "month", emotion_column: str = "dominant_emotion", sentiment_column: str = "vader_sentiment_score") -> Grain:
    """The specification of an aggregated Gold level."""
    if period not in PERIODS:
        raise ValueError(f"unknown period: {period}")
    if emotion_column not in EMOTION_COLUMNS or sentiment_column not in SENTIMENT_COLUMNS:
        raise ValueError(f"unknown emotion or sentiment column: {emotion_column}, {sentiment_column}")
    c, state, city = F.col, F.upper(F.trim("state")), F.trim("city")
    made = {
        "business": lambda: Grain(
            {"business_id": c("business_id")}, ("business_id",), c("business_id"), null_keys=True,
            dimensions=PLACE,
        ),
        "user": lambda: Grain({"user_id": c("user_id")}, ("user_id",), c("user_id"), null_keys=True, dimensions={"user_name": ("user_name", None)}),
        "date": lambda: Grain({"date_period": F.date_trunc(period, F.to_timestamp("review_date"))}, ("review_date",), c("date_period").cast("string")),
        "industry": lambda: Grain({"primary_industry": c("primary_industry")}, ("primary_industry",), c("primary_industry")),
        "state": lambda: Grain({"state": state}, ("state",), c("state"), drop_blank=True),
        "city-of-state": lambda: Grain(
            {"state": state, "city": city}, ("state", "city"), F.concat_ws(" | ", "state", "city"), drop_blank=True,
            means={"centroid_latitude": "latitude", "centroid_longitude": "longitude"},
        ),
        "sentiment": lambda: Grain({"sentiment_label": sentiment_label(sentiment_column)}, (sentiment_column,), c("sentiment_label")),
        "emotion": lambda: Grain({"emotion_label": F.lower(emotion_column)}, (emotion_column,), c("emotion_label")),
    }
    if level not in made:
        raise ValueError(f"unknown Gold level: {level}")
    return made[level]()


GRAIN_KEYS = {
    "sample": ("review_id",), "brand-sample": ("gold_variant_value", "review_id"), "business": ("business_id",), "user": ("user_id",), "date": ("date_period",),
    "industry": ("primary_industry",), "state": ("state",), "city-of-state": ("state", "city"), "sentiment": ("sentiment_label",), "emotion": ("emotion_label",),
}


DISTINCT = {"unique_business_count": "business_id", "unique_user_count": "user_id"}


def aggregate(df: DataFrame, level: str, **options) -> DataFrame:
    """One Gold grain in one aggregation."""
    g = grain(level, **options)
    require_columns(df, g.needs, f"Gold by {level}")
    keyed = df.select(*[F.col(c) for c in df.columns if c not in g.keys], *[e.alias(k) for k, e in g.keys.items()])
    for key in g.keys:
        if not g.null_keys:
            keyed = keyed.where(F.col(key).isNotNull())
        if g.drop_blank:
            keyed = keyed.where(F.col(key) != "")
    known = reduce(Column.__and__, (F.col(k).isNotNull() for k in g.keys))
    means = present(df, METRICS) | (g.means if set(g.means.values()) <= set(df.columns) else {})
    out = grouped(keyed, Grouping(tuple(g.keys), means, g.dimensions, DISTINCT), known)
    return out.withColumns({"gold_variant_level": F.lit(level), "gold_variant_value": g.value})


def brand_sample(df: DataFrame, brands: list[str], size: int, seed: int = 42, by: str = "xxhash64") -> DataFrame:
    """Up to ``size`` reviews of each brand by hash, in one pass.

    A review is taken once for each brand that its place's name contains.
    Rows are ranked per brand; the ranking keeps only ``size`` rows of a
    brand from each task before the shuffle.
    """
    if not brands:
        raise ValueError("a brand sample needs at least one brand")
    if size is None or size < 1:
        raise ValueError("a brand sample needs a size of at least 1")
    hit = F.array_compact(F.array(*[F.when(contains_any(F.col("name"), [b]), F.lit(b)) for b in brands]))
    tagged = df.withColumn("gold_variant_value", F.explode(hit))
    order = F.xxhash64(F.lit(int(seed)), F.col("review_id")) if by == "xxhash64" else F.md5(F.concat(F.lit(f"{seed}:"), F.col("review_id")).cast("binary"))
    rank = F.row_number().over(Window.partitionBy("gold_variant_value").orderBy(order, "review_id"))
    return (
        tagged.withColumn("__rank", rank).where(F.col("__rank") <= size).drop("__rank")
        .withColumns({"gold_variant_level": F.lit("brand-sample"), "gold_sample_seed": F.lit(int(seed))})
    )


def build_gold(df: DataFrame, level: str, size: int | None = None, seed: int = 42, brands: list[str] | None = None, by: str = "xxhash64", **options) -> DataFrame:
    """Any Gold level: a sample, a brand sample or an aggregated grain."""
    if level == "brand-sample":
        return brand_sample(df, brands or [], size, seed, by)
    if level == "sample":
        if size is None:
            raise ValueError("a sample needs a size")
        tags = {"gold_variant_level": F.lit("sample"), "gold_variant_value": F.lit("filtered_reviews"), "gold_sample_seed": F.lit(int(seed))}
        return sample_by_hash(df, size, seed, by=by).withColumns(tags)
    return aggregate(df, level, **options)


def effective_size(requested: int | None, eligible: int) -> int | None:
    """The size that can be had: None stays None."""
    if eligible < 0 or (requested is not None and requested < 1):
        raise ValueError("sizes must be at least 1, eligible rows at least 0")
    return None if requested is None else min(requested, eligible)
