"""Serving tables and the reads of a dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions.labels import attention_tier, recommended_focus, risk_score
from lakemill.operators.common import require_columns
from lakemill.operators.gold import PLACE
from lakemill.operators.measures import Grouping, grouped

ROW_LEVELS = ("sample", "brand-sample")


# Means of the serving tables, by result name.
VARIANT_MEANS = {"avg_stars": "stars", "avg_sentiment": "vader_sentiment_score"}
EMOTION_MEANS = {f"avg_{e}": f"{e}_int_avg" for e in ("anger", "fear", "sadness", "joy")}
BUSINESSES = Grouping(
    ("gold_variant_value", "business_id"), VARIANT_MEANS | {"avg_weighted_star": "weighted_star"} | EMOTION_MEANS,
    {name: (source, kind or "string") for name, (source, kind) in PLACE.items()}, shim=True,
)
MONTHS = Grouping(("gold_variant_value", "year_month", "primary_industry"), VARIANT_MEANS, shim=True)
VARIANTS = Grouping(("gold_variant_value",), VARIANT_MEANS, shim=True)


def business_summary(gold: DataFrame) -> DataFrame:
    """Per variant and place: counts, means, risk score, tier and focus."""
    base = grouped(gold, BUSINESSES)
    c = F.col
    scored = base.withColumn("risk_score", risk_score(c("avg_stars"), c("low_star_rate"), c("avg_sentiment")))
    return scored.withColumns(
        {
            "attention_tier": attention_tier(c("risk_score")),
            "recommended_focus": recommended_focus(c("low_star_rate"), c("avg_sentiment"), c("avg_joy"), c("avg_sadness")),
        }
    )


def monthly_summary(gold: DataFrame) -> DataFrame:
    """Per variant, month and industry; NULL groups stay."""
    month = F.date_format("review_date", "yyyy-MM")
    if "year_month" in gold.columns:
        month = F.coalesce("year_month", month)
    return grouped(gold.withColumn("year_month", month), MONTHS)


def top_businesses(summary: DataFrame, n: int = 10_000) -> DataFrame:
    return summary.orderBy(F.desc("review_count"), "gold_variant_value", "business_id").limit(n)


def first_months(monthly: DataFrame, n: int = 50_000) -> DataFrame:
    return monthly.where(F.col("year_month").isNotNull()).orderBy("year_month", "gold_variant_value", "primary_industry").limit(n)


def latest_reviews(gold: DataFrame, n: int = 30_000) -> DataFrame:
    return gold.orderBy(F.desc("review_date"), "review_id").limit(n)


def dashboard_filter(summary: DataFrame, min_reviews: int = 1, variants: list[str] | None = None, states: list[str] | None = None, industries: list[str] | None = None, mapped: bool = False) -> DataFrame:
    """Rows with enough reviews, of the chosen values; ``mapped`` needs coordinates."""
    out = summary.where(F.col("review_count") >= min_reviews)
    for column, values in (("gold_variant_value", variants), ("state", states), ("primary_industry", industries)):
        if values:
            out = out.where(F.col(column).isin(values))
    return out.dropna(subset=["latitude", "longitude"]) if mapped else out


def state_rollup(summary: DataFrame) -> DataFrame:
    """Means of the places of a state, weighted by reviews (NULLs carry no weight)."""
    weigh = lambda c: (F.sum(F.col(c) * F.col("review_count")) / F.sum(F.when(F.col(c).isNotNull(), F.col("review_count")))).alias(c)
    return summary.where(F.col("state").isNotNull()).groupBy("state").agg(
        F.sum("review_count").alias("review_count"), F.count("*").alias("businesses"), weigh("avg_stars"), weigh("avg_sentiment"), weigh("risk_score")
    )


def variant_summary(gold: DataFrame) -> DataFrame:
    return grouped(gold, VARIANTS).drop("low_star_rate")


def rating_histogram(gold: DataFrame) -> DataFrame:
    return gold.where(F.col("stars").isNotNull()).groupBy("gold_variant_value", "stars").agg(F.count("*").alias("review_count"))


def leading_industries(monthly: DataFrame, n: int = 8) -> DataFrame:
    """Monthly rows of the ``n`` industries with most reviews."""
    top = (
        monthly.where(F.col("primary_industry").isNotNull()).groupBy("primary_industry").agg(F.sum("review_count").alias("n"))
        .orderBy(F.desc("n"), "primary_industry").limit(n).select("primary_industry")
    )
    return monthly.join(F.broadcast(top), "primary_industry", "left_semi")


def priority_list(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.desc("risk_score"), F.desc("review_count"), "gold_variant_value", "business_id")


def check_row_level(gold: DataFrame) -> None:
    """Serving tables are made of row-level Gold only."""
    require_columns(gold, {"review_id", "business_id", "stars", "primary_industry", "gold_variant_level", "gold_variant_value"}, "serving tables")
    found = {r[0] for r in gold.select("gold_variant_level").distinct().limit(len(ROW_LEVELS) + 1).collect()}
    if not found:
        raise AssertionError("Gold is empty")
    if found - set(ROW_LEVELS):
        raise ValueError(f"serving tables need row-level Gold, not {sorted(found, key=str)}")
