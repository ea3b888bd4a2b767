"""Combinable review filters: families are AND-ed, the values of one OR-ed."""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.labels import contains_any, sentiment_label
from lakemill.operators.common import require_columns
from lakemill.operators.silver import INDUSTRIES

EMOTION_COLUMNS = ("dominant_emotion", "primary_emotion_lex", "hf_emotion_label")
SENTIMENT_COLUMNS = ("vader_sentiment_score", "hf_computed_sentiment", "affect_sentiment_avg", "Valence_avg")


@dataclass(frozen=True)
class ReviewFilter:
    """What to keep; None or empty means no condition."""

    business_ids: list[str] | None = None
    business_names: list[str] | None = None
    user_ids: list[str] | None = None
    industries: list[str] | None = None
    cities: list[str] | None = None
    states: list[str] | None = None
    start_date: str | None = None
    end_date: str | None = None
    sentiment_labels: list[str] | None = None
    emotion_labels: list[str] | None = None
    min_sentiment: float | None = None
    max_sentiment: float | None = None
    min_stars: float | None = None
    max_stars: float | None = None
    sentiment_column: str = "vader_sentiment_score"
    emotion_column: str = "dominant_emotion"

    def __post_init__(self) -> None:
        if self.sentiment_column not in SENTIMENT_COLUMNS or self.emotion_column not in EMOTION_COLUMNS:
            raise ValueError(f"unknown sentiment or emotion column: {self.sentiment_column}, {self.emotion_column}")
        if self.start_date and self.end_date and self.start_date > self.end_date:
            raise ValueError("start date is after end date")
        for low, high, what in ((self.min_sentiment, self.max_sentiment, "sentiment"), (self.min_stars, self.max_stars, "stars")):
            if low is not None and high is not None and low > high:
                raise ValueError(f"minimum {what} is over the maximum")

    def conditions(self, df: DataFrame) -> list[Column]:
        """One column per family in use; ValueError where its column is missing."""
        out: list[Column] = []

        def add(value, column: str, make) -> None:
            if value is not None and value != []:
                require_columns(df, {column}, f"filtering by {column}")
                out.append(make(F.col(column)))

        day = F.to_date("review_date")
        add(self.business_ids, "business_id", lambda c: c.isin(self.business_ids))
        add(self.business_names, "name", lambda c: contains_any(c, self.business_names))
        add(self.user_ids, "user_id", lambda c: c.isin(self.user_ids))
        if self.industries:
            have = [c for c in INDUSTRIES if c in df.columns]
            if not have:
                raise ValueError("filtering by industry needs an industry column")
            out.append(reduce(Column.__or__, (contains_any(F.col(c), self.industries) for c in have)))
        add(self.cities, "city", lambda c: F.lower(c).isin([v.lower() for v in self.cities]))
        add(self.states, "state", lambda c: F.upper(c).isin([v.upper() for v in self.states]))
        add(self.start_date, "review_date", lambda _: day >= F.lit(self.start_date).cast("date"))
        add(self.end_date, "review_date", lambda _: day <= F.lit(self.end_date).cast("date"))
        add(self.sentiment_labels, self.sentiment_column, lambda _: sentiment_label(self.sentiment_column).isin(self.sentiment_labels))
        add(self.emotion_labels, self.emotion_column, lambda c: F.lower(c).isin([v.lower() for v in self.emotion_labels]))
        add(self.min_sentiment, self.sentiment_column, lambda c: c >= self.min_sentiment)
        add(self.max_sentiment, self.sentiment_column, lambda c: c <= self.max_sentiment)
        add(self.min_stars, "stars", lambda c: c >= self.min_stars)
        add(self.max_stars, "stars", lambda c: c <= self.max_stars)
        return out


def apply_filter(df: DataFrame, wanted: ReviewFilter | None = None, **options) -> DataFrame:
    """Rows that meet every family of ``wanted`` (or of a filter of ``options``)."""
    if wanted is None:
        unknown = set(options) - {f.name for f in fields(ReviewFilter)}
        if unknown:
            raise ValueError(f"unknown filters: {sorted(unknown)}")
        wanted = ReviewFilter(**options)
    return reduce(lambda d, c: d.where(c), wanted.conditions(df), df)


def priority_filter(df: DataFrame, business_id: str | None = None, name: str | None = None, state: str | None = None, city: str | None = None) -> tuple[DataFrame, str]:
    """The most specific of id, name, city (within a state), state; and what was used."""
    same = lambda c, v: F.lower(F.trim(c)) == v.strip().lower()
    if business_id:
        return df.where(F.col("business_id") == business_id), f"business {business_id}"
    if name:
        return df.where(contains_any(F.col("name"), [name])), f"name {name}"
    if city:
        found = df.where(same("city", city))
        return (found.where(same("state", state)), f"city {city}, {state}") if state else (found, f"city {city}")
    if state:
        return df.where(same("state", state)), f"state {state}"
    return df, "all"
