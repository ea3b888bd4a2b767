"""Labels, rounding, decay and the risk score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Emotions, in the order that breaks ties.
EMOTIONS = ("anger", "fear", "joy", "sadness", "anticipation", "disgust", "surprise", "trust")
# Share of a star that is left after each day.
DAILY_DECAY = 0.998
# Sentiment cut-offs (positive from, negative to), by scale.
CUTS = {"Valence_avg": (0.55, 0.45)}
DEFAULT_CUTS = (0.05, -0.05)


def round4(x: Column) -> Column:
    """Four decimals, halves away from zero on the binary value; one rule for all engines."""
    return F.signum(x) * F.floor(F.abs(x) * 10000 + 0.5) / 10000


def sentiment_label(name: str) -> Column:
    """positive, negative or neutral; NULL is neutral."""
    high, low = CUTS.get(name, DEFAULT_CUTS)
    c = F.col(name)
    return F.when(c >= high, "positive").when(c <= low, "negative").otherwise("neutral")


def contains_any(c: Column, values: list[str]) -> Column:
    """Case-blind substring test with white space collapsed; values are trimmed."""
    have = F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), "(?U)\\s+", " "))
    wanted = (" ".join(v.split()).lower() for v in values)
    return reduce(Column.__or__, (F.contains(have, F.lit(v)) for v in wanted))


def weighted_star(stars: Column, day: Column, anchor: Column) -> Column:
    """Stars decayed by whole days before ``anchor`` (never less than 0 days).

    A day that cannot be read, or no anchor, leaves the stars as they are;
    NULL stars stay NULL.
    """
    days = F.greatest(F.datediff(anchor, day), F.lit(0))
    return F.coalesce(round4(stars * F.pow(F.lit(DAILY_DECAY), days)), stars)


def dominant(scores: dict[str, Column], none: str = "neutral") -> Column:
    """Name of the greatest score; the first of equals; ``none`` if none is positive."""
    top = F.greatest(*scores.values())
    out = F.when(F.coalesce(top, F.lit(0.0)) <= 0, none)
    for name, score in scores.items():
        out = out.when(score == top, name)
    return out


def risk_score(stars: Column, low_star_rate: Column, sentiment: Column) -> Column:
    """0 to 1: 45 % missing stars, 35 % low-star share, 20 % negative sentiment."""
    missing = F.greatest(F.lit(0.0), (5.0 - stars) / 4.0)
    negative = F.greatest(F.lit(0.0), -F.coalesce(sentiment, F.lit(0.0)))
    return round4(F.least(F.lit(1.0), missing * 0.45 + low_star_rate * 0.35 + negative * 0.20))


def attention_tier(risk: Column) -> Column:
    return F.when(risk >= 0.65, "high").when(risk >= 0.40, "moderate").otherwise("monitor")


# The advice texts, by the first condition that holds.
FOCUS = (
    "Review recurring low-star pain points",
    "Investigate negative sentiment drivers",
    "Strengthen positive service moments",
    "Maintain performance and monitor trends",
)


def recommended_focus(low_star_rate: Column, sentiment: Column, joy: Column, sadness: Column) -> Column:
    return F.when(low_star_rate >= 0.35, FOCUS[0]).when(sentiment < -0.15, FOCUS[1]).when(joy < sadness, FOCUS[2]).otherwise(FOCUS[3])
