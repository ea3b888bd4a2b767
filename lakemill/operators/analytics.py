"""Descriptive, diagnostic, predictive and prescriptive analyses of reviews."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.functions.labels import EMOTIONS
from lakemill.operators.common import require_columns
from lakemill.operators.validate import safe_corr

# Words left out of pain points.
STOP_WORDS = (
    "the", "and", "for", "that", "this", "with", "you", "have", "are", "but", "not", "was", "were", "they", "from", "your", "their", "has",
    "had", "our", "all", "too", "just", "then", "what", "when", "there", "which", "will", "been", "into", "out", "about", "like", "theyre",
    "dont", "cant",
)
# Columns averaged per place, and their names in the result.
PLACE_MEANS = {
    "weighted_star": "business_weighted_star_avg", "word_count": "avg_review_length", "subjectivity_score": "avg_subjectivity", "negation_count": "negation_rate",
    "type_token_ratio": "avg_type_token_ratio", "noun_pct": "avg_noun_pct", "verb_pct": "avg_verb_pct", "adj_pct": "avg_adj_pct", "adv_pct": "avg_adv_pct",
    "person_count": "avg_person_mentions", "location_count": "avg_location_mentions", "product_count": "avg_product_mentions",
}
PLACE_KEYS = ("business_id", "name", "city", "state", "is_open", "dataset")


def place_profile(df: DataFrame) -> DataFrame:
    """One row per place and dataset: star and sentiment spread, emotion, means.

    Rows with a NULL key are left out. The mode is the smallest of equals.
    """
    require_columns(df, PLACE_KEYS, "place profile")
    known = reduce(Column.__and__, (F.col(k).isNotNull() for k in PLACE_KEYS))
    spread = [
        F.avg("stars").alias("business_star_avg"), F.stddev_samp("stars").alias("business_star_std"), F.min("stars").alias("business_star_min"),
        F.max("stars").alias("business_star_max"), F.median("stars").alias("business_star_median"), F.avg("vader_sentiment_score").alias("sentiment_score_mean"),
        F.stddev_samp("vader_sentiment_score").alias("sentiment_score_std"), F.median("vader_sentiment_score").alias("sentiment_score_median"),
        F.mode("dominant_emotion", True).alias("primary_emotion_mode"),
    ]
    means = [F.avg(c).alias(n) for c, n in PLACE_MEANS.items() if c in df.columns]
    return df.where(known).groupBy(*PLACE_KEYS).agg(F.count("review_id").alias("review_count"), *spread, *means)


def with_place_figures(df: DataFrame) -> DataFrame:
    """Append each review's place's mean stars and number of reviews.

    ``business_star_avg`` and ``place_reviews`` are NULL for a review without
    a place. Reviews meet their place in the shuffle that counts it: a window
    by place would gather a large place into one task, a join need not.
    """
    require_columns(df, {"business_id", "stars", "review_id"}, "place figures")
    places = df.where(F.col("business_id").isNotNull()).groupBy("business_id")
    return df.join(places.agg(F.avg("stars").alias("business_star_avg"), F.count("review_id").alias("place_reviews")), "business_id", "left")


def union_datasets(parts: dict[str, DataFrame]) -> DataFrame:
    """Stack datasets by column name, each tagged."""
    tagged = [df.withColumn("dataset", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def monthly_decay(df: DataFrame) -> DataFrame:
    """Mean stars and mean decayed stars, rescaled to the same overall mean, per month."""
    month = F.date_trunc("month", F.to_timestamp("review_date"))
    scale = df.agg(F.avg("stars").alias("a"), F.avg("weighted_star").alias("w")).select(F.when(F.col("w") > 0, F.col("a") / F.col("w")).otherwise(1.0).alias("scale"))
    per = df.where(F.col("review_date").isNotNull()).groupBy(month.alias("month")).agg(F.avg("stars").alias("actual"), F.avg("weighted_star").alias("decayed"))
    return per.crossJoin(F.broadcast(scale)).select("month", "actual", (F.col("decayed") * F.col("scale")).alias("weighted"))


def melt_monthly(monthly: DataFrame) -> DataFrame:
    return monthly.unpivot(["month"], ["actual", "weighted"], "series", "value")


def emotion_distribution(df: DataFrame, column: str = "dominant_emotion") -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("emotion")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "emotion")


def extreme_places(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` places with the best and the worst mean stars."""
    per = df.where(F.col("business_id").isNotNull()).groupBy("business_id").agg(F.avg("stars").alias("avg_stars"), F.count("*").alias("reviews"))
    best = per.orderBy(F.desc("avg_stars"), "business_id").limit(n).withColumn("side", F.lit("top"))
    return best.unionByName(per.orderBy("avg_stars", "business_id").limit(n).withColumn("side", F.lit("bottom")))


def emotion_averages(df: DataFrame) -> DataFrame:
    """Mean share of each emotion, and mean stars, one row."""
    return df.agg(*[F.avg(f"{e}_int_avg").alias(f"{e}_int_avg") for e in EMOTIONS if f"{e}_int_avg" in df.columns], F.avg("stars").alias("avg_stars"))


def star_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """feature, correlation with stars, over rows where all are present."""
    full = df.dropna(subset=["stars", *columns])
    row = full.agg(*[safe_corr(F.col(c), F.col("stars")).alias(c) for c in columns])
    return row.unpivot([], columns, "feature", "correlation")


def pain_points(df: DataFrame, text_col: str = "stripped_review", n: int = 20, below: float = 3.0) -> DataFrame:
    """Most frequent words of low-star reviews (three letters or more, no stop words)."""
    word = F.explode(F.regexp_extract_all(F.lower(text_col), F.lit("([\\p{L}\\p{N}_]+)"), 1)).alias("word")
    plain = F.col("word").rlike("^[a-z]{3,}$") & ~F.col("word").isin(*STOP_WORDS)
    counts = df.where(F.col("stars") < below).select(word).where(plain).groupBy("word").agg(F.count("*").alias("frequency"))
    return counts.orderBy(F.desc("frequency"), "word").limit(n)


def at_risk(df: DataFrame, months: int = 6) -> DataFrame:
    """Places whose stars fell between the last months and those before.

    One pass: both periods are conditional aggregates.
    """
    month = F.to_date(F.date_trunc("month", F.to_timestamp("review_date")))
    dated = df.where(F.col("business_id").isNotNull()).withColumn("m", month)
    last = dated.agg(F.max("m").alias("last"))
    cut, older = F.add_months("last", -months), F.add_months("last", -2 * months)
    recent, prior = F.col("m") >= cut, (F.col("m") >= older) & (F.col("m") < cut)
    low = F.col("stars") < 3
    per = dated.crossJoin(F.broadcast(last)).where(F.col("m") >= older).groupBy("business_id").agg(
        F.avg(F.when(recent, F.col("stars"))).alias("r"), F.count(F.when(recent, 1)).alias("recent_reviews"), F.count(F.when(recent & low, 1)).alias("recent_low"),
        F.avg(F.when(prior, F.col("stars"))).alias("p"), F.count(F.when(prior, 1)).alias("prior_reviews"),
    ).where(F.col("recent_reviews") > 0)
    recent_avg, prior_avg = F.coalesce("r", F.lit(0.0)), F.coalesce("p", F.lit(0.0))
    out = per.select(
        "business_id", recent_avg.alias("recent_avg"), prior_avg.alias("prior_avg"), "recent_reviews", "prior_reviews",
        (F.col("recent_low") / F.col("recent_reviews")).alias("recent_low_pct"), (prior_avg - recent_avg).alias("decline"),
    )
    flag = (F.col("decline") > 0.3) | ((F.col("recent_low_pct") > 0.25) & (F.col("recent_reviews") >= 10))
    return out.withColumn("at_risk_flag", flag).orderBy(F.desc("at_risk_flag"), F.desc("decline"), "business_id")


def monthly_series(df: DataFrame) -> DataFrame:
    """Mean stars for every month from first to last; gaps take the month before."""
    month = F.to_date(F.date_trunc("month", F.to_timestamp("review_date")))
    per = df.where(F.col("review_date").isNotNull()).groupBy(month.alias("month")).agg(F.avg("stars").alias("value"))
    span = per.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a IS NOT NULL")
    every = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    # one row per month: the ordering window sees a few hundred rows at most
    filled = F.last("value", ignorenulls=True).over(Window.orderBy("month"))
    return every.join(per, "month", "left").select("month", filled.alias("value"))


def forecast(series: DataFrame, periods: int = 6, order: int = 5) -> DataFrame:
    """History and ``periods`` months ahead: month, value, kind.

    An autoregression of ``order`` on monthly differences by least squares,
    an approximation of an integrated autoregressive model. Under twelve
    months, or when it cannot be fitted, the last value goes on.
    """

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("month")
        y = batch["value"].to_numpy(float)
        ahead = [y[-1]] * periods
        if len(y) >= 12:
            d = np.diff(y)
            x = np.column_stack([d[order - k - 1 : len(d) - k - 1] for k in range(order)])
            try:
                w, *_ = np.linalg.lstsq(x, d[order:], rcond=None)
                last, level, ahead = [*d[-order:]], y[-1], []
                for _ in range(periods):
                    step = float(np.dot(w, last[::-1]))
                    level += step
                    last = [*last[1:], step]
                    ahead.append(level)
            except np.linalg.LinAlgError:
                pass
        start = pd.Period(batch["month"].iloc[-1], "M")
        later = [(start + i + 1).to_timestamp().date() for i in range(periods)]
        return pd.DataFrame({"month": [*batch["month"], *later], "value": [*y, *np.clip(ahead, 1, 5)], "kind": ["history"] * len(y) + ["forecast"] * periods})

    return series.groupBy().applyInPandas(run, "month date, value double, kind string")


def recommendation(df: DataFrame, risks: DataFrame) -> DataFrame:
    """One row: HIGH for low stars with anger or fear, MODERATE for a place at risk, else LOW."""
    base = df.agg(F.avg("stars").alias("stars"), F.avg("anger_int_avg").alias("anger"), F.avg("fear_int_avg").alias("fear"))
    worst = risks.where("at_risk_flag").orderBy(F.desc("decline"), "business_id").limit(1).select("business_id", "decline")
    both = base.join(F.broadcast(worst), how="left", on=F.lit(True))
    high = (F.col("stars") < 4) & ((F.col("anger") > 0.015) | (F.col("fear") > 0.015))
    return both.select(
        F.when(high, "HIGH").when(F.col("business_id").isNotNull(), "MODERATE").otherwise("LOW").alias("priority"),
        F.when(high, F.least(F.lit(5.0), F.col("stars") + 10 * (F.col("anger") + F.col("fear")))).otherwise(F.col("decline")).alias("metric"),
        F.when(~F.coalesce(high, F.lit(False)), F.col("business_id")).alias("business_id"),
    )


def stratified_sample(df: DataFrame, size: int = 15_000, by: str = "stars", key: str = "review_id", seed: int = 222) -> DataFrame:
    """``size`` rows with each stratum's share, by largest remainder and hash.

    All rows when there are no more than ``size``. Strata are few (values of
    ``by``); the bound of ``size`` on the rank lets each task keep only so
    many rows of a stratum before the shuffle.
    """
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)).cast("binary")), 1, 8), 16, 10).cast("long")
    strata = df.groupBy(by).agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy()))
    exact = F.col("n") * F.least(F.lit(size), F.col("total")) / F.col("total")
    left = F.least(F.lit(size), F.col("total")) - F.sum(F.floor(exact)).over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy(F.desc(exact - F.floor(exact)), by))
    quota = strata.select(F.col(by).alias("__s"), (F.floor(exact) + F.when(place <= left, 1).otherwise(0)).alias("__q"), F.col("n").alias("__n"))
    tagged = df.withColumn("__h", h).join(quota, F.col(by).eqNullSafe(F.col("__s")))
    rank = F.row_number().over(Window.partitionBy("__s").orderBy("__h", key))
    return tagged.withColumn("__r", rank).where(F.col("__r") <= size).where("__r <= __q").select(*df.columns)
