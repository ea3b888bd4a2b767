"""The review-level Silver table, sampling and scoping of related tables.

Silver is declared once, as a list of its columns with the dataset, column and
type each comes from; the join and the jobs' checks read that declaration.
"""

from __future__ import annotations

from collections.abc import Collection
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.operators.common import require_columns

INDUSTRIES = ("primary_industry", "secondary_industry", "tertiary_industry")


class From(NamedTuple):
    """Where a Silver column comes from; no type keeps that of the source."""

    dataset: str
    column: str
    kind: str | None = None


# The columns of Silver before features, in their order.
SILVER = {
    "review_id": From("review", "review_id"),
    "user_id": From("review", "user_id"),
    "business_id": From("review", "business_id"),
    "stars": From("review", "stars", "double"),
    "review_date": From("review", "date", "date"),
    "raw_review": From("review", "text"),
    "name": From("business", "name"),
    "city": From("business", "city"),
    "state": From("business", "state"),
    "latitude": From("business", "latitude", "double"),
    "longitude": From("business", "longitude", "double"),
    "business_review_count": From("business", "review_count", "long"),
    "is_open": From("business", "is_open", "long"),
    "user_name": From("user", "name"),
    "user_review_count": From("user", "review_count", "long"),
    "user_stars_avg": From("user", "average_stars", "double"),
}
KEYS = {"review": "review_id", "business": "business_id", "user": "user_id"}


def one_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key, whatever the order of rows: the least by its other
    columns, from left to right (NULL least). Rows with a NULL key count as one key."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row")).select(*keys, "__row.*").select(*df.columns)


def known_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows that have the key."""
    return df.where(F.col(key).isNotNull())


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The key's values, each once, without NULL."""
    return known_keys(df, key).select(key).distinct()


def silver_side(df: DataFrame, dataset: str, unique: bool = False, extra: Collection[str] = ()) -> DataFrame:
    """A dataset's part of Silver with its key, one row per key.

    ``unique`` says that the key is known to be unique (``validate_bronze``
    has checked it), which saves the shuffle that makes it so.
    """
    own = {name: at for name, at in SILVER.items() if at.dataset == dataset}
    own = {KEYS[dataset]: From(dataset, KEYS[dataset])} | own
    require_columns(df, {at.column for at in own.values()}, f"Silver from {dataset}")
    out = df.select(*[(F.col(at.column).cast(at.kind) if at.kind else F.col(at.column)).alias(n) for n, at in own.items()], *[c for c in extra if c in df.columns])
    return out if unique else one_per_key(out, KEYS[dataset])


def build_silver(reviews: DataFrame, places: DataFrame, users: DataFrame, broadcast_places: bool = False, unique: Collection[str] = ()) -> DataFrame:
    """Reviews with their place and user, one row per review_id.

    ``unique`` names the datasets whose keys are known to be unique; the
    others are made so first, by the least row of a key. ``broadcast_places``
    is for a place table of checked size; otherwise adaptive execution decides.
    """
    review = silver_side(reviews, "review", "review" in unique)
    place = silver_side(places, "business", "business" in unique, ("categories",))
    user = silver_side(users, "user", "user" in unique)
    joined = review.join(F.broadcast(place) if broadcast_places else place, KEYS["business"], "left").join(user, KEYS["user"], "left")
    month = F.date_format("review_date", "yyyy-MM").alias("year_month")
    return with_industries(joined.select(*SILVER, month, *[c for c in ("categories",) if c in joined.columns]))


def with_industries(df: DataFrame) -> DataFrame:
    """Replace ``categories`` by its first three entries (NULL where missing or blank)."""
    if "categories" not in df.columns:
        return df
    parts = F.split(F.coalesce("categories", F.lit("")), "\\s*,\\s*")
    named = {name: F.nullif(F.trim(F.get(parts, F.lit(i))), F.lit("")) for i, name in enumerate(INDUSTRIES)}
    return df.withColumns(named).drop("categories")


def sample_by_hash(df: DataFrame, size: int | None, seed: int = 42, key: str = "review_id", by: str = "xxhash64") -> DataFrame:
    """The ``size`` rows least by hash of (seed, key): the same for any partitioning.

    ``by`` is xxhash64, or md5 (which other engines share). None takes all.
    """
    if size is None:
        return df
    if size < 1:
        raise ValueError("sample size must be at least 1")
    order = F.xxhash64(F.lit(int(seed)), F.col(key)) if by == "xxhash64" else F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)).cast("binary"))
    return df.orderBy(order, F.col(key)).limit(size)


def scope_related(df: DataFrame, name: str, selected: DataFrame) -> DataFrame:
    """Rows of a related table that belong to the selected reviews."""
    keys = KEYS | {"checkin": KEYS["business"], "tip": KEYS["business"]}
    if name not in keys:
        raise ValueError(f"unknown dataset: {name}")
    if name == "review":
        return selected
    key = keys[name]
    require_columns(selected, {key}, f"scoping {name}")
    return df.join(distinct_keys(selected, key), key, "left_semi")
