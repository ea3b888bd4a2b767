"""Gates: each computes its measures in one or two aggregations and raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lakemill.functions.features import OWNED
from lakemill.functions.text import words, clean
from lakemill.operators.common import require_columns
from lakemill.operators.gold import GRAIN_KEYS

UNIQUE_DATASETS = ("review", "business", "user")


def _fail(what: str, failures: list[str]) -> None:
    if failures:
        raise AssertionError(f"{what} failed: " + "; ".join(failures))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation, NULL where either side is constant or empty.

    One pass of sums rather than corr(), which raises under ANSI for a constant.
    """
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """rows, null_keys and repeated_keys in one row."""
    per = df.groupBy(key).agg(F.count("*").alias("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull() & (F.col("n") > 1), 1)), F.lit(0)).cast("long").alias("repeated_keys"),
    )


def key_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of each key (NULL is a key), as ``count``."""
    return df.groupBy(*keys).count()


def repeats(df: DataFrame, *keys: str) -> DataFrame:
    """One row: whether any key repeats."""
    return key_counts(df, *keys).where("count > 1").limit(1).agg((F.count("*") > 0).alias("repeats"))


def extremes(c: str) -> tuple[Column, Column]:
    """Least and greatest value of a column: a constant one has equal ones."""
    return F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")


def validate_bronze(df: DataFrame, name: str, key: str, allow_empty: bool = False) -> int:
    """Key present, rows present, no NULL keys, unique keys where they identify."""
    require_columns(df, {key}, f"Bronze {name}")
    got = key_profile(df, key).first()
    failures = []
    if not got.row_count and not allow_empty:
        failures.append("it has no rows")
    if got.null_keys:
        failures.append(f"{got.null_keys} rows have no {key}")
    if name in UNIQUE_DATASETS and got.repeated_keys:
        failures.append(f"{got.repeated_keys} values of {key} repeat")
    _fail(f"Bronze {name}", failures)
    return got.row_count


def silver_measures(df: DataFrame, text_col: str = "stripped_review", changing: tuple[str, ...] = OWNED) -> DataFrame:
    """One row of measures over a Silver table with features."""
    have = set(df.columns)
    nonzero = lambda c: F.avg(F.when(F.col(c) != 0, 1.0).otherwise(0.0)).alias(f"nonzero_{c}")
    out = [F.count("*").alias("row_count")]
    if {"word_count", text_col} <= have:
        out.append(safe_corr(F.col("word_count"), F.size(words(clean(F.col(text_col))))).alias("corr_word_count"))
    out += [safe_corr(F.col(c), F.col("stars")).alias(f"corr_{c}") for c in ("vader_sentiment_score", "Valence_avg") if c in have]
    out += [nonzero(c) for c in ("worry_word_count", "wcst_warmth_avg", "affect_sentiment_avg") if c in have]
    if "weighted_star" in have:
        same = F.col("weighted_star") == F.col("stars")
        out.append(F.avg(F.when(same, 1.0).otherwise(0.0)).alias("same_weighted_star"))
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name in changing and f.name not in ("num_at", "num_hash")]
    out += [low.eqNullSafe(high).alias(f"constant_{c}") for c in numeric for low, high in [extremes(c)]]
    return df.agg(*out)


def validate_silver(df: DataFrame, text_col: str = "stripped_review") -> dict:
    """All gates on a Silver table with features; an undefined correlation fails."""
    got = silver_measures(df, text_col).first().asDict()
    failures = [] if got["row_count"] else ["it has no rows"]
    # Least correlation or share of each measure.
    least = {"corr_word_count": 0.9, "corr_vader_sentiment_score": 0.3, "corr_Valence_avg": 0.2}
    failures += [f"{k} is {got[k]}, under {v}" for k, v in least.items() if k in got and (got[k] is None or not got[k] >= v)]
    failures += [f"{k[9:]} is constant" for k, v in got.items() if k.startswith("constant_") and v]
    failures += [f"{k[8:]} is zero nearly everywhere: no lexicon?" for k, v in got.items() if k.startswith("nonzero_") and not (v or 0) >= 0.01]
    if (got.get("same_weighted_star") or 0) > 0.999:
        failures.append("weighted_star equals stars: no decay?")
    _fail("Silver", failures)
    return got


def validate_small(df: DataFrame, text_col: str = "stripped_review", most_rows: int = 500_000) -> dict:
    """The same gates for a table that must be small."""
    if df.limit(most_rows + 1).count() > most_rows:
        raise ValueError(f"more than {most_rows} rows; use validate_silver")
    return validate_silver(df, text_col)


def validate_gold(df: DataFrame, level: str, size: int | None = None, brands: list[str] | None = None) -> dict:
    """Rows present, unique keys, sizes kept, every brand found."""
    keys = GRAIN_KEYS[level]
    got = key_counts(df, *keys).agg(F.sum("count").alias("n"), F.max("count").alias("most")).first()
    failures = [] if got.n else ["it has no rows"]
    if (got.most or 0) > 1:
        failures.append(f"keys {list(keys)} are not unique")
    if level == "sample" and size is not None and (got.n or 0) > size:
        failures.append("there are more rows than asked for")
    if level == "brand-sample":
        found = {r[0]: r[1] for r in df.groupBy("gold_variant_value").count().collect()}  # one row per brand asked for
        if size is not None and max(found.values(), default=0) > size:
            failures.append("a brand has more rows than asked for")
        if lost := sorted(set(brands or ()) - set(found)):
            failures.append(f"no reviews of {lost}")
    _fail(f"Gold {level}", failures)
    return {"passed": True, "gold_level": level, "gold_rows": got.n, "most_rows_of_a_key": got.most, "keys": list(keys)}


def validate_parity_of_rows(silver: DataFrame, bronze: DataFrame) -> dict[str, int]:
    """Silver has as many rows as the Bronze reviews."""
    got = {"silver_rows": silver.count(), "bronze_rows": bronze.count()}
    _fail("Silver", [] if len(set(got.values())) == 1 else [f"{got['silver_rows']} rows, Bronze reviews have {got['bronze_rows']}"])
    return got


def validate_serving(summary: DataFrame, monthly: DataFrame) -> dict:
    """Serving tables are not empty and places are unique in a variant."""
    got = key_counts(summary, "gold_variant_value", "business_id").agg(F.count("*").alias("n"), F.sum("count").alias("places"), F.max("count").alias("most")).first()
    months = monthly.limit(1).count()
    _fail("serving tables", ["no places"] * (not got.n) + ["places repeat in a variant"] * ((got.most or 0) > 1) + ["no months"] * (not months))
    return {"businesses": got.places, "keys": got.n}


def compare_frames(a: DataFrame, b: DataFrame, key: str, columns: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Mismatch counts per column over a full join on the key, one row.

    Numbers differ beyond ``tolerance``, other values by equality, NULL only
    from not NULL; only_left and only_right count unmatched keys.
    """
    for df, side in ((a, "left"), (b, "right")):
        require_columns(df, {key, *columns}, f"comparison ({side})")
    numeric = {f.name for f in a.schema if isinstance(f.dataType, NumericType)}
    l = a.select(F.col(key).alias("k"), *[F.col(c).alias(f"l_{i}") for i, c in enumerate(columns)], F.lit(True).alias("l"))
    r = b.select(F.col(key).alias("k"), *[F.col(c).alias(f"r_{i}") for i, c in enumerate(columns)], F.lit(True).alias("r"))
    joined = l.join(r, "k", "full")
    both = F.col("l").isNotNull() & F.col("r").isNotNull()

    def differs(i: int, c: str) -> Column:
        x, y = F.col(f"l_{i}"), F.col(f"r_{i}")
        far = F.abs(x.cast("double") - y.cast("double")) > tolerance if c in numeric else x.cast("string") != y.cast("string")
        return F.count(F.when(both & ((x.isNull() != y.isNull()) | far), 1)).alias(f"diff_{c}")

    return joined.agg(
        F.count(F.when(F.col("r").isNull(), 1)).alias("only_left"), F.count(F.when(F.col("l").isNull(), 1)).alias("only_right"),
        *[differs(i, c) for i, c in enumerate(columns)],
    )


def assert_same(a: DataFrame, b: DataFrame, key: str, columns: list[str], tolerance: float = 1e-6) -> None:
    """Raise unless both have the same unique keys and equal values."""
    failures = []
    for df, side in ((a, "left"), (b, "right")):
        got = key_profile(df, key).first()
        if got.null_keys or got.repeated_keys:
            failures.append(f"{side}: keys are missing or repeat")
    got = compare_frames(a, b, key, columns, tolerance).first().asDict()
    failures += [f"{k}: {v}" for k, v in got.items() if v]
    _fail("comparison", failures)


def degenerate_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long table of columns that are all NULL or constant: column_name, problem."""
    names = columns or df.columns
    got = df.agg(*[F.struct(F.count(c).alias("n"), (low == high).alias("same")).alias(c) for c in names for low, high in [extremes(c)]])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`.n").alias("n"), F.col(f"`{c}`.same").alias("same")) for c in names]))
    problem = F.when(F.col("x.n") == 0, "all null").when(F.col("x.same"), "constant")
    return got.select(rows.alias("x")).select("x.column_name", problem.alias("problem")).where(F.col("problem").isNotNull())


def validate_outputs(tables: dict[str, DataFrame]) -> None:
    """All or nothing: raise if any column of any table is degenerate."""
    found = {n: [f"{r.column_name} {r.problem}" for r in degenerate_columns(df).collect()] for n, df in tables.items()}
    _fail("outputs", [f"{n}: {', '.join(p)}" for n, p in found.items() if p])
