"""The pipeline's steps as jobs: bronze, silver, gold, serving.

    python -m lakemill.jobs gold --source S --target T --level state --state NV

Each job materialises what it uses more than once, checks before it writes,
appends an audit row whether it succeeds or fails, and releases what it kept.
Sources and targets are Parquet folders on any file system Spark reads.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.features import apply_features, resolve_groups
from lakemill.functions.lexicon import combine
from lakemill.operators import gold, serving, silver, validate
from lakemill.operators.common import require_columns
from lakemill.operators.filters import ReviewFilter, apply_filter
from lakemill.operators.materialize import MODES, Kept
from lakemill.sources import bronze, lexicons, sinks
from lakemill.sources.names import join_path


def audited(spark: SparkSession, target: str, task: str, mode: str, run: Callable[[Kept, dict], None]) -> dict:
    """Run a job; audit its metrics with the outcome; release what it kept."""
    metrics: dict = {}
    with Kept(spark, mode) as kept:
        metrics["run_id"] = kept.run_id
        try:
            run(kept, metrics)
        except Exception as e:
            sinks.append_audit(spark, target, task, "failed", metrics | {"error": str(e)[:2_000]})
            raise
        metrics["rows"] = dict(kept.counts)
    sinks.append_audit(spark, target, task, "succeeded", metrics | {"warnings": kept.warnings})
    return metrics


def run_bronze(spark: SparkSession, source: str, target: str, names: list[str] | None = None, partitions: int | None = None, overwrite: bool = False) -> dict[str, str]:
    """Convert raw JSON lines to Parquet, each dataset once."""
    chosen = [bronze.DATASETS[n] for n in names or bronze.DATASETS]
    return {d.name: sinks.convert(spark, d, join_path(source, f"{d.name}.json"), join_path(target, d.name), partitions, overwrite) for d in chosen}


def run_silver(
    spark: SparkSession, source: str, target: str, audit: str, lexicon_paths: dict[str, str] | None = None, size: int | None = None, seed: int = 42,
    groups: list[str] | None = None, mode: str = "auto", check_features: bool = True,
) -> dict:
    """Sample reviews, scope and check their related tables, join, add features, check, write.

    Writes scoped Bronze tables to target/bronze_<name> and Silver to
    target/silver. Without lexicons only the groups that need none may be chosen.
    """
    chosen = resolve_groups(groups)

    def run(kept: Kept, metrics: dict) -> None:
        metrics["groups"] = list(chosen)
        picked = kept.keep(silver.sample_by_hash(bronze.read_bronze(spark, "review", source), size, seed), "reviews")
        scoped = {}
        for name, data in bronze.DATASETS.items():
            path = join_path(source, name)
            if name not in ("review", "business", "user") and not sinks.path_exists(spark, path):
                continue
            df = picked if name == "review" else bronze.read_bronze(spark, name, source)
            df = df if size is None or name == "review" else silver.scope_related(df, name, picked)
            validate.validate_bronze(df, name, data.key, allow_empty=not data.unique)
            sinks.write(df, join_path(target, f"bronze_{name}"), "parquet")
            scoped[name] = spark.read.parquet(join_path(target, f"bronze_{name}"))
        joined = silver.build_silver(scoped["review"], scoped["business"], scoped["user"], unique=validate.UNIQUE_DATASETS)  # as just checked
        lexicon = combine(*lexicons.load_all(spark, lexicon_paths)) if lexicon_paths else combine(spark.createDataFrame([], "term string"))
        out = kept.keep(apply_features(joined, lexicon, chosen), "silver")
        require_columns(out, silver.SILVER, "Silver")
        metrics["parity"] = validate.validate_parity_of_rows(out, scoped["review"])
        if check_features:
            metrics["measures"] = validate.validate_silver(out)
        sinks.write(out, join_path(target, "silver"), "parquet")

    return audited(spark, audit, "silver", mode, run)


def run_gold(
    spark: SparkSession, source: str, target: str, audit: str, level: str, wanted: ReviewFilter | None = None, size: int | None = None, seed: int = 42,
    brands: list[str] | None = None, period: str = "month", mode: str = "auto",
) -> dict:
    """Filter Silver, build one Gold level, check, write. Features are never recomputed."""
    wanted = wanted or ReviewFilter()

    def run(kept: Kept, metrics: dict) -> None:
        filtered = kept.keep(apply_filter(spark.read.parquet(source), wanted), "filtered")
        n = gold.effective_size(size, kept.counts["filtered"]) if kept.counts["filtered"] else size
        if n != size:
            metrics["size_shrunk"] = [size, n]
        options = {} if level in ("sample", "brand-sample") else {"period": period, "emotion_column": wanted.emotion_column, "sentiment_column": wanted.sentiment_column}
        out = kept.keep(gold.build_gold(filtered, level, n, seed, brands, **options).withColumn("gold_created_at", F.current_timestamp()), "gold")
        metrics["gold"] = validate.validate_gold(out, level, n, brands)
        sinks.write(out, target, "parquet")

    return audited(spark, audit, f"gold:{level}", mode, run)


def run_serving(spark: SparkSession, source: str, target: str, audit: str, mode: str = "auto") -> dict:
    """The three serving tables from row-level Gold: review_sample, business_summary, monthly_summary."""

    def run(kept: Kept, metrics: dict) -> None:
        rows = spark.read.parquet(source)
        serving.check_row_level(rows)
        tables: dict[str, DataFrame] = {
            "review_sample": rows, "business_summary": kept.keep(serving.business_summary(rows), "businesses"), "monthly_summary": kept.keep(serving.monthly_summary(rows), "months"),
        }
        metrics["serving"] = validate.validate_serving(tables["business_summary"], tables["monthly_summary"])
        for name, df in tables.items():
            sinks.write(df, join_path(target, name), "parquet")

    return audited(spark, audit, "serving", mode, run)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lakemill.jobs", description=__doc__.split("\n")[0])
    jobs = top.add_subparsers(dest="job", required=True)
    for name in ("bronze", "silver", "gold", "serving"):
        p = jobs.add_parser(name)
        p.add_argument("--source", required=True)
        p.add_argument("--target", required=True)
        if name == "bronze":
            p.add_argument("--dataset", action="append", choices=[*bronze.DATASETS])
            p.add_argument("--partitions", type=int)
            p.add_argument("--overwrite", action="store_true")
            continue
        p.add_argument("--audit", required=True)
        p.add_argument("--materialization", default="auto", choices=MODES)
        if name == "serving":
            continue
        p.add_argument("--size", type=int)
        p.add_argument("--seed", type=int, default=42)
        if name == "silver":
            p.add_argument("--group", action="append")
            p.add_argument("--lexicon-dir")
            for flag in lexicons.FLAGS:
                p.add_argument(f"--{flag}")
            continue
        p.add_argument("--level", required=True, choices=[*gold.GRAIN_KEYS])
        p.add_argument("--brand", action="append")
        p.add_argument("--period", default="month", choices=gold.PERIODS)
        for flag, field in MANY.items():
            p.add_argument(flag, action="append", dest=field)
        for flag, (field, kind) in ONE.items():
            p.add_argument(flag, type=kind, dest=field)
        p.add_argument("--sentiment-column", default="vader_sentiment_score")
        p.add_argument("--emotion-column", default="dominant_emotion")
    return top


MANY = {
    "--business-id": "business_ids", "--business-name": "business_names", "--user-id": "user_ids", "--industry": "industries", "--city": "cities", "--state": "states",
    "--sentiment": "sentiment_labels", "--emotion": "emotion_labels",
}
ONE = {
    "--start-date": ("start_date", str), "--end-date": ("end_date", str), "--min-sentiment": ("min_sentiment", float), "--max-sentiment": ("max_sentiment", float),
    "--min-stars": ("min_stars", float), "--max-stars": ("max_stars", float),
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"lakemill-{a.job}").getOrCreate()
    if a.job == "bronze":
        print(run_bronze(spark, a.source, a.target, a.dataset, a.partitions, a.overwrite))
    elif a.job == "silver":
        flags = {f: getattr(a, f) for f in lexicons.FLAGS}
        paths = lexicons.resolve_paths(a.lexicon_dir, **flags) if a.lexicon_dir or any(flags.values()) else None
        print(run_silver(spark, a.source, a.target, a.audit, paths, a.size, a.seed, a.group, a.materialization))
    elif a.job == "gold":
        fields = {f: getattr(a, f) for f in [*MANY.values(), *(f for f, _ in ONE.values()), "sentiment_column", "emotion_column"]}
        print(run_gold(spark, a.source, a.target, a.audit, a.level, ReviewFilter(**fields), a.size, a.seed, a.brand, a.period, a.materialization))
    else:
        print(run_serving(spark, a.source, a.target, a.audit, a.materialization))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
