"""Writes: idempotent conversion, tables, formats, audit and run log."""

from __future__ import annotations

import json
import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from lakemill.sources.bronze import Dataset, read_json
from lakemill.sources.names import identifier, join_path, quote_table

AUDIT = "recorded_at_utc string, task string, outcome string, metrics_json string"


def path_exists(spark: SparkSession, path: str) -> bool:
    """By the path's own file system, so remote paths work."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def convert(spark: SparkSession, dataset: Dataset, source: str, target: str, partitions: int | None = None, overwrite: bool = False) -> str:
    """JSON lines to Parquet, once: 'converted' or 'skipped'.

    A target that was not finished raises unless it may be overwritten.
    """
    n = dataset.partitions if partitions is None else partitions
    if n < 1:
        raise ValueError("partitions must be at least 1")
    if not overwrite and path_exists(spark, target):
        if path_exists(spark, join_path(target, "_SUCCESS")):
            return "skipped"
        raise RuntimeError(f"{target} exists but was not finished")
    df = read_json(spark, dataset.schema, source).repartition(n)
    df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "snappy").parquet(target)
    return "converted"


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{identifier(name, 'schema')}`")


def save_table(df: DataFrame, table: str, mode: str = "overwrite") -> None:
    """A managed Parquet table; overwriting replaces its schema."""
    quote_table(table)
    df.write.format("parquet").mode(mode).saveAsTable(table)


def save_external(df: DataFrame, path: str, table: str, mode: str = "overwrite") -> None:
    """An external Parquet table: dropped and written anew, or only if absent."""
    if mode not in ("overwrite", "errorifexists"):
        raise ValueError(f"unknown mode: {mode}")
    spark, name = df.sparkSession, quote_table(table)
    if mode == "errorifexists" and spark.catalog.tableExists(table):
        raise RuntimeError(f"{table} exists")
    if mode == "overwrite":
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.format("parquet").mode(mode).option("path", path).saveAsTable(table)


def write(df: DataFrame, path: str, kind: str) -> None:
    """Overwrite a path as csv, json or parquet."""
    writers = {"csv": lambda w: w.option("header", True).option("escape", '"').csv(path), "json": lambda w: w.json(path), "parquet": lambda w: w.parquet(path)}
    if kind not in writers:
        raise ValueError(f"unknown format: {kind}")
    writers[kind](df.write.mode("overwrite"))


def audit_row(spark: SparkSession, task: str, outcome: str, metrics: dict) -> DataFrame:
    return spark.createDataFrame([(datetime.now(timezone.utc).isoformat(), task, outcome, json.dumps(metrics, default=str, sort_keys=True))], AUDIT)


def append_audit(spark: SparkSession, target: str, task: str, outcome: str, metrics: dict) -> None:
    """Append a row to an audit table, or to a path if it has a slash."""
    row = audit_row(spark, task, outcome, metrics).write.mode("append")
    if "/" in target:
        row.parquet(target)
    else:
        quote_table(target)
        row.saveAsTable(target)


def flatten(record: dict) -> dict:
    """Nested values as JSON text."""
    return {k: json.dumps(v, default=str, sort_keys=True) if isinstance(v, (dict, list)) else v for k, v in record.items()}


def log_run(record: dict, path: str, spark: SparkSession | None = None) -> None:
    """Append a run record: Spark JSON for a URI, a JSON array for a local file.

    A file that holds one object becomes an array of it and the new one.
    """
    if "://" in path:
        if spark is None:
            raise ValueError("a remote log needs a session")
        spark.createDataFrame([(json.dumps(flatten(record), default=str, sort_keys=True),)], "record_json string").write.mode("append").json(path)
        return
    old = []
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            old = json.load(f)
    runs = [*(old if isinstance(old, list) else [old]), record]
    with open(path, "w", encoding="utf-8") as f:
        json.dump(runs, f, default=str, indent=1)
