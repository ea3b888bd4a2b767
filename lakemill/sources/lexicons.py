"""Loaders of the five lexicon layouts, as small frames for ``functions.lexicon.combine``.

The literal term ``null`` is a term: nothing is read as NULL but missing fields.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.labels import EMOTIONS
from lakemill.functions.lexicon import SOCIAL

FLAGS = ("vad", "worry", "wcst", "affect", "intensity")


def _fields(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.split("value", "\t", -1).alias("f"), F.monotonically_increasing_id().alias("n"))


def _named(spark: SparkSession, path: str) -> DataFrame:
    """Rows by the header's names: lowered, cut at ' ('."""
    lines = _fields(spark, path)
    head = [h.strip().lower().split(" (")[0] for h in lines.orderBy("n").first().f]
    body = lines.where(~F.array_join("f", "\t").eqNullSafe(F.lit("\t".join(lines.orderBy("n").first().f))))
    return body.select(*[F.get("f", F.lit(i)).alias(h) for i, h in enumerate(head)], "n")


def _last(df: DataFrame) -> DataFrame:
    """The last row of each term."""
    values = [c for c in df.columns if c not in ("term", "n")]
    return df.groupBy("term").agg(*[F.max_by(c, "n").alias(c) for c in values])


def load_vad(spark: SparkSession, path: str) -> DataFrame:
    """Single-word terms with valence, arousal and dominance."""
    d = _named(spark, path).where(~F.contains("term", F.lit(" ")))
    return _last(d.select(F.lower("term").alias("term"), *[F.col(c).try_cast("double").alias(c) for c in ("valence", "arousal", "dominance")], "n"))


def load_worry(spark: SparkSession, path: str) -> DataFrame:
    """Terms whose majority label is at least 2."""
    d = _named(spark, path).where(F.col("majoritylabel").try_cast("double") >= 2)
    return d.select(F.lower("term").alias("term"), F.lit(True).alias("worry")).distinct()


def load_social(spark: SparkSession, path: str) -> DataFrame:
    d = _named(spark, path)
    return _last(d.select(F.lower("term").alias("term"), *[F.col(c).try_cast("double").alias(f"social_{c}") for c in SOCIAL], "n"))


def load_affect(spark: SparkSession, path: str) -> DataFrame:
    """term, score, ...: short lines and scores that are no numbers are skipped; the last wins."""
    d = _fields(spark, path).where(F.size("f") >= 2).select(F.col("f")[0].alias("term"), F.col("f")[1].try_cast("double").alias("affect"), "n")
    return _last(d.where("affect IS NOT NULL"))


def load_intensity(spark: SparkSession, path: str) -> DataFrame:
    """term, emotion, score without a header; the last of a pair wins."""
    d = _fields(spark, path).where(F.size("f") >= 3).select(F.lower(F.col("f")[0]).alias("term"), F.lower(F.col("f")[1]).alias("e"), F.col("f")[2].try_cast("double").alias("v"), "n")
    return d.groupBy("term").agg(*[F.max_by(F.when(F.col("e") == e, F.col("v")), F.when(F.col("e") == e, F.col("n"))).alias(f"int_{e}") for e in EMOTIONS])


def resolve_paths(folder: str | None = None, names: dict[str, str] | None = None, **flags: str | None) -> dict[str, str]:
    """Path of each lexicon: a flag of its own beats the folder; SystemExit names what is missing."""
    names = names or {f: f"{f}.tsv" for f in FLAGS}
    out = {f: flags.get(f) or (str(Path(folder) / names[f]) if folder and "://" not in folder else f"{folder}/{names[f]}" if folder else None) for f in FLAGS}
    if lost := [f"--{f}" for f, p in out.items() if not p]:
        raise SystemExit(f"missing lexicons: give a folder or {', '.join(lost)}")
    return out


def load_all(spark: SparkSession, paths: dict[str, str]) -> list[DataFrame]:
    load = {"vad": load_vad, "worry": load_worry, "wcst": load_social, "affect": load_affect, "intensity": load_intensity}
    return [load[k](spark, p) for k, p in paths.items()]
