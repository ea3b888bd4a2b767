"""A training-corpus pipeline of five of the operators, in order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. Stages are independent jobs: the
output of one is written and read again as the next one's docs.

SQL cannot express a trained model, the components of near copies or the
tokenizer, so there is no ORACLE_SQL; the tests hold every
stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import bpe, decontaminate, jaccard, suffixes, toxicity
from lakemill.llm.common import checkpointed
from lakemill.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 0.8 or more of their five-word
    shingles shared. SimHash at op9's 3 bits misses most of those, so the stage
    takes MinHash bands with exact verification; its name stays."""
    return jaccard.drop_near_copies(docs, width=5, similarity=0.8)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the byte strings that an earlier place holds;
    n_chars is that of the text left."""
    out = suffixes.suffix_array_dedup(docs, keep_text=True, carry=tuple(c for c in docs.columns if c not in ("text", "n_chars")))
    text = F.col("kept_text")
    own = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return out.select(*[own[c].alias(c) if c in own else F.col(f"carry.{c}") for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text per document."""
    return bpe.bpe_codec(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("bpe_codec", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each cut from the last by a checkpoint."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = checkpointed(docs)
    return docs
