"""Feature groups: which columns they own, how they are chosen and applied."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from lakemill.functions.labels import EMOTIONS, weighted_star
from lakemill.functions.lexicon import SOCIAL, VAD, lexicon_features
from lakemill.functions.scorers import LexiconSentiment, RuleEntities, SuffixGrammar
from lakemill.functions.text import LINGUISTIC, linguistic

# The groups and their columns, in output order.
GROUPS: dict[str, tuple[str, ...]] = {
    "linguistic": LINGUISTIC,
    "vader": LexiconSentiment.columns,
    "nrc-emotion": (*(f"{e}_count" for e in EMOTIONS), *(f"{e}_int_avg" for e in EMOTIONS), "positive_count", "negative_count", "dominant_emotion"),
    "vad": (*(f"{d.capitalize()}_avg" for d in VAD), "vad_matched_words"),
    "entities": RuleEntities.columns,
    "grammar": (*SuffixGrammar.columns, "type_token_ratio"),
    "domain-lexicons": (
        "worry_word_count", *(f"wcst_{d}_avg" for d in SOCIAL), "affect_sentiment_avg", "affect_matched_words", *(f"nrc_{e}_lex" for e in EMOTIONS),
        "primary_emotion_lex", "primary_emotion_lex_conf", "secondary_emotion_lex", "secondary_emotion_lex_conf",
    ),
    "time-weighting": ("weighted_star",),
    "transformers": ("hf_sentiment_label", "hf_sentiment_confidence", "hf_computed_sentiment", "hf_emotion_label", "hf_emotion_confidence"),
}
DEFAULT_GROUPS = tuple(g for g in GROUPS if g != "transformers")
OWNED = tuple(c for columns in GROUPS.values() for c in columns)
STRINGS = {"stripped_review", "dominant_emotion", "primary_emotion_lex", "secondary_emotion_lex", "hf_emotion_label"}
LONGS = {c for c in OWNED if c.endswith(("_count", "_words")) or c.startswith("num_")} | {"hf_sentiment_label"}


def resolve_groups(groups: Iterable[str] | None = None, use_transformers: bool = False) -> tuple[str, ...]:
    """Chosen groups in output order; ValueError for none or unknown ones."""
    chosen = set(DEFAULT_GROUPS if groups is None else groups) | ({"transformers"} if use_transformers else set())
    if not chosen:
        raise ValueError("at least one feature group is needed")
    if unknown := sorted(chosen - set(GROUPS)):
        raise ValueError(f"unknown feature groups: {unknown}; known: {list(GROUPS)}")
    return tuple(g for g in GROUPS if g in chosen)


def output_columns(groups: Iterable[str] | None = None, use_transformers: bool = False) -> list[str]:
    return [c for g in resolve_groups(groups, use_transformers) for c in GROUPS[g]]


def generated_schema(groups: Iterable[str] | None = None, use_transformers: bool = False) -> StructType:
    kind = lambda c: StringType() if c in STRINGS else LongType() if c in LONGS else DoubleType()
    return StructType([StructField(c, kind(c)) for c in output_columns(groups, use_transformers)])


def with_decay(df: DataFrame, stars: str = "stars", day: str = "review_date") -> DataFrame:
    """Append weighted_star, decayed to the latest day of the table.

    The anchor is a one-row aggregate joined lazily, so no job runs here.
    """
    date = F.try_to_date(F.col(day).cast("string")) if dict(df.dtypes)[day] == "string" else F.to_date(day)
    anchor = df.agg(F.max(date).alias("__anchor"))
    return df.crossJoin(F.broadcast(anchor)).withColumn("weighted_star", weighted_star(F.col(stars), date, F.col("__anchor"))).drop("__anchor")


def apply_features(
    df: DataFrame, lexicon: DataFrame, groups: Iterable[str] | None = None, key: str = "review_id", text_col: str = "raw_review",
    sentiment=LexiconSentiment(), entities=RuleEntities(), grammar=SuffixGrammar(), transformers=None,
) -> DataFrame:
    """Input columns (but owned ones) and the columns of the chosen groups.

    Only what the chosen groups need is planned; Catalyst prunes the rest.
    """
    chosen = resolve_groups(groups, transformers is not None)
    if "transformers" in chosen and transformers is None:
        raise ValueError("the transformers group needs a scorer")
    base = df.select(*[c for c in df.columns if c not in OWNED])
    out = linguistic(base, text_col)
    if {"vader", "nrc-emotion", "vad", "domain-lexicons"} & set(chosen):
        out = lexicon_features(out, lexicon, key)
    for group, scorer in (("vader", sentiment), ("entities", entities), ("grammar", grammar), ("transformers", transformers)):
        if group in chosen:
            out = scorer(out, "stripped_review")
    if "time-weighting" in chosen:
        out = with_decay(out)
    return out.select(*base.columns, *[F.col(f.name).cast(f.dataType) for f in generated_schema(chosen)])
