"""Lexicon features from one wide table of all lexicons, keyed by term.

Within a stated bound every worker holds the table and sums the tokens of
each text in Arrow batches. Beyond it tokens are exploded once and meet the
table in a single shuffle join on the term, with one partial aggregation.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions import counting
from lakemill.functions.labels import EMOTIONS, dominant, round4
from lakemill.functions.text import tokens

VAD = ("valence", "arousal", "dominance")
SOCIAL = ("warmth", "competence", "sociability", "trust")
BROADCAST_TERMS = 200_000
#: columns of the wide lexicon beside ``term``
WIDE = {
    "worry": "boolean", **dict.fromkeys(VAD, "double"), **{f"social_{d}": "double" for d in SOCIAL}, "affect": "double",
    **{f"hit_{e}": "boolean" for e in EMOTIONS}, "hit_positive": "boolean", "hit_negative": "boolean", **{f"int_{e}": "double" for e in EMOTIONS},
}
# what is counted and summed over the tokens of a text: true entries, entries, values
HITS = {"worry_word_count": "worry", **{f"{e}_count": f"hit_{e}" for e in EMOTIONS}, "positive_count": "hit_positive", "negative_count": "hit_negative"}
MATCHES = {"vad_matched_words": "valence", "__n_social": "social_warmth", "affect_matched_words": "affect"}
SUMS = {f"__s_{c}": c for c in (*VAD, *(f"social_{d}" for d in SOCIAL), "affect", *(f"int_{e}" for e in EMOTIONS))}


def combine(*parts: DataFrame) -> DataFrame:
    """One row per term of several lexicons with columns of ``WIDE`` each."""
    full = [p.select("term", *[(F.col(c) if c in p.columns else F.lit(None)).cast(t).alias(c) for c, t in WIDE.items()]) for p in parts]
    return reduce(DataFrame.unionByName, full).groupBy("term").agg(*[F.max(c).alias(c) for c in WIDE])


def lexicon_features(df: DataFrame, lexicon: DataFrame, key: str = "review_id", text_col: str = "stripped_review") -> DataFrame:
    """Append every lexicon feature to ``df`` (one row per ``key``).

    Tokens without an entry count only as tokens. Rows whose text is NULL or
    has no token get zeros and 'neutral'; columns of ``df`` stay as they are.
    """
    small = lexicon.select("term", *WIDE).where("term IS NOT NULL").limit(BROADCAST_TERMS + 1).toArrow()  # at most so many rows reach the driver, once
    if small.num_rows <= BROADCAST_TERMS and len(small["term"].unique()) == small.num_rows:
        return label_emotions(shape(df.withColumn("__sums", _summed(small)(F.col(text_col))), df.columns, "__sums."))
    token = df.select(key, F.explode(tokens(F.coalesce(F.col(text_col), F.lit("")))).alias("term"))
    met = token.join(lexicon, "term", "left")
    per = met.groupBy(key).agg(
        F.count("*").alias("__n"), *[F.count(F.when(F.col(c), 1)).alias(n) for n, c in HITS.items()],
        *[F.count(c).alias(n) for n, c in MATCHES.items()], *[F.sum(c).alias(n) for n, c in SUMS.items()],
    )
    found = shape(per, [key])
    return label_emotions(df.join(found, key, "left").fillna(0, [c for c in found.columns if c != key]))


def _summed(lexicon: pa.Table) -> Callable[[Column], Column]:
    """Counts and sums of a text's tokens, looked up in one table of values per worker: no row per token, no join."""
    lexicon = lexicon.combine_chunks()
    rows = [pc.fill_null(lexicon[c], False) for c in HITS.values()] + [pc.is_valid(lexicon[c]) for c in MATCHES.values()] + [pc.fill_null(lexicon[c], 0.0) for c in SUMS.values()]
    values = np.array([r.to_numpy().astype(float) for r in rows])
    terms = pa.array(lexicon["term"].to_pylist(), pa.string())
    return counting.counter(lambda c: counting.lexicon_sums(c, terms, values), ["__n", *HITS, *MATCHES], [*SUMS])


def shape(per: DataFrame, keep: list[str], at: str = "") -> DataFrame:
    """Means and shares from the sums of one text each, which are columns of ``per`` or fields of the struct ``at``."""
    col = lambda c: F.col(at + c)
    mean = lambda s, n: F.when(col(n) > 0, round4(col(s) / col(n))).otherwise(0.0)
    hits = reduce(Column.__add__, (col(f"{e}_count") for e in EMOTIONS))
    return per.select(
        *keep, col("worry_word_count"),
        *[mean(f"__s_{c}", "vad_matched_words").alias(f"{c.capitalize()}_avg") for c in VAD], col("vad_matched_words"),
        *[mean(f"__s_social_{c}", "__n_social").alias(f"wcst_{c}_avg") for c in SOCIAL],
        mean("__s_affect", "affect_matched_words").alias("affect_sentiment_avg"), col("affect_matched_words"),
        *[col(f"{e}_count") for e in EMOTIONS], col("positive_count"), col("negative_count"),
        *[F.when(hits > 0, round4(col(f"{e}_count") / hits)).otherwise(0.0).alias(f"{e}_int_avg") for e in EMOTIONS],
        *[round4(F.coalesce(col(f"__s_int_{e}"), F.lit(0.0)) / F.greatest(col("__n"), F.lit(1))).alias(f"nrc_{e}_lex") for e in EMOTIONS],
    )


def label_emotions(df: DataFrame) -> DataFrame:
    """dominant_emotion, and first and second emotion by lexicon with confidences."""
    lex = {e: F.col(f"nrc_{e}_lex") for e in EMOTIONS}
    total = reduce(Column.__add__, lex.values())
    ranked = F.array_sort(F.array(*[F.struct((-c).alias("s"), F.lit(i).alias("i"), F.lit(e).alias("e")) for i, (e, c) in enumerate(lex.items())]))
    df = df.withColumns({"dominant_emotion": dominant({e: F.col(f"{e}_int_avg") for e in EMOTIONS}), "__rank": ranked, "__total": total})
    some = F.col("__total") > 0
    out = {}
    for place, name in enumerate(("primary", "secondary")):
        first = F.col("__rank")[place]
        out[f"{name}_emotion_lex"] = F.when(some, first["e"]).otherwise("neutral")
        out[f"{name}_emotion_lex_conf"] = F.when(some, round4(-first["s"] / F.col("__total"))).otherwise(1.0 if place == 0 else 0.0)
    return df.withColumns(out).drop("__rank", "__total")
