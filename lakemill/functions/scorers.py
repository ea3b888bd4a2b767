"""Features that need a language model, behind one interface.

The default scorers are native: means over the lexicon for sentiment, rules
for entities, no part-of-speech shares. A package that is installed can be
plugged in through ``pandas_scorer``; nothing here pretends to equal it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from importlib.util import find_spec
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemill.functions import counting
from lakemill.functions.labels import round4


class Scorer(Protocol):
    """Appends its columns to a frame with a cleaned text."""

    columns: tuple[str, ...]

    def __call__(self, df: DataFrame, text_col: str) -> DataFrame: ...


class LexiconSentiment:
    """Compound and shares from positive and negative hits (needs their counts)."""

    columns = ("vader_sentiment_score", "vader_pos", "vader_neu", "vader_neg")

    def __call__(self, df: DataFrame, text_col: str = "stripped_review") -> DataFrame:
        pos, neg, n = F.col("positive_count"), F.col("negative_count"), F.greatest(F.size(F.split(text_col, " ")), F.lit(1))
        gap = (pos - neg).cast("double")
        return df.withColumns(
            {
                "vader_sentiment_score": round4(gap / F.sqrt(gap * gap + 15)),
                "vader_pos": round4(pos / n),
                "vader_neg": round4(neg / n),
                "vader_neu": round4(F.greatest(F.lit(0.0), (n - pos - neg) / n)),
            }
        )


class RuleEntities:
    """Capitalised pairs, words after a place preposition, words with digits."""

    columns = ("person_count", "location_count", "product_count")
    patterns = ("\\b[A-Z][a-z]+ [A-Z][a-z]+\\b", "\\b(?:in|at|near|from) [A-Z][a-z]+", "\\b[A-Z][A-Za-z]*[0-9]+\\b")

    def __call__(self, df: DataFrame, text_col: str = "stripped_review") -> DataFrame:
        found = counting.counter(counting.entities, list(self.columns))(F.col(text_col))
        return df.withColumn("__found", found).withColumns({c: F.col(f"__found.{c}") for c in self.columns}).drop("__found")


class SuffixGrammar:
    """Shares of words by ending, and a subjectivity of adjectives and adverbs."""

    columns = ("noun_pct", "verb_pct", "adj_pct", "adv_pct", "subjectivity_score")
    endings = ("(?:tion|ment|ness|ity|er|s)", "(?:ing|ed|ize)", "(?:ous|ful|ive|able|al)", "ly")

    def __call__(self, df: DataFrame, text_col: str = "stripped_review") -> DataFrame:
        kinds = [e.strip("(?:)").split("|") for e in self.endings]
        count = counting.counter(lambda c: counting.endings(c, kinds), ["n", *self.columns[: len(kinds)]])
        found = df.withColumn("__found", count(F.col(text_col)))
        n = F.greatest(F.col("__found.n"), F.lit(1))
        shares = {c: round4(F.col(f"__found.{c}") / n) for c in self.columns[: len(kinds)]}
        both = F.col("__found.adj_pct") + F.col("__found.adv_pct")
        return found.withColumns(shares | {"subjectivity_score": round4(both / n)}).drop("__found")


def pandas_scorer(package: str, schema: str, make: Callable[[], Callable[[str], dict]]) -> Scorer:
    """A scorer around a Python package: one model per worker, Arrow batches.

    ``make`` builds the model on the executor; ``schema`` is DDL of its columns.
    """
    if find_spec(package) is None:
        raise ModuleNotFoundError(f"{package} is not installed; use a native scorer or install it on driver and executors")

    class Plugged:
        columns = tuple(part.split()[0] for part in schema.split(","))

        def __call__(self, df: DataFrame, text_col: str = "stripped_review") -> DataFrame:
            whole = StructType([*df.schema.fields, *StructType.fromDDL(schema).fields])

            def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                score = make()
                for batch in batches:
                    rows = pd.DataFrame([score(t or "") for t in batch[text_col]], index=batch.index, columns=[*self.columns])
                    yield pd.concat([batch, rows], axis=1)

            return df.mapInPandas(run, whole)

    return Plugged()


# Columns of the optional transformer models, all NULL for an empty text.
TRANSFORMER = "hf_sentiment_label long, hf_sentiment_confidence double, hf_computed_sentiment double, hf_emotion_label string, hf_emotion_confidence double"


def transformer_scorer(classify: Callable[[str], tuple[int, float, str, float]], package: str = "transformers") -> Scorer:
    """Signed sentiment (2 label - 1) * confidence and an emotion, from ``classify``."""

    def make() -> Callable[[str], dict]:
        def one(text: str) -> dict:
            if not text.strip():
                return dict.fromkeys(part.split()[0] for part in TRANSFORMER.split(", "))
            label, sure, emotion, emotion_sure = classify(text)
            return {
                "hf_sentiment_label": label, "hf_sentiment_confidence": sure, "hf_computed_sentiment": (2 * label - 1) * sure,
                "hf_emotion_label": emotion, "hf_emotion_confidence": emotion_sure,
            }

        return one

    return pandas_scorer(package, TRANSFORMER, make)
