"""Text features as built-in expressions; what needs words or patterns is counted in Arrow batches."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions import counting
from lakemill.functions.labels import round4

# Words that negate.
NEGATIONS = (
    "not", "no", "never", "none", "nobody", "nothing", "neither", "nowhere", "cannot", "cant", "can't", "won't", "wont", "isn't", "isnt",
    "wasn't", "wasnt", "aren't", "arent", "weren't", "werent", "doesn't", "doesnt", "didn't", "didnt", "don't", "dont", "hasn't", "hasnt",
    "haven't", "havent", "hadn't", "hadnt", "shouldn't", "shouldnt", "wouldn't", "wouldnt", "couldn't", "couldnt", "n't",
)
LINGUISTIC = (
    "stripped_review", "word_count", "char_count", "avg_word_len", "avg_sentence_len", "num_excl", "num_ques", "num_caps", "num_at",
    "num_hash", "sentence_count", "negation_count",
)
_COUNTS = ["sentence_count", "num_caps", "negation_count", "__kinds"]


# Unicode white space as explicit classes ((?U) and \\p{Z} make every match slow); most characters leave one by its first range
_SPACE = " \\t\\n\\x0b\\f\\r\\x1c\\x1d\\x1e\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_ONE = f"[\\x00- \\x85-\\uffff&&[{_SPACE}]]"


def clean(text: Column) -> Column:
    """NULL to '', links to a space, white space collapsed and trimmed."""
    text = F.coalesce(text, F.lit(""))
    links = F.regexp_replace(text, f"http[^{_SPACE}]+|www\\.[^{_SPACE}]+", " ")
    bare = F.when(F.contains(text, F.lit("http")) | F.contains(text, F.lit("www.")), links).otherwise(text)
    # every run but a single plain space, which stays: few matches
    return F.trim(F.regexp_replace(bare, f"{_ONE}(?:(?<! )|(?={_ONE})){_ONE}*+", " "))


def tokens(text: Column) -> Column:
    """Runs of letters a-z and apostrophes, lowered."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z']+)"), 1)


def occurrences(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))).cast("long")


def words(cleaned: Column) -> Column:
    """White-space words of a cleaned text; none for ''."""
    return F.when(cleaned == "", F.array().cast("array<string>")).otherwise(F.split(cleaned, " "))


def mean3(x: Column, n: Column) -> Column:
    """x / n to three decimals, 0 where there is nothing."""
    return F.when(n == 0, 0.0).otherwise(F.floor(x / n * 1000 + 0.5) / 1000)


def linguistic(df: DataFrame, text_col: str = "raw_review") -> DataFrame:
    """Append the linguistic features and type_token_ratio.

    Sentences are counted as runs of . ! ? with text before them, plus an
    unfinished rest, at least one: an approximation of a sentence splitter.
    """
    step = df.withColumn("stripped_review", clean(F.col(text_col)))
    t, count = F.col("stripped_review"), _COUNTS
    step = step.withColumns(
        {
            "__counts": counting.counter(lambda c: counting.linguistic(c, pa.array(NEGATIONS)), count)(t),
            "word_count": F.when(t == "", F.lit(0)).otherwise(occurrences(t, " ") + 1).cast("long"),
            "char_count": F.length(t).cast("long"),
            "__letters": (F.length(t) - occurrences(t, " ")).cast("double"),
            "num_excl": occurrences(t, "!"),
            "num_ques": occurrences(t, "?"),
            "num_at": occurrences(t, "@"),
            "num_hash": occurrences(t, "#"),
        }
    )
    step = step.withColumns({c: F.col(f"__counts.{c}") for c in count})
    n = F.col("word_count")
    return step.withColumns(
        {
            "avg_word_len": mean3(F.col("__letters"), n),
            "avg_sentence_len": mean3(n.cast("double"), F.col("sentence_count")),
            "type_token_ratio": F.when(n == 0, 0.0).otherwise(round4(F.col("__kinds") / n)),
        }
    ).drop("__counts", "__letters", "__kinds")


def distinct_tokens(df: DataFrame, text_col: str) -> DataFrame:
    """The tokens of all texts, each once, as ``term``."""
    return df.select(text_col).mapInArrow(counting.distinct_tokens, "term string").distinct()
