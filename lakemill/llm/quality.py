"""Quality rules: cross-document line frequency over simple text rules, native.

Lines are normalised (lower case, white space collapsed) and hashed; a line
that occurs in more than ``max_documents`` distinct documents of one host is
boilerplate and is removed; a document is rejected when too little is left.

Texts are read once: one scan makes a row per document of its counts and line
hashes, which is written; what follows reads only that. Rows per (host, line)
are counted first, each document's once, as a plain partial aggregation that
costs a line which every document has one row per task; only the lines with
enough rows are then counted by distinct documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import checkpointed

SPACE = "[\\x20\\x09-\\x0D]+"
NONSPACE = "[^\\x20\\x09-\\x0D]"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def _repeated_places(ranked: Column) -> Column:
    """Ascending places of the (hash, place) pairs whose hash has a neighbour."""
    twin = lambda x, j: (F.get(ranked, j - 1)["h"] == x["h"]) | (F.get(ranked, j + 1)["h"] == x["h"])
    places = F.transform(ranked, lambda x, j: F.when(twin(x, j), x["i"]))
    return F.sort_array(F.filter(places, lambda i: i.isNotNull()))


def document_counts(docs: DataFrame, width: int = 5) -> DataFrame:
    """Per-document counts and line hashes by built-in functions, in one pass.

    Expects a column text (not null), which it replaces by n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words and lines, an array of
    the hash and word characters of each line with a word. Windows are
    compared by 64-bit hashes within one document.
    """
    step = docs.withColumn("words", _words(F.col("text")))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(NONSPACE))
    names = docs.columns
    step = step.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]+", ""))).cast("long"),
            "lines": lines,
            "marks": F.transform("words", lambda x: F.xxhash64(x)),
        }
    ).drop("words", "text")
    # each word is hashed once; a window is the hash of its words' hashes. As marks are named more
    # than once, the optimiser does not compute them anew for each window.
    windows = F.transform("marks", lambda x, i: F.xxhash64(x, *[F.get("marks", i + k) for k in range(1, width)]))
    whole = F.slice(windows, 1, F.size("marks") - (width - 1))
    step = step.withColumn("hashes", F.when(F.size("marks") > width, whole).otherwise(F.array().cast("array<bigint>"))).drop("marks")
    step = step.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    step = step.withColumn("lines", _content_lines(F.col("lines")))
    step = step.withColumn(
        "ranked",
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("hashes")
    step = step.withColumn("again", _repeated_places(F.col("ranked"))).drop("ranked")
    covered = F.aggregate(
        "again",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-width).cast("int").alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(width), i - a["last"])).cast("long").alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).select(
        *[n for n in names if n != "text"], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"
    )


def _content_lines(lines: Column) -> Column:
    """Hash and word characters of each line, normalised."""
    plain = F.transform(lines, lambda x: F.trim(F.regexp_replace(F.lower(x), SPACE, " ")))
    return F.transform(plain, lambda x: F.struct(F.xxhash64(x).alias("h"), F.length(F.replace(x, F.lit(" "))).alias("chars")))


def boilerplate(counts: DataFrame, max_documents: int) -> DataFrame:
    """What boilerplate lines take from each row.

    ``counts`` has row, document, host and lines. Returns row, removed_chars
    and removed_lines; rows without such lines are absent.
    """
    hashes = F.array_distinct(F.transform("lines", lambda x: x["h"]))
    often = counts.select("host", F.explode(hashes).alias("h")).groupBy("host", "h").count().where(F.col("count") > max_documents).select("host", "h")
    each = counts.select("row", "document", "host", F.explode("lines").alias("line")).select("row", "document", "host", "line.*")
    hits = each.join(often, ["host", "h"], "left_semi")
    common = hits.select("host", "h", "document").distinct().groupBy("host", "h").count().where(F.col("count") > max_documents).select("host", "h")
    taken = hits.join(common, ["host", "h"], "left_semi")
    return taken.groupBy("row").agg(F.sum("chars").alias("removed_chars"), F.count("*").alias("removed_lines"))


def quality_rules(
    docs: DataFrame,
    max_documents: int = 20,
    least_left: float = 0.5,
    least_words: int = 10,
    most_repeated: float = 0.2,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """Judge every document; one row per input row.

    A line found in more than ``max_documents`` distinct documents of its host is
    removed. Rejected are documents that fail the base rules (too few words,
    too many repeated ones) and depleted ones: less than ``least_left`` of
    their word characters remain after the removal.

    Null texts are empty and fail the base rules; a null host is a host of
    its own. Documents are told apart by their ids: rows of one id (whatever
    their texts) count as one document for a line, and each is judged; a row
    without an id is a document named by its text. Other columns are ignored,
    so they may have any name. An empty table gives no rows.
    """
    document = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("\x00")).alias("host"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumns({"document": document, "row": F.monotonically_increasing_id()})
    counts = checkpointed(document_counts(rows))
    taken = boilerplate(counts, max_documents)
    out = counts.drop("lines", "document", "host").join(taken, "row", "left").withColumns(
        {
            "removed_chars": F.coalesce("removed_chars", F.lit(0)).cast("long"),
            "removed_lines": F.coalesce("removed_lines", F.lit(0)).cast("long"),
            "base_failed": (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > round(100 * most_repeated) * F.col("n_words")),
        }
    )
    depleted = (F.col("word_chars") - F.col("removed_chars")) < least_left * F.col("word_chars")
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~depleted).alias("kept"), "removed_chars", "removed_lines",
    )
