"""Benchmark decontamination by pigeonhole pieces and Myers' bit-parallel distance.

Texts are compared composed (NFC), case-folded and with white space collapsed. A test item of
m characters may appear with up to k = max_error * m edits; it is split into
k + 1 pieces, one of which any such appearance must hold unchanged. All
pieces form an automaton that reads every whole document; each hit names a
place where the item may stand, and Myers' algorithm (one machine-wide integer
per item) finds the least edit distance there.

The benchmark is the stated query set. It is handled in blocks of bounded
size, one after another, so what is broadcast at once is bounded whatever the
table's size; each block costs a scan of the documents.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import IDS, checkpointed, documents, own_ids, row_key

SCHEMA = "item_id long, distance int, budget int, start long, stop long"


def normal(text: str) -> str:
    """NFC and case-folded, runs of ASCII white space as one space; the error
    budget is left for real edits."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).casefold())
    return b" ".join(text.encode("utf-8", "surrogatepass").lower().split()).decode("utf-8", "surrogatepass")


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """budget + 1 consecutive pieces covering the item, with their places."""
    cuts = [i * len(item) // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def letter_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to a substring of text, and its end."""
    full = (1 << m) - 1
    top = 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    get = masks.get
    for j, c in enumerate(text, 1):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, end = score, j
    return best, end


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, most_chars: int) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for r in benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("t is not null").orderBy("i", "t").toLocalIterator():
        item = normal(r.t)
        if not item:
            continue
        if block and size + len(item) > most_chars:
            yield block
            block, size = [], 0
        block.append((r.i, item))
        size += len(item)
    if block:
        yield block


def _search(rows: DataFrame, shared: Broadcast, max_error: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan = [(i, t, int(max_error * len(t)), letter_masks(t)) for i, t in shared.value]
        found: dict[str, list[tuple[int, int]]] = {}
        for n, (_, t, k, _) in enumerate(plan):
            for at, p in pieces(t, k):
                found.setdefault(p, []).append((n, at))
        machine = ahocorasick.Automaton()
        for p, where in found.items():
            machine.add_word(p, (len(p), where))
        machine.make_automaton()
        for batch in batches:
            out = []
            for doc, none, text in zip(batch["doc_id"], batch["no_id"], batch["text"]):
                text = normal(text)
                spans: dict[int, list[list[int]]] = {}
                for end, (size, where) in machine.iter(text):
                    for n, at in where:
                        start = end + 1 - size - at
                        k, m = plan[n][2], len(plan[n][1])
                        lo, hi = max(0, start - k), min(len(text), start + m + k)
                        mine = spans.setdefault(n, [])
                        if mine and lo <= mine[-1][1] and lo >= mine[-1][0]:
                            mine[-1][1] = max(mine[-1][1], hi)
                        else:
                            mine.append([lo, hi])
                for n, places in spans.items():
                    item, t, k, masks = plan[n]
                    best = None
                    for lo, hi in places:
                        d, end = myers(masks, len(t), text[lo:hi])
                        if d <= k and (best is None or d < best[0]):
                            best = (d, lo, lo + end)
                    if best:
                        out.append((doc, none, item, best[0], k, max(best[1], best[2] - len(t) - k), best[2]))
            frame = pd.DataFrame(out, columns=["doc_id", "no_id", "item_id", "distance", "budget", "start", "stop"])
            yield frame.assign(item_id=pd.array([r[2] for r in out], dtype="Int64"))

    return own_ids(rows.mapInPandas(run, f"{IDS}, {SCHEMA}"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, max_error: float = 0.08, block_chars: int = 4_000_000,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Every (document, item) with the item in the document within its budget.

    Returns doc_id, item_id, distance (least over the document), budget and a
    stretch of the normalised text holding the best place (start, stop).
    Documents without any item are absent. Null texts are empty and hold
    nothing; null, empty and white-space items are left out; items shorter
    than 1 / max_error characters match exactly only. There is no least
    length, and an item may stand inside longer words (``cat`` is found in
    ``concatenate``): choose items that are worth finding. Repeated rows give
    repeated rows; null ids stay null. Empty tables give no rows.

    A benchmark of one block is searched in one lazy scan. Of a larger one,
    each block is broadcast, searched, written and released before the next.
    """
    rows = documents(docs, id_col, text_col)
    spark = rows.sparkSession
    blocks = _blocks(benchmark, item_col, item_text_col, block_chars)
    block, after = next(blocks, None), next(blocks, None)
    if block is None:
        return spark.createDataFrame([], f"doc_id long, {SCHEMA}")
    if after is None:
        return _search(rows, spark.sparkContext.broadcast(block), max_error)
    parts = []
    for one in chain([block, after], blocks):
        shared = spark.sparkContext.broadcast(one)
        parts.append(checkpointed(_search(rows, shared, max_error)))
        shared.destroy()
    return reduce(DataFrame.unionAll, parts)


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_error: float = 0.08) -> DataFrame:
    """Documents (all their columns) that hold no benchmark item.

    Verdicts fall on rows, named by id and text, so null and repeated ids
    need no care; the flagged rows are few beside the documents.
    """
    named = docs.select(F.struct("*").alias("row"), row_key("doc_id", "text").alias("key"))
    found = contaminated(docs.select(row_key("doc_id", "text").alias("key"), "text"), benchmark, max_error, id_col="key")
    bad = found.select(F.col("doc_id").alias("key")).distinct()
    return named.join(bad, "key", "left_anti").select("row.*")
