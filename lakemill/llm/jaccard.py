"""Near copies by SimHash, with bands for what lies beyond its radius; all verified exactly.

Texts of equal shingle sets are one node. First SimHash: the fingerprints of
the sets are linked within 3 bits by ball hashing (``simhash.near_links``).
Texts of similarity 0.8 lie some ten bits apart, out of reach of balls; for
these, MinHash bands add candidates: texts of similarity s share a band of
``ROWS`` minima with probability 1 - (1 - s ** ROWS) ** BANDS, which at 0.8 is
all but 3 in a million. Every candidate is verified by the Jaccard similarity
of the sets, and components are formed over all links. The nodes of a band are compared with one of them (the hub; another
for each band), which joins a large group by few links. Groups that their hub has not joined into
one component are split by every further band, and the parts, whose nodes are
much closer, are compared with two hubs of their own. So the work grows with the
rows and never with the square of a group; a link can be missed only where two
nodes are alike and neither is like any of the hubs of all their shared groups
and parts (the README has the measured share).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import IDS, ascii_lower_words, checkpointed, distinct, documents, own_id, release, row_key
from lakemill.llm.simhash import SEED, components, fingerprint, near_links, shingle_hashes

BANDS, ROWS = 32, 5
CHUNK = 4_096  # shingles hashed at once


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return distinct(shingle_hashes(ascii_lower_words(text), width))


def hash_functions() -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and addends of the BANDS * ROWS hash functions."""
    r = np.random.default_rng(SEED)
    draw = lambda: r.integers(0, 2**64, BANDS * ROWS, np.uint64, endpoint=False)
    return draw() | np.uint64(1), draw()


def minima(shingles: np.ndarray, times: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """The least value of the set under each hash function."""
    least = np.full(len(times), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        np.minimum(least, (times[:, None] * shingles[None, at : at + CHUNK] + plus[:, None]).min(axis=1), out=least)
    return least


def sketches(rows: DataFrame, width: int) -> DataFrame:
    """row, doc_id, no_id, node (hash of the shingle set), the set's SimHash and its band keys for each row of row, doc_id, no_id, text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        times, plus = hash_functions()
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            nodes, fps, bands = np.zeros(len(batch), np.uint64), np.zeros(len(batch), np.uint64), []
            for i, text in enumerate(batch["text"]):
                have = shingle_set(text, width)
                nodes[i] = digest(have.tobytes(), SEED)
                fps[i] = fingerprint(have)
                low = minima(have, times, plus).reshape(BANDS, ROWS) if len(have) else np.zeros((0, ROWS), np.uint64)
                bands.append(np.array([digest(x.tobytes(), b) for b, x in enumerate(low)], np.uint64).view(np.int64))
            own = {"row": batch["row"], "doc_id": batch["doc_id"], "no_id": batch["no_id"]}
            yield pd.DataFrame({**own, "node": nodes.view(np.int64), "fp": fps.view(np.int64), "bands": bands})

    return rows.mapInPandas(run, f"row long, {IDS}, node long, fp long, bands array<long>")


def shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """node and its packed shingle set for each row of node, text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "shingles": [shingle_set(t, width).tobytes() for t in batch["text"]]})

    return texts.mapInPandas(run, "node long, shingles binary")


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets have at least this Jaccard similarity."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (x, y) in enumerate(zip(batch["x"], batch["y"])):
                n, m = len(x) // 8, len(y) // 8
                if min(n, m) >= similarity * max(n, m):
                    both = np.sort(np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)]))
                    common = int((both[1:] == both[:-1]).sum())
                    keep[i] = common >= similarity * (n + m - common)
            yield batch.loc[keep, ["a", "b"]]

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def close_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes within 3 bits whose closure joins all such: of each
    fingerprint the smallest node with the others, and those of close fingerprints.

    ``nodes`` has one row per node (columns node and fp).
    """
    heads = checkpointed(nodes.groupBy("fp").agg(F.min("node").alias("head")))
    equal = nodes.join(heads, "fp").where("node != head").select(*_pair("node", "head"))
    left, right = heads.toDF("a", "x"), heads.toDF("b", "y")
    near = near_links(heads, direct=True).join(left, "a").join(right, "b").select(*_pair("x", "y"))
    return equal.union(near).distinct()


def near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, node and root for each row of ``docs``.

    ``row`` is :func:`lakemill.llm.common.row_key`. Rows of one root are joined by links of at
    least ``similarity``; it is one of their nodes. Null texts count as empty;
    texts without words are copies of each other. An empty table gives no rows.
    """
    keyed = documents(docs, id_col, text_col, row_key(id_col, text_col).alias("row"))
    rows = checkpointed(sketches(keyed, width))
    close = checkpointed(close_pairs(rows.select("node", "fp").distinct()))
    release(docs.sparkSession)
    nodes = rows.dropDuplicates(["node"]).select("node", "bands")
    places = nodes.select("node", F.explode("bands").alias("key"))
    hubs = places.groupBy("key").agg(F.min(F.col("node").bitwiseXOR(F.col("key"))).alias("low"), F.count("*").alias("n")).where("n > 1")
    shared = checkpointed(places.join(hubs, "key").select("key", "node", F.col("low").bitwiseXOR(F.col("key")).alias("hub")))
    del nodes, places, hubs  # they name the shuffles of this step
    release(docs.sparkSession)
    linked = shared.select("node").union(close.select("a")).union(close.select("b")).distinct()
    wanted = rows.join(linked, "node").groupBy("node").agg(F.min("row").alias("row"))
    sets = checkpointed(shingle_sets(keyed.join(wanted, "row").select("node", "text"), width).dropDuplicates(["node"]))

    del linked, wanted
    release(docs.sparkSession)
    tried = checkpointed(shared.where("node != hub").select(*_pair("node", "hub")).union(close).distinct())
    links = checkpointed(similar(tried, sets, similarity))
    release(docs.sparkSession)
    found = components(links)
    release(docs.sparkSession)
    placed = shared.join(found, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).where("lo != hi and n > 2").select("key")
    bands = placed.join(mixed, "key", "left_semi").groupBy("node").agg(F.collect_set("key").alias("keys"))  # at most BANDS
    first = bands.select("node", "keys", F.explode("keys").alias("one"))
    parts = first.select("node", F.explode(F.filter("keys", lambda k: k > F.col("one"))).alias("two"), "one")
    parts = checkpointed(parts.select(F.xxhash64("one", "two").alias("key"), "node"))
    for pick in (F.min, F.max):  # two hubs, the second for what the first leaves apart
        homed = parts.join(found, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        hub = pick(F.struct(F.col("node").bitwiseXOR(F.col("key")).alias("at"), F.col("root").alias("home"))).alias("hub")
        heads = homed.groupBy("key").agg(hub, F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("key", "hub.*")
        away = homed.join(heads, "key").where("root != home").select("node", F.col("at").bitwiseXOR(F.col("key")).alias("hub"))
        pairs = checkpointed(away.select(*_pair("node", "hub")).distinct().join(tried, ["a", "b"], "left_anti"))
        more = checkpointed(similar(pairs, sets, similarity))
        release(docs.sparkSession)
        if not more.isEmpty():
            tried, links = tried.union(pairs), links.union(more)
            found = components(links)
    return rows.join(found, "node", "left").select("row", own_id().alias("doc_id"), "node", F.coalesce("root", "node").alias("root"))


def drop_near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, of one document of each group of near copies.

    The smallest doc_id of a group stays (a null one only if there is no
    other). Verdicts fall on rows, named by id and text: rows of one id but
    different texts, and rows without an id, are documents of their own.
    Repeated rows of one id and text are one document.
    """
    found = checkpointed(near_copies(docs, width, similarity, id_col, text_col).select("row", "doc_id", "root").distinct())
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    crowd = found.groupBy("root").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").select("root", F.col("first.row").alias("stays"))
    gone = found.join(crowd, "root").where("row != stays").select(F.col("row").alias("key")).distinct()
    named = docs.select(F.struct("*").alias("row"), row_key(id_col, text_col).alias("key"))
    return named.join(gone, "key", "left_anti").dropDuplicates(["key"]).select("row.*")
