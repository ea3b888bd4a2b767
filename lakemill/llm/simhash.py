"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within 3 bits are found by letting every distinct fingerprint
emit all variants within half that radius (one flipped bit) of each of its
four 48-bit projections (one 16-bit block masked), 4 * 49 in all. If two
fingerprints differ in at most 3 bits, some projection drops a differing bit
or leaves at most two, so one flip on either side makes the variants equal.

Inside a bucket the fingerprints of one variant are linked without listing
pairs: equal masked blocks form a chain, blocks one bit apart are looked up.
What that leaves (three differing bits in one block) shows as equal
projections with blocks three bits apart and is looked up likewise. Every
link is verified on the whole fingerprints, a local union-find thins the
links, and connected components are labelled by rounds of large and small
stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import IDS, ascii_lower_words, bucket_of, checkpointed, documents, mix, own_id

SEED = 42
BUCKET_BYTES = 16_000_000  # variants of one projection in a bucket
SENT = 60_000  # fingerprints whose variants are sent at once
BLOCK = 16
LOW = np.uint64((1 << BLOCK) - 1)
NEAR = np.array([1 << i for i in range(BLOCK)], np.uint64)
FAR = np.array([1 << a | 1 << b | 1 << c for a, b, c in combinations(range(BLOCK), 3)], np.uint64)


def shingle_hashes(words: list[bytes], width: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``width`` words joined by spaces."""
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-width]]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(whole[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())), np.uint64, len(starts))


def fingerprint(h: np.ndarray) -> np.uint64:
    """The SimHash of shingle hashes: a bit is 1 if set in over half of them."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):
        ones += np.unpackbits(h[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint16)
    return np.packbits(2 * ones > len(h)).view(">u8")[0]


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, no_id, fp (the 64 bits as a signed long) for each row of :func:`documents`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = np.zeros(len(batch), np.uint64)
            for i, text in enumerate(batch["text"]):
                out[i] = fingerprint(shingle_hashes(ascii_lower_words(text), width))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "no_id": batch["no_id"], "fp": out.view(np.int64)})

    return docs.select("doc_id", "no_id", "text").mapInPandas(run, f"{IDS}, fp long")


def rotate(x: np.ndarray, block: int) -> np.ndarray:
    """Bring a 16-bit block to the low end."""
    k = np.uint64(BLOCK * block)
    return x if not block else (x >> k) | (x << (np.uint64(64) - k))


def links(keys: np.ndarray, flips: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among variants: pairs of places in ``keys``.

    ``keys`` are rotated variants (masked block lowest), ``flips`` the bit
    flipped in each (64 for none). Places are of the given arrays.
    """
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    high = k >> np.uint64(BLOCK)
    same = high[1:] == high[:-1]
    company = np.zeros(len(k), bool)
    company[1:] |= same
    company[:-1] |= same
    order, k = order[company], k[company]
    left, right = [], []
    chain = np.nonzero(k[1:] == k[:-1])[0]
    left.append(order[chain])
    right.append(order[chain + 1])
    heads, at = np.unique(k, return_index=True)  # one per (variant, masked block)
    exact = np.nonzero(flips[order] == 64)[0]
    own, own_at = np.unique(k[exact], return_index=True) if len(exact) else (k[:0], exact)
    for pool, place, masks in ((heads, at, NEAR), (own, exact[own_at] if len(exact) else exact, FAR)):
        if len(pool) < 2:
            continue
        for mask in masks:
            want = pool ^ mask
            lower = want > pool
            found = np.searchsorted(pool, want[lower])
            found[found == len(pool)] = 0
            hit = pool[found] == want[lower]
            left.append(order[place[lower][hit]])
            right.append(order[place[found[hit]]])
    return np.concatenate(left), np.concatenate(right)


def union(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of links between values: (value, smallest value), roots left out."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = inverse[: len(a)], inverse[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[moved], nodes[label[moved]]


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of links that join all that the links (a, b) join, without a cycle."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    at, i, j = np.arange(len(a)), inverse[: len(a)], inverse[len(a) :]
    chosen = []
    while True:
        cross = i != j
        at, i, j = at[cross], i[cross], j[cross]
        if not len(at):
            return np.concatenate([at, *chosen])
        first = np.full(len(nodes), len(at))  # the first link out of each part
        np.minimum.at(first, i, np.arange(len(at)))
        np.minimum.at(first, j, np.arange(len(at)))
        took = np.unique(first[first < len(at)])
        chosen.append(at[took])
        label = np.arange(len(nodes))
        part, low = union(i[took], j[took])
        label[part] = low
        i, j = label[i], label[j]


def near_links(distinct: DataFrame, direct: bool = False) -> DataFrame:
    """Star links (a, b) whose closure joins fingerprints within 3 bits.

    ``distinct`` has one row per fingerprint (column fp). A bucket is to hold
    about ``BUCKET_BYTES`` of variants of one projection. Ends of a star link
    may lie further apart; with ``direct`` all links are of fingerprints
    within 3 bits, so that each can be verified on its texts.
    """
    buckets = max(1, -(-distinct.count() * 49 * 9 // BUCKET_BYTES))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = batch["fp"].to_numpy(np.int64).view(np.uint64)
            for cut in range(0, len(whole), SENT):
                fp = whole[cut : cut + SENT]
                for block in range(4):
                    base = rotate(fp, block)
                    flips = np.array([0, *(1 << i for i in range(BLOCK, 64))], np.uint64)
                    which = np.array([64, *range(BLOCK, 64)], np.uint8)
                    keys = (base[None, :] ^ flips[:, None]).ravel()
                    bits = np.repeat(which, len(fp))
                    to = bucket_of(mix((keys >> np.uint64(BLOCK)) * np.uint64(4) + np.uint64(block)), buckets)
                    order = np.argsort(to, kind="stable")
                    keys, bits, to = keys[order], bits[order], to[order]
                    ends = np.searchsorted(to, np.arange(buckets + 1, dtype=np.uint64))
                    rows = [
                        (b * 4 + block, keys[lo:hi].tobytes(), bits[lo:hi].tobytes())
                        for b, (lo, hi) in enumerate(zip(ends[:-1], ends[1:]))
                        if hi > lo
                    ]
                    yield pd.DataFrame(rows, columns=["bucket", "keys", "bits"])

    def join(batch: pd.DataFrame) -> pd.DataFrame:
        block = int(batch["bucket"].iloc[0]) % 4
        keys = np.frombuffer(b"".join(batch["keys"]), "<u8").astype(np.uint64)
        bits = np.frombuffer(b"".join(batch["bits"]), np.uint8)
        i, j = links(keys, bits, block)
        flip = np.where(bits == 64, 0, np.uint64(1) << (bits.astype(np.uint64) & np.uint64(63)))
        fp = rotate(keys ^ flip, (4 - block) % 4)
        a, b = fp[i], fp[j]
        near = (a != b) & (np.bitwise_count(a ^ b) <= 3)
        a, b = a[near], b[near]
        if direct:
            kept = forest(a, b)
            node, root = np.minimum(a[kept], b[kept]), np.maximum(a[kept], b[kept])
        else:
            node, root = union(a, b)
        return pd.DataFrame({"a": node.view(np.int64), "b": root.view(np.int64)})

    sent = distinct.select("fp").mapInPandas(emit, "bucket int, keys binary, bits binary")
    return sent.groupBy("bucket").applyInPandas(join, "a long, b long").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Label each node of (a, b) with the smallest node it reaches: node, root.

    Large-star and small-star rounds in turn; each is cut by a checkpoint.
    Labels spread along stars, so a node of very many links is only ever the
    key of a partial minimum and of a join that may be split.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        if large:
            return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        moved = both.join(least, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a != b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = checkpointed(edges.where("a != b"))
    before = state(e)
    for _ in range(most_rounds):
        e = checkpointed(star(star(e, True), False))
        now = state(e)
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row.

    component_id is the smallest doc_id reachable over links of at most 3
    differing bits. Null texts count as empty; texts without words have
    fingerprint zero and link like any other. Repeated ids are rows of their
    own. A null id is returned but never names a component with other ids.
    An empty table gives no rows; other columns are ignored.
    """
    rows = checkpointed(fingerprints(documents(docs, id_col, text_col)))
    distinct = checkpointed(rows.groupBy("fp").agg(F.min(own_id()).alias("least")))
    found = components(near_links(distinct))
    classes = distinct.join(found, distinct.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    classes = checkpointed(classes)
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    member = classes.join(named, "root").select("fp", "component_id")
    return rows.join(member, "fp").select(own_id().alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
