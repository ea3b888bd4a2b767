"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features are single words, their stems (the first four bytes, so that
inflected forms share a feature), adjacent pairs and skip pairs (one or two
words between), hashed to 2**bits places, each counted once per document. The model
is trained online on a bounded, documented sample of labelled rows, with
per-coordinate rates and L1 sparsity; the few weights that are not zero are
what scoring broadcasts (at most 2**bits of them).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import IDS, M1, M2, WordHash, crc_mod, distinct, documents, mix, own_ids

STEM = 4
# Punctuation separates words; letters beyond ASCII are kept as they are.
_SEPARATE = bytes(b if b >= 128 or chr(b).isalnum() or chr(b) == "'" else 32 for b in range(256))


@dataclass(frozen=True)
class FtrlSettings:
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.5
    bits: int = 20
    epochs: int = 4
    #: bound of the training sample (rows, by hash of the id)
    sample_rows: int = 10_000


def tokens(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(_SEPARATE).split()


def hashes_of(text: str, memo: WordHash) -> np.ndarray:
    """Hashes of the words and their stems: two rows."""
    words = tokens(text)
    return np.stack([memo.of(words), memo.of([w[:STEM] for w in words])])


def features(both: np.ndarray, doc: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of word and stem hashes in order, with their documents."""
    shift, (h, stem) = np.uint64(64 - bits), both
    places, owners = [mix(h) >> shift, mix(stem * M1 + M2) >> shift], [doc, doc]
    for gap in (1, 2, 3):
        if len(h) > gap:
            same = doc[gap:] == doc[:-gap]
            pair = mix(h[:-gap] * M1 + h[gap:] * M2 + np.uint64(gap))
            places.append(pair[same] >> shift)
            owners.append(doc[gap:][same])
    return np.concatenate(places).astype(np.int64), np.concatenate(owners)


def train(examples: list[tuple[np.ndarray, int]], s: FtrlSettings) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over (feature places, label); places, weights and bias."""
    size = 1 << s.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    for _ in range(s.epochs):
        for x, y in examples:
            x = np.append(x, size)
            zx, nx = z[x], n[x]
            root = np.sqrt(nx)
            w = -(zx - np.sign(zx) * s.l1) / ((s.beta + root) / s.alpha + s.l2)
            w[np.abs(zx) <= s.l1] = 0
            w[-1] = -zx[-1] / ((s.beta + root[-1]) / s.alpha)  # the bias is not regularised
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            z[x] += g - (np.sqrt(nx + g * g) - root) / s.alpha * w
            n[x] += g * g
    w = -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)
    w[np.abs(z) <= s.l1] = 0
    bias = float(-z[-1] / ((s.beta + np.sqrt(n[-1])) / s.alpha))
    at = np.nonzero(w[:-1])[0]
    return at, w[at], bias


def train_model(docs: DataFrame, labels: DataFrame, s: FtrlSettings) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights learned from the first ``sample_rows`` training ids by hash.

    ``docs`` is of :func:`documents`, ``labels`` has doc_id and label (0/1).
    Rows with a null id or label are left out. Each (id, label) is one
    example, whatever the number of rows: of several texts under an id, one
    (that of the least packed features). Without examples the model is constant.
    """
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .select("doc_id", F.col("label").cast("int").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(s.sample_rows)
    )
    rows = docs.where("not no_id").join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHash()
        for batch in batches:
            out = []
            for text in batch["text"]:
                both = hashes_of(text, hashes)
                at, _ = features(both, np.zeros(both.shape[1], np.int32), s.bits)
                out.append(distinct(at).astype("<i4").tobytes())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "x": out})

    def learn(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["doc_id", "label", "x"])
        order = np.random.default_rng(7).permutation(len(batch))
        x, y = batch["x"].tolist(), batch["label"].tolist()
        at, w, bias = train([(np.frombuffer(x[i], "<i4"), y[i]) for i in order], s)
        return pd.DataFrame({"at": [at.astype("<i4").tobytes()], "w": [w.astype("<f4").tobytes()], "bias": [bias]})

    examples = rows.mapInPandas(extract, "doc_id long, label int, x binary").groupBy("doc_id", "label").agg(F.min("x").alias("x"))
    # one task by nature of an online learner; its rows are bounded by sample_rows
    got = examples.groupBy().applyInPandas(learn, "at binary, w binary, bias double").collect()
    if not got:
        return np.zeros(0, np.int64), np.zeros(0), 0.0
    return np.frombuffer(got[0].at, "<i4").astype(np.int64), np.frombuffer(got[0].w, "<f4").astype(float), got[0].bias


BLOCK = 300_000  # words handled at once


def scorer(model: tuple[np.ndarray, np.ndarray, float], s: FtrlSettings):
    """A function from texts to scores (0 to 1)."""
    at, w, bias = model
    table = np.zeros(1 << s.bits, np.float32)
    table[at] = w
    memo = WordHash()

    def totals(parts: list[np.ndarray]) -> np.ndarray:
        doc = np.repeat(np.arange(len(parts)), [p.shape[1] for p in parts])
        place, owner = features(np.concatenate(parts, axis=1), doc, s.bits)
        hit = np.nonzero(table[place])[0]
        once = distinct(owner[hit].astype(np.int64) << s.bits | place[hit])
        return np.bincount(once >> s.bits, weights=table[once & ((1 << s.bits) - 1)], minlength=len(parts))

    def run(texts) -> np.ndarray:
        sums, parts, size = [], [], 0
        for text in texts:
            parts.append(hashes_of(text or "", memo))
            size += parts[-1].shape[1]
            if size > BLOCK:
                sums.append(totals(parts))
                parts, size = [], 0
        if parts:
            sums.append(totals(parts))
        total = np.concatenate(sums) if sums else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(total + bias, -35, 35)))

    return run


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], s: FtrlSettings) -> DataFrame:
    """doc_id, no_id and score for each row of :func:`documents`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = scorer(shared.value, s)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "no_id": batch["no_id"], "score": of(batch["text"])})

    return docs.select("doc_id", "no_id", "text").mapInPandas(run, f"{IDS}, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, s: FtrlSettings = FtrlSettings(), label_col: str = "toxic", folds: int = 5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, whose text scores below 0.5.

    The model is that of :func:`toxicity`; rows are judged one by one, so
    null and repeated ids need no care; a null text scores as an empty one.
    Without a labelled example there is nothing to judge by, and all stay.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).alias("label")).where(crc_mod(F.col("doc_id"), folds) != 0)
    model = train_model(documents(docs, text_col=text_col), known, s)
    if not len(model[0]) and not model[2]:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        of = scorer(shared.value, s)
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):  # small batches keep the buffers on both sides small
                batch = whole.slice(at, 1_000)
                yield batch.filter(pa.array(of(batch.column(batch.schema.get_field_index(text_col)).to_pylist()) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, s: FtrlSettings = FtrlSettings(), label_col: str = "toxic", folds: int = 5) -> DataFrame:
    """Score every whole text; one row per input row.

    Learns from labelled rows with crc32(doc_id) mod ``folds`` not 0. Returns
    doc_id, held_out, score (0 to 1) and predicted (1 if score >= 0.5). Null
    texts are empty and score as the bias alone; a null id counts as the
    empty text for the fold; repeated rows score alike; empty tables give no
    rows; with no labels the score is 0.5. Other columns are ignored.
    """
    rows = documents(docs)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).alias("label")).where(crc_mod(F.col("doc_id"), folds) != 0)
    scored = own_ids(score(rows, train_model(rows, known, s), s))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), folds) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
