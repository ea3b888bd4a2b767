"""Substring dedup with repeated-phrase automata.

Documents are dealt to shards by ranges of doc_id. A pass over the shards
sends the distinct fingerprints of all 13-word windows to buckets. Buckets
confirm which recur, and name for each shard that holds a window the nearest
earlier shard that does: the one to supply it. Suppliers cut the passages they
are asked for (runs of such windows) out of their documents and send their
words on; each shard adds the passages that repeat among its own documents.

A shard compiles its passages into one Aho-Corasick automaton over word codes
and streams every one of its documents through it; so all documents are read,
each by the automaton of all passages that it may share with an earlier one.
Each hit is extended to the whole occurrence by comparing words, and only what
so agrees is removed: fingerprints choose passages, they remove nothing.

An anchor phrase is the five-word phrase of a window with the least
fingerprint: it depends on the window's words alone, so an occurrence of any
window of a passage holds that window's anchor phrase, and is found.
"""

from __future__ import annotations

import hashlib
from itertools import compress, product, repeat

import ahocorasick
import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame

from lakemill.llm.common import (
    IDS, M1, M2, WordHash, cut_by_bucket, distinct, documents, mix, own_ids, pack_planes, pack_sorted, partitions, unpack_planes, unpack_sorted, with_range_shard,
    words_of,
)

PHRASE = 5
HALF = np.uint64(32)


def runs_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of each run of ``width`` word hashes, in order: runs of 1, 2,
    4 ... words are made from two halves, and the width from some of these."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, run, size = np.zeros(n, np.uint64), 0, h, 1
    while True:
        if width & size:
            out = (out + run[done : done + n]) * M1
            out ^= out >> HALF
            done += size
        if 2 * size > width:
            return mix(out)
        run = (run[:-size] * M2 + run[size:]) * M1
        run ^= run >> HALF
        size *= 2


def windows_of(sizes: list[int], hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all windows inside one document, and how many each document has."""
    every = runs_hash(hashes, width)
    ends = np.cumsum(sizes)
    inside = np.ones(len(every), bool)
    for k in range(1, width):  # windows that begin in the last words of a document run over its end
        at = ends - k
        inside[at[(at >= 0) & (at < len(every))]] = False
    counts = np.maximum(np.array(sizes, np.int64) - (width - 1), 0)
    return every[inside], counts


def word_codes(number: dict[bytes, int]) -> dict[bytes, str]:
    """Words as strings of one length in a small alphabet, which keeps the
    automaton's nodes narrow. First letters are capitals, so that matches
    begin where words do."""
    wide = 1
    while 24**wide < len(number):
        wide += 1
    letters = [chr(65 + i) for i in range(24)], *[[chr(97 + i) for i in range(24)]] * (wide - 1)
    return dict(zip(number, map("".join, product(*letters))))


def same_words(run: str, at: int, line: str, here: int, most: int, wide: int, ahead: bool) -> int:
    """How many words from (or before) two places agree, up to ``most``."""
    sign = 1 if ahead else -1

    def agree(k: int) -> bool:
        i, j, m, n = at * wide, (at + sign * k) * wide, here * wide, (here + sign * k) * wide
        return run[i:j] == line[m:n] if ahead else run[j:i] == line[n:m]

    if agree(most):
        return most
    low, high, step = 0, most - 1, 2  # doubling from near, then halving
    while low < high:
        k = min(high, low + step)
        if agree(k):
            low, step = k, 2 * step
        else:
            high, step = k - 1, max(1, step // 2)
    return low


def ranks_of(batch: pd.DataFrame) -> np.ndarray:
    """Dense rank of each row's id; a shard has ids or has none."""
    return np.unique(batch["doc_id"].to_numpy(np.int64), return_inverse=True)[1]


def packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pack_planes(x.astype("<u4")))


def unpacked(data: bytes) -> np.ndarray:
    return unpack_planes(zstandard.ZstdDecompressor().decompress(data), "<u4").astype(np.int64)


class Shard:
    """The windows of one shard's documents, in order of their ids."""

    def __init__(self, batch: pd.DataFrame, width: int):
        rank = ranks_of(batch)
        order = np.argsort(rank, kind="stable")
        memo = WordHash()
        self.rank, self.width = rank[order], width
        self.words = [words_of(batch["text"].iat[i]) for i in order]
        every, counts = windows_of([*map(len, self.words)], memo.of([w for words in self.words for w in words]), width)
        self.start = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.owner = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        self.order = np.argsort(every)
        ranked = every[self.order]
        fresh = np.ones(len(ranked), bool)
        fresh[1:] = ranked[1:] != ranked[:-1]
        self.heads = np.nonzero(fresh)[0]  # of each distinct window, in the order
        self.first = np.minimum.reduceat(self.order, self.heads) if len(ranked) else self.order  # its first place

    def repeated_inside(self, external: np.ndarray) -> np.ndarray:
        """Places of the windows that a later document of the shard has too and
        no earlier shard supplies."""
        if not len(self.order):
            return self.order
        last = np.maximum.reduceat(self.rank[self.owner][self.order], self.heads)
        return np.sort(self.first[~external & (last > self.rank[self.owner[self.first]])])

    def passages(self, places: np.ndarray, targets: np.ndarray) -> list[tuple[int, int, bytes]]:
        """(target, home document, words) of each run of places; both sorted by (target, place)."""
        doc = self.owner[places]
        breaks = np.nonzero((np.diff(places) != 1) | (np.diff(doc) != 0) | (np.diff(targets) != 0))[0] + 1
        edges = np.concatenate([[0], breaks, [len(places)]]).astype(int)
        local = places - self.start[doc]
        return [
            (int(targets[a]), int(doc[a]), b" ".join(self.words[doc[a]][local[a] : local[b - 1] + self.width]))
            for a, b in zip(edges, edges[1:])
            if b > a
        ]


def locate(documents_words: list[list[bytes]], ranks: np.ndarray, passages: list[tuple[int, list[bytes]]], width: int) -> list[np.ndarray]:
    """Per document, which words an automaton over the passages removes.

    A passage is (rank of its home, words); it removes from documents of a
    larger rank whatever agrees with it in ``width`` words or more.
    """
    removed = [np.zeros(len(w), bool) for w in documents_words]
    number: dict[bytes, int] = {}
    for _, words in passages:
        for w in words:
            number.setdefault(w, len(number))
    if not number:
        return removed
    memo, phrase = WordHash(), min(PHRASE, width)
    code = word_codes(number)
    wide, unknown = len(next(iter(code.values()))), "~" * len(next(iter(code.values())))
    # all passages as one run of words, with a stop after each
    parts, source, begin, places = [], [], [], {}
    for p, (_, words) in enumerate(passages):
        begin.append(len(parts))
        parts += [code[w] for w in words] + ["." * wide]
        source += [p] * (len(words) + 1)
    run = "".join(parts)
    for p, (_, words) in enumerate(passages):
        view = np.lib.stride_tricks.sliding_window_view(runs_hash(memo.of(words), phrase), width - phrase + 1)
        for at in distinct(view.argmin(axis=1) + np.arange(len(view))):
            at = begin[p] + int(at)
            places.setdefault(run[at * wide : (at + phrase) * wide], []).append(at)
    machine = ahocorasick.Automaton()
    for key, at in places.items():
        machine.add_word(key, at)
    machine.make_automaton()
    for d, words in enumerate(documents_words):
        n = len(words)
        if n < width:
            continue
        line = "".join(map(code.get, words, repeat(unknown)))
        rank = ranks[d]
        done: dict[int, int] = {}  # diagonal to where it has been read
        for end, where in machine.iter(line):
            here = (end + 1) // wide - phrase
            for at in where:
                if done.get(at - here, -1) > here:
                    continue
                p = source[at]
                home, own = passages[p]
                if home >= rank:
                    continue
                back, ahead = min(at - begin[p], here), min(begin[p] + len(own) - at, n - here)
                if run[(at - back) * wide : (at + ahead) * wide] != line[(here - back) * wide : (here + ahead) * wide]:
                    back = same_words(run, at, line, here, back, wide, False)
                    ahead = same_words(run, at, line, here, ahead, wide, True)
                done[at - here] = here + ahead
                if back + ahead >= width:
                    removed[d][here - back : here + ahead] = True
    return removed


def suppliers(keys: list[np.ndarray], shards: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Who has each key and who supplies it.

    ``keys`` are each shard's distinct keys, in shard order. Returns, for all
    keys in one run: whether a shard of an earlier class has it; and pairs
    (place of the supplier's key, shard it goes to), sorted.
    """
    whole = np.concatenate(keys)
    shard = np.repeat(shards, [len(k) for k in keys])
    order = np.argsort(whole, kind="stable")
    ranked, kind = whole[order], classes[shard[order]]
    fresh = np.ones(len(whole), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    head = fresh.copy()
    head[1:] |= kind[1:] != kind[:-1]
    heads = np.nonzero(head)[0]
    before = np.where(fresh[heads], -1, heads - 1)[np.cumsum(head) - 1]
    has = before >= 0
    earlier = np.zeros(len(whole), bool)
    earlier[order[has]] = True
    place, to = order[before[has]], shard[order[has]]
    by = np.lexsort((to, place))
    return earlier, place[by], to[by]


def substring_dedup(
    docs: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, shards: int | None = None
) -> DataFrame:
    """Remove words of ``width``-word windows that an earlier document holds.

    Windows are judged on the input. Returns doc_id, n_words, n_removed,
    kept_sha256 and, with ``keep_text``, kept_text (kept words joined by one
    space); one row per input row. Null texts count
    as empty. Rows with equal ids are not earlier than each other; rows with a
    null id come after all others and are not earlier than each other. An
    empty table gives no rows; other columns are ignored. Whatever is removed
    was compared word by word.
    """
    rows = documents(docs, id_col, text_col)
    spark = rows.sparkSession
    dealt, kinds = with_range_shard(rows, shards or 3 * partitions(spark))
    buckets = shards or partitions(spark)
    classes = np.array(kinds, np.int64)

    def send(batch: pd.DataFrame) -> pd.DataFrame:
        texts = [words_of(t) for t in batch["text"]]
        keys = distinct(windows_of([*map(len, texts)], WordHash().of([w for words in texts for w in words]), width)[0])
        ends = cut_by_bucket(keys, buckets)
        out = [(b, int(batch["shard"].iloc[0]), pack_sorted(keys[lo:hi])) for b, (lo, hi) in enumerate(zip(ends, ends[1:])) if hi > lo]
        return pd.DataFrame(out, columns=["bucket", "shard", "keys"])

    def confirm(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("shard")
        keys = [unpack_sorted(k) for k in batch["keys"]]
        earlier, place, to = suppliers(keys, batch["shard"].to_numpy(), classes)
        starts = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        cut = np.searchsorted(place, starts)
        out = []
        for i, shard in enumerate(batch["shard"]):
            bits = np.packbits(earlier[starts[i] : starts[i + 1]]).tobytes()
            mine = place[cut[i] : cut[i + 1]] - starts[i]
            out.append((shard, batch["bucket"].iat[i], len(keys[i]), bits, packed(np.diff(mine, prepend=0)), packed(to[cut[i] : cut[i + 1]])))
        return pd.DataFrame(out, columns=["shard", "bucket", "n", "bits", "steps", "targets"])

    def supply(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["shard", "homes", "words"]
        if not len(batch) or not len(answers):
            return pd.DataFrame(columns=columns)
        own, shard = int(batch["shard"].iloc[0]), Shard(batch, width)
        answers = answers.sort_values("bucket")
        start = np.concatenate([[0], np.cumsum(answers["n"])])
        external = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=int(k)) for b, k in zip(answers["bits"], answers["n"])]).astype(bool)
        asked = np.concatenate([np.cumsum(unpacked(s)) + a for s, a in zip(answers["steps"], start)])
        to = np.concatenate([unpacked(t) for t in answers["targets"]])
        places = shard.first[asked]
        order = np.lexsort((places, to))
        inside = shard.repeated_inside(external)
        found: dict[int, list] = {}
        for target, _, words in shard.passages(places[order], to[order]):
            found.setdefault(target, []).append((-1, words))
        for target, doc, words in shard.passages(inside, np.full(len(inside), own)):
            found.setdefault(target, []).append((int(shard.rank[doc]), words))
        press = zstandard.ZstdCompressor(level=3).compress
        out = [(t, np.array([h for h, _ in ps], "<i4").tobytes(), press(b"\n".join([w for _, w in ps]))) for t, ps in found.items()]
        return pd.DataFrame(out, columns=columns)

    def stream(batch: pd.DataFrame, supplied: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "no_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
        if not len(batch):
            return pd.DataFrame(columns=columns)
        passages = []
        for homes, words in zip(supplied["homes"], supplied["words"]):
            lines = zstandard.ZstdDecompressor().decompress(words).split(b"\n")
            passages += zip(np.frombuffer(homes, "<i4").tolist(), [x.split(b" ") for x in lines])
        texts = [words_of(t) for t in batch["text"]]
        out = []
        for words, gone in zip(texts, locate(texts, ranks_of(batch), passages, width)):
            kept = b" ".join(compress(words, (~gone).tolist()) if gone.any() else words)
            out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass") if keep_text else None))
        frame = pd.DataFrame(out, columns=columns[2:])
        return frame.assign(doc_id=batch["doc_id"].to_numpy(), no_id=batch["no_id"].to_numpy())

    sent = dealt.groupBy("shard").applyInPandas(send, "bucket int, shard int, keys binary")
    answers = sent.groupBy("bucket").applyInPandas(confirm, "shard int, bucket int, n long, bits binary, steps binary, targets binary")
    supplied = dealt.groupBy("shard").cogroup(answers.groupBy("shard")).applyInPandas(supply, "shard int, homes binary, words binary")
    schema = f"{IDS}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    out = own_ids(dealt.groupBy("shard").cogroup(supplied.groupBy("shard")).applyInPandas(stream, schema))
    return out if keep_text else out.drop("kept_text")
