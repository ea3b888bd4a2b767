"""Suffix-array dedup of bytes by a distributed difference cover.

The suffixes of all documents need be sorted only by their first 100 bytes,
and only equality of those prefixes matters. The steps of the difference-cover
construction are kept, with two changes that make them fit a cluster:

* the cover is chosen by content, not by position modulo 3: of the 77 triples
  of eight-byte words that lie in a 100-byte prefix, the one with the least
  name is sampled. Equal prefixes sample the same place, which is what a
  difference cover is for, and only some 2.6 % of all suffixes are sampled;
* a name is a 64-bit fingerprint of the triple of names below it instead of
  its rank, so naming needs no sort of its own.

Names of triples, and triples of those names (72 bytes), are formed level by
level; two of these overlap to name a 100-byte prefix. The suffixes between
two sampled ones are merged with the sampled suffix that covers them: such a
cell is named by the names of its prefixes in order. Cells are sorted by
(sample, cell) in buckets and adjacent ones compared: a cell that an earlier
place has is a repeat in whole. Where one sample has cells of several kinds,
the prefixes of each first cell are sorted and compared one by one in a second
exchange. Cells are compared by 128 bits and prefixes by 96, of which 64 and
32 name the sample: only texts around equal samples could be confused. Nothing
is expanded into pairs; each shard sends a name once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import (
    IDS, M1, M2, cut_by_bucket, documents, mix, own_ids, pack_planes, pack_sorted, partitions, unpack_planes, unpack_sorted, with_range_shard,
)

LENGTH = 100
WORD = 8
TRIPLE = 3 * WORD  # bytes under the names that are sampled
CHUNK = 96 * 1024
M3 = np.uint64(0x165667B19E3779F9)
HIGH = np.uint64(0xFFFFFFFF00000000)
S32 = np.uint64(32)


def triple(names: np.ndarray, gap: int) -> np.ndarray:
    """Name of (names[p], names[p + gap], names[p + 2 gap]) for each p."""
    n = len(names) - 2 * gap
    t = names[:n] * M1
    t ^= t >> S32
    t += names[gap : gap + n]
    t *= M2
    t ^= t >> S32
    t += names[2 * gap : 2 * gap + n]
    t *= M3
    t ^= t >> S32
    return t


def prefix_names(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all ``length``-byte prefixes, and the place of each one's sample.

    ``data`` holds bytes; prefixes that would run over its end are left out.
    """
    n = len(data) - length + 1
    words = np.ndarray((len(data) - WORD + 1,), "<u8", data.tobytes(), strides=(1,)).astype(np.uint64)
    small = triple(words, WORD)  # 24 bytes
    large = triple(small, TRIPLE)  # 72 bytes
    names = mix(large[:n] * M3 + large[length - 3 * TRIPLE : length - 3 * TRIPLE + n])
    span = length - TRIPLE + 1
    least = mix(small)
    least &= HIGH
    least |= np.arange(len(least), dtype=np.uint64)  # ties go to the leftmost place
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: -(span - width)], least[span - width :])
    return names, (least[:n] & ~HIGH).astype(np.int64)


class Shard:
    """One shard's documents as one run of bytes, cut into cells of prefixes."""

    def __init__(self, batch: pd.DataFrame, length: int):
        self.length = length
        self.rows = batch.sort_values(["doc_id", "place", "text"], kind="stable").reset_index(drop=True)  # with ids or without, as a whole
        texts = [t.encode("utf-8", "surrogatepass") for t in self.rows["text"]]
        self.ends = np.cumsum([len(t) for t in texts]) if texts else np.zeros(0, np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)

    def chunks(self):
        """(start, prefix names, sample places, whether inside one document).

        Consecutive chunks meet at a cell's edge, so that no cell is cut.
        """
        at, total = 0, len(self.data)
        while at + self.length <= total:
            part = self.data[at : at + CHUNK + self.length]
            names, sample = prefix_names(part, self.length)
            place = np.arange(at, at + len(names))
            inside = self.ends[np.searchsorted(self.ends, place, side="right")] >= place + self.length
            if at + len(part) < total:
                edge = np.nonzero(sample[1:] != sample[:-1])[0][-1] + 1
                names, sample, inside = names[:edge], sample[:edge], inside[:edge]
            yield at, names, sample + at, inside
            at += len(names)

    def cells(self) -> None:
        """Sample name and cell name of every cell, with first prefix and size."""
        anchors, kinds, firsts, sizes = [], [], [], []
        for at, names, sample, inside in self.chunks():
            keep = np.nonzero(inside)[0]
            if not len(keep):
                continue
            names, sample = names[keep], sample[keep]
            head = np.concatenate([[0], np.nonzero(sample[1:] != sample[:-1])[0] + 1])
            size = np.diff(np.append(head, len(names)))
            inner = (np.arange(len(names)) - np.repeat(head, size)).astype(np.uint64)
            kinds.append(np.add.reduceat(mix(names + inner * M2), head))
            words = self.data[sample[head][:, None] + np.arange(TRIPLE)]
            anchors.append(triple(np.ascontiguousarray(words).view("<u8").astype(np.uint64).ravel(), 1)[::3][: len(head)])
            firsts.append(keep[head] + at)
            sizes.append(size)
        join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        self.anchor, self.kind = join(anchors, np.uint64), join(kinds, np.uint64)
        self.first, self.size = join(firsts, np.int64), join(sizes, np.int64)
        order, fresh = ranked(self.anchor, self.kind)
        heads = order[fresh]
        self.keys = (self.anchor[heads], self.kind[heads])  # distinct, sorted
        self.inverse = np.empty(len(order), np.int64)
        self.inverse[order] = np.cumsum(fresh) - 1
        self.leader = np.zeros(len(order), bool)  # first of its kind in the shard
        self.leader[order[fresh]] = True

    def open_prefixes(self, external: np.ndarray, mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Repeated cells; and of the prefixes left to compare the places, names
        and upper halves of their samples' names (a name in 96 bits)."""
        repeat = external[self.inverse] | ~self.leader
        open_ = ~repeat & mixed[self.inverse]
        wanted = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(wanted, self.first[open_], 1)
        np.add.at(wanted, self.first[open_] + self.size[open_], -1)
        wanted = np.cumsum(wanted[:-1]) > 0
        places, found = [], []
        for at, names, _, _ in self.chunks() if open_.any() else ():
            here = np.nonzero(wanted[at : at + len(names)])[0]
            places.append(here + at)
            found.append(names[here])
        if not places:
            return repeat, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        places = np.concatenate(places)
        cell = np.searchsorted(self.first, places, side="right") - 1
        return repeat, places, np.concatenate(found), (self.anchor[cell] >> S32).astype(np.uint32)

    def removed(self, repeat: np.ndarray, places: np.ndarray, again: np.ndarray) -> np.ndarray:
        """Mask of the bytes that repeated prefixes cover."""
        edge = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edge, self.first[repeat], 1)
        np.add.at(edge, self.first[repeat] + self.size[repeat] + self.length - 1, -1)
        np.add.at(edge, places[again], 1)
        np.add.at(edge, places[again] + self.length, -1)
        return np.cumsum(edge[:-1]) > 0


def ranked(names: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of (name, more) pairs, and which of the ordered are the first of theirs."""
    order = np.lexsort((more, names))
    n, m = names[order], more[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (n[1:] != n[:-1]) | (m[1:] != m[:-1])
    return order, fresh


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


def suffix_array_dedup(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, shards: int | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Remove bytes of ``length``-byte strings that also start earlier.

    Earlier means in a document with a smaller id, or before in the same one;
    strings are judged on the input. Returns doc_id, n_bytes, n_removed,
    n_spans, kept_sha256 and, with ``keep_text``, kept_text (characters of
    which a part was removed go whole), and the columns named in ``carry`` as a
    struct of that name; one row per input row. ``length`` is
    at least 72. Null texts count as empty; rows with equal ids are taken one
    after another, in order of a hash of their texts; rows with null ids come
    last, likewise. An empty table gives no rows; other columns are ignored.
    """
    if length < 3 * TRIPLE:
        raise ValueError(f"length must be at least {3 * TRIPLE}")
    rows = documents(docs, id_col, text_col, *([F.struct(*carry).alias("carry")] if carry else []))
    n = shards or 2 * partitions(rows.sparkSession)
    dealt, _ = with_range_shard(rows, n)
    buckets = n

    def send(batch: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(batch, length)
        shard.cells()
        anchor, kind = shard.keys
        ends = cut_by_bucket(anchor, buckets)
        number = int(batch["shard"].iloc[0])
        out = [(b, number, pack_sorted(anchor[lo:hi]), pack_planes(kind[lo:hi])) for b, (lo, hi) in enumerate(zip(ends, ends[1:])) if hi > lo]
        return pd.DataFrame(out, columns=["bucket", "shard", "anchors", "kinds"])

    def compare_cells(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("shard")
        sizes = [len(k) // 8 for k in batch["kinds"]]
        anchor = np.concatenate([unpack_sorted(a) for a in batch["anchors"]])
        kind = np.concatenate([unpack_planes(k, "<u8") for k in batch["kinds"]])
        order = np.lexsort((kind, anchor))
        a, k = anchor[order], kind[order]
        same_anchor = a[1:] == a[:-1]
        earlier, mixed = np.zeros(len(a), bool), np.zeros(len(a), bool)
        earlier[order[1:]] = same_anchor & (k[1:] == k[:-1])
        group = np.concatenate([[0], np.cumsum(~same_anchor)])
        several = np.zeros(group[-1] + 1, bool)
        several[group[1:][same_anchor & (k[1:] != k[:-1])]] = True
        mixed[order] = several[group]
        cut = np.cumsum(sizes)[:-1]
        return pd.DataFrame(
            {
                "shard": batch["shard"], "bucket": batch["bucket"], "n": sizes,
                "earlier": [_bits(f) for f in np.split(earlier, cut)], "mixed": [_bits(f) for f in np.split(mixed, cut)],
            }
        )

    def read(answers: pd.DataFrame, column: str) -> np.ndarray:
        parts = [_flags(b, int(k)) for b, k in zip(answers[column], answers["n"])]
        return np.concatenate(parts) if parts else np.zeros(0, bool)

    def send_open(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "shard", "own", "n", "earlier", "mixed"]
        if not len(batch):
            return pd.DataFrame(columns=columns)
        shard, number = Shard(batch, length), int(batch["shard"].iloc[0])
        shard.cells()
        answers = answers.sort_values("bucket")
        earlier, mixed = read(answers, "earlier"), read(answers, "mixed")
        _, _, names, more = shard.open_prefixes(earlier, mixed)
        order, fresh = ranked(names, more)
        names, more = names[order[fresh]], more[order[fresh]]
        ends = cut_by_bucket(names, buckets)
        # what the shard has learned goes along, to come back with the answers
        out = [(number % buckets, number, True, len(earlier), _bits(earlier), _bits(mixed))]
        out += [(b, number, False, hi - lo, pack_sorted(names[lo:hi]), pack_planes(more[lo:hi])) for b, (lo, hi) in enumerate(zip(ends, ends[1:])) if hi > lo]
        return pd.DataFrame(out, columns=columns)

    def compare_prefixes(batch: pd.DataFrame) -> pd.DataFrame:
        own = batch[batch["own"]]
        rest = batch[~batch["own"]].sort_values("shard")
        if not len(rest):
            return own
        names = np.concatenate([unpack_sorted(k) for k in rest["earlier"]])
        order, fresh = ranked(names, np.concatenate([unpack_planes(m, "<u4") for m in rest["mixed"]]))
        earlier = np.zeros(len(names), bool)
        earlier[order] = ~fresh
        flags = np.split(earlier, np.cumsum(rest["n"])[:-1])
        return pd.concat([own, rest.assign(earlier=[_bits(f) for f in flags], mixed=None)])

    def finish(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "no_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
        if carry and not len(batch):
            return pd.DataFrame(columns=[*columns, "carry"])
        if not len(batch):
            return pd.DataFrame(columns=columns)
        shard = Shard(batch, length)
        shard.cells()
        own = answers[answers["own"]]
        repeat, places, names, more = shard.open_prefixes(read(own, "earlier"), read(own, "mixed"))
        order, fresh = ranked(names, more)
        external = read(answers[~answers["own"]].sort_values("bucket"), "earlier")
        again = np.zeros(len(names), bool)
        if len(names):
            again[order] = external[np.cumsum(fresh) - 1] | ~fresh
        mask = shard.removed(repeat, places, again)
        out, start = [], 0
        for doc, none, stop in zip(shard.rows["doc_id"], shard.rows["no_id"], shard.ends.tolist()):
            data, gone = shard.data[start:stop], mask[start:stop]
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            kept = (data[~gone] if spans else data).tobytes()
            text = None
            if keep_text:
                text = _whole_characters(data, gone) if spans else kept.decode("utf-8", "surrogatepass")
            out.append((doc, none, stop - start, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), text))
            start = stop
        frame = pd.DataFrame(out, columns=columns)
        if carry:
            frame["carry"] = shard.rows["carry"]
        return frame

    plain = dealt.drop("carry")
    sent = plain.groupBy("shard").applyInPandas(send, "bucket int, shard int, anchors binary, kinds binary")
    cells = sent.groupBy("bucket").applyInPandas(compare_cells, "shard int, bucket int, n long, earlier binary, mixed binary")
    fields = "bucket int, shard int, own boolean, n long, earlier binary, mixed binary"
    opened = plain.groupBy("shard").cogroup(cells.groupBy("shard")).applyInPandas(send_open, fields)
    answers = opened.groupBy("bucket").applyInPandas(compare_prefixes, fields)
    schema = f"{IDS}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    if carry:
        schema += f", carry {rows.schema['carry'].dataType.simpleString()}"
    out = own_ids(dealt.groupBy("shard").cogroup(answers.groupBy("shard")).applyInPandas(finish, schema))
    return out if keep_text else out.drop("kept_text")


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> str:
    """What is left when characters go whole of which any byte is gone."""
    head = (data & 0xC0) != 0x80
    number = np.cumsum(head) - 1
    lost = np.zeros(number[-1] + 1, bool)
    lost[number[gone]] = True
    return data[~lost[number]].tobytes().decode("utf-8", "surrogatepass")
