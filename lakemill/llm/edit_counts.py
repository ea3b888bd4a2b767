"""Edit-aware token counts on kept segment trees of pre-tokens.

A tree is a row of a table: one per document. Its leaves hold runs of
pre-tokens (their text, lengths and token counts) and ``sums`` holds, for each
node, the characters, tokens and pre-tokens below it. The table is built once
and written; applying edits reads it, opens only the leaves that an edit
touches and gives back updated rows. An edit re-splits text from the pre-token
that holds the second character before it (the furthest the pattern looks
ahead) until the new boundaries meet the old ones, re-encodes only those
pre-tokens and updates the sums above the touched leaves.
"""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemill.llm.bpe import Finder, Memo, Vocabulary, classes
from lakemill.llm.common import shared_folder

LEAF = 64
EDITS = "array<struct<start:bigint,delete:bigint,insert:string>>"
TREE = "texts array<string>, lengths array<binary>, counts array<binary>, sums binary"
BEFORE = ["n_pretokens", "n_tokens"]
AFTER = ["n_edits", "n_reencoded", "n_pretokens_after", "n_tokens_after"]
ROWS = 1_000  # rows of a batch given back at once


@functools.cache
def pretoken_pattern(narrow: bool = False) -> str:
    letter, digit, space = classes(narrow).values()
    # Fixed value: the byte-level pre-token pattern of the vocabulary. Words and numbers, which are
    # most, are tried before contractions, which begin with neither.
    return f" ?[{letter}]+| ?[{digit}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+"


class Counter(Memo):
    """Tokens of a pre-token, by exact merges; remembers what it used lately."""

    LIMIT = 300_000

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(lambda pretoken: len(vocabulary.merge(pretoken)), self.LIMIT)

    def of(self, pretokens: list[str]) -> list[int]:
        return [*map(self.__getitem__, pretokens)]

    @classmethod
    def kept(cls, vocabulary: Vocabulary) -> Counter:
        """The counter of a worker: it stays with the broadcast vocabulary, so that
        the tasks of one worker merge a pre-token once."""
        if not hasattr(vocabulary, "counter"):
            vocabulary.counter = cls(vocabulary)
        return vocabulary.counter


def load(path: str) -> Vocabulary:
    """A vocabulary whose pre-tokens are those of the pattern here."""
    vocabulary = Vocabulary.load(path)
    if vocabulary.kind != "bytes":
        raise ValueError("token counts need a byte-level file")
    return vocabulary


def pack(xs: list[int]) -> bytes:
    """Small numbers in a byte each, or all in four."""
    try:
        return bytes(xs)
    except ValueError:
        return np.array(xs, "<u4").tobytes()


def unpack(data: bytes, n: int) -> list[int]:
    return list(data) if len(data) == n else np.frombuffer(data, "<u4").tolist()


class Leaf:
    """A run of pre-tokens."""

    __slots__ = ("text", "lengths", "counts")

    def __init__(self, text: str = "", lengths: list[int] | None = None, counts: list[int] | None = None):
        self.text, self.lengths, self.counts = text, lengths or [], counts or []

    @property
    def sums(self) -> tuple[int, int, int]:
        return len(self.text), sum(self.counts), len(self.lengths)


def leaves_of(text: str, pieces: list[str], counts: list[int]) -> list[Leaf]:
    lengths, out, at = [*map(len, pieces)], [], 0
    for i in range(0, len(pieces), LEAF):
        mine = lengths[i : i + LEAF]
        end = at + sum(mine)
        out.append(Leaf(text[at:end], mine, counts[i : i + LEAF]))
        at = end
    return out


def sums_of(rows: np.ndarray) -> np.ndarray:
    """Sums of all nodes of a tree over leaves with these sums."""
    size = 1 << max(0, len(rows) - 1).bit_length()
    sums = np.zeros((2 * size, 3), np.int64)  # characters, tokens, pre-tokens
    sums[size : size + len(rows)] = rows
    at = size
    while at > 1:
        sums[at // 2 : at] = sums[at : 2 * at : 2] + sums[at + 1 : 2 * at : 2]
        at //= 2
    return sums


class Pretokens(Finder):
    """Finds all pre-tokens of a text, or the one at a place."""

    def __init__(self, pattern: str, narrow: str):
        super().__init__(pattern, narrow)
        self.match = re.compile(pattern).match


class DocumentTree:
    """Segment tree over one document's pre-tokens; ``edit`` keeps it right.

    ``leaves`` are Leaf objects or numbers, which ``stored`` turns into a Leaf
    when one is first needed; ``read`` counts the characters so opened.
    """

    def __init__(self, leaves: list, sums: np.ndarray, pattern: Pretokens, counter: Counter, stored=None):
        self.leaves, self.sums, self.size = leaves, sums, len(sums) // 2
        self.pattern, self.counter, self.stored = pattern, counter, stored
        self.encoded = self.read = 0

    @classmethod
    def of_text(cls, text: str, pattern: Pretokens, counter: Counter) -> DocumentTree:
        pieces = pattern(text)
        leaves = leaves_of(text, pieces, counter.of(pieces))
        return cls(leaves, sums_of(np.array([x.sums for x in leaves], np.int64).reshape(-1, 3)), pattern, counter)

    @property
    def characters(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def pretokens(self) -> int:
        return int(self.sums[1, 2])

    def leaf(self, i: int) -> Leaf:
        if i >= len(self.leaves):
            self.leaves += [Leaf() for _ in range(i + 1 - len(self.leaves))]
        if not isinstance(self.leaves[i], Leaf):
            self.leaves[i] = self.stored(self.leaves[i], int(self.sums[self.size + i, 2]))
            self.read += len(self.leaves[i].text)
        return self.leaves[i]

    def _find(self, place: int) -> tuple[int, int]:
        """Leaf that holds a character, and the leaf's first character."""
        node, first = 1, 0
        while node < self.size:
            node *= 2
            if place - first >= self.sums[node, 0]:
                first += int(self.sums[node, 0])
                node += 1
        return node - self.size, first

    def _update(self, i: int) -> None:
        node = i + self.size
        self.sums[node] = self.leaves[i].sums
        while node > 1:
            node //= 2
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def _old_text(self, place: int) -> Iterator[str]:
        """The text from a place on, a leaf at a time."""
        if place >= self.characters:
            return
        i, first = self._find(place)
        yield self.leaf(i).text[place - first :]
        for j in range(i + 1, len(self.leaves)):
            if self.sums[self.size + j, 0]:
                yield self.leaf(j).text

    def edit(self, start: int, delete: int, insert: str) -> None:
        """Replace ``delete`` characters at ``start`` (both clamped) by ``insert``."""
        n = self.characters
        start = min(max(0, start), n)
        stop = min(n, start + max(0, delete))
        shift = len(insert) - (stop - start)
        leaf = index = home = 0  # where the new pre-tokens begin; the empty document has one place
        if n:
            context = max(0, start - 2)
            leaf, home = self._find(context)
        at = home
        own = self.leaf(leaf)
        while n and at + own.lengths[index] <= context:
            at += own.lengths[index]
            index += 1
        first, kept, prefix = leaf, index, own.text[: at - home]
        text = ""
        for part in self._old_text(at) if start > at else ():
            text += part
            if len(text) >= start - at:
                break
        text = text[: start - at] + insert
        more = self._old_text(stop)
        ended = False
        old = place = at  # old boundary in old places, new boundary in new ones
        fresh: list[str] = []
        while True:
            if place >= start + len(insert):
                target = place - shift
                while old < target and leaf < len(self.leaves):
                    whole = self.sums[self.size + leaf]
                    if not index and old + whole[0] <= target:  # no need to open the leaf
                        old, leaf = old + int(whole[0]), leaf + 1
                    elif index < len(self.leaf(leaf).lengths):
                        old += self.leaves[leaf].lengths[index]
                        index += 1
                    else:
                        leaf, index = leaf + 1, 0
                if old == target:
                    break
            m = self.pattern.match(text, place - at)
            # a match is sure when two characters after it are known, or there are none
            while not ended and (m is None or m.end() + 1 >= len(text)):
                part = next(more, None)
                ended = part is None
                if part:
                    text += part
                    m = self.pattern.match(text, place - at)
            if not m:
                break
            fresh.append(m.group())
            place = m.end() + at
        self.encoded += len(fresh)
        if place == n + shift:  # all old pre-tokens from the first touched one are gone
            leaf, index = max(len(self.leaves), first + 1), 0
        last = self.leaf(leaf) if leaf < len(self.leaves) and (index or leaf == first) else None
        tail = Leaf()
        if last is not None:
            begin = sum(last.lengths[:index])
            tail = Leaf(last.text[begin:], last.lengths[index:], last.counts[index:])
        mine = Leaf(prefix + "".join(fresh), own.lengths[:kept] + [*map(len, fresh)], own.counts[:kept] + self.counter.of(fresh))
        if leaf == first:
            mine = Leaf(mine.text + tail.text, mine.lengths + tail.lengths, mine.counts + tail.counts)
        self.leaves[first] = mine
        for i in range(first + 1, min(leaf, len(self.leaves))):
            self.leaves[i] = Leaf()
            self._update(i)
        if last is not None and leaf > first:
            self.leaves[leaf] = tail
            self._update(leaf)
        if len(mine.lengths) > 4 * LEAF:
            self._split(first)
        else:
            self._update(first)

    def _split(self, i: int) -> None:
        """Cut a leaf that has grown; the others stay closed."""
        big, rows = self.leaves[i], self.sums[self.size : self.size + len(self.leaves)]
        parts, at = [], 0
        for cut in range(0, len(big.lengths), LEAF):
            lengths = big.lengths[cut : cut + LEAF]
            parts.append(Leaf(big.text[at : at + sum(lengths)], lengths, big.counts[cut : cut + LEAF]))
            at += sum(lengths)
        self.leaves[i : i + 1] = parts
        self.sums = sums_of(np.concatenate([rows[:i], [p.sums for p in parts], rows[i + 1 :]]))
        self.size = len(self.sums) // 2


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """Attach a table of edits (doc_id, seq, start, delete, insert) as ``edits``
    to documents or trees."""
    per = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "start", "delete", "insert"))).alias("e"))
    per = per.select("doc_id", F.transform("e", lambda x: F.struct(x["start"], x["delete"], x["insert"])).cast(EDITS).alias("edits"))
    return docs.join(per, "doc_id", "left")


def _nested(rows: list[list], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array([x for r in rows for x in r], kind))


def _packed_trees(trees: list[DocumentTree], stored: list[pa.Array] | None = None) -> list[pa.Array]:
    """The columns of TREE. Closed leaves are copied from ``stored`` unopened."""
    fresh: list[Leaf] = []
    where, ends, sums = [], [0], []
    base = len(stored[0]) if stored else 0
    for t in trees:
        if len(t.leaves) > t.size:  # leaves beyond the last one are empty
            del t.leaves[t.size :]
        for x in t.leaves:
            if isinstance(x, Leaf):
                where.append(base + len(fresh))
                fresh.append(x)
            else:
                where.append(x)
        ends.append(len(where))
        sums.append(t.sums.astype("<u4").tobytes())
    columns = [pa.array([x.text for x in fresh], pa.string()), pa.array([pack(x.lengths) for x in fresh], pa.binary()), pa.array([pack(x.counts) for x in fresh], pa.binary())]
    if stored:
        columns = [pa.concat_arrays([a, b]).take(pa.array(where, pa.int64())) for a, b in zip(stored, columns)]
    return [*(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), c) for c in columns), pa.array(sums, pa.binary())]


def build_trees(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """A tree for every whole text: doc_id, ``carry``, n_characters,
    n_pretokens, n_tokens and the columns of TREE. Null texts are empty."""
    shared = docs.sparkSession.sparkContext.broadcast((load(vocabulary_path), (pretoken_pattern(), pretoken_pattern(True))))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *carry)
    names = [c for c in rows.columns if c != "text"]
    schema = rows.drop("text").schema
    out = StructType([*schema, *StructType.fromDDL(f"n_characters long, n_pretokens long, n_tokens long, {TREE}")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, pattern = Counter.kept(shared.value[0]), Pretokens(*shared.value[1])
        for whole in batches:
            for cut in range(0, whole.num_rows, ROWS):
                batch = whole.slice(cut, ROWS)
                trees = [DocumentTree.of_text(t, pattern, counter) for t in batch.column("text").to_pylist()]
                counts = [pa.array([f(t) for t in trees], pa.int64()) for f in (lambda t: t.characters, lambda t: t.pretokens, lambda t: t.tokens)]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *counts, *_packed_trees(trees)], names=out.names)

    return rows.select(*names, "text").mapInArrow(run, out)


def apply_edits(trees: DataFrame, vocabulary_path: str, edits_col: str = "edits", keep_trees: bool = True) -> DataFrame:
    """Apply each row's edits to its tree.

    ``trees`` is of :func:`build_trees` (or of this function) with an array
    of EDITS. Only touched leaves are opened; n_read counts their characters.
    Returns doc_id, n_pretokens and n_tokens (as they were), n_edits,
    n_reencoded, n_pretokens_after, n_tokens_after, n_read and, with
    ``keep_trees``, n_characters and the updated columns of TREE.
    """
    shared = trees.sparkSession.sparkContext.broadcast((load(vocabulary_path), (pretoken_pattern(), pretoken_pattern(True))))
    tree = [c.split()[0] for c in TREE.split(", ")]
    rows = trees.select("doc_id", *tree, F.col(edits_col).cast(EDITS).alias("edits"))
    fields = "doc_id long, " + ", ".join(f"{n} long" for n in [*BEFORE, *AFTER, "n_read"])
    out = StructType.fromDDL(fields + f", n_characters long, {TREE}" * keep_trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, pattern = Counter.kept(shared.value[0]), Pretokens(*shared.value[1])
        for whole in batches:
            for cut in range(0, whole.num_rows, ROWS):
                batch = whole.slice(cut, ROWS)
                lists = [batch.column(c) for c in tree[:3]]
                starts = [x.offsets.to_numpy() for x in lists]
                flat = [x.values for x in lists]

                def stored(i: int, n: int, flat=flat) -> Leaf:
                    return Leaf(flat[0][i].as_py(), unpack(flat[1][i].as_py(), n), unpack(flat[2][i].as_py(), n))

                done, counts = [], []
                for row, (sums, edits) in enumerate(zip(batch.column("sums").to_pylist(), batch.column("edits").to_pylist())):
                    t = DocumentTree(list(range(starts[0][row], starts[0][row + 1])), np.frombuffer(sums, "<u4").reshape(-1, 3).astype(np.int64), pattern, counter, stored)
                    before = [t.pretokens, t.tokens]
                    for e in edits or ():
                        if e is not None:
                            t.edit(int(e["start"] or 0), int(e["delete"] or 0), e["insert"] or "")
                    counts.append([*before, len(edits or ()), t.encoded, t.pretokens, t.tokens, t.read, t.characters])
                    done.append(t)
                columns = [pa.array(c, pa.int64()) for c in (zip(*counts) if counts else [[]] * 8)]
                columns = [*columns, *_packed_trees(done, flat)] if keep_trees else columns[:-1]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=out.names)

    return rows.mapInArrow(run, out)


def edit_counts(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits", path: str | None = None
) -> DataFrame:
    """Token counts of every whole text, before and after its edits.

    ``edits`` is an array of (start, delete, insert), in characters of the
    text as it is then, applied in order; places outside are clamped, null
    members count as 0 or empty, a null array as none. The trees are written
    to ``path`` (a folder of their own under the checkpoint folder, if none is
    given), stay there, are read back and edited. Returns doc_id, n_pretokens, n_tokens,
    n_edits, n_reencoded (pre-tokens encoded again), n_pretokens_after,
    n_tokens_after. Null texts are empty; repeated rows give repeated rows;
    null ids stay null; an empty table gives no rows; other columns are
    ignored. Special tokens in texts are ordinary text.
    """
    spark = docs.sparkSession
    path = path or f"{shared_folder(spark)}/trees-{uuid.uuid4().hex}"
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(edits_col).cast(EDITS).alias("edits"))
    build_trees(named, vocabulary_path, carry=("edits",)).write.option("compression", "zstd").parquet(path)
    return apply_edits(spark.read.parquet(path), vocabulary_path, keep_trees=False).select("doc_id", *BEFORE, *AFTER)
