"""BPE encoding and decoding over a minimal acyclic transducer lexicon.

Frequent words of the corpus are encoded once on the driver and compiled into
a minimal acyclic automaton with shared prefixes and suffixes. Each arc
carries an output number; their sum along a word is its place in a table of
token ids. The automaton is one flat block of bytes, broadcast (its size is
bounded by ``lexicon_words``) and memory-mapped by each Python worker through
an anonymous memory file, so no local folder is written. A word that is not in
the lexicon is merged exactly, lowest rank first.
"""

from __future__ import annotations

import functools
import hashlib
import json
import mmap
import os
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemill.llm.common import IDS, checkpointed, documents, own_ids

LATIN_END = "\u0250"


def char_class(prop: str, below: int = 0x110000) -> str:
    """The inside of a regex class for ``prop`` as the tokenizer library's engine
    knows it (its Unicode version may differ from Python's)."""
    from tokenizers import Regex, pre_tokenizers

    every = "".join(chr(c) for c in range(below) if not 0xD800 <= c < 0xE000)
    runs = pre_tokenizers.Split(Regex(prop + "+"), "removed", invert=True).pre_tokenize_str(every)
    return "".join(f"\\U{ord(r[0]):08x}-\\U{ord(r[-1]):08x}" for r, _ in runs)


ROWS = 1_000  # texts handled at once
SIEVE = 1 << 20  # bits of the sieve before a lexicon
SHIFT = 20  # bits of a token id
MASK, NONE = (1 << SHIFT) - 1, 1 << 62
ODD_SPACE = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable letter for each byte, by the usual byte-level rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


def split_words(text: str) -> list[str]:
    """Stretches without Unicode white space; str.split() alone also splits at 1C-1F."""
    if ODD_SPACE.search(text):
        return [w for w in re.split("[^\\S\x1c-\x1f]+", text) if w]
    return text.split()


@functools.cache
def _normalizer():
    """NFC, then lower case of each character, by the library's Unicode version."""
    from tokenizers import normalizers

    return normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])


def normalized(word: str) -> str:
    if word.isascii() or max(word) < LATIN_END:  # such words are in NFC already
        return word.lower()
    return _normalizer().normalize_str(word)


@functools.cache
def classes(narrow: bool = False) -> dict[str, str]:
    """Insides of the classes that patterns name; ``narrow`` ones are for text
    below LATIN_END only, and much faster."""
    return {p: char_class(p, ord(LATIN_END) if narrow else 0x110000) for p in (r"\p{L}", r"\p{N}", r"\s")}


class Finder:
    """All pre-tokens of a text, by the narrow form of a pattern where it will do."""

    WIDE = re.compile(f"[^\\x00-{chr(ord(LATIN_END) - 1)}]").search

    def __init__(self, pattern: str, narrow: str):
        self.full, self.narrow = re.compile(pattern).findall, re.compile(narrow).findall

    def __call__(self, text: str) -> list[str]:
        return (self.full if self.WIDE(text) else self.narrow)(text)


def own_regex(pattern: str, narrow: bool = False) -> str:
    """A file's pre-token pattern for Python's engine: letters, digits and white
    space, which must stand in brackets, as the library knows them."""
    out, at, inside = [], 0, False
    while at < len(pattern):
        name = next((p for p in classes() if pattern.startswith(p, at)), None)
        if name is None and pattern[at] == "\\" or name is not None and not inside:
            raise ValueError(f"unsupported pre-token pattern: {pattern}")
        inside = pattern[at] == "[" or inside and pattern[at] != "]"
        out.append(classes(narrow)[name] if name else pattern[at])
        at += len(name or "x")
    return "".join(out)


# The steps before the merges that are understood here, as tokenizer files state them.
WORD_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def pretokens_of(data: dict) -> tuple[str, str | None]:
    """Kind of a tokenizer file (``words`` or ``bytes``) and its own pre-token pattern.

    ValueError for any other file: its ids would not be those of the library.
    """
    before, split = data.get("normalizer") or {}, data.get("pre_tokenizer") or {}
    plain = {"type": "ByteLevel", "add_prefix_space": False}
    byte_level = lambda x, regex: plain.items() <= x.items() and x.get("use_regex", True) is regex
    model, tokens = data["model"], data["added_tokens"]
    odd = [k for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
    odd += [t["content"] for t in tokens if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized")) or t["content"].split() != [t["content"]]]
    if model.get("type") != "BPE" or odd:
        raise ValueError(f"unsupported tokenizer file: {model.get('type')} {odd}")
    if not before and byte_level(split, True):
        return "bytes", None
    steps = split.get("pretokenizers", [])
    if before.get("normalizers") == WORD_STEPS and len(steps) == 2 and byte_level(steps[1], False):
        cut = steps[0]
        if cut.get("type") == "Split" and cut.get("behavior") == "Removed" and cut.get("invert") and "Regex" in cut["pattern"]:
            own_regex(cut["pattern"]["Regex"])
            return "words", cut["pattern"]["Regex"]
    raise ValueError("unsupported tokenizer file: normalizer or pre-tokenizer")


class Vocabulary:
    """Ranks and ids from a tokenizer file (byte letters; word ends may be marked)."""

    def __init__(self, data: dict):
        model = data["model"]
        self.kind, pattern = pretokens_of(data)
        self.patterns = (own_regex(pattern), own_regex(pattern, True)) if pattern else ()
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        # a pair of ids to its rank and the id it becomes, both in one number, so
        # that the least number is the next merge
        self.merges: dict[int, int] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merges[self.ids[a] << SHIFT | self.ids[b]] = rank << SHIFT | self.ids[a + b]
        letters = byte_letters()
        self.inner = [self.ids[c] for c in letters]
        self.last = [self.ids[c + self.end] for c in letters]
        self.mark = os.path.commonprefix([*self.special])  # what all specials begin with
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special))) + ")") if self.special else None

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def merge(self, pretoken: str) -> list[int]:
        """Exact merges of one pre-token: lowest rank first, leftmost first."""
        data = pretoken.encode()
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        get = self.merges.get
        best = [get(a << SHIFT | b, NONE) for a, b in zip(parts, parts[1:])]
        while best and (least := min(best)) < NONE:
            at = best.index(least)
            parts[at] = least & MASK
            del parts[at + 1], best[at]
            if at:
                best[at - 1] = get(parts[at - 1] << SHIFT | parts[at], NONE)
            if at < len(best):
                best[at] = get(parts[at] << SHIFT | parts[at + 1], NONE)
        return parts


def compile_lexicon(entries: dict[str, list[int]]) -> bytes:
    """Minimal acyclic transducer over UTF-8 words, as one block of bytes."""
    words = sorted((w.encode(), ids) for w, ids in entries.items())
    register: dict[tuple, int] = {}
    states: list[tuple] = []  # (final, ((label, target), ...)) by number
    path: list[list] = [[False, []]]  # unfinished states of the last word

    def finish(down_to: int) -> None:
        while len(path) > down_to + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            path[-1][1][-1] = (path[-1][1][-1][0], register[key])

    last = b""
    for word, _ in words:
        same = len(os.path.commonprefix([last, word]))
        finish(same)
        for b in word[same:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    finish(0)
    states.append((path[0][0], tuple(path[0][1])))
    count = []  # words below each state; targets are numbered before sources
    for final, arcs in states:
        count.append(final + sum(count[t] for _, t in arcs))
    first, labels, targets, outputs = [0], bytearray(), [], []
    for final, arcs in states:
        before = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            outputs.append(before)
            before += count[target]
        first.append(len(labels))
    finals = bytes(int(f) for f, _ in states)
    places, ids = [0], []
    for _, w in words:
        ids += w
        places.append(len(ids))
    number = lambda xs: struct.pack(f"<{len(xs)}I", *xs)
    sieve = bytearray(SIEVE // 8)
    for w, _ in words:
        h = zlib.crc32(w) & (SIEVE - 1)
        sieve[h >> 3] |= 1 << (h & 7)
    sections = [number(first), number(targets), number(outputs), number(places), number(ids), bytes(sieve), bytes(labels), finals]
    head, at = [], 4 * 9
    for s in sections:
        head.append(at)
        at += len(s)
    return struct.pack("<9I", *head, at) + b"".join(sections)


class Lexicon:
    """Read side of a compiled lexicon, on a memory map."""

    def __init__(self, block: bytes):
        fd = os.memfd_create("lexicon")
        try:
            os.truncate(fd, len(block))
            with os.fdopen(os.dup(fd), "wb") as f:
                f.write(block)
            self.map = mmap.mmap(fd, len(block), prot=mmap.PROT_READ)
        finally:
            os.close(fd)
        at = struct.unpack("<9I", self.map[:36])
        view = memoryview(self.map)
        self.first, self.targets, self.outputs, self.places, self.ids = (view[at[i] : at[i + 1]].cast("I") for i in range(5))
        self.sieve, self.labels, self.finals = view[at[5] : at[6]], at[6], view[at[7] : at[8]]
        self.root = len(self.finals) - 1

    def get(self, word: str) -> list[int] | None:
        data = word.encode()
        h = zlib.crc32(data) & (SIEVE - 1)
        if not self.sieve[h >> 3] >> (h & 7) & 1:
            return None  # most unseen words end here
        state, place, find, first, labels = self.root, 0, self.map.find, self.first, self.labels
        for i in range(len(data)):
            arc = find(data[i : i + 1], labels + first[state], labels + first[state + 1])
            if arc < 0:
                return None
            arc -= labels
            place += self.outputs[arc]
            state = self.targets[arc]
        return list(self.ids[self.places[place] : self.places[place + 1]]) if self.finals[state] else None


class Memo(dict):
    """A dict that fills itself; beyond a size it keeps what it used lately."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class Codec:
    """Encodes texts to ids and decodes ids; one per task."""

    def __init__(self, vocabulary: Vocabulary, block: bytes | None = None):
        self.vocabulary, self.lexicon = vocabulary, Lexicon(block) if block else None
        self.find = Finder(*vocabulary.patterns)
        self.decimal = [str(i) for i in range(max(vocabulary.tokens) + 1)]
        self.token = [vocabulary.tokens.get(i, "") for i in range(len(self.decimal))]
        #: words, and the pre-tokens they consist of, to ids in decimal and decoded text
        self.words = Memo(self._word, 220_000)
        self.hollow = False  # whether some word had no token

    def pretoken_ids(self, pretoken: str) -> list[int]:
        ids = self.lexicon.get(pretoken) if self.lexicon else None
        return self.vocabulary.merge(pretoken) if ids is None else ids

    def pieces(self, word: str) -> list[str | int]:
        """Pre-tokens and special ids of a stretch without white space."""
        v = self.vocabulary
        if not v.cut or v.mark not in word:
            return self.find(normalized(word))
        out: list[str | int] = []
        for part in v.cut.split(word):
            out += [v.special[part]] if part in v.special else self.find(normalized(part))
        return out

    def _word(self, word: str) -> tuple[str, str]:
        if word.isalpha() and (word.isascii() or max(word) < LATIN_END):
            found = [word.lower()]  # letters only: one pre-token
        else:
            found = self.pieces(word)
        if not found:
            self.hollow = True
            return "", ""
        if len(found) > 1 or found[0] != word:
            got = [(self.decimal[p], self.token[p]) if isinstance(p, int) else self.words[p] for p in found]
            return got[0] if len(got) == 1 else (" ".join([a for a, _ in got]), " ".join([b for _, b in got]))
        ids, decimal, token = self.pretoken_ids(word), self.decimal, self.token
        return " ".join([decimal[i] for i in ids]), " ".join([token[i] for i in ids])

    def encode(self, text: str) -> list[int]:
        pieces = (p for w in split_words(text) for p in self.pieces(w))
        return [i for p in pieces for i in ([p] if isinstance(p, int) else self.pretoken_ids(p))]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces: the file names no decoder. Unknown ids vanish."""
        tokens = self.vocabulary.tokens
        return " ".join([tokens[i] for i in ids if i in tokens])

    def both(self, text: str) -> tuple[str, str]:
        """The ids in decimal, joined by spaces, and the decoded text."""
        got = [*map(self.words.__getitem__, split_words(text))]
        if self.hollow:
            got = [g for g in got if g[0]]
        return " ".join([a for a, _ in got]), " ".join([b for _, b in got])


def count_words(docs: DataFrame) -> DataFrame:
    """word, n: counts over all texts, summed per task before the shuffle."""

    def packed(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                for text in whole.column("text").slice(at, ROWS).to_pylist():
                    seen.update(split_words(text))
                    if len(seen) > 300_000:
                        yield packed(seen)
                        seen.clear()
        if seen:
            yield packed(seen)

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, lexicon_words: int) -> bytes:
    """Compile the pre-tokens of the most frequent words.

    At most ``lexicon_words`` words reach the driver: all those as frequent as
    the least count (on a scale of 1/16 octave) that leaves no more. The
    choice affects speed, never ids.
    """
    words = checkpointed(count_words(docs).where("n > 1").withColumn("level", F.floor(16 * F.log2("n"))))
    levels = words.groupBy("level").count().orderBy(F.desc("level")).collect()  # some hundred rows
    least, total = None, 0
    for r in levels:
        total += r["count"]
        if total > lexicon_words:
            break
        least = r["level"]
    top = words.where(F.col("level") >= least).collect() if least is not None else []
    find = Finder(*vocabulary.patterns)
    pretokens = {p for r in top for p in find(normalized(r["word"]))}
    return compile_lexicon({p: vocabulary.merge(p) for p in pretokens})


def bpe_codec(
    docs: DataFrame, vocabulary_path: str, lexicon_words: int = 32_768, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """Encode and decode every whole text; one row per input row.

    Returns doc_id, n_tokens, ids_sha256 and decoded_sha256 (and ids
    array<int> and decoded string with ``keep_ids``). Null texts are empty:
    no tokens, digests of the empty text. Repeated rows give repeated rows;
    null ids stay null; an empty table gives no rows; other columns are
    ignored. The vocabulary file is read on the driver only; its pattern and
    special tokens are its own, and a file of another kind is refused.
    """
    rows = documents(docs, id_col, text_col)
    vocabulary = Vocabulary.load(vocabulary_path)
    if vocabulary.kind != "words":
        raise ValueError("the codec needs a file that splits words")
    shared = rows.sparkSession.sparkContext.broadcast((vocabulary, build_lexicon(rows, vocabulary, lexicon_words)))
    schema = StructType.fromDDL(f"{IDS}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):  # few texts at once are Python strings
                batch = whole.slice(at, ROWS)
                done = [codec.both(text) for text in batch.column("text").to_pylist()]
                columns = [
                    batch.column("doc_id"), batch.column("no_id"), pa.array([ids.count(" ") + 1 if ids else 0 for ids, _ in done], pa.int64()),
                    pa.array([digest(ids) for ids, _ in done], pa.string()), pa.array([digest(text) for _, text in done], pa.string()),
                ]
                if keep_ids:
                    columns += [pa.array([[*map(int, ids.split())] for ids, _ in done], pa.list_(pa.int32())), pa.array([text for _, text in done], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return own_ids(rows.mapInArrow(run, schema))
