"""Counts over texts in Arrow batches: array operations over the characters of many
texts at once, where a regular expression each would read every text again.

Texts of a chunk are joined by line feeds, which end every pattern counted here.
Word boundaries are those of Java's ``\\b``: letters and digits of any script,
``_``, and combining marks after a letter or digit.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 4_000_000  # characters handled at once, and one text at least
LOWER, UPPER, DIGIT, ALNUM, MARK, RISES, FALLS, KNOWN = (1 << i for i in range(8))  # RISES, FALLS: changed by upper(), lower()


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class bits by code point, filled as code points are met."""
    return np.zeros(0x110000, np.uint8)


def _class_of(code: int) -> int:
    c = chr(code)
    kind = unicodedata.category(c)
    bits = {LOWER: "a" <= c <= "z", UPPER: "A" <= c <= "Z", DIGIT: "0" <= c <= "9", ALNUM: kind in ("Lu", "Ll", "Lt", "Lm", "Lo", "Nd"), MARK: kind == "Mn", RISES: c.upper() != c, FALLS: c.lower() != c}
    return KNOWN | sum(b for b, holds in bits.items() if holds)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last positions of the runs of true (the last place is false)."""
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if mask[0]:
        edge = np.concatenate(([0], edge))
    return edge[::2], edge[1::2] - 1


class Chunk:
    """Some texts as one array of code points, each text followed by a line feed."""

    def __init__(self, texts: list[str]):
        whole = "\n".join(texts) + "\n\n\n\n"  # room to look ahead
        self.texts, self.whole = texts, whole
        self.codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        table = _classes()
        self.classes = table[self.codes]
        if (new := self.classes == 0).any():
            for code in np.unique(self.codes[new]).tolist():
                table[code] = _class_of(code)
            self.classes = table[self.codes]

    def has(self, bits: int) -> np.ndarray:
        return (self.classes & bits) != 0

    def lowered(self) -> Chunk:
        """This chunk, for counts of the lower-case text: beyond A-Z two characters fall to a-z."""
        if "\u0130" not in self.whole and "\u212a" not in self.whole:
            return self
        return Chunk([t.replace("\u0130", "i\u0307").replace("\u212a", "k") for t in self.texts])

    def letters(self) -> np.ndarray:
        """The code points as bytes, A-Z lowered (meant for ASCII ones only)."""
        return self.codes.astype(np.uint8) + (self.has(UPPER).view(np.uint8) << 5)

    def per_text(self, at: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """How many of the ascending positions lie in each text, or the sum of their weights."""
        cuts = np.searchsorted(at, self.ends)
        if weights is not None:
            cuts = np.concatenate(([0], np.cumsum(weights)))[cuts]
        return np.diff(cuts, prepend=0)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        r"""Runs of characters between two \b."""
        word, mark = self.has(ALNUM), self.has(MARK)
        if mark.any():
            base = np.maximum.accumulate(np.where(mark, 0, np.arange(len(mark))))
            word = word | (mark & word[base])
        return runs(word | (self.codes == ord("_")))

    def tokens(self) -> tuple[np.ndarray, pa.StringArray]:
        """Positions and texts of the runs of a-z and apostrophes; for a lowered chunk."""
        mask = self.has(LOWER | UPPER) | (self.codes == ord("'"))
        first, last = runs(mask)
        offsets = np.concatenate(([0], np.cumsum(last - first + 1))).astype(np.int32)
        return first, pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(self.letters()[mask]))


def _within(mask: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that counts the places of the mask after ``first`` up to ``last``."""
    sums = np.cumsum(mask, dtype=np.int32)
    return lambda first, last: sums[last] - sums[first]


def _ends(c: Chunk, last: np.ndarray) -> np.ndarray:
    """The four bytes up to each place as one number."""
    low = c.letters()
    out = np.zeros(len(last), np.uint32)
    for back in range(4):
        out |= low[np.maximum(last - back, 0)].astype(np.uint32) << (8 * back)
    return out


def _is(word: str) -> tuple[int, int]:
    """Mask and value of a word of four letters at most, among the last four bytes."""
    return (1 << 8 * len(word)) - 1, int.from_bytes(word.encode(), "big")


def chunks(texts: pa.Array) -> Iterator[Chunk]:
    part, n = [], 0
    for text in texts.to_pylist():
        if part and n + len(text or "") > CHUNK:
            yield Chunk(part)
            part, n = [], 0
        part.append(text or "")
        n += len(part[-1])
    if part:
        yield Chunk(part)


def counter(count: Callable[[Chunk], list[np.ndarray]], longs: list[str], doubles: list[str] = ()) -> Callable[[Column], Column]:
    """A function of a text column that appends a struct of counts (and sums)."""
    names = [*longs, *doubles]
    types = [pa.int64()] * len(longs) + [pa.float64()] * len(doubles)

    def run(texts: pa.Array) -> pa.Array:
        got = [count(c) for c in chunks(texts)]
        columns = [np.concatenate([g[i] for g in got]) if got else np.zeros(0) for i in range(len(names))]
        return pa.StructArray.from_arrays([pa.array(x.astype(t.to_pandas_dtype())) for x, t in zip(columns, types)], names)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, ", ".join([f"`{n}` long" for n in longs] + [f"`{n}` double" for n in doubles]))


def linguistic(c: Chunk, negations: pa.Array) -> list[np.ndarray]:
    """Sentences, capital words, negations and distinct words of cleaned texts."""
    break_ = c.codes == ord("\n")
    unfinished, _ = runs(~((c.codes == ord(".")) | (c.codes == ord("!")) | (c.codes == ord("?")) | break_))
    first, last = runs(~((c.codes == ord(" ")) | break_))
    few = (last > first) & ((c.classes[first] & RISES) == 0)
    first, last = first[few], last[few]
    capital = (_within(c.has(RISES))(first, last) == 0) & (_within(c.has(FALLS))(first, last) + ((c.classes[first] & FALLS) != 0) > 0)
    low = c.lowered()
    at, token = low.tokens()
    negation = at[pc.is_in(token, value_set=negations).to_numpy(zero_copy_only=False)]
    kinds = np.fromiter((len(set(t.split(" "))) if t else 0 for t in c.texts), np.int64, len(c.texts))
    return [np.maximum(c.per_text(unfinished), 1), c.per_text(first[capital]), low.per_text(negation), kinds]


def entities(c: Chunk) -> list[np.ndarray]:
    r"""Counts of \b[A-Z][a-z]+ [A-Z][a-z]+\b, \b(?:in|at|near|from) [A-Z][a-z]+ and \b[A-Z][A-Za-z]*[0-9]+\b."""
    first, last = c.words()
    lower, upper, digit = c.has(LOWER), c.has(UPPER), c.has(DIGIT)
    after = c.codes[last + 1] == ord(" ")
    n, lowers = last - first, _within(lower)(first, last)
    # pairs: a row of k capitalised words one space apart holds k // 2
    name = upper[first] & (n > 0) & (lowers == n)
    linked = np.zeros(len(first) + 1, bool)
    if len(first):
        linked[:-2] = name[:-1] & name[1:] & after[:-1] & (first[1:] == last[:-1] + 2)
    a, b = runs(linked)
    pairs = c.per_text(first[a], (b - a + 2) // 2)
    # places: the preposition is a whole word
    tail, small = _ends(c, last), lower[first] & (lowers == n)
    preposition = np.zeros(len(first), bool)
    for word in ("in", "at", "near", "from"):
        mask, value = _is(word)
        preposition |= (n == len(word) - 1) & ((tail & np.uint32(mask)) == value)
    place = preposition & small & after & upper[last + 2] & lower[last + 3]
    # products: letters, then digits, to the end of the word
    some = upper[first] & digit[last]
    s, e = first[some], last[some]
    letters = _within(lower | upper)
    turn = s + letters(s, e)  # the last letter, if letters come first
    product = (letters(s, turn) == turn - s) & (_within(digit)(turn, e) == e - turn)
    return [pairs, c.per_text(first[place]), c.per_text(s[product])]


def endings(c: Chunk, kinds: list[list[str]]) -> list[np.ndarray]:
    r"""Words ``\S+``, and of each kind how many words of a-z have a letter and one of the endings."""
    gap = (c.codes == ord(" ")) | ((c.codes >= 9) & (c.codes <= 13))
    out = [c.per_text(runs(~gap)[0])]
    low = c.lowered()
    first, last = low.words()
    az = low.has(LOWER | UPPER)
    pure = az[first] & (_within(az)(first, last) == last - first) & (last > first)
    first, last = first[pure], last[pure]
    n, tail = last - first + 1, _ends(low, last)
    for kind in kinds:
        hit = np.zeros(len(first), bool)
        for ending in kind:
            mask, value = _is(ending)
            hit |= (n > len(ending)) & ((tail & np.uint32(mask)) == value)
        out.append(low.per_text(first[hit]))
    return out


def lexicon_sums(c: Chunk, terms: pa.Array, values: np.ndarray) -> list[np.ndarray]:
    """Tokens of each text, and the sums of each row of ``values`` (one column a term) over them."""
    c = c.lowered()
    at, token = c.tokens()
    ids = pc.fill_null(pc.index_in(token, value_set=terms), -1).to_numpy(zero_copy_only=False)
    met = ids >= 0
    n, ids = c.per_text(at[met]), ids[met]
    some = n > 0
    starts = (np.cumsum(n) - n)[some]
    out = [c.per_text(at)]
    for row in values:
        sums = np.zeros(len(n))
        if len(starts):
            sums[some] = np.add.reduceat(row[ids], starts)
        out.append(sums)
    return out


def distinct_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over one text column: distinct tokens of each chunk."""
    for batch in batches:
        for c in chunks(batch.column(0)):
            yield pa.RecordBatch.from_arrays([c.lowered().tokens()[1].unique()], ["term"])
