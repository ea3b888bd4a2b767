"""Language-model scores by a hierarchical Pitman-Yor model.

Every word that comes before another has a context restaurant; all of them
share one parent, the root restaurant over single words, whose base is uniform
over the vocabulary and one unknown word. Customers of a context restaurant
are the tokens seen after its word; each of its tables sends one customer to
the root, where customers sit at tables likewise.

Seating is sampled by Gibbs, in sweeps. In a sweep every dish of the context
restaurants redraws its number of tables given the other tables of its
restaurant and the root's probability of the dish, both as the sweep before
left them (that conditional has a closed form with generalised Stirling
numbers); the new tables are the root's customers, whose dishes are then
redrawn the same way. A text's probability uses the average of the predictive
probabilities of the sweeps after the first few.

One model, whatever the layout: a draw is a hash of the context, the word and
the sweep, counts are integers and the totals of restaurants and of the root
are exact, so neither shards nor buckets nor hot contexts alter a score.

Layout: documents are packed into shards. A shard sends each distinct
(context, word) pair once, with its training count, to the bucket of the
context. A bucket merges its pairs and keeps those that can change (pairs seen
twice or more; a pair seen once has one table). One in ``ROOT_SPAN`` buckets
is a root too, of the words that hash to that span. A sweep is one message from each bucket to
each root (tables of the words they share) and one back (customers and tables at
the root), as packed arrays of small numbers in an order fixed once.
Contexts that hold over a thousandth of a bounded sample of tokens are spread
over the buckets of ``HOT_PARTS`` parts by word, and their tables are summed
with every sweep.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import (
    IDS, M1, M2, WordHash, ascii_lower_words, bucket_of, checkpointed, crc_mod, cut_by_bucket, documents, mix, own_id, own_ids, pack_planes, pack_sorted,
    partitions, unpack_planes, unpack_sorted,
)

START = np.uint64(0x5354415254)  # context of a text's first word
END = np.uint64(0xFFFFFFFF00454E44)  # the end token
HOT_PARTS = 64
HOT_SAMPLE = 2_000  # documents looked at to find hot contexts
STIRLING = 64
SWEEPS, BURN_IN = 5, 2
SAMPLES = SWEEPS - BURN_IN
ROOT_SPAN = 8  # buckets whose words one root task holds
DISH_BYTES = 5  # a dish is named by the upper 40 bits of its word's hash
SIDE = np.uint64(64 - 8 * DISH_BYTES)
LOW32 = np.uint64(0xFFFFFFFF)


class Prior:
    """Discounts and strengths of the context restaurants and of the root."""

    d, theta = 0.8, 1.0
    d_root, theta_root = 0.75, 100.0


def log_stirling(d: float, most: int = STIRLING) -> np.ndarray:
    """log of generalised Stirling numbers S(c, t), c and t from 0 to ``most``."""
    out = np.full((most + 1, most + 2), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, most + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(1, most):
            stay = np.where(t <= c, np.log(np.maximum(c - d * t, 1e-300)) + out[c, 1:-1], -np.inf)
            out[c + 1, 1:-1] = np.logaddexp(out[c, :-2], stay)
    return out


def uniform(keys: np.ndarray, sweep: int, step: int) -> np.ndarray:
    """One number in (0, 1] for each key: what is drawn depends on nothing else."""
    x = mix(keys + np.uint64((sweep << 32 | step) * int(M2) % 2**64))
    return ((mix(x ^ (x >> np.uint64(32))) >> np.uint64(11)) + np.uint64(1)) * 2.0**-53


def seat(c: np.ndarray, others: np.ndarray, parent: np.ndarray, d: float, theta: float, table: np.ndarray, draw) -> np.ndarray:
    """Draw the number of tables of dishes with ``c`` customers.

    ``others`` are the tables of other dishes in the restaurant, ``parent`` the
    parent's probability of the dish, and ``draw(rows, step)`` gives uniform
    numbers for some of the dishes. Up to STIRLING customers the draw is
    from the exact conditional; larger dishes are seated one customer after
    another, skipping from one new table to the next.
    """
    t = np.minimum(c, 1).astype(np.int64)
    for n in np.unique(c[(c > 1) & (c <= STIRLING)]).tolist():
        at = np.nonzero(c == n)[0]
        for cut in range(0, len(at), 200_000 // n + 1):
            rows = at[cut : cut + 200_000 // n + 1]
            k = np.arange(n)
            weight = np.cumsum(np.log((theta + d * (others[rows, None] + k)) * parent[rows, None]), axis=1) + table[n, 1 : n + 1]
            weight = np.exp(weight - weight.max(axis=1, keepdims=True))
            total = np.cumsum(weight, axis=1)
            t[rows] = 1 + (total < draw(rows, 0)[:, None] * total[:, -1:]).sum(axis=1)
    at = np.nonzero(c > STIRLING)[0]
    tables = np.ones(len(at), np.int64)
    for j in range(1, STIRLING):  # the first customers one by one
        a = (theta + d * (others[at] + tables)) * parent[at]
        tables += draw(at, j) * (a + j - d * tables) < a
    seated, step = np.full(len(at), float(STIRLING)), STIRLING
    while len(at):
        a = (theta + d * (others[at] + tables)) * parent[at]
        shift = (a - 1) / 2 - d * tables
        with np.errstate(over="ignore"):
            seated = np.maximum(np.ceil((np.maximum(seated + shift, 1e-9)) * draw(at, step) ** (-1 / a) - shift), seated + 1)
        step += 1
        done = ~(seated <= c[at])
        t[at[done]] = tables[done]
        at, seated, tables = at[~done], seated[~done], tables[~done] + 1
    return t


class Shard:
    """One shard's tokens: words, contexts and distinct pairs, in sorted order."""

    def __init__(self, texts: list[str], held_out: np.ndarray, hot: np.ndarray):
        memo = WordHash()
        runs = [memo.of(ascii_lower_words(t)) for t in texts]
        self.sizes = np.array([len(r) + 1 for r in runs], np.int64)
        ends = np.cumsum(self.sizes) - 1
        token = np.empty(int(self.sizes.sum()), np.uint64)
        inside = np.ones(len(token), bool)
        inside[ends] = False
        token[inside] = np.concatenate(runs) if runs else []
        token[ends] = END
        train = np.repeat(~held_out, self.sizes)
        self.words, self.word = np.unique(token, return_inverse=True)
        self.word_counts = np.bincount(self.word[train], minlength=len(self.words))
        # contexts are numbered by the word before, then by hot context and part
        n = len(self.words)
        before = np.empty(len(token), np.int64)
        before[1:] = self.word[:-1]
        before[np.concatenate([[0], ends[:-1] + 1])] = n  # the start of a text
        names = np.append(self.words, START)
        place = np.minimum(np.searchsorted(hot, names), len(hot) - 1)
        warm = np.where(hot[place] == names, place, -1)
        split = np.nonzero(warm[before] >= 0)[0]
        code = before.copy()
        code[split] = n + 1 + warm[before[split]] * HOT_PARTS + (token[split] >> SIDE).astype(np.int64) % HOT_PARTS
        codes = np.nonzero(np.bincount(code, minlength=n + 1 + len(hot) * HOT_PARTS))[0]
        keys = np.concatenate([names, part_names(hot).ravel()])[codes]
        order = np.argsort(keys)
        self.contexts, rank = keys[order], np.empty(n + 1 + len(hot) * HOT_PARTS, np.int64)
        rank[codes[order]] = np.arange(len(codes))
        # each context's word (the start has as many customers as the end), and its number if hot
        origin = np.where(codes > n, np.searchsorted(names[:n], hot[np.maximum(codes - n - 1, 0) // HOT_PARTS]), codes)[order]
        self.hot = np.where(codes > n, (codes - n - 1) // HOT_PARTS, -1)[order]
        start = (origin == n) | ((self.hot >= 0) & (hot[np.maximum(self.hot, 0)] == START))
        self.before = np.where(start, np.searchsorted(self.words, END), np.minimum(origin, n - 1))
        self.pairs, self.pair = np.unique(rank[code].astype(np.uint64) << np.uint64(32) | self.word.astype(np.uint64), return_inverse=True)
        self.pair_counts = np.bincount(self.pair[train], minlength=len(self.pairs))
        self.home, self.what = (self.pairs >> np.uint64(32)).astype(np.int64), (self.pairs & LOW32).astype(np.int64)


def hot_contexts(docs: DataFrame, share: float = 1e-3) -> np.ndarray:
    """Words over ``share`` of the tokens of a bounded sample (at most 1 / share
    words), and the start. The layout depends on it, scores do not."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHash()
        for batch in batches:
            h = [memo.of(ascii_lower_words(t)) for t in batch["text"]]
            key, n = np.unique(np.concatenate(h), return_counts=True)
            yield pd.DataFrame({"h": key.view(np.int64), "n": n})

    sample = docs.orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").limit(HOT_SAMPLE)
    counts = docs.join(F.broadcast(sample.distinct()), "doc_id").select("text").mapInPandas(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    counts = checkpointed(counts)  # the words of the sample
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") > share * total).collect()
    return np.unique(np.append(np.array([r.h for r in hot], np.int64).view(np.uint64), START))


def cut_by_root(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of each root's words in sorted keys."""
    return np.append(cut_by_bucket(keys, buckets)[:-1:ROOT_SPAN], len(keys))


def root_of(key: np.ndarray, buckets: int) -> int:
    return int(bucket_of(key, buckets)[0]) // ROOT_SPAN


def part_names(hot: np.ndarray) -> np.ndarray:
    """Names of the parts of hot contexts: a row for each."""
    return mix(hot[:, None] + (np.arange(HOT_PARTS, dtype=np.uint64) + np.uint64(1)) * M2)


# One shape for all messages; what a field holds depends on the kind. ``to`` is a bucket, or
# a shard in the last exchange; ``source`` is the shard or bucket it comes from.
FIELDS = "to int, kind int, source int, a binary, b binary, c binary, d binary, e binary, f binary"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]
SENT, MULTI, SHARED, HOT, STATE, TABLES, ROOT, REPLY, SEATED, TOP = range(10)


def message(to: int, kind: int, source: int, a=b"", b=b"", c=b"", d=b"", e=b"", f=b"") -> tuple:
    return (to, kind, source, a, b, c, d, e, f)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=NAMES)


def _ints(x: np.ndarray) -> bytes:
    """Small numbers, packed by planes and compressed."""
    return zstandard.ZstdCompressor(level=1).compress(pack_planes(x.astype("<u4")))


def _uints(data: bytes) -> np.ndarray:
    return unpack_planes(zstandard.ZstdDecompressor().decompress(data), "<u4").astype(np.int64)


def _rows_of(lists: list[np.ndarray]) -> bytes:
    """Several lists of one length, each as differences from the one before."""
    out = [x - y for x, y in zip(lists, [0, *lists])]
    return _ints(np.concatenate(out)) if out else b""


def _lists_of(data: bytes, n: int) -> list[np.ndarray]:
    flat = _uints(data).astype("<u4").reshape(n, -1)
    return [x.astype(np.int64) for x in np.cumsum(flat, axis=0, dtype="<u4")]


def _dishes(x: np.ndarray) -> bytes:
    """Upper bytes as byte planes."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - DISH_BYTES :].T.tobytes()


def _undishes(data: bytes) -> np.ndarray:
    n = len(data) // DISH_BYTES
    out = np.zeros((n, 8), np.uint8)
    out[:, 8 - DISH_BYTES :] = np.frombuffer(data, np.uint8).reshape(DISH_BYTES, n).T
    return out.view("<u8").ravel().astype(np.uint64)


def _join(xs: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(xs) if len(xs) else np.zeros(0, kind)


def _pick(rows: pd.DataFrame, kind: int) -> pd.DataFrame:
    return rows[rows["kind"] == kind].sort_values("source")


class Merged:
    """What a bucket's shards have sent: its restaurants and its words."""

    def __init__(self, sent: pd.DataFrame):
        self.sources = sent["source"].tolist()
        self.contexts = [unpack_sorted(k) for k in sent["a"]]
        self.sizes = [_uints(s) for s in sent["b"]]
        dish = _join([_undishes(d) for d in sent["c"]], np.uint64)
        count = _join([_uints(c) for c in sent["d"]], np.int64)
        self.restaurants, number = np.unique(_join(self.contexts, np.uint64), return_inverse=True)
        number = np.repeat(number, _join(self.sizes, np.int64))
        self.dishes, dish = np.unique(dish, return_inverse=True)
        pairs, self.pair = np.unique(number.astype(np.uint64) << np.uint64(32) | dish.astype(np.uint64), return_inverse=True)
        self.c = np.bincount(self.pair, weights=count, minlength=len(pairs)).astype(np.int64)
        self.home, self.what = (pairs >> np.uint64(32)).astype(np.int64), (pairs & LOW32).astype(np.int64)
        self.lists = [unpack_sorted(k) for k in sent["e"]]
        self.words, self.word = np.unique(_join(self.lists, np.uint64), return_inverse=True)
        counts = _join([_uints(c) for c in sent["f"]], np.int64)
        self.word_counts = np.bincount(self.word, weights=counts, minlength=len(self.words)).astype(np.int64)


def _layout(m: Merged, bucket: int, buckets: int, parts: np.ndarray, hot: np.ndarray) -> list[tuple]:
    """What sweeps need of a bucket: pairs that can change, tables that cannot,
    and the words shared with each root bucket."""
    changing, once = np.nonzero(m.c > 1)[0], m.c == 1
    singles = np.bincount(m.home[once], minlength=len(m.restaurants))
    rooms, size = np.unique(m.home[changing], return_counts=True)
    out = [message(bucket, MULTI, bucket, pack_sorted(m.restaurants[rooms]), _ints(size), _dishes(m.dishes[m.what[changing]]), _ints(m.c[changing]), _ints(singles[rooms]))]
    fixed = np.bincount(m.what[once], minlength=len(m.dishes))
    moves = np.zeros(len(m.dishes), bool)
    moves[m.what[changing]] = True
    used = moves | (fixed > 0)
    names, fixed, moves = m.dishes[used], fixed[used], moves[used]
    totals = np.array([m.word_counts.sum(), (m.word_counts > 0).sum()], "<i8").tobytes()
    ends = cut_by_root(names, buckets)
    for r, (lo, hi) in enumerate(zip(ends, ends[1:])):
        out.append(message(r, SHARED, bucket, pack_sorted(names[lo:hi] >> SIDE), _ints(fixed[lo:hi]), np.packbits(moves[lo:hi]).tobytes(), f=totals))
    for u in np.nonzero(np.isin(parts, m.restaurants).any(axis=1))[0]:
        n = int(singles[np.isin(m.restaurants, parts[u])].sum())
        out.append(message(root_of(hot[u : u + 1], buckets), HOT, bucket, hot[u : u + 1].tobytes(), np.int64(n).tobytes()))
    return out


class Changing:
    """The pairs of a bucket whose tables are redrawn."""

    def __init__(self, fixed: pd.DataFrame, parts: np.ndarray, hot: np.ndarray):
        row = _pick(fixed, MULTI)
        self.restaurants = unpack_sorted(row["a"].iat[0]) if len(row) else np.zeros(0, np.uint64)
        size = _uints(row["b"].iat[0]) if len(row) else np.zeros(0, np.int64)
        self.home = np.repeat(np.arange(len(size)), size)
        self.dish = _undishes(row["c"].iat[0]) if len(row) else np.zeros(0, np.uint64)
        self.c = _uints(row["d"].iat[0]) if len(row) else np.zeros(0, np.int64)
        self.singles = _uints(row["e"].iat[0]) if len(row) else np.zeros(0, np.int64)
        flat = parts.ravel()
        order = np.argsort(flat)
        at = np.minimum(np.searchsorted(flat[order], self.restaurants), len(flat) - 1)
        split = flat[order][at] == self.restaurants
        self.hot = np.where(split, order[at] // HOT_PARTS, -1)  # number of the hot context, or -1
        names = np.where(split, hot[np.maximum(self.hot, 0)], self.restaurants)
        self.keys = mix(names[self.home] * M1 + (self.dish >> SIDE) * M2 + np.uint64(1))
        self.names, self.name = np.unique(self.dish, return_inverse=True)

    def tables_of(self, t: np.ndarray) -> np.ndarray:
        """Tables of each restaurant here (of hot ones, the part's that change)."""
        return np.bincount(self.home, weights=t, minlength=len(self.restaurants)).astype(np.int64) + np.where(self.hot < 0, self.singles, 0)


def _root_value(customers, tables, totals: np.ndarray):
    """Probability of a word at the root. ``totals``: tokens, words, customers, tables."""
    p = Prior
    back = (p.theta_root + p.d_root * totals[3]) / (p.theta_root + totals[2]) / (totals[1] + 1)
    return (customers - p.d_root * tables) / (p.theta_root + totals[2]) + back


def _sweep_contexts(fixed: pd.DataFrame, got: pd.DataFrame | None, bucket: int, buckets: int, sweep: int, parts: np.ndarray, hot: np.ndarray) -> list[tuple]:
    """Redraw a bucket's tables (sweep 0 sets one for each pair) and send them to the roots."""
    x = Changing(fixed, parts, hot)
    history, totals = [], np.zeros(4)
    if sweep == 0:
        t, summed = np.ones(len(x.c), np.int64), np.zeros(len(x.c), np.int64)
    else:
        replies = _pick(got, REPLY)
        totals = np.sum([np.frombuffer(f, "<f8") for f in replies["f"]], axis=0)
        state = _pick(got, STATE)
        t, summed = (_uints(state[k].iat[0]) for k in "ab") if len(state) else (np.zeros(0, np.int64),) * 2
        history = _lists_of(state["c"].iat[0], max(0, sweep - 1 - BURN_IN)) if len(state) and sweep - 1 > BURN_IN else []
        customers, tables = (_join([_uints(v) for v in replies[k]], np.int64) for k in "ab")
        parent = _root_value(customers, tables, totals)[x.name]
        whole = x.tables_of(t)
        for _, row in _pick(got, HOT).iterrows():
            whole[x.hot == np.searchsorted(hot, np.frombuffer(row["a"], np.uint64)[0])] = np.frombuffer(row["b"], np.int64)[0]
        others = np.maximum(whole[x.home] - t, 0)
        t = seat(x.c, others, parent, Prior.d, Prior.theta, log_stirling(Prior.d), lambda rows, step: uniform(x.keys[rows], sweep, step))
        if sweep > BURN_IN:
            summed = summed + t - 1
            history = [*history, x.tables_of(t)]
    out = [message(bucket, STATE, bucket, _ints(t), _ints(summed), _rows_of(history))]
    sums = np.bincount(x.name, weights=t, minlength=len(x.names)).astype(np.int64)
    ends = cut_by_root(x.names, buckets)
    out += [message(r, TABLES, bucket, _ints(sums[lo:hi]), f=totals.tobytes()) for r, (lo, hi) in enumerate(zip(ends, ends[1:]))]
    whole = x.tables_of(t)
    for u in np.unique(x.hot[x.hot >= 0]).tolist():
        n = np.int64(whole[x.hot == u].sum())
        out.append(message(root_of(hot[u : u + 1], buckets), HOT, bucket, hot[u : u + 1].tobytes(), n.tobytes()))
    return out


def _sweep_root(fixed: pd.DataFrame, got: pd.DataFrame, bucket: int, buckets: int, sweep: int, parts: np.ndarray, hot: np.ndarray) -> list[tuple]:
    """Redraw a root's tables (sweep 0 sets one for each word) and answer all buckets."""
    passed = [message(*r) for r in _pick(got, STATE)[NAMES].itertuples(index=False)]
    if bucket > (buckets - 1) // ROOT_SPAN:
        return passed
    shared, sent = _pick(fixed, SHARED), _pick(got, TABLES)
    lists = [unpack_sorted(a) << SIDE for a in shared["a"]]
    moves = [np.unpackbits(np.frombuffer(c, np.uint8), count=len(k)).astype(bool) for c, k in zip(shared["c"], lists)]
    new = dict(zip(sent["source"], sent["a"]))
    names, name = np.unique(_join(lists, np.uint64), return_inverse=True)
    each = []
    for source, still, move in zip(shared["source"], shared["b"], moves):
        tables = _uints(still)
        if source in new:
            tables[move] += _uints(new[source])
        each.append(tables)
    customers = np.bincount(name, weights=_join(each, np.int64), minlength=len(names)).astype(np.int64)
    n, v = np.sum([np.frombuffer(f, "<i8") for f in shared["f"]], axis=0) if len(shared) else (0, 0)
    state, history = _pick(got, ROOT), []
    if sweep == 0:
        t = np.ones(len(names), np.int64)
    else:
        before = np.frombuffer(sent["f"].iat[0], "<f8")[3]
        t = _uints(state["a"].iat[0])
        history = _lists_of(state["b"].iat[0], 2 * (sweep - 1 - BURN_IN)) if sweep - 1 > BURN_IN else []
        keys = mix((names >> SIDE) * M1 + np.uint64(2))
        base = np.full(len(names), 1 / (v + 1))
        t = seat(customers, np.maximum(before - t, 0), base, Prior.d_root, Prior.theta_root, log_stirling(Prior.d_root), lambda rows, step: uniform(keys[rows], sweep, step))
        if sweep > BURN_IN:
            history = [*history, customers, t]
    # tokens and words of the whole corpus are known here, so one bucket tells them
    totals = np.array([n if bucket == 0 else 0, v if bucket == 0 else 0, customers.sum(), t.sum()], "<f8")
    kept = [*(_totals_of(state) if len(state) else []), totals] if sweep > BURN_IN else []
    if sweep < SWEEPS:
        out = [message(bucket, ROOT, bucket, _ints(t), _rows_of(history), d=np.concatenate(kept).tobytes() if kept else b"")]
        starts = np.concatenate([[0], np.cumsum([len(k) for k in lists])]).astype(int)
        asked = {int(s): name[a:b][m] for s, a, b, m in zip(shared["source"], starts, starts[1:], moves)}
        none = np.zeros(0, np.int64)
        for b in range(buckets):
            at = asked.get(b, none)
            out.append(message(b, REPLY, bucket, _ints(customers[at]), _ints(t[at]), f=totals.tobytes()))
    else:  # to each bucket its own words
        ends = cut_by_bucket(names, buckets)
        kept = np.concatenate(kept).tobytes()
        span = range(ROOT_SPAN * bucket, min(buckets, ROOT_SPAN * (bucket + 1)))
        out = [message(b, ROOT, bucket, b=_rows_of([x[ends[b] : ends[b + 1]] for x in history]), c=pack_sorted(names[ends[b] : ends[b + 1]] >> SIDE), d=kept if b == span[0] else b"") for b in span]
    return out + passed + _hot_totals(fixed, got, bucket, buckets, sweep, parts, hot)


def _totals_of(state: pd.DataFrame) -> list[np.ndarray]:
    return list(np.frombuffer(state["d"].iat[0], "<f8").reshape(-1, 4))


def _hot_totals(fixed: pd.DataFrame, got: pd.DataFrame, bucket: int, buckets: int, sweep: int, parts: np.ndarray, hot: np.ndarray) -> list[tuple]:
    """Tables of this bucket's hot contexts, to the buckets of their parts; the
    kept sweeps' are remembered here."""
    sums: dict[int, int] = {}
    for rows in (_pick(fixed, HOT), _pick(got, HOT)):
        for key, n in zip(rows["a"], rows["b"]):
            u = int(np.searchsorted(hot, np.frombuffer(key, np.uint64)[0]))
            sums[u] = sums.get(u, 0) + int(np.frombuffer(n, np.int64)[0])
    past = {k: v for k, v in zip(_pick(got, TOP)["a"], _pick(got, TOP)["b"])}
    out = []
    for u, n in sorted(sums.items()):
        key, n = hot[u : u + 1].tobytes(), np.int64(n).tobytes()
        if sweep > BURN_IN:
            out.append(message(bucket if sweep < SWEEPS else bucket * ROOT_SPAN, TOP, bucket, key, past.get(key, b"") + n))
        if sweep < SWEEPS:
            out += [message(int(b), HOT, bucket, key, n) for b in np.unique(bucket_of(parts[u], buckets))]
    return out


def _answers(m: Merged, end: pd.DataFrame, bucket: int, shards: int, hot: np.ndarray) -> list[tuple]:
    """What the shards asked for: counts and tables of pairs, contexts and words."""
    state, root, top = _pick(end, STATE), _pick(end, ROOT), _pick(end, TOP)
    changing = m.c > 1
    extra = np.zeros(len(m.c), np.int64)
    singles = np.bincount(m.home[m.c == 1], minlength=len(m.restaurants))
    whole = [singles.copy() for _ in range(SAMPLES)]
    if changing.any():
        extra[changing] = _uints(state["b"].iat[0])
        rooms = np.unique(m.home[changing])
        for have, tables in zip(whole, _lists_of(state["c"].iat[0], SAMPLES)):
            have[rooms] = tables
    names = unpack_sorted(root["c"].iat[0]) << SIDE
    lists = _lists_of(root["b"].iat[0], 2 * SAMPLES)
    lists = [np.append(x, 0) for x in lists]
    at = np.searchsorted(names, (m.words >> SIDE) << SIDE)
    at = np.where(np.append(names, 0)[at] == (m.words >> SIDE) << SIDE, at, len(names))
    at[m.word_counts == 0] = len(names)  # a word that is not of the vocabulary has no table
    totals = b""  # of the root and its hot contexts, told by the first bucket of a root
    if root["d"].iat[0]:
        tables = np.zeros((len(hot), SAMPLES))
        for key, n in zip(top["a"], top["b"]):
            tables[np.searchsorted(hot, np.frombuffer(key, np.uint64)[0])] = np.frombuffer(n, np.int64)
        totals = root["d"].iat[0] + tables.tobytes()
    out, start, begin = {s: message(s, SEATED, bucket, f=totals) for s in range(shards)} if totals else {}, 0, 0
    for source, ctx, size, k in zip(m.sources, m.contexts, m.sizes, m.lists):
        pair, word = m.pair[start : start + size.sum()], m.word[begin : begin + len(k)]
        start, begin = start + len(pair), begin + len(k)
        room = np.searchsorted(m.restaurants, ctx)
        out[source] = message(
            source, SEATED, bucket, _rows_of([x[room] for x in whole]), _ints(m.c[pair]), _ints(extra[pair]),
            _ints(m.word_counts[word]), _rows_of([x[at[word]] for x in lists]), totals,
        )
    return list(out.values())


def _probabilities(s: Shard, answers: pd.DataFrame, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Training count and additive base of each word, averaged predictive of
    each pair (both in log10), and the tokens learned from."""
    p, rows = Prior, _pick(answers, SEATED)
    ends = [np.frombuffer(f, "<f8") for f in rows["f"] if f]
    totals = np.sum([x[: 4 * SAMPLES].reshape(SAMPLES, 4) for x in ends], axis=0)
    hot_tables = np.sum([x[4 * SAMPLES :].reshape(len(hot), SAMPLES) for x in ends], axis=0)
    tokens, vocabulary = totals[0, :2]
    across = lambda parts, n: np.concatenate([np.stack(_lists_of(x, n)) if x else np.zeros((n, 0)) for x in parts], axis=1).astype(np.float64)
    c = _join([_uints(x) for x in rows["d"]], np.int64).astype(np.float64)
    root = across(rows["e"], 2 * SAMPLES)
    pair_c = _join([_uints(x) for x in rows["b"]], np.int64).astype(np.float64)
    pair_t = _join([_uints(x) for x in rows["c"]], np.int64) / SAMPLES + (pair_c > 0)
    tables = across(rows["a"], SAMPLES)
    warm = s.hot >= 0
    tables[:, warm] = hot_tables[s.hot[warm]].T
    given, alone = pair_c - p.d * pair_t, np.zeros(len(s.words))
    for i in range(SAMPLES):
        single = _root_value(root[2 * i], root[2 * i + 1], totals[i]) / SAMPLES
        given += ((p.theta + p.d * tables[i])[s.home]) * single[s.what]
        alone += single
    customers = c[s.before]
    logs = np.log10(np.where(customers[s.home] > 0, given / (p.theta + customers)[s.home], alone[s.what]))
    return c, np.log10((c + 0.1) / (tokens + 0.1 * (vocabulary + 1))), logs, int(tokens)


def _packed_documents(rows: DataFrame, shards: int) -> DataFrame:
    """Documents as compressed blocks, dealt to shards by a hash of id and text."""
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.substring("text", 1, 64)), F.lit(shards)).cast("int"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            out = []
            for shard, part in batch.groupby("shard"):
                texts = [t.encode("utf-8", "surrogatepass") for t in part["text"]]
                flags = part["held_out"].to_numpy(bool).astype(np.uint8) | part["no_id"].to_numpy(bool).astype(np.uint8) << 1
                out.append((shard, part["doc_id"].to_numpy(np.int64).tobytes(), flags.tobytes(), np.array([len(t) for t in texts], "<u4").tobytes(), press(b"".join(texts))))
            yield pd.DataFrame(out, columns=["shard", "ids", "flags", "sizes", "texts"])

    return dealt.select("shard", "doc_id", "no_id", "held_out", "text").mapInPandas(run, "shard int, ids binary, flags binary, sizes binary, texts binary")


def _unpacked(blocks: pd.DataFrame) -> tuple[pd.DataFrame, list[str]]:
    """Ids, flags and texts of a shard's blocks, in an order of their own."""
    flags = np.frombuffer(b"".join(blocks["flags"]), np.uint8)
    ids = np.frombuffer(b"".join(blocks["ids"]), np.int64)
    texts = []
    for sizes, data in zip(blocks["sizes"], blocks["texts"]):
        data, ends = zstandard.ZstdDecompressor().decompress(data), np.cumsum(np.frombuffer(sizes, "<u4").astype(np.int64))
        texts += [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
    return pd.DataFrame({"doc_id": ids, "no_id": flags >> 1 > 0, "held_out": flags & 1 > 0}), texts


def score_documents(docs: DataFrame, folds: int = 10, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Score every whole text; one row per input row.

    Learns from rows with crc32(doc_id) mod ``folds`` not 0. A-Z is lowered;
    tokens are the words and one end. Returns doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score (additive unigram log10), score (the
    model's log10 probability) and perplexity. Null texts are empty (one
    token, the end); a null id counts as the empty text for the fold;
    repeated rows count and score each; an empty table gives no rows; with
    no training rows every probability is the base. Other columns are
    ignored. ``shards`` is layout alone: scores do not depend on it. Words are
    told apart by 64-bit fingerprints, dishes by the upper 40 bits of them (a
    few words in millions share a dish; counts do not).
    """
    rows = documents(docs, id_col, text_col).withColumn("held_out", crc_mod(own_id(), folds) == 0)
    n = shards or 2 * partitions(rows.sparkSession)
    buckets = shards or partitions(rows.sparkSession)
    hot = hot_contexts(rows)
    parts = part_names(hot)
    dealt = _packed_documents(rows, n)

    def send(blocks: pd.DataFrame) -> pd.DataFrame:
        about, texts = _unpacked(blocks)
        s, number = Shard(texts, about["held_out"].to_numpy(), hot), int(blocks["shard"].iloc[0])
        sizes = np.bincount(s.home, minlength=len(s.contexts))
        first = np.concatenate([[0], np.cumsum(sizes)])
        dish = s.words[s.what]
        words, ctx = cut_by_bucket(s.words, buckets), cut_by_bucket(s.contexts, buckets)
        out = []
        for b in range(buckets):
            w, v, lo, hi = words[b], words[b + 1], ctx[b], ctx[b + 1]
            a, z = first[lo], first[hi]
            pairs = (pack_sorted(s.contexts[lo:hi]), _ints(sizes[lo:hi]), _dishes(dish[a:z]), _ints(s.pair_counts[a:z]))
            out.append(message(b, SENT, number, *pairs, pack_sorted(s.words[w:v]), _ints(s.word_counts[w:v])))
        return _frame(out)

    def layout(batch: pd.DataFrame) -> pd.DataFrame:
        return _frame(_layout(Merged(_pick(batch, SENT)), int(batch["to"].iloc[0]), buckets, parts, hot))

    def begin(fixed: pd.DataFrame) -> pd.DataFrame:
        return _frame(_sweep_contexts(fixed, None, int(fixed["to"].iloc[0]), buckets, 0, parts, hot))

    def contexts(sweep: int):
        def run(fixed: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
            keep = got[got["kind"].isin([ROOT, TOP])]
            return pd.concat([keep, _frame(_sweep_contexts(fixed, got, int(got["to"].iloc[0]), buckets, sweep, parts, hot))])

        return run

    def roots(sweep: int):
        def run(fixed: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
            return _frame(_sweep_root(fixed, got, int(got["to"].iloc[0]), buckets, sweep, parts, hot))

        return run

    def answer(batch: pd.DataFrame, end: pd.DataFrame) -> pd.DataFrame:
        return _frame(_answers(Merged(_pick(batch, SENT)), end, int(batch["to"].iloc[0]), n, hot))

    def finish(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "no_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
        if not len(blocks):
            return pd.DataFrame(columns=names)
        about, texts = _unpacked(blocks)
        s = Shard(texts, about["held_out"].to_numpy(), hot)
        c, base, logs, tokens = _probabilities(s, answers, hot)
        start = np.concatenate([[0], np.cumsum(s.sizes)[:-1]])
        score = np.add.reduceat(logs[s.pair], start)
        return about.assign(
            n_tokens=s.sizes, n_known=np.add.reduceat((c > 0).astype(np.int64)[s.word], start), train_tokens=tokens,
            base_score=np.add.reduceat(base[s.word], start), score=score, perplexity=10 ** (-score / s.sizes),
        )

    sent = dealt.groupBy("shard").applyInPandas(send, FIELDS)
    fixed = sent.groupBy("to").applyInPandas(layout, FIELDS)
    state = fixed.groupBy("to").applyInPandas(begin, FIELDS)
    for sweep in range(SWEEPS + 1):
        if sweep:
            state = fixed.groupBy("to").cogroup(state.groupBy("to")).applyInPandas(contexts(sweep), FIELDS)
        state = fixed.groupBy("to").cogroup(state.groupBy("to")).applyInPandas(roots(sweep), FIELDS)
    answers = sent.groupBy("to").cogroup(state.groupBy("to")).applyInPandas(answer, FIELDS)
    schema = f"{IDS}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return own_ids(dealt.groupBy("shard").cogroup(answers.groupBy("to")).applyInPandas(finish, schema))
