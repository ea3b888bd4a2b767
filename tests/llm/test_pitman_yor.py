import math
import random
import zlib
from collections import Counter

import numpy as np
import xxhash

from lakemill.llm import pitman_yor as py


def corpus(n):
    r = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    after = {w: r.choices(words, weights, k=4) for w in words}
    rows = []
    for i in range(n):
        w, text = "w1", []
        for _ in range(r.randint(0, 80)):
            w = r.choice(after[w]) if r.random() < 0.7 else r.choices(words, weights)[0]
            text.append(w.upper() if r.random() < 0.2 else w)
        rows.append((i, " \n".join(text)))
    return rows + [(None, "w1 w2"), (None, None), (3, None), (3, ""), (5, "never seen É words")]


def test_counts_and_base_are_exact(spark):
    rows = corpus(300)
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, score int")
    got = py.score_documents(df, shards=5).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    tokens = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split() + ["\n"]
    seen = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(seen.values()), len(seen)
    want = sorted((str(i), held(i), len(tokens(t)), sum(seen[w] > 0 for w in tokens(t)), n, round(sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 6)) for i, t in rows)
    assert sorted((str(g.doc_id), g.held_out, g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 6)) for g in got) == want
    out = [g for g in got if g.held_out]
    assert sum(g.score for g in out) > 1.02 * sum(g.base_score for g in out) and all(g.score < 0 for g in got)
    assert abs(out[0].perplexity - 10 ** (-out[0].score / out[0].n_tokens)) < 1e-9


def plain_model(rows):
    """The model with dictionaries and loops, in one process: score of each text."""
    h = lambda w: xxhash.xxh64_intdigest(w.encode())
    side = lambda x: x >> int(py.SIDE)
    one = lambda key, sweep, step: float(py.uniform(np.array([key], np.uint64), sweep, step)[0])
    mixed = lambda x: int(py.mix(np.array([x % 2**64], np.uint64))[0])
    words = lambda t: [*map(h, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()), int(py.END)]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    m1, m2, p = int(py.M1), int(py.M2), py.Prior

    def draw(c, others, parent, d, theta, key, sweep):
        if c == 1:
            return 1
        if c > py.STIRLING:
            return int(py.seat(np.array([c]), np.array([others]), np.array([parent]), d, theta, None, lambda rows, step: py.uniform(np.array([key], np.uint64)[rows], sweep, step))[0])
        ways = {(1, 1): 1.0}
        for n in range(1, c):
            for k in range(1, n + 2):
                ways[n + 1, k] = ways.get((n, k - 1), 0) + (n - d * k) * ways.get((n, k), 0)
        weight = [ways[c, k] * math.prod((theta + d * (others + i)) * parent for i in range(k)) for k in range(1, c + 1)]
        left = one(key, sweep, 0) * sum(weight)
        for k, w in enumerate(weight, 1):
            left -= w
            if left <= 1e-12 * sum(weight):
                return k
        return c

    pairs, seen = Counter(), Counter()
    for i, t in rows:
        if not held(i):
            ws = words(t)
            seen.update(ws)
            pairs.update(zip([int(py.START), *ws[:-1]], ws))
    customers = Counter()
    for (u, _), c in pairs.items():
        customers[u] += c
    v = len(seen)
    t, root_t, samples = dict.fromkeys(pairs, 1), {}, []
    for sweep in range(py.SWEEPS + 1):
        room = Counter()
        for (u, _), k in t.items():
            room[u] += k
        if sweep:
            value = lambda w: (root[w] - p.d_root * root_t[w]) / (p.theta_root + n) + (p.theta_root + p.d_root * n_t) / (p.theta_root + n) / (v + 1) if w in root else (p.theta_root + p.d_root * n_t) / (p.theta_root + n) / (v + 1)
            t = {(u, w): draw(c, room[u] - t[u, w], value(w), p.d, p.theta, mixed(u * m1 + side(w) * m2 + 1), sweep) for (u, w), c in pairs.items()}
            room = Counter()
            for (u, _), k in t.items():
                room[u] += k
        root = Counter()
        for (_, w), k in t.items():
            root[w] += k
        if sweep:
            root_t = {w: draw(k, n_t - root_t[w], 1 / (v + 1), p.d_root, p.theta_root, mixed(side(w) * m1 + 2), sweep) for w, k in root.items()}
        else:
            root_t = dict.fromkeys(root, 1)
        n, n_t = sum(root.values()), sum(root_t.values())
        if sweep > py.BURN_IN:
            samples.append((t, room, root, root_t, n, n_t))

    def probability(u, w):
        out = 0
        for t, room, root, root_t, n, n_t in samples:
            single = (root[w] - p.d_root * root_t.get(w, 0) + (p.theta_root + p.d_root * n_t) / (v + 1)) / (p.theta_root + n)
            own = (pairs[u, w] - p.d * t.get((u, w), 0) + (p.theta + p.d * room[u]) * single) / (p.theta + customers[u]) if customers[u] else single
            out += own / len(samples)
        return out

    return [(i, sum(math.log10(probability(u, w)) for u, w in zip([int(py.START), *words(t)[:-1]], words(t)))) for i, t in rows]


def test_scores_equal_the_plain_model_at_any_layout(spark):
    rows = corpus(120)
    df = spark.createDataFrame([(n, *x) for n, x in enumerate(rows)], "n int, doc_id long, text string")
    want = sorted(plain_model(rows), key=str)
    first = None
    for shards, parts in ((1, 1), (8, 3), (64, 5)):
        got = sorted(((g.doc_id, g.score) for g in py.score_documents(df.repartition(parts), shards=shards).collect()), key=str)
        assert [i for i, _ in got] == [i for i, _ in want]
        assert max(abs(a - b) for (_, a), (_, b) in zip(sorted(got, key=lambda x: x[1]), sorted(want, key=lambda x: x[1]))) < 1e-9 * 1e3
        first = first or got
        assert max(abs(a - b) for (_, a), (_, b) in zip(sorted(got, key=lambda x: x[1]), sorted(first, key=lambda x: x[1]))) < 1e-9


def test_hot_contexts_are_layout_alone(spark, monkeypatch):
    df = spark.createDataFrame(corpus(80), "doc_id long, text string")
    one = sorted(r.score for r in py.score_documents(df, shards=4).collect())
    monkeypatch.setattr(py, "hot_contexts", lambda docs: np.array([py.START], np.uint64))
    two = sorted(r.score for r in py.score_documents(df, shards=4).collect())
    assert max(abs(a - b) for a, b in zip(one, two)) < 1e-9


def test_probabilities_sum_to_one(spark):
    """p(w | start) over the vocabulary and one unknown word: a text of w alone
    scores p(w | start) p(end | w), the text "w w1" p(w | start) p(w1 | w) p(end | w1);
    so p(w | start) is had by asking for every word that may follow w."""
    rows = [(i, t) for i, t in corpus(60) if i is not None and zlib.crc32(str(i).encode()) % 10]
    words = sorted({w for _, t in rows for w in (t or "").lower().split()})[:6]
    small = [(i, " ".join(w for w in (t or "").lower().split() if w in words)) for i, t in rows]
    ids = (i for i in range(1000, 10**6) if zlib.crc32(str(i).encode()) % 10 == 0)
    each = [*words, "unknown"]
    ask = {(a, b): next(ids) for a in each for b in each}
    alone = {a: next(ids) for a in each}
    texts = [(i, f"{a} {b}") for (a, b), i in ask.items()] + [(i, a) for a, i in alone.items()] + [(next(ids), "")]
    out = py.score_documents(spark.createDataFrame(small + texts, "doc_id long, text string"), shards=3).collect()
    p = {r.doc_id: 10**r.score for r in out}
    empty = p[texts[-1][0]]  # p(end | start)
    # one-word texts: p(a | start) p(end | a); two-word ones: p(a | start) p(b | a) p(end | b).
    # With q(a) = p(end | a), sum over b of p(ab) / q(b) + p(a) = p(a | start); solve for q by iteration.
    q = {a: 0.1 for a in each}
    for _ in range(3000):
        start = {a: p[alone[a]] + sum(p[ask[a, b]] / q[b] for b in each) for a in each}
        q = {a: p[alone[a]] / start[a] for a in each}
    assert abs(empty + sum(start.values()) - 1) < 1e-3


def test_tables_follow_the_conditional():
    rng = np.random.default_rng(1)
    table = py.log_stirling(0.8)
    m, c, p, others = 40_000, 5, 0.05, 7
    t = py.seat(np.full(m, c), np.full(m, float(others)), np.full(m, p), 0.8, 1.0, table, lambda rows, step: rng.random(len(rows)))
    weight = [math.exp(table[c, k]) * p**k * math.prod(1 + 0.8 * (others + i) for i in range(k)) for k in range(1, c + 1)]
    want = np.array(weight) / sum(weight)
    assert np.abs(np.bincount(t, minlength=c + 1)[1:] / m - want).max() < 0.01
    # large dishes: near the expectation of the seating process
    t = py.seat(np.full(3_000, 500), np.full(3_000, 50.0), np.full(3_000, 0.01), 0.8, 1.0, table, lambda rows, step: rng.random(len(rows)))
    one = []
    for _ in range(2_000):
        k = 1
        for j in range(1, 500):
            a = (1 + 0.8 * (50 + k)) * 0.01
            k += rng.random() < a / (a + j - 0.8 * k)
        one.append(k)
    assert abs(t.mean() - np.mean(one)) < 0.04 * np.mean(one)


def test_empty(spark):
    assert py.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
