import hashlib
import random

from lakemill.llm.suffixes import suffix_array_dedup


def brute(rows, length):
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, rows[n][1] or ""))
    seen, out = set(), []
    for n in order:
        b = (rows[n][1] or "").encode()
        gone = [False] * len(b)
        for a in range(len(b) - length + 1):
            s = b[a : a + length]
            if s in seen:
                gone[a : a + length] = [True] * length
            seen.add(s)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((str(rows[n][0]), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed, n):
    r = random.Random(seed)
    text = lambda k: "".join(r.choice("abcdé ñ\n") for _ in range(k))
    passages = [text(r.randint(60, 700)) for _ in range(15)]
    rows = []
    for i in range(n):
        t = ""
        for _ in range(r.randint(0, 5)):
            p = r.choice(passages)
            a = r.randint(0, len(p))
            t += p[a : a + r.randint(1, 700)] + text(r.randint(0, 150))
        rows.append((i * 2, t))
    near = list(rows[4][1])
    for _ in range(5):
        near[r.randrange(len(near))] = "#"
    rows += [(None, rows[3][1]), (9, rows[5][1]), (9, rows[5][1]), (11, None), (3, ""), (500, "a" * 1000), (501, "ab" * 400), (502, "a" * 100), (503, "x" * 99), (504, "".join(near)), (505, passages[0] * 4), (506, ("q" * 37 + "é") * 9000)]
    r.shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    for seed, shards, length in ((1, 1, 100), (2, 6, 100), (3, 4, 72), (4, 3, 131)):
        rows = corpus(seed, 70)
        df = spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, text string, n_bytes string")
        got = suffix_array_dedup(df, length, shards=shards, keep_text=True).collect()
        assert sorted((str(g.doc_id), g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got) == brute(rows, length)
        assert all(g.kept_text is not None for g in got)


def test_empty(spark):
    assert suffix_array_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = suffix_array_dedup(spark.createDataFrame([(1, None), (2, "short")], "doc_id long, text string"), keep_text=True).collect()
    assert sorted((g.doc_id, g.n_bytes, g.n_spans, g.kept_text) for g in got) == [(1, 0, 0, ""), (2, 5, 0, "short")]
