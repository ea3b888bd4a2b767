import hashlib
import random

from lakemill.llm.substring import locate, substring_dedup


def brute(rows, width):
    first = {}
    words = {n: (t or "").encode().split() for n, (_, t) in enumerate(rows)}
    rank = lambda i: (i is None, i or 0)
    for n, (i, _) in enumerate(rows):
        for a in range(len(words[n]) - width + 1):
            w = tuple(words[n][a : a + width])
            first[w] = min(first.get(w, (True, 2**63)), rank(i))
    out = []
    for n, (i, _) in enumerate(rows):
        gone = set()
        for a in range(len(words[n]) - width + 1):
            if first[tuple(words[n][a : a + width])] < rank(i):
                gone |= {*range(a, a + width)}
        kept = b" ".join(w for k, w in enumerate(words[n]) if k not in gone)
        out.append((str(i), len(words[n]), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé") for _ in range(r.randint(1, 3)))
    passages = [[word() for _ in range(r.randint(3, 60))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(r.randint(0, 6)):
            p = r.choice(passages)
            a = r.randint(0, len(p))
            w += p[a : a + r.randint(1, 60)] + [word() for _ in range(r.randint(0, 20))]
        rows.append((i * 3, r.choice([" ", "\n", "\t  "]).join(w)))
    rows += [(None, rows[3][1]), (9, rows[5][1]), (9, rows[5][1]), (1, None), (4, ""), (500, "a " * 300), (501, "a " * 20), (-7, rows[8][1]), (502, "b a " * 3000)]
    r.shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    for seed, shards, width in ((1, 1, 13), (2, 7, 13), (3, 5, 6), (4, 3, 2)):
        rows = corpus(seed, 60)
        df = spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, text string, n_words string")
        got = substring_dedup(df, width, shards=shards).collect()
        assert sorted((str(g.doc_id), g.n_words, g.n_removed, g.kept_sha256) for g in got) == brute(rows, width)


def test_empty_and_kept_text(spark):
    df = spark.createDataFrame([(1, "x y"), (2, None)], "doc_id long, text string")
    assert substring_dedup(df.limit(0)).count() == 0
    got = {r.doc_id: r.kept_text for r in substring_dedup(df, 2, keep_text=True).collect()}
    assert got == {1: "x y", 2: ""}


BIG = 2**60


def test_ids_beside_nulls_stay_and_come_last(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(BIG + 2, text), (None, text), (BIG + 1, text), (None, text), (3, "short"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for shards in (1, 2, 7):
        got = sorted(((g.doc_id is None, g.doc_id or 0, g.n_words, g.n_removed) for g in substring_dedup(df, shards=shards).collect()))
        assert got == [(False, 3, 1, 0), (False, BIG + 1, 40, 0), (False, BIG + 2, 40, 40), (True, 0, 0, 0), (True, 0, 40, 40), (True, 0, 40, 40)]


def test_hot_ids_and_rows_without_one(spark):
    r = random.Random(5)
    phrase = " ".join(f"p{i}" for i in range(20))
    filler = lambda: " ".join(r.choice("abcdefgh") * 3 + str(r.randint(0, 999)) for _ in range(30))
    rows = [(i, f"{filler()} {phrase}") for i in range(5)] + [(7, f"{phrase} {filler()}") for _ in range(40)] + [(None, f"{phrase} {filler()}") for _ in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup(df, shards=6).collect()
    assert sorted((str(g.doc_id), g.n_words, g.n_removed, g.kept_sha256) for g in got) == brute(rows, 13)


def test_only_the_automaton_removes():
    words = [b"a%d" % i for i in range(30)]
    ranks = [0, 1]
    assert not any(m.any() for m in locate([words, words], ranks, [], 13))
    assert [int(m.sum()) for m in locate([words, words], ranks, [(0, words)], 13)] == [0, 30]
    assert [int(m.sum()) for m in locate([words, words], ranks, [(-1, words[:14])], 13)] == [14, 14]
    assert not any(m.any() for m in locate([words, words], ranks, [(-1, words[:12] + [b"x"])], 13))
