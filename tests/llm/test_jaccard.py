import random

import numpy as np
import xxhash

import corpus_pipeline as cp
from lakemill.llm import jaccard


def shingles(text, width=5):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def similarity(a, b):
    return len(a & b) / len(a | b)


def groups(texts, least=0.8):
    have = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    while True:
        new = [min(root[j] for j in range(len(texts)) if similarity(have[i], have[j]) >= least) for i in range(len(texts))]
        new = [min(n for n, m in zip(new, root) if m == k) for k in root]
        if new == root:
            return root
        root = new


def corpus(r):
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(500)]
    texts = []
    for _ in range(12):
        base = [r.choice(words) for _ in range(r.choice([60, 150, 300]))]
        texts.append(" ".join(base))
        for share in (0.01, 0.02, 0.02, 0.03, 0.06, 0.1):  # edited words; both sides of 0.8
            texts.append(" ".join(r.choice(words) if r.random() < share else w for w in base))
    base = [r.choice(words) for _ in range(200)]
    for at in range(40):  # one crowd, and a chain whose ends differ
        texts.append(" ".join(base[:at] + ["crowd"] + base[at + 1 :]))
        texts.append(" ".join([r.choice(words) for _ in range(3 * at)] + base[3 * at :]) if 3 * at < 190 else f"alone {at}")
    return texts + [None, "", " \n", "four words are few", "Four words ARE few", texts[0].upper()]


def test_groups_equal_brute_force(spark):
    texts = corpus(random.Random(3))
    got = {r.doc_id: r.root for r in jaccard.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = groups(texts)
    name = lambda label: sorted(sorted(i for i in range(len(texts)) if label[i] == k) for k in set(label))
    assert name([got[i] for i in range(len(texts))]) == name(want)
    assert 12 < len(set(want)) < len(texts) - 60
    assert jaccard.near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_crowd_around_the_threshold(spark):
    """Copies of one text of which some pairs are alike and most are not: the hub of a band joins few."""
    r = random.Random(21)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(800)]
    base = [r.choice(words) for _ in range(150)]
    texts = []
    for _ in range(160):
        own = list(base)
        for at in r.sample(range(150), r.choice([1, 2, 3, 4, 5, 6])):
            own[at] = r.choice(words)
        texts.append(" ".join(own))
    got = {x.doc_id: x.root for x in jaccard.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = groups(texts)
    name = lambda label: sorted(sorted(i for i in range(len(texts)) if label[i] == k) for k in set(label))
    assert name([got[i] for i in range(len(texts))]) == name(want) and 5 < len(set(want)) < 155


def test_stage_drops_lightly_edited_copies(spark):
    """Copies of 0.8 or more of their five-word shingles go, though their SimHashes differ by more than 3 bits."""
    texts = corpus(random.Random(8))
    docs = spark.createDataFrame([(i, t, "more") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    left = cp.drop_near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(groups(texts)))


def test_each_row_has_its_own_verdict(spark):
    r = random.Random(2)
    words = lambda n: [f"w{r.randrange(10_000)}" for _ in range(n)]
    one, two, three = words(200), words(200), words(200)
    edited = lambda w, at: " ".join(w[:at] + ["edit"] + w[at + 1 :])
    rows = [(1, " ".join(one)), (5, edited(one, 50)), (5, " ".join(two)), (5, " ".join(two)), (None, " ".join(three)), (None, edited(three, 90)), (None, edited(one, 20)), (None, "a clean text of its own")]
    left = cp.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    kept = {(x.doc_id, x.text) for x in left}
    assert len(left) == len(kept) == 4 and {rows[0], rows[2], rows[7]} < kept
    assert len(kept & {rows[4], rows[5]}) == 1


def test_stage_links_by_simhash(spark, monkeypatch):
    """Copies within 3 bits go by SimHash, without a band in common; beyond 3 bits the bands are needed."""
    r = random.Random(14)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(900)]
    texts = []
    for _ in range(30):
        base = [r.choice(words) for _ in range(600)]
        texts.append(" ".join(base))
        for edits in (1, 2, 4, 12):
            own = list(base)
            for at in r.sample(range(600), edits):
                own[at] = r.choice(words)
            texts.append(" ".join(own))
    have = [shingles(t) for t in texts]
    hashes = [[xxhash.xxh64_intdigest(b" ".join(s), 42) for s in x] for x in have]
    fps = [sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h)) for h in hashes]
    near = [[j for j, g in enumerate(fps) if (f ^ g).bit_count() <= 3 and similarity(have[i], have[j]) >= 0.8] for i, f in enumerate(fps)]
    root = list(range(len(texts)))
    for _ in range(5):
        root = [min(root[j] for j in near[i]) for i in range(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = lambda: sorted(x.doc_id for x in cp.drop_near_duplicates(spark, docs, "").collect())
    assert kept() == sorted(set(groups(texts)))
    monkeypatch.setattr(jaccard, "minima", lambda have, times, plus: np.bitwise_xor.reduce(have) + np.arange(len(times), dtype=np.uint64))
    assert kept() == sorted(set(root))
    assert len(set(groups(texts))) < len(set(root)) < len(texts) - 30
