"""The toxicity model against a plain version: dictionaries, loops, one row after another."""

import math
import random
import zlib

import numpy as np
import xxhash

from lakemill.llm import toxicity as tox

MASK = 2**64 - 1
M1, M2 = int(tox.M1), int(tox.M2)
S = tox.FtrlSettings(bits=16, l1=0.5, epochs=2)


def mixed(a):
    a = ((a ^ (a >> 31)) * M1) & MASK
    a ^= a >> 29
    return (a * M2) & MASK


def plain_features(text, bits):
    """Places of the words, four-byte stems, pairs and skip pairs of a text, each once."""
    plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(c if ord(c) >= 128 or c.isalnum() or c == "'" else " " for c in plain).encode().split()
    h = [xxhash.xxh64_intdigest(w) for w in words]
    out = {mixed(x) >> (64 - bits) for x in h}
    out |= {mixed((xxhash.xxh64_intdigest(w[:4]) * M1 + M2) & MASK) >> (64 - bits) for w in words}
    for gap in (1, 2, 3):
        out |= {mixed((a * M1 + b * M2 + gap) & MASK) >> (64 - bits) for a, b in zip(h, h[gap:])}
    return out


def plain_weights(rows, s):
    """FTRL-proximal as published, coordinate by coordinate; the bias is a coordinate without penalty."""
    z, n = {}, {}

    def weight(i):
        a = z.get(i, 0.0)
        rate = (s.beta + math.sqrt(n.get(i, 0.0))) / s.alpha
        if i == "bias":
            return -a / rate
        return 0.0 if abs(a) <= s.l1 else -(a - math.copysign(s.l1, a)) / (rate + s.l2)

    for _ in range(s.epochs):
        for x, y in rows:
            at = [*x, "bias"]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in at:
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / s.alpha * w[i]
    return {i: weight(i) for i in z}


def corpus():
    r = random.Random(11)
    mild, harsh = ["fine", "Good-day", "müde", "thanks", "it's", "sun"], ["awful", "IDIOT", "trash", "rubbish!"]
    texts = {}
    for i in range(90):
        bad = r.random() < 0.4
        texts[i] = (" ".join(r.choice(mild + harsh * bad) for _ in range(r.randint(1, 30))), int(bad))
    return texts


def test_scores_equal_a_plain_model(spark):
    texts = corpus()
    extra = [(200, None), (201, ""), (202, "word " * 120_000 + "idiot"), (None, "awful trash"), (None, None), (3, "a second text of a labelled id")]
    docs = spark.createDataFrame([(i, t, "x") for i, (t, _) in texts.items()] + [(i, t, "x") for i, t in extra], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in texts.items()] + [(5, texts[5][1]), (None, 1), (7000, 1), (8, None)], "doc_id long, toxic int")
    got = [(r.doc_id, r.held_out, r.score, r.predicted) for r in tox.toxicity(docs, labels, S).collect()]

    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0
    packed = lambda t: np.array(sorted(plain_features(t, S.bits)), "<i4").tobytes()
    examples = {}  # one for each id and label: that of the least packed features
    for i, t in [(i, t) for i, (t, _) in texts.items()] + extra:
        if i in texts and not held(i):
            examples[i, texts[i][1]] = min(examples.get((i, texts[i][1]), b"\xff"), packed(t))
    rows = sorted((i, y, x) for (i, y), x in examples.items())
    order = np.random.default_rng(7).permutation(len(rows))
    w = plain_weights([(np.frombuffer(rows[k][2], "<i4").tolist(), rows[k][1]) for k in order], S)

    def score(text):
        return 1 / (1 + math.exp(-(sum(w.get(i, 0.0) for i in plain_features(text, S.bits)) + w["bias"])))

    want = [(i, held(i), score(t)) for i, t in [(i, t) for i, (t, _) in texts.items()] + extra]
    key = lambda r: (str(r[0]), round(r[2], 4))
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-5 and a[3] == int(a[2] >= 0.5)
    assert len({round(s, 3) for _, _, s, _ in got}) > 20


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in tox.toxicity(docs, labels, S).collect()} == {0.5}
    assert tox.toxicity(docs.limit(0), labels, S).count() == 0
    assert tox.drop_toxic(docs, labels, S).count() == 2
