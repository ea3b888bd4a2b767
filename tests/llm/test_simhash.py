import random

import numpy as np
import xxhash

from lakemill.llm import simhash


def plain(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(fps):
    root = list(range(len(fps)))
    for _ in fps:
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= 3:
                    root[i] = root[j] = min(root[i], root[j])
    return root


def test_links_close_like_brute_force(spark):
    r = random.Random(5)
    fps = []
    for _ in range(14):
        centre = r.getrandbits(64)
        fps.append(centre)
        for _ in range(6):
            x = centre
            for b in r.sample(range(64), r.choice([1, 2, 3, 3, 4])):
                x ^= 1 << b
            fps.append(x)
        for block in range(4):  # three flips in one block, and none elsewhere
            x = centre
            for b in r.sample(range(16), 3):
                x ^= 1 << (16 * block + b)
            fps.append(x)
    fps = sorted(set(fps) | {0, 7})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    got = simhash.components(simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()
    label = {x: x for x in signed} | {g.node: g.root for g in got}
    want = closure(fps)
    groups = lambda names: sorted(sorted(i for i in range(len(fps)) if names[i] == n) for n in set(names))
    assert groups([label[x] for x in signed]) == groups(want)


def test_operator(spark):
    r = random.Random(1)
    base = [" ".join(r.choice("abcdefghijklmnop") * r.randint(1, 5) for _ in range(300)) for _ in range(5)]
    texts = [None, "", " \n", "one", "One two", *base, base[0].upper(), base[1] + " tail", base[0], "é Ü 　 x"]
    rows = [(10 + i, t, "x") for i, t in enumerate(texts)] + [(None, base[2], "n"), (10, None, "again")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, component_id string")).collect()
    assert len(got) == len(rows)
    fps = [plain(t) for _, t, _ in rows]
    ids = [i for i, _, _ in rows]
    root = closure(fps)
    least = {k: min([i for i, x in zip(ids, root) if x == k and i is not None], default=None) for k in root}
    want = sorted((str(i), f"{f:016x}", least[k]) for i, f, k in zip(ids, fps, root))
    assert sorted((str(g.doc_id), g.fingerprint, g.component_id) for g in got) == want
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_direct_links_are_close_and_join_all(spark):
    r = random.Random(9)
    fps = set()
    for _ in range(6):
        x = r.getrandbits(64)
        for _ in range(25):  # a walk: its ends differ by far more than 3 bits
            fps.add(x)
            for b in r.sample(range(64), r.choice([1, 2, 3])):
                x ^= 1 << b
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    got = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), direct=True).collect()
    assert all(g.a != g.b and (g.a % 2**64 ^ g.b % 2**64).bit_count() <= 3 for g in got)
    label = {x: x for x in signed} | {g.node: g.root for g in simhash.components(spark.createDataFrame(got)).collect()}
    want = closure(fps)
    groups = lambda names: sorted(sorted(i for i in range(len(fps)) if names[i] == n) for n in set(names))
    assert groups([label[x] for x in signed]) == groups(want)
