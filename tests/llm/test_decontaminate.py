import random
import unicodedata

from lakemill.llm import decontaminate as dc


def substring_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_myers_equals_dynamic_programming():
    r = random.Random(2)
    for _ in range(300):
        p = "".join(r.choice("abc ") for _ in range(r.randint(1, 90)))
        t = "".join(r.choice("abc ") for _ in range(r.randint(0, 120)))
        assert dc.myers(dc.letter_masks(p), len(p), t)[0] == substring_distance(p, t)


def test_pieces_cover():
    for n in (1, 5, 99):
        for k in range(n):
            got = dc.pieces("x" * n, k)
            assert len(got) == k + 1 and "".join(p for _, p in got) == "x" * n and all(p for _, p in got)


def test_operator_equals_brute_force(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijk") for _ in range(r.randint(1, 7)))
    items = [(i, " ".join(word() for _ in range(r.choice([2, 12, 25])))) for i in range(12)] + [(90, None), (91, " "), (3, "repeated id item here")]
    docs = []
    for d in range(60):
        text = [word() for _ in range(40)]
        item = list(r.choice(items[:12])[1])
        for _ in range(r.choice([0, 0, 2, 5, 9, 20])):
            at = r.randrange(len(item)) if item else 0
            item[at : at + r.choice([0, 1])] = r.choice(["", "q", "Z", " "])
        docs.append((d, " ".join(text[:20]) + "\n " + "".join(item).upper() + "\t" + " ".join(text[20:]), 1))
    docs += [(None, items[5][1], 0), (70, None, 0), (71, "", 0), (5, docs[5][1], 1), (72, "x " * 40_000 + items[7][1], 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for d, t, _ in docs:
        for i, q in items:
            q = dc.normal(q or "")
            if q:
                text = dc.normal(t or "")
                dist = substring_distance(q, text if len(text) < 5000 else text[-400:])
                if dist <= int(0.08 * len(q)):
                    want.append((d, i, dist))
    for chars in (4_000_000, 60):
        got = [(x.doc_id, x.item_id, x.distance) for x in dc.contaminated(df, bench, block_chars=chars).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert len(want) > 20
    bad = {d for d, _, _ in want}
    left = dc.decontaminate(df, bench)
    assert left.columns == df.columns and sorted(x.doc_id for x in left.collect()) == sorted(d for d, _, _ in docs if d not in bad)
    assert dc.contaminated(df, bench.limit(0)).count() == dc.contaminated(df.limit(0), bench).count() == 0


def test_capitals_and_composition_cost_no_budget(spark):
    items = [(1, "éèàùçœ êâîôûëï äöüãõñ áíóú ýčšžřů ěďťňľ ôàéêè"), (2, "съешь ещё этих мягких французских булок"), (3, "große straße füße heißen weiß"), (4, "ξεσκεπάζω την ψυχοφθόρα βδελυγμία")]
    docs = [(i, "before " + t.upper() + "\n after") for i, t in items] + [(5, "before " + unicodedata.normalize("NFD", items[0][1]) + " after"), (6, "nothing here")]
    got = dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    # Greek capitals carry their accents here, as str.upper() leaves them
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got.collect()) == [(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 1, 0)]


def test_each_row_has_its_own_verdict(spark):
    item = "the quick brown fox jumps over the lazy dog"
    docs = spark.createDataFrame([(None, "a clean text"), (None, "x " + item), (None, "another clean text"), (7, item + " y"), (7, "clean, of the same id"), (8, None)], "doc_id long, text string")
    left = dc.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(map(tuple, left.collect()), key=str) == sorted([(None, "a clean text"), (None, "another clean text"), (7, "clean, of the same id"), (8, None)], key=str)
