import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from lakemill.llm import toxicity as tx


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(11)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(900)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    docs, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        t = text(60).split()
        if bad:
            for w in ("nastyword", "vileword", "nastyone"):
                t.insert(r.randrange(len(t)), w)
        docs.append([i, " ".join(t)])
        if i < 300:
            labels.append((i, 1, int(bad)))
    item = text(30)
    docs[301][1] += " " + item + " " + text(5)
    docs[303][1] = docs[302][1]
    docs[305][1] = docs[301 + 5][1].replace("a", "A")  # the same words in capitals
    docs[309][1] = text(30) + " " + docs[307][1][:200]  # a passage of another document
    rows = [(i, t, "en", f"s{i % 3}", len(t), "more") for i, t in docs] + [(310, docs[310][1], "en", "s0", 5, "again"), (None, text(40), None, None, None, None), (500, None, "en", None, 0, "x")]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        seen[name] = docs
        assert name == "bpe_codec" or docs.columns == columns
    ids = {n: sorted((r.doc_id for r in df.collect()), key=str) for n, df in seen.items()}
    tox = set(ids["toxicity"])
    assert [i for i in range(400) if (i in tox) == (i % 4 == 0)] == [] and {None, 500} <= tox
    near = ids["simhash_near_dedup"]
    assert 302 in near and 303 not in near and 305 in near and 306 not in near and near.count(310) == 1 and None in near
    assert set(tox) - set(near) == {303, 306}
    cut = {r.doc_id: r for r in seen["suffix_array_dedup"].collect()}
    before = {r.doc_id: r for r in seen["simhash_near_dedup"].collect()}
    assert len(cut[309].text) == len(before[309].text) - 200 and cut[309].n_chars == len(cut[309].text) and cut[309].shard == "more"
    assert all(cut[i].text == (before[i].text or "") for i in cut if i != 309)
    assert set(cut) - set(ids["benchmark_decontamination"]) == {301}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    n = {r.doc_id: r.n_tokens for r in seen["bpe_codec"].collect()}
    assert all(n[i] == len(library.encode(cut[i].text or "", add_special_tokens=False).ids) for i in n)
    got = cp.run(spark, folder)
    assert sorted(map(str, got.collect())) == sorted(map(str, seen["bpe_codec"].collect()))


def test_toxicity_scores_held_out_rows(spark, folder):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = {r.doc_id: r for r in tx.toxicity(docs, labels).collect()}
    held = [r for i, r in got.items() if r.held_out and i is not None and i < 400]
    assert len(held) > 40 and sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert got[500].predicted == 0 and got[None].score is not None
    empty = docs.limit(0)
    assert tx.toxicity(empty, labels).count() == 0 and {r.score for r in tx.toxicity(docs.limit(3), labels.limit(0)).collect()} == {0.5}
