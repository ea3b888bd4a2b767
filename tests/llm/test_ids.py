"""Ids above 2**53 beside null ids, in one batch, through every operator."""

import public_tokenizers

from lakemill.llm import bpe, decontaminate, edit_counts, jaccard, pitman_yor, simhash, substring, suffixes, toxicity

BIG = 2**60
IDS = [BIG + 1, None, BIG + 2, None, 3, BIG + 3]
SHOWN = sorted(map(str, IDS))


def shown(df, column="doc_id"):
    return sorted(str(r[column]) for r in df.collect())


def table(spark, texts=None):
    texts = texts or [f"a text of its own number {i} with some words" for i in range(len(IDS))]
    return spark.createDataFrame([(i, t, "x") for i, t in zip(IDS, texts)], "doc_id long, text string, no_id string").coalesce(1)


def test_ids_come_back(spark):
    df = table(spark)
    labels = spark.createDataFrame([(3, 1), (BIG + 1, 0), (None, 1)], "doc_id long, toxic int")
    for out in (
        substring.substring_dedup(df), suffixes.suffix_array_dedup(df), suffixes.suffix_array_dedup(df, shards=1), pitman_yor.score_documents(df),
        toxicity.toxicity(df, labels), bpe.bpe_codec(df, public_tokenizers.path("word_bpe_49k.json")),
        edit_counts.edit_counts(df.selectExpr("*", f"cast(null as {edit_counts.EDITS}) as edits"), public_tokenizers.path("byte_bpe_50k.json")),
        simhash.near_duplicates(df), jaccard.near_copies(df), jaccard.drop_near_copies(df),
        decontaminate.contaminated(df, spark.createDataFrame([(1, "a text of its own number")], "item_id long, text string")),
    ):
        assert shown(out) == SHOWN
    items = spark.createDataFrame([(BIG + 1, "some words"), (None, "its own"), (BIG + 2, "number")], "item_id long, text string").coalesce(1)
    assert set(shown(decontaminate.contaminated(df, items), "item_id")) == {str(BIG + 1), str(BIG + 2), "None"}


def test_rows_without_an_id_come_last(spark):
    text = "the very same words stand in each of these texts and there are more than enough of them to be found again " * 2
    df = spark.createDataFrame([(1, text), (None, text), (2, text), (BIG, None)], "doc_id long, text string").coalesce(1)
    for shards in (1, 2, 7):
        got = {str(r.doc_id): r for r in suffixes.suffix_array_dedup(df, shards=shards).collect()}
        assert got["1"].n_removed < got["1"].n_bytes == got["2"].n_removed == got["None"].n_removed
    links = simhash.near_duplicates(df).collect()
    assert {str(r.doc_id): r.component_id for r in links} == {"1": 1, "2": 1, "None": 1, str(BIG): BIG}
