import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemill.llm import common

KEYS = st.lists(st.integers(0, 2**64 - 1), max_size=200)


@settings(max_examples=60, deadline=None)
@given(KEYS)
def test_packing_round_trips(xs):
    keys = common.distinct(np.array(xs, np.uint64))
    assert keys.tolist() == sorted(set(xs))
    assert common.unpack_sorted(common.pack_sorted(keys)).tolist() == keys.tolist()
    small = (keys & np.uint64(0xFFFF)).astype("<u4")
    assert common.unpack_planes(common.pack_planes(small), "<u4").tolist() == small.tolist()
    ends = common.cut_by_bucket(keys, 7)
    assert len(ends) == 8 and ends[0] == 0 and ends[-1] == len(keys)
    assert all((common.bucket_of(keys[a:b], 7) == i).all() for i, (a, b) in enumerate(zip(ends, ends[1:])))


def test_range_shards_keep_order_and_share_text(spark):
    rows = [(i, "x" * (4_000 if i % 50 == 0 else 20)) for i in range(3_000)] + [(None, "x"), (7, "y"), (7, "z")]
    docs = common.documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    df, classes = common.with_range_shard(docs, 6)
    got = df.where("not no_id").groupBy("shard").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.sum(F.length("text")).alias("w")).orderBy("shard").collect()
    assert 4 <= len(got) <= 6 and all(x.b < y.a for x, y in zip(got, got[1:]))
    assert max(g.w for g in got) < 1.6 * sum(g.w for g in got) / len(got)
    last = df.where("no_id").first().shard
    assert last == max(g.shard for g in got) + 1 and df.where("doc_id = 7").select("shard").distinct().count() == 1
    assert len(set(classes)) == len(classes) == last + 1
    assert common.with_range_shard(docs.limit(0), 6)[0].count() == 0


def test_many_rows_of_one_id_or_none_are_spread(spark):
    rows = [(None, f"x {i}") for i in range(2_000)] + [(5, f"y {i}") for i in range(1_000)] + [(i, f"z {i}") for i in range(1_000)]
    df, classes = common.with_range_shard(common.documents(spark.createDataFrame(rows, "doc_id long, text string")), 8)
    got = {r.shard: r for r in df.groupBy("shard").agg(F.count("*").alias("n"), F.max("no_id").alias("none"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).collect()}
    assert max(r.n for r in got.values()) < 2 * len(rows) / 8
    none = {classes[s] for s, r in got.items() if r.none}
    assert len(none) == 1 and min(s for s, r in got.items() if r.none) > max(s for s, r in got.items() if not r.none)
    five = [s for s, r in got.items() if not r.none and r.a == r.b == 5]
    assert len(five) > 1 and len({classes[s] for s in five}) == 1
    assert classes == sorted(classes)
