import pytest

from lakemill.operators import silver
from lakemill.sources import bronze


def fixture(spark):
    reviews = spark.createDataFrame(
        [("r1", "u1", "b1", 5.0, "2021-01-02", "good"), ("r1", "u1", "b1", 5.0, "2021-01-02", "good"), ("r2", "u2", "b2", 1.0, "2021-02-03", "bad")],
        "review_id string, user_id string, business_id string, stars double, date string, text string",
    )
    places = spark.createDataFrame(
        [("b1", "One", "Reno", "NV", 39.5, -119.8, 4.0, 10, 1, "Food, Coffee , Tea, More"), ("b2", "Two", "Boise", "ID", 43.6, -116.2, 3.0, 5, 0, "Hair, Nails")],
        "business_id string, name string, city string, state string, latitude double, longitude double, stars double, review_count long, is_open long, categories string",
    )
    users = spark.createDataFrame([("u1", "Ann", 3, 4.5), ("u2", "Bo", 1, 1.0)], "user_id string, name string, review_count long, average_stars double")
    return reviews, places, users


@pytest.mark.parametrize("broadcast", [True, False])
def test_silver_join(spark, broadcast):
    rows = {r.review_id: r for r in silver.build_silver(*fixture(spark), broadcast).collect()}
    assert set(rows) == {"r1", "r2"}
    assert (rows["r1"].primary_industry, rows["r1"].secondary_industry, rows["r1"].tertiary_industry) == ("Food", "Coffee", "Tea")
    assert rows["r2"].tertiary_industry is None and rows["r2"].year_month == "2021-02" and rows["r1"].latitude == 39.5
    assert "categories" not in rows["r1"].asDict()


def test_industries_of_odd_lists(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "A"), (4, " A ,, B "), (5, "A,B,C,D,E")], "k int, categories string")
    got = {r.k: tuple(r)[1:] for r in silver.with_industries(df).collect()}
    assert got == {1: (None,) * 3, 2: (None,) * 3, 3: ("A", None, None), 4: ("A", None, "B"), 5: ("A", "B", "C")}
    assert silver.with_industries(df.drop("categories")).columns == ["k"]


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(f"r{i}",) for i in range(100)], "review_id string")
    for by in ("xxhash64", "md5"):
        sets = [{r.review_id for r in silver.sample_by_hash(df.repartition(n), 7, 42, by=by).collect()} for n in (1, 3, 9)]
        assert sets[0] == sets[1] == sets[2] and len(sets[0]) == 7
    assert silver.sample_by_hash(df, None).count() == 100 and silver.sample_by_hash(df, 500).count() == 100
    with pytest.raises(ValueError):
        silver.sample_by_hash(df, 0)


def test_scope_related(spark):
    chosen = spark.createDataFrame([("r1", "b1", "u1"), ("r2", None, "u1")], "review_id string, business_id string, user_id string")
    places = spark.createDataFrame([("b1", "x"), ("b2", "y"), (None, "z")], "business_id string, name string")
    assert [r.name for r in silver.scope_related(places, "business", chosen).collect()] == ["x"]
    assert silver.scope_related(places, "review", chosen) is chosen
    with pytest.raises(ValueError):
        silver.scope_related(places, "menu", chosen)


def test_joined_scan_and_prepared(spark, tmp_path):
    for n, df in zip("rpu", fixture(spark)):
        df.write.parquet(f"{tmp_path}/{n}")
    assert bronze.read_joined(spark, *(f"{tmp_path}/{n}" for n in "rpu")).count() == 2
    (tmp_path / "a.csv").write_text('id,text\n1,"two\nlines ""quoted"""\n')
    row = bronze.read_prepared(spark, str(tmp_path / "a.csv")).first()
    assert row.id == 1 and row.text == 'two\nlines "quoted"'
    with pytest.raises(ValueError):
        bronze.read_prepared(spark, "x", "orc")


def test_the_least_row_of_a_key_stays(spark):
    rows = [("k", 2, "a"), ("k", 1, "z"), ("k", 1, "b"), ("n", None, "x"), ("n", 0, "x"), (None, 1, "p"), (None, 1, "q")]
    for n in (1, 4):
        df = spark.createDataFrame(rows, "k string, v int, t string").repartition(n)
        got = silver.one_per_key(df, "k")
        assert got.columns == df.columns and sorted(map(tuple, got.collect()), key=str) == sorted([("k", 1, "b"), ("n", None, "x"), (None, 1, "p")], key=str)
    assert silver.one_per_key(spark.createDataFrame(rows, "k string, v int, t string").select("k"), "k").count() == 3


def test_unique_sides_are_not_shuffled_by_their_keys(spark):
    reviews, places, users = fixture(spark)
    plain = silver.build_silver(reviews.dropDuplicates(), places, users).orderBy("review_id").collect()
    known = silver.build_silver(reviews.dropDuplicates(), places, users, unique=silver.KEYS)
    assert known.orderBy("review_id").collect() == plain
    assert "Aggregate" not in silver.silver_side(places, "business", unique=True)._jdf.queryExecution().executedPlan().toString()


def test_hash_order_is_that_of_chained_xxhash64(spark):
    """The sample that no SQL twin covers, by another implementation of the hash."""
    import struct

    import xxhash

    ids = [f"r{i}" for i in range(300)] + ["", "é"]
    df = spark.createDataFrame([(i,) for i in ids], "review_id string")
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    first = xxhash.xxh64_intdigest(struct.pack("<i", 42), 42)
    want = sorted(ids, key=lambda i: (signed(xxhash.xxh64_intdigest(i.encode(), first)), i))[:25]
    assert {r.review_id for r in silver.sample_by_hash(df, 25, 42).collect()} == set(want)
