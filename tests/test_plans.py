"""The plans are the ones meant: pushdown, pruning, top-k, rank limits, one aggregation."""

import pytest

from lakemill.operators import filters, gold, silver


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "t")
    spark.createDataFrame(
        [(str(i), f"b{i % 5}", f"u{i}", f"Name {i % 5}", "Reno", "NV", float(i % 5 + 1), f"2021-01-{i % 28 + 1:02d}", "x" * 50) for i in range(200)],
        "review_id string, business_id string, user_id string, name string, city string, state string, stars double, review_date string, raw_review string",
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(filters.apply_filter(stored, business_ids=["b1", "b2"], min_stars=2.0).select("review_id"))
    assert "In(business_id, [b1,b2])" in text and "GreaterThanOrEqual(stars,2.0)" in text
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "raw_review" not in schema and "city" not in schema


def test_samples_are_top_k(stored):
    assert "TakeOrderedAndProject" in plan(silver.sample_by_hash(stored, 5))
    assert "WindowGroupLimit" in plan(gold.brand_sample(stored, ["name"], 3))


def test_a_grain_reads_once_and_does_not_join(stored):
    text = plan(gold.build_gold(stored, "business"))
    assert text.count("Scan parquet") == text.count("(1) Scan parquet") * 2 and "Join" not in text
    assert "raw_review" not in text.split("ReadSchema: ")[1].splitlines()[0]


def test_scoping_is_a_semi_join(spark, stored):
    text = plan(silver.scope_related(stored, "user", stored.limit(10)))
    assert "LeftSemi" in text
