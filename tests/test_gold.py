import pytest

from lakemill.operators import filters, gold, serving, validate


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            ("r1", "b1", "u1", "Alpha Cafe", "Reno", "nv", 1.0, 2.0, "Food", "Coffee", None, 5.0, "2021-01-05", 0.8, "Joy", "joy"),
            ("r2", "b1", "u2", "Alpha  Cafe", "Reno ", "NV ", 1.0, 2.0, "Food", "Coffee", None, 1.0, "2021-01-20", -0.8, "anger", "anger"),
            ("r3", "b2", "u1", "Beta", "Boise", "ID", 3.0, 4.0, "Hair", None, None, 4.0, "2021-03-01", 0.0, "trust", "trust"),
            ("r4", "b3", "u3", "Gamma cafe", None, "  ", None, None, None, None, None, None, None, None, None, None),
            ("r5", None, None, None, "X", "TX", None, None, "Hair", "FOOD trucks", None, 2.0, "2022-01-01", 0.05, "JOY", None),
        ],
        "review_id string, business_id string, user_id string, name string, city string, state string, latitude double, longitude double, primary_industry string, "
        "secondary_industry string, tertiary_industry string, stars double, review_date string, vader_sentiment_score double, dominant_emotion string, primary_emotion_lex string",
    )


def ids(df):
    return sorted(r.review_id for r in df.collect())


def test_filters_alone_and_together(rows):
    f = lambda **o: ids(filters.apply_filter(rows, **o))
    assert f(business_names=[" ALPHA   cafe "]) == ["r1", "r2"] and f(business_names=["cafe", "beta"]) == ["r1", "r2", "r3", "r4"]
    assert f(business_names=[""]) == ["r1", "r2", "r3", "r4", "r5"] and f(business_ids=[]) == ["r1", "r2", "r3", "r4", "r5"]
    assert f(industries=["food"]) == ["r1", "r2", "r5"] and f(cities=["reno"]) == ["r1"] and f(states=["nv"]) == ["r1"]
    assert f(start_date="2021-01-20", end_date="2021-03-01") == ["r2", "r3"]
    assert f(sentiment_labels=["neutral"]) == ["r3", "r4"] and f(sentiment_labels=["positive"]) == ["r1", "r5"]
    assert f(emotion_labels=["joy"]) == ["r1", "r5"] and f(emotion_labels=["JOY"], emotion_column="primary_emotion_lex") == ["r1"]
    assert f(min_sentiment=0.0, max_sentiment=0.05) == ["r3", "r5"] and f(min_stars=2, max_stars=4) == ["r3", "r5"]
    assert f(industries=["food"], states=["tx"], start_date="2021-01-01", sentiment_labels=["positive"]) == ["r5"]


def test_filter_guards(rows):
    with pytest.raises(ValueError, match="city"):
        filters.apply_filter(rows.drop("city"), cities=["x"])
    with pytest.raises(ValueError, match="industry"):
        filters.apply_filter(rows.drop("primary_industry", "secondary_industry", "tertiary_industry"), industries=["x"])
    for bad in ({"start_date": "2022-01-02", "end_date": "2022-01-01"}, {"min_stars": 4, "max_stars": 3}, {"min_sentiment": 1, "max_sentiment": 0}, {"sentiment_column": "x"}, {"nope": 1}):
        with pytest.raises(ValueError):
            filters.apply_filter(rows, **bad)
    assert filters.priority_filter(rows, business_id="b1", state="ID")[1] == "business b1" and filters.priority_filter(rows)[1] == "all"


@pytest.mark.parametrize(
    ("level", "values"),
    [
        ("business", {"b1", "b2", "b3", None}), ("user", {"u1", "u2", "u3", None}), ("industry", {"Food", "Hair"}), ("state", {"NV", "ID", "TX"}),
        ("city-of-state", {"NV | Reno", "ID | Boise", "TX | X"}), ("sentiment", {"positive", "negative", "neutral"}), ("emotion", {"joy", "anger", "trust"}),
    ],
)
def test_grains(rows, level, values):
    out = gold.build_gold(rows, level)
    assert {r.gold_variant_value for r in out.collect()} == values and out.count() == len(values)
    assert validate.validate_gold(out, level)["gold_rows"] == len(values)


def test_grain_values(rows):
    by = {r.business_id: r for r in gold.build_gold(rows, "business").collect()}
    assert (by["b1"].review_count, by["b1"].low_star_rate, by["b1"].avg_stars, by["b1"].unique_user_count) == (2, 0.5, 3.0, 2)
    assert by["b3"].low_star_rate == 0.0 and by["b3"].avg_stars is None and by[None].business_name is None and by[None].city is None
    assert "avg_word_count" not in gold.build_gold(rows, "state").columns
    for p, n in zip(gold.PERIODS, (4, 4, 3, 2, 2)):
        assert gold.build_gold(rows, "date", period=p).count() == n
    assert "centroid_latitude" not in gold.build_gold(rows.drop("latitude"), "city-of-state").columns
    plain = gold.build_gold(rows.drop("latitude"), "business").first()
    assert plain.latitude is None
    for bad in ({"level": "planet"}, {"level": "date", "period": "hour"}, {"level": "sample"}, {"level": "brand-sample", "size": 3}, {"level": "brand-sample", "brands": ["a"]}):
        with pytest.raises(ValueError):
            gold.build_gold(rows, **bad)


def test_brand_sample(rows):
    out = gold.build_gold(rows, "brand-sample", 1, 7, ["cafe", "Alpha Cafe", "none"])
    assert {r.gold_variant_value: r["gold_sample_seed"] for r in out.collect()} == {"cafe": 7, "Alpha Cafe": 7}
    with pytest.raises(AssertionError, match="none"):
        validate.validate_gold(out, "brand-sample", 1, ["cafe", "none"])
    a = [ids(gold.brand_sample(rows.repartition(n), ["cafe"], 2)) for n in (1, 4)]
    assert a[0] == a[1] and len(a[0]) == 2
    assert gold.effective_size(None, 3) is None and gold.effective_size(5, 3) == 3
    for bad in ((0, 3), (1, -1)):
        with pytest.raises(ValueError):
            gold.effective_size(*bad)


def test_serving(spark):
    g = spark.createDataFrame(
        [
            ("r1", "p1", "One", "Reno", "NV", 1.0, 2.0, "Food", 5.0, "2021-01", "2021-01-01", 0.8, 0.1, 0.1, 0.1, 0.1, "sample", "v"),
            ("r2", "p1", "One", "Reno", "NV", 1.0, 2.0, "Food", 1.0, None, "2021-02-01", -0.8, 0.1, 0.1, 0.1, 0.1, "sample", "v"),
            ("r3", "p2", "Two", "Reno", "NV", None, None, "Hair", 4.0, "2021-01", "2021-01-09", 0.5, 0.0, 0.0, 0.0, 0.2, "sample", "v"),
        ],
        "review_id string, business_id string, name string, city string, state string, latitude double, longitude double, primary_industry string, stars double, year_month string, "
        "review_date string, vader_sentiment_score double, anger_int_avg double, fear_int_avg double, sadness_int_avg double, joy_int_avg double, gold_variant_level string, gold_variant_value string",
    )
    serving.check_row_level(g)
    s = {r.business_id: r for r in serving.business_summary(g).collect()}
    assert (s["p1"].risk_score, s["p1"].attention_tier, s["p1"].avg_weighted_star) == (0.4, "moderate", None)
    assert s["p1"].recommended_focus == "Review recurring low-star pain points"
    assert (s["p2"].risk_score, s["p2"].attention_tier, s["p2"].recommended_focus) == (0.1125, "monitor", "Maintain performance and monitor trends")
    months = serving.monthly_summary(g)
    assert {(r.year_month, r.primary_industry) for r in months.collect()} == {("2021-01", "Food"), ("2021-02", "Food"), ("2021-01", "Hair")}
    assert validate.validate_serving(serving.business_summary(g), months) == {"businesses": 2, "keys": 2}
    assert serving.dashboard_filter(serving.business_summary(g), 1, mapped=True).count() == 1
    roll = serving.state_rollup(serving.business_summary(g)).first()
    assert roll.review_count == 3 and abs(roll.avg_stars - 10 / 3) < 1e-9
    for wrong, error in ((g.drop("stars"), ValueError), (g.limit(0), AssertionError), (g.replace("sample", "state", "gold_variant_level"), ValueError)):
        with pytest.raises(error):
            serving.check_row_level(wrong)
