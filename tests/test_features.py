import math

import pytest
from pyspark.sql import functions as F

from lakemill.functions import features, labels, lexicon, scorers, text
from lakemill.operators import analytics, validate

TEXTS = [
    None, "", "   \n ", "http://only.url/x", "see www.site.org NOW!!! it isn't BAD, A1! OK I @me #tag ?", "café über don’t don't n't not 'no' \U0001f600",
    "One. Two! Three? four", "Word word WORD",
]


def test_linguistic(spark):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)], "review_id string, raw_review string")
    got = {int(r.review_id): r for r in text.linguistic(df).collect()}
    for i in range(4):
        r = got[i]
        assert (r.stripped_review, r.word_count, r.char_count, r.avg_word_len, r.sentence_count, r.type_token_ratio, r.num_caps) == ("", 0, 0, 0.0, 1, 0.0, 0)
    r = got[4]
    assert r.stripped_review == "see NOW!!! it isn't BAD, A1! OK I @me #tag ?" and r.word_count == 11
    assert (r.num_excl, r.num_ques, r.num_at, r.num_hash, r.num_caps, r.negation_count) == (4, 1, 1, 1, 4, 1)
    assert got[5].stripped_review.startswith("café über") and got[5].negation_count == 3
    assert got[6].sentence_count == 4 and got[7].type_token_ratio == 1.0


def test_labels(spark):
    df = spark.createDataFrame([(0.05, 0.55), (-0.05, 0.45), (0.0, 0.5), (None, None)], "vader_sentiment_score double, Valence_avg double")
    for c in ("vader_sentiment_score", "Valence_avg"):
        assert [r[0] for r in df.select(labels.sentiment_label(c)).collect()] == ["positive", "negative", "neutral", "neutral"]
    half = spark.createDataFrame([(0.12345,), (-0.12345,), (2.0,)], "x double")
    assert [r[0] for r in half.select(labels.round4(F.col("x"))).collect()] == [0.1235, -0.1235, 2.0]


def test_decay(spark):
    df = spark.createDataFrame([("a", 5.0, "2021-01-11"), ("b", 5.0, "2021-01-01"), ("c", None, "2021-01-01"), ("d", 3.0, "not a date"), ("e", 2.0, None)], "review_id string, stars double, review_date string")
    got = {r.review_id: r.weighted_star for r in features.with_decay(df).collect()}
    assert got == {"a": 5.0, "b": math.floor(5 * 0.998**10 * 1e4 + 0.5) / 1e4, "c": None, "d": 3.0, "e": 2.0}
    assert {r.weighted_star for r in features.with_decay(df.where("review_id = 'd'")).collect()} == {3.0}


def lex(spark):
    vad = spark.createDataFrame([("good", 0.5, 0.25, 0.125), ("null", -1.0, 0.0, 0.0)], "term string, valence double, arousal double, dominance double")
    emo = spark.createDataFrame([("good", True, None, True, 0.5), ("bad", None, True, None, None)], "term string, hit_joy boolean, hit_anger boolean, hit_positive boolean, int_joy double")
    more = spark.createDataFrame([("bad", True, -2.0, 0.75)], "term string, worry boolean, affect double, int_anger double")
    return lexicon.combine(vad, emo, more)


def test_lexicon_features(spark):
    df = spark.createDataFrame([("a", "Good good BAD other"), ("b", "nothing"), ("c", None), ("d", "null"), ("e", "good bad")], "review_id string, stripped_review string")
    got = {r.review_id: r for r in lexicon.lexicon_features(df, lex(spark)).collect()}
    a = got["a"]
    assert (a.Valence_avg, a.vad_matched_words, a.joy_count, a.anger_count, a.positive_count, a.worry_word_count) == (0.5, 2, 2, 1, 2, 1)
    assert (a.joy_int_avg, a.anger_int_avg, a.dominant_emotion) == (0.6667, 0.3333, "joy")
    assert (a.nrc_joy_lex, a.nrc_anger_lex, a.primary_emotion_lex, a.primary_emotion_lex_conf, a.secondary_emotion_lex) == (0.25, 0.1875, "joy", 0.5714, "anger")
    assert (a.affect_sentiment_avg, a.affect_matched_words) == (-2.0, 1)
    assert got["e"].dominant_emotion == "anger"  # a tie goes to the first
    for k in "bc":
        r = got[k]
        assert (r.dominant_emotion, r.primary_emotion_lex, r.primary_emotion_lex_conf, r.secondary_emotion_lex_conf, r.vad_matched_words, r.Valence_avg) == ("neutral", "neutral", 1.0, 0.0, 0, 0.0)
    assert got["d"].Valence_avg == -1.0


def test_groups_and_schema(spark):
    assert features.resolve_groups(["vad", "linguistic"]) == ("linguistic", "vad") and len(features.output_columns()) == 68
    assert features.output_columns(["vader"]) == ["vader_sentiment_score", "vader_pos", "vader_neu", "vader_neg"] and len(features.output_columns(use_transformers=True)) == 73
    for bad in ([], ["nope"]):
        with pytest.raises(ValueError):
            features.resolve_groups(bad)
    df = spark.createDataFrame([("a", "good bad", 4.0, "2021-01-01", 99)], "review_id string, raw_review string, stars double, review_date string, word_count int")
    out = features.apply_features(df, lex(spark))
    assert out.columns == ["review_id", "raw_review", "stars", "review_date", *features.output_columns()] and out.first().word_count == 2
    assert [f.dataType for f in out.schema][4:] == [f.dataType for f in features.generated_schema()]
    only = features.apply_features(df, lex(spark), ["vad"])
    assert only.columns[4:] == ["Valence_avg", "Arousal_avg", "Dominance_avg", "vad_matched_words"]
    with pytest.raises(ModuleNotFoundError):
        scorers.transformer_scorer(lambda t: (1, 0.5, "joy", 0.5), "no_such_package")


def test_plugged_scorer(spark):
    scorer = scorers.transformer_scorer(lambda t: (0, 0.75, "joy", 0.5), "json")
    df = spark.createDataFrame([("a", "some"), ("b", " "), ("c", None)], "review_id string, stripped_review string")
    got = {r.review_id: r for r in scorer(df).collect()}
    assert got["a"].hf_computed_sentiment == -0.75 and got["b"].hf_sentiment_label is None and got["c"].hf_emotion_label is None


def test_a_real_package_takes_a_scorer_place(spark):
    """Sentiment and entities by the regex package, in place of the native ones, through the feature groups."""
    pytest.importorskip("regex")

    def sentiment():
        import regex

        good, bad = regex.compile(r"\b(?:good|great|súper)\b", regex.I), regex.compile(r"\b(?:bad|awful)\b", regex.I)

        def one(text):
            p, n, words = len(good.findall(text)), len(bad.findall(text)), max(1, len(text.split()))
            return {"vader_sentiment_score": (p - n) / max(1, p + n), "vader_pos": p / words, "vader_neu": 1 - (p + n) / words, "vader_neg": n / words}

        return one

    def entities():
        import regex

        name = regex.compile(r"\p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+")
        return lambda text: {"person_count": len(name.findall(text)), "location_count": 0, "product_count": 0}

    plugged = scorers.pandas_scorer("regex", ", ".join(f"{c} double" for c in scorers.LexiconSentiment.columns), sentiment)
    names = scorers.pandas_scorer("regex", ", ".join(f"{c} long" for c in scorers.RuleEntities.columns), entities)
    df = spark.createDataFrame([("a", "Good food, súper, bad wine. Élan Vital", 5.0), ("b", None, None)], "review_id string, raw_review string, stars double")
    lex = lexicon.combine(spark.createDataFrame([("good", True)], "term string, hit_positive boolean"))
    out = features.apply_features(df, lex, ["vader", "entities"], sentiment=plugged, entities=names)
    assert out.columns == ["review_id", "raw_review", "stars", *features.output_columns(["vader", "entities"])]
    got = {r.review_id: r for r in out.collect()}
    assert got["a"].vader_sentiment_score == pytest.approx(1 / 3) and got["a"].vader_pos == pytest.approx(2 / 7) and got["a"].person_count == 1
    assert (got["b"].vader_neu, got["b"].person_count, got["b"].stars) == (1.0, 0, None)


def test_validation(spark):
    ok = spark.createDataFrame([("a",), ("b",)], "review_id string")
    assert validate.validate_bronze(ok, "review", "review_id") == 2
    for bad in (ok.union(ok), ok.limit(0), spark.createDataFrame([(None,)], "review_id string")):
        with pytest.raises(AssertionError):
            validate.validate_bronze(bad, "review", "review_id")
    assert validate.validate_bronze(ok.limit(0), "tip", "review_id", allow_empty=True) == 0 and validate.validate_bronze(ok.union(ok), "tip", "review_id") == 4
    with pytest.raises(ValueError):
        validate.validate_bronze(ok, "review", "other")
    assert validate.validate_parity_of_rows(ok, ok) == {"silver_rows": 2, "bronze_rows": 2}
    base = [(str(i), "w " * (i % 7 + 1), float(i % 5 + 1), i % 7 + 1, (i % 5) / 10, (i % 5) / 10, i % 2, 0.5, 0.5, (i % 5 + 1) * 0.9) for i in range(40)]
    cols = "review_id string, stripped_review string, stars double, word_count long, vader_sentiment_score double, Valence_avg double, worry_word_count long, wcst_warmth_avg double, affect_sentiment_avg double, weighted_star double"
    df = spark.createDataFrame(base, cols)
    with pytest.raises(AssertionError, match="constant"):
        validate.validate_silver(df)
    good = df.withColumns({"wcst_warmth_avg": F.rand(1), "affect_sentiment_avg": F.rand(2)})
    assert validate.validate_small(good)["row_count"] == 40
    for wrong in (
        good.withColumn("weighted_star", F.col("stars")), good.withColumn("vader_sentiment_score", -F.col("stars")), good.withColumn("word_count", F.lit(3).cast("long")),
        good.withColumn("worry_word_count", F.lit(0)), good.limit(0),
    ):
        with pytest.raises(AssertionError):
            validate.validate_silver(wrong)
    with pytest.raises(ValueError):
        validate.validate_small(good, most_rows=10)


def test_frames_compare(spark):
    a = spark.createDataFrame([("x", 1.0, "s"), ("y", None, None)], "review_id string, feature_a double, b string")
    validate.assert_same(a, a, "review_id", ["feature_a", "b"])
    near = a.withColumn("feature_a", F.col("feature_a") + 1e-8)
    validate.assert_same(a, near, "review_id", ["feature_a", "b"])
    for wrong in (a.fillna(0.0), a.withColumn("b", F.lit("t")), a.replace("x", "z", "review_id"), a.limit(1), a.union(a)):
        with pytest.raises(AssertionError):
            validate.assert_same(a, wrong, "review_id", ["feature_a", "b"])
    with pytest.raises(ValueError):
        validate.assert_same(a, a.drop("b"), "review_id", ["feature_a", "b"])
    with pytest.raises(AssertionError, match="b constant"):
        validate.validate_outputs({"t": a.select("review_id", F.lit(1).alias("b"))})


def test_undefined_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    for d in (df, df.limit(0), df.select(F.lit(None).cast("double").alias("x"), "y")):
        assert d.agg(validate.safe_corr(F.col("x"), F.col("y"))).first()[0] is None


def test_analytics(spark):
    rows = [(f"r{i}", f"b{i % 3}", float(i % 5 + 1), f"20{20 + i // 24}-{i // 2 % 12 + 1:02d}-05", "bad food awful" if i % 2 else "the fine place") for i in range(60)]
    df = spark.createDataFrame(rows, "review_id string, business_id string, stars double, review_date string, stripped_review string")
    gap = df.where("review_date NOT LIKE '2020-03%'")
    months = analytics.monthly_series(gap).orderBy("month").collect()
    assert len(months) == 30 and months[2].value == months[1].value
    ahead = analytics.forecast(analytics.monthly_series(gap)).where("kind = 'forecast'").orderBy("month").collect()
    assert len(ahead) == 6 and all(1 <= r.value <= 5 for r in ahead) and str(ahead[0].month) == "2022-07-01"
    short = analytics.forecast(analytics.monthly_series(df.where("review_date < '2020-06-01'")), 2).where("kind = 'forecast'").collect()
    assert len({r.value for r in short}) == 1
    assert analytics.forecast(analytics.monthly_series(df.limit(0))).count() == 0
    words = {r.word: r.frequency for r in analytics.pain_points(df).collect()}
    assert "the" not in words and words["bad"] > 0
    sample = analytics.stratified_sample(df, 20)
    assert sample.count() == 20 and {r["count"] for r in sample.groupBy("stars").count().collect()} == {4}
    assert analytics.stratified_sample(df, 500).count() == 60
    assert analytics.at_risk(df).count() == 3 and analytics.extreme_places(df, 2).count() == 4


def test_stream_of_months(spark, tmp_path):
    from lakemill.streaming.gold_stream import monthly_counts

    spark.createDataFrame([("2021-01-03 00:00:00", "b", 1.0), ("2021-01-04 00:00:00", "b", 4.0)], "ts string, business_id string, stars double").write.json(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, business_id string, stars double").json(f"{tmp_path}/in")
    q = monthly_counts(stream).writeStream.format("memory").queryName("months").outputMode("update").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [(r.review_count, r.avg_stars, r.low_star_rate) for r in spark.sql("SELECT * FROM months").collect()] == [(2, 2.5, 0.5)]


def test_owned_columns_are_replaced_for_every_document(spark, tmp_path):
    import hashlib
    import re

    from lakemill.plans import catalog, small  # noqa: F401  small adds to the catalog

    texts = ["good bad ugly", "one two three four five six seven", "longwords everywhere", "", None, "to be or not to be"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {int(r.review_id): r for r in catalog.QUERIES["p4_p6_owned_columns"](spark, str(tmp_path)).collect()}
    part = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:3], 16)
    positive = lambda w: len(w) <= 5 and part(w) % 10 % 2 == 0
    want = []
    for t in texts:
        words = re.findall("[a-z']+", t or "")
        want.append(math.floor(sum(map(positive, words)) / max(1, len(words)) * 1e4 + 0.5) / 1e4)
    assert [got[i].raw_review for i in range(6)] == texts and [got[i].vader_pos for i in range(6)] == want and any(want)


def test_numbers_of_the_input_stay_null(spark):
    rows = [("a", "good words", None, None), ("b", None, 4.0, 2), ("c", "x", 2.0, None)]
    df = spark.createDataFrame(rows, "review_id string, raw_review string, stars double, useful long").withColumn("review_date", F.lit("2020-01-01"))
    lex = lexicon.combine(spark.createDataFrame([("good", True)], "term string, hit_positive boolean"))
    got = {r.review_id: r for r in features.apply_features(df, lex).collect()}
    assert [(got[k].stars, got[k].useful, got[k].weighted_star) for k in "abc"] == [(None, None, None), (4.0, 2, 4.0), (2.0, None, 2.0)]
    assert [got[k].positive_count for k in "abc"] == [1, 0, 0]


def test_forecast_is_least_squares_on_differences(spark):
    """The same by normal equations solved with elimination, month by month."""
    import datetime
    import random

    r, y, d = random.Random(4), [3.0], [0.05, -0.1, 0.08, 0.02, -0.04]
    for _ in range(40):
        d.append(0.4 * d[-1] - 0.2 * d[-2] + 0.1 * d[-5] + r.uniform(-0.03, 0.03))
    for x in d:
        y.append(y[-1] + x)
    months = [datetime.date(2020 + i // 12, i % 12 + 1, 1) for i in range(len(y))]
    series = spark.createDataFrame(list(zip(months, y)), "month date, value double")
    got = [x for x in analytics.forecast(series, 6).orderBy("month").collect() if x.kind == "forecast"]
    rows = [(d[i - 5 : i][::-1], d[i]) for i in range(5, len(d))]
    a = [[sum(x[i] * x[j] for x, _ in rows) for j in range(5)] + [sum(x[i] * t for x, t in rows)] for i in range(5)]
    for i in range(5):
        a[i] = [v / a[i][i] for v in a[i]]
        for j in range(5):
            if j != i:
                a[j] = [v - a[j][i] * u for v, u in zip(a[j], a[i])]
    w, last, level, want = [x[5] for x in a], d[-5:], y[-1], []
    for _ in range(6):
        step = sum(p * q for p, q in zip(w, last[::-1]))
        last, level = [*last[1:], step], level + step
        want.append(min(5.0, max(1.0, level)))
    assert [x.value for x in got] == pytest.approx(want, abs=1e-6)
    assert [x.month for x in got][0] == datetime.date(2023, 11, 1)
    short = analytics.forecast(series.limit(11), 3).where("kind = 'forecast'").collect()
    assert len({x.value for x in short}) == 1


def test_counts_equal_their_patterns(spark):
    """Counts in Arrow batches against one regular expression each, over words of several scripts."""
    words = [
        "Abc", "Def", "in", "near", "xin", "In", "Ab12", "A1b2", "nation", "tion", "s", "cats", "ously", "ly", "able", "it's", "isn't", "NOT", "n't", "Été", "CAFÉ",
        "catś", "́abc", "_foo", "Kelvin", "İstanbul", "\U0001d400BC", "١٢", "X١", "OK", "B2B", "!", "?!", "a.b",
    ]
    seps = [" ", " ", " ", "", "\n", "  ", " ", ", "]
    texts = ["".join(words[(i * 7 + j * j * (i % 5 + 1)) % len(words)] + seps[(i + j * 3) % len(seps)] for j in range(i % 40)) for i in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *TEXTS])], "i int, raw_review string")
    df = text.linguistic(df).select("i", "raw_review", "stripped_review", "num_caps", "negation_count", "sentence_count", "type_token_ratio")
    df = scorers.SuffixGrammar()(scorers.RuleEntities()(df))
    t = F.col("stripped_review")
    found = lambda c, p: F.size(F.regexp_extract_all(c, F.lit(f"({p})"), 1))
    n = F.greatest(found(t, "\\S+"), F.lit(1))
    ws = text.words(t)
    want = {
        "stripped_review": F.trim(F.regexp_replace(F.coalesce("raw_review", F.lit("")), "(?U)http\\S+|www\\.\\S+|[\\s\\x1c-\\x1f]+", " ")),
        "sentence_count": F.greatest(found(t, "[^.!?]+(?:[.!?]+|$)"), F.lit(1)),
        "num_caps": F.size(F.filter(ws, lambda x: (x == F.upper(x)) & (x != F.lower(x)) & (F.length(x) > 1))),
        "negation_count": F.size(F.filter(text.tokens(t), lambda x: x.isin(*text.NEGATIONS))),
        "type_token_ratio": F.when(F.size(ws) == 0, 0.0).otherwise(labels.round4(F.size(F.array_distinct(ws)) / F.size(ws))),
        **{c: found(t, p) for c, p in zip(scorers.RuleEntities.columns, scorers.RuleEntities.patterns)},
        **{c: labels.round4(found(F.lower(t), f"\\b[a-z]+{e}\\b") / n) for c, e in zip(scorers.SuffixGrammar.columns, scorers.SuffixGrammar.endings)},
    }
    want["stripped_review"] = F.trim(F.regexp_replace(want["stripped_review"], " +", " "))
    got = df.agg(*[F.count_if(~F.col(c).eqNullSafe(w)).alias(c) for c, w in want.items()]).first().asDict()
    assert got == dict.fromkeys(want, 0)


def test_features_make_no_row_per_token(spark):
    """Neither tokens nor texts are dealt out: the counts of a text are made where it lies."""
    df = spark.createDataFrame([("a", "Good bad.", 3.0, "2020-01-01")], "review_id string, raw_review string, stars double, review_date string")
    groups = [g for g in features.DEFAULT_GROUPS if g != "time-weighting"]
    plan = features.apply_features(df, lex(spark), groups)._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Join" not in plan and "Exchange" not in plan


def test_repeated_terms_take_the_join(spark):
    """A lexicon with two rows of a term counts both, as the join does."""
    df = spark.createDataFrame([("a", "good bad")], "review_id string, stripped_review string")
    assert lexicon.lexicon_features(df, lex(spark).union(lex(spark))).first().worry_word_count == 2
