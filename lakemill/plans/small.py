"""Queries for inventory rows that are a part of a larger operator, each on its own."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakemill.functions import features, labels, lexicon, text
from lakemill.operators import analytics, gold, materialize, measures, serving, silver, validate
from lakemill.plans import catalog as c
from lakemill.plans.adapters import featured, places, silver as silver_table, table
from lakemill.sources import bronze, lexicons, names, sinks

FT, S, ROWS = c.FT, c.S, c.ROWS_SQL
add = c.add


def _lines(spark: SparkSession, name: str, body: str) -> str:
    """A small text file in the scratch folder, written by Spark."""
    at = c.scratch(spark, name)
    spark.createDataFrame([(x,) for x in body.split("\n")], "value string").coalesce(1).write.text(at)
    return at


# ---------------------------------------------------- projections and shims


@add("p2_year_month", f"{S} SELECT year_month, count(*) AS n FROM silver GROUP BY year_month")
def _(spark, d):
    return silver_table(spark, d).groupBy("year_month").agg(F.count("*").alias("n"))


_SHARE = c._round4("(positive_count::DOUBLE / greatest(len(ws), 1))")


@add(
    "p4_p6_owned_columns",
    f"{c.LEXICON_SQL} SELECT s.review_id, d.text AS raw_review, {_SHARE} AS vader_pos "
    "FROM shaped s JOIN w USING (review_id) JOIN documents d ON CAST(d.doc_id AS VARCHAR) = s.review_id",
)
def _(spark, d):
    """Owned columns of the input are replaced, not kept: every document."""
    docs = c.documents_as_reviews(spark, d).withColumn("vader_pos", F.lit("old"))
    return features.apply_features(docs, c.synthetic_lexicon(spark, d), ["vader"]).select("review_id", "raw_review", "vader_pos")


@add("p7_sentiment_labels", f"{FT} SELECT {c.VADER} AS vader_label, {c.VALENCE} AS valence_label, count(*) AS n FROM featured GROUP BY 1, 2")
def _(spark, d):
    f = featured(spark, d).select(labels.sentiment_label("vader_sentiment_score").alias("vader_label"), labels.sentiment_label("Valence_avg").alias("valence_label"))
    return f.groupBy("vader_label", "valence_label").agg(F.count("*").alias("n"))


@add("p8_emotion_labels", f"{FT} SELECT DISTINCT lower(dominant_emotion) AS emotion FROM featured WHERE dominant_emotion IS NOT NULL")
def _(spark, d):
    return gold.aggregate(featured(spark, d), "emotion").select(F.col("emotion_label").alias("emotion"))


@add("p9_places_cleaned", "WITH places AS (" + c.duck(c.PLACES) + ") SELECT DISTINCT upper(trim(state)) AS state, trim(city) AS city FROM places WHERE trim(state) <> '' AND trim(city) <> ''")
def _(spark, d):
    p = places(spark, d).select(F.upper(F.trim("state")).alias("state"), F.trim("city").alias("city"))
    return p.where("state <> '' AND city <> ''").distinct()


@add("p10_quarters", f"{FT} SELECT DISTINCT strftime(date_trunc('quarter', review_date), '%Y-%m-%d') AS q FROM featured WHERE review_date IS NOT NULL")
def _(spark, d):
    return gold.aggregate(featured(spark, d), "date", period="quarter").select(F.date_format("date_period", "yyyy-MM-dd").alias("q"))


@add("p11_variant_values", f"{FT} SELECT DISTINCT concat_ws(' | ', upper(trim(state)), trim(city)) AS v FROM featured WHERE trim(state) <> '' AND trim(city) <> ''")
def _(spark, d):
    return gold.aggregate(featured(spark, d), "city-of-state").select(F.col("gold_variant_value").alias("v"))


@add("p12_missing_columns", ROWS + " SELECT gold_variant_value, business_id, CAST(NULL AS DOUBLE) AS avg_weighted_star, CAST(NULL AS DOUBLE) AS latitude FROM g GROUP BY 1, 2")
def _(spark, d):
    out = serving.business_summary(c._row_gold(spark, d).drop("weighted_star", "latitude"))
    return out.select("gold_variant_value", "business_id", "avg_weighted_star", "latitude")


@add("p13_month_of_date", ROWS + " SELECT strftime(review_date, '%Y-%m') AS year_month, count(*) AS n FROM g GROUP BY 1")
def _(spark, d):
    monthly = serving.monthly_summary(c._row_gold(spark, d).drop("year_month"))
    return monthly.groupBy("year_month").agg(F.sum("review_count").alias("n"))


@add("p14_risk", c.SUMMARY_SQL + " SELECT business_id, gold_variant_value, risk_score, attention_tier, recommended_focus FROM summary")
def _(spark, d):
    return c._summary(spark, d).select("business_id", "gold_variant_value", "risk_score", "attention_tier", "recommended_focus")


@add("f12_f13_guards", "SELECT 'missing column' AS guard, true AS raised UNION ALL SELECT 'date range', true UNION ALL SELECT 'star range', true")
def _(spark, d):
    from lakemill.operators.filters import apply_filter

    df, out = table(spark, d, "region"), []
    for name, options in (("missing column", {"cities": ["x"]}), ("date range", {"start_date": "2", "end_date": "1"}), ("star range", {"min_stars": 3, "max_stars": 2})):
        try:
            apply_filter(df, **options)
            out.append((name, False))
        except ValueError:
            out.append((name, True))
    return spark.createDataFrame(out, "guard string, raised boolean")


# --------------------------------------------------------- joins, aggregates


@add("j4_metrics_with_dimensions", f"{FT} SELECT business_id, count(review_id) AS review_count, min(CASE WHEN business_id IS NOT NULL THEN name END) AS business_name FROM featured GROUP BY business_id")
def _(spark, d):
    return gold.aggregate(featured(spark, d), "business").select("business_id", "review_count", "business_name")


@add("j5_centroids", f"{FT} SELECT upper(trim(state)) AS state, trim(city) AS city, avg(latitude) AS centroid_latitude, avg(longitude) AS centroid_longitude FROM featured WHERE trim(state) <> '' AND trim(city) <> '' GROUP BY 1, 2")
def _(spark, d):
    return gold.aggregate(featured(spark, d), "city-of-state").select("state", "city", "centroid_latitude", "centroid_longitude")


@add("j6_n1_reviews_with_place_profile", f"{FT}, p AS (SELECT business_id, avg(stars) AS business_star_avg, count(review_id) AS place_reviews FROM featured WHERE business_id IS NOT NULL GROUP BY 1) SELECT review_id, stars, business_star_avg, place_reviews FROM featured LEFT JOIN p USING (business_id)")
def _(spark, d):
    return analytics.with_place_figures(featured(spark, d)).select("review_id", "stars", "business_star_avg", "place_reviews")


@add("a1_metrics", f"{FT} SELECT is_open, {c.METRIC_SQL} FROM featured GROUP BY is_open")
def _(spark, d):
    f = featured(spark, d)
    return measures.grouped(f, measures.Grouping(("is_open",), measures.present(f, gold.METRICS), distinct=gold.DISTINCT))


@add("a15_min_max", f"{FT} SELECT min(stars) AS min_stars, max(stars) AS max_stars, min(word_count) AS min_word_count, max(word_count) AS max_word_count, min(vader_sentiment_score) AS min_score, max(vader_sentiment_score) AS max_score FROM featured")
def _(spark, d):
    f = featured(spark, d).withColumnRenamed("vader_sentiment_score", "score")
    return f.agg(*[e for c in ("stars", "word_count", "score") for e in validate.extremes(c)])


@add("a16_shares", f"{FT} SELECT avg(CASE WHEN word_count <> 0 THEN 1.0e0 ELSE 0.0e0 END) AS nonzero, avg(CASE WHEN weighted_star = stars THEN 1.0e0 ELSE 0.0e0 END) AS same FROM featured")
def _(spark, d):
    got = validate.silver_measures(featured(spark, d).withColumn("worry_word_count", F.col("word_count")), "raw_review")
    return got.select(F.col("nonzero_worry_word_count").alias("nonzero"), F.col("same_weighted_star").alias("same"))


@add("l6_effective_size", f"{S}, n AS (SELECT count(*) AS n FROM silver) SELECT n AS eligible, least(500, n) AS size FROM n")
def _(spark, d):
    n = silver_table(spark, d).count()
    return spark.createDataFrame([(n, gold.effective_size(500, n))], "eligible long, size long")


@add("l11_row_cap", "SELECT least(count(*), 100) AS n FROM documents")
def _(spark, d):
    return c.documents_as_reviews(spark, d).limit(100).agg(F.count("*").alias("n"))


# ------------------------------------------------------------- text features

for _name, _columns in {
    "t3_word_count": ("word_count",), "t4_characters": ("char_count", "avg_word_len"), "t5_sentences": ("sentence_count", "avg_sentence_len"),
    "t6_marks": ("num_excl", "num_ques", "num_at", "num_hash"), "t7_capitals": ("num_caps",), "t8_negations": ("negation_count",), "t16_type_token_ratio": ("type_token_ratio",),
}.items():
    add(_name, f"SELECT review_id, {', '.join(_columns)} FROM ({c.LINGUISTIC_SQL})")(
        lambda spark, d, cols=_columns: text.linguistic(c.documents_as_reviews(spark, d)).select("review_id", *cols)
    )
for _name, _columns in {
    "t11_dominant_emotion": ("dominant_emotion",), "t12_vad": ("Valence_avg", "Arousal_avg", "Dominance_avg", "vad_matched_words"), "t17_worry": ("worry_word_count",),
    "t18_social": tuple(f"wcst_{x}_avg" for x in lexicon.SOCIAL), "t19_affect": ("affect_sentiment_avg", "affect_matched_words"),
    "t20_intensities": tuple(f"nrc_{e}_lex" for e in labels.EMOTIONS), "t21_lexicon_emotions": ("primary_emotion_lex", "primary_emotion_lex_conf", "secondary_emotion_lex", "secondary_emotion_lex_conf"),
}.items():
    add(_name, f"SELECT review_id, {', '.join(_columns)} FROM ({c.LEXICON_SQL + c.LEXICON_SELECT})")(
        lambda spark, d, cols=_columns: c.QUERIES["t10_t21_lexicon_features"](spark, d).select("review_id", *cols)
    )


@add("d1_d2_pandas_surface", c.TEXT_SQL + " SELECT review_id, CAST(length(t) AS BIGINT) AS n FROM w")
def _(spark, d):
    """A plugged scorer (Arrow batches, one model per worker)."""
    from lakemill.functions.scorers import pandas_scorer

    docs = c.documents_as_reviews(spark, d).select("review_id", text.clean(F.col("raw_review")).alias("stripped_review"))
    return pandas_scorer("json", "n long", lambda: lambda t: {"n": len(t)})(docs).select("review_id", "n")


# ------------------------------------------------------------------ lexicons


@add("t24_worry_lexicon", "SELECT * FROM (VALUES ('null'), ('fear')) t(term)")
def _(spark, d):
    return lexicons.load_worry(spark, _lines(spark, "worry", "Term\tMajorityLabel\nnull\t2\ncalm\t1\nFear\t3")).select("term")


@add("t25_social_lexicon", "SELECT 'null' AS term, 0.25::DOUBLE AS social_warmth, 0.5::DOUBLE AS social_trust")
def _(spark, d):
    at = _lines(spark, "social", "term\twarmth (W)\tcompetence (C)\tsociability (S)\ttrust (T)\nnull\t0.25\t0\t0\t0.5")
    return lexicons.load_social(spark, at).select("term", "social_warmth", "social_trust")


@add("t26_affect_lexicon", "SELECT * FROM (VALUES ('good', 2.5::DOUBLE), ('null', -1.0::DOUBLE)) t(term, affect)")
def _(spark, d):
    return lexicons.load_affect(spark, _lines(spark, "affect", "good\t1.5\tx\nshort\nbad\tno number\ngood\t2.5\nnull\t-1"))


@add("t27_intensity_lexicon", "SELECT * FROM (VALUES ('null', 0.75::DOUBLE, NULL::DOUBLE), ('sun', NULL::DOUBLE, 0.5::DOUBLE)) t(term, int_joy, int_fear)")
def _(spark, d):
    return lexicons.load_intensity(spark, _lines(spark, "intensity", "null\tjoy\t0.5\nnull\tjoy\t0.75\nsun\tfear\t0.5")).select("term", "int_joy", "int_fear")


@add("t28_t29_s9_vad_lexicon", "SELECT * FROM (VALUES ('null', 0.5::DOUBLE), ('sun', 1.0::DOUBLE)) t(term, valence)")
def _(spark, d):
    return lexicons.load_vad(spark, _lines(spark, "vad", "term\tvalence\tarousal\tdominance\nnull\t0.5\t0\t0\ntwo words\t1\t1\t1\nSun\t1\t0\t0")).select("term", "valence")


@add("s4_staged_file", "SELECT 1 AS files, 5 AS characters")
def _(spark, d):
    at = _lines(spark, "staged", "body")
    name = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(at).select("path").first().path.rsplit("/", 1)[1]
    with bronze.staged(spark, at, [name]) as got:
        n = len(open(got[name], encoding="utf-8").read())
    return spark.createDataFrame([(len(got), n)], "files int, characters int")


# --------------------------------------------------------- sinks, resources


@add("k3_k7_external_table", "SELECT n_nationkey, n_name FROM nation")
def _(spark, d):
    sinks.ensure_schema(spark, "lakemill_check")
    at, name = c.scratch(spark, "external"), f"lakemill_check.t_{materialize.new_run_id()}"
    sinks.save_external(table(spark, d, "nation").select("n_nationkey", "n_name"), at, name)
    spark.sql(f"DROP TABLE {names.quote_table(name)}")  # external: the files stay
    return spark.read.parquet(at)


@add("k4_json_sink", "SELECT c_custkey, c_name FROM customer")
def _(spark, d):
    at = c.scratch(spark, "json")
    sinks.write(table(spark, d, "customer").select("c_custkey", "c_name"), at, "json")
    return bronze.read_json(spark, "c_custkey long, c_name string", at)


@add("k4_parquet_sink", "SELECT s_suppkey, s_name FROM supplier")
def _(spark, d):
    at = c.scratch(spark, "parquet")
    for _ in range(2):  # the second write replaces the first
        sinks.write(table(spark, d, "supplier").select("s_suppkey", "s_name"), at, "parquet")
    return bronze.read_prepared(spark, at, "parquet")


@add("k6_run_log", """SELECT '{"metrics": "{\\"rows\\": null}", "run": 1}' AS record_json""")
def _(spark, d):
    at = c.scratch(spark, "log")
    sinks.log_run({"run": 1, "metrics": {"rows": None}}, at if "://" in at else f"file://{at}", spark)
    return spark.read.json(at)


@add("l8_priority_order", c.SUMMARY_SQL + " SELECT gold_variant_value, business_id, row_number() OVER (ORDER BY risk_score DESC, review_count DESC, gold_variant_value, business_id NULLS FIRST) AS place FROM summary ORDER BY place LIMIT 100")
def _(spark, d):
    """The list's own order, as its first rows are read."""
    first = serving.priority_list(c._summary(spark, d)).limit(100).select("gold_variant_value", "business_id").collect()
    return spark.createDataFrame([(*r, i) for i, r in enumerate(first, 1)], "gold_variant_value string, business_id string, place long")


@add("k8_k9_names", "SELECT '`c`.`s`.`t`' AS quoted, 's3://b/x/y' AS joined, true AS refused")
def _(spark, d):
    try:
        names.identifier("a; DROP TABLE x")
        refused = False
    except ValueError:
        refused = True
    return spark.createDataFrame([(names.quote_table("c.s.t"), names.join_path("s3://b/x/", "/y"), refused)], "quoted string, joined string, refused boolean")


@add("m1_m6_kept_frames", "SELECT mode, count(*) AS n FROM orders, (VALUES ('persist'), ('table'), ('none')) m(mode) GROUP BY mode")
def _(spark, d):
    out = []
    for mode in ("persist", "table", "none"):
        with materialize.Kept(spark, mode) as kept:
            kept.keep(table(spark, d, "orders"), "orders")
            out.append((mode, kept.counts["orders"]))
    return spark.createDataFrame(out, "mode string, n long")


# ----------------------------------------------------- dashboard, validation


@add("s10_dashboard_reads", c.MONTHLY_SQL + " SELECT year_month, gold_variant_value, review_count FROM monthly WHERE year_month IS NOT NULL AND primary_industry IS NULL")
def _(spark, d):
    spark_monthly = c._monthly(spark, d)
    return spark.sql("SELECT year_month, gold_variant_value, review_count FROM {m} WHERE year_month IS NOT NULL AND primary_industry IS NULL", m=spark_monthly)


@add("v3_v5_gates_refuse", "SELECT 'constant' AS fault, true AS refused UNION ALL SELECT 'no decay', true UNION ALL SELECT 'empty', true")
def _(spark, d):
    """Through the gate for tables of any size: the one for small tables refuses, by its bound, a table beyond 500,000 rows."""
    f = featured(spark, d).select("stars", "vader_sentiment_score", "weighted_star")
    out = []
    for name, df in (("constant", f.withColumn("vader_sentiment_score", F.lit(0.5))), ("no decay", f.withColumn("weighted_star", F.col("stars"))), ("empty", f.limit(0))):
        try:
            validate.validate_silver(df)
            out.append((name, False))
        except AssertionError:
            out.append((name, True))
    return spark.createDataFrame(out, "fault string, refused boolean")


@add("v8_serving_keys", c.SUMMARY_SQL + " SELECT count(*) AS places, count(DISTINCT (gold_variant_value, coalesce(business_id, ''))) AS keys FROM summary")
def _(spark, d):
    got = validate.validate_serving(c._summary(spark, d), c._monthly(spark, d))
    return spark.createDataFrame([(got["businesses"], got["keys"])], "places long, keys long")


@add("n4_diagnosis", c.AT_RISK + " SELECT count(*) AS places, count(*) FILTER (at_risk_flag) AS flagged, min(decline) AS least, max(decline) AS most FROM flagged")
def _(spark, d):
    from lakemill.operators.analytics import at_risk

    return at_risk(featured(spark, d)).agg(F.count("*").alias("places"), F.count_if("at_risk_flag").alias("flagged"), F.min("decline").alias("least"), F.max("decline").alias("most"))


@add("a17_uniqueness_probe", "SELECT count(*) > 0 AS repeats FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)")
def _(spark, d):
    return validate.repeats(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@add("j3_scope_tips", f"{S}, {c.PICK} SELECT event_id FROM events WHERE CAST(user_id AS VARCHAR) IN (SELECT user_id FROM picked)")
def _(spark, d):
    picked = silver.sample_by_hash(silver_table(spark, d), 500, 42, by="md5")
    events = table(spark, d, "events").withColumn("user_id", F.col("user_id").cast("string"))
    return silver.scope_related(events, "user", picked).select("event_id")



TIPS = "tips AS (SELECT event_id, CAST(user_id % 1000 AS VARCHAR) AS business_id FROM events)"


@add("j3_scope_tips_of_places", f"{S}, {c.PICK}, {TIPS} SELECT event_id, business_id FROM tips SEMI JOIN picked USING (business_id)")
def _(spark, d):
    picked = silver.sample_by_hash(silver_table(spark, d), 500, 42, by="md5")
    tips = table(spark, d, "events").select("event_id", (F.col("user_id") % 1000).cast("string").alias("business_id"))
    return silver.scope_related(tips, "tip", picked).select("event_id", "business_id")


@add("j3_scope_checkins", f"{S}, {c.PICK} SELECT l_orderkey, l_linenumber, CAST(l_partkey % 1000 AS VARCHAR) AS business_id FROM lineitem WHERE CAST(l_partkey % 1000 AS VARCHAR) IN (SELECT business_id FROM picked)")
def _(spark, d):
    picked = silver.sample_by_hash(silver_table(spark, d), 500, 42, by="md5")
    visits = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 1000).cast("string").alias("business_id"))
    return silver.scope_related(visits, "checkin", picked).select("l_orderkey", "l_linenumber", "business_id")


@add(
    "m4_m5_m6_d4_resources",
    "SELECT * FROM (VALUES ('scratch table is read', true), ('scratch table is gone after release', true), ('a failed clean-up is a warning', true), "
    "('run ids differ', true), ('arrow options are set', true), ('the session is local', true), ('a remote session keeps tables', true)) t(what, holds)",
)
def _(spark, d):
    nation = table(spark, d, "nation")
    kept = materialize.Kept(spark, "table")
    read = kept.keep(nation, "nation").count() == nation.count()
    name = f"_scratch_nation_{kept.run_id}"
    there = spark.catalog.tableExists(f"default.{name}")
    kept._undo.insert(0, ("broken", lambda: 1 / 0))
    warnings = kept.release()
    arrow = materialize.configure_arrow(spark, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
    rows = [
        ("scratch table is read", read), ("scratch table is gone after release", there and not spark.catalog.tableExists(f"default.{name}")),
        ("a failed clean-up is a warning", [w.split(":")[0] for w in warnings] == ["broken"]), ("run ids differ", materialize.new_run_id() != kept.run_id),
        ("arrow options are set", all(arrow.values())), ("the session is local", not materialize.is_connect(spark)),
        ("a remote session keeps tables", materialize.resolve_mode("auto", True) == "table"),
    ]
    return spark.createDataFrame(rows, "what string, holds boolean")


@add(
    "t30_lexicon_paths",
    "SELECT * FROM (VALUES ('vad', 'own/vad.txt'), ('worry', 's3://b/lex/worry.tsv'), ('wcst', 's3://b/lex/wcst.tsv'), ('affect', 's3://b/lex/affect.tsv'), "
    "('intensity', 's3://b/lex/intensity.tsv'), ('missing', 'missing lexicons: give a folder or --worry, --wcst, --affect, --intensity')) t(lexicon, path)",
)
def _(spark, d):
    rows = list(lexicons.resolve_paths("s3://b/lex", vad="own/vad.txt").items())
    try:
        lexicons.resolve_paths(vad="own/vad.txt")
    except SystemExit as e:
        rows.append(("missing", str(e)))
    return spark.createDataFrame(rows, "lexicon string, path string")
