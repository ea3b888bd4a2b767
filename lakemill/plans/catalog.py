"""Every registered query by inventory id, and its SQL twin for DuckDB.

Queries are thin: they feed the operators with the adapted tables. Where a
result depends on a hash that DuckDB lacks, the query uses the md5 order.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions import features, labels, lexicon, scorers, text
from lakemill.operators import analytics, filters, gold, serving, silver, validate
from lakemill.plans.adapters import FEATURED_SQL, PLACES, REVIEWS, SILVER_SQL, USERS, duck, featured, places, reviews, table, tables, users
from lakemill.plans.adapters import silver as silver_table
from lakemill.sources import bronze, sinks
from lakemill.sources.names import join_path
from lakemill.sources.scan import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def add(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder (on a local master a temporary one, if unset)."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not spark.sparkContext.isLocal():
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = root or tempfile.mkdtemp(prefix="lakemill")
    return join_path(root, f"{name}-{uuid.uuid4().hex}")


S, FT = "WITH " + SILVER_SQL, "WITH " + FEATURED_SQL
REVIEW_COLUMNS = "review_id, user_id, business_id, stars, useful, funny, cool, text, date"

# ---------------------------------------------------------------- scans, sinks


@add("s1_k1_json_to_parquet", f"WITH reviews AS ({duck(REVIEWS)}) SELECT {REVIEW_COLUMNS} FROM reviews")
def _(spark, d):
    """Write JSON lines with an extra field, convert them once, read Bronze."""
    at = scratch(spark, "bronze")
    reviews(spark, d).withColumn("unknown", F.lit(1)).write.json(f"{at}/review.json")
    sinks.convert(spark, bronze.DATASETS["review"], f"{at}/review.json", f"{at}/review", partitions=4)
    return bronze.read_bronze(spark, "review", at).drop("_source_file", "_ingested_at")


@add("s2_bronze_scan", f"WITH reviews AS ({duck(REVIEWS)}) SELECT review_id, stars, date, true AS has_source FROM reviews")
def _(spark, d):
    at = scratch(spark, "bronze")
    reviews(spark, d).select(*bronze.DATASETS["review"].schema.names).write.parquet(f"{at}/review")
    return bronze.read_bronze(spark, "review", at).select("review_id", "stars", "date", F.contains("_source_file", F.lit("/review/")).alias("has_source"))


@add("s3_found_json", f"WITH users AS ({duck(USERS)}) SELECT user_id, name, CAST(review_count AS BIGINT) AS review_count, average_stars FROM users")
def _(spark, d):
    at = scratch(spark, "found")
    users(spark, d).coalesce(1).write.json(f"{at}/deep/down")
    name = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(f"{at}/deep/down").select("path").first().path.rsplit("/", 1)[1]
    path = bronze.find_one(spark, at, name)
    return bronze.read_json(spark, bronze.DATASETS["user"].schema, path).select("user_id", "name", "review_count", "average_stars")


@add("s5_prepared_csv", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(spark, d):
    at = scratch(spark, "csv")
    sinks.write(table(spark, d, "nation"), at, "csv")
    return bronze.read_prepared(spark, at)


@add("s6_prepared_parquet", "SELECT c_custkey, c_mktsegment FROM customer")
def _(spark, d):
    return bronze.read_prepared(spark, f"{d}/customer.parquet", "parquet").select("c_custkey", "c_mktsegment")


@add("s7_k2_catalog_table", "SELECT r_regionkey, r_name FROM region")
def _(spark, d):
    name = f"scan_{uuid.uuid4().hex}"
    sinks.save_table(table(spark, d, "region"), f"default.{name}")
    at = scratch(spark, "scanned")
    spark.table(f"default.{name}").write.parquet(at)
    spark.sql(f"DROP TABLE default.{name}")
    return spark.read.parquet(at)


@add("s8_joined_scan", f"{S} SELECT review_id, stars, name, user_name FROM silver")
def _(spark, d):
    at = scratch(spark, "joined")
    for name, df in (("r", reviews(spark, d)), ("p", places(spark, d)), ("u", users(spark, d))):
        df.write.parquet(f"{at}/{name}")
    return bronze.read_joined(spark, f"{at}/r", f"{at}/p", f"{at}/u").select("review_id", "stars", "name", "user_name")


@add(
    "k5_audit_rows",
    """SELECT 'ingest' AS task, 'succeeded' AS outcome, '{"rows": ' || count(*) || '}' AS metrics_json, true AS stamped FROM region """
    """UNION ALL SELECT 'gold', 'failed', '{"error": null}', true""",
)
def _(spark, d):
    at = scratch(spark, "audit")
    sinks.append_audit(spark, at, "ingest", "succeeded", {"rows": table(spark, d, "region").count()})
    sinks.append_audit(spark, at, "gold", "failed", {"error": None})
    return spark.read.parquet(at).select("task", "outcome", "metrics_json", F.to_timestamp("recorded_at_utc").isNotNull().alias("stamped"))


# ------------------------------------------------------------ silver relations

SILVER_COLUMNS = (
    "review_id, user_id, business_id, stars, review_date, raw_review, name, city, state, latitude, longitude, business_review_count, is_open, user_name, "
    "user_review_count, user_stars_avg, year_month, primary_industry, secondary_industry, tertiary_industry"
)


@add("j1_silver", f"{S} SELECT {SILVER_COLUMNS} FROM silver")
def _(spark, d):
    return silver_table(spark, d)


@add("p1_review_columns", f"WITH reviews AS ({duck(REVIEWS)}) SELECT review_id, stars, CAST(date AS DATE) AS review_date, text AS raw_review FROM reviews")
def _(spark, d):
    return silver_table(spark, d).select("review_id", "stars", "review_date", "raw_review")


@add("p3_industries", f"{S} SELECT DISTINCT business_id, primary_industry, secondary_industry, tertiary_industry FROM silver WHERE business_id IS NOT NULL")
def _(spark, d):
    used = reviews(spark, d).select("business_id").distinct()
    return silver.with_industries(places(spark, d).select("business_id", "categories")).join(used, "business_id", "left_semi")


@add("a12_unique_lines", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def _(spark, d):
    keys = ("l_orderkey", "l_linenumber")
    return silver.one_per_key(table(spark, d, "lineitem").select(*keys, "l_partkey", "l_quantity"), *keys).select(*keys)


@add("a13_distinct_keys", f"{S} SELECT DISTINCT business_id FROM silver WHERE business_id IS NOT NULL")
def _(spark, d):
    return silver.distinct_keys(silver_table(spark, d), "business_id")


MD5 = "md5('42:' || review_id)"
PICK = f"picked AS (SELECT * FROM silver ORDER BY {MD5}, review_id LIMIT 500)"


@add("l1_sample_md5", f"{S}, {PICK} SELECT review_id, stars FROM picked")
def _(spark, d):
    return silver.sample_by_hash(silver_table(spark, d), 500, 42, by="md5").select("review_id", "stars")


@add("l1_sample_xxhash64")
def _(spark, d):
    return silver.sample_by_hash(silver_table(spark, d), 500, 42).select("review_id", "stars")


@add("j2_scope_users", f"{S}, {PICK} SELECT user_id, name FROM users SEMI JOIN picked USING (user_id)")
def _(spark, d):
    picked = silver.sample_by_hash(silver_table(spark, d), 500, 42, by="md5")
    return silver.scope_related(users(spark, d), "user", picked).select("user_id", "name")


@add("j3_scope_places", f"{S}, {PICK} SELECT business_id, name FROM places SEMI JOIN picked USING (business_id)")
def _(spark, d):
    picked = silver.sample_by_hash(silver_table(spark, d), 500, 42, by="md5")
    return silver.scope_related(places(spark, d), "business", picked).select("business_id", "name")


# -------------------------------------------------------------------- filters

LOW, LABEL = "lower(regexp_replace(coalesce({}, ''), '\\s+', ' ', 'g'))", "CASE WHEN {0} >= {1} THEN 'positive' WHEN {0} <= {2} THEN 'negative' ELSE 'neutral' END"
VADER, VALENCE = LABEL.format("vader_sentiment_score", 0.05, -0.05), LABEL.format("Valence_avg", 0.55, 0.45)
KEPT = "review_id, business_id, user_id, city, state, stars"
FILTERS: dict[str, tuple[dict, str]] = {
    "f1_business_ids": ({"business_ids": ["1", "5", "9"]}, "business_id IN ('1', '5', '9')"),
    "f2_business_names": ({"business_names": [" supplier#000000002 ", "0000007"]}, f"contains({LOW.format('name')}, 'supplier#000000002') OR contains({LOW.format('name')}, '0000007')"),
    "f3_user_ids": ({"user_ids": ["10", "11"]}, "user_id IN ('10', '11')"),
    "f4_industries": (
        {"industries": ["brass", " Brand#1"]},
        " OR ".join(f"contains({LOW.format(c)}, '{v}')" for c in ("primary_industry", "secondary_industry", "tertiary_industry") for v in ("brass", "brand#1")),
    ),
    "f5_cities": ({"cities": ["nation_3", "NATION_7"]}, "lower(city) IN ('nation_3', 'nation_7')"),
    "f6_states": ({"states": ["asia"]}, "upper(state) IN ('ASIA')"),
    "f7_dates": ({"start_date": "1996-01-01", "end_date": "1997-06-30"}, "review_date >= DATE '1996-01-01' AND review_date <= DATE '1997-06-30'"),
    "f8_sentiment_labels": ({"sentiment_labels": ["positive", "neutral"]}, f"{VADER} IN ('positive', 'neutral')"),
    "f8_valence_labels": ({"sentiment_labels": ["negative"], "sentiment_column": "Valence_avg"}, f"{VALENCE} = 'negative'"),
    "f9_emotions": ({"emotion_labels": ["Joy", "anger"]}, "lower(dominant_emotion) IN ('joy', 'anger')"),
    "f10_sentiment_range": ({"min_sentiment": -0.25, "max_sentiment": 0.5}, "vader_sentiment_score >= -0.25 AND vader_sentiment_score <= 0.5"),
    "f11_star_range": ({"min_stars": 2.0, "max_stars": 4.0}, "stars >= 2 AND stars <= 4"),
    "f_combined": (
        {"states": ["Europe", "AMERICA"], "start_date": "1995-06-01", "sentiment_labels": ["positive"], "max_stars": 3.0},
        f"upper(state) IN ('EUROPE', 'AMERICA') AND review_date >= DATE '1995-06-01' AND {VADER} = 'positive' AND stars <= 3",
    ),
}
for _name, (_options, _where) in FILTERS.items():
    add(_name, f"{FT} SELECT {KEPT} FROM featured WHERE {_where}")(
        lambda spark, d, o=_options: filters.apply_filter(featured(spark, d), **o).select(*KEPT.split(", "))
    )


@add("f14_non_null_keys", f"{S} SELECT review_id FROM silver WHERE business_id IS NOT NULL")
def _(spark, d):
    return silver.known_keys(silver_table(spark, d), "business_id").select("review_id")


@add("f16_priority_filter", f"{S} SELECT review_id, city FROM silver WHERE lower(trim(city)) = 'nation_3' AND lower(trim(state)) = 'europe'")
def _(spark, d):
    return filters.priority_filter(silver_table(spark, d), city="Nation_3", state=" EUROPE")[0].select("review_id", "city")


# ----------------------------------------------------------------------- gold

LOW_STAR = "avg(CASE WHEN stars <= 2 THEN 1.0e0 ELSE 0.0e0 END) AS low_star_rate"
METRIC_SQL = (
    f"count(review_id) AS review_count, {LOW_STAR}, count(DISTINCT business_id) AS unique_business_count, count(DISTINCT user_id) AS unique_user_count, "
    + ", ".join(f"avg({m}) AS avg_{m}" for m in gold.METRICS if m not in ("Arousal_avg", "Dominance_avg"))
)


def gold_sql(keys: str, value: str, level: str, where: str = "true", more: str = "") -> str:
    names = ", ".join(k.rsplit(" AS ", 1)[-1] for k in keys.split("; "))
    return (
        f"{FT}, keyed AS (SELECT * REPLACE (upper(trim(state)) AS state, trim(city) AS city), "
        f"{VADER} AS sentiment_label, lower(dominant_emotion) AS emotion_label FROM featured), shown AS (SELECT * {keys.partition('|')[2]} FROM keyed) "
        f"SELECT {names.partition('|')[0]}, {METRIC_SQL}{more}, '{level}' AS gold_variant_level, {value} AS gold_variant_value FROM shown WHERE {where} GROUP BY {names.partition('|')[0]}"
    )


PLACE_DIMS = "".join(
    f", min(CASE WHEN business_id IS NOT NULL THEN {c} END) AS {n}"
    for c, n in (("name", "business_name"), ("city", "city"), ("state", "state"), ("latitude", "latitude"), ("longitude", "longitude"), ("primary_industry", "primary_industry"))
)
GOLD = {
    "a2_business_gold": ("business", {}, gold_sql("business_id", "business_id", "business", more=PLACE_DIMS).replace("upper(trim(state))", "state").replace("trim(city)", "city")),
    "a3_user_gold": ("user", {}, gold_sql("user_id", "user_id", "user", more=", min(CASE WHEN user_id IS NOT NULL THEN user_name END) AS user_name")),
    "a5_industry_gold": ("industry", {}, gold_sql("primary_industry", "primary_industry", "industry", "primary_industry IS NOT NULL")),
    "a6_state_gold": ("state", {}, gold_sql("state", "state", "state", "state <> ''")),
    "a6_city_gold": (
        "city-of-state", {},
        gold_sql("state; city", "concat_ws(' | ', state, city)", "city-of-state", "state <> '' AND city <> ''", ", avg(latitude) AS centroid_latitude, avg(longitude) AS centroid_longitude"),
    ),
    "a7_sentiment_gold": ("sentiment", {}, gold_sql("sentiment_label", "sentiment_label", "sentiment")),
    "a8_emotion_gold": ("emotion", {}, gold_sql("emotion_label", "emotion_label", "emotion", "emotion_label IS NOT NULL")),
}
for _p in gold.PERIODS:
    _period = f"date_trunc('{_p}', review_date::TIMESTAMP)"
    GOLD[f"a4_{_p}_gold"] = (
        "date", {"period": _p},
        gold_sql(f"date_period|, {_period} AS date_period", "strftime(date_period, '%Y-%m-%d %H:%M:%S')", "date", "review_date IS NOT NULL"),
    )
for _name, (_level, _options, _sql) in GOLD.items():
    add(_name, _sql)(lambda spark, d, level=_level, o=_options: gold.build_gold(featured(spark, d), level, **o))

for _name in [n for n in GOLD if n.startswith("a4_")]:  # timestamps compare as text in every engine
    SQL[_name] = SQL[_name].replace("SELECT date_period, count", "SELECT strftime(date_period, '%Y-%m-%d') AS date_period, count")
    QUERIES[_name] = lambda spark, d, f=QUERIES[_name]: f(spark, d).withColumn("date_period", F.date_format("date_period", "yyyy-MM-dd"))

BRANDS = ["Supplier#000000001", "supplier#00000000", "nobody"]


def _brand_hits() -> str:
    return " UNION ALL ".join(f"SELECT *, '{b}' AS brand FROM featured WHERE contains(lower(coalesce(name, '')), '{b.lower()}')" for b in BRANDS)


@add(
    "u1_brand_sample",
    f"{FT}, hits AS ({_brand_hits()}), ranked AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY {MD5}, review_id) AS r FROM hits) "
    "SELECT review_id, brand AS gold_variant_value, 'brand-sample' AS gold_variant_level, 42 AS gold_sample_seed FROM ranked WHERE r <= 40",
)
def _(spark, d):
    out = gold.build_gold(featured(spark, d), "brand-sample", 40, 42, BRANDS, by="md5")
    return out.select("review_id", "gold_variant_value", "gold_variant_level", "gold_sample_seed")


@add("l2_gold_sample", f"{FT} SELECT review_id, stars, 'sample' AS gold_variant_level, 'filtered_reviews' AS gold_variant_value, 42 AS gold_sample_seed FROM featured ORDER BY {MD5}, review_id LIMIT 300")
def _(spark, d):
    return gold.build_gold(featured(spark, d), "sample", 300, 42, by="md5").select("review_id", "stars", "gold_variant_level", "gold_variant_value", "gold_sample_seed")


# ------------------------------------------------------------- serving tables


def _row_gold(spark: SparkSession, d: str) -> DataFrame:
    """All featured reviews as row-level Gold with two variants."""
    variant = F.when(F.col("stars") <= 3, "lower").otherwise("upper")
    return featured(spark, d).withColumns({"gold_variant_level": F.lit("sample"), "gold_variant_value": variant})


def _round4(x: str) -> str:
    return f"sign({x}) * floor(abs({x}) * 10000 + 0.5) / 10000"


RISK = "least(1.0e0, greatest(0.0e0, (5.0e0 - avg_stars) / 4.0e0) * 0.45e0 + low_star_rate * 0.35e0 + greatest(0.0e0, -coalesce(avg_sentiment, 0.0e0)) * 0.20e0)"
ROWS_SQL = FT + ", g AS (SELECT *, CASE WHEN stars <= 3 THEN 'lower' ELSE 'upper' END AS gold_variant_value FROM featured)"
SUMMARY_SQL = (
    ROWS_SQL + ", sums AS (SELECT gold_variant_value, business_id, min(name) AS business_name, min(city) AS city, min(state) AS state, min(latitude) AS latitude, "
    "min(longitude) AS longitude, min(primary_industry) AS primary_industry, count(review_id) AS review_count, avg(stars) AS avg_stars, " + LOW_STAR +
    ", avg(weighted_star) AS avg_weighted_star, avg(vader_sentiment_score) AS avg_sentiment, avg(anger_int_avg) AS avg_anger, avg(fear_int_avg) AS avg_fear, "
    "avg(sadness_int_avg) AS avg_sadness, avg(joy_int_avg) AS avg_joy FROM g GROUP BY gold_variant_value, business_id), "
    f"risk AS (SELECT *, {_round4(RISK)} AS risk_score FROM sums), summary AS (SELECT *, CASE WHEN risk_score >= 0.65 THEN 'high' WHEN risk_score >= 0.4 THEN 'moderate' ELSE 'monitor' END AS attention_tier, "
    f"CASE WHEN low_star_rate >= 0.35 THEN '{labels.FOCUS[0]}' WHEN avg_sentiment < -0.15 THEN '{labels.FOCUS[1]}' WHEN avg_joy < avg_sadness THEN '{labels.FOCUS[2]}' ELSE '{labels.FOCUS[3]}' END AS recommended_focus FROM risk)"
)
MONTHLY_SQL = ROWS_SQL + f", monthly AS (SELECT gold_variant_value, year_month, primary_industry, count(review_id) AS review_count, avg(stars) AS avg_stars, {LOW_STAR}, avg(vader_sentiment_score) AS avg_sentiment FROM g GROUP BY ALL)"


def _summary(spark: SparkSession, d: str) -> DataFrame:
    return serving.business_summary(_row_gold(spark, d))


def _monthly(spark: SparkSession, d: str) -> DataFrame:
    return serving.monthly_summary(_row_gold(spark, d))


SERVING: dict[str, tuple[Query, str]] = {
    "a9_business_summary": (_summary, SUMMARY_SQL + " SELECT * FROM summary"),
    "a10_monthly_summary": (_monthly, MONTHLY_SQL + " SELECT * FROM monthly"),
    "l3_top_businesses": (lambda s, d: serving.top_businesses(_summary(s, d), 50), SUMMARY_SQL + " SELECT * FROM summary ORDER BY review_count DESC, gold_variant_value, business_id NULLS FIRST LIMIT 50"),
    "l4_first_months": (lambda s, d: serving.first_months(_monthly(s, d), 200), MONTHLY_SQL + " SELECT * FROM monthly WHERE year_month IS NOT NULL ORDER BY year_month, gold_variant_value, primary_industry NULLS FIRST LIMIT 200"),
    "l5_latest_reviews": (lambda s, d: serving.latest_reviews(_row_gold(s, d), 300).select("review_id", "review_date", "stars"), ROWS_SQL + " SELECT review_id, review_date, stars FROM g ORDER BY review_date DESC, review_id LIMIT 300"),
    "f15_dashboard_filter": (
        lambda s, d: serving.dashboard_filter(_summary(s, d), 5, ["lower"], ["ASIA", "EUROPE"], mapped=True),
        SUMMARY_SQL + " SELECT * FROM summary WHERE review_count >= 5 AND gold_variant_value = 'lower' AND state IN ('ASIA', 'EUROPE') AND latitude IS NOT NULL AND longitude IS NOT NULL",
    ),
    "a18_state_rollup": (
        lambda s, d: serving.state_rollup(_summary(s, d)).select("state", "review_count", "businesses", *[labels.round4(F.col(c)).alias(c) for c in ("avg_stars", "avg_sentiment", "risk_score")]),
        SUMMARY_SQL + " SELECT state, CAST(sum(review_count) AS BIGINT) AS review_count, count(*) AS businesses, " + ", ".join(
            _round4(f"(sum({c} * review_count) / sum(review_count) FILTER ({c} IS NOT NULL))") + f" AS {c}" for c in ("avg_stars", "avg_sentiment", "risk_score")
        ) + " FROM summary WHERE state IS NOT NULL GROUP BY state",
    ),
    "a19_variant_summary": (lambda s, d: serving.variant_summary(_row_gold(s, d)), ROWS_SQL + " SELECT gold_variant_value, count(review_id) AS review_count, avg(stars) AS avg_stars, avg(vader_sentiment_score) AS avg_sentiment FROM g GROUP BY 1"),
    "a19_rating_histogram": (lambda s, d: serving.rating_histogram(_row_gold(s, d)), ROWS_SQL + " SELECT gold_variant_value, stars, count(*) AS review_count FROM g WHERE stars IS NOT NULL GROUP BY 1, 2"),
    "l7_leading_industries": (
        lambda s, d: serving.leading_industries(_monthly(s, d)),
        MONTHLY_SQL + " SELECT * FROM monthly WHERE primary_industry IN (SELECT primary_industry FROM monthly WHERE primary_industry IS NOT NULL GROUP BY 1 ORDER BY sum(review_count) DESC, primary_industry LIMIT 8)",
    ),
    "l8_priority_list": (lambda s, d: serving.priority_list(_summary(s, d)).select("gold_variant_value", "business_id", "risk_score", "review_count"), SUMMARY_SQL + " SELECT gold_variant_value, business_id, risk_score, review_count FROM summary"),
}
for _name, (_query, _sql) in SERVING.items():
    add(_name, _sql)(_query)

# -------------------------------------------------------------- text features

CLEAN = r"trim(regexp_replace(regexp_replace(coalesce(text, ''), 'http\S+|www\.\S+', ' ', 'g'), '\s+', ' ', 'g'))"
TEXT_SQL = f"""WITH c AS (SELECT CAST(doc_id AS VARCHAR) AS review_id, {CLEAN} AS t FROM documents),
w AS (SELECT *, CASE WHEN t = '' THEN [] ELSE string_split(t, ' ') END AS ws, regexp_extract_all(lower(t), '[a-z'']+') AS tk FROM c)"""
NEGATED = ", ".join("'" + n.replace("'", "''") + "'" for n in text.NEGATIONS)
LINGUISTIC_SQL = TEXT_SQL + f"""
SELECT review_id, t AS stripped_review, CAST(len(ws) AS BIGINT) AS word_count, length(t) AS char_count,
  CASE WHEN len(ws) = 0 THEN 0.0 ELSE floor(length(array_to_string(ws, ''))::DOUBLE / len(ws) * 1000 + 0.5) / 1000 END AS avg_word_len,
  CASE WHEN sc = 0 THEN 0.0 ELSE floor(len(ws)::DOUBLE / sc * 1000 + 0.5) / 1000 END AS avg_sentence_len,
  length(t) - length(replace(t, '!', '')) AS num_excl, length(t) - length(replace(t, '?', '')) AS num_ques,
  CAST(len(list_filter(ws, lambda x: x = upper(x) AND x <> lower(x) AND length(x) > 1)) AS BIGINT) AS num_caps,
  length(t) - length(replace(t, '@', '')) AS num_at, length(t) - length(replace(t, '#', '')) AS num_hash, sc AS sentence_count,
  CAST(len(list_filter(tk, lambda x: x IN ({NEGATED}))) AS BIGINT) AS negation_count,
  CASE WHEN len(ws) = 0 THEN 0.0 ELSE floor(len(list_distinct(ws))::DOUBLE / len(ws) * 10000 + 0.5) / 10000 END AS type_token_ratio
FROM (SELECT *, CAST(greatest(len(regexp_extract_all(t, '[^.!?]+([.!?]+|$)')), 1) AS BIGINT) AS sc FROM w)"""


def documents_as_reviews(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("review_id"), F.col("text").alias("raw_review")))


@add("t1_t8_linguistic", LINGUISTIC_SQL)
def _(spark, d):
    return text.linguistic(documents_as_reviews(spark, d)).drop("raw_review")


@add("t2_token_counts", TEXT_SQL + " SELECT tok, count(*) AS n FROM (SELECT unnest(tk) AS tok FROM w) GROUP BY tok")
def _(spark, d):
    token = F.explode(text.tokens(text.clean(F.col("raw_review")))).alias("tok")
    return documents_as_reviews(spark, d).select(token).groupBy("tok").agg(F.count("*").alias("n"))


def _slice(i: int) -> str:
    return f"CAST(('0x' || substr(md5(term), {i}, 3)) AS INTEGER)"


def synthetic_lexicon(spark: SparkSession, d: str) -> DataFrame:
    """Terms of five or fewer letters in the corpus, valued by their md5: a stand-in
    for licensed lexicons, the same in every engine."""
    docs = documents_as_reviews(spark, d).select(text.clean(F.col("raw_review")).alias("text"))
    terms = text.distinct_tokens(docs, "text").where(F.length("term") <= 5)
    part = lambda i: F.conv(F.substring(F.md5(F.col("term").cast("binary")), i, 3), 16, 10).cast("int")
    unit = lambda i: (part(i) % 129 - 64) / F.lit(64.0)
    kind = part(1) % 10
    return terms.select(
        "term", F.when(part(4) % 3 == 0, True).alias("worry"), *[F.when(part(7) % 2 == 0, unit(8 + i)).alias(c) for i, c in enumerate(lexicon.VAD)],
        *[F.when(part(12) % 4 == 0, unit(13 + i)).alias(f"social_{c}") for i, c in enumerate(lexicon.SOCIAL)], F.when(part(18) % 2 == 1, unit(19)).alias("affect"),
        *[F.when(kind == i, True).alias(f"hit_{e}") for i, e in enumerate(labels.EMOTIONS)], F.when(kind % 2 == 0, True).alias("hit_positive"), F.when(kind % 2 == 1, True).alias("hit_negative"),
        *[F.when(part(22) % 8 == i, (part(25) % 65) / F.lit(64.0)).alias(f"int_{e}") for i, e in enumerate(labels.EMOTIONS)],
    )


def _unit(i: int) -> str:
    return f"({_slice(i)} % 129 - 64) / 64.0e0"


_E = list(enumerate(labels.EMOTIONS))
LEXICON_SQL = TEXT_SQL + ", lex AS (SELECT term, CASE WHEN " + _slice(4) + " % 3 = 0 THEN true END AS worry, " + ", ".join(
    [f"CASE WHEN {_slice(7)} % 2 = 0 THEN {_unit(8 + i)} END AS {c}" for i, c in enumerate(lexicon.VAD)]
    + [f"CASE WHEN {_slice(12)} % 4 = 0 THEN {_unit(13 + i)} END AS social_{c}" for i, c in enumerate(lexicon.SOCIAL)]
    + [f"CASE WHEN {_slice(18)} % 2 = 1 THEN {_unit(19)} END AS affect"] + [f"CASE WHEN {_slice(1)} % 10 = {i} THEN true END AS hit_{e}" for i, e in _E]
    + [f"CASE WHEN {_slice(1)} % 10 % 2 = 0 THEN true END AS hit_positive, CASE WHEN {_slice(1)} % 10 % 2 = 1 THEN true END AS hit_negative"]
    + [f"CASE WHEN {_slice(22)} % 8 = {i} THEN ({_slice(25)} % 65) / 64.0e0 END AS int_{e}" for i, e in _E]
) + """ FROM (SELECT DISTINCT unnest(tk) AS term FROM w) WHERE length(term) <= 5),
tok AS (SELECT review_id, unnest(tk) AS term FROM w),
per AS (SELECT review_id, count(*) AS n, count(worry) AS worry_word_count, """ + ", ".join(
    [f"sum({c}) AS s_{c}" for c in lexicon.VAD] + ["count(valence) AS vad_matched_words"] + [f"sum(social_{c}) AS s_social_{c}" for c in lexicon.SOCIAL]
    + ["count(social_warmth) AS n_social, sum(affect) AS s_affect, count(affect) AS affect_matched_words"] + [f"count(hit_{e}) AS {e}_count" for e in labels.EMOTIONS]
    + ["count(hit_positive) AS positive_count, count(hit_negative) AS negative_count"] + [f"sum(int_{e}) AS s_int_{e}" for e in labels.EMOTIONS]
) + " FROM tok LEFT JOIN lex USING (term) GROUP BY review_id), hits AS (SELECT *, " + " + ".join(f"{e}_count" for e in labels.EMOTIONS) + " AS h FROM per), shaped AS (SELECT c.review_id, " + ", ".join(
    ["coalesce(worry_word_count, 0) AS worry_word_count"]
    + [f"CASE WHEN vad_matched_words > 0 THEN {_round4(f's_{c} / vad_matched_words')} ELSE 0.0 END AS {c.capitalize()}_avg" for c in lexicon.VAD] + ["coalesce(vad_matched_words, 0) AS vad_matched_words"]
    + [f"CASE WHEN n_social > 0 THEN {_round4(f's_social_{c} / n_social')} ELSE 0.0 END AS wcst_{c}_avg" for c in lexicon.SOCIAL]
    + [f"CASE WHEN affect_matched_words > 0 THEN {_round4('s_affect / affect_matched_words')} ELSE 0.0 END AS affect_sentiment_avg, coalesce(affect_matched_words, 0) AS affect_matched_words"]
    + [f"coalesce({e}_count, 0) AS {e}_count" for e in labels.EMOTIONS] + ["coalesce(positive_count, 0) AS positive_count, coalesce(negative_count, 0) AS negative_count"]
    + [f"CASE WHEN h > 0 THEN {_round4(f'({e}_count::DOUBLE / h)')} ELSE 0.0 END AS {e}_int_avg" for e in labels.EMOTIONS]
    + [f"coalesce({_round4(f'(coalesce(s_int_{e}, 0.0e0) / greatest(n, 1))')}, 0.0) AS nrc_{e}_lex" for e in labels.EMOTIONS]
) + " FROM c LEFT JOIN hits USING (review_id)), ranked AS (SELECT *, list_sort([" + ", ".join(f"{{'s': -nrc_{e}_lex, 'i': {i}, 'e': '{e}'}}" for i, e in _E) + "]) AS rk, " + " + ".join(
    f"nrc_{e}_lex" for e in labels.EMOTIONS
) + " AS tot, greatest(" + ", ".join(f"{e}_int_avg" for e in labels.EMOTIONS) + ") AS top FROM shaped)"
LEXICON_SELECT = " SELECT * EXCLUDE (rk, tot, top), CASE WHEN top <= 0 THEN 'neutral' " + " ".join(f"WHEN {e}_int_avg = top THEN '{e}'" for e in labels.EMOTIONS) + " END AS dominant_emotion, " + ", ".join(
    f"CASE WHEN tot > 0 THEN rk[{i}].e ELSE 'neutral' END AS {n}_emotion_lex, CASE WHEN tot > 0 THEN {_round4(f'(-rk[{i}].s / tot)')} ELSE {x} END AS {n}_emotion_lex_conf"
    for i, n, x in ((1, "primary", "1.0"), (2, "secondary", "0.0"))
) + " FROM ranked"


@add("t10_t21_lexicon_features", LEXICON_SQL + LEXICON_SELECT)
def _(spark, d):
    docs = documents_as_reviews(spark, d).withColumn("stripped_review", text.clean(F.col("raw_review"))).drop("raw_review")
    return lexicon.lexicon_features(docs, synthetic_lexicon(spark, d)).drop("stripped_review")


@add("j7_lexicon_hits", LEXICON_SQL + " SELECT review_id, count(*) AS tokens, count(lex.term) AS matched FROM tok LEFT JOIN lex USING (term) GROUP BY review_id")
def _(spark, d):
    token = documents_as_reviews(spark, d).select("review_id", F.explode(text.tokens(text.clean(F.col("raw_review")))).alias("term"))
    lex = synthetic_lexicon(spark, d).select("term", F.lit(1).alias("hit"))
    return token.join(lex, "term", "left").groupBy("review_id").agg(F.count("*").alias("tokens"), F.count("hit").alias("matched"))


DECAY_SQL = f"""{S} SELECT review_id, {_round4("(stars * pow(0.998e0, greatest(date_diff('day', review_date, (SELECT max(review_date) FROM silver)), 0)))")} AS weighted_star FROM silver"""


@add("t22_a11_weighted_star", DECAY_SQL)
def _(spark, d):
    return features.with_decay(silver_table(spark, d)).select("review_id", "weighted_star")


# Java takes letters of any script for word characters at \\b, RE2 only ASCII: others become '_'.
_BOUND = "regexp_replace({}, '[^\\x00-\\x7F\\pP\\pS\\pZ\\pC\\pM]', '_', 'g')"


def _found(pattern: str, text_sql: str) -> str:
    return f"len(regexp_extract_all({_BOUND.format(text_sql)}, '{pattern}'))"


_NATIVE = {"vader_sentiment_score": "gap / sqrt(gap * gap + 15)", "vader_pos": "positive_count / n", "vader_neg": "negative_count / n", "vader_neu": "greatest(0.0e0, (n - positive_count - negative_count) / n)"}
_GRAMMAR = dict(zip(scorers.SuffixGrammar.columns, (_found(f"\\b[a-z]+{e}\\b", "lower(t)") for e in scorers.SuffixGrammar.endings)))
_GRAMMAR["subjectivity_score"] = f"({_GRAMMAR['adj_pct']} + {_GRAMMAR['adv_pct']})"
NATIVE_SELECT = (
    ", native AS (SELECT review_id, " + ", ".join([f"{_round4('(' + e + ')')} AS {x}" for x, e in _NATIVE.items()])
    + ", " + ", ".join(f"CAST({_found(p, 't')} AS BIGINT) AS {x}" for x, p in zip(scorers.RuleEntities.columns, scorers.RuleEntities.patterns))
    + ", " + ", ".join(f"{_round4('(' + e + ' / n)')} AS {x}" for x, e in _GRAMMAR.items())
    + " FROM (SELECT review_id, t, greatest(len(ws), 1)::DOUBLE AS n, positive_count, negative_count, (positive_count - negative_count)::DOUBLE AS gap FROM shaped JOIN w USING (review_id)))"
)


@add("t9_t13_t15_native_scorers", LEXICON_SQL + NATIVE_SELECT + " SELECT * FROM native")
def _(spark, d):
    docs = documents_as_reviews(spark, d).withColumns({"stripped_review": text.clean(F.col("raw_review")), "stars": F.lit(3.0)})
    base = lexicon.lexicon_features(docs, synthetic_lexicon(spark, d))
    out = scorers.SuffixGrammar()(scorers.RuleEntities()(scorers.LexiconSentiment()(base)))
    return out.select("review_id", *scorers.LexiconSentiment.columns, *scorers.RuleEntities.columns, *scorers.SuffixGrammar.columns)


DATED_DOCS = (
    "SELECT CAST(doc_id AS VARCHAR) AS review_id, text AS raw_review, CASE WHEN doc_id % 7 = 3 THEN NULL ELSE CAST(doc_id % 5 + 1 AS DOUBLE) END AS stars, "
    "CASE WHEN doc_id % 11 = 4 THEN NULL ELSE CAST(doc_id % 3 AS BIGINT) END AS useful, DATE '2020-01-01' + CAST(doc_id % 700 AS INTEGER) AS review_date FROM documents"
)
ALL_SQL = (
    f"WITH base AS ({DATED_DOCS}), ling AS ({LINGUISTIC_SQL}), lexi AS ({LEXICON_SQL + LEXICON_SELECT}), nat AS ({LEXICON_SQL + NATIVE_SELECT} SELECT * FROM native) "
    "SELECT base.*, ling.* EXCLUDE (review_id), lexi.* EXCLUDE (review_id), nat.* EXCLUDE (review_id), "
    + _round4("(stars * pow(0.998e0, date_diff('day', review_date, (SELECT max(review_date) FROM base))))")
    + " AS weighted_star FROM base JOIN ling USING (review_id) JOIN lexi USING (review_id) JOIN nat USING (review_id)"
)


@add("p5_p6_all_features", ALL_SQL)
def _(spark, d):
    """All default columns; stars and useful of the input are NULL here and there and stay so."""
    k = F.col("review_id").cast("long")
    docs = documents_as_reviews(spark, d).withColumns(
        {
            "stars": F.when(k % 7 != 3, (k % 5 + 1).cast("double")), "useful": F.when(k % 11 != 4, k % 3),
            "review_date": F.date_add(F.lit("2020-01-01").cast("date"), (k % 700).cast("int")),
        }
    )
    return features.apply_features(docs, synthetic_lexicon(spark, d))


# ----------------------------------------------------------------- validation


@add("v1_a17_key_profile", "SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(coalesce(sum(n) FILTER (l_orderkey IS NULL), 0) AS BIGINT) AS null_keys, count(*) FILTER (l_orderkey IS NOT NULL AND n > 1) AS repeated_keys FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)")
def _(spark, d):
    return validate.key_profile(table(spark, d, "lineitem"), "l_orderkey")


CORR = "covar_pop({0}, stars) / (stddev_pop({0}) * stddev_pop(stars))"


@add(
    "v2_a14_a16_silver_measures",
    f"{FT} SELECT count(*) AS row_count, {_round4('(' + CORR.format('vader_sentiment_score') + ')')} AS corr_vader_sentiment_score, {_round4('(' + CORR.format('Valence_avg') + ')')} AS corr_Valence_avg, "
    "avg(CASE WHEN weighted_star = stars THEN 1.0e0 ELSE 0.0e0 END) AS same_weighted_star, "
    + ", ".join(f"min({c}) = max({c}) AS constant_{c}" for c in ("vader_sentiment_score", "Valence_avg", "word_count", "subjectivity_score", "negation_count", "weighted_star", "anger_int_avg", "fear_int_avg", "joy_int_avg", "sadness_int_avg"))
    + " FROM featured",
)
def _(spark, d):
    got = validate.silver_measures(featured(spark, d), "raw_review")
    return got.drop("corr_word_count").withColumns({c: labels.round4(F.col(c)) for c in ("corr_vader_sentiment_score", "corr_Valence_avg")})


@add("v6_gold_keys", f"{FT} SELECT count(*) AS n, CAST(1 AS BIGINT) AS most FROM (SELECT DISTINCT upper(trim(state)) AS state FROM featured WHERE trim(state) <> '')")
def _(spark, d):
    got = validate.validate_gold(gold.aggregate(featured(spark, d), "state"), "state")
    return spark.createDataFrame([(got["gold_rows"], got["most_rows_of_a_key"])], "n long, most long")


@add("v7_row_parity", f"{S} SELECT (SELECT count(*) FROM silver) AS silver_rows, (SELECT count(*) FROM orders) AS bronze_rows")
def _(spark, d):
    got = validate.validate_parity_of_rows(silver_table(spark, d), reviews(spark, d))
    return spark.createDataFrame([tuple(got.values())], "silver_rows long, bronze_rows long")


@add(
    "v9_frame_parity",
    "SELECT count(*) FILTER (o_orderkey % 100 = 0) AS only_left, CAST(0 AS BIGINT) AS only_right, count(*) FILTER (o_orderkey % 100 <> 0 AND o_orderkey % 7 = 0) AS diff_o_totalprice, "
    "count(*) FILTER (o_orderkey % 100 <> 0 AND o_orderkey % 9 = 0) AS diff_o_orderstatus FROM orders",
)
def _(spark, d):
    a = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    k = F.col("o_orderkey")
    b = a.where(k % 100 != 0).withColumns(
        {"o_totalprice": F.col("o_totalprice") + F.when(k % 7 == 0, 0.5).otherwise(1e-8), "o_orderstatus": F.when(k % 9 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))}
    )
    return validate.compare_frames(a, b, "o_orderkey", ["o_totalprice", "o_orderstatus"])


@add("v10_degenerate_columns", "SELECT 'flat' AS column_name, 'constant' AS problem UNION ALL SELECT 'gone', 'all null'")
def _(spark, d):
    df = table(spark, d, "nation").withColumns({"flat": F.lit(1), "gone": F.lit(None).cast("int")})
    return validate.degenerate_columns(df)


# ------------------------------------------------------------------ analytics

DATED = FT + ", dated AS (SELECT *, CAST(date_trunc('month', review_date) AS DATE) AS m FROM featured WHERE review_date IS NOT NULL)"
PLACE_SQL = FT + """ SELECT business_id, name, city, state, is_open, 'all' AS dataset, count(review_id) AS review_count, avg(stars) AS business_star_avg,
  floor(stddev_samp(stars) * 10000 + 0.5) / 10000 AS business_star_std, min(stars) AS business_star_min, max(stars) AS business_star_max, median(stars) AS business_star_median,
  avg(vader_sentiment_score) AS sentiment_score_mean, floor(stddev_samp(vader_sentiment_score) * 10000 + 0.5) / 10000 AS sentiment_score_std, median(vader_sentiment_score) AS sentiment_score_median,
  avg(weighted_star) AS business_weighted_star_avg, avg(word_count) AS avg_review_length, avg(subjectivity_score) AS avg_subjectivity, avg(negation_count) AS negation_rate
FROM featured WHERE business_id IS NOT NULL AND name IS NOT NULL AND city IS NOT NULL AND state IS NOT NULL AND is_open IS NOT NULL GROUP BY 1, 2, 3, 4, 5"""
MODE_SQL = FT + """, c AS (SELECT business_id, dominant_emotion, count(*) AS n FROM featured WHERE business_id IS NOT NULL AND dominant_emotion IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY business_id ORDER BY n DESC, dominant_emotion) AS r FROM c) SELECT business_id, dominant_emotion AS primary_emotion_mode FROM r WHERE r = 1"""


def _profile(spark: SparkSession, d: str) -> DataFrame:
    return analytics.place_profile(featured(spark, d).withColumn("dataset", F.lit("all")))


@add("a20_place_profile", PLACE_SQL)
def _(spark, d):
    std = ("business_star_std", "sentiment_score_std")
    return _profile(spark, d).drop("primary_emotion_mode").withColumns({c: F.floor(F.col(c) * 10000 + 0.5) / 10000 for c in std})


@add("a20_emotion_mode", MODE_SQL)
def _(spark, d):
    return _profile(spark, d).where("primary_emotion_mode IS NOT NULL").select("business_id", "primary_emotion_mode")


@add("u2_union_datasets", f"{S} SELECT review_id, dataset FROM (SELECT review_id, 'low' AS dataset FROM silver WHERE stars < 3 UNION ALL SELECT review_id, 'high' FROM silver WHERE stars >= 3)")
def _(spark, d):
    s = silver_table(spark, d)
    return analytics.union_datasets({"low": s.where("stars < 3"), "high": s.where("stars >= 3").drop("city")}).select("review_id", "dataset")


MONTHLY_DECAY = DATED + ", k AS (SELECT CASE WHEN avg(weighted_star) > 0 THEN avg(stars) / avg(weighted_star) ELSE 1.0 END AS scale FROM featured), md AS (SELECT m AS month, avg(stars) AS actual, avg(weighted_star) * any_value(scale) AS weighted FROM dated, k GROUP BY m)"


@add("a21_n2_monthly_decay", MONTHLY_DECAY + " SELECT strftime(month, '%Y-%m') AS month, series, value FROM (SELECT month, 'actual' AS series, actual AS value FROM md UNION ALL SELECT month, 'weighted', weighted FROM md)")
def _(spark, d):
    return analytics.melt_monthly(analytics.monthly_decay(featured(spark, d)).withColumn("month", F.date_format("month", "yyyy-MM")))


@add("a22_emotion_distribution", FT + " SELECT dominant_emotion AS emotion, count(*) AS n FROM featured WHERE dominant_emotion IS NOT NULL GROUP BY 1")
def _(spark, d):
    return analytics.emotion_distribution(featured(spark, d))


@add("a23_emotion_averages", FT + " SELECT " + ", ".join(f"avg({e}_int_avg) AS {e}_int_avg" for e in ("anger", "fear", "joy", "sadness")) + ", avg(stars) AS avg_stars FROM featured")
def _(spark, d):
    return analytics.emotion_averages(featured(spark, d))


_CORRELATED = ["word_count", "subjectivity_score", "vader_sentiment_score", "negation_count"]


@add(
    "a24_star_correlations",
    FT + ", f AS (SELECT * FROM featured WHERE stars IS NOT NULL AND " + " AND ".join(f"{c} IS NOT NULL" for c in _CORRELATED) + ") "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {_round4('(' + CORR.format(c) + ')')} AS correlation FROM f" for c in _CORRELATED),
)
def _(spark, d):
    return analytics.star_correlations(featured(spark, d), _CORRELATED).withColumn("correlation", labels.round4(F.col("correlation")))


_STOP = ", ".join(f"'{w}'" for w in analytics.STOP_WORDS)


@add("a25_pain_points", TEXT_SQL + f", p AS (SELECT unnest(regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}_]+')) AS word FROM c WHERE CAST(review_id AS BIGINT) % 5 + 1 < 3) SELECT word, count(*) AS frequency FROM p WHERE regexp_full_match(word, '[a-z]{{3,}}') AND word NOT IN ({_STOP}) GROUP BY word ORDER BY frequency DESC, word LIMIT 20")
def _(spark, d):
    docs = documents_as_reviews(spark, d).withColumns({"stripped_review": text.clean(F.col("raw_review")), "stars": F.col("review_id").cast("long") % 5 + 1})
    return analytics.pain_points(docs)


AT_RISK = DATED + """, lim AS (SELECT max(m) AS last FROM dated WHERE business_id IS NOT NULL), per AS (
SELECT business_id, avg(stars) FILTER (m >= last - INTERVAL 6 MONTH) AS r, count(*) FILTER (m >= last - INTERVAL 6 MONTH) AS recent_reviews,
  count(*) FILTER (m >= last - INTERVAL 6 MONTH AND stars < 3) AS low, avg(stars) FILTER (m >= last - INTERVAL 12 MONTH AND m < last - INTERVAL 6 MONTH) AS p,
  count(*) FILTER (m >= last - INTERVAL 12 MONTH AND m < last - INTERVAL 6 MONTH) AS prior_reviews FROM dated, lim WHERE business_id IS NOT NULL GROUP BY business_id),
risk AS (SELECT business_id, coalesce(r, 0) AS recent_avg, coalesce(p, 0) AS prior_avg, recent_reviews, prior_reviews, low::DOUBLE / recent_reviews AS recent_low_pct, coalesce(p, 0) - coalesce(r, 0) AS decline FROM per WHERE recent_reviews > 0),
flagged AS (SELECT *, decline > 0.3 OR (recent_low_pct > 0.25 AND recent_reviews >= 10) AS at_risk_flag FROM risk)"""


@add("a26_at_risk", AT_RISK + " SELECT * FROM flagged")
def _(spark, d):
    return analytics.at_risk(featured(spark, d))


@add("l9_extreme_places", FT + ", p AS (SELECT business_id, avg(stars) AS avg_stars, count(*) AS reviews FROM featured WHERE business_id IS NOT NULL GROUP BY 1) (SELECT *, 'top' AS side FROM p ORDER BY avg_stars DESC, business_id LIMIT 5) UNION ALL (SELECT *, 'bottom' AS side FROM p ORDER BY avg_stars, business_id LIMIT 5)")
def _(spark, d):
    return analytics.extreme_places(featured(spark, d))


@add(
    "l10_stratified_sample",
    FT + ", st AS (SELECT stars, count(*) AS n, sum(count(*)) OVER () AS total FROM featured GROUP BY stars), "
    "q AS (SELECT stars, floor(n * least(1000, total) / total) AS f, n * least(1000, total) / total - floor(n * least(1000, total) / total) AS rest, total FROM st), "
    "qq AS (SELECT stars, f + CASE WHEN row_number() OVER (ORDER BY rest DESC, stars) <= least(1000, total) - sum(f) OVER () THEN 1 ELSE 0 END AS quota FROM q), "
    "rk AS (SELECT review_id, stars, row_number() OVER (PARTITION BY stars ORDER BY CAST('0x' || substr(md5('222:' || review_id), 1, 8) AS BIGINT), review_id) AS r FROM featured) "
    "SELECT rk.review_id, rk.stars FROM rk JOIN qq ON qq.stars IS NOT DISTINCT FROM rk.stars WHERE r <= quota",
)
def _(spark, d):
    return analytics.stratified_sample(featured(spark, d), 1000).select("review_id", "stars")


SERIES = DATED + ", v AS (SELECT m AS month, avg(stars) AS value FROM dated GROUP BY m), e AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM v)::TIMESTAMP, (SELECT max(month) FROM v)::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS month)"


@add("n3_monthly_series", SERIES + " SELECT month, last_value(value IGNORE NULLS) OVER (ORDER BY month) AS value FROM e LEFT JOIN v USING (month)")
def _(spark, d):
    return analytics.monthly_series(featured(spark, d))


@add("n3_forecast")
def _(spark, d):
    return analytics.forecast(analytics.monthly_series(featured(spark, d)))


@add(
    "n5_recommendation",
    AT_RISK + ", b AS (SELECT avg(stars) AS stars, avg(anger_int_avg) AS anger, avg(fear_int_avg) AS fear FROM featured), wst AS (SELECT business_id, decline FROM flagged WHERE at_risk_flag ORDER BY decline DESC, business_id LIMIT 1) "
    "SELECT CASE WHEN stars < 4 AND (anger > 0.015 OR fear > 0.015) THEN 'HIGH' WHEN business_id IS NOT NULL THEN 'MODERATE' ELSE 'LOW' END AS priority, "
    "CASE WHEN stars < 4 AND (anger > 0.015 OR fear > 0.015) THEN least(5.0e0, stars + 10 * (anger + fear)) ELSE decline END AS metric, "
    "CASE WHEN NOT coalesce(stars < 4 AND (anger > 0.015 OR fear > 0.015), false) THEN business_id END AS business_id FROM b LEFT JOIN wst ON true",
)
def _(spark, d):
    f = featured(spark, d)
    return analytics.recommendation(f, analytics.at_risk(f))
