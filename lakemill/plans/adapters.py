"""The given tables seen as reviews, places and users, in SQL that Spark and DuckDB share.

Reviews are orders, places suppliers, users customers; feature columns are
arithmetic of the keys on binary fractions, so that sums are exact in any
order. Text features run on ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

REVIEWS = """
SELECT CAST(o_orderkey AS STRING) AS review_id, CAST(o_custkey AS STRING) AS user_id, CAST(b.s AS STRING) AS business_id,
  CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS stars, o_orderkey % 11 AS useful, o_orderkey % 5 AS funny, o_orderkey % 3 AS cool,
  concat('Order ', o_orderstatus, ' of ', CAST(o_custkey AS STRING), '. Great service!') AS text, CAST(CAST(o_orderdate AS DATE) AS STRING) AS date
FROM {orders} LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS s FROM {lineitem} GROUP BY l_orderkey) b ON b.l_orderkey = o_orderkey
"""
PLACES = """
SELECT CAST(s_suppkey AS STRING) AS business_id, s_name AS name, n_name AS city, r_name AS state, s_nationkey * 1.5e0 AS latitude,
  s_nationkey * 2.0e0 - 30 AS longitude, 1.0e0 + (s_suppkey % 9) * 0.5e0 AS stars, s_suppkey % 500 AS review_count, s_suppkey % 2 AS is_open,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 5 = 0 THEN concat(' ', p_type, ' , ', p_brand, ' , , x') ELSE concat(p_type, ', ', p_brand) END AS categories
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey JOIN {region} ON r_regionkey = n_regionkey LEFT JOIN {part} ON p_partkey = s_suppkey
"""
USERS = """
SELECT CAST(c_custkey AS STRING) AS user_id, c_name AS name, c_custkey % 300 AS review_count, 1.0e0 + (c_custkey % 33) * 0.125e0 AS average_stars FROM {customer}
"""
FEATURES = """
SELECT s.*,
  ((k * 7919) % 2049 - 1024) / 1024.0e0 AS vader_sentiment_score, ((k * 10473) % 1025) / 1024.0e0 AS Valence_avg, k % 300 AS word_count,
  CASE WHEN k % 13 = 0 THEN NULL ELSE ((k * 31) % 65) / 64.0e0 END AS subjectivity_score,
  ((k * 3) % 17) / 16.0e0 AS anger_int_avg, ((k * 5) % 17) / 64.0e0 AS fear_int_avg, ((k * 7) % 17) / 16.0e0 AS joy_int_avg, ((k * 11) % 17) / 16.0e0 AS sadness_int_avg,
  floor(stars * pow(0.998e0, days_old) * 1024) / 1024.0e0 AS weighted_star, k % 4 AS negation_count,
  CASE k % 10 WHEN 0 THEN 'Anger' WHEN 1 THEN 'fear' WHEN 2 THEN 'joy' WHEN 3 THEN 'JOY' WHEN 4 THEN 'sadness' WHEN 5 THEN 'trust' WHEN 6 THEN NULL ELSE 'neutral' END AS dominant_emotion
FROM (SELECT *, CAST(review_id AS BIGINT) AS k, CAST(CAST(review_id AS BIGINT) % 2000 AS DOUBLE) AS days_old FROM {silver}) s
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in names}


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REVIEWS, **tables(spark, sf_dir, "orders", "lineitem"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PLACES, **tables(spark, sf_dir, "supplier", "nation", "region", "part"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(USERS, **tables(spark, sf_dir, "customer"))


def duck(sql: str) -> str:
    """The same SQL over DuckDB's views."""
    return sql.format(**{t: t for t in TABLES}, silver="silver")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakemill.operators.silver import KEYS, build_silver

    # the adapted tables are keyed by primary keys; a12 and s8 make keys unique, v7 compares the rows
    return build_silver(reviews(spark, sf_dir), places(spark, sf_dir), users(spark, sf_dir), unique=KEYS)


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with stand-ins for the feature columns."""
    return spark.sql(FEATURES, silver=silver(spark, sf_dir)).drop("k", "days_old")


SILVER_SQL = duck(
    "reviews AS (" + REVIEWS + "), places AS (" + PLACES + "), users AS (" + USERS + r"""), silver AS (
SELECT review_id, r.user_id, r.business_id, r.stars, CAST(r.date AS DATE) AS review_date, r.text AS raw_review, p.name, p.city, p.state, p.latitude, p.longitude,
  CAST(p.review_count AS BIGINT) AS business_review_count, CAST(p.is_open AS BIGINT) AS is_open, u.name AS user_name, CAST(u.review_count AS BIGINT) AS user_review_count,
  u.average_stars AS user_stars_avg, strftime(CAST(r.date AS DATE), '%Y-%m') AS year_month,
  nullif(trim(string_split_regex(coalesce(p.categories, ''), '\s*,\s*')[1]), '') AS primary_industry,
  nullif(trim(string_split_regex(coalesce(p.categories, ''), '\s*,\s*')[2]), '') AS secondary_industry,
  nullif(trim(string_split_regex(coalesce(p.categories, ''), '\s*,\s*')[3]), '') AS tertiary_industry
FROM reviews r LEFT JOIN places p ON p.business_id = r.business_id LEFT JOIN users u ON u.user_id = r.user_id)
"""
)
FEATURED_SQL = SILVER_SQL + ", featured AS (SELECT * EXCLUDE (k, days_old) FROM (" + duck(FEATURES) + "))"
