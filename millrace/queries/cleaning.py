"""Projections, cleaning and look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.signals import clip, epoch_seconds, normalize_code
from millrace.operators import cleaning, features
from millrace.operators.sequences import trim_warmup
from millrace.operators.stress import row_scenarios, scenario_grid
from millrace.operators.sampling import sample_n
from millrace.queries.registry import (
    EJECTION, FORCE, FRAGMENT, ORDER, ORDER_SQL, SPEED, THICKNESS, query, table,
)


@query("normalize_columns", "SELECT s_suppkey AS id, s_acctbal AS balance FROM supplier")
def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias(" ID"), F.col("s_acctbal").alias("Balance "))
    return cleaning.normalize_columns(raw)


@query("parse_timestamp", """
SELECT o_orderkey, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS seconds
FROM orders WHERE o_orderstatus <> 'P'
""")
def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text, written in two ways and unreadable for one order status."""
    day = F.col("o_orderdate")
    text = (F.when(F.col("o_orderstatus") == "P", F.lit("not known"))
            .when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    raw = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("order_time"))
    column = cleaning.find_column(raw, "time", "date")
    return cleaning.parse_timestamp(raw, column).select(
        "o_orderkey", epoch_seconds(F.col("timestamp")).alias("seconds"))


PAGE_TAIL_SQL = "TRY_CAST(split_part(url, '/', -1) AS DOUBLE)"


@query("cast_columns", f"SELECT page_id, {PAGE_TAIL_SQL} AS tail FROM pages")
def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "pages").select("page_id", F.element_at(F.split("url", "/"), -1).alias("tail"))
    return cleaning.cast_columns(raw, ["tail", "no such column"])


@query("coerce_dropna", f"""
SELECT CAST(page_id AS DOUBLE) AS page_id, {PAGE_TAIL_SQL} AS tail FROM pages
WHERE {PAGE_TAIL_SQL} IS NOT NULL
""")
def coerce_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "pages").select("page_id", F.element_at(F.split("url", "/"), -1).alias("tail"))
    return cleaning.coerce_and_drop(raw, ["page_id", "tail"])


@query("clip_outliers", """
SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 5000 WHEN c_acctbal < 0 THEN 0
                       ELSE c_acctbal END AS c_acctbal FROM customer
""")
def clip_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clip_outliers(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"),
                                  "c_acctbal", 0.0, 5000.0)


@query("dedup_all", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def dedup_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_duplicates(
        table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus"))


@query("dedup_subset", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS r
  FROM lineitem) WHERE r = 1
""")
def dedup_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    return cleaning.drop_duplicates(
        rows, ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]).drop("l_shipdate")


def _balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer balances with both kinds of missing values."""
    balance = (F.when(F.col("c_acctbal") > 9000, F.lit(float("nan")))
               .when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return table(spark, sf_dir, "customer").select("c_custkey", balance.alias("balance"))


def _impute_sql(fill: str) -> str:
    return f"""
WITH b AS (SELECT c_custkey, CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN c_acctbal END AS balance
           FROM customer)
SELECT c_custkey, round(coalesce(balance, {fill}), 4) AS balance FROM b"""


def _impute(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    filled = cleaning.impute_missing(_balances(spark, sf_dir), ["balance", "no such column"], strategy)
    return filled.select("c_custkey", F.round("balance", 4).alias("balance"))


@query("impute_zero", _impute_sql("0"))
def impute_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _impute(spark, sf_dir, "zero")


@query("impute_mean", _impute_sql("(SELECT avg(balance) FROM b)"))
def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _impute(spark, sf_dir, "mean")


@query("impute_median", _impute_sql("(SELECT quantile_cont(balance, 0.5) FROM b)"))
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _impute(spark, sf_dir, "median")


@query("drop_silence", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0")
def drop_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_silence(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", SPEED), SPEED)


STRENGTH_SQL = "(l_extendedprice * 2 * 1000) / (pi() * p_size * l_tax)"


@query("tensile_strength", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {STRENGTH_SQL} AS strength
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_tax > 0
""")
def tensile_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", FORCE, THICKNESS)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    joined = rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    return features.with_tensile_strength(joined, FORCE, "p_size", THICKNESS, "strength").select(
        "l_orderkey", "l_linenumber", "l_partkey", "strength")


PURGED_SQL = f"""
active AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY {ORDER_SQL}) AS r
  FROM lineitem WHERE l_discount > 0),
warm AS (
  SELECT *, count(*) OVER (PARTITION BY l_suppkey, l_returnflag) AS n FROM active WHERE r > 90),
silver AS (
  SELECT w.*, p.p_size, p.p_retailprice FROM warm w LEFT JOIN part p ON w.l_partkey = p.p_partkey
  WHERE n >= 100),
gold AS (
  SELECT *, {STRENGTH_SQL} AS strength FROM silver WHERE l_tax > 0)"""


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Process rows after silence, warm-up and fragment rules, with part attributes."""
    rows = table(spark, sf_dir, "lineitem").select(
        *FRAGMENT, *ORDER, SPEED, FORCE, EJECTION, THICKNESS)
    kept = trim_warmup(cleaning.drop_silence(rows, SPEED), FRAGMENT, ORDER, 90, 100)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return kept.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")


def gold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_tensile_strength(silver_rows(spark, sf_dir), FORCE, "p_size", THICKNESS,
                                          "strength")


@query("purge", f"""
WITH {PURGED_SQL}
SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey, p_size, strength FROM gold
""")
def purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw process rows to cleaned rows with tensile strength."""
    return gold_rows(spark, sf_dir).select(*FRAGMENT, "l_orderkey", "l_linenumber", "l_partkey",
                                           "p_size", "strength")


@query("normalize_code", """
SELECT p_partkey, split_part(CAST(p_retailprice AS VARCHAR), '.', 1) AS code FROM part
""")
def normalized_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", normalize_code(F.col("p_retailprice")).alias("code"))


@query("golden_filter", "SELECT event_id, value FROM events WHERE value >= 80")
def golden_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.golden_rows(table(spark, sf_dir, "events").select("event_id", "value"), "value", 80.0)


@query("select_features", """
SELECT ts AS "timestamp", value, k FROM (
  SELECT CAST(epoch_us(ts) AS BIGINT) AS ts, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
""")
def select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumns({
        "timestamp": F.unix_micros(F.col("ts").cast("timestamp")),
        "k": F.get_json_object("props", "$.k").cast("bigint")})
    return features.select_features(rows, ["value", "k"])


@query("has_ampm", """
SELECT o_orderpriority, bool_or(o_orderstatus = 'P') AS has_ampm FROM orders GROUP BY o_orderpriority
""")
def has_ampm(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd hh:mm a"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")))
    return (table(spark, sf_dir, "orders").select("o_orderpriority", text.alias("time"))
            .groupBy("o_orderpriority").agg(cleaning.has_mixed_time_format("time").alias("has_ampm")))


@query("assemble_vectors", """
SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS v0, c_acctbal AS v1
FROM customer WHERE c_acctbal BETWEEN 0 AND 9000
""")
def assemble_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors from columns with null and NaN: incomplete rows are skipped."""
    from pyspark.ml.functions import vector_to_array
    nation = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    rows = _balances(spark, sf_dir).join(nation, "c_custkey")
    vectors = features.assemble_vectors(rows, ["c_nationkey", "balance"])
    array = vector_to_array("features")
    return vectors.select("c_custkey", array[0].alias("v0"), array[1].alias("v1"))


DIAMETERS_SQL = ", ".join(f"('{k}', {v})" for k, v in features.PRODUCT_DIAMETERS.items())


@query("enrich_dimension", f"""
WITH dim(code, diameter) AS (VALUES {DIAMETERS_SQL})
SELECT l_orderkey, l_linenumber, l_partkey, p_size, CAST(diameter AS DOUBLE) AS diameter,
       bool_or(diameter IS NULL) OVER () AS any_null
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN dim ON CAST(p_size AS VARCHAR) = code
""")
def enrich_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product diameters by code; half of the codes are unmapped and stay null."""
    dimension = spark.createDataFrame(list(features.PRODUCT_DIAMETERS.items()),
                                      "product_code string, diameter double")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    coded = rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").drop("p_partkey")
    enriched = features.enrich_dimension(coded, dimension, "p_size")
    incomplete = features.any_null(enriched, "diameter").first()[0]
    return enriched.withColumn("any_null", F.lit(incomplete))


@query("golden_semi", """
SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality >= 1)
""")
def golden_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.golden_batches(table(spark, sf_dir, "documents").select("doc_id", "n_chars"),
                                   table(spark, sf_dir, "labels"), "doc_id", "quality", 1)


@query("rejected_anti", """
SELECT doc_id, n_chars FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality >= 1)
""")
def rejected_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.rejected_batches(table(spark, sf_dir, "documents").select("doc_id", "n_chars"),
                                     table(spark, sf_dir, "labels"), "doc_id", "quality", 1)


SCENARIOS = row_scenarios(["o_totalprice", "o_custkey"])
SCENARIOS_SQL = ", ".join(f"('{t}', '{f}', CAST({m} AS DOUBLE))" for t, f, m in SCENARIOS)


@query("scenario_grid", f"""
WITH drawn AS (SELECT o_orderkey FROM orders ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 200),
grid(type, feature, magnitude) AS (VALUES {SCENARIOS_SQL})
SELECT o_orderkey, type, feature, magnitude FROM drawn CROSS JOIN grid
""")
def scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = sample_n(table(spark, sf_dir, "orders").select("o_orderkey"), 200, ["o_orderkey"], 7)
    return scenario_grid(drawn, SCENARIOS)


@query("union_by_name", """
SELECT o_orderkey AS id, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS name FROM orders
UNION ALL SELECT c_custkey, c_acctbal, c_name FROM customer
""")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"),
                                                 F.col("o_totalprice").alias("amount"))
    right = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount"), F.col("c_custkey").alias("id"))
    return features.union_by_name(left, right)


@query("scalar_suite", """
SELECT o_orderkey,
       o_totalprice + 1 AS plus, o_totalprice - 1 AS minus, o_totalprice * 2 AS times,
       o_totalprice / 4 AS divided, abs(o_totalprice - 250000) AS absolute,
       sqrt(o_totalprice) AS root, round(o_totalprice / 1000, 1) AS rounded,
       o_totalprice * o_totalprice AS squared, pi() * o_totalprice AS by_pi,
       lower(o_orderpriority) AS lowered, trim(' ' || o_orderpriority || ' ') AS stripped,
       regexp_matches(o_orderpriority, 'URG|HIGH') AS has_word,
       split_part(o_orderpriority, '-', 1) AS before_dash,
       regexp_replace(o_orderpriority, '^[0-9]-', 'P-') AS renamed,
       starts_with(o_orderpriority, '1') AS is_first, suffix(o_orderpriority, 'LOW') AS is_low,
       CAST(floor(epoch(o_orderdate)) AS BIGINT) AS seconds,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END IS NULL AS is_missing,
       coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, '?') AS filled,
       upper(replace(o_orderpriority, '-', ' ')) AS displayed,
       array_to_string(list_transform(string_split(replace(o_orderpriority, '-', ' '), ' '),
                       lambda w: upper(w[1]) || lower(w[2:])), ' ') AS titled,
       least(o_totalprice, 100000) AS low, greatest(o_totalprice, 100000) AS high
FROM orders
""")
def scalar_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, word = F.col("o_totalprice"), F.col("o_orderpriority")
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", (x + 1).alias("plus"), (x - 1).alias("minus"), (x * 2).alias("times"),
        (x / 4).alias("divided"), F.abs(x - 250000).alias("absolute"), F.sqrt(x).alias("root"),
        F.round(x / 1000, 1).alias("rounded"), (x * x).alias("squared"), (F.pi() * x).alias("by_pi"),
        F.lower(word).alias("lowered"), F.trim(F.concat(F.lit(" "), word, F.lit(" "))).alias("stripped"),
        word.rlike("URG|HIGH").alias("has_word"), F.substring_index(word, "-", 1).alias("before_dash"),
        F.regexp_replace(word, "^[0-9]-", "P-").alias("renamed"),
        word.startswith("1").alias("is_first"), word.endswith("LOW").alias("is_low"),
        epoch_seconds(F.col("o_orderdate").cast("timestamp")).alias("seconds"),
        known.isNull().alias("is_missing"), F.coalesce(known, F.lit("?")).alias("filled"),
        F.upper(F.replace(word, F.lit("-"), F.lit(" "))).alias("displayed"),
        F.initcap(F.replace(word, F.lit("-"), F.lit(" "))).alias("titled"),
        F.least(x, F.lit(100000.0)).alias("low"), F.greatest(x, F.lit(100000.0)).alias("high"))


__all__ = ["clip", "gold_rows", "silver_rows"]
