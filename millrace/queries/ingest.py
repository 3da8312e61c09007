"""Scans, sources and sinks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.cleaning import cast_columns, filter_extension, split_valid
from millrace.operators.scaling import minmax_fit
from millrace.queries.registry import query, signals, table
from millrace.session import qualified, scratch_path
from millrace.plans.layers import silver, silver_job
from millrace.sources.archives import archives_to_bronze, expand_archives, open_store
from millrace.sources.delimited import read_csv, read_process_csv
from millrace.sources.layers import (
    layer_path, list_layer, read_dimension_json, read_layer, read_report, read_with_lineage, replace_parts, write_layer, write_report,
)
from millrace.sources.params import load_params, params_frame, save_params


@query("scan_csv_groups", """
SELECT event_id, CAST(epoch_us(ts) AS BIGINT) AS us, user_id, event_type, value,
       CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS layout
FROM events
""")
def scan_csv_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as text in two column orders and read back by header."""
    root = scratch_path(spark, "bronze")
    rows = signals(spark, sf_dir).withColumn("us", F.unix_micros("ts"))
    first = ["event_id", "us", "user_id", "event_type", "value"]
    even = F.col("event_id") % 2 == 0
    for name, columns, part in (("a", first, even), ("b", first[::-1], ~even)):
        (rows.filter(part).select(*[F.col(c).alias(f" {c.upper()}") for c in columns],
                                  F.lit(name).alias("Layout"))
         .write.option("sep", ";").option("header", "true").csv(f"{root}/{name}"))
    read, _ = read_process_csv(spark, root, roles={"time": ("us",)}, needed=("time",), moved=())
    return (cast_columns(cast_columns(read, ["event_id", "us", "user_id"], "bigint"), ["value"])
            .select(*first, "layout"))


@query("scan_project", "SELECT l_orderkey, l_quantity, l_tax FROM lineitem")
def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_layer(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity", "l_tax"])


@query("scan_with_lineage", """
SELECT 'events.parquet' AS source_file, count(*) AS n, min(event_id) AS first_id,
       max(event_id) AS last_id
FROM events
""")
def scan_with_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read_with_lineage(spark, sf_dir, "events.parquet").groupBy("source_file")
            .agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"),
                 F.max("event_id").alias("last_id")))


@query("dim_from_json", """
SELECT event_id, 'k' AS key, CAST(json_extract_string(props, '$.k') AS BIGINT) AS value FROM events
""")
def dim_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_dimension_json(table(spark, sf_dir, "events").select("event_id", "props"),
                               "props", "bigint")


def _zip_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One archive per Arrow batch: a folder entry and one delimited member per event type."""
    for frame in frames:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("Process/", "")
            for kind, part in frame.groupby("event_type"):
                lines = part["event_id"].astype(str) + ";" + part["value"].map(repr)
                archive.writestr(f"Process/{kind}.csv", "\n".join(lines) + "\n")
        yield pd.DataFrame({"path": [f"{frame['event_id'].iloc[0]}.zip"],
                            "content": [buffer.getvalue()]})


@query("expand_archives", """
SELECT 'process_time_series/' || event_type || '.csv' AS member, event_id, value FROM events
""")
def expanded_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events zipped on the workers, expanded to lines and parsed again."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    archives = rows.mapInPandas(_zip_batches, "path string, content binary")
    fields = F.split("line", ";")
    return expand_archives(archives).select(
        "member", fields[0].cast("bigint").alias("event_id"), fields[1].cast("double").alias("value"))


def _zip_files(folder: str):
    """Archives of a folder entry and one delimited file per event type, written by the tasks."""
    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = open_store(folder)
        system.create_dir(root, recursive=True)
        for frame in frames:
            first = frame["event_id"].iloc[0]
            with system.open_output_stream(f"{root}/{first}.Zip") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("Process/", "")
                for kind, part in frame.groupby("event_type"):
                    rows = (part["event_type"] + ";" + part["time"] + ";" + part["value"].map(repr) + ";"
                            + part["event_id"].astype(str))
                    z.writestr(f"Process/{kind}/{first}.csv", "Batch;Log Time;Speed;event_id\n" + "\n".join(rows) + "\n")
            yield frame[["event_id"]].iloc[:1]
    return write


@query("archives_to_silver", """
WITH active AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS r
                FROM events WHERE value > 0),
warm AS (SELECT *, count(*) OVER (PARTITION BY event_type) AS n FROM active WHERE r > 90)
SELECT event_type AS batch, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, max(value) AS top
FROM warm WHERE n >= 100 GROUP BY event_type
""")
def archives_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in archives, their members written below the raw layer, and cleaned from there."""
    folder, bronze, clean = (scratch_path(spark, n) for n in ("archives", "bronze", "silver"))
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"))
    rows.mapInPandas(_zip_files(qualified(spark, folder)), "event_id bigint").count()
    archives_to_bronze(spark, folder, bronze)
    none = spark.createDataFrame([], "product_code string, diameter double")
    silver_job(spark, bronze, clean, none, ["batch"], ["speed", "event_id"], ["event_id"])
    return read_layer(spark, clean).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").cast("bigint").alias("ids"), F.max("speed").alias("top"))


# Three layouts whose time, speed and code columns differ in name and place; the fourth has no time.
LAYOUTS = {
    "a": ["time as timestamp", "value as tbl_speed", "code as code", "event_id", "layout"],
    "b": ["code as Product", "event_id", "value as ` Speed`", "time as `Log Date`", "layout"],
    "c": ["layout", "value as speed_rpm", "event_id", "time as datetime", "code as product_code"],
    "d": ["layout", "value as speed_rpm", "event_id", "code as product_code"],
}


@query("silver_mixed_layouts", """
WITH rows AS (SELECT *, event_id % 8 AS part, substr('abcd', CAST(event_id % 4 AS INT) + 1, 1) AS layout FROM events),
active AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY ts, event_id) AS r FROM rows
           WHERE layout <> 'd' AND value > 0),
warm AS (SELECT *, count(*) OVER (PARTITION BY part) AS n FROM active WHERE r > 90),
kept AS (SELECT layout, count(*) AS n FROM warm WHERE n >= 100 GROUP BY layout)
SELECT 'kept ' || layout AS outcome, n, n AS with_diameter FROM kept
UNION ALL SELECT 'ruled out', (SELECT count(*) FROM rows WHERE layout <> 'd') - (SELECT coalesce(sum(n), 0) FROM kept), 0
UNION ALL SELECT 'malformed row', 1, 0
UNION ALL SELECT 'no column named like time or date', (SELECT count(DISTINCT part) FROM rows WHERE layout = 'd'), 0
""")
def silver_mixed_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of four layouts, two folders with equal file names each, to one cleaned table."""
    bronze, clean = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    part, layout = F.col("event_id") % 8, F.substr(F.lit("abcd"), (F.col("event_id") % 4 + 1).cast("int"), F.lit(1))
    rows = table(spark, sf_dir, "events").select(
        "event_id", "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"), F.lit("5.0").alias("code"),
        part.alias("part"), layout.alias("layout"))
    for name, columns in LAYOUTS.items():
        # One file for each value of ``part``; files that one task writes have the same name.
        (rows.filter(F.col("layout") == name).repartition(1 if name == "a" else 2, "part").selectExpr(*columns, "part")
         .write.partitionBy("part").option("sep", ";").option("header", "true").csv(f"{bronze}/{name}"))
    cut_off = rows.orderBy("event_id").limit(1).select(F.concat_ws(";", "time", "value").alias("value"))
    head = spark.createDataFrame([("timestamp;tbl_speed;code;event_id;layout",)], "value string")
    head.union(cut_off).coalesce(1).write.option("compression", "none").text(f"{bronze}/e")
    dimension = spark.createDataFrame([("5", 7.0)], "product_code string, diameter double")
    # Text files end in .txt, the others in .csv: both are asked for.
    raw, rejected = read_process_csv(spark, bronze, glob="*.{csv,txt}")
    write_layer(silver(raw, dimension, numeric=["event_id"], tie_break=["event_id"]), clean)
    found = read_layer(spark, clean)
    kept = found.groupBy("layout").agg(F.count(F.lit(1)).alias("n"), F.count("diameter").alias("with_diameter"))
    whole = raw.agg(F.count(F.lit(1)).alias("a")).join(found.agg(F.count(F.lit(1)).alias("b")))
    return (kept.select(F.concat(F.lit("kept "), "layout").alias("outcome"), "n", "with_diameter")
            .union(whole.select(F.lit("ruled out"), F.col("a") - F.col("b"), F.lit(0).cast("bigint")))
            .union(rejected.groupBy("reason").count().select("reason", "count", F.lit(0).cast("bigint"))))


@query("layer_listing", """
SELECT event_type AS folder, 1 AS files, count(*) AS rows FROM events GROUP BY event_type
""")
def layer_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a layer, found by its name and listed by ending, and read as comma-separated text."""
    path = layer_path("Bronze", {"bronze": scratch_path(spark, "bronze")})
    (table(spark, sf_dir, "events").select("event_id", "event_type").repartition("event_type")
     .write.partitionBy("event_type").option("header", "true").csv(path))
    files = list_layer(spark, path, ".csv").groupBy(F.regexp_extract("path", "event_type=([^/]+)/", 1).alias("folder")).agg(
        F.count(F.lit(1)).cast("int").alias("files"))
    rows = read_csv(spark, path).groupBy(F.col("event_type").alias("folder")).agg(F.count("event_id").alias("rows"))
    return files.join(rows, "folder")


@query("filter_extension", """
SELECT page_id, url FROM pages WHERE lower(url) LIKE '%.html' OR lower(url) LIKE '%.zip'
""")
def extension_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_extension(table(spark, sf_dir, "pages").select("page_id", "url"),
                            "url", [".html", ".zip"])


@query("fragment_rerun", """
SELECT l_orderkey, l_linenumber, l_suppkey % 7 AS fragment,
       CASE WHEN l_suppkey % 7 = 3 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity
FROM lineitem WHERE l_suppkey % 7 <> 5
""")
def fragment_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer by fragment; a second run of one fragment, and a first one of another, keep the rest."""
    path = scratch_path(spark, "fragments")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_suppkey") % 7).alias("fragment"))
    replace_parts(rows.where("fragment not in (5, 6)"), path, ["fragment"])
    replace_parts(rows.where("fragment in (3, 6)").withColumn(
        "l_quantity", F.when(F.col("fragment") == 3, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))), path, ["fragment"])
    return spark.read.parquet(path).withColumn("fragment", F.col("fragment").cast("bigint"))


@query("sink_roundtrip", """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines,
       max(l_extendedprice) AS top
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    write_layer(table(spark, sf_dir, "lineitem").drop("l_shipdate"), path, ["l_returnflag"])
    return (read_layer(spark, path).groupBy("l_returnflag", "l_linestatus")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"),
                 F.max("l_extendedprice").alias("top")))


@query("report_roundtrip", """
SELECT fmt, event_type, count(*) AS n, max(value) AS top
FROM events, (VALUES ('csv'), ('json')) AS f(fmt) GROUP BY fmt, event_type
""")
def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = (table(spark, sf_dir, "events").groupBy("event_type")
              .agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top")))
    parts = []
    for fmt in ("csv", "json"):
        path = scratch_path(spark, "report")
        write_report(report, path, fmt)
        parts.append(read_report(spark, path, report.schema, fmt).withColumn("fmt", F.lit(fmt)))
    return parts[0].unionByName(parts[1]).select("fmt", "event_type", "n", "top")


@query("quarantine_split", """
SELECT event_type, value > 0 AND value <= 100 AS accepted, count(*) AS n, max(value) AS top
FROM events GROUP BY 1, 2
""")
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", "value")
    good, bad = split_valid(rows, (F.col("value") > 0) & (F.col("value") <= 100))
    both = good.withColumn("accepted", F.lit(True)).unionByName(bad.withColumn("accepted", F.lit(False)))
    return both.groupBy("event_type", "accepted").agg(F.count(F.lit(1)).alias("n"),
                                                      F.max("value").alias("top"))


@query("params_roundtrip", """
SELECT 'minmax' AS model, name, CAST(0 AS BIGINT) AS i, CAST(j AS BIGINT) AS j, value FROM (
  SELECT 'offset' AS name, 0 AS j, min(l_quantity) AS value FROM lineitem UNION ALL
  SELECT 'offset', 1, min(l_extendedprice) FROM lineitem UNION ALL
  SELECT 'scale', 0, max(l_quantity) - min(l_quantity) FROM lineitem UNION ALL
  SELECT 'scale', 1, max(l_extendedprice) - min(l_extendedprice) FROM lineitem)
""")
def params_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaler = minmax_fit(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])
    path = scratch_path(spark, "params")
    save_params(spark, path, "minmax", {"offset": scaler.offset, "scale": scaler.scale})
    return params_frame(spark, "minmax", load_params(spark, path, "minmax")).select(
        "model", "name", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
        "value")
