"""Named queries over the given tables, with the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it has no SQL counterpart on whole tables."""
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir)
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a signal table: instant ``ts`` and two sensors, ``value`` and ``k``."""
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
                         "event_type", "value",
                         F.get_json_object("props", "$.k").cast("double").alias("k"))


SIGNALS_SQL = """signals AS (
    SELECT event_id, ts, epoch_us(ts) AS us, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
    FROM events)"""

# Roles of the process table's columns.
FRAGMENT = ["l_suppkey", "l_returnflag"]
ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
ORDER_SQL = "l_shipdate, l_orderkey, l_linenumber, l_partkey"
SPEED, FORCE, EJECTION, THICKNESS = "l_discount", "l_extendedprice", "l_quantity", "l_tax"
SIGNAL_ORDER = ["ts", "event_id"]
