"""Layered Parquet tables and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.session import scratch_path

LAYERS = ("bronze", "silver", "gold")


def layer_path(layer: str, roots: dict[str, str]) -> str:
    """Base URI of a layer (any case); an unknown name is taken as a path itself."""
    return roots.get(layer.lower(), layer)


def read_layer(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first path that exists, asked through the Hadoop file system of its scheme."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        uri = jvm.org.apache.hadoop.fs.Path(path)
        if uri.getFileSystem(conf).exists(uri):
            return path
    raise FileNotFoundError(f"none of {list(paths)} exists")


def list_layer(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(path, length) of all files below ``path`` that end in ``suffix``; no content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*{suffix}").load(path).select("path", "length"))


def read_with_lineage(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Union of all files by column name, with ``source_file`` (name of the file)."""
    df = (spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob).parquet(path))
    return df.withColumn("source_file", F.col("_metadata.file_name"))


def read_dimension_json(rows: DataFrame, text: str, value_type: str = "double") -> DataFrame:
    """(key, value) entries of a flat JSON object held in a text column; other columns are kept."""
    rest = [c for c in rows.columns if c != text]
    entries = F.from_json(F.col(text), f"map<string,{value_type}>")
    return rows.select(*rest, F.explode(entries).alias("key", "value"))


def read_dimension_file(spark: SparkSession, path: str, value_type: str = "double") -> DataFrame:
    """A JSON file with one flat object, such as product code -> diameter."""
    return read_dimension_json(spark.read.text(path, wholetext=True), "value", value_type)


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table.

    Rows are brought together per partition value before the write, so a value gets
    few files; ``rebalance`` lets Spark cut a value that holds most of the rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_parts(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    """Write ``df`` into a partitioned Parquet table, in place of the parts that it has rows of.

    A part is a combination of values of ``parts``, such as one fragment; all other parts stay as
    they are, so a re-run of some fragments replaces their output only. Spark swaps whole parts
    when the job commits, so a failed run leaves the table as it was. An empty ``df`` changes
    nothing; a table that is not there yet is made. Null is a part like any other.
    """
    if not parts:
        raise ValueError("a table without parts is replaced by write_layer")
    (df.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written once to the shared folder and read from there.

    For a table that several passes read: the passes prune columns and partitions,
    and a lost executor costs a file scan instead of the whole lineage.
    """
    path = scratch_path(df.sparkSession, name)
    write_layer(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        raise ValueError(f"unknown report format: {fmt}")


def read_report(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.option("header", "true").csv(path) if fmt == "csv" else reader.json(path)
