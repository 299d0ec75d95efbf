"""Files around the data: sizes, versions, JSON, and metric sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.functions.text import size_text
from precis.operators.rouge import METRICS
from precis.session import stage_table


def file_sizes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(path, length, size)`` of the files below ``path``. Contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )
    return files.withColumn("size", size_text(F.col("length")))


def total_size(files: DataFrame) -> DataFrame:
    """Files, bytes and readable size in all."""
    return files.agg(
        F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("length")
    ).withColumn("size", size_text(F.col("length")))


def latest_artifact(df: DataFrame, path: str, family: Column, version: Column) -> DataFrame:
    """The path with the highest version number of every family.

    ``checkpoint-1000`` beats ``checkpoint-800``; equal versions resolve to the last path.
    """
    found = df.select(
        family.alias("family"), version.try_cast("bigint").alias("version"), F.col(path).alias("path")
    )
    latest = F.max(F.struct("version", "path")).alias("latest")
    return (
        found.where(F.col("version").isNotNull())
        .groupBy("family")
        .agg(F.count(F.lit(1)).alias("n_versions"), latest)
        .select("family", "n_versions", "latest.version", "latest.path")
    )


def trailing_number(path: Column) -> Column:
    """The number at the end of a path, as text; empty when there is none."""
    return F.regexp_extract(path, r"([0-9]+)\z", 1)


def save_json(df: DataFrame, path: str) -> None:
    """Write rows as JSON lines; parent folders are made."""
    df.write.mode("overwrite").json(path)


def load_json(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = False) -> DataFrame:
    """Read JSON lines, or whole JSON files with ``multi_line``."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def metrics_wide(
    scores: DataFrame,
    by: Sequence[str] = ("model",),
    value: str = "f1",
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """One row per model with a column per metric."""
    return scores.groupBy(*by).pivot("metric", list(metrics)).agg(F.first(value))


def write_metrics(wide: DataFrame, path: str) -> None:
    """The metric table (a row per model) as one CSV and one JSON file beside it."""
    table = stage_table(wide, "metrics").coalesce(1)
    table.write.mode("overwrite").option("header", True).csv(f"{path}.csv")
    table.write.mode("overwrite").json(f"{path}.json")
