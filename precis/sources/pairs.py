"""Dialogue/summary pairs from turn tables and document tables.

Every pair row is ``(id STRING, dialogue STRING, summary STRING, split STRING)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Of every 20 consecutive numbers 18 train, 1 validates, 1 tests.
SPLITS = ("train", "validation", "test")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One Parquet table below ``root``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """``(doc_id, text)`` of the documents."""
    return read_table(spark, root, "documents").select("doc_id", "text")


def split_name(number: Column) -> Column:
    """Split of a row by its number."""
    place = F.pmod(number, F.lit(20))
    return F.when(place < 18, "train").when(place == 18, "validation").otherwise("test")


def _grouped_turns(turns: DataFrame) -> DataFrame:
    """Turns of each conversation, in order: what its one output row holds."""
    return (
        turns.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
        .withColumn("id", F.concat(F.lit("conv-"), F.col("conv_id")))
    )


def _lines(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(t.role, F.lit(": "), t.text)), "\n")


def dialogue_from_turns(turns: DataFrame) -> DataFrame:
    """``Speaker: text`` lines of each conversation, as ``(id, n_turns, dialogue)``."""
    return _grouped_turns(turns).select(
        "id", F.size("turns").alias("n_turns"), _lines(F.col("turns")).alias("dialogue")
    )


def pairs_from_turns(turns: DataFrame) -> DataFrame:
    """The last turn of an assistant is the summary, the turns before it the dialogue."""
    last = F.element_at("turns", -1)
    return (
        _grouped_turns(turns)
        .where((F.size("turns") > 1) & (last.role == "assistant"))
        .select(
            "id",
            _lines(F.slice("turns", F.lit(1), F.size("turns") - 1)).alias("dialogue"),
            last.text.alias("summary"),
            split_name(F.col("conv_id")).alias("split"),
        )
    )


def pairs_from_documents(documents: DataFrame) -> DataFrame:
    """The first line of a document is the summary, the rest the dialogue."""
    cut = F.instr("text", "\n")
    return documents.where(cut > 0).select(
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("id"),
        F.col("text").substr(cut + 1, F.length("text")).alias("dialogue"),
        F.col("text").substr(F.lit(1), cut - 1).alias("summary"),
        split_name(F.col("doc_id")).alias("split"),
    )


def load_pairs(spark: SparkSession, root: str) -> DataFrame:
    """All pairs of the provided conversations and documents."""
    return pairs_from_documents(read_documents(spark, root)).unionByName(
        pairs_from_turns(read_table(spark, root, "conversations"))
    )
