"""From raw documents to token files in five stages.

Quality rules reject documents, one document of each group of near-duplicates
stays, documents that hold benchmark passages go, sources are mixed to target
weights by copying or leaving out documents, and what remains is tokenised into
seekable files. Each stage takes the table that the one before it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.llm import decontaminate, mixing, near_copies, quality, token_files
from precis.llm.words import counted
from precis.session import scratch_path, stage_table
from precis.sources.pairs import read_table

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep; a null text fails them."""
    judged = quality.judged(docs, "text")
    return judged.where(F.col(judged.columns[-1])["kept"]).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest doc_id, null last.

    Near-duplicates share at least 0.8 of their five-word shingles, or lead to each
    other through documents that do.
    Rows are told apart by a hash of all their columns: different rows under one
    doc_id, or without one, are documents of their own, and of rows that are equal
    in every column one stays.
    """
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64(*docs.columns).alias("row"))
    rows = docs.select(F.struct(*docs.columns).alias("all"), "text", name.alias("name"))
    found = near_copies.near_copies(rows, "name", "text")
    stay = found.where("key = component").select(F.col("key").alias("name")).distinct()
    return rows.join(stay, "name", "left_semi").dropDuplicates(["name"]).select("all.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no passage of the benchmark."""
    return decontaminate.decontaminated(docs, "text", read_table(spark, sf_dir, "benchmark"), "text")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target of words asks for: not at all, once or twice."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", "text")
    sized = counted(rows, "text", "size").drop("text")
    copied = mixing.mixed(sized, "doc_id", "size", "source")
    return copied.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files hold of each document: doc_id, start, n_tokens and the ids' checksum."""
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, "doc_id", "text", path, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.read_token_files(spark, path).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
    ("token_output", token_output),
]

# The estimate of the quality rules and the ids of the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
