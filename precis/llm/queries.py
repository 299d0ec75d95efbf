"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.llm import (
    bloom_lm,
    chat,
    decontaminate,
    langid,
    mixing,
    oracles,
    pieces,
    quality,
    resample,
    simhash,
    spans,
    token_files,
    url_filter,
    variants,
)
from precis.llm.words import counted
from precis.session import scratch_path, stage_table
from precis.sources.pairs import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _remainder(key: str, n: int):
    """crc32 of the key as text, modulo ``n``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


@query
def op1_cross_parsing(spark, d):
    docs = read_table(spark, d, "documents")
    known = langid.samples(docs, "doc_id", "text", "lang", _remainder("doc_id", 5) != 0)
    found = langid.identify(docs, "doc_id", "text", known).withColumnRenamed("key", "doc_id")
    return found.withColumn("held_out", F.coalesce(_remainder("doc_id", 5) == 0, F.lit(True)))


@query
def op2_decontamination(spark, d):
    docs, benchmark = read_table(spark, d, "documents"), read_table(spark, d, "benchmark")
    found = decontaminate.contamination(docs, "doc_id", "text", benchmark, "item_id", "text")
    return found.select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "start", "similarity")


ORACLES["op2_decontamination"] = oracles.DECONTAMINATION


@query
def op3_bloom_lm(spark, d):
    docs = read_table(spark, d, "documents")
    found = bloom_lm.score(docs, "doc_id", "text", _remainder("doc_id", 7) != 2)
    return found.withColumn("held_out", ~F.col("learned")).drop("learned").withColumnRenamed("key", "doc_id")


@query
def op4_repeated_spans(spark, d):
    return spans.without_repeats(read_table(spark, d, "documents"), "doc_id", "text").withColumnRenamed("key", "doc_id")


ORACLES["op4_repeated_spans"] = oracles.REPEATED_SPANS
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


@query
def op5_token_files(spark, d):
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    docs = read_table(spark, d, "documents")
    token_files.write_token_files(docs, "doc_id", "text", path, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.read_token_files(spark, path).withColumnRenamed("key", "doc_id")


@query
def op6_entropy_mix(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "source", "text")
    sized = stage_table(counted(docs, "text", "size").drop("text"), "mix-input")
    mix = mixing.mixed(sized, "doc_id", "size", "source")
    taken = F.col("size") * F.col("copies")
    return mix.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


@query
def op7_weak_supervision(spark, d):
    found = quality.verdicts(read_table(spark, d, "documents"), "doc_id", "text")
    return found.withColumnRenamed("key", "doc_id")


# The rules of the query, and words that hosts of spam carry.
SITES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
SPAM_WORDS = ("casino", "cheap-pills", "spam-farm")


@query
def op8_url_filter(spark, d):
    globs = url_filter.site_globs(SITES) + url_filter.word_globs(SPAM_WORDS)
    found = url_filter.filtered(read_table(spark, d, "pages"), "page_id", "url", globs)
    site = F.col("rule").isin([rule for _, rule in SITES])
    return found.withColumn("rule", F.when(site, F.col("rule"))).withColumnRenamed("key", "page_id")


ORACLES["op8_url_filter"] = oracles.url_filter(SITES, SPAM_WORDS)


@query
def op9_simhash_near_duplicates(spark, d):
    docs = read_table(spark, d, "documents")
    found = simhash.near_duplicates(docs, "doc_id", "text")
    return found.select(
        F.col("key").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op10_quotation_linking(spark, d):
    talk = read_table(spark, d, "conversations")
    return chat.reply_ordered(talk, "conv_id", "turn", "role", "text").withColumnRenamed("conv", "conv_id")


ORACLES["op10_quotation_linking"] = oracles.QUOTATION_LINKING


@query
def op11_spelling_variants(spark, d):
    return variants.variants(read_table(spark, d, "documents"), "doc_id", "text", drop_every=199)


ORACLES["op11_spelling_variants"] = oracles.SPELLING_VARIANTS


@query
def op12_importance_resampling(spark, d):
    docs, target = read_table(spark, d, "documents"), read_table(spark, d, "benchmark")
    return resample.resample(docs, "doc_id", "text", target, "text").withColumnRenamed("key", "doc_id")


ORACLES["op12_importance_resampling"] = oracles.IMPORTANCE_RESAMPLING


PIECES = "piece_bpe_32k.model"


@query
def op13_piece_encoding(spark, d):
    import public_tokenizers

    docs = read_table(spark, d, "documents")
    found = pieces.encoded(docs, "doc_id", "text", public_tokenizers.path(PIECES), decode=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        F.col("key").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
