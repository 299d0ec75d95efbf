"""Vocabulary, encoding to ids, padding, masks, and decoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precis.functions.text import tokens
from precis.operators.rouge import corpus_scores, rouge_scores
from precis.operators.skew import lookup_arrays, with_positions

# Special ids, ignored-label mark, and default lengths.
START, PAD, END, UNKNOWN = 0, 1, 2, 3
FIRST_WORD_ID = 4
IGNORE = -100
MAX_INPUT, MAX_TARGET = 1024, 128


def build_vocab(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(token, n, token_id)`` of every token in ``columns``, most frequent first.

    Counts combine before the shuffle; the numbering is distributed.
    """
    toks = [tokens(F.coalesce(c, F.lit(""))) for c in columns]
    counts = (
        df.select(F.explode(F.concat(*toks)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = with_positions(counts, ["n", "token"], descending=["n"])
    return ranked.select("token", "n", (F.col("pos") + FIRST_WORD_ID).alias("token_id"))


def encode(
    df: DataFrame,
    key: str,
    columns: Mapping[str, int],
    vocab: DataFrame,
    pad: bool = True,
    keep_source: bool = False,
) -> DataFrame:
    """``<column>_ids`` and ``<column>_mask`` for every column, at most its length long.

    ``[start] + ids + [end]``, truncated to the length and, with ``pad``, filled
    up to it. Every row gives one, whether its key repeats or is null.
    """
    if min(columns.values(), default=2) < 2:
        raise ValueError("a length must leave room for the start and end ids")
    arrays = {c: F.slice(tokens(F.coalesce(c, F.lit(""))), 1, n - 2) for c, n in columns.items()}
    arrays = {f"{c}_ids": a for c, a in arrays.items()}
    out = lookup_arrays(df, df.columns if keep_source else [key], arrays, vocab, "token", "token_id", weight="n")
    for c, n in columns.items():
        ids = F.transform(f"{c}_ids", lambda x: F.coalesce(x.cast("int"), F.lit(UNKNOWN)))
        out = out.withColumn(f"{c}_ids", F.concat(F.array(F.lit(START)), ids, F.array(F.lit(END))))
        real = F.array_repeat(F.lit(1), F.size(f"{c}_ids"))
        out = out.withColumn(f"{c}_mask", padded(real, n, 0) if pad else real)
        if pad:
            out = out.withColumn(f"{c}_ids", padded(F.col(f"{c}_ids"), n, PAD))
    return out


def padded(array: Column, n: Column | int, fill: int) -> Column:
    """``array`` filled up to length ``n``."""
    return F.concat(array, F.array_repeat(F.lit(fill), n - F.size(array)))


def pad_to_longest(df: DataFrame, ids: str, batch: Sequence[str] = ("split", "chunk")) -> DataFrame:
    """Pad ``ids`` to the longest array of its batch. A batch has a fixed number of rows."""
    longest = F.max(F.size(ids)).over(Window.partitionBy(*batch))
    return df.withColumn("_longest", longest).withColumn(
        ids, padded(F.col(ids), F.col("_longest"), PAD)
    ).drop("_longest")


def mask_padding(labels: Column) -> Column:
    """Padding ids become the mark that a loss ignores."""
    return F.transform(labels, lambda x: F.when(x == PAD, IGNORE).otherwise(x))


def unmask_labels(labels: Column) -> Column:
    """The ignore mark becomes the padding id again."""
    return F.transform(labels, lambda x: F.when(x == IGNORE, PAD).otherwise(x))


def decode(
    df: DataFrame, key: str, columns: Sequence[str], vocab: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """Text of id columns, special ids skipped, as ``(key, keep, <column>_text)``."""
    arrays = {c: F.filter(c, lambda x: x >= FIRST_WORD_ID) for c in columns}
    arrays = {f"{c}_text": a for c, a in arrays.items()}
    out = lookup_arrays(df, [key, *keep], arrays, vocab, "token_id", "token", weight="n")
    texts = [F.array_join(F.filter(f"{c}_text", lambda x: x.isNotNull()), " ").alias(f"{c}_text") for c in columns]
    return out.select(key, *keep, *texts)


def compute_metrics(
    df: DataFrame, key: str, predictions: str, labels: str, vocab: DataFrame, stemmed: bool = False
) -> DataFrame:
    """ROUGE of predicted against label ids: unmask, decode, score, mean to four digits."""
    ids = df.select(key, predictions, unmask_labels(F.col(labels)).alias(labels))
    texts = decode(ids, key, [predictions, labels], vocab)
    scores = rouge_scores(texts, [key], f"{predictions}_text", f"{labels}_text", stemmed=stemmed)
    return corpus_scores(scores, ["metric"], digits=4)
