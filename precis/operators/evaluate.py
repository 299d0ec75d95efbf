"""Score summarisers on reference summaries and compare them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.operators.rouge import METRICS, corpus_scores, rouge_scores
from precis.operators.summarize import MAX_WORDS, METHODS, summarize


def pair_predictions(predictions: DataFrame, references: DataFrame, key: Sequence[str]) -> DataFrame:
    """Predictions beside their references: joined by key, never by position."""
    return references.join(predictions, list(key))


def predictions_of(
    df: DataFrame,
    methods: Sequence[str],
    key: str = "id",
    text: str = "dialogue",
    keep: Sequence[str] = ("summary", "split"),
    max_words: int = MAX_WORDS,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Summaries of every method, with a ``model`` column."""
    parts = [
        summarize(df, key, text, m, keep, max_words, fit_on).withColumn("model", F.lit(m))
        for m in methods
    ]
    return reduce(DataFrame.unionByName, parts)


def evaluate(
    df: DataFrame,
    methods: Sequence[str] = METHODS,
    key: str = "id",
    text: str = "dialogue",
    reference: str = "summary",
    metrics: Sequence[str] = METRICS,
    stemmed: bool = False,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Corpus ROUGE per model and split: summarise, score, average in one job."""
    predicted = predictions_of(df, methods, key, text, (reference, "split"), fit_on=fit_on)
    scores = rouge_scores(
        predicted, ["model", key], "prediction", reference, metrics, ["split"], stemmed
    )
    return corpus_scores(scores, ["model", "split", "metric"])
