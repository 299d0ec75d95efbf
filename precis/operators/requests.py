"""Scoring requests: checks, responses, batch responses, and their log."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.functions.text import cut_words, strip
from precis.operators.skew import lookup_join
from precis.operators.summarize import MAX_WORDS, summarize, summarize_with
from precis.session import stage_table

# Limits of a request.
MIN_CHARS = 10
MIN_BATCH, MAX_BATCH = 1, 10
MIN_SUMMARY, MAX_SUMMARY = 1, 512

# Loads a model once per task; the model turns a list of texts into their summaries.
Model = Callable[[], Callable[[list[str]], list[str]]]


def request_status(text: Column, trim: bool = False, max_length: Column | None = None) -> Column:
    """``ok``, or why a request is rejected: ``missing``, ``too_short`` or ``max_length``."""
    measured = F.length(strip(text) if trim else text)
    status = F.when(text.isNull(), "missing").when(measured < MIN_CHARS, "too_short")
    if max_length is not None:
        in_range = F.coalesce(max_length.between(MIN_SUMMARY, MAX_SUMMARY), F.lit(True))
        status = status.when(~in_range, "max_length")
    return status.otherwise("ok")


def validate_requests(
    df: DataFrame, text: str = "text", trim: bool = False, max_length: str | None = None
) -> DataFrame:
    """Add ``status`` to every request."""
    limit = None if max_length is None else F.col(max_length)
    return df.withColumn("status", request_status(F.col(text), trim, limit))


def batch_sizes(df: DataFrame, batch: str) -> DataFrame:
    """``(batch, n, status)``: a batch holds 1 to 10 texts."""
    counts = df.groupBy(batch).agg(F.count(F.lit(1)).alias("n"))
    in_range = F.col("n").between(MIN_BATCH, MAX_BATCH)
    return counts.withColumn("status", F.when(in_range, "ok").otherwise("batch_size"))


def array_batch_status(texts: Column) -> Column:
    """Status of a batch that arrives as one array of texts."""
    return F.when(texts.isNull(), "missing").when(
        F.size(texts).between(MIN_BATCH, MAX_BATCH), "ok"
    ).otherwise("batch_size")


def validate_batches(df: DataFrame, batch: str, text: str = "text", max_length: str | None = None) -> DataFrame:
    """Status per text: that of its batch, then its own. A text without a batch is ``missing`` one.

    Sizes come from a counting aggregation; a batch of any size is never gathered.
    Every text gets one row back, repeated batches and positions included.
    """
    apart = df.where(F.col(batch).isNull()).withColumn("status", F.lit("missing"))
    sizes = stage_table(batch_sizes(df, batch).withColumnRenamed("status", "_batch"), "batches")
    # Sizes under names of their own, beside whatever columns the requests have.
    sizes = sizes.withColumnRenamed("n", "_texts")
    sized = lookup_join(df.where(F.col(batch).isNotNull()), sizes, batch, weight="_texts")
    own = request_status(F.col(text), max_length=None if max_length is None else F.col(max_length))
    checked = sized.withColumn("status", F.when(F.col("_batch") == "ok", own).otherwise(F.col("_batch")))
    return checked.drop("_batch", "_texts").unionByName(apart)


def predict(
    df: DataFrame,
    key: str,
    text: str = "text",
    keep: Sequence[str] = (),
    method: str = "lead",
    max_words: int = MAX_WORDS,
    max_length: str | None = None,
    model: Model | None = None,
    fitted: PipelineModel | None = None,
) -> DataFrame:
    """One response per text: input, summary, both lengths in characters, the time, and any error.

    A summary holds at most ``max_words`` words, or as many as the request's own
    ``max_length`` says where it is not null. A plug-in ``model`` (see
    ``summarize_with``) takes the place of the method; if it fails on a text,
    that response has its message as ``error`` and no summary. A ``fitted`` model of
    ``pyspark.ml`` that was saved once (see ``precis.operators.fitted``) takes raw texts
    from the column ``text`` names and adds ``prediction``; its own budget holds, and the
    request's, and what it learned stays the same whatever batch it is asked about. A
    blank text gets an empty summary.
    """
    budget = max_words if max_length is None else F.coalesce(F.col(max_length), F.lit(max_words))
    kept = [text, *[c for c in keep if c != text]]
    if fitted is not None:
        out = fitted.transform(df.select(key, *kept, F.lit(budget).alias("_request_words")))
        out = out.withColumn("prediction", cut_words(F.col("prediction"), F.col("_request_words")))
        out = out.withColumn("error", F.lit(None).cast("string"))
    elif model is None:
        out = summarize(df, key, text, method, keep=kept, max_words=budget)
        out = out.withColumn("error", F.lit(None).cast("string"))
    else:
        limited = df.select(key, *kept, F.lit(budget).alias("_request_words"))
        out = summarize_with(limited, text, model)
        out = out.withColumn("prediction", cut_words(F.col("prediction"), F.col("_request_words")))
    return out.select(
        key,
        *[c for c in keep if c != text],
        F.col(text).alias("input_text"),
        F.col("prediction").alias("summary"),
        F.length(text).alias("input_length"),
        F.length("prediction").alias("summary_length"),
        F.current_timestamp().alias("timestamp"),
        "error",
    )


def predict_batches(
    df: DataFrame,
    batch: str,
    position: str,
    text: str = "text",
    method: str = "lead",
    max_words: int = MAX_WORDS,
    max_length: str | None = None,
    model: Model | None = None,
    fitted: PipelineModel | None = None,
) -> DataFrame:
    """``(batch, results, count)`` of the valid texts of every valid batch, in order.

    Only batches of at most ten texts reach the gathering step. Texts of one batch
    and position are answered each, in the order of their text.
    """
    rows = validate_batches(df, batch, text, max_length).where(F.col("status") == "ok")
    keyed = rows.withColumn("_key", F.struct(F.col(batch).alias("batch"), F.col(position).alias("position")))
    responses = predict(keyed, "_key", text, [batch, position], method, max_words, max_length, model, fitted)
    fields = ["input_text", "summary", "input_length", "summary_length", "timestamp", "error"]
    gathered = F.array_sort(F.collect_list(F.struct(position, *fields)))
    return responses.groupBy(batch).agg(gathered.alias("results")).withColumn(
        "count", F.size("results")
    )


def compression(input_length: Column, summary_length: Column) -> Column:
    """Percent of the input that the summary leaves out, to one digit."""
    return F.round((1 - F.try_divide(summary_length, input_length)) * 100, 1)


def scoring_log(responses: DataFrame) -> DataFrame:
    """Totals per status: responses, characters in and out, and mean summary length."""
    n = F.count(F.lit(1))
    return responses.groupBy("status").agg(
        n.alias("n_texts"),
        F.sum(F.col("input_length").cast("long")).alias("chars_in"),
        F.sum(F.col("summary_length").cast("long")).alias("chars_out"),
        F.round(F.sum(F.col("summary_length").cast("long")) / n, 6).alias("mean_summary_chars"),
    )
