"""The request checks and summaries of the batch path, on a stream of files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from precis.operators.requests import Model, predict, validate_requests
from precis.operators.summarize import MAX_WORDS
from precis.operators.validate import per_column, profile
from precis.session import is_folder


def stream_table(spark: SparkSession, folder: str, schema: str, pattern: str, files_per_trigger: int = 100) -> DataFrame:
    """New Parquet files of ``folder`` whose names match ``pattern``."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def stream_named(spark: SparkSession, root: str, name: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """The table ``name`` below ``root`` as a stream, whether it is one Parquet file or a folder of them."""
    path = f"{root}/{name}.parquet"
    folder, pattern = (path, "*") if is_folder(spark, path) else (root, f"{name}.parquet")
    return stream_table(spark, folder, schema, pattern, files_per_trigger)


def once_within(requests: DataFrame, key: str, sent: str, within: str) -> DataFrame:
    """A request sent again within the delay passes once, also across micro-batches and restarts.

    Keys are held in the state store until the latest ``sent`` time is ``within`` past
    theirs, so the state is bounded. A request that comes later than that is late and
    doesn't pass; a null key is a key like any other.
    """
    return requests.withWatermark(sent, within).dropDuplicatesWithinWatermark([key])


def score_stream(
    requests: DataFrame,
    out: str,
    checkpoint: str,
    key: str,
    text: str = "text",
    keep: Sequence[str] = (),
    method: str = "lead",
    max_words: int = MAX_WORDS,
    max_length: str | None = None,
    model: Model | None = None,
    fitted: PipelineModel | None = None,
    sent: str | None = None,
    within: str = "1 day",
) -> StreamingQuery:
    """Responses below ``out/status=ok``, rejected requests below folders of their status.

    A micro-batch is read and checked once: rejected requests pass the model by,
    and one write deals out all rows by status. Every micro-batch writes its own folder
    and replaces it when it is repeated after a failure, so each request is answered
    exactly once; with ``sent``, the column of its time, also one that was sent twice
    (see ``once_within``). ``tfidf`` by name learns from each micro-batch anew; a
    ``fitted`` model (see ``predict``) gives the same answer in every batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = validate_requests(batch, text, max_length=max_length)
        good = F.col("status") == "ok"
        # A rejected text is blank to the model, which leaves it alone.
        asked = checked.withColumn("_asked", F.when(good, F.col(text)))
        own = [c for c in keep if c not in (text, "status")]
        answers = predict(asked, key, "_asked", [*own, text, "status"], method, max_words, max_length, model, fitted)
        told = [F.when(good, F.col(c)).alias(c) for c in ("summary", "input_length", "summary_length", "timestamp")]
        rows = answers.select(key, *own, F.col(text).alias("input_text"), *told, "error", "status")
        rows.write.mode("overwrite").partitionBy("status").parquet(f"{out}/batch={batch_id}")

    arriving = requests if sent is None else once_within(requests, key, sent, within)
    return (
        arriving.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def check_stream(arrivals: DataFrame, group: str, columns: Sequence[str], out: str, checkpoint: str) -> StreamingQuery:
    """Append the blank counts of every micro-batch to a check history."""

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = per_column(profile(batch.withColumn("split", F.col(group)), columns), columns)
        counts.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        arrivals.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def check_totals(history: DataFrame) -> DataFrame:
    """Totals over all micro-batches."""
    sums = [F.sum(c).alias(c) for c in ("n_rows", "n_blank", "n_values", "n_chars")]
    return history.groupBy("split", "column").agg(*sums)


def window_totals(
    arrivals: DataFrame, time: str, width: str, delay: str, group: Sequence[str], totals: Mapping[str, Column]
) -> DataFrame:
    """``window_start, <group>, n_rows`` and the named totals per event-time window, on a stream or a table.

    On a stream the windows are state, dropped once the latest time is ``delay`` past
    their end; a row that comes for such a window is late and counts nowhere. Rows
    without a time are in no window.
    """
    sums = [c.alias(name) for name, c in totals.items()]
    windows = arrivals.withWatermark(time, delay).groupBy(F.window(time, width).alias("_window"), *group)
    counted = windows.agg(F.count(F.lit(1)).alias("n_rows"), *sums)
    return counted.select(F.col("_window.start").alias("window_start"), *group, "n_rows", *totals)


def totals_stream(totals: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Keep the windows of ``window_totals`` up to date: each micro-batch writes those that it changed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        totals.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_totals(history: DataFrame, group: Sequence[str]) -> DataFrame:
    """The last state of every window in what ``totals_stream`` wrote."""
    values = [c for c in history.columns if c not in ("window_start", "batch", *group)]
    last = F.max_by(F.struct(*values), "batch").alias("_last")
    return history.groupBy("window_start", *group).agg(last).select("window_start", *group, "_last.*")
