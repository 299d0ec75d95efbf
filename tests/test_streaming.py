"""State across micro-batches and restarts."""

from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

import pytest

from precis.plans.queries import QUERIES
from precis.session import scratch_path
from precis.streaming import scoring

SCHEMA = "id string, text string, sent timestamp"


def deliver(spark, folder, n, rows):
    """One file of requests ``(id, text, minute)``."""
    timed = [(i, t, m) for i, t, m in rows]
    df = spark.createDataFrame(timed, "id string, text string, minute int")
    sent = F.timestamp_seconds(F.lit(1_700_000_000) + 60 * F.col("minute"))
    df.coalesce(1).select("id", "text", sent.alias("sent")).write.parquet(f"{folder}/delivery={n}")


def run(spark, folder, out, checkpoint, **options):
    arrivals = scoring.stream_table(spark, folder, SCHEMA, "*.parquet", 1)
    scoring.score_stream(arrivals, out, checkpoint, "id", sent="sent", within="1 hour", **options).awaitTermination()
    return Counter(r.id for r in spark.read.parquet(out).collect())


def test_a_request_is_answered_once_across_restarts(spark):
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
    text = "a text that is long enough to be answered"
    deliver(spark, folder, 0, [("a", text, 0), ("b", text, 1), ("a", text, 2), (None, text, 2)])
    assert run(spark, folder, out, checkpoint) == Counter(["a", "b", None])
    # Sent again after the application stopped: the state comes back from the checkpoint.
    deliver(spark, folder, 1, [("b", text, 20), ("c", text, 30), (None, text, 30)])
    assert run(spark, folder, out, checkpoint) == Counter(["a", "b", "c", None])
    # Far later the names are forgotten, and what is older than the delay is late.
    deliver(spark, folder, 2, [("d", text, 600)])
    run(spark, folder, out, checkpoint)
    deliver(spark, folder, 3, [("e", text, 601)])
    run(spark, folder, out, checkpoint)
    deliver(spark, folder, 4, [("late", text, 3), ("a", text, 602)])
    got = run(spark, folder, out, checkpoint)
    assert got["a"] == 2 and got["d"] == 1 and "late" not in got


def test_window_totals_follow_the_arrivals(spark):
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
    totals = {"chars": F.sum(F.length("text").cast("long"))}

    def state():
        arrivals = scoring.stream_table(spark, folder, SCHEMA, "*.parquet", 1)
        windows = scoring.window_totals(arrivals, "sent", "1 hour", "2 hours", ["id"], totals)
        scoring.totals_stream(windows, out, checkpoint).awaitTermination()
        last = scoring.latest_totals(spark.read.parquet(out), ["id"])
        return {(r.id, int(r.window_start.timestamp()) // 3600 - 1_700_000_000 // 3600): (r.n_rows, r.chars) for r in last.collect()}

    # The first time lies 800 seconds into its hour.
    deliver(spark, folder, 0, [("x", "ab", 0), ("x", "c", 5), ("y", "d", 0), ("x", "e", 60), (None, "f", 0)])
    assert state() == {("x", 0): (2, 3), ("y", 0): (1, 1), ("x", 1): (1, 1), (None, 0): (1, 1)}
    deliver(spark, folder, 1, [("x", "g", 10), ("y", None, 70)])
    assert state() == {("x", 0): (3, 4), ("y", 0): (1, 1), ("x", 1): (1, 1), (None, 0): (1, 1), ("y", 1): (1, None)}
    deliver(spark, folder, 2, [("x", "h", 600)])
    state()
    deliver(spark, folder, 3, [("x", "i", 599)])
    state()
    deliver(spark, folder, 4, [("x", "late", 6), ("z", "j", 601)])
    got = state()
    assert got["x", 0] == (3, 4) and got["x", 10] == (2, 2)


def test_window_totals_of_a_table_are_those_of_the_stream(spark):
    folder = scratch_path(spark, "in")
    deliver(spark, folder, 0, [("x", "ab", m) for m in range(0, 300, 7)])
    table = spark.read.schema(SCHEMA).parquet(folder)
    got = scoring.window_totals(table, "sent", "1 hour", "1 hour", ["id"], {"chars": F.sum(F.length("text").cast("long"))})
    assert sum(r.n_rows for r in got.collect()) == 43


def written(spark, df, name, folder):
    """A root below which the table is a folder of two files, or one file."""
    root = scratch_path(spark, "tables")
    if folder:
        df.repartition(2).write.parquet(f"{root}/{name}.parquet")
    else:
        df.toPandas().to_parquet(make_root(root) / f"{name}.parquet", index=False)
    return root


def make_root(root):
    path = Path(root)
    path.mkdir(parents=True)
    return path


@pytest.mark.parametrize("folder", [True, False])
def test_blank_check_streams_a_table_of_one_file_or_many(spark, folder):
    rows = [(1, 0, "user", "hello"), (1, 1, "user", " "), (2, 0, "system", None), (2, 1, None, "abc")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = QUERIES["stream_blank_check"](spark, written(spark, turns, "conversations", folder)).collect()
    assert {r.role: (r.n_rows, r.n_blank, r.n_values, r.n_chars) for r in got} == {"user": (2, 1, 2, 6), "system": (1, 1, 0, 0), None: (1, 0, 1, 3)}


def test_requests_are_streamed_from_a_table_of_many_files(spark):
    rows = [(n, f"document {n} is long enough to be answered") for n in range(1, 5)] + [(5, "short"), (None, None)]
    root = written(spark, spark.createDataFrame(rows, "doc_id long, text string"), "documents", True)
    got = QUERIES["stream_predict"](spark, root).collect()
    assert Counter(r.doc_id for r in got) == Counter([1, 2, 3, 4, 5, None])


def test_a_delivery_of_many_files_is_one_micro_batch(spark, monkeypatch):
    rows = [(n, f"document {n} is long enough to be answered") for n in range(48)]
    root = scratch_path(spark, "tables")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(f"{root}/documents.parquet")
    started, start = [], scoring.score_stream
    monkeypatch.setattr(scoring, "score_stream", lambda *args, **options: started.append(start(*args, **options)) or started[-1])
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a partition, and so a file, for each file read
    try:
        got = QUERIES["stream_predict_once"](spark, root).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert Counter(r.doc_id for r in got) == Counter(range(48))
    assert sum(1 for q in started for p in q.recentProgress if p["numInputRows"]) == 4
