import pytest
from pyspark.sql import functions as F

from precis.operators import requests as R
from precis.streaming import scoring as ST

CHAT = (
    "Ines: The kiln is free on Tuesday.\nOmar: I can bring the glazes.\nInes: Two shelves are ours.\n"
    "Omar: Then we fire the bowls first. The plates can wait a week."
)


@pytest.mark.parametrize(
    "text, limit, trim, want",
    [
        (CHAT, None, False, "ok"), ("hi", None, False, "too_short"), (None, None, False, "missing"),
        (CHAT, 9999, False, "max_length"), (CHAT, 0, False, "max_length"), (CHAT, 512, False, "ok"),
        ("123456789", None, False, "too_short"), ("1234567890", None, False, "ok"),
        ("  hi        ", None, False, "ok"), ("  hi        ", None, True, "too_short"),
        ("🎉 Tom: Happy birthday!\nLisa: thanks", None, True, "ok"), ("", None, False, "too_short"),
    ],
)
def test_single_request(spark, text, limit, trim, want):
    df = spark.createDataFrame([(text, limit)], "text string, max_length int")
    assert R.validate_requests(df, trim=trim, max_length="max_length").first().status == want


def test_batch_as_array(spark):
    rows = [(1, []), (2, [CHAT]), (3, [CHAT] * 10), (4, [CHAT] * 11), (5, None)]
    df = spark.createDataFrame(rows, "i int, texts array<string>")
    got = {r.i: r.s for r in df.select("i", R.array_batch_status(F.col("texts")).alias("s")).collect()}
    assert got == {1: "batch_size", 2: "ok", 3: "ok", 4: "batch_size", 5: "missing"}


@pytest.fixture
def batches(spark):
    rows = [("a", 1, "Tom: I like tea a lot."), ("a", 0, CHAT), ("b", 0, "short"), ("b", 1, "long enough text")]
    rows += [("hot", i, f"message number {i}") for i in range(400)]
    return spark.createDataFrame(rows, "batch string, position int, text string")


def test_batch_status_per_text(batches):
    got = {(r.batch, r.position): r.status for r in R.validate_batches(batches, "batch").collect()}
    assert got["a", 0] == got["a", 1] == got["b", 1] == "ok"
    assert got["b", 0] == "too_short"
    assert sum(s == "batch_size" for s in got.values()) == 400 and len(got) == 404


def test_texts_without_a_batch_or_with_the_same_place(spark):
    rows = [(None, 1, "a text that is long enough"), (None, None, "short"), ("a/1", 1, "the first of two texts"), ("a/1", 1, "another of two texts"), ("a", None, "a text without a place")]
    df = spark.createDataFrame(rows, "batch string, position int, text string")
    got = [(r.batch, r.text, r.status) for r in R.validate_batches(df, "batch").collect()]
    assert sorted(got, key=str) == sorted([(b, t, "missing" if b is None else "ok") for b, _, t in rows], key=str)
    for method in ("lead", "tfidf"):
        answered = {r.batch: [x.input_text for x in r.results] for r in R.predict_batches(df, "batch", "position", method=method).collect()}
        assert answered == {"a/1": ["another of two texts", "the first of two texts"], "a": ["a text without a place"]}
    named = df.withColumns({"n": F.lit(1), "status": F.lit("x")})
    assert R.validate_batches(named, "batch").where("n = 1").count() == 5


def test_batch_responses_are_ordered(batches):
    got = {r.batch: r for r in R.predict_batches(batches, "batch", "position").collect()}
    assert set(got) == {"a", "b"}
    first = got["a"].results[0]
    assert [x.position for x in got["a"].results] == [0, 1] and got["a"]["count"] == 2
    assert (first.input_text, first.input_length) == (CHAT, len(CHAT))
    assert first.summary and first.summary_length == len(first.summary)
    assert len({x.timestamp for r in got.values() for x in r.results}) == 1


def test_no_requests(spark):
    empty = spark.createDataFrame([], "batch string, position int, text string")
    assert R.predict_batches(empty, "batch", "position").count() == 0


def test_compression_and_log(spark):
    df = spark.createDataFrame([("ok", 200, 25), ("ok", 100, 50), ("too_short", 2, None)], "status string, input_length int, summary_length int")
    ratio = df.select(R.compression(F.col("input_length"), F.col("summary_length")).alias("c")).collect()
    assert [r.c for r in ratio] == [87.5, 50.0, None]
    log = {r.status: r for r in R.scoring_log(df).collect()}
    assert (log["ok"].n_texts, log["ok"].chars_in, log["ok"].mean_summary_chars) == (2, 300, 37.5)
    zero = spark.createDataFrame([(0, 0)], "a int, b int")
    assert zero.select(R.compression(F.col("a"), F.col("b")).alias("c")).first().c is None


SCHEMA = "id long, text string"


def write(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    first = [(1, CHAT), (2, "tiny"), (3, None)]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.parquet(source)
    for expected in (1, 1):
        arrivals = ST.stream_table(spark, source, SCHEMA, "*.parquet")
        ST.score_stream(arrivals, out, checkpoint, "id").awaitTermination()
        assert spark.read.parquet(out).where("status = 'ok'").count() == expected
    second = [(4, "Ann: a new request here."), (5, "x")]
    spark.createDataFrame(second, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    ST.score_stream(ST.stream_table(spark, source, SCHEMA, "*.parquet"), out, checkpoint, "id").awaitTermination()
    streamed = {r.id: r.summary for r in spark.read.parquet(out).where("status = 'ok'").collect()}
    everything = spark.createDataFrame(first + second, SCHEMA)
    good = R.validate_requests(everything).where("status = 'ok'")
    assert streamed == {r.id: r.summary for r in R.predict(good, "id").collect()}
    rejected = {r.id: r.status for r in spark.read.parquet(out).where("status <> 'ok'").collect()}
    assert rejected == {2: "too_short", 3: "missing", 5: "too_short"}


def test_stream_checks(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    schema = "role string, text string"
    for rows in ([("user", "a"), ("user", " ")], [("user", None), ("bot", "b")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        ST.check_stream(ST.stream_table(spark, source, schema, "*.parquet"), "role", ["text"], out, checkpoint).awaitTermination()
    history = spark.read.parquet(out)
    assert history.select("batch").distinct().count() == 2
    got = {r.split: (r.n_rows, r.n_blank) for r in ST.check_totals(history).collect()}
    assert got == {"user": (3, 2), "bot": (1, 0)}


def shouting():
    """A model that fails on texts about rain; made here, so that it travels by value."""

    def load():
        def run(texts):
            if any("rain" in t for t in texts):
                raise ValueError("no rain")
            return [t.upper() for t in texts]

        return run

    return load


def test_model_and_errors(spark):
    rows = [(1, "sun and more sun today", 3), (2, "rain again and again", 3), (3, "wind all the day long", None)]
    df = spark.createDataFrame(rows, "id int, text string, max_length int")
    got = {r.id: r for r in R.predict(df, "id", max_length="max_length", model=shouting()).collect()}
    assert (got[1].summary, got[1].error) == ("SUN AND MORE", None)
    assert (got[2].summary, got[2].error) == (None, "no rain")
    assert got[3].summary == "WIND ALL THE DAY LONG"
    batches = df.selectExpr("1 as batch", "id as position", "text", "max_length")
    results = R.predict_batches(batches, "batch", "position", max_length="max_length", model=shouting()).first().results
    assert [r.error for r in results] == [None, "no rain", None]


@pytest.mark.parametrize("method", ["lead", "frequency", "tfidf", "textrank"])
def test_own_budget_of_each_request(spark, method):
    text = "Seven words stand in this first sentence. Four stand in this. Three words here."
    df = spark.createDataFrame([(1, text, 4), (2, text, 14), (3, text, None)], "id int, text string, max_length int")
    got = {r.id: r.summary for r in R.predict(df, "id", method=method, max_length="max_length").collect()}
    assert [len(got[i].split()) for i in (1, 2)] <= [4, 14] and len(got[1].split()) <= 4
    assert got[3] == text


def test_stream_with_a_failing_model(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    rows = [(1, "sun and more sun"), (2, "rain again and again"), (3, "rain")]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(source)
    arrivals = ST.stream_table(spark, source, SCHEMA, "*.parquet")
    ST.score_stream(arrivals, out, checkpoint, "id", model=shouting()).awaitTermination()
    got = {r.id: (r.status, r.summary, r.error) for r in spark.read.parquet(out).collect()}
    assert got == {
        1: ("ok", "SUN AND MORE SUN", None), 2: ("ok", None, "no rain"), 3: ("too_short", None, None),
    }
