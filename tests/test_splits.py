import duckdb
import pytest
from pyspark.sql import functions as F

from precis.plans import oracle
from precis.plans.queries import QUERIES
from precis.session import path_exists, scratch_path
from precis.sources import artifacts as A
from precis.sources import pairs as P
from precis.sources import splits as S

SCHEMA = "id string, dialogue string, summary string, split string"


def rows(n, split="train"):
    return [(f"{split}-{i:03d}", f"d{i}", f"s{i}", split) for i in range(n)]


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame(rows(20) + rows(3, "test"), SCHEMA)


def test_empty_split_is_not_missing(spark, pairs):
    root = scratch_path(spark, "data")
    S.save_splits(pairs, root, ["train", "test", "validation"])
    loaded = S.load_splits(spark, root, ["train", "test", "validation", "extra"])
    assert {s: df.count() for s, df in loaded.items()} == {"train": 20, "test": 3, "validation": 0}
    assert loaded["validation"].columns == ["id", "dialogue", "summary"]


def test_ingest_once(spark, pairs):
    root = scratch_path(spark, "data")
    assert S.ingest(pairs, root, ["train"]) == "written"
    assert S.ingest(pairs.repartition(5), root, ["train"]) == "kept"
    assert S.load_splits(spark, root, ["train"])["train"].count() == 20


def test_changed_input_is_refused_or_replaces(spark, pairs):
    root = scratch_path(spark, "data")
    S.ingest(pairs, root, ["train"])
    doubled = pairs.unionByName(pairs.where("id = 'train-001'"))
    edited = pairs.withColumn("summary", F.when(F.col("id") == "test-001", "other").otherwise(F.col("summary")))
    nulled = pairs.withColumn("summary", F.when(F.col("id") != "test-001", F.col("summary")))
    marks = {S.content_mark(x) for x in (pairs, doubled, edited, nulled, pairs.limit(0), pairs.withColumnRenamed("summary", "s"))}
    assert len(marks) == 6
    for other in (doubled, edited, nulled):
        with pytest.raises(ValueError, match="other data"):
            S.ingest(other, root, ["train"])
    assert S.load_splits(spark, root, ["train"])["train"].count() == 20
    assert S.ingest(doubled, root, ["train"], on_change="replace") == "replaced"
    assert S.load_splits(spark, root, ["train"])["train"].count() == 21
    assert S.ingest(doubled, root, ["train"]) == "kept"
    with pytest.raises(ValueError, match="other data"):
        S.ingest(pairs, root, ["train"])
    with pytest.raises(ValueError, match="choice"):
        S.ingest(pairs, root, ["train"], on_change="merge")


def test_half_written_dataset_is_replaced(spark, pairs):
    root = scratch_path(spark, "data")
    pairs.limit(2).write.partitionBy("split").parquet(root)
    assert S.ingest(pairs, root, ["train"]) == "written"
    assert S.load_splits(spark, root, ["train"])["train"].count() == 20


def test_renamed(spark):
    path = scratch_path(spark, "raw")
    spark.createDataFrame([("a", "b", 1)], "input string, output string, n int").write.parquet(path)
    got = S.load_renamed(spark, {"train": path}, {"input": "dialogue", "output": "summary"})
    assert got["train"].columns == ["dialogue", "summary", "n"]


def test_head_row_preview(pairs):
    head = S.head_rows(pairs, 2).collect()
    assert sorted(r.id for r in head) == ["test-000", "test-001", "train-000", "train-001"]
    at = S.row_at(pairs, 3).collect()
    assert [r.id for r in at] == ["train-003"]
    assert sorted(S.row_at(pairs, 2).columns) == sorted(pairs.columns)
    seen = {r.split: (r.n_rows, r.first_id, r.head) for r in S.preview(pairs, chars=1).collect()}
    assert seen == {"train": (20, "train-000", "d"), "test": (3, "test-000", "d")}


def test_batches(pairs):
    chunks = S.batch_chunks(pairs, 8).collect()
    by = {}
    for r in chunks:
        by.setdefault((r.split, r.chunk), []).append((r.pos, r.id))
    assert {k: len(v) for k, v in by.items()} == {("train", 0): 8, ("train", 1): 8, ("train", 2): 4, ("test", 0): 3}
    assert [i for _, i in sorted(by["train", 1])] == [f"train-{i:03d}" for i in range(8, 16)]


def test_turns(spark):
    turns = [(1, 2, "assistant", "C"), (1, 0, "user", "A"), (1, 1, "user", "B\nb"), (2, 0, "user", "x"), (3, 0, "assistant", "y")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.id: r.dialogue for r in P.dialogue_from_turns(df).collect()}
    assert got["conv-1"] == "user: A\nuser: B\nb\nassistant: C"
    pair = P.pairs_from_turns(df).collect()
    assert [(r.id, r.dialogue, r.summary, r.split) for r in pair] == [("conv-1", "user: A\nuser: B\nb", "C", "train")]


@pytest.mark.parametrize("n", [10_001, 25_000])
def test_long_conversations_make_one_pair(spark, tmp_path, n):
    """The true last turn is the summary, as in the statement on the same rows."""
    rows = spark.range(n).select(
        F.lit(4).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == (n - 1) % 2, "assistant").otherwise("user").alias("role"),
        F.concat(F.lit("said "), "id").alias("text"),
    )
    got = P.pairs_from_turns(rows).collect()
    assert [r.summary for r in got] == [f"said {n - 1}"]
    con = duckdb.connect()
    rows.coalesce(1).write.parquet(str(tmp_path / "talk"))
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/talk/*.parquet'")
    con.execute("CREATE VIEW documents AS SELECT 1 AS doc_id, 'no line' AS text")
    want = con.execute(oracle.oracle_sql()["load_splits"]).fetchall()
    assert [(r.id, r.split, r.dialogue, r.summary) for r in got] == want
    assert P.dialogue_from_turns(rows).first().n_turns == n


def test_latest_artifact_sorts_numbers(spark):
    paths = [(f"run/checkpoint-{n}",) for n in (200, 800, 1000)] + [("run/final",)]
    df = spark.createDataFrame(paths, "path string")
    from pyspark.sql import functions as F

    got = A.latest_artifact(df, "path", F.lit("run"), A.trailing_number(F.col("path"))).first()
    assert (got.path, got.n_versions) == ("run/checkpoint-1000", 3)


def test_file_sizes(spark, tmp_path):
    (tmp_path / "a.txt").write_text("wool and")
    (tmp_path / "b.txt").write_text("ab" * 768)
    files = A.file_sizes(spark, str(tmp_path))
    assert sorted(r["size"] for r in files.collect()) == ["1.5 KB", "8 B"]
    total = A.total_size(files).first()
    assert (total.n_files, total.length, total["size"]) == (2, 1544, "1.5 KB")


def test_json(spark, tmp_path):
    file = tmp_path / "case.json"
    file.write_text('{\n "key": "value",\n "number": 42,\n "list": [1, 2, 3]\n}')
    row = A.load_json(spark, str(file), multi_line=True).first()
    assert (row.key, row.number, row.list) == ("value", 42, [1, 2, 3])
    out = str(tmp_path / "sub" / "dir")
    A.save_json(A.load_json(spark, str(file), multi_line=True), out)
    assert A.load_json(spark, out).first().asDict() == row.asDict()


def test_metric_sinks(spark, tmp_path):
    rows_ = [("m", "rouge1", 0.5), ("m", "rouge2", 0.25), ("m", "rougeL", 0.1), ("m", "rougeLsum", 0.2)]
    scores = spark.createDataFrame(rows_, "model string, metric string, f1 double")
    path = str(tmp_path / "out" / "metrics")
    A.write_metrics(A.metrics_wide(scores), path)
    csv = spark.read.option("header", True).option("inferSchema", True).csv(f"{path}.csv").first()
    assert csv.asDict() == {"model": "m", "rouge1": 0.5, "rouge2": 0.25, "rougeL": 0.1, "rougeLsum": 0.2}
    assert spark.read.json(f"{path}.json").first().rougeL == 0.1
    assert path_exists(spark, f"{path}.csv")


def test_rows_in_another_order_come_in_as_many_tasks_as_they_need(spark, tables, monkeypatch):
    seen, ingest = [], S.ingest
    monkeypatch.setattr(S, "ingest", lambda df, *args, **options: seen.append(df) or ingest(df, *args, **options))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        got = QUERIES["ingest_idempotent"](spark, tables).first()
        again = seen[1].rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert (got["first"], got["again"], got["changed"], got["by_choice"]) == ("written", "kept", "refused", "replaced")
    assert again > 3
