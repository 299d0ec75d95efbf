import dataclasses
import json

import pytest

from precis.plans import config as C
from precis.plans import job
from precis.sources.splits import PAIR_SCHEMA, save_splits


def test_yaml(tmp_path):
    file = tmp_path / "job.yaml"
    file.write_text("source: /in\nroot: /out\nencode:\n  max_input_length: 64\ntrain:\n  grid: [0.5]\n")
    c = C.JobConfig.from_yaml(file)
    assert (c.ingest.source, c.encode.max_input_length, c.train.grid) == ("/in", 64, (0.5,))
    assert (c.encode.max_target_length, c.encode.text_column, c.evaluate.summary_column) == (128, "dialogue", "summary")
    assert c.validate.required_splits == ("train", "test", "validation")
    with pytest.raises(dataclasses.FrozenInstanceError):
        c.encode.max_input_length = 1


def test_yaml_errors(tmp_path):
    bare = tmp_path / "bare.yaml"
    for content, lacking in (("", "no root and no source"), ("source: /in", "no root"), ("- 1", "no root and no source")):
        bare.write_text(content)
        with pytest.raises(ValueError, match=lacking):
            C.read_yaml(bare)
    with pytest.raises(OSError):
        C.read_yaml(tmp_path / "nowhere.yaml")
    with pytest.raises(ValueError, match="unknown"):
        C.JobConfig.at("/in", "/out", encode={"typo": 1})


def test_stage_range(spark, tmp_path):
    with pytest.raises(ValueError):
        job.run(spark, C.JobConfig.at("/in", str(tmp_path)), 3, 2)
    with pytest.raises(SystemExit):
        job.main(["--config", "x.yaml", "--stage", "6"])


def test_all_stages(spark, tables, tmp_path):
    c = C.JobConfig.at(tables, str(tmp_path), train={"grid": (0.1,)}, evaluate={"methods": ("lead", "frequency")})
    job.run(spark, c)
    metrics = spark.read.option("header", True).csv(f"{c.evaluate.metrics}.csv").collect()
    assert {r.model for r in metrics} == {"lead", "frequency", "trained"}
    coded = spark.read.parquet(f"{c.encode.encoded}/table")
    row = coded.first()
    assert (len(row.input_ids), len(row.attention_mask), len(row.labels)) == (1024, 1024, 128)
    history = job.latest_runs(spark.read.parquet(c.history)).collect()
    assert {r.stage: r.status for r in history} == {n: "completed" for n in range(1, 6)}
    job.run(spark, c, 1, 2)
    assert spark.read.parquet(c.history).count() == 7


def test_invalid_data_stops_the_run(spark, tmp_path):
    c = C.JobConfig.at("/in", str(tmp_path))
    with pytest.raises(RuntimeError, match="error"):
        job.run(spark, c, 2, 3)
    rows = [("1", "hello", "h", "train"), ("2", " ", "h", "test"), ("3", "hello", "h", "validation")]
    df = spark.createDataFrame(rows, "id string, dialogue string, summary string, split string")
    save_splits(df, c.ingest.dataset, c.ingest.splits)
    with pytest.raises(RuntimeError, match="split_test_dialogue_no_nulls"):
        job.run(spark, c, 2, 3)
    history = spark.read.parquet(c.history).collect()
    assert [(r.stage, r.status) for r in history] == [(2, "failed")] * 2
    assert PAIR_SCHEMA.names == ["id", "dialogue", "summary"]


def own_dataset(spark, folder, summary="string"):
    """Splits of one's own, with columns ``input`` and ``output``."""
    for split, n in (("learn", 30), ("tune", 6), ("exam", 6)):
        rows = [(f"{split}{i}", f"Ann: tea {i} is hot. Bob: then wait {i} minutes. Ann: fine.", str(i)) for i in range(n)]
        df = spark.createDataFrame(rows, "key string, input string, output string")
        df.withColumn("output", df["output"].cast(summary)).write.parquet(f"{folder}/{split}")
    return {"train": f"{folder}/learn", "validation": f"{folder}/tune", "test": f"{folder}/exam"}


def test_own_dataset_with_other_names(spark, tmp_path):
    paths = own_dataset(spark, str(tmp_path / "in"))
    names = {"text_column": "talk", "summary_column": "gist"}
    c = C.JobConfig.at(
        "", str(tmp_path / "out"), **names, train={"grid": (0.1,)}, evaluate={"methods": ("lead",)},
        ingest={"paths": paths, "renames": {"key": "id", "input": "talk", "output": "gist"}},
    )
    job.run(spark, c)
    report = json.loads("".join(r.value for r in spark.read.text(c.validate.report).collect()))
    assert report["validation_status"] and report["details"]["split_train_gist_type"]
    metrics = spark.read.option("header", True).csv(f"{c.evaluate.metrics}.csv").collect()
    assert {r.model for r in metrics} == {"lead", "trained"}
    assert spark.read.parquet(f"{c.encode.encoded}/table").where("split = 'test'").count() == 6
    bare = dataclasses.replace(c, evaluate=dataclasses.replace(c.evaluate, models=(f"{tmp_path}/none",)))
    job.run(spark, bare, 5, 5)
    metrics = spark.read.option("header", True).csv(f"{c.evaluate.metrics}.csv").collect()
    assert {r.model for r in metrics} == {"lead", "base"}


def test_wrong_type_stops_in_stage_2(spark, tmp_path):
    paths = own_dataset(spark, str(tmp_path / "in"), "int")
    renames = {"key": "id", "input": "dialogue", "output": "summary"}
    c = C.JobConfig.at("", str(tmp_path / "out"), ingest={"paths": paths, "renames": renames})
    with pytest.raises(RuntimeError, match="split_test_summary_type"):
        job.run(spark, c)
    assert [r.stage for r in spark.read.parquet(c.history).where("status = 'failed'").collect()] == [2]


def test_report_of_a_broken_validation(spark, tmp_path):
    c = C.JobConfig.at("", str(tmp_path))
    for split in c.ingest.splits:
        (tmp_path / "dataset" / f"split={split}").mkdir(parents=True)
        (tmp_path / "dataset" / f"split={split}" / "part-0.parquet").write_bytes(b"no table")
    with pytest.raises(Exception):  # noqa: B017
        job.run(spark, c, 2, 2)
    report = json.loads("".join(r.value for r in spark.read.text(c.validate.report).collect()))
    assert not report["validation_status"] and report["details"]["exception"]
