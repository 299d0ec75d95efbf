import json

import pytest
from pyspark.sql import types as T

from precis.operators import validate as V
from precis.session import scratch_path
from precis.sources.splits import PAIR_SCHEMA

CONTRACT = V.Contract()


def good(spark, n=2):
    return spark.createDataFrame([(str(i), "hello there", "hi") for i in range(n)], PAIR_SCHEMA)


def checks(spark, splits):
    return {r.check_key: r.passed for r in V.check_splits(spark, splits, CONTRACT).collect()}


def test_happy_path_has_21_checks_and_9_of_types(spark):
    got = checks(spark, {s: good(spark) for s in CONTRACT.splits})
    assert len(got) == 30 and sum(k.endswith("_type") for k in got) == 9 and all(got.values())


def test_missing_split_skips_its_other_checks(spark):
    got = checks(spark, {"train": good(spark), "test": good(spark)})
    assert got["split_validation_exists"] is False
    assert [k for k in got if k.startswith("split_validation")] == ["split_validation_exists"]
    assert len(got) == 21


def test_empty_split_exists_but_fails(spark):
    splits = {s: good(spark) for s in CONTRACT.splits} | {"test": good(spark).limit(0)}
    got = checks(spark, splits)
    assert got["split_test_exists"] and not got["split_test_non_empty"]
    assert got["split_test_dialogue_no_nulls"] and len(got) == 30


def test_missing_column_skips_its_blank_check(spark):
    splits = {s: good(spark) for s in CONTRACT.splits}
    splits["train"] = splits["train"].drop("summary")
    got = checks(spark, splits)
    assert got["split_train_col_summary"] is False
    assert "split_train_summary_no_nulls" not in got and len(got) == 28


def test_extra_split_is_ignored(spark):
    splits = {s: good(spark) for s in (*CONTRACT.splits, "extra")}
    assert len(checks(spark, splits)) == 30


@pytest.mark.parametrize("blank", [None, "", "  ", "\t\n", "\xa0", "\x85", "\x1c\x1f"])
def test_blanks(spark, blank):
    splits = {s: good(spark) for s in CONTRACT.splits}
    splits["test"] = spark.createDataFrame([("1", "x", blank), ("2", "​", "y")], PAIR_SCHEMA)
    got = checks(spark, splits)
    assert not got["split_test_summary_no_nulls"] and got["split_test_dialogue_no_nulls"]


def test_types(spark):
    wrong = T.StructType(list(PAIR_SCHEMA)[:2] + [T.StructField("summary", T.IntegerType())])
    rows = V.types_match({"train": wrong}, spark, CONTRACT).collect()
    assert {r.check_key: r.passed for r in rows} == {
        "split_train_id_type": True, "split_train_dialogue_type": True, "split_train_summary_type": False,
    }


def test_length_stats_round_half_even_and_survive_emptiness(spark):
    rows = [("1", "ab", "x", "a"), ("2", "abc", None, "a"), ("3", None, None, "b")]
    df = spark.createDataFrame(rows, "id string, dialogue string, summary string, split string")
    stats = V.length_stats(V.profile(df, ["dialogue", "summary"]), ["dialogue", "summary"])
    got = {(r.split, r.column): (r.mean_chars, r.mean_chars_shown) for r in stats.collect()}
    assert got == {
        ("a", "dialogue"): (2.5, 2), ("a", "summary"): (1.0, 1), ("b", "dialogue"): (None, None), ("b", "summary"): (None, None),
    }


def test_report_file_and_gate(spark):
    ok = V.check_splits(spark, {s: good(spark) for s in CONTRACT.splits}, CONTRACT)
    path = scratch_path(spark, "report")
    V.write_report(ok, path)
    report = json.loads("\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect()))
    assert report["validation_status"] is True and len(report["details"]) == 30
    assert set(report["details"].values()) == {True}
    V.require_valid(ok)
    bad = V.check_splits(spark, {"train": good(spark)}, CONTRACT)
    with pytest.raises(RuntimeError, match="split_test_exists"):
        V.require_valid(bad)
    gone = V.missing_dataset_report(spark, "/nowhere")
    assert V.overall_status(gone).first().validation_status is False
    assert json.loads(V.report_json(gone).first().value) == {
        "validation_status": False, "details": {"error": "no dataset below /nowhere"},
    }


def test_set_difference(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "k string")
    b = spark.createDataFrame([("y",), ("z",)], "k string")
    got = {r.k: r.problem for r in V.set_difference(a, b, "k").collect()}
    assert got == {"x": "missing", "z": "unexpected"}
