from collections import Counter
import contextlib
import io
import random
import tempfile

from pyspark.sql import functions as F

from precis.operators import skew


def test_lookup_join_equals_plain_join(spark):
    rng = random.Random(1)
    keys = ["hot"] * 300 + [f"k{rng.randrange(80)}" for _ in range(300)] + ["absent"] * 5
    rows = spark.createDataFrame(list(enumerate(keys)), "i int, k string")
    dim = spark.createDataFrame(
        [("hot", 300, 0)] + [(f"k{j}", 4, j + 1) for j in range(80)], "k string, n int, v int"
    )
    got = skew.lookup_join(rows, dim, "k", "n", head_rows=3).collect()
    want = rows.join(dim, "k").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_value_counts(spark):
    rng = random.Random(3)
    values = ["hot"] * 500 + [None] * 7 + [f"v{rng.randrange(900)}" for _ in range(2_000)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5).localCheckpoint()
    got = skew.value_counts(df, "v", "n")
    assert {r.v: r.n for r in got.collect()} == Counter(values) and got.count() == len(set(values))
    assert skew.value_counts(df.limit(0), "v", "n").collect() == []


def test_ngrams_hold_no_table_of_a_whole_split(spark):
    """No hash table stands before the exchange, and the counts meet in parts that grow with the input."""
    from precis.plans.queries import QUERIES

    path = tempfile.mkdtemp(dir="/tmp")
    rows = [(i, f"a b c{i}. A B", "en", "web", 1) for i in range(40)] + [(None, None, None, None, None), (7, "a b", "en", "web", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(30).write.parquet(f"{path}/documents.parquet")
    got = QUERIES["ngrams"](spark, path)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        got.explain()
    plan = plan.getvalue()
    assert plan.rindex("HashAggregate") < plan.index("Exchange hashpartitioning(gram") < plan.index("MapInArrow")
    assert {r.gram: r.n for r in got.collect()} == {"a b": 81} | {k: 1 for i in range(40) for k in (f"b c{i}", f"c{i} a")}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        read = spark.read.parquet(f"{path}/documents.parquet").rdd.getNumPartitions()
        assert QUERIES["ngrams"](spark, path).rdd.getNumPartitions() == skew.PARTS_FOR_ONE * read
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_long_keys_are_in_the_head(spark):
    long_key = "x" * 200
    rows = spark.createDataFrame([(1, long_key), (2, "a")], "i int, k string")
    dim = spark.createDataFrame([(long_key, 9, 7), ("a", 1, 8)], "k string, n int, v int")
    head = skew.head_of(dim, "k", "n", head_rows=1)
    assert [r.v for r in head.collect()] == [7] and "k" not in head.columns
    got = {r.i: r.v for r in skew.lookup_join(rows, dim, "k", "n").collect()}
    assert got == {1: 7, 2: 8}


def test_lookup_arrays_keeps_order_and_gaps(spark):
    rows = [("a", ["x", "y", "x", "zz"], ["q"]), ("b", [], ["y", "?"]), ("c", [], [])]
    df = spark.createDataFrame(rows, "id string, one array<string>, two array<string>")
    dim = spark.createDataFrame([("x", 5, 1), ("y", 4, 2), ("q", 1, 3)], "w string, n int, v int")
    for head in (1, 2, 100):
        got = skew.lookup_arrays(
            df, ["id"], {"one": F.col("one"), "two": F.col("two")}, dim, "w", "v", "n", head_rows=head
        )
        assert {r.id: (r.one, r.two) for r in got.collect()} == {
            "a": ([1, 2, 1, None], [3]),
            "b": ([], [2, None]),
            "c": ([], []),
        }


def test_lookup_arrays_of_repeated_and_null_keys(spark):
    rng = random.Random(9)
    dim = [(f"w{i}", 100 - i, i) for i in range(60)] + [("long" * 100, 1, 77), (None, 5, 78)]
    rows = [(rng.choice(["a", "b", None]), [rng.choice(["zz", None, *(w for w, *_ in dim)]) for _ in range(rng.randrange(9))]) for _ in range(80)]
    rows += [(None, None), ("a", [])]
    value = {w: v for w, _, v in dim if w is not None}
    want = Counter((k, tuple(value.get(x) for x in a or [])) for k, a in rows)
    df = spark.createDataFrame(rows, "k string, a array<string>").repartition(3)
    words = spark.createDataFrame(dim, "w string, n int, v int")
    for head in (1, 20, 1000):
        got = skew.lookup_arrays(df, ["k"], {"out": F.col("a")}, words, "w", "v", "n", head_rows=head)
        assert Counter((r.k, tuple(r.out)) for r in got.collect()) == want
    back = spark.createDataFrame([(v, n, w) for w, n, v in dim if w], "v int, n int, w string")
    ids = df.select("k", F.transform("a", lambda x: F.when(x.startswith("w"), F.substring(x, 2, 3).cast("int"))).alias("a"))
    got = skew.lookup_arrays(ids, ["k"], {"out": F.col("a")}, back, "v", "w", "n", head_rows=7)
    assert Counter((r.k, tuple(r.out)) for r in got.collect()) == Counter(
        (k, tuple(x if x and x.startswith("w") else None for x in a or [])) for k, a in rows
    )


def test_null_groups_are_groups(spark):
    data = [(None, i, 9 - i) for i in range(6)] + [("a", i, i) for i in range(4)]
    df = spark.createDataFrame(data, "g string, o int, v int")
    placed = skew.with_positions(df, ["o"], ["g"])
    assert sorted(((r.g or "", r.o, r.pos) for r in placed.collect())) == sorted((g or "", o, o) for g, o, _ in data)
    got = {(r.g, r.o): r.before for r in skew.running_before(placed, ["g"], "v", "min", "before").collect()}
    assert got == {(g, o): (None if o == 0 else (9 - o + 1 if g is None else 0)) for g, o, _ in data}


def test_positions_with_one_hot_group(spark):
    rng = random.Random(2)
    data = [("hot", i) for i in range(500)] + [(f"g{rng.randrange(9)}", 1000 + i) for i in range(100)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, o int")
    got = {(r.g, r.o): r.pos for r in skew.with_positions(df, ["o"], ["g"]).collect()}
    groups = {}
    for g, o in sorted(data):
        groups.setdefault(g, []).append(o)
    assert got == {(g, o): i for g, os in groups.items() for i, o in enumerate(os)}


def test_positions_without_group_descending(spark):
    df = spark.createDataFrame([("a", 3), ("b", 9), ("c", 3)], "t string, n int")
    got = {r.t: r.pos for r in skew.with_positions(df, ["n", "t"], descending=["n"]).collect()}
    assert got == {"b": 0, "a": 1, "c": 2}


def test_running_before_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(skew, "BLOCK_ROWS", 4)
    rng = random.Random(3)
    data = [("r", i, rng.randrange(50)) for i in range(30)] + [("s", 0, 7)]
    df = spark.createDataFrame(data, "g string, pos long, v int")
    for how, fn in (("min", min), ("max", max)):
        got = {(r.g, r.pos): r.before for r in skew.running_before(df, ["g"], "v", how, "before").collect()}
        for g, pos, _ in data:
            earlier = [v for h, p, v in data if h == g and p < pos]
            assert got[g, pos] == (fn(earlier) if earlier else None)
