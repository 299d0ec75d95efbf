import pytest
from pyspark.sql import functions as F

from precis.operators import encode as E


@pytest.fixture(scope="module")
def vocab(spark):
    df = spark.createDataFrame([("b b b a a c", None)], "dialogue string, summary string")
    return E.build_vocab(df, ["dialogue", "summary"]).cache()


def test_vocab_order(vocab):
    got = {r.token: (r.n, r.token_id) for r in vocab.collect()}
    assert got == {"b": (3, 4), "a": (2, 5), "c": (1, 6)}


def one(spark, text, vocab, n, **options):
    df = spark.createDataFrame([("x", text)], "id string, t string")
    return E.encode(df, "id", {"t": n}, vocab, **options).first()


def test_encode_pads_and_masks(spark, vocab):
    row = one(spark, "A z b", vocab, 8)
    assert row.t_ids == [0, 5, 3, 4, 2, 1, 1, 1]
    assert row.t_mask == [1, 1, 1, 1, 1, 0, 0, 0]


@pytest.mark.parametrize("text", ["", None, "..."])
def test_encode_nothing(spark, vocab, text):
    row = one(spark, text, vocab, 4)
    assert (row.t_ids, row.t_mask) == ([0, 2, 1, 1], [1, 1, 0, 0])


@pytest.mark.parametrize("n_tokens", [1021, 1022, 1023, 1024, 1025])
def test_encode_truncates(spark, vocab, n_tokens):
    row = one(spark, "a " * n_tokens, vocab, 1024)
    kept = min(n_tokens, 1022)
    assert row.t_ids == [0] + [5] * kept + [2] + [1] * (1022 - kept)
    assert sum(row.t_mask) == kept + 2


def test_encode_unpadded_with_source(spark, vocab):
    row = one(spark, "a", vocab, 8, pad=False, keep_source=True)
    assert (row.t, row.t_ids, row.t_mask) == ("a", [0, 5, 2], [1, 1, 1])


def test_decode_inverts_encode(spark, vocab):
    df = spark.createDataFrame([("x", "a b c a", "b"), ("y", "", "c z")], "id string, p string, q string")
    coded = E.encode(df, "id", {"p": 6, "q": 4}, vocab)
    got = {r.id: (r.p_ids_text, r.q_ids_text) for r in E.decode(coded, "id", ["p_ids", "q_ids"], vocab).collect()}
    assert got == {"x": ("a b c a", "b"), "y": ("", "c")}


def test_label_mask(spark):
    df = spark.createDataFrame([([0, 5, 2, 1, 1],)], "l array<int>")
    masked = df.select(E.mask_padding(F.col("l")).alias("m")).select("m", E.unmask_labels(F.col("m")).alias("u")).first()
    assert (masked.m, masked.u) == ([0, 5, 2, -100, -100], [0, 5, 2, 1, 1])


def test_pad_to_longest(spark):
    df = spark.createDataFrame(
        [("a", "t", 0, [0, 2]), ("b", "t", 0, [0, 4, 2]), ("c", "t", 1, [0, 2])], "id string, split string, chunk int, ids array<int>"
    )
    got = {r.id: r.ids for r in E.pad_to_longest(df, "ids").collect()}
    assert got == {"a": [0, 2, 1], "b": [0, 4, 2], "c": [0, 2]}


def test_compute_metrics(spark, vocab):
    df = spark.createDataFrame([("x", [0, 4, 5, 2], [0, 4, 5, 2, -100])], "id string, p array<int>, l array<int>")
    got = {r.metric: r.f1 for r in E.compute_metrics(df, "id", "p", "l", vocab, stemmed=True).collect()}
    assert got == {"rouge1": 1.0, "rouge2": 1.0, "rougeL": 1.0, "rougeLsum": 1.0}


def test_lengths_leave_room_for_the_marks(spark, vocab):
    df = spark.createDataFrame([("a", "x")], "id string, t string")
    with pytest.raises(ValueError, match="room"):
        E.encode(df, "id", {"t": 1}, vocab)
