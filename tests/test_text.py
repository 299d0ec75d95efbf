import pytest
from pyspark.sql import functions as F

from precis.functions import text as T

AWKWARD = [
    "", "   ", "\t\n", "\xa0", "\x85", "\x1c\x1f", "​", "　a", " a b ", " x ", "x\x00",
]


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_strip_and_blank_follow_python(spark):
    assert values(spark, AWKWARD, T.strip(F.col("t"))) == [s.strip() for s in AWKWARD]
    want = [s is None or s.strip() == "" for s in [*AWKWARD, None]]
    assert values(spark, [*AWKWARD, None], T.is_blank(F.col("t"))) == want


def test_every_character_python_strips(spark):
    spaces = [chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000 and chr(i).strip() == ""]
    assert sorted(spaces) == sorted(T.SPACES)


def test_tokens(spark):
    got = values(spark, ["Café 9AM, it's OK!", "", "---"], T.tokens(F.col("t")))
    assert got == [["caf", "9am", "it", "s", "ok"], [], []]


def test_sentences(spark):
    got = values(spark, ["One. Two!  Three?\n\n four", "", None, "No end"], T.sentences(F.col("t")))
    assert got == [["One.", "Two!", "Three?", "four"], [], [], ["No end"]]


def test_ngrams(spark):
    got = values(spark, ["a b c", "a", ""], T.ngrams(T.tokens(F.col("t")), 2))
    assert got == [["a b", "b c"], [], []]


def test_cut_words(spark):
    assert values(spark, ["a  b c", "a  b"], T.cut_words(F.col("t"), 2)) == ["a b", "a  b"]


def test_tidy(spark):
    got = values(spark, ["Hi , you do n't say !", "it 's ' quoted ' here"], T.tidy(F.col("t")))
    assert got == ["Hi, you don't say!", "it's'quoted'here"]


@pytest.mark.parametrize(
    "n, want",
    [(0, "0 B"), (5, "5 B"), (1023, "1023 B"), (2048, "2.0 KB"), (1280, "1.2 KB"), (1792, "1.8 KB"),
     (5 * 1024**2, "5.0 MB"), (3 * 1024**3, "3.0 GB")],
)
def test_size_text(spark, n, want):
    df = spark.createDataFrame([(n,)], "n long")
    assert df.select(T.size_text(F.col("n")).alias("v")).first().v == want


def test_length_counts_code_points(spark):
    assert values(spark, ["🎉 ok"], F.length("t")) == [4]
