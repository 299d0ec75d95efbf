import numpy as np
import pyarrow as pa
import hashlib
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from precis.functions import parts as P
from precis.functions.lcs import lcs_length, lcs_places, union_hits
from precis.functions.porter import stem
from precis.operators import rouge as R

WORDS = st.lists(st.sampled_from("abcde"), max_size=14)


def table_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@settings(max_examples=200, deadline=None)
@given(WORDS, WORDS)
def test_lcs_against_the_full_table(a, b):
    assert lcs_length(a, b) == lcs_length(b, a) == table_lcs(a, b)
    assert len(lcs_places(a, b)) == table_lcs(a, b)


def test_union_lcs_example_of_lin_2004():
    ref = [["w1", "w2", "w3", "w4", "w5"]]
    cand = [["w1", "w2", "w6", "w7", "w8"], ["w1", "w3", "w8", "w9", "w5"]]
    assert union_hits(ref, cand) == 4


def test_union_hits_count_a_token_once_per_occurrence():
    assert union_hits([["a", "b"], ["a", "c"]], [["a", "b", "c"]]) == 3
    assert union_hits([], [["a"]]) == 0
    assert union_hits([["a"]], []) == 0


def test_tie_moves_along_the_reference():
    assert lcs_places(["a", "b"], ["b", "a"]) == {0}


@settings(max_examples=100, deadline=None)
@given(WORDS, WORDS)
def test_one_sentence_union_is_plain_lcs(a, b):
    assert union_hits([a], [b]) == table_lcs(a, b)


@pytest.mark.parametrize(
    "word, want",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("agreed", "agre"),
        ("plastered", "plaster"), ("motoring", "motor"), ("conflated", "conflat"), ("hopping", "hop"),
        ("falling", "fall"), ("filing", "file"), ("happy", "happi"), ("relational", "relat"),
        ("conditional", "condit"), ("vietnamization", "vietnam"), ("triplicate", "triplic"),
        ("hopefulness", "hope"), ("goodness", "good"), ("allowance", "allow"), ("adjustment", "adjust"),
        ("adoption", "adopt"), ("effective", "effect"), ("probate", "probat"), ("rate", "rate"),
        ("controll", "control"), ("roll", "roll"), ("dying", "die"), ("news", "news"), ("died", "die"),
        ("enjoy", "enjoy"), ("geology", "geolog"),
    ],
)
def test_stems(word, want):
    assert stem(word) == want


CASES = [
    ("same", "the cat sat", "the cat sat"),
    ("none", "dogs run", "the cat sat"),
    ("clip", "the the the the", "the cat the"),
    ("no_pred", "", "the cat"),
    ("null_pred", None, "the cat"),
    ("no_ref", "the cat", ""),
    ("accent", "Café", "caf"),
    ("lines", "the cat sat\non the mat", "on the mat\nthe cat sat"),
]


def scores(spark, cases, **options):
    df = spark.createDataFrame(cases, "id string, p string, r string")
    rows = R.rouge_scores(df, ["id"], "p", "r", **options).collect()
    return {(r.id, r.metric): r for r in rows}


def test_scores_by_hand(spark):
    got = scores(spark, CASES)
    assert len(got) == len(CASES) * 4
    for m in R.METRICS:
        assert got["same", m].f1 == 1.0
        for empty in ("none", "no_pred", "null_pred", "no_ref"):
            assert got[empty, m].f1 == 0.0
    clip = got["clip", "rouge1"]
    assert (clip.hits, clip.n_pred, clip.n_ref) == (2, 4, 3)
    assert (clip.precision, clip.recall, clip.f1) == (0.5, 0.666667, 0.571429)
    assert got["accent", "rouge1"].f1 == 1.0
    assert got["lines", "rouge1"].f1 == 1.0
    assert got["lines", "rougeL"].hits == 3
    assert got["lines", "rougeLsum"].hits == 6


def test_scores_by_brute_force(spark):
    rng = random.Random(5)
    text = lambda: " ".join(rng.choice("abcdefg") for _ in range(rng.randrange(0, 25)))
    cases = [(str(i), text(), text()) for i in range(60)]
    got = scores(spark, cases)
    for i, p, r in cases:
        p, r = p.split(), r.split()
        for n in (1, 2):
            cp, cr = (Counter(zip(*[t[k:] for k in range(n)])) for t in (p, r))
            row = got[i, f"rouge{n}"]
            assert row.hits == sum((cp & cr).values())
            assert (row.n_pred, row.n_ref) == (sum(cp.values()), sum(cr.values()))
        assert got[i, "rougeL"].hits == got[i, "rougeLsum"].hits == table_lcs(r, p)
        assert all(0 <= got[i, m].f1 <= 1 for m in R.METRICS)


def test_stemming_and_kept_columns(spark):
    df = spark.createDataFrame([("a", "running dogs", "run dog", "x")], "id string, p string, r string, s string")
    plain = R.rouge_scores(df, ["id"], "p", "r", ["rouge1"], ["s"]).first()
    stemmed = {r.metric: r for r in R.rouge_scores(df, ["id"], "p", "r", keep=["s"], stemmed=True).collect()}
    assert (plain.f1, plain.s) == (0.0, "x")
    assert stemmed["rouge1"].hits == stemmed["rougeL"].hits == stemmed["rougeLsum"].hits == 2


def test_corpus_mean_and_interval(spark):
    rows = [(str(i), "test", "rouge1", (i % 5) / 4.0) for i in range(200)]
    df = spark.createDataFrame(rows, "id string, split string, metric string, f1 double")
    df = df.selectExpr("*", "f1 as precision", "f1 as recall")
    mean = R.corpus_scores(df, ["split", "metric"]).first()
    assert (mean.f1, mean.n_pairs) == (0.5, 200)
    low, mid, high = R.bootstrap_interval(df, "id", ["split"], ["rouge1"]).first()[2:]
    assert low < mid < high
    assert abs(mid - 0.5) < 0.01 and 0.03 < high - low < 0.2
    again = R.bootstrap_interval(df.repartition(3), "id", ["split"], ["rouge1"]).first()[2:]
    assert again == (low, mid, high)


def test_interval_with_few_replicates(spark):
    df = spark.createDataFrame([("a", "rouge1", 0.25)], "id string, metric string, f1 double")
    row = R.bootstrap_interval(df, "id", [], ["rouge1"], replicates=10).first()
    assert row.low == row.mid == row.high == 0.25


def test_rows_of_equal_and_null_keys_stay_apart(spark):
    rows = [("a", "the cat", "the cat sat"), ("a", "dogs", "the cat"), ("a", "dogs", "the cat"), (None, "x y z", "x y z"), (None, "q", "r")]
    df = spark.createDataFrame(rows, "id string, p string, r string").repartition(3)
    got = [(r.id, r.metric, r.hits, r.n_pred, r.n_ref) for r in R.rouge_scores(df, ["id"], "p", "r").collect()]
    want = []
    for key, p, r in rows:
        p, r = p.split(), r.split()
        for m in R.METRICS:
            n = 2 if m == "rouge2" else 1
            grams = [Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1)) for t in (p, r)]
            want.append((key, m, sum((grams[0] & grams[1]).values()), *(sum(g.values()) for g in grams)))
    assert Counter(got) == Counter(want)


def test_states_of_batches_add_up(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, rng.choice(["x", None]), rng.random(), rng.random(), rng.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, split string, precision double, recall double, f1 double")
    whole = sorted(R.corpus_scores(df, ["split"]).collect(), key=str)
    for cuts in ([0, 300], [0, 1, 150, 300], [0, 100, 100, 300]):
        table = R.MetricTable(str(tmp_path / f"t{len(cuts)}{cuts[1]}"), ["split"])
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            table.add_batch(df.where(f"id >= {a} and id < {b}"), f"b{k}")
        table.add_batch(df.where(f"id >= {cuts[-2]}"), f"b{len(cuts) - 2}")  # again: counts once
        assert sorted(table.compute(spark).collect(), key=str) == whole
    merged = R.merge_states(R.metric_states(df.limit(0), ["split"]), ["split"])
    assert merged.count() == 0 and R.state_means(merged, ["split"]).count() == 0


def test_interval_of_repeated_and_null_keys(spark):
    """Rows of one key share its weights and count each; the plan explodes nothing."""
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice(["s", None]), m, rng.random()) for _ in range(120) for m in ("rouge1", "rougeL")]
    df = spark.createDataFrame(rows, "id string, split string, metric string, f1 double")
    got = R.bootstrap_interval(df.repartition(5), "id", ["split"], ["rouge1", "rougeL"], replicates=30)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    for r in got.collect():
        means = []
        for i in range(30):
            n = total = 0
            for key, split, m, f1 in rows:
                if (split, m) == (r.split, r.metric):
                    text = (key + ":" if key is not None else "") + str(i // 4)
                    draw = hashlib.md5(text.encode()).hexdigest()[8 * (i % 4) : 8 * (i % 4) + 8]
                    w = sum(draw >= e for e in R.POISSON_EDGES)
                    n, total = n + w, total + w * round(f1 * 1_000_000)
            if n:
                means.append(total / (n * 1e6))
        want = np.quantile(means, [0.025, 0.5, 0.975])
        assert [r.low, r.mid, r.high] == pytest.approx(want, abs=1e-6)
    assert got.count() == 4


def test_gram_hits_match_counters():
    rng = random.Random(5)
    rows = [([rng.choice("abc") for _ in range(rng.randrange(9))], [rng.choice("abcd") for _ in range(rng.randrange(9))]) for _ in range(300)]
    refs, preds = (pa.array(x, pa.list_(pa.string())) for x in zip(*rows))
    for n in (1, 2, 3):
        def grams(x):
            return Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1))
        want = [sum((grams(r) & grams(p)).values()) for r, p in rows]
        assert R.gram_hits(refs, preds, n).to_pylist() == want
        assert R.gram_hits(refs.slice(7, 50), preds.slice(7, 50), n).to_pylist() == want[7:57]
        assert R.gram_hits(refs[:0], preds[:0], n).to_pylist() == []


def test_scoring_moves_no_row(spark):
    df = spark.createDataFrame([(1, "a b a", "a a b"), (1, "a b a", "a a b"), (None, None, "x")], "k long, p string, r string")
    scores = R.rouge_scores(df, ["k"], "p", "r")
    assert "Exchange" not in scores._jdf.queryExecution().executedPlan().toString()
    assert Counter((x.k, x.metric, x.hits) for x in scores.collect())[1, "rouge2", 1] == 2


@pytest.mark.parametrize("stemmed", [False, True])
def test_overlaps_in_slices_equal_plain_python(spark, monkeypatch, stemmed):
    """Lines, stems and odd letters, with a slice for every few rows."""
    rng = random.Random(31)
    bits = ["a", "b", "hopping", "hopped", "Ponies", "pony", "rates", "été", "KK", "İx", "9", ".", " ", " ", " ", "\n", "\n", "\r", "日"]
    texts = [None, "", "\n\n", *("".join(rng.choice(bits) for _ in range(rng.randrange(50))) for _ in range(200))]
    rows = [(rng.choice(texts), rng.choice(texts)) for _ in range(300)]
    own = lambda x: [stem(t) if stemmed and len(t) > 3 else t for t in re.findall("[a-z0-9]+", x.lower())]
    want = []
    for p, r in rows:
        lp, lr = ([own(x) for x in (t or "").split("\n")] for t in (p, r))
        tp, tr = own(p or ""), own(r or "")
        grams = [[Counter(zip(*[t[k:] for k in range(n)])) for t in (tp, tr)] for n in (1, 2)]
        want.append((len(tp), len(tr), *(sum((a & b).values()) for a, b in grams), table_lcs(tr, tp), union_hits(lr, lp)))
    monkeypatch.setattr(P, "SLICE_BYTES", 100)
    preds, refs = (pa.array(["gone", *side], kind).slice(1) for side, kind in zip(zip(*rows), (pa.string(), pa.large_string())))
    got = R.overlaps(preds, refs, R.METRICS, stemmed).to_pylist()
    assert [tuple(x.values()) for x in got] == want
    assert [x["rougeLsum"] for x in R.overlaps(preds, refs, ["rougeLsum"], stemmed).to_pylist()] == [x[-1] for x in want]
    assert R.overlaps(preds[:0], refs[:0], R.METRICS, stemmed).to_pylist() == []
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "i int, p string, r string")
    hits = {(x.i, x.metric): x.hits for x in R.rouge_scores(df, ["i"], "p", "r", stemmed=stemmed).collect()}
    assert hits == {(i, m): x[2 + k] for i, x in enumerate(want) for k, m in enumerate(R.METRICS)}
