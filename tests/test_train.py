import numpy as np
import pytest

from precis.operators import train as M


def newton(x, y, reg):
    """Logistic regression with an L2 penalty on all weights but the intercept."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    ridge = reg * np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-a @ w))
        slope = a.T @ (p - y) / len(y) + ridge @ w
        curve = (a * (p * (1 - p))[:, None]).T @ a / len(y) + ridge
        w -= np.linalg.solve(curve, slope)
    return w


def loss(x, y, w):
    p = 1 / (1 + np.exp(-(np.column_stack([x, np.ones(len(x))]) @ w)))
    return -np.mean(np.where(y == 1, np.log(p), np.log(1 - p)))


def test_fit_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(3, 5, (400, len(M.FEATURES))) * np.arange(1, len(M.FEATURES) + 1)
    y = (rng.random(400) < 1 / (1 + np.exp(-(x[:, 0] - 3) / 4))).astype(float)
    split = np.array(["train", "train", "train", "validation", "test"] * 80)
    rows = [(s, float(t), *map(float, r)) for s, t, r in zip(split, y, x, strict=True)]
    schema = ", ".join(["split string", "label double", *(f"{c} double" for c in M.FEATURES)])
    _, report = M.train_sentence_model(spark.createDataFrame(rows, schema), (0.0, 0.1))
    own = split == "train"
    scaled = (x - x[own].mean(axis=0)) / x[own].std(axis=0, ddof=1)
    got = {(r.reg_param, r.split): r for r in report.collect()}
    for reg in (0.0, 0.1):
        w = newton(scaled[own], y[own], reg)
        for s in ("train", "validation", "test"):
            r = got[reg, s]
            assert r.log_loss == pytest.approx(loss(scaled[split == s], y[split == s], w), abs=2e-4)
            assert r.n_sentences == (split == s).sum() and r.converged
    assert {r.reg_param for r in got.values() if r.chosen} == {min((0.0, 0.1), key=lambda g: got[g, "validation"].log_loss)}


def test_an_early_end_is_reported(spark):
    rng = np.random.default_rng(2)
    rows = [("train", float(i % 2), *map(float, rng.normal(i % 2, 1, len(M.FEATURES)))) for i in range(80)]
    schema = ", ".join(["split string", "label double", *(f"{c} double" for c in M.FEATURES)])
    _, report = M.train_sentence_model(spark.createDataFrame(rows, schema), (0.0,), max_iter=1)
    assert not any(r.converged for r in report.collect())


def test_features_of_a_text_of_many_sentences_are_found_once(spark):
    text = "\n".join(["alpha beta beta"] + [f"word{n} alpha" for n in range(2_999)])
    df = spark.createDataFrame([(1, text, "alpha beta"), (2, "", "x"), (3, None, None)], "id long, dialogue string, summary string")
    features = M.sentence_features(df, "id", "dialogue", "summary")
    # The highest frequency of the text stands beside each sentence and is not searched for in each.
    assert "array_max" not in features._jdf.queryExecution().optimizedPlan().toString()
    rows = {r.sent: r for r in features.collect()}
    assert len(rows) == 3_000 and {r.id for r in rows.values()} == {1}
    assert (rows[0].frequency, rows[0].frequency_share) == (3_002.0, 1.0)
    assert (rows[2_999].frequency, rows[2_999].frequency_share, rows[2_999].place_share) == (3_000.0, 3_000 / 3_002, 1.0)
