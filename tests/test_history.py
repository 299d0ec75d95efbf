import random

import pytest

from precis.operators import history as H
from precis.operators import skew


def stopped(losses, patience=3):
    best, at, waited = None, None, 0
    for i, loss in enumerate(losses):
        if best is None or loss < best:
            best, at, waited = loss, i, 0
        else:
            waited += 1
            if waited >= patience:
                return i, at, best
    return None, at, best


@pytest.mark.parametrize("block", [3, 65_536])
def test_early_stop_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(skew, "BLOCK_ROWS", block)
    rng = random.Random(block)
    runs = {r: [rng.randrange(100) / 4 for _ in range(rng.randrange(1, 30))] for r in range(25)}
    runs[99] = [float(200 - i) for i in range(60)]
    rows = [(r, i, x) for r, xs in runs.items() for i, x in enumerate(xs)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "run int, step int, loss double")
    got = {r.run: (r.stop_step, r.best_step, r.best_loss) for r in H.early_stop(df).collect()}
    assert got == {r: stopped(xs) for r, xs in runs.items()}


def test_best_step_breaks_ties_by_step(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 1.0), ("a", 3, 1.0), ("b", 1, None), ("b", 2, 5.0)], "run string, step int, loss double")
    got = {r.run: (r.n_steps, r.best_step, r.best_loss) for r in H.best_step(df).collect()}
    assert got == {"a": (3, 2, 1.0), "b": (1, 2, 5.0)}
