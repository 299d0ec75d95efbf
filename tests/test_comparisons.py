import random

import pytest

from precis.operators import skew
from precis.plans import queries as Q
from precis.session import stage_table

# Rows of each comparison over three splits, four methods and four metrics.
ROWS = {"rouge_corpus": 48, "metrics_wide": 24, "metrics_rounded": 48, "evaluate_models": 12}


@pytest.fixture(scope="module")
def many_words(spark, tmp_path_factory):
    """Tables with more distinct words than the 100,000 that a looked-up head holds."""
    rng = random.Random(17)
    path = str(tmp_path_factory.mktemp("words"))
    line = lambda n: " ".join(f"w{rng.randrange(400_000)}" for _ in range(n))
    docs = [(i, "planets grow slowly\nplanets grow. " + ". ".join(line(9) for _ in range(300)), "en", "web", 1) for i in range(80)]
    docs += [(None, None, None, None, None), (7, docs[7][1], "en", "web", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    turns = [(c, t, ("user", "assistant")[t], line(20)) for c in range(40) for t in range(2)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return path


@pytest.mark.parametrize("name", list(ROWS))
def test_comparisons_stage_no_text_twice(spark, many_words, monkeypatch, name):
    """Beside the pairs and the words' weights nothing is written: no text with the weights of all its words."""
    staged = []
    monkeypatch.setattr(skew, "stage_table", lambda df, name: staged.append(name) or stage_table(df, name))
    rows = Q.QUERIES[name](spark, many_words).collect()
    assert staged == [] and len(rows) == ROWS[name]
    scores = [r.f1 if "f1" in r else r.rouge1 for r in rows]
    assert all(x is not None and 0 <= x <= 1 for x in scores) and max(scores) > 0
