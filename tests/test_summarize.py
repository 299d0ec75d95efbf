import contextlib
import io
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from precis.functions import parts as P
from precis.functions import text as T
from precis.operators import fitted as FT
from precis.operators import requests as R
from precis.operators import skew
from precis.operators import summarize as S
from precis.operators import train as M
from precis.session import stage_table

TEXT = (
    "Planets orbit stars. A moon orbits planets too. The weather was fine. "
    "Stars and planets form from clouds, and planets grow slowly. Nothing else happened."
)


def docs(spark, texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, t string")


def run(spark, method, texts, **options):
    out = S.summarize(docs(spark, texts), "id", "t", method, **options)
    return {r.id: r.prediction for r in out.collect()}


@pytest.mark.parametrize("method", S.METHODS)
def test_blank_texts_give_empty_summaries(spark, method):
    got = run(spark, method, ["", None, " \n ", TEXT])
    assert got["0"] == got["1"] == got["2"] == "" and got["3"]
    assert len(got) == 4


@pytest.mark.parametrize("method", S.METHODS)
def test_budget_order_and_sentences(spark, method):
    rng = random.Random(7)
    words = [f"word{i}" for i in range(12)]
    texts = []
    for _ in range(20):
        n = rng.randrange(1, 15)
        texts.append(" ".join(" ".join(rng.choices(words, k=rng.randrange(1, 9))) + f" s{j}." for j in range(n)))
    got = run(spark, method, texts, max_words=20)
    for i, text in enumerate(texts):
        if method == "lead":
            first = " ".join(" ".join(text.split(". ")[:3]).replace(".", "").split()[:20])
            assert got[str(i)].replace(".", "") == first
            continue
        picked = got[str(i)].split(". ")
        source = text.split(". ")
        places = [next(k for k, s in enumerate(source) if s.rstrip(".") == p.rstrip(".")) for p in picked]
        assert places == sorted(places)
        assert 0 < len(got[str(i)].split()) <= 20
        grams = [tuple(got[str(i)].split()[k : k + 5]) for k in range(len(got[str(i)].split()) - 4)]
        inner = [g for g in grams if not any(w.startswith("s") and w.endswith(".") for w in g[:-1])]
        assert len(inner) == len(set(inner))


def test_long_first_sentence_is_cut(spark):
    text = " ".join(f"w{i}" for i in range(300))
    for method in S.METHODS:
        assert run(spark, method, [text], max_words=10)["0"] == " ".join(f"w{i}" for i in range(10))


def test_lead_takes_three(spark):
    assert run(spark, "lead", ["A b. C d. E f. G h."])["0"] == "A b. C d. E f."


def test_frequency_prefers_frequent_words(spark):
    # planets 4, stars 2: sentences 1 and 4 score 6, sentence 2 scores 4, the others 0.
    assert run(spark, "frequency", [TEXT], max_words=10)["0"] == "Planets orbit stars. A moon orbits planets too."
    got = run(spark, "frequency", [TEXT], max_words=13)["0"]
    assert got == "Planets orbit stars. Stars and planets form from clouds, and planets grow slowly."


def test_repeated_sentence_is_taken_once(spark):
    line = "alpha beta gamma delta epsilon zeta."
    got = run(spark, "frequency", [f"{line}\n{line}\n{line}"])["0"]
    assert got == line


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        run(spark, "lead", ["x"], max_words=9999)
    with pytest.raises(ValueError):
        run(spark, "guess", ["x"])


def test_keep_columns(spark):
    df = docs(spark, [TEXT, ""]).withColumn("split", F.lit("test"))
    for method in S.METHODS:
        rows = S.summarize(df, "id", "t", method, keep=["split"]).collect()
        assert {(r.id, r.split) for r in rows} == {("0", "test"), ("1", "test")}


def pairwise_ranks(sents):
    """The same whole-number ranks from all sentence pairs."""
    n = len(sents)
    a = [int(S.WEIGHT_ONE // np.sqrt(max(len(s), 1))) for s in sents]
    tie = [[len(set(x) & set(y)) if i != j else 0 for j, y in enumerate(sents)] for i, x in enumerate(sents)]
    degree = [a[i] * sum(tie[i][j] * a[j] for j in range(n)) for i in range(n)]
    score = [S.RANK_ONE] * n
    for _ in range(S.ROUNDS):
        flow = [score[j] * a[j] * S.FLOW_ONE // degree[j] if degree[j] else 0 for j in range(n)]
        got = [sum(tie[i][j] * flow[j] for j in range(n)) for i in range(n)]
        score = [S.RANK_BASE + S.DAMPING * (a[i] * got[i] // S.FLOW_ONE) // 100 for i in range(n)]
    return score


def test_graph_ranks_equal_the_pairwise_form():
    rng = random.Random(11)
    texts = [
        [sorted({rng.choice("abcdefghij") for _ in range(rng.randrange(0, 7))}) for _ in range(rng.randrange(0, 9))]
        for _ in range(40)
    ]
    got = S.graph_ranks(pa.array(texts, pa.list_(pa.list_(pa.string())))).to_pylist()
    assert got == [pairwise_ranks(t) for t in texts]
    assert S.graph_ranks(pa.array([[], []], pa.list_(pa.list_(pa.string())))).to_pylist() == [[], []]


def test_plug_in_model(spark):
    def load():
        def model(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("cannot")
            return [t.upper() for t in texts]

        return model

    got = {r.id: (r.prediction, r.error) for r in S.summarize_with(docs(spark, ["ok", "bad", " ", None]).coalesce(1), "t", load).collect()}
    assert got == {"0": ("OK", None), "1": (None, "cannot"), "2": ("", None), "3": ("", None)}


def test_plug_in_model_loads_once_per_worker(spark, tmp_path):
    mark = str(tmp_path / "loads")

    def load():
        with open(mark, "a") as f:
            f.write("x")
        return lambda texts: texts

    df = docs(spark, [f"text {i}" for i in range(50)]).repartition(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        assert S.summarize_with(df, "t", load).where("prediction <> ''").count() == 50
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert open(mark).read() == "x"


def test_repeated_ngrams(spark):
    got = {r.id: r.repeats for r in S.repeated_ngrams(docs(spark, ["a b c d e a b c d e", "a b c d e f", "a"]), "id", "t").collect()}
    assert got == {"0": True, "1": False, "2": False}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(13)
    rows = []
    for i in range(60):
        topic = rng.choice(["planet", "harbour", "garden"])
        sents = [f"The {topic} grows number{k} {topic}." if k < 2 else f"Filler{k} talks about nothing{k}." for k in range(6)]
        split = ("train", "validation", "test")[0 if i < 40 else 1 + i % 2]
        rows.append((str(i), " ".join(sents), f"the {topic} grows", split))
    return spark.createDataFrame(rows, "id string, t string, ref string, split string")


def test_features_and_labels(labelled):
    rows = M.sentence_features(labelled, "id", "t", "ref", ["split"]).where("id = '0'").orderBy("sent").collect()
    assert [r.label for r in rows] == [1.0] + [0.0] * 5 and [r.pick for r in rows][:2] == [1, 0]
    assert [r.overlap > 0.5 for r in rows] == [True, True, False, False, False, False]
    assert [r.place_share for r in rows] == [k / 5 for k in range(6)]
    assert [r.n_words for r in rows][0] == 5.0


def test_train_choose_save_load_and_summarise(spark, labelled, tmp_path):
    features = M.sentence_features(labelled, "id", "t", "ref", ["split"])
    model, report = M.train_sentence_model(features, (0.0, 5.0))
    rows = report.collect()
    assert {r.split for r in rows} == {"train", "validation", "test"} and len(rows) == 6
    losses = {(r.reg_param, r.split): r.log_loss for r in rows}
    chosen = {r.reg_param for r in rows if r.chosen}
    assert chosen == {min((0.0, 5.0), key=lambda g: losses[g, "validation"])}
    path = str(tmp_path / "model")
    assert M.load_model(spark, [path]) is None
    M.save_model(FT.trained_summariser(model, "t", 10), path)
    loaded = M.load_model(spark, [str(tmp_path / "absent"), path])
    extra = labelled.unionByName(spark.createDataFrame([("blank", "", "", "test"), ("0", "Only one.", "", "test"), (None, None, None, None)], labelled.schema))
    got = loaded.transform(extra)
    assert got.columns == [*extra.columns, "prediction"] and got.count() == 63
    by_text = {(r.id, r.t): r.prediction for r in got.collect()}
    assert by_text["0", labelled.where("id = '0'").first().t].count("grows") == 2
    assert by_text["blank", ""] == "" and by_text["0", "Only one."] == "Only one." and by_text[None, None] == ""
    # The stages in the model choose as the scores of the features say.
    p = M.probability(model, features).where("id = '1'").orderBy(F.desc("p"), "sent").collect()
    best = [r.sentence for r in p][:2]
    assert all(x in by_text["1", labelled.where("id = '1'").first().t] for x in best)


def plain_greedy(sents, ref):
    """The greedy choice by trying every sentence anew."""

    def score(chosen):
        total = 0
        for n in (1, 2):
            want = Counter(tuple(ref[i : i + n]) for i in range(len(ref) - n + 1))
            have = Counter(tuple(s[i : i + n]) for s in chosen for i in range(len(s) - n + 1))
            total += 2_000_000 * sum((want & have).values()) // max(sum(want.values()) + sum(have.values()), 1)
        return total

    chosen, best = [], 0
    while True:
        tried = [(score([sents[j] for j in [*(c for c, _ in chosen), i]]), -i) for i in range(len(sents)) if i not in {c for c, _ in chosen}]
        if not tried or max(tried)[0] <= best:
            return chosen
        best, at = max(tried)
        chosen.append((-at, best))


def test_greedy_labels_by_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        sents = [[rng.choice("abcdefgh") for _ in range(rng.randrange(0, 7))] for _ in range(rng.randrange(0, 8))]
        ref = [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 12))]
        assert M.greedy_choice(sents, ref) == plain_greedy(sents, ref)


def test_labels_of_odd_rows(spark):
    rows = [("a", "One two. Three four.", "three four"), ("a", "One two. Three four.", "one"), (None, "x. y.", None), (None, None, "x"), ("b", "", "x")]
    df = spark.createDataFrame(rows, "id string, t string, ref string")
    got = [(r.id, r.pick, r.sent, r.score) for r in M.oracle_labels(df, "id", "t", "ref").collect()]
    assert sorted(got) == [("a", 1, 0, 666_666), ("a", 1, 1, 2_000_000)]
    assert M.sentence_features(df, "id", "t", "ref").count() == 6
    assert M.oracle_labels(df.limit(0), "id", "t", "ref").count() == 0


def test_tfidf_model_in_a_fresh_reader(spark, labelled, tmp_path):
    fitted = FT.TfidfSummariser(textCol="t", outputCol="short", maxWords=6).fit(labelled.where("split = 'train'"))
    PipelineModel([fitted]).save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    stage = loaded.stages[0]
    assert (stage.getOrDefault("textCol"), stage.getOrDefault("outputCol"), stage.getOrDefault("maxWords")) == ("t", "short", 6)
    want = S.summarize(labelled, "id", "t", "tfidf", max_words=6, fit_on=labelled.where("split = 'train'"))
    want = {r.id: r.prediction for r in want.collect()}
    for part in ("split = 'test'", "id < '3'", "true"):
        asked = labelled.where(part)
        assert all(r.short == want[r.id] for r in loaded.transform(asked).collect())
        own = PipelineModel([stage.copy({stage.outputCol: "prediction"})])
        answers = R.predict(asked, "id", "t", fitted=own)
        assert all(r.summary == want[r.id] and r.error is None for r in answers.collect())


def test_tfidf_of_repeated_and_null_keys(spark):
    rows = [("a", "Cats purr. Dogs bark loudly."), ("a", "Rain falls. Snow melts."), (None, "One. Two."), (None, None)]
    df = spark.createDataFrame(rows, "id string, t string")
    got = Counter((r.id, r.prediction) for r in S.summarize(df, "id", "t", "tfidf").collect())
    assert got == Counter([("a", "Cats purr. Dogs bark loudly."), ("a", "Rain falls. Snow melts."), (None, "One. Two."), (None, "")])


def plain_beam(sizes, scores, grams, max_words, penalty):
    """The best of all allowed choices."""
    best = None
    for mask in range(1 << len(sizes)):
        own = [i for i in range(len(sizes)) if mask >> i & 1]
        seen, fits = set(), sum(sizes[i] for i in own) <= max_words
        for i in own:
            fits = fits and seen.isdisjoint(grams[i])
            seen |= set(grams[i])
        if fits:
            worth = round(sum(scores[i] for i in own) / max(sum(sizes[i] for i in own), 1) ** penalty, 6)
            best = max(best or (worth, ""), (worth, "".join("01"[i in own] for i in range(len(sizes)))))
    return best


def test_beam_search():
    """Width 1 is the greedy walk, no width is worse than it, and a wide search finds the best of all choices."""
    rng = random.Random(11)
    better = 0
    for _ in range(200):
        n = rng.randrange(0, 9)
        sizes = [rng.randrange(1, 9) for _ in range(n)]
        scores = sorted((rng.randrange(0, 30) for _ in range(n)), reverse=True)
        grams = [[rng.choice("abcdefghijkl") for _ in range(rng.randrange(3))] for _ in range(n)]
        limit = rng.randrange(1, 25)
        taken, words, seen = [], 0, set()
        for i in range(n):
            if words + sizes[i] <= limit and seen.isdisjoint(grams[i]):
                taken.append(i)
                words += sizes[i]
                seen |= set(grams[i])

        def worth(own):
            return round(sum(scores[i] for i in own) / max(sum(sizes[i] for i in own), 1) ** 0.8, 6)

        assert S.beam_search(sizes, scores, grams, limit, 1, 0.0) == taken
        eight = S.beam_search(sizes, scores, grams, limit, 8, 0.8)
        assert worth(eight) >= worth(taken) and sum(sizes[i] for i in eight) <= limit
        better += worth(eight) > worth(taken)
        all_ = S.beam_search(sizes, scores, grams, limit, 1 << n, 0.8)
        assert (worth(all_), "".join("01"[i in all_] for i in range(n))) == plain_beam(sizes, scores, grams, limit, 0.8)
    assert better > 20


@pytest.mark.parametrize("method", ["frequency", "textrank", "tfidf"])
def test_beams_of_odd_texts(spark, method):
    got = run(spark, method, ["", None, " \n ", TEXT, "One. One. One."], beams=4, max_words=12)
    assert got["0"] == got["1"] == got["2"] == "" and got["3"] and len(got["3"].split()) <= 12


def odd_texts(n=150):
    rng = random.Random(23)
    bits = ["a", "Cat", "dog", "été", "K", "İx", "KKelvin", " ", "\xa0", "\x85", "　", "\x1c", "\r", "\t", "\n", " ", " ", ". ", "! ", "?", ".", "日", "\U0001f600", "planets", "orbit stars slowly", "\x85."]
    return [None, "", " \n", "x" * 40, *("".join(rng.choice(bits) for _ in range(rng.randrange(70))) for _ in range(n))]


def test_parts_equal_the_column_functions(spark):
    """Sentences, words and tokens cut inside Arrow batches are those of the column functions."""
    texts = odd_texts()
    cut = T.sentences(F.col("t"))
    rows = docs(spark, texts).select("id", cut.alias("s"), F.transform(cut, lambda s: F.size(T.words(s))).alias("n"), T.tokens(F.col("t")).alias("k")).collect()
    want = {int(r.id): (r.s, r.n, r.k or []) for r in rows}
    p = P.parts_of(*P.text_bytes(pa.array(texts, pa.string())))
    bounds = P.text_bytes(pa.array(texts, pa.string()))[1]
    for i in range(len(texts)):
        own = range(p.first[i], p.first[i + 1])
        toks = p.tokens.codes[slice(*np.searchsorted(p.tokens.starts, bounds[i : i + 2]))]
        got = ([p.data[p.starts[s] : p.ends[s]].tobytes().decode() for s in own], [int(p.n_words[s]) for s in own])
        assert (*got, [p.tokens.words[int(c)].as_py() for c in toks]) == want[i]


def test_choice_in_a_batch_equals_choose_sentences(spark, monkeypatch):
    """Slices of a few bytes and budgets of 0, of no number, and below a sentence's length change nothing."""
    texts = odd_texts()
    p = P.parts_of(*P.text_bytes(pa.array(texts, pa.string())))
    scores = np.array([s % 3 for s in range(len(p.starts))])
    budgets = [(None, 0, 1, 2, 3, 5, 8, 128)[i % 8] for i in range(len(texts))]
    rows = []
    for i in range(len(texts)):
        own = [(int(-scores[s]), s, p.data[p.starts[s] : p.ends[s]].tobytes().decode()) for s in range(p.first[i], p.first[i + 1])]
        rows.append((i, sorted(own), budgets[i]))
    df = spark.createDataFrame(rows, "i int, ranked array<struct<order:int,sent:int,sentence:string>>, b int")
    want = df.select("i", S.choose_sentences(F.col("ranked"), F.col("b")).alias("p")).collect()
    got = P.choose(p, scores, budgets, S.NO_REPEAT)
    assert {r.i: r.p for r in want} == {i: x.decode() for i, x in enumerate(got)}
    monkeypatch.setattr(P, "SLICE_BYTES", 50)
    array = pa.array(["gone", *texts], pa.large_string()).slice(1)
    again = [x for row, d, b in P.slices(array) for x in P.choose(P.parts_of(d, b), np.zeros(10_000, np.int64)[: len(P.parts_of(d, b).starts)], budgets[row : row + len(b) - 1], S.NO_REPEAT)]
    assert again == P.choose(p, np.zeros(len(p.starts), np.int64), budgets, S.NO_REPEAT)


def test_tfidf_of_many_words_moves_no_text(spark, monkeypatch):
    """More words than a broadcast head of 100,000: nothing is staged or shuffled, and the rest path gives the same."""
    rng = random.Random(5)
    texts = [". ".join(" ".join(f"w{rng.randrange(400_000)}" for _ in range(9)) for _ in range(300)) for _ in range(70)]
    df = docs(spark, [None, "", *texts])
    idf = S.stage_table(S.fit_idf(df, "t"), "idf")
    assert idf.count() > 100_000
    staged = []
    monkeypatch.setattr(skew, "stage_table", lambda table, name: staged.append(name) or stage_table(table, name))
    got = S.summarize_tfidf(df, idf, "id", "t")
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        got.explain()
    assert staged == [] and "Exchange" not in plan.getvalue()
    got = {r.id: r.prediction for r in got.collect()}
    monkeypatch.setattr(S, "HEAD_WORDS", 0)
    want = {r.id: r.prediction for r in S.summarize_tfidf(df, idf, "id", "t").collect()}
    assert staged == ["lookup"] and got == want and all(got[str(i)] for i in range(2, 72))


def test_word_hashes_tell_words_apart():
    words = ["", *(x * n for x in "ab0" for n in range(1, 40)), *(f"{'a' * n}b" for n in range(30)), *(str(i) for i in range(20_000))]
    hashed = P.word_hashes(pa.array(words))
    assert len(set(hashed.tolist())) == len(set(words))
    assert P.word_hashes(pa.array(["x", *words]).slice(1)).tolist() == hashed.tolist()
    assert len(P.word_hashes(pa.array([], pa.string()))) == 0


def test_fit_idf_counts_texts(spark, monkeypatch):
    monkeypatch.setattr(P, "SLICE_BYTES", 60)
    texts = odd_texts()
    toks = docs(spark, texts).select(F.array_distinct(T.tokens(F.col("t"))).alias("k")).collect()
    got = S.fit_idf(docs(spark, texts), "t").collect()
    assert {r.word: r.df for r in got} == Counter(w for r in toks for w in r.k or [])
    assert all(r.idf == round(1000 * np.log((1 + len(texts)) / (1 + r.df))) for r in got)
    assert S.fit_idf(docs(spark, texts).limit(0), "t").collect() == []


def test_numbered_and_distinct():
    rng = random.Random(41)
    for top in (1, 50, 1 << 62):
        values = np.array([rng.randrange(top) for _ in range(300)])
        place, first = P.numbered(values)
        want, at, inverse = np.unique(values, return_index=True, return_inverse=True)
        assert (place == inverse).all() and (first == at).all() and (P.distinct(values) == want).all()
    assert [len(x) for x in (*P.numbered(np.empty(0, np.int64)), P.distinct(np.empty(0, np.int64)))] == [0, 0, 0]
