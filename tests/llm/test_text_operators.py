"""Language identification, decontamination, language model, spans, quality against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from precis.llm import bloom_lm, decontaminate, langid, quality, spans
from precis.llm.words import slices
from tests.llm.conftest import edited, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return [w.lower() for w in (text or "").encode().split()]


# Language identification


def phrases(text, sample):
    sample = langid._fold(sample) + " "
    text = re.sub(" +", " ", "".join(c.lower() if c.isalpha() else " " for c in text)).lstrip(" ")
    i = n = 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i : j + 1] in sample:
            j += 1
        i, n = j, n + 1
    return n, len(text)


def test_phrases_against_brute_force():
    known = {"a": prose(1, 80), "b": prose(2, 60).upper() + " é ß", "c": "xyz"}
    tables = langid.build(known)
    texts = [prose(3, 50), prose(1, 30) + " 12 é", "", None, "!!", "Éx yz", "中文 abc", "a"]
    names, scores, entropy = langid._judge(tables, pa.array(texts))
    for text, name, score, least in zip(texts, names, scores, entropy, strict=True):
        if not any(c.isalpha() for c in text or ""):
            assert (name, score) == ("und", 0.0)
            continue
        want = {}
        for k, sample in known.items():
            n, size = phrases(text, sample)
            want[k] = n * math.log2(max(2, len(langid._fold(sample)))) / size
        assert least == pytest.approx(min(want.values()))
        assert name == min(want, key=lambda k: (want[k], k)) and 0.5 <= score <= 1


def test_languages_held_out(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    known = langid.samples(docs, "doc_id", "text", "lang", rest != 0)
    found = langid.identify(docs, "doc_id", "text", known).withColumnRenamed("key", "doc_id")
    held = docs.where(rest == 0).join(found, "doc_id").where("lang is not null")
    right, n = held.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 20 and right >= 0.95 * n


def test_language_of_odd_rows(spark, odd, no_docs):
    known = langid.samples(odd, "doc_id", "text", "lang", F.lit(True), documents=3, chars=200)
    assert set(known) == {"en", "fr"}
    got = langid.identify(odd, "doc_id", "text", known).collect()
    assert len(got) == odd.count()
    assert all((r["lang_pred"] == "und") == (r["key"] in (4, 5, 6, 13)) for r in got)
    assert langid.samples(no_docs, "doc_id", "text", "lang", F.lit(True)) == {}
    assert {r["lang_pred"] for r in langid.identify(odd, "doc_id", "text", {}).collect()} == {"und"}
    assert langid.identify(no_docs, "doc_id", "text", known).collect() == []


# Decontamination


def plain_contamination(docs, items):
    out = {}
    for key, text in docs:
        own = words(text)
        for item, passage in items:
            w = words(passage)
            n, size = min(5, len(w)), min(len(w), len(own))
            if not w or not own or size < n:
                continue
            parts = lambda x, n=n: Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1))
            want = parts(w)
            for s in range(len(own) - size + 1):
                have = parts(own[s : s + size])
                sim = sum((want & have).values()) / sum((want | have).values())
                if sim >= 0.8 and (sim, -s) > out.get((key, item), (0, 0)):
                    out[key, item] = (sim, -s)
    return {k: (round(s, 12), -at) for k, (s, at) in out.items()}


def test_contamination_against_brute_force(spark):
    items = [(i, prose(100 + i, 20 + 9 * i)) for i in range(6)]
    items += [(10, "one two"), (11, "three"), (12, None), (13, " "), (14, items[0][1]), (None, prose(200, 30))]
    rng = random.Random(1)
    docs = []
    for i in range(60):
        passage = items[rng.randrange(6)][1]
        n = len(passage.split(" "))
        kind = i % 6
        if kind == 1:
            passage = edited(passage, [0])
        elif kind == 2:
            passage = edited(passage, [rng.randrange(n), rng.randrange(n)])
        elif kind == 3:
            passage = passage.upper().replace(" ", " \n")
        elif kind == 4:
            passage = " ".join(passage.split(" ")[: n - 2])
        elif kind == 5:
            passage = prose(300 + i, 30)
        docs.append((i, f"{prose(400 + i, rng.randrange(40))} {passage}\n{prose(500 + i, rng.randrange(40))}"))
    docs += [(100, items[2][1]), (101, None), (102, ""), (103, "x one TWO y"), (104, "three"), (None, items[3][1])]
    df = spark.createDataFrame(docs, "k long, t string").repartition(3)
    bench = spark.createDataFrame(items, "i long, p string")
    want = plain_contamination(docs, items)
    assert len(want) > 30
    for block in (1, 1 << 20):
        got = decontaminate.contamination(df, "k", "t", bench, "i", "p", block_bytes=block).collect()
        assert {(r["key"], r["item"]): (round(r["similarity"], 12), r["start"]) for r in got} == want
        assert all(r["distance"] <= decontaminate.RADIUS for r in got)
    clean = decontaminate.decontaminated(df, "t", bench, "p").collect()
    dirty = {k for k, _ in want}
    assert sorted(str(r["k"]) for r in clean) == sorted(str(k) for k, _ in docs if k not in dirty)


def test_multi_index_finds_all_within_radius():
    rng = random.Random(2)
    texts = [prose(i, 30) for i in range(20)]
    index = decontaminate.Index(texts, 5, 0.8, decontaminate.RADIUS)
    _, prints, _ = index.by_size[30]
    near = []
    for fp in prints.tolist():
        for k in (0, 5, decontaminate.RADIUS, decontaminate.RADIUS + 1):
            near.append(fp ^ sum(1 << b for b in rng.sample(range(64), k)))
    got = {(w, i) for w, i, _ in index.near(30, np.array(near, dtype=np.uint64), np.arange(20))}
    want = {(w, i) for w, a in enumerate(near) for i, b in enumerate(prints.tolist()) if (a ^ b).bit_count() <= decontaminate.RADIUS}
    assert got == want
    some = {(w, i) for w, i, _ in index.near(30, np.array(near, dtype=np.uint64), np.array([3, 7]))}
    assert some == {(w, i) for w, i in want if i in (3, 7)}


@pytest.mark.parametrize("kind", ["int", "date", "string", "decimal(10,2)"])
def test_item_keys_of_any_type(spark, kind):
    items = [(i, prose(100 + i, 30)) for i in range(4)]
    days = F.date_add(F.lit("2024-01-01"), F.col("i")).cast(kind) if kind == "date" else F.col("i").cast(kind)
    bench = spark.createDataFrame([*items, (None, prose(150, 30))], "i int, p string").withColumn("i", days)
    docs = spark.createDataFrame([(i, f"before {t} behind") for i, t in items] + [(9, prose(150, 30))], "k int, t string")
    got = decontaminate.contamination(docs.withColumn("k", F.col("k").cast("date" if kind == "date" else kind) if kind != "date" else F.date_add(F.lit("2024-01-01"), F.col("k"))), "k", "t", bench, "i", "p")
    assert got.schema["item"].dataType == bench.schema["i"].dataType
    pairs = {(str(r["key"]), str(r["item"])) for r in got.collect()}
    assert len(pairs) == 5 and sum(a == b for a, b in pairs) == 4 and sum(b == "None" for _, b in pairs) == 1


def test_many_blocks_leave_one_worker_step(spark):
    """Each block's rows are written before the next is sent, so no plan chains the searches of two."""
    items = [(i, prose(100 + i, 25)) for i in range(14)]
    bench = spark.createDataFrame(items, "i int, p string")
    rows = [(1, prose(900, 40)), (2, f"x {items[13][1]} y"), (2, prose(901, 40)), (None, items[0][1]), (None, None), (3, items[5][1]), (3, items[5][1])]
    docs = spark.createDataFrame(rows, "key int, text string")
    plans = []
    real = decontaminate.stage_table
    decontaminate.stage_table = lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, name)
    try:
        got = decontaminate.contamination(docs, "key", "text", bench, "i", "p", block_bytes=1)
        clean = decontaminate.decontaminated(docs, "text", bench, "p", block_bytes=1)
    finally:
        decontaminate.stage_table = real
    assert len(plans) == 28 and all(p.count("MapInArrow") == 1 for p in plans)
    assert "MapInArrow" not in got._jdf.queryExecution().executedPlan().toString()
    assert Counter((r["key"], r["item"]) for r in got.collect()) == Counter([(2, 13), (None, 0), (3, 5), (3, 5)])
    assert Counter(tuple(r) for r in clean.collect()) == Counter([rows[0], rows[2], rows[4]])


def test_contamination_of_nothing(spark, odd, no_docs):
    bench = spark.createDataFrame([(1, prose(900, 30))], "i long, p string")
    assert decontaminate.contamination(no_docs, "doc_id", "text", bench, "i", "p").collect() == []
    assert decontaminate.contamination(odd, "doc_id", "text", bench.limit(0), "i", "p").collect() == []
    assert decontaminate.decontaminated(odd, "text", bench, "p").count() == odd.count()


# Language model


def test_base_score_against_brute_force(spark, odd):
    learns = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    taught = [t for k, t in rows if k is not None and zlib.crc32(str(k).encode()) % 3 != 0]
    counts = Counter(w for t in taught for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(k), len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), None]), n,
         round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words(t), None]), 6))
        for k, t in rows
    )
    for head in (0, 50, 500_000):
        got = bloom_lm.score(odd, "doc_id", "text", learns, head_rows=head).collect()
        fields = ("n_tokens", "n_known", "train_tokens")
        assert sorted((str(r["key"]), *(r[f] for f in fields), round(r["base_score"], 6)) for r in got) == want
        assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def test_language_model_of_nothing(spark, odd, no_docs):
    assert bloom_lm.score(no_docs, "doc_id", "text", F.lit(True)).collect() == []
    got = bloom_lm.score(odd, "doc_id", "text", F.lit(None).cast("boolean")).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got} == {(0, 0, 0.0, 0.0)}


def test_filter_reads_levels(spark):
    texts = [("a " * 40 + "b " * 9 + prose(1, 200),), (prose(1, 200),)]
    model = bloom_lm.learn(spark.createDataFrame(texts, "t string"), "t")
    counts = Counter(w for (t,) in texts for w in words(t))
    part = next(slices(pa.array([" ".join(w.decode() for w in counts)])))
    got = model.filter.counts(bloom_lm.WORD, part.hashes)
    want = bloom_lm._TYPICAL[bloom_lm.level(np.array(list(counts.values())))]
    assert (got >= want).all() and (got == want).mean() > 0.9
    strange = bloom_lm.mix(np.arange(10_000, dtype=np.uint64))
    assert (model.filter.counts(bloom_lm.PAIR, strange) > 0).mean() < 0.15


def test_filter_keeps_its_bound(spark):
    texts = spark.createDataFrame([(prose(i, 300),) for i in range(6)] + [(prose(1, 300),)] * 3, "t string")
    model = bloom_lm.learn(texts, "t", filter_bytes=400)
    assert model.filter.shape.lowest > 1 and model.filter.words.nbytes <= 400 + 8 * len(model.filter.shape.size)


def test_scores_do_not_depend_on_the_bound(spark, odd, monkeypatch):
    """A filter too large to be broadcast is read whole: rare words and pairs count as they do in a small one."""
    texts = [(i, prose(i % 9, 200 + i)) for i in range(40)] + [(r["doc_id"], r["text"]) for r in odd.collect()]
    df = spark.createDataFrame(texts, "k long, t string").repartition(3).persist()
    learns = F.col("k") % 7 != 2
    fields = ("learned", "n_tokens", "n_known", "train_tokens")

    def scored(**bounds):
        got = bloom_lm.score(df, "k", "t", learns, **bounds).collect()
        return sorted((str(r["key"]), *(r[f] for f in fields), round(r["base_score"], 6), round(r["score"], 6)) for r in got)

    want = scored()
    assert scored(filter_bytes=400) == want
    monkeypatch.setattr(bloom_lm, "FLUSH_TOKENS", 500)
    assert scored(filter_bytes=400, head_rows=3) == want


def test_probabilities_sum_to_one_at_most(spark):
    """Over all words after one context, with exact counts, the model's probabilities sum to 1."""
    pairs, seen = np.array([3.0, 2.0, 0.0, 0.0]), np.array([9.0, 5.0, 2.0, 1.0])
    total, before = seen.sum() + len(seen), pairs.sum()
    chance = (pairs + bloom_lm.PRIOR * (seen + 1) / total) / (before + bloom_lm.PRIOR)
    assert chance.sum() == pytest.approx(1)


# Repeated spans


def plain_spans(docs):
    """Sentences by regular expression, runs by trial, owners by sorting."""
    split, runs = {}, {}
    for key, text in docs:
        marked = re.sub(r"([.!?][\x20\x09-\x0D]+|[\x20\x09-\x0D]*\n[\x20\x09-\x0D]*)", "\\1\x01", text or "")
        parts = marked.split("\x01")
        lead = "" if not parts or WORD.search(parts[0]) else parts[0]
        split[key] = (lead, [p for p in parts if WORD.search(p)])
        own = [words(p) for p in split[key][1]]
        spans_ = set()
        for i in range(len(own)):
            if len(own[i]) >= 50:
                spans_.add((i, i))
                continue
            for order in (range(i + 1, len(own)), range(i - 1, -1, -1)):
                for j in order:
                    a, b = min(i, j), max(i, j)
                    if sum(map(len, own[a : b + 1])) >= 20:
                        spans_.add((a, b))
                        break
        for a, b in spans_:
            runs.setdefault(tuple(w for s in own[a : b + 1] for w in s), []).append((key, a, b))
    gone = {key: set() for key, _ in docs}
    for places in runs.values():
        for key, a, b in sorted(places)[1:]:
            gone[key].update(range(a, b + 1))
    return {
        key: ("".join([lead, *(s for i, s in enumerate(own) if i not in gone[key])]), len(own), len(gone[key]))
        for key, (lead, own) in split.items()
    }


def test_spans_against_brute_force(spark):
    rng = random.Random(4)
    shared = [prose(50 + i, 60) for i in range(3)] + ["w " * 55 + "x.", "Short one. And two."]
    docs = []
    for i in range(40):
        parts = [prose(1000 + i, rng.randrange(30)) + rng.choice(["", ".", "!"])]
        for _ in range(rng.randrange(4)):
            parts.append(rng.choice(shared))
            parts.append(prose(2000 + 10 * i, rng.randrange(30)) + ".")
        docs.append((i, rng.choice(["\n", " \n ", "  ", ". "]).join(parts)))
    docs += [(50, " \n" + docs[3][1] + "\n"), (51, ""), (52, " \n "), (53, docs[3][1].replace(" ", "\t"))]
    want = plain_spans(docs)
    df = spark.createDataFrame(docs, "k long, t string").repartition(3)
    got = spans.without_repeats(df, "k", "t").collect()
    assert {r["key"]: (r["text"], r["n_sentences"], r["n_removed"]) for r in got} == want
    assert sum(n for *_, n in want.values()) > 50


def test_spans_of_repeated_keys(spark):
    """Texts of one key are documents of their own; equal rows are one; null keys stay as they are."""
    shared, other = prose(60, 60), prose(61, 60)
    texts = {
        (2, "first"): f"{prose(70, 12)}. {shared} {prose(71, 12)}.",
        (2, "second"): f"{prose(72, 12)}. {other} {prose(73, 12)}.",
        (2, "third"): f"{prose(74, 12)}. {shared}",
        (1, "same"): f"{shared} {prose(75, 12)}.",
        (3, "alone"): f"{other} {prose(76, 25)}. {prose(77, 25)}.",
    }
    hashes = {r["t"]: r["h"] for r in spark.createDataFrame([(t,) for t in texts.values()], "t string").selectExpr("t", "xxhash64(t) h").collect()}
    want = plain_spans([((k, hashes[t]), t) for (k, _), t in texts.items()])
    rows = [(k, t) for (k, _), t in texts.items()] + [(1, texts[1, "same"]), (None, shared), (None, shared)]
    got = spans.without_repeats(spark.createDataFrame(rows, "k long, t string").repartition(3), "k", "t").collect()
    expected = Counter((k, *want[k, hashes[t]]) for (k, _), t in texts.items())
    expected[1, *want[1, hashes[texts[1, "same"]]]] += 1
    n = plain_spans([(0, shared)])[0][1]
    expected[None, shared, n, 0] += 2
    assert Counter(tuple(r) for r in got) == expected
    assert sum(n for *_, n in want.values()) > 5 and want[2, hashes[texts[2, "second"]]][2] == 0


def test_spans_of_odd_rows(spark, odd, no_docs):
    got = spans.without_repeats(odd, "doc_id", "text").collect()
    assert len(got) == odd.count()
    by_key = {r["key"]: r for r in got}
    assert by_key[4]["text"] is None and by_key[4]["n_sentences"] == 0
    assert by_key[5]["text"] == "" and by_key[6]["text"] == " \t\n\x0b "
    assert by_key[1]["n_removed"] == by_key[7]["n_removed"] == by_key[None]["n_removed"] == 0
    assert by_key[2]["text"] == "" and by_key[11]["text"].strip() == prose(5, 40)
    assert spans.without_repeats(no_docs, "doc_id", "text").collect() == []


# Quality


def plain_measures(text):
    own = WORD.findall(text or "")
    seen = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    covered = {i + k for i in range(len(own) - 4) if seen[tuple(own[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measures_against_brute_force(spark, odd):
    texts = ["a b c d e " * 5, "a b c d e f g a b c d e", "x\nx\n \nX\nx", "a b c d", "a " * 40, "é中# $|", "a b c d e x a b c d e y b c d e x"]
    rows = [(100 + i, t) for i, t in enumerate(texts)] + [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = quality.verdicts(spark.createDataFrame(rows, "k long, t string"), "k", "t").collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r["key"]), *(r[f] for f in fields)) for r in got) == sorted((str(k), *plain_measures(t)) for k, t in rows)
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def plain_estimate(patterns, steps=quality.MAX_STEPS):
    """The same expectation-maximisation over single texts."""
    good = np.array([0.05 if -1 in p else 0.95 for p in patterns])
    votes = np.array(patterns)
    last = None
    for _ in range(steps):
        share = (good.sum() + 1) / (len(good) + 2)
        right, caught = [], []
        for v in votes.T:
            up, down = v == 1, v == -1
            a = (good[up].sum() + 1) / (good[up].sum() + good[down].sum() + 2)
            b = ((1 - good)[down].sum() + 1) / ((1 - good)[up].sum() + (1 - good)[down].sum() + 2)
            right.append(a)
            caught.append(max(b, 1 - a))
        odds = np.full(len(good), share / (1 - share))
        for v, a, b in zip(votes.T, right, caught, strict=True):
            odds *= np.where(v > 0, a / (1 - b), np.where(v < 0, (1 - a) / b, 1.0))
        good = odds / (1 + odds)
        flat = [share, *right, *caught]
        if last and max(abs(x - y) for x, y in zip(flat, last, strict=True)) <= quality.TOLERANCE:
            break
        last = flat
    return share, right, caught


def test_estimate_against_plain(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(400):
        good = rng.random() < 0.8
        texts.append(tuple(0 if rng.random() < 0.2 else (1 if rng.random() < (0.97 if good else 0.4) else -1) for _ in range(4)))
    counts = Counter(texts)
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame([(*p, n) for p, n in counts.items()], "a int, b int, c int, d int, n long")
    got = quality.estimate(df, names)
    share, right, caught = plain_estimate(texts)
    assert got.share == pytest.approx(share) and 0.7 < share < 0.9
    assert list(got.good.values()) == pytest.approx(right) and list(got.bad.values()) == pytest.approx(caught)


def test_quality_rejects_junk(spark):
    rows = [(i, prose(i, 60), "good") for i in range(60)]
    rows += [(100 + i, prose(i, 60).replace(" ", "%%% "), "junk") for i in range(8)]
    rows += [(200 + i, prose(i, 60).upper().replace(" ", "!! "), "junk") for i in range(8)]
    rows += [(300, None, "junk"), (301, "", "junk")]
    df = spark.createDataFrame(rows, "k long, t string, quality string")
    judged = quality.judged(df, "t")
    assert judged.columns == ["k", "t", "quality", "quality_"]
    got = judged.select("quality", F.col("quality_")["kept"].alias("kept")).collect()
    assert all(r["kept"] == (r["quality"] == "good") for r in got)
    assert judged.limit(0).count() == 0 and quality.judged(df.limit(0), "t").count() == 0
