"""Importance resampling against a plain version, and the selection against sorting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from precis.llm import resample
from precis.llm.queries import QUERIES

_FOLD = {c: c + 32 for c in range(65, 91)}


def plain_features(text, runs):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_FOLD))
    return words, [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def plain_resample(rows, target, percent=10, min_words=20, buckets=10_000, runs=1, seed=2024):
    def of(text):
        words, features = plain_features(text, runs)
        return len(words), [zlib.crc32(f.encode()) % buckets for f in features]

    docs = [(key, *of(text)) for key, text in rows]
    s, t = Counter(b for _, _, f in docs for b in f), Counter(b for x in target for b in of(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for key, n_words, features in docs:
        gains = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in features]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(features), weight, score, n_words])
    order = lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2])
    able = sorted((r for r in out if r[4] >= min_words), key=order)
    able = able[: len(able) * percent // 100]
    ranks = {id(r): i + 1 for i, r in enumerate(able)}
    return Counter((*r[:4], ranks.get(id(r))) for r in out)


def test_crc32s():
    rng = random.Random(1)
    for sizes in ([0, 1, 5, 64, 65, 300], [3] * 50, []):
        parts = [bytes(rng.randrange(256) for _ in range(n)) for n in sizes]
        data = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
        starts = ends - [len(p) for p in parts]
        assert resample.crc32s(data, starts, ends).tolist() == [zlib.crc32(p) for p in parts]
        before = np.arange(len(parts), dtype=np.uint32) * 99
        want = [zlib.crc32(p, int(b)) for p, b in zip(parts, before, strict=True)]
        assert resample.crc32s(data, starts, ends, before).tolist() == want


@pytest.mark.parametrize("runs, percent, min_words", [(1, 10, 20), (2, 50, 0), (3, 100, 1), (1, 0, 20)])
def test_odd_rows(spark, odd, runs, percent, min_words):
    docs = odd.withColumns({"key": F.lit(1), "weight": F.lit(2), "pos": F.lit(3), "rank": F.lit(4), "side": F.lit(5)})
    target = docs.where("doc_id in (2, 4, 8)").select(F.col("text").alias("key"), F.lit(1).alias("text"))
    got = resample.resample(docs, "doc_id", "text", target, "key", percent, min_words, 500, runs)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain_resample(rows, [r["key"] for r in target.collect()], percent, min_words, 500, runs)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert got.columns == ["key", "n_features", "weight", "score", "rank"]


def test_text_keys(spark, odd):
    docs = odd.withColumn("doc_id", F.concat(F.lit("k"), F.col("doc_id").cast("string")))
    got = resample.resample(docs, "doc_id", "text", docs, "text", 50, 1)
    ranks = [r["rank"] for r in got.collect() if r["rank"] is not None]
    able = sum(len(plain_features(r["text"], 1)[0]) >= 1 for r in docs.collect())
    assert sorted(ranks) == list(range(1, able // 2 + 1))


@pytest.mark.parametrize("kind, shrink", [("spread", 0.0), ("spread", 0.9), ("level", 0.25), ("few", 0.25)])
def test_cutoff(spark, monkeypatch, kind, shrink):
    """Every place is found, with and without writing what remains anew."""
    monkeypatch.setattr(resample, "_SHRINK", shrink)
    rng = random.Random(kind)
    n = 3 if kind == "few" else 900
    score = {"spread": lambda i: rng.randrange(10**6), "level": lambda i: 7, "few": lambda i: i % 2}[kind]
    rows = [(i % 800 if i else None, 5, i % 3, score(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "key long, n_features long, weight long, score long").repartition(3)
    placed = sorted((-s, k is None, k or 0, f, w) for k, f, w, s in rows)
    for at in {1, n // 3, n}:
        found = resample.cutoff(resample._order(df), at)
        assert (*found[:2], found[2] or 0, *found[3:]) == placed[at - 1]
    assert resample.cutoff(resample._order(df), 0) is None
    with pytest.raises(ValueError, match="rows"):
        resample.cutoff(resample._order(df), n + 1)


def test_a_quarter_goes_each_round():
    """The weighted median of medians leaves at least a quarter of the rows on each side."""
    rng = random.Random(4)
    for _ in range(50):
        parts = [sorted((rng.randrange(1000),) for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 20))]
        every = [x for p in parts for x in p]
        split = resample._Split(len(every), [(p[(len(p) - 1) // 2], len(p)) for p in parts])
        pivot = split.pivot()
        assert 4 * sum(x <= pivot for x in every) >= len(every) and 4 * sum(x >= pivot for x in every) >= len(every)


def test_nothing(spark, no_docs, odd):
    assert resample.resample(no_docs, "doc_id", "text", odd, "text").count() == 0
    got = resample.resample(odd, "doc_id", "text", no_docs, "text", 100)
    assert got.count() == odd.count() and got.where("rank is not null").count() > 0


def test_query(spark, tables):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tables}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op12_importance_resampling"](spark, tables).collect())
    assert got == plain_resample(docs, target)
