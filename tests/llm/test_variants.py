"""Spelling variants against plain comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from precis.llm import variants
from precis.llm.queries import QUERIES

LETTERS = "abeñtßé"


def plain_counts(rows, drop_every):
    total = Counter()
    fold = {c: c + 32 for c in range(65, 91)}
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(fold)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    total.pop("", None)
    return total


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    if len(a) == len(b):
        return i < len(a) and a[i + 1 :] == b[i + 1 :]
    return len(a) + 1 == len(b) and a[i:] == b[i + 1 :]


def plain_groups(counts, times=5):
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [] for w in counts}
    for n, some in by_length.items():
        for i, a in enumerate(some):
            for b in some[i + 1 :] + by_length.get(n + 1, []):
                if one_edit(a, b):
                    near[a].append(b)
                    near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def random_counts(seed, words, letters, shortest, longest):
    rng = random.Random(seed)
    made = {}
    while len(made) < words:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(shortest, longest)))
        made[w] = rng.choice([5, 6, 30, 31, 160, 900, 5000])
    return made


@pytest.mark.parametrize(
    "seed, letters, shortest, longest, list_rows", [(1, LETTERS, 4, 7, 100), (2, "ab", 4, 12, 3), (3, "abc", 6, 9, 100)]
)
def test_groups(spark, monkeypatch, seed, letters, shortest, longest, list_rows):
    monkeypatch.setattr(variants, "LIST_ROWS", list_rows)
    monkeypatch.setattr(variants, "CARRIED", 6 if seed == 1 else 64)
    counts = random_counts(seed, 1500, letters, shortest, longest)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {tuple(r) for r in variants.grouped(words).collect()} == plain_groups(counts)


@pytest.mark.parametrize("nodes", [20, 1000, 10**9])
def test_every_edit_leaves_a_probe(nodes, monkeypatch):
    """Whatever the dictionary, words of one edit share a list in which one of them is a probe."""
    rng = random.Random(nodes)
    made = list(random_counts(5, 300, "abc", 6, 12))
    grams = Counter(w[p : p + q] for w in made for q in range(2, 8) for p in range(len(w) - q + 1))
    inner = frozenset(g for g, n in grams.items() if n > len(made) / nodes)
    for w in made:
        p = rng.randrange(len(w))
        for other in {w[:p] + "c" + w[p + 1 :], w[:p] + "b" + w[p:], w + "a", "b" + w} - {w}:
            for entries in (lambda x: variants.gram_entries(x, inner), variants.edit_entries):
                mine, theirs = dict(entries(w)), dict(entries(other))
                assert any(mine[k] | theirs[k] == 3 for k in mine.keys() & theirs.keys())


def test_edit_lists_are_bounded():
    """Under what stands on both sides of an edit there is one word for each letter, and one more."""
    some = ["aaa" + c + "bbb" for c in "abcdefgh"] + ["aaabbb"]
    lists = Counter(k for w in some for k, _ in variants.edit_entries(w))
    assert max(lists.values()) <= 9


def test_odd_rows(spark, odd):
    docs = odd.withColumns({"word": F.lit("x"), "n": F.lit(1), "list": F.lit(2), "root": F.lit("y")})
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for every in (0, 7):
        counts = {w: n for w, n in plain_counts(rows, every).items() if len(w) >= 6 and n >= 5}
        got = variants.variants(docs, "doc_id", "text", drop_every=every)
        assert {tuple(r) for r in got.collect()} == plain_groups(counts)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_very_long_words(spark):
    words = spark.createDataFrame([("ab" * 2_000, 100), ("ab" * 2_000 + "a", 5), ("ab" * 1_999 + "xx", 5)], "word string, n long")
    got = {len(r["word"]) * (1 if r["word"][-1] != "x" else -1): r["n_near"] for r in variants.grouped(words).collect()}
    assert got == {4_000: 1, 4_001: 1, -4_000: 0}


def test_chains_end_at_the_last_form(spark):
    chain = [("abcdef" + "g" * i, 5 * 6**i) for i in range(9)]
    got = variants.grouped(spark.createDataFrame(chain, "word string, n long")).collect()
    assert {r["root"] for r in got} == {chain[-1][0]} and len(got) == 9


def test_nothing(spark, no_docs):
    assert variants.variants(no_docs, "doc_id", "text").count() == 0
    with pytest.raises(ValueError, match="4"):
        variants.variants(no_docs, "doc_id", "text", min_length=3)


def test_query(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").collect()
    counts = plain_counts([(r["doc_id"], r["text"]) for r in docs], 199)
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = QUERIES["op11_spelling_variants"](spark, tables)
    assert {tuple(r) for r in got.collect()} == plain_groups(counts) and counts
