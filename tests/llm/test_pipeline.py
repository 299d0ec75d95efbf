"""The stages against plain versions of what they decide."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from precis.llm import quality
from precis.llm.words import counted
from tests.llm.conftest import prose
from tests.llm.test_outputs import want_rows, want_targets
from tests.llm.test_near_copies import brute_copies
from tests.llm.test_text_operators import plain_contamination

pytest.importorskip("public_tokenizers")


def test_names():
    assert [n for n, _ in C.STAGES] == ["quality_rules", "near_dedup", "decontamination", "mix", "token_output"]


def test_stages_against_plain_versions(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = C.quality_rules(spark, docs, tables).persist()
    judged = {r["key"]: r for r in quality.verdicts(docs, "doc_id", "text").collect()}
    assert {r["doc_id"] for r in kept.collect()} == {k for k, r in judged.items() if r["kept"]}
    assert kept.columns == docs.columns and 0.5 * docs.count() < kept.count() < docs.count()

    name = brute_copies({r["doc_id"]: r["text"] for r in kept.collect()})
    single = C.near_dedup(spark, kept, tables).persist()
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(name.values()))
    assert single.columns == docs.columns and single.count() < kept.count()

    bench = spark.read.parquet(f"{tables}/benchmark.parquet").collect()
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    # The plain search is quadratic: try it on documents that share a run of words with an item, and some others.
    shared = {k for k, t in texts.items() if any(" ".join(b["text"].split()[:4]) in " ".join(t.split()) for b in bench)}
    tried = sorted(shared | set(sorted(texts)[:5]))
    dirty = {k for k, _ in plain_contamination([(k, texts[k]) for k in tried], [(b["item_id"], b["text"]) for b in bench])}
    clean = C.decontamination(spark, single, tables).persist()
    assert {r["doc_id"] for r in clean.collect()} == set(texts) - dirty and dirty
    assert clean.columns == docs.columns

    mixed = C.mix(spark, clean, tables).persist()
    size = {r["doc_id"]: (r["source"], r["n"]) for r in counted(clean, "text", "n").collect()}
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == docs.columns and set(copies.values()) <= {1, 2}
    sums, taken = Counter(), Counter()
    for k, (s, n) in size.items():
        sums[s] += n
        taken[s] += n * copies[k]
    for s, target in want_targets(dict(sums)).items():
        assert abs(taken[s] - target) <= max(n for x, n in size.values() if x == s)

    rows = [(r["doc_id"], r["text"]) for r in mixed.collect()]
    got = C.token_output(spark, mixed, tables).collect()
    want = [w[:4] for w in want_rows(rows)]
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got), key=lambda r: r[1]) == want


def test_stages_on_odd_rows(spark, odd, tables):
    """Nulls, repeated rows, and extra columns with names that stages use themselves."""
    extra = ["row", "size", "copies", "quality", "target", "key", "fp", "words"]
    docs = odd.select("*", *[F.lit(i).alias(c) for i, c in enumerate(extra)])
    for _, stage in C.STAGES[:-1]:
        after = stage(spark, docs, tables)
        assert after.columns == docs.columns
        assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in docs.collect()}
    assert C.near_dedup(spark, docs, tables).where("doc_id = 7").count() == 1
    assert C.near_dedup(spark, docs, tables).where("doc_id is null").count() == 1
    assert C.quality_rules(spark, docs, tables).where("text is null").count() == 0
    assert C.decontamination(spark, docs, tables).count() == docs.count()
    assert C.token_output(spark, docs, tables).count() == docs.count()


def test_near_dedup_keeps_unlike_texts_of_one_name(spark, odd, tables):
    """Repeated and missing names: a text that is a copy of nothing stays, of equal rows one."""
    rows = [(1, prose(1, 60)), (1, prose(2, 60)), (1, prose(2, 60)), (2, prose(1, 60)), (None, prose(3, 60)), (None, prose(4, 60))]
    rows += [(None, prose(1, 60)), (None, prose(4, 60))]
    docs = spark.createDataFrame([(k, t, "en", "a", 1) for k, t in rows], odd.schema)
    got = [(r["doc_id"], r["text"]) for r in C.near_dedup(spark, docs, tables).collect()]
    assert Counter(got) == Counter([(1, prose(1, 60)), (1, prose(2, 60)), (None, prose(3, 60)), (None, prose(4, 60))])


def test_stages_on_nothing(spark, no_docs, tables):
    for _, stage in C.STAGES:
        assert stage(spark, no_docs, tables).count() == 0
