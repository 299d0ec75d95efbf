"""The piece encoder against the sentencepiece library and against plain merging."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from precis.llm import pieces
from precis.llm.queries import PIECES, QUERIES

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path(PIECES)


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PATH)


def random_texts(library, n, seed):
    rng = random.Random(seed)
    known = [library.id_to_piece(i) for i in range(259, library.get_piece_size())]
    letters = ["a", "b", "e", "n", "t", "h", "▁", " ", "  ", "\n", "0", "é", "日", "\U0001f600", "<0x0A>", "<s>", "\x00"]
    for i in range(n):
        if i % 4 == 0:
            yield "".join(rng.choice(known) for _ in range(rng.randint(0, 12)))
        elif i % 4 == 1:
            yield "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        elif i % 4 == 2:
            yield " " * rng.randint(0, 40) + rng.choice(known) + " " * rng.randint(0, 20)
        else:
            points = (rng.randint(1, rng.choice([0x7F, 0x2FF, 0xFFFF, 0x10FFFF])) for _ in range(20))
            yield "".join(chr(c) for c in points if not 0xD800 <= c < 0xE000)


def test_equals_the_library(library):
    model = pieces.model(PATH)
    texts = list(random_texts(library, 8000, 1)) + ["ab" * 20_000, "日本語" * 5_000, " " * 5_000]
    for text in texts:
        ids = model.encode(text)
        assert ids == library.encode(text), text[:100]
        assert model.decode(ids) == library.decode(ids)


def test_split_is_what_the_merges_give(library):
    model = pieces.model(PATH)
    for text in random_texts(library, 2000, 2):
        word = library.normalize(text)[:40]
        if word:
            assert model.split(word) == model.merged(word)


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 3)
    monkeypatch.setattr(pieces, "CACHE_PAIRS", 3)
    model = pieces.PieceModel(PATH)
    for text in random_texts(library, 400, 3):
        assert model.encode(text) == library.encode(text)


def test_failed_places_keep_the_search_linear():
    """Each place is left for good at most once, so fits is asked a bounded number of times for each character."""
    model = pieces.PieceModel(PATH)
    asked = []
    real = model.fits
    model.fits = lambda a, b: asked.append(1) or real(a, b)
    model._fit = {}
    model.split("the" * 5000 + "q" * 5000)
    assert len(asked) < 20 * 20_000


def test_odd_rows(spark, odd, library):
    docs = odd.withColumns({"key": F.lit(1), "ids": F.lit(2), "decoded": F.lit(3)})
    got = pieces.encoded(docs, "doc_id", "text", PATH, decode=True)
    want = [(r["doc_id"], library.encode(r["text"] or "") + [2], r["text"] or "") for r in docs.collect()]
    want = [(k, ids, library.decode(ids)) for k, ids, _ in want]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)
    assert got.columns == ["key", "ids", "decoded"]
    plain = pieces.encoded(docs, "doc_id", "text", PATH, add_end=False)
    assert plain.where("key = 5").first()["ids"] == [] and plain.where("key = 4").first()["ids"] == []


def test_small_parts_keep_every_row(spark, odd, monkeypatch):
    from precis.llm.words import mapped

    monkeypatch.setattr(pieces, "PART_IDS", 10)
    monkeypatch.setattr(pieces, "mapped", lambda df, fn, schema: mapped(df.coalesce(1), fn, schema))
    assert pieces.encoded(odd, "doc_id", "text", PATH).count() == odd.count()


def test_decoded(spark):
    rows = spark.createDataFrame([(1, [264, 287, 2]), (2, []), (3, None), (3, None)], "k int, ids array<int>")
    got = pieces.decoded(rows, "k", "ids", PATH)
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a b"), (2, ""), (3, None), (3, None)]


def test_nothing(spark, no_docs):
    got = pieces.encoded(no_docs, "doc_id", "text", PATH, decode=True)
    assert got.count() == 0 and got.columns == ["key", "ids", "decoded"]


def test_query(spark, tables, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_piece_encoding"](spark, tables).collect()}
    docs = spark.read.parquet(f"{tables}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r["text"] or "", add_eos=True)
        listed = " ".join(map(str, ids))
        want = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, library.decode(ids))]
        assert got[r["doc_id"]] == (len(ids), *want)
