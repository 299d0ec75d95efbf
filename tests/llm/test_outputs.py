"""Token files, mixing, URL rules and conversations against plain versions."""

import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from precis.llm import chat, mixing, oracles, token_files, url_filter
from precis.llm.words import counted
from precis.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


# Token files


@pytest.fixture(scope="module")
def encoder():
    return token_files.Encoder(PATH)


SIGNS = [" ", " ", "\n", "\t", "a", "b", "é", "1", "!", ".", "s", "%%", "'s", "'", "²", "ª", "<|endoftext|>", "\u3000", "中", "\0", "\x1c", "\x85"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SIGNS), max_size=12).map("".join), max_size=8))
def test_pieces_give_the_tokenizers_ids(encoder, texts):
    assert encoder.encode(texts) == encoder._whole(texts)


def test_any_text(encoder):
    rng = random.Random(1)
    texts = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x250), 32])) for _ in range(40)) for _ in range(500)]
    assert encoder.encode(texts) == encoder._whole(texts)


class Counted:
    """A tokenizer that notes the texts it is given."""

    def __init__(self, inner):
        self.inner, self.texts = inner, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.inner.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("words", [50_000, 7])
def test_the_model_sees_each_new_word_once_in_few_calls(monkeypatch, words):
    monkeypatch.setattr(token_files, "_WORDS", words)
    encoder, rng = token_files.Encoder(PATH), random.Random(2)
    known = ["".join(rng.choices("abcdé", k=9)) for _ in range(200)]
    texts = [" ".join(w + rng.choice(["", ".", "%%%", ".\nOf", "中"]) for w in rng.choices(known, k=50)) for _ in range(100)]
    encoder._model = model = Counted(encoder._model)
    assert encoder.encode(texts) == encoder._whole(texts)
    seen = " ".join(model.texts).split(" ")
    assert len(seen) == len(set(seen)) and len(model.texts) == -(-len(seen) // words)


def test_a_model_without_some_byte(encoder, monkeypatch):
    texts = ["a bc def bc", "", "x"]
    want = encoder.encode(texts)
    monkeypatch.setattr(encoder, "_lengths", np.zeros_like(encoder._lengths))
    assert encoder.encode(texts) == want == encoder._whole(texts)


def want_rows(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_token_files_round_trip(spark, odd):
    path = scratch_path(spark, "tokens")
    manifest = token_files.write_token_files(odd, "doc_id", "text", path, PATH, 2)
    assert token_files.read_manifest(path) == manifest
    got = token_files.read_token_files(spark, path, with_ids=True).collect()
    want = want_rows([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert sorted(((r["key"], r["start"], r["n_tokens"], r["ids_crc32"], r["ids"]) for r in got), key=lambda r: r[1]) == want
    some = token_files.read_token_files(spark, path, only=[3, 12, 99]).collect()
    assert sorted(r["key"] for r in some) == [3, 12]
    assert {(r["key"], r["start"]) for r in some} == {w[:2] for w in want if w[0] in (3, 12)}


def test_token_files_of_nothing(spark, no_docs):
    path = scratch_path(spark, "tokens")
    assert token_files.write_token_files(no_docs, "doc_id", "text", path, PATH, 2) == []
    assert token_files.read_token_files(spark, path).collect() == []


def test_frames_are_read_alone_and_checked():
    sink = pa.BufferOutputStream()
    writer = token_files.FrameWriter(sink)
    contents = [np.arange(n, dtype="<u4").tobytes() for n in (0, 1, 5, 70_000)]
    for i, content in enumerate(contents):
        writer.add(None if i == 1 else -i, content)
    writer.finish()
    whole = sink.getvalue().to_pybytes()
    reader = token_files.FrameReader(pa.BufferReader(whole))
    assert [reader.document(i) for i in range(4)] == contents and reader.keys == [0, None, -2, -3]
    # Every frame but the third is destroyed, which the third does not notice.
    broken = bytearray(whole)
    a, b = reader._bounds[2], reader._bounds[3]
    broken[:a] = bytes(a)
    broken[b : reader._bounds[4]] = bytes(reader._bounds[4] - b)
    hurt = token_files.FrameReader(pa.BufferReader(bytes(broken)))
    assert hurt.document(2) == contents[2]
    with pytest.raises(Exception):  # noqa: B017
        hurt.document(3)
    swapped = bytearray(whole)
    at = whole.index(reader.checks[2].astype("<u4").tobytes(), reader._bounds[4])
    swapped[at] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        token_files.FrameReader(pa.BufferReader(bytes(swapped))).document(2)
    import zstandard

    assert zstandard.ZstdDecompressor().decompress(whole, max_output_size=1 << 20) == contents[0]


# Mixing


def want_targets(sizes):
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    full = set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        share = sum(weight[s] for s in sizes if s not in full) or 1
        new = {s for s in sizes if s not in full and left * weight[s] / share >= 2 * sizes[s]}
        if not new:
            return {s: 2.0 * sizes[s] if s in full else left * weight[s] / share for s in sizes}
        full |= new


def test_mix_against_targets(spark):
    rng = random.Random(3)
    names = [None, "z", "é", "Z", "a", "hot", "b"]
    rows = [(i, "hot" if i % 3 == 0 else rng.choice(names), rng.choice([0, 1, 5, 40, 100, 300])) for i in range(2400)]
    df = spark.createDataFrame(rows, "k long, source string, size long").withColumn("target", F.lit("x"))
    got = mixing.mixed(df, "k", "size", "source").collect()
    again = mixing.mixed(df.repartition(5), "k", "size", "source").collect()
    assert sorted((r["k"], r["copies"]) for r in got) == sorted((r["k"], r["copies"]) for r in again)
    assert len(got) == len(rows) and {r["copies"] for r in got} <= {0, 1, 2}
    sizes = {s: sum(n for _, x, n in rows if x == s) for s in names}
    want = want_targets(sizes)
    for s in names:
        own = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in own} == {sizes[s]}
        assert {round(r["target"], 4) for r in own} == {round(want[s], 4)}
        assert abs(sum(r["size"] * r["copies"] for r in own) - want[s]) <= max(300, 0.02 * want[s])
    assert all(r["copies"] == 1 for r in got if r["size"] == 0)


def test_multipliers_solve_the_dual(spark):
    rng = random.Random(4)
    rows = [(i, "ab"[i % 2], rng.randint(1, 200)) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, source string, size long")
    goals = mixing.source_sizes(df.select("source", "size")).withColumn("target", F.col("source_size") * 0.6)
    for r in mixing.multipliers(df, goals).collect():
        rates = [(n, min(2.0, np.exp(r["multiplier"] * n / r["mean"]))) for _, s, n in rows if s == r["source"]]
        assert sum(n * x for n, x in rates) == pytest.approx(r["target"], rel=1e-6)
        assert r["multiplier"] < 0


def test_mix_of_odd_rows(spark, odd, no_docs):
    sized = counted(odd, "text", "size")
    got = mixing.mixed(sized, "doc_id", "size", "source").collect()
    assert len(got) == odd.count() and all(r["copies"] in (0, 1, 2) for r in got)
    assert len({r["copies"] for r in got if r["doc_id"] == 7}) == 1
    assert mixing.mixed(counted(no_docs, "text", "size"), "doc_id", "size", "source").collect() == []
    nothing = sized.where("size = 0")
    assert {r["copies"] for r in mixing.mixed(nothing, "doc_id", "size", "source").collect()} == {1}


# URL rules


def glob_regex(pattern):
    parts = re.split(r"(\*\*|\*)", pattern)
    return re.compile("".join({"**": ".*", "*": "[^/]*"}.get(p, re.escape(p)) for p in parts), re.S)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.text("ab/*é", max_size=6), min_size=1, max_size=30),
    st.lists(st.text("ab/é", max_size=9), min_size=1, max_size=6),
)
def test_automaton_against_regular_expressions(patterns, texts):
    patterns = [re.sub(r"\*{3,}", "**", p) for p in patterns]
    automaton = url_filter.Automaton([url_filter.Glob(p, p, "block", 0) for p in patterns])
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(t) for t in data])
    lengths = np.array([len(t) for t in data])
    got = automaton.run(np.frombuffer(b"".join(data) + b"\0", np.uint8), ends - lengths, lengths)
    want = [[bool(glob_regex(p).fullmatch(t)) for p in patterns] for t in texts]
    assert got.tolist() == want


URLS = [
    None, "", "no scheme", "http://", "HTTP://Example.COM/en/x", "http://example.com/en", "http://www.example.com/en/a",
    "http://a.www.example.com/en/", "http://com/", "http://com", "http://xcom/", "http://x.net/es/1?q=/fr/", "http://net/fr/",
    "http://evil.org/a.com/b", "http://casino.org", "http://x.org/casino", "http://é.com/", "a://b://c.com/x", "http://x.com?y/z",
    "http://my-casino-win.net/es/2", "http://X.net/ES/3", "http://x.com#/a", "http://x.com/" + "p" * 5000,
    "http://x.com/a\nb",
]


def test_url_rules_against_sql(spark):
    from precis.llm.queries import ORACLES, QUERIES, SITES, SPAM_WORDS

    rows = [(i, u) for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    globs = url_filter.site_globs(SITES) + url_filter.word_globs(SPAM_WORDS)
    got = url_filter.filtered(pages, "page_id", "url", globs).collect()
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": [r[0] for r in rows], "url": [r[1] for r in rows]}))
    want = con.execute(ORACLES["op8_url_filter"]).fetchall()
    sites = {r for _, r in SITES}
    mine = [(r["key"], r["host"], r["path"], r["rule"] if r["rule"] in sites else None, r["verdict"]) for r in got]
    assert sorted(mine) == sorted(want) and "op8_url_filter" in QUERIES
    assert url_filter.filtered(pages.limit(0), "page_id", "url", globs).collect() == []
    assert {r["verdict"] for r in url_filter.filtered(pages, "page_id", "url", []).collect()} == {"allow"}


# Conversations


def talk():
    first = "Shall we meet at the old bridge?\nBring the two maps.\nOr only one map then."
    rows = [
        (1, 0, "user", first),
        (1, 1, "assistant", "Yes, I will bring both of them.\nAnd some bread."),
        (1, 2, "user", "> Shall we meet  at the OLD bridge?\n> Bring the two maps.\n> Or only one map then.\n\nAgain to my own words."),
        (1, 3, "assistant", ">> Bring the two maps.\n> Yes, I will bring both of them.\n> And some bread.\nThanks for the bread."),
        (1, 4, "user", "> never said by anyone here\nHm."),
        (1, 5, "user", "> And some\n> bread. Yes, I will bring both\nrewrapped"),
        (1, 6, "user", "> > Shall we meet at the old bridge?\ndeep only"),
        (1, 7, "user", ">\n> \nempty quote"),
        (2, 0, "user", "no quotes <|user|> here"),
        (2, None, None, None),
        (2, 1, "user", "a > b"),
        (3, 5, "user", "> Shall we meet at the old bridge?\nother conversation"),
        (3, 5, "user", "twice the same turn"),
    ]
    rng = random.Random(6)
    for c in range(10, 22):
        said = []
        for t in range(rng.randrange(1, 14)):
            own = " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(3, 9)))
            lines = []
            for _ in range(rng.randrange(0, 3) if said else 0):
                lines.append(">" * rng.randrange(1, 3) + " " + rng.choice(said))
            said.append(own)
            rows.append((c, t, rng.choice(["user", "assistant"]), "\n".join([*lines, own])))
    return rows


def test_conversations_against_sql(spark):
    rows = talk()
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema).repartition(4)
    got = chat.reply_ordered(df, "conv_id", "turn", "role", "text").collect()
    con = duckdb.connect()
    names = ("conv_id", "turn", "role", "text")
    con.register("conversations", pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)}))
    want = con.execute(oracles.QUOTATION_LINKING).fetchall()
    order = lambda rows: sorted(rows, key=str)
    steady = lambda r: r[0] != 3  # noqa: E731  turns of equal rank follow a hash that SQL does not have
    assert order(filter(steady, (tuple(r) for r in got))) == order(filter(steady, want))
    threads = {(r["conv"], r["position"], r["reply_to"]) for r in got}
    assert all(b is None or b < a for _, a, b in threads)
    assert any(b is not None and b != a - 1 for _, a, b in threads)
    by_turn = {r["turn"]: r for r in got if r["conv"] == 1}
    place = {t: r["position"] for t, r in by_turn.items()}
    assert by_turn[2]["reply_to"] == place[0] and by_turn[3]["reply_to"] == place[1] and by_turn[6]["reply_to"] == place[0]
    assert by_turn[3]["text"] == "<|assistant|>\nThanks for the bread.<|end|>\n"
    assert any("no quotes < |user|> here" in r["text"] for r in got)


def test_messages_without_a_conversation(spark):
    schema = "conv_id long, turn long, role string, text string, position string"
    df = spark.createDataFrame([(None, 1, "user", "> x y z\na", "p"), (None, 1, "user", "b", "p")], schema)
    got = chat.reply_ordered(df, "conv_id", "turn", "role", "text").collect()
    assert sorted((r["position"], r["reply_to"], r["n_quotes"], r["text"]) for r in got) == [
        (0, None, 0, "<|user|>\nb<|end|>\n"), (0, None, 2, "<|user|>\na<|end|>\n"),
    ]
    assert chat.reply_ordered(df.limit(0), "conv_id", "turn", "role", "text").collect() == []
