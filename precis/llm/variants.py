"""Groups of spelling variants: near words by a variable-length gram index.

Grams of two and more characters that many words hold make up the dictionary's inner
nodes; a gram that is one of them takes the next character too, so frequent beginnings
are told apart by longer grams. A word is cut into one such gram for each place. As a
gram depends on its own characters only, one edit spoils at most as many of a word's
grams as overlap one place, a number known for each word: of any one gram more, at
least one is whole, and with it all of the word on one side of it. So only the lists of
these grams, the most central of the word, are merged with those of all grams of other
words, each list divided by what stands before the gram and by what stands behind it.
Words of a list too long for that meet once more under what stands on both sides of an
edit, where a list has at most one word for each letter and one more. What meets is
verified.

One word's grams are at most half as long as the shorter word of a pair, so words of
length n are cut for pairs of length n and n + 1, and once more for n - 1 and n.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.words import mapped
from precis.session import ship_package, stage_table

# Runs of a-z and of U+00C0 to U+00FF, which are two bytes from C3 80 on, in text whose A-Z are folded.
_RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")

MIN_GRAM, MAX_GRAM = 2, 8
# A gram in more than one of so many words is an inner node, so there are at most this times the mean length for each size.
NODES = 1000
# Shorter words may have no gram that an edit leaves whole.
SHORTEST = 4
# From so many characters on a hash stands for a word in the lists.
CARRIED = 64
# Lists of more entries are divided further.
LIST_ROWS = 100
# Distinct words a task holds before it passes its counts on.
_COUNTED = 200_000

_PROBE, _INDEX = 1, 2


def word_counts(df: DataFrame, key: str, text: str, drop_every: int = 0) -> DataFrame:
    """``(word, n)``: how often each run of letters occurs, A-Z folded; a null text has none.

    With ``drop_every`` a run loses one character in texts where crc32 of ``key:run``
    is a multiple of it, the one at that crc32 modulo the run's length.
    """
    ship_package(df.sparkSession)

    def count(batches):
        total: Counter[bytes] = Counter()
        for batch in batches:
            for name, value in zip(*batch.columns, strict=True):
                found = Counter(_RUN.findall((value.as_py() or "").encode().lower()))
                if drop_every:
                    found = _shortened(found, zlib.crc32(f"{name.as_py()}:".encode()), drop_every)
                total.update(found)
                if len(total) >= _COUNTED:
                    yield _counts(total)
                    total.clear()
        yield _counts(total)

    named = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name")
    counts = df.select(named, F.col(text).alias("text")).mapInArrow(count, "word string, n long")
    return counts.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))


def _shortened(found: Counter[bytes], before: int, every: int) -> Counter[bytes]:
    out: Counter[bytes] = Counter()
    for run, n in found.items():
        h = zlib.crc32(run, before)
        if h % every == 0:
            letters = run.decode()
            at = h % len(letters)
            run = (letters[:at] + letters[at + 1 :]).encode()
        out[run] += n
    return out


def _counts(total: Counter[bytes]) -> pa.RecordBatch:
    words = pa.array(list(total), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])


def gram_nodes(words: DataFrame) -> frozenset[str]:
    """The inner nodes of the gram dictionary: grams that more than one word in ``NODES`` holds, repeats counted."""
    sizes = F.filter(F.sequence(F.lit(MIN_GRAM), F.lit(MAX_GRAM - 1)), lambda q: q <= F.length("word"))
    grams = F.transform(
        sizes,
        lambda q: F.transform(
            F.sequence(F.lit(1), F.length("word") - q + 1), lambda p: F.col("word").substr(p, q)
        ),
    )
    least = words.count() / NODES
    counted = words.select(F.explode(F.flatten(grams)).alias("gram")).groupBy("gram").count()
    return frozenset(r["gram"] for r in counted.where(F.col("count") > least).select("gram").collect())


def gram_lengths(word: str, longest: int, nodes: frozenset[str]) -> list[int]:
    """The length of the gram at each place where one begins."""
    out = []
    for p in range(len(word) - MIN_GRAM + 1):
        q = MIN_GRAM
        while q < longest and p + q < len(word) and word[p : p + q] in nodes:
            q += 1
        out.append(q)
    return out


def most_affected(word: str, lengths: list[int], longest: int, nodes: frozenset[str]) -> int:
    """How many of the grams one edit can change at most.

    A character replaced or removed changes the grams it lies in, and one put between
    two others fewer. One put at the end lengthens grams that only the end cut short.
    """
    turns = [0] * (len(word) + 1)
    at_end = 0
    for p, q in enumerate(lengths):
        turns[p] += 1
        turns[p + q] -= 1
        at_end += p + q == len(word) and q < longest and word[p:] in nodes
    inside = most = 0
    for turn in turns:
        inside += turn
        most = max(most, inside)
    return max(most, at_end)


def _sides(word: str) -> tuple[list[int], list[int]]:
    """crc32 of each beginning of the word, by its length, and of what stands from each place on."""
    before, after = [0], [0]
    for c in word:
        before.append(zlib.crc32(c.encode(), before[-1]))
    for c in reversed(word):
        after.append(zlib.crc32(c.encode(), after[-1]))
    return before, after[::-1]


def gram_entries(word: str, nodes: frozenset[str]) -> list[tuple[int, int]]:
    """``(list, role)`` of a word: all its grams as entries, its central ones as probes too."""
    n = len(word)
    before, after = _sides(word)
    out = []
    for shorter in (n, n - 1):
        longest = max(MIN_GRAM, min(shorter // 2, MAX_GRAM))
        lengths = gram_lengths(word, longest, nodes)
        need = most_affected(word, lengths, longest, nodes) + 1
        central = sorted(range(len(lengths)), key=lambda p: (-min(p + lengths[p], n - p), p))
        probes = set(central[:need])
        for p, q in enumerate(lengths):
            role = _INDEX * (shorter == n) | _PROBE * (p in probes)
            if role:
                out.append(((before[p + q] << 28) + 2 * shorter, role))
                out.append(((after[p] << 28) + 2 * shorter + 1, role))
    return out


def edit_entries(word: str) -> list[tuple[int, int]]:
    """``(list, role)`` of a word by what stands on both sides of each edit."""
    n = len(word)
    before, after = _sides(word)
    out = []
    for i in range(n + 1):
        for role, left, behind in ((_PROBE | _INDEX, n - 1, i + 1), (_INDEX, n, i)):
            if behind <= n:
                both = ((before[i] << 32) | after[behind]) * 0x9E3779B97F4A7C15 + (left << 20) + i
                out.append(((both ^ (both >> 61)) & ((1 << 63) - 1), role))
    return out


def _entries(named: DataFrame, entries) -> DataFrame:
    """``(list, name, role)`` of ``(word, name)``."""

    def run(batch):
        lists, roles, places = [], [], []
        for i, word in enumerate(batch.column(0).to_pylist()):
            for key, role in entries(word):
                lists.append(key)
                roles.append(role)
                places.append(i)
        names = batch.column(1).take(pa.array(places, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(lists, pa.int64()), names, pa.array(roles, pa.int32())], names=["list", "name", "role"]
        )

    return mapped(named.select("word", "name"), run, "list long, name string, role int")


def _met(entries: DataFrame) -> DataFrame:
    """``(p, q)`` of different names that meet as probe and entry in a list of bounded length."""
    has = lambda role: F.col("role").bitwiseAND(role) > 0
    lists = entries.groupBy("list").agg(
        F.collect_list(F.when(has(_PROBE), F.col("name"))).alias("probes"),
        F.collect_list(F.when(has(_INDEX), F.col("name"))).alias("indexed"),
    )
    return (
        lists.where("size(probes) > 0 and size(indexed) > 0")
        .select(F.explode("probes").alias("p"), "indexed")
        .select("p", F.explode("indexed").alias("q"))
        .where("p <> q")
    )


def _candidates(named: DataFrame, nodes: frozenset[str]) -> DataFrame:
    """``(p, q)``, repeats among them, of the names of all words that may differ by one edit."""
    entries = stage_table(_entries(named, lambda w: gram_entries(w, nodes)), "gram-lists")
    long = entries.groupBy("list").count().where(F.col("count") > LIST_ROWS).select("list")
    long = stage_table(long, "long-lists")
    crowded = named.join(entries.join(long, "list", "left_semi").select("name").distinct(), "name", "left_semi")
    first = _met(entries.join(long, "list", "left_anti"))
    return first.unionByName(_met(_entries(crowded, edit_entries)))


def _verified(pairs: DataFrame, p: str, q: str) -> DataFrame:
    found = pairs.where(F.levenshtein(p, q, 1) == 1)
    return found.select(F.least(p, q).alias("a"), F.greatest(p, q).alias("b")).distinct()


def near_pairs(words: DataFrame) -> DataFrame:
    """Every pair ``(a, b)``, a before b, of the distinct ``word`` of a staged table that differ by one edit.

    Words of up to ``CARRIED`` characters stand in the lists themselves and are verified
    where they meet; from that length on a hash stands for the word.
    """
    nodes = gram_nodes(words)
    carried = words.where(F.length("word") <= CARRIED).select("word", F.col("word").alias("name"))
    pairs = _verified(_candidates(carried, nodes), "p", "q")
    hashed = words.where(F.length("word") >= CARRIED).select("word", F.hex(F.xxhash64("word")).alias("name"))
    if hashed.isEmpty():
        return pairs
    met = _candidates(stage_table(hashed, "long-words"), nodes).distinct()
    for c in ("p", "q"):
        met = met.join(hashed.select(F.col("name").alias(c), F.col("word").alias(f"{c}_word")), c)
    return pairs.unionByName(_verified(met, "p_word", "q_word")).distinct()


def grouped(words: DataFrame, times: int = 5) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for a staged table of distinct words and their counts ``n``.

    ``form`` is the near word with the largest count (ties: the first by code points) if
    that is at least ``times`` the word's own, else null. ``root`` follows forms to the last.
    """
    pairs = stage_table(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"))
    )
    known = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = (
        both.join(known, "other")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    )
    chosen = F.when(-F.col("best.less") >= times * F.col("n"), F.col("best"))
    table = words.join(best, "word", "left").select(
        "word",
        chosen["other"].alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        (-chosen["less"]).alias("form_n"),
    )
    table = stage_table(table, "forms")
    return table.join(_roots(table.where("form is not null").select("word", "form")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(links: DataFrame) -> DataFrame:
    """``(word, root)``: the last word of each chain. Counts grow along a chain, so it ends; steps double each round."""
    now = stage_table(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = now.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        after = stage_table(after, "roots")
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def variants(
    df: DataFrame, key: str, text: str, min_length: int = 6, min_count: int = 5, times: int = 5, drop_every: int = 0
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of all texts: see ``word_counts`` and ``grouped``.

    Words have at least ``min_length`` characters, 4 at least, and occur ``min_count`` times
    over all rows, repeated rows and keys counted as often as they stand there. Null and empty
    texts have no words, a null key is an empty name, an empty table gives an empty result,
    and other columns don't matter. Only grams of the dictionary reach the driver.
    """
    if min_length < SHORTEST:
        raise ValueError(f"words of at least {SHORTEST} characters")
    counts = word_counts(df, key, text, drop_every)
    words = counts.where((F.length("word") >= min_length) & (F.col("n") >= min_count))
    return grouped(stage_table(words, "words"), times)
