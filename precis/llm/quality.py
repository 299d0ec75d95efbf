"""Quality rules combined by weak supervision, in DataFrame functions only.

Each rule looks at one measure of a text and votes good, bad, or abstains between its
two limits. Expectation-maximisation estimates, without labels, how often each rule
votes right on good and on bad texts, and the share of good texts; a text's
posterior probability of being good then decides, in place of "all rules must pass".
The estimation runs on the counts of vote patterns, at most 3 to the number of rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.session import stage_table

WINDOW = 5
BASE_WORDS = 10
BASE_REPEATS = 20  # percent of the words

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_other", "n_lines",
)

_GAP = r"[\x20\x09-\x0D]"
_NO_GAP = r"[^\x20\x09-\x0D]"


class Rule(NamedTuple):
    """Good from ``good`` on, bad from ``bad`` on, in the direction from good to bad."""

    name: str
    measure: str  # SQL over the columns of ``measures``
    good: float
    bad: float


# The rules' limits lie apart, so that each abstains where texts of both kinds are found.
RULES = (
    Rule("length", "n_words", 30, 9),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", 0.02, 0.2),
    Rule("word_length_high", "word_chars / greatest(n_words, 1)", 9, 14),
    Rule("word_length_low", "word_chars / greatest(n_words, 1)", 3, 1.5),
    Rule("capitals", "n_capitals / greatest(word_chars, 1)", 0.15, 0.5),
    Rule("other_signs", "n_other / greatest(word_chars, 1)", 0.08, 0.25),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", 0.1, 0.5),
    Rule("repeated_words", "n_repeat_words / greatest(n_words, 1)", 0.05, 0.2),
)

THRESHOLD = 0.5
MAX_STEPS = 20
TOLERANCE = 1e-4


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words of an array stand in windows that are found twice or more.

    Windows are hashed and sorted with their places; each repeated one covers the
    words up to the next repeated one, ``window`` at most. Arrays without a repeated
    window, the rule, are not sorted. Linear but for the sort, whatever the length.
    """

    def windows(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (window - 1), F.lit(0)))
        return F.transform(starts, lambda _, i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))

    def covered(places: Column) -> Column:
        gaps = F.transform(
            places, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(places, i + 1) - p, F.lit(window)))
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(sorted_: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            before, after = F.get(sorted_, i - 1)["h"], F.get(sorted_, i + 1)["h"]
            return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

        return F.array_sort(F.transform(F.filter(sorted_, twice), lambda x: x["p"]))

    def count(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        found = _let(_let(F.array_sort(placed), repeated), covered)
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), found).otherwise(F.lit(0).cast("long"))

    return _let(_let(words, windows), count)


def _found(text: Column, signs: str) -> Column:
    """How many characters of a class a text has."""
    return (F.size(F.split(text, signs)) - 1).cast("long")


def _once(df: DataFrame, *columns: Column) -> DataFrame:
    """``df`` with further columns that are computed once, however often later steps name them.

    A generator over one row, as the optimizer would merge plain projections and
    repeat the columns' expressions wherever they are used.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def measures(rows: DataFrame) -> DataFrame:
    """``row`` and the measures of ``text``, for rows ``(row, text)``; a null text is empty."""
    own = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(own, f"{_GAP}+"), lambda w: w != "")
    lines = F.filter(F.split(own, "\n"), lambda x: x.rlike(_NO_GAP))
    both = _let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    cut = _once(rows, own.alias("own"), words.alias("words"), both.alias("lines"))
    return _once(
        cut.select("row", "own", "words", "lines"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _found(F.col("own"), r"[#*$%&|<>]").alias("n_symbols"),
        (F.col("lines.n") - F.col("lines.d")).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        _found(F.col("own"), r"\p{Lu}").alias("n_capitals"),
        _found(F.col("own"), r"[^\p{L}\s]").alias("n_other"),
        F.col("lines.n").cast("long").alias("n_lines"),
    ).select("row", *MEASURES)


def base_failed() -> Column:
    """The plain rule over the columns of ``measures``, for any text that holds too little or repeats itself."""
    return (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEATS * F.col("n_words"))


def votes(rules: Sequence[Rule]) -> dict[str, Column]:
    """Each rule's vote over the columns of ``measures``: 1 good, -1 bad, 0 abstains."""
    out = {}
    for r in rules:
        x, rising = F.expr(r.measure), r.bad > r.good
        good = x <= r.good if rising else x >= r.good
        bad = x >= r.bad if rising else x <= r.bad
        out[r.name] = F.when(good, 1).when(bad, -1).otherwise(0)
    return out


class Estimate(NamedTuple):
    """What expectation-maximisation found."""

    share: float  # of good texts
    good: dict[str, float]  # of a rule's votes on good texts, how many are good
    bad: dict[str, float]  # of a rule's votes on bad texts, how many are bad


def posterior(estimate: Estimate) -> Column:
    """Probability that a text is good, over its votes."""
    odds = F.lit(estimate.share / (1 - estimate.share))
    for name, good in estimate.good.items():
        bad = estimate.bad[name]
        odds = odds * F.when(F.col(name) > 0, good / (1 - bad)).when(F.col(name) < 0, (1 - good) / bad).otherwise(1.0)
    return odds / (1 + odds)


def _free(df: DataFrame) -> str:
    name = "quality"
    while name in df.columns:
        name += "_"
    return name


def estimate(patterns: DataFrame, names: Sequence[str]) -> Estimate:
    """Fit to vote patterns (a column for each rule, and their number ``n``).

    Begins with texts on which any rule votes bad as bad, and ends when no
    estimate moves by more than a ten-thousandth. One vote of each sort counts
    beforehand for each rule and class, and a rule is never taken to be worse than
    chance. Without texts everything is even.
    """
    any_bad = F.greatest(*[F.when(F.col(v) < 0, 1).otherwise(0) for v in names]) > 0
    good = F.when(any_bad, 0.05).otherwise(0.95)
    last, now = None, None
    for _ in range(MAX_STEPS):
        weighed = patterns.withColumn("_good", good)
        sums = [F.sum(F.col("n") * F.col("_good")), F.sum("n")]
        for v in names:
            for vote in (1, -1):
                voted = F.when(F.sign(F.col(v)) == vote, F.col("n")).otherwise(0)
                sums += [F.sum(voted * F.col("_good")), F.sum(voted * (1 - F.col("_good")))]
        row = [float(x or 0) for x in weighed.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()]
        share = (row[0] + 1) / (row[1] + 2)
        in_good, in_bad = {}, {}
        for i, v in enumerate(names):
            up_good, up_bad, down_good, down_bad = row[2 + 4 * i : 6 + 4 * i]
            right = (up_good + 1) / (up_good + down_good + 2)
            caught = (down_bad + 1) / (up_bad + down_bad + 2)
            in_good[v], in_bad[v] = right, max(caught, 1 - right)
        now = Estimate(share, in_good, in_bad)
        flat = [share, *in_good.values(), *in_bad.values()]
        if last is not None and max(abs(a - b) for a, b in zip(flat, last, strict=True)) <= TOLERANCE:
            break
        last, good = flat, posterior(now)
    return now


def judged(df: DataFrame, text: str, rules: Sequence[Rule] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``df`` and a struct of measures, ``base_failed``, ``posterior`` and ``kept``.

    The struct is called ``quality``, with underscores behind while ``df`` has such
    a column. ``df`` is read twice, for the estimate and for the verdict: pass a
    table, or one of measures only. A null text is empty and fails the base rule.
    Texts that fail it take no part in the estimate and are not kept; the others
    are kept from a posterior of ``threshold`` on. Repeated rows are judged alike;
    an empty table gives no rows.
    """
    name = _free(df)
    measured = measures(df.select(F.struct(*df.columns).alias("row"), F.col(text).alias("text")))
    return _verdict(measured, _fitted(measured, rules), rules, threshold, name).select("row.*", name)


def _fitted(measured: DataFrame, rules: Sequence[Rule]) -> Estimate:
    own = measured.where(~base_failed()).select(*[v.alias(n) for n, v in votes(rules).items()])
    names = [r.name for r in rules]
    return estimate(stage_table(own.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "votes"), names)


def _verdict(measured: DataFrame, found: Estimate, rules: Sequence[Rule], threshold: float, name: str) -> DataFrame:
    """``row`` and the struct ``name``."""
    voted = _once(measured, *[v.alias(n) for n, v in votes(rules).items()])
    voted = _once(voted, base_failed().alias("base_failed"), posterior(found).alias("posterior"))
    kept = ~F.col("base_failed") & (F.col("posterior") >= threshold)
    return voted.select("row", F.struct(*MEASURES, "base_failed", "posterior", kept.alias("kept")).alias(name))


def verdicts(df: DataFrame, key: str, text: str, rules: Sequence[Rule] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``key``, measures, ``base_failed``, ``posterior`` and ``kept`` of each row; texts are measured once."""
    rows = df.select(F.col(key).alias("row"), F.col(text).alias("text"))
    measured = stage_table(measures(rows), "quality")
    found = _fitted(measured, rules)
    return _verdict(measured, found, rules, threshold, "quality").select(F.col("row").alias("key"), "quality.*")
