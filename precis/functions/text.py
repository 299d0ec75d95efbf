"""Column functions on text. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip() removes.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Word separators, sentence ends, and tokens.
WORD_GAP = r"[ \t\n\r\f]+"
SENTENCE_END = r"([.!?])[ \t\n\r\f]+"
TOKEN = "[a-z0-9]+"


def strip(c: Column) -> Column:
    """Remove surrounding whitespace as ``str.strip()`` does."""
    return F.btrim(c, F.lit(SPACES))


def is_blank(c: Column) -> Column:
    """NULL, empty, or nothing but (Unicode) whitespace."""
    return c.isNull() | (strip(c) == "")


def tidy(c: Column) -> Column:
    """Remove the space that detokenising leaves before punctuation and contractions."""
    closed = F.regexp_replace(c, r" ([.,!?])", "$1")
    joined = F.regexp_replace(closed, " ' ", "'")
    return F.regexp_replace(joined, " (n't|'m|'s|'ve|'re)", "$1")


def tokens(c: Column) -> Column:
    """Lower-case runs of ``a-z0-9``; everything else separates."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def words(c: Column) -> Column:
    """Whitespace-separated words of a stripped, non-empty text."""
    return F.split(c, WORD_GAP)


def sentences(c: Column) -> Column:
    """Sentences in order: broken at newlines and after ``.``, ``!`` or ``?``."""
    broken = F.regexp_replace(c, SENTENCE_END, "$1\n")
    parts = F.transform(F.split(broken, "\n"), strip)
    return F.filter(F.coalesce(parts, F.array().cast("array<string>")), lambda s: s != "")


def cut_words(c: Column, n: int | Column) -> Column:
    """The text itself, or its first ``n`` words when it has more."""
    return let(
        words(c), lambda w: F.when(F.size(w) > n, F.array_join(F.slice(w, 1, n), " ")).otherwise(c)
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A lambda evaluates the columns it mentions anew for every element, so an
    expression used inside one is bound to a variable first.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def ngrams(toks: Column, n: int) -> Column:
    """Space-joined ``n``-grams; empty when there are fewer than ``n`` tokens."""
    if n == 1:
        return toks

    def of(t: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(t) - (n - 1))
        grams = F.transform(starts, lambda i: F.array_join(F.slice(t, i, n), " "))
        return F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>"))

    return let(toks, of)


def size_text(n_bytes: Column) -> Column:
    """Bytes as ``12 B``, ``3.4 KB``, ``5.6 MB`` or ``7.8 GB`` (steps of 1024)."""
    def scaled(power: int, unit: str) -> Column:
        return F.format_string(f"%.1f {unit}", F.bround(n_bytes / F.lit(float(1024**power)), 1))

    return (
        F.when(n_bytes < 1024, F.concat(n_bytes.cast("string"), F.lit(" B")))
        .when(n_bytes < 1024**2, scaled(1, "KB"))
        .when(n_bytes < 1024**3, scaled(2, "MB"))
        .otherwise(scaled(3, "GB"))
    )


def half_even(c: Column, digits: int = 0) -> Column:
    """Round halves to the even neighbour, as Python's formatting does."""
    return F.bround(c, digits)
