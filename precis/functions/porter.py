"""Porter's suffix stripping (Porter 1980, with NLTK's later additions), per token."""

from __future__ import annotations

from functools import lru_cache

# Irregular forms and the suffix tables of the algorithm.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(w: str) -> str:
    """``c`` or ``v`` per letter; ``y`` is a vowel after a consonant."""
    out = ""
    for ch in w:
        vowel = ch in "aeiou" or (ch == "y" and out[-1:] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(w: str) -> int:
    return _shape(w).count("vc")


def _ends_cvc(w: str) -> bool:
    s = _shape(w)
    return (s.endswith("cvc") and w[-1] not in "wxy") or s == "vc"


def _plural(w: str) -> str:
    if w.endswith("ies") and len(w) == 4:
        return w[:-1]
    if w.endswith(("sses", "ies")):
        return w[:-2]
    return w if w.endswith("ss") or not w.endswith("s") else w[:-1]


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    base = next((w[: -len(e)] for e in ("ed", "ing") if w.endswith(e) and "v" in _shape(w[: -len(e)])), None)
    if base is None:
        return w
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if base[-1:] == base[-2:-1] and _shape(base)[-1] == "c":
        return base if base[-1] in "lsz" else base[:-1]
    return base + "e" if _measure(base) == 1 and _ends_cvc(base) else base


def _swap(w: str, table: tuple[tuple[str, str], ...]) -> str:
    for end, new in table:
        if w.endswith(end):
            base = w[: -len(end)]
            return base + new if _measure(base) > 0 else w
    return w


def _double_suffix(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _double_suffix(w[:-2])
    if w.endswith("logi"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    return _swap(w, STEP_2)


def _residue(w: str) -> str:
    for end in STEP_4:
        base = w[: -len(end)]
        if w.endswith(end) and (end != "ion" or base[-1:] in ("s", "t")):
            return base if _measure(base) > 1 else w
    return w


def _final(w: str) -> str:
    if w.endswith("e"):
        base = w[:-1]
        m = _measure(base)
        if m > 1 or (m == 1 and not _ends_cvc(base)):
            w = base
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w


@lru_cache(maxsize=200_000)
def stem(w: str) -> str:
    """The stem of a lower-case token."""
    if w in IRREGULAR:
        return IRREGULAR[w]
    if len(w) <= 2:
        return w
    w = _past(_plural(w))
    if w.endswith("y") and len(w) > 2 and _shape(w)[-2] == "c":
        w = w[:-1] + "i"
    return _final(_residue(_swap(_double_suffix(w), STEP_3)))
