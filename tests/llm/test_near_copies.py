import random

import numpy as np
import pytest

from precis.llm import near_copies as N
from precis.llm.simhash import chains_hold
from tests.llm.conftest import SCHEMA, edited, prose
from tests.llm.test_simhash import brute_components


def shingles(text):
    words = (text or "").lower().split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def brute_copies(texts):
    """The smallest key reached by links of similarity 0.8 or more, for every key."""
    sets = {k: shingles(t) for k, t in texts.items()}
    holders, pairs = {}, set()
    for k, own in sets.items():
        for s in own or {()}:
            holders.setdefault(s, []).append(k)
    for k, own in sets.items():
        for other in {o for s in own or {()} for o in holders[s]}:
            both = len(own & sets[other])
            if k < other and (not own or 5 * both >= 4 * (len(own) + len(sets[other]) - both)):
                pairs.add((k, other))
    return brute_components(list(sets), sorted(pairs))


def components_of(spark, texts, **bounds):
    df = spark.createDataFrame([(k, t, "en", "a", 1) for k, t in texts.items()], SCHEMA).repartition(3)
    return {r["key"]: r["component"] for r in N.near_copies(df, "doc_id", "text", **bounds).collect()}


def family(seed, members, words, edits):
    """Near-copies of one text, each edited at places of its own, on both sides of the threshold."""
    rng, base = random.Random(seed), prose(seed, words)
    return [edited(base, rng.sample(range(words), rng.randint(0, edits))) for _ in range(members)]


def test_families_against_brute_force(spark):
    texts = [t for seed in range(12) for t in family(seed, 8, 60 + 20 * seed, 2 + seed)]
    texts += [None, "", " \t", "one two", "One  two", "one two three four five six"]
    texts = dict(enumerate(texts, 1))
    want = brute_copies(texts)
    assert components_of(spark, texts) == want
    assert 20 < len(set(want.values())) < len(texts)


@pytest.mark.parametrize("bounds", [{"group_rows": 6}, {"group_shingles": 500}])
def test_hot_groups_are_divided_and_lose_nothing(spark, bounds):
    """A passage that many texts share, and a large family of copies, with room for few in a group."""
    passage = prose(99, 60)
    texts = [passage + " " + prose(100 + i, 40) for i in range(40)] + family(3, 40, 120, 3)
    texts += [t + " " + passage for t in family(4, 10, 150, 3)]
    texts = dict(enumerate(texts, 1))
    assert components_of(spark, texts, **bounds) == brute_copies(texts)


def test_chains_keep_all_within_the_radius():
    rng = random.Random(1)
    diffs = [sum(1 << b for b in rng.sample(range(64), rng.randint(0, N.RADIUS))) for _ in range(5000)]
    assert chains_hold(np.array(diffs, np.uint64), N.RADIUS, N.SEGMENTS).all()
    far = [sum(1 << b for b in rng.sample(range(64), 36)) for _ in range(500)]
    assert not chains_hold(np.array(far, np.uint64), N.RADIUS, N.SEGMENTS).any()


def test_odd_rows(spark, odd, no_docs):
    got = [(r["key"], r["component"]) for r in N.near_copies(odd, "doc_id", "text").collect()]
    by_key = dict(got)
    assert len(got) == odd.count() and got.count((7, 7)) == 2 and got.count((None, None)) == 2
    assert by_key[2] == by_key[3] == 1 and by_key[5] == by_key[6] == by_key[4] == 4 and by_key[9] == 8
    assert by_key[10] == 10 and by_key[11] == 11 and by_key[12] == 12
    assert N.near_copies(no_docs, "doc_id", "text").collect() == []
