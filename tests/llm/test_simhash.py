import random

import numpy as np
import pytest
import xxhash

from precis.llm import simhash as S
from precis.llm.components import components


def brute_print(text, size=3):
    words = (text or "").encode().lower().split()
    n = min(size, len(words))
    parts = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if n else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, pairs):
    """Smallest node that each node reaches."""
    name = {n: n for n in nodes}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        name[b] = a
    return {n: root(n) for n in nodes}


def close(prints, radius=3):
    return [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= radius]


def test_against_brute_force(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    prints = [brute_print(t) for _, t in rows]
    name = brute_components(set(prints), close(set(prints)))
    least = {}
    for (key, _), fp in zip(rows, prints, strict=True):
        if key is not None:
            least[name[fp]] = min(key, least.get(name[fp], key))
    want = sorted((str(k), fp, str(least.get(name[fp]))) for (k, _), fp in zip(rows, prints, strict=True))
    got = S.near_duplicates(odd, "doc_id", "text").collect()
    assert sorted((str(r["key"]), r["fp"] % (1 << 64), str(r["component"])) for r in got) == want
    by_key = {r["key"]: r["component"] for r in got}
    assert by_key[2] == 1 and by_key[5] == by_key[4] == by_key[6] == 4 and by_key[8] == by_key[9] == 8


def test_empty(spark, no_docs):
    assert S.near_duplicates(no_docs, "doc_id", "text").collect() == []


@pytest.mark.parametrize("bucket", [20, 4096])
def test_links_of_crowded_keys(spark, bucket):
    """Clusters of near fingerprints, more than a small bucket takes."""
    rng = random.Random(bucket)
    prints = set()
    for centre in [0, (1 << 64) - 1, rng.getrandbits(64)]:
        for _ in range(40):
            fp = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                fp ^= 1 << b
            prints.add(fp)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    links = S.links(spark.createDataFrame([(x,) for x in signed], "fp long"), bucket)
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    assert brute_components(prints, found) == brute_components(prints, close(prints))


def test_chains_hold_for_every_linked_pair():
    rng = random.Random(3)
    diffs = [sum(1 << b for b in rng.sample(range(64), k)) for k in range(4) for _ in range(500)]
    assert S.chains_hold(np.array(diffs, dtype=np.uint64)).all()
    far = [sum(1 << b for b in rng.sample(range(64), k)) for k in range(4, 9) for _ in range(300)]
    assert not S.chains_hold(np.array(far, dtype=np.uint64)).any()


def test_majority_of_many_hashes():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 2, 254, 255, 256, 1000, 0]
    hashes = rng.integers(0, 1 << 63, sum(sizes), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, sum(sizes), dtype=np.uint64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    for i, fp in enumerate(S.majority(hashes, first).tolist()):
        own = hashes[first[i] : first[i + 1]].tolist()
        assert fp == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > len(own))


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7)]
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == brute_components(nodes, edges[:-1])
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
