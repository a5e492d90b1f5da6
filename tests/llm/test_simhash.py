from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from leaseload.llm import simhash
from tests.llm.conftest import CLASHING, LONG


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().replace(b"\n", b" ").split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Least position reachable over pairs at most two bits apart."""
    least = list(range(len(prints)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                x, y = sorted((root(i), root(j)))
                least[y] = x
    return [root(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", ["", "One", "a B c", "a b c d e f g", "é É x\ty\nz", "w " * 500])
def test_fingerprint(text):
    words = " ".join(text.encode().lower().decode().split())
    assert simhash.fingerprint(text) == plain_fingerprint(words)


def test_every_pair_shares_a_key_and_a_chain():
    rng = random.Random(3)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        found = [start for start, mask in simhash.chain_slots() if a & mask == b & mask]
        differing = np.array([a ^ b], np.uint64)
        assert any(simhash.chain_holds(differing, start)[0] for start in found)


@pytest.mark.parametrize("bucket", [2, 2_048])
def test_links_give_the_components_of_all_pairs(spark, bucket):
    rng = random.Random(5)
    prints = {0}
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(30):
            prints.add(at)
            at ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
        # A dense cluster: many prints in the same bucket.
        prints |= {at ^ (1 << rng.randrange(20)) for _ in range(15)}
    ordered = sorted(prints, key=simhash._signed)
    frame = spark.createDataFrame([(simhash._signed(p),) for p in ordered], "fp bigint")
    edges = simhash.links(frame, bucket)
    labels = {r.vertex: r.label for r in simhash.smallest_label(edges).collect()}
    got = [labels.get(simhash._signed(p), simhash._signed(p)) for p in ordered]
    assert got == [simhash._signed(ordered[i]) for i in plain_groups(ordered)]


def test_near_copies_and_what_stays(spark, documents):
    base = "the quick brown fox jumps over the lazy dog while seven green birds sing in the old tree " * 6
    texts = [base, base, base.upper(), None, "", (7, "alone here with other words"), (7, "alone here with other words"), (None, "no id at all"), LONG]
    docs = documents(*texts, extra=CLASHING)
    rows = sorted(((r.doc_id, r.component_id) for r in simhash.near_copies(docs).collect()), key=repr)
    assert rows == sorted(
        [(0, 0), (1, 0), (2, 0), (3, 3), (4, 3), (7, 7), (7, 7), (None, None), (8, 8)], key=repr
    )
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([0, 3, 7, None, 8], key=repr)


def test_empty_table(documents):
    docs = documents("x").filter("false")
    assert simhash.near_copies(docs).count() == 0
    assert simhash.drop_near_copies(docs).count() == 0
