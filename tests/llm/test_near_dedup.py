"""SuperMinHash against its definition, and the groups against counting the shingles of every pair."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogproof.llm import near_dedup, similar, words


def test_components_equal_the_definition():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (0, 1, 3, 40, 200)]
    got = near_dedup.super_minhash(np.concatenate(sets), np.repeat(np.arange(5), [len(s) for s in sets]), 5, 32)
    for elements, row in zip(sets, got):
        least = [2**64 - 1] * 32
        for e in elements:
            order = list(range(32))
            for place in range(32):
                drawn = words.mix(np.array([e]) ^ words.mix(np.array([place + 1], np.uint64)))
                other = place + int(words.mix(drawn + np.uint64(1))[0]) % (32 - place)
                order[place], order[other] = order[other], order[place]
                least[order[place]] = min(least[order[place]], place << 56 | int(drawn[0]) >> 8)
        assert least == [int(x) for x in row]


def test_variance_is_below_that_of_independent_minima():
    rng = np.random.default_rng(2)
    shares = []
    for _ in range(200):
        a, b, both = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (8, 7, 85))
        got = near_dedup.super_minhash(np.concatenate([both, a, both, b]), np.repeat([0, 1], [93, 92]), 2)
        shares.append((got[0] == got[1]).mean())
    assert np.mean(shares) == pytest.approx(0.85, abs=0.006)
    assert np.std(shares) < 0.9 * (0.85 * 0.15 / similar.BINS) ** 0.5


def brute_force(texts):
    """doc_id -> (n_shingles, component_id) by counting shared shingles of every pair that has any."""
    sets = {}
    for i, text in texts.items():
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    holders, shared = collections.defaultdict(list), collections.Counter()
    for i, s in sets.items():
        for shingle in s:
            shared.update((j, i) for j in holders[shingle])
            holders[shingle].append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_large_groups_chains_and_common_passages(spark, monkeypatch):
    """Buckets over the limit, several parts and blocks, members that only others than the root link."""
    monkeypatch.setattr(near_dedup, "SMALL", 6)
    monkeypatch.setattr(similar, "BLOCK", 16)
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    passage, base = [word() for _ in range(60)], [word() for _ in range(120)]
    texts = {}
    for i in range(80):  # near copies of one text, some of copies
        changed = (texts[r.randrange(i)].split() if i and r.random() < 0.5 else list(base)).copy()
        changed[r.randrange(len(changed))] = word()
        texts[i] = " ".join(changed)
    for i in range(80, 160):  # others that share a passage
        texts[i] = " ".join(passage + [word() for _ in range(30)])
    for i in range(160, 200):  # a chain: each is like its neighbours only
        start = 4 * (i - 160)
        texts[i] = " ".join((base * 4)[k % 120] + str(k // 120) for k in range(start, start + 100))
    texts |= {200: "", 201: None, 202: " \n", 203: "One two", 204: "one TWO", 205: "one\ttwo", 206: texts[3].upper(), 207: "Éa b c d e f", 208: "éa b c d e f"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = near_dedup.grouped(df).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in rows} == brute_force(texts)
    assert all(x["kept"] == (x["doc_id"] == x["component_id"]) for x in rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000)) + " " + "x" * 50_000
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "A B C D E F"), (7, long), (8, long.upper()), (None, "no id but words here"), (9, None), (10, "")]
    odd = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("row", "kept", "n", "bands", "key", "component_id")})
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.grouped(odd).collect()), key=repr)
    n = 30_001 - 4
    want = [(5, 2, 5, True)] * 2 + [(None, 2, 5, False), (None, 1, None, True), (7, n, 7, True), (8, n, 7, False), (9, 0, 9, True), (10, 0, 10, True)]
    assert got == sorted(want, key=repr)
    assert near_dedup.grouped(odd.limit(0)).count() == 0
