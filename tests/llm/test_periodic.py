"""Runs by recompression against every pair of places, and the query against a plain rebuilding of its contract."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogproof.llm import periodic
from catalogproof.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"


def brute_force(words):
    """(start, length, period) of every run, by comparing all words a period apart."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        t = 0
        while t < n - p:
            u = t
            while u < n - p and words[u] == words[u + p]:
                u += 1
            if u > t and u - t + p >= max(24, 3 * p):
                found.setdefault((t, u - t + p), p)
            t = max(u, t + 1)
    return sorted(((s, m, p) for (s, m), p in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    dropped = {t for s, m, p in runs for t in range(s + p, s + m)}
    return " ".join(w for t, w in enumerate(words) if t not in dropped)


def test_runs_equal_brute_force(monkeypatch):
    monkeypatch.setattr(periodic, "PAIRS", 100)
    r = random.Random(11)
    for _ in range(300):
        texts = []
        for _ in range(r.randrange(1, 6)):
            n, k = r.choice([0, 1, 5, 23, 24, 25, 60, 150]), r.choice([1, 2, 2, 3, 10])
            words = [r.randrange(k) for _ in range(n)]
            if n > 30 and r.random() < 0.7:
                a = r.randrange(n)
                p = 1 + (n - a) // r.randrange(3, 10)
                words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
                words[r.randrange(n)] = r.choice([99, words[0]])
            texts.append(words)
        hashes = np.array([w for words in texts for w in words], np.uint64)
        got = [[] for _ in texts]
        for t, *run in zip(*(c.tolist() for c in periodic.runs(hashes, np.array([len(w) for w in texts])))):
            got[t].append(tuple(run))
        assert got == [brute_force(w) for w in texts]


@pytest.mark.parametrize("back", [False, True])
def test_extensions_equal_a_plain_loop(back):
    r = random.Random(3)
    numbers = np.array([100, *[r.randrange(2) for _ in range(200)], 101])
    grammar = periodic.Grammar(numbers)
    pairs = [(i, j) for i in range(1, 201) for j in range(i + 1, 202)]
    i, j = np.array(pairs).T
    for (a, b), n in zip(pairs, grammar.extend(i, j, back).tolist()):
        k = 0
        while numbers[a - 1 - k if back else a + k] == numbers[b - 1 - k if back else b + k]:
            k += 1
        assert n == k


def test_query_equals_its_contract(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = {r["doc_id"]: r for r in QUERIES["op12_periodic"](spark, SF).collect()}
    assert rows.keys() == docs.keys()
    some = 0
    for i, text in docs.items():
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        if n > 3000:
            continue  # too many pairs for a plain loop
        runs = brute_force(words)
        r = rows[i]
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        some += bool(runs)
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == (best or (None,) * 3)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{m},{p}\n" for s, m, p in runs))
        assert r["collapsed_sha256"] == sha(collapse(words, runs))
    assert some >= 10


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 23), (5, "a " * 24), (5, "a " * 24), (None, "x y z " * 9 + "é"), (6, "w " * 60_000 + "x" * 50_000)]
    odd = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit("clash"), "collapsed": F.lit("clash"), "start": F.lit(7)})
    got = sorted((r["doc_id"] or 0, r["start"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.find(odd).collect())
    assert [g[0] for g in got] == [0, 1, 2, 3, 4, 5, 5, 6] and {g[1] for g in got} == {7}
    assert got[0][2:] == ([(0, 27, 3)], "x y z é")
    assert [g[2:] for g in got[1:4]] == [([], "")] * 3
    assert got[4][2:] == ([], " ".join("a" * 23))
    assert got[5][2:] == got[6][2:] == ([(0, 24, 1)], "a")
    assert got[7][2:] == ([(0, 60_000, 1)], "w " + "x" * 50_000)
    assert periodic.find(odd.limit(0)).count() == 0
