"""The trie against a plain dictionary of prefixes; odd rows, ties and hot prefixes."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from catalogproof.llm import prefix_trie
from catalogproof.operators import scaling

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(ids):
    return hashlib.sha256(",".join(map(str, sorted(i for i in ids if i is not None))).encode()).hexdigest()


def brute_force(convs):
    """Rows of the expanded trie from {conv_id: [(role, text), ...]}, sorted."""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in convs:
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(who) - 1) * len(p[-1][1].encode()) if p else 0
    least = lambda p: min((c for c in members[p] if c is not None), default=None)
    rows = [(least(p), len(p), least(p[:-1]) if p else None, len(who), children[p], leaves[p], saved[p], sha(ends[p])) for p, who in members.items()]
    return sorted(rows, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def built(conversations):
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie(conversations).collect()), key=repr)


@pytest.mark.parametrize("seed,letters,longest", [(1, 1, 40), (2, 2, 9), (3, 3, 17)])
def test_trie_equals_a_dictionary(spark, monkeypatch, seed, letters, longest):
    """Chains of prefixes of one another, shared beginnings, copies; every prefix of a quarter of the rows counts as hot."""
    monkeypatch.setattr(scaling, "HOT_ROWS", 8)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    r = random.Random(seed)
    convs = {}
    for c in range(120):
        turns = [("user" if r.randrange(letters) else "assistant", "é" * r.randrange(letters)) for _ in range(r.randrange(1, longest))]
        if r.random() < 0.4:
            turns = [("system", "be kind"), *turns]
        convs[7 * c - 50] = convs[7 * r.randrange(c) - 50] if c and r.random() < 0.3 else turns
    rows = [(c, t, *turn) for c, turns in convs.items() for t, turn in enumerate(turns)]
    r.shuffle(rows)
    found = prefix_trie.listed(spark.createDataFrame(rows, SCHEMA))
    assert built(found) == brute_force(convs.items())


def test_a_stored_trie_takes_another_batch(spark):
    rows = [(c, t, "user", f"{(c * 31 + t * t) % 3}") for c in range(40) for t in range(c % 6 + 1)]
    described = scaling.materialize(prefix_trie.describe(prefix_trie.listed(spark.createDataFrame(rows, SCHEMA))))
    whole = prefix_trie.sequences(described)
    some = prefix_trie.sequences(described.filter("conv_id % 3 = 0"))
    nodes = prefix_trie.insert(prefix_trie.build(some), whole)
    parts = lambda n: sorted(map(tuple, n.select("top", "depth", F.hex("id"), F.hex("handle"), "upto").collect()), key=repr)
    assert parts(nodes) == parts(prefix_trie.build(whole))


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"),
        (1, 0, None, None),
        (2, None, "user", "first"),
        (2, 5, "", ""),
        (3, 1, "user", "first"),
        (3, 1, "user", "first"),
        (None, 1, "user", "first"),
        (None, 2, "x", "long " * 50_000),
        (4, 9, "user", "first"),
    ]
    first = ("user", "first")
    convs = [(1, [first, ("", "")]), (2, [first, ("", "")]), (3, [first, first]), (None, [first, ("x", "long " * 50_000)]), (4, [first])]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("keys", "depth", "id", "turns", "upto")})
    assert built(prefix_trie.listed(odd)) == brute_force(convs)
    turnless = prefix_trie.listed(odd).unionByName(spark.createDataFrame([(9, [])], "conv_id long, turns array<struct<a:long,b:long,bytes:long>>"))
    assert built(turnless) == brute_force([*convs, (9, [])])
    assert built(prefix_trie.listed(odd.limit(0))) == []
    assert built(turnless.filter("conv_id = 9")) == brute_force([(9, [])])
