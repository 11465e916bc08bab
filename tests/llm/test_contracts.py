"""The registered queries against their SQL, and the others against brute force, on the smallest data."""

import collections
import hashlib
import random
import re

import pytest

import corpus_pipeline
from catalogproof.llm import jaccard, licenses, pii, similar
from catalogproof.llm.queries import ORACLE, QUERIES, table, vocabulary
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), SF, name, QUERIES[name], ORACLE[name]) is None


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_equals_the_library(spark, docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    for r in QUERIES["op3_bpe"](spark, SF).collect():
        ids = plain.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(plain.decode(ids, skip_special_tokens=False))


def plain_base_spans(text):
    """The base rules of the contract as plain regular expressions, without any code of the operator."""

    def doubled(digits):
        total = 0
        for k, d in enumerate(reversed(digits)):
            n = int(d) * (2 if k % 2 else 1)
            total += n - 9 if n > 9 else n
        return total % 10 == 0

    only = lambda s: [c for c in s if c in "0123456789"]
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(only(s)) <= 19 and doubled(only(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(only(s)) <= 15),
    ]
    return [(kind, m.start(), m.end()) for kind, rule, holds in rules for m in re.finditer(rule, text) if holds(m[0])]


def test_pii_keeps_the_base_spans(spark, docs):
    some = 0
    for r in QUERIES["op5_pii"](spark, SF).collect():
        base = plain_base_spans(docs[r["doc_id"]] or "")
        some += bool(base)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        spans = [":".join(map(str, s)) for s in base]
        assert r["base_sha256"] == sha(",".join(spans))
        assert set(spans) <= set(filter(None, r["spans"].split(",")))
    assert some > 5


def test_pii_base_spans_of_random_texts():
    """Overlaps, runs that end at each other, failing beginnings: against the plain expressions."""
    r = random.Random(9)
    for letters in ("ab.@ ", "1.0 2", "@a.-_%+", "+1 -().", "45391 -", "a1@.+- ()", "é9.@x+ "):
        for _ in range(3000):
            text = "".join(r.choice(letters) for _ in range(r.randrange(40)))
            assert pii.base_spans(text) == plain_base_spans(text), text
    card = "4539 1488 0343 6467"
    assert pii.base_spans(f"x {card}, {card[:-1]}8") == [("card", 2, 21)] == plain_base_spans(f"x {card}, {card[:-1]}8")


def test_license_scan_equals_alignment_everywhere(spark, docs):
    index = licenses.Index(licenses.TEMPLATES)
    for r in QUERIES["op6_licenses"](spark, SF).collect():
        words = [index.ids.get(w.lower(), 0) for w in licenses._WORD.findall(docs[r["doc_id"]])]
        found = []
        for t, template in enumerate(index.words):
            matched, first, end = licenses.align(template.tolist(), words, 0, len(words) + len(template))
            if matched / len(template) >= licenses.COVERAGE:
                found.append((-matched, -matched / len(template), t, first, end))
        best = min(found, default=None)
        assert (best is None) == (r["n_findings"] == 0)
        if best:
            assert any(f.startswith(index.names[best[2]] + ":") for f in r["findings"].split(","))


def test_edit_counts_equal_a_full_recount(spark, docs):
    from catalogproof.llm import edit_counts

    encoding = edit_counts.counter(vocabulary("byte_bpe_50k.tiktoken"))._encoding
    for r in QUERIES["op8_edit_counts"](spark, SF).collect():
        text = docs[r["doc_id"]]
        n = len(text)
        assert r["n_tokens_before"] == len(encoding.encode_ordinary(text))
        for start, end, new in ((n // 3, n // 3, "new WORDS's "), (n // 2, n // 2 + 20, ""), (n - 5, n + 100, "2026 à la fin")):
            start = min(max(start, 0), len(text))
            text = text[:start] + new + text[max(start, end) :]
        assert (r["n_tokens"], r["n_chars"], r["edited_sha256"]) == (len(encoding.encode_ordinary(text)), len(text), sha(text))
        assert r["encoded_chars"] <= 3 * len(text) + 100


def brute_force_classes(texts):
    """doc_id -> (class_id, n_links) by counting shared shingles of every pair that has any."""
    sets = {}
    for i, text in texts.items():
        words = (text or "").encode().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    holders, shared = collections.defaultdict(list), collections.Counter()
    for i, s in sets.items():
        for shingle in s:
            shared.update((j, i) for j in holders[shingle])
            holders[shingle].append(i)
    parent, links = {i: i for i in sets}, collections.Counter()

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in shared.items():
        if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
            links.update((a, b))
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in sets}


def test_jaccard_join_finds_every_pair(spark, docs):
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in QUERIES["op10_jaccard"](spark, SF).collect()}
    assert got == brute_force_classes(docs)


def test_jaccard_join_of_large_groups_and_common_passages(spark, monkeypatch):
    """Buckets over the limit, several blocks, chains: every way through the join."""
    monkeypatch.setattr(jaccard, "SMALL", 6)
    monkeypatch.setattr(similar, "BLOCK", 16)
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    passage, base = [word() for _ in range(40)], [word() for _ in range(90)]
    texts = {}
    for i in range(60):  # near copies of one text
        changed = list(base)
        changed[r.randrange(90)] = word()
        texts[i] = " ".join(changed)
    for i in range(60, 140):  # others that share a passage
        texts[i] = " ".join(passage + [word() for _ in range(60)])
    for i in range(140, 170):  # a chain: each is like its neighbours only
        start = 5 * (i - 140)
        texts[i] = " ".join((base * 4)[k % 90] + str(k // 90) for k in range(start, start + 100))
    texts |= {170: "", 171: None, 172: " \n", 173: "one two", 174: "one two", 175: "one  two", 176: texts[3]}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in jaccard.join(df).collect()}
    assert got == brute_force_classes(texts)
    kept = sorted(x["doc_id"] for x in jaccard.keep_one(df).collect())
    assert kept == sorted({c for c, _ in got.values()})


def test_jaccard_join_of_skewed_texts_at_the_limit(spark, monkeypatch):
    """Texts that share many words, with copies just at the limit: buckets go deep, and no link is lost."""
    monkeypatch.setattr(jaccard, "SMALL", 4)
    depths = []
    search = jaccard._search
    monkeypatch.setattr(jaccard, "_search", lambda *a: depths.append(search(*a)) or depths[-1])
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    common, texts = [word() for _ in range(85)], {}
    for i in range(0, 300, 2):
        own = common + [word() for _ in range(115)]
        copy = list(own)
        for k in r.sample(range(90, 200, 5), 4):  # 196 windows, 20 to 21 of them changed: similarity 0.80 to 0.82
            copy[k] = word()
        texts |= {i: " ".join(own), i + 1: " ".join(copy)}
    want = brute_force_classes(texts)
    links = sum(n for _, n in want.values())
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in jaccard.join(df).collect()}
    assert links >= 200 and sum(n for _, n in got.values()) >= 0.99 * links
    deepest = max(d for _, d, _ in depths)
    assert deepest > jaccard.DEPTH and len(depths) > 1


def test_jaccard_join_of_rings(spark, monkeypatch):
    """Copies at all distances from one text: what rings decide, what blocks decide, and counts with copies."""
    monkeypatch.setattr(similar, "BLOCK", 8)
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    base, texts = [word() for _ in range(300)], {}
    for i in range(120):
        changed = list(base)
        for k in r.sample(range(300), i % 12):
            changed[k] = word()
        texts[i] = " ".join(changed)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in jaccard.join(df).collect()}
    assert got == brute_force_classes(texts)


def test_pipeline_stages(spark, docs):
    before = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        after = spark.createDataFrame(after.collect(), after.schema)
        assert sorted(after.columns) == sorted(corpus_pipeline.COLUMNS), name
        before = after
    taken = collections.Counter(r["source"] for r in before.collect())
    assert sum(taken.values()) > 100
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF).collect()
    assert len(last) == before.count() and all(len(r["ids"]) == r["n_tokens"] for r in last)


def test_pipeline_decodes_what_it_encodes(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    texts = ["Plain words, of a  text!", "", None, "ümlaut \u4e2d\u6587 \U0001f600 #1"] * 2
    rows = spark.createDataFrame([(i, "s", "en", t) for i, t in enumerate(texts)], "doc_id long, source string, lang string, text string")
    last = {r["doc_id"]: r for r in corpus_pipeline.STAGES[-1][1](spark, rows, SF).collect()}
    assert len(last) == len(texts)
    for i, text in enumerate(texts):
        ids = plain.encode(text or "", add_special_tokens=False).ids
        assert last[i]["ids"] == ids
        assert last[i]["decoded_sha256"] == sha(plain.decode(ids, skip_special_tokens=False))


def test_quality_rejects_symbol_junk_and_keeps_clean_texts(spark):
    """By the labels: of the texts that pass the base rules and are a tenth symbols or more, and of those labelled good."""
    sf = "/root/testdata/sf0.1"
    judged = QUERIES["op7_quality"](spark, sf).join(table(spark, sf, "labels"), "doc_id").filter("NOT base_failed")
    junk = judged.filter("quality = 0 AND n_symbols > 0.1 * word_chars")
    good = judged.filter("quality = 1")
    assert junk.count() > 200 and junk.filter("kept").count() <= 0.2 * junk.count()
    assert good.filter("NOT kept").count() <= 0.01 * good.count()


def test_jaccard_join_searches_deep_buckets_directly(spark, monkeypatch):
    """Texts that share most of their words stay together at every split: after DEPTH levels they are compared, not split on."""
    monkeypatch.setattr(jaccard, "SMALL", 16)
    depths = []
    search = jaccard._search
    monkeypatch.setattr(jaccard, "_search", lambda *a: depths.append(search(*a)) or depths[-1])
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    common, texts = [word() for _ in range(64)], {}
    for i in range(0, 160, 2):
        own = common + [word() for _ in range(40)]
        texts |= {i: " ".join(own), i + 1: " ".join([*own[:-1], word()])}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in jaccard.join(df).collect()}
    assert got == brute_force_classes(texts)
    assert [d for _, d, _ in depths] == [jaccard.DEPTH]


def written(monkeypatch):
    """Names and rows of the tables that a join writes."""
    from catalogproof.operators import scaling

    tables, write = [], scaling.materialize

    def counting(df, name="step"):
        tables.append((name, write(df, name)))
        return tables[-1][1]

    monkeypatch.setattr(scaling, "materialize", counting)
    return tables


def test_jaccard_join_compares_a_common_passage_at_once(spark, monkeypatch):
    """Texts that share half of their words are not split on in every run, which would write them again and again."""
    tables = written(monkeypatch)
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    common, texts = [word() for _ in range(60)], {}
    for i in range(0, 400, 2):
        own = common + [word() for _ in range(45)]
        texts |= {i: " ".join(own), i + 1: " ".join([*own[:-1], word()])}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in jaccard.join(df).collect()}
    assert got == brute_force_classes(texts)
    assert not [name for name, _ in tables if name in ("level", "split")]


def test_a_large_group_is_sent_by_blocks_not_by_rings(spark, monkeypatch):
    monkeypatch.setattr(similar, "BLOCK", 80)
    tables = written(monkeypatch)
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    base, texts = [word() for _ in range(200)], {}
    for i in range(240):  # at all distances from one text, rings of few members
        changed = list(base)
        for k in r.sample(range(200), i % 16):
            changed[k] = word()
        texts[i] = " ".join(changed)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in jaccard.join(df).collect()}
    assert got == brute_force_classes(texts)
    (rings,) = [t for name, t in tables if name == "ring_stats"]
    (cells,) = [t for name, t in tables if name == "cells"]
    assert rings.count() > 15 and cells.count() <= 4 * 240


def test_the_last_edges_are_contracted_at_once(spark, monkeypatch):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300) if i % 50] + [(1000 + r.randrange(40), 1000 + r.randrange(40)) for _ in range(30)]
    df = spark.createDataFrame(edges, "a long, b long")

    def parts():
        found = collections.defaultdict(set)
        for x in similar.components(df).collect():
            found[x["root"]].add(x["row"])
        assert all(root in rows for root, rows in found.items())
        return sorted(map(sorted, found.values()))

    tables = written(monkeypatch)
    at_once = parts()
    assert [name for name, _ in tables].count("hooks") == 1
    monkeypatch.setattr(similar, "LAST", 3)
    assert parts() == at_once
    assert [name for name, _ in tables].count("hooks") > 3


def test_rows_of_buckets_are_sent_without_a_second_key(spark, monkeypatch):
    from catalogproof.operators import scaling

    rows = [(node, 10 * node + k) for node in range(1, 30) for k in range(1 if node % 3 else node)]
    level = spark.createDataFrame(rows, "node long, row long")
    few = sorted(map(tuple, similar.buckets(level)[0].select("node", "row", "size", "pivot").collect()))
    monkeypatch.setattr(scaling, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(scaling, "HOT_ROWS", 12)
    many = similar.buckets(level)[0].select("node", "row", "size", "pivot")
    assert sorted(map(tuple, many.collect())) == few
    assert len(few) == sum(range(3, 30, 3)) and {size for _, _, size, _ in few} == set(range(3, 30, 3))
    assert "_second" not in many._jdf.queryExecution().executedPlan().toString()


def passages(n: int, seed: int) -> dict[int, str]:
    """Texts of which pairs are near copies and all share half of their words."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    common, texts = [word() for _ in range(60)], {}
    for i in range(0, n, 2):
        own = common + [word() for _ in range(45)]
        texts |= {i: " ".join(own), i + 1: " ".join([*own[:-1], word()])}
    return texts


def test_jaccard_join_of_few_edges_writes_few_tables(spark, monkeypatch):
    """Few edges need no rounds, few keys and pivots no tables of their own; the broader paths find the same."""
    from catalogproof.operators import scaling

    monkeypatch.setattr(jaccard, "SMALL", 2)
    monkeypatch.setattr(jaccard, "DEEP_TIMES", 1)
    monkeypatch.setattr(similar, "BLOCK", 8)
    texts = passages(60, 3)
    r = random.Random(4)
    base = texts[0].split()
    for i in range(100, 130):  # a group of several blocks
        texts[i] = " ".join(base[:k] + ["x" + str(i)] + base[k + 1 :]) if (k := r.randrange(40, 100)) else ""
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    tables = written(monkeypatch)

    def links():
        tables.clear()
        found = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in jaccard.join(df).collect()}
        return found, collections.Counter(name for name, _ in tables)

    wanted = brute_force_classes(texts)
    found, names = links()
    assert found == wanted and names["split"] and names["ring_stats"]
    assert names["keys"] == names["labels"] == 0
    assert names["hooks"] == 2
    monkeypatch.setattr(similar, "LAST", 3)
    monkeypatch.setattr(similar, "FEW_PIVOTS", 0)
    monkeypatch.setattr(scaling, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(scaling, "HOT_ROWS", 12)
    found, names = links()
    assert found == wanted and names["keys"] and names["labels"] == 2


def test_workers_collect_garbage_by_bytes_not_by_partitions(monkeypatch):
    import pyarrow as pa

    from catalogproof.llm import words

    collected = []
    monkeypatch.setattr(words.gc, "collect", lambda: collected.append(1))
    monkeypatch.setattr(words, "COLLECT", 10_000)
    monkeypatch.setattr(words, "_taken", 0)
    batch = pa.RecordBatch.from_arrays([pa.array(range(100), pa.int64())], ["x"])
    run = words.returning(lambda batches: (b for b in batches))
    for _ in range(100):
        assert sum(b.num_rows for b in run(iter([batch]))) == 100
    assert 7 <= len(collected) <= 8
