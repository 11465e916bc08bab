"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogproof.llm import bpe, chat, edit_counts, fingerprints, jaccard, licenses, mixing, pii, quality, revisits, similar, words
from catalogproof.llm.queries import vocabulary
from catalogproof.operators import scaling

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 40_000 + "x" * 50_000


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (3, " \n\t ", "en", None, 4),
        (4, LONG, "fr", "b", len(LONG)),
        (5, "same text here", "en", "a", 14),
        (5, "same text here", "en", "a", 14),
        (None, "no id at all, but words", "en", "a", 23),
        (6, "same text here", "en", "b", 14),
    ]
    clash = ["kept", "copies", "taken", "position", "target", "ids", "decoded", "n_words", "findings", "spans", "base_spans", "n_tokens", "n_symbols"]
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_words_hash_alike_wherever_they_stand():
    import pyarrow as pa

    texts = ["alpha beta", None, "", "beta\talpha\n" * 3, " é beta"]
    hashes, counts = words.hashed(pa.array(texts))
    assert counts.tolist() == [2, 0, 0, 6, 2]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2] == hashes[9] and len(set(hashes.tolist())) == 3


def test_words_do_not_depend_on_the_window(monkeypatch):
    import pyarrow as pa

    r = random.Random(1)
    texts = pa.array(["".join(r.choice("ab  \nç") for _ in range(r.randrange(200))) for _ in range(50)])
    whole = words.hashed(texts)
    monkeypatch.setattr(words, "WINDOW", 16)
    parts = words.hashed(texts)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()
    assert whole[1].tolist() == [len(t.encode().split()) for t in texts.to_pylist()]


# --- mixing -------------------------------------------------------------------------


def schedule(spark, *rows):
    return spark.createDataFrame(rows, "source string, at double, weight double")


def test_mixing_odd_rows(spark, odd, none):
    flat = schedule(spark, *[(s, t, 1.0) for s in ("a", "b", None) for t in (0.0, 1.0)])
    sized = odd.withColumn("size", words.count(F.col("text")))
    placed = mixing.place(sized, flat).collect()
    assert len(placed) == 8 and all(r["taken"] == r["copies"] * r["size"] for r in placed)
    assert all(r["copies"] == 0 and r["position"] is None for r in placed if not r["size"])
    assert mixing.place(none.withColumn("size", F.lit(1)), flat).count() == 0
    assert mixing.mix(none.withColumn("size", F.lit(1)), flat).count() == 0


def test_mixing_reaches_targets_and_caps(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 2000, "big").when(F.col("id") < 2900, "mid").otherwise("small").alias("source"),
        (F.col("id") % 37 + 1).alias("size"),
    )
    plan = schedule(spark, *[(s, t, w) for s, w in (("big", 1.0), ("mid", 2.0), ("small", 20.0)) for t in (0.0, 1.0)])
    rows = mixing.place(docs, plan).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("n"), F.max("copies").alias("c")).collect()
    by = {r["source"]: r for r in rows}
    assert by["small"]["target"] == 3 * by["small"]["n"] and by["small"]["c"] == 3
    assert sum(r["target"] for r in rows) == pytest.approx(sum(r["n"] for r in rows))
    assert by["mid"]["target"] == pytest.approx(2 * by["big"]["target"])
    assert all(abs(r["taken"] - r["target"]) <= 37 / 2 for r in rows)


def test_mixing_follows_the_curriculum(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "early").otherwise("late").alias("source"), F.lit(1).alias("size"))
    plan = schedule(spark, ("early", 0.0, 2.0), ("early", 1.0, 0.0), ("late", 0.0, 0.0), ("late", 1.0, 2.0))
    mixed = mixing.mix(docs, plan)
    rows = [(r["source"], r["position"]) for r in mixed.collect()]
    assert [p for _, p in rows] == sorted(p for _, p in rows)
    # the integral of 2 - 2t is 2t - t^2
    assert sum(s == "early" and p < 0.5 for s, p in rows) == pytest.approx(2000 * 0.75, abs=2)
    assert sum(s == "late" and p < 0.5 for s, p in rows) == pytest.approx(2000 * 0.25, abs=2)


def test_mixing_does_not_depend_on_partitions(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") % 7).alias("size"))
    both = docs.unionByName(docs.limit(0)).withColumn("source", F.when(F.col("doc_id") < 50, "t").otherwise("s"))
    plan = schedule(spark, *[(s, t, 1.0) for s in "st" for t in (0.0, 1.0)])
    once = sorted(map(tuple, mixing.place(both, plan).select("doc_id", "copies", "position").collect()))
    again = sorted(map(tuple, mixing.place(both.repartition(5), plan).select("doc_id", "copies", "position").collect()))
    assert once == again


# --- fingerprints ---------------------------------------------------------------------


def versions(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "key long, a string, b string")
    return df.select("key", fingerprints.digests(F.col("a")).alias("a"), fingerprints.digests(F.col("b")).alias("b"))


def test_pieces_cover_the_text(spark):
    texts = ["", "a", "\n\n", "x " * 100, "one two\nthree", LONG, " lead\n tail "]
    pieces = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.regexp_extract_all("t", F.lit(fingerprints.PIECE), F.lit(0)))
    assert all("".join(p) == t for t, p in pieces.collect())


def test_difference_is_recovered_with_retries(spark):
    r = random.Random(5)
    lines = [f"line {i}\n" for i in range(3000)]
    pairs = [(None, ""), ("x", "x"), ("a\na\na\n", "a\na\n"), ("".join(lines), "".join(r.sample(lines, 1500)))]
    pairs += [("".join(r.choices(lines, k=k)), "".join(r.choices(lines, k=k))) for k in (1, 5, 40, 300)]
    table = versions(spark, pairs).cache()
    got = {x["key"]: x for x in fingerprints.difference(table, "key", "a", ["b"], m=12).collect()}
    assert 0 not in got and max(x["tries"] for x in got.values()) > 2
    exact = fingerprints.elements(table, "key", [("a", 0, 1), ("b", 0, -1)]).groupBy("key", "element").agg(F.sum("side").alias("s"))
    want = {}
    for x in exact.filter("s != 0").collect():
        want.setdefault(x["key"], (set(), set()))[x["s"] < 0].add(x["element"])
    for key, x in got.items():
        assert (set(x["only_left"]), set(x["only_right"])) == want.get(key, (set(), set()))


def test_fingerprints_of_equal_texts(spark):
    table = versions(spark, [("a\nb", "b\na"), ("a\nb", None), ("", "a")])
    f = {r["key"]: (r["a"], r["b"]) for r in fingerprints.fingerprint(table, "key", ["a", "b"]).collect()}
    assert f[0][0] == f[1][0] != f[0][1] and f[1][1] == "" == f[2][0]


def test_fingerprint_query_of_odd_rows(spark, odd, none):
    """Null, repeated and sparse ids, null and empty texts, clashing columns: every row has its next one."""
    import hashlib

    from catalogproof.llm.queries import compared

    rows = [(1, "a\nb\nc"), (2, "x y"), (4, "same"), (4, "same"), (10**15, "far\naway"), (-3, None), (None, "no id"), (None, "none"), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("block", "guest", "digests", "next_text", "key")})
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, md5(r[1])), reverse=True)
    want = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        want.append((i, len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    got = compared(df).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert compared(none).count() == 0 and compared(odd).count() == 8


def test_repeated_lines_are_alike(spark):
    table = versions(spark, [("line\n" * 1000, "line\n" * 999), ("a\nb\n", "c\nd\n")]).cache()
    near = fingerprints.difference(table, "key", "a", ["b"])
    alike = {r["key"]: r["n"] for r in near.select("key", fingerprints.likeness(near).alias("n")).collect()}
    assert alike[0] > 0.999 and alike[1] == 0


# --- BPE --------------------------------------------------------------------------------


def test_bpe_odd_rows_and_the_library(spark, odd, none):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    rows = bpe.decode(bpe.encode(odd, path), path).collect()
    assert len(rows) == 8
    for r in rows:
        ids = plain.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == plain.decode(ids, skip_special_tokens=False)
    assert bpe.encode(none, path).count() == 0 == bpe.digest(none.select("doc_id", "text"), path).count()


def test_bpe_strange_texts():
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    plain, own = Tokenizer.from_file(path), bpe.vocabulary(path)
    texts = ["<|startoftext|>a<|endoftext|>B<|x|>", "<|ENDOFTEXT|>", "a\x1cb", "ΑΣ Σ", "İ ǅ", "é ́", "it's I'LL", "²³½", "日本語 한국어 각", "😀", "ﬁ ẞ Å"]
    for text in [*texts, *["a" + chr(c) + "b" for c in range(1, 0x3000)]]:
        assert own.encode(text) == plain.encode(text, add_special_tokens=False).ids, repr(text)


# --- chat -------------------------------------------------------------------------------


LOG = "conv_id long, seq long, kind string, message_id long, role string, text string"


def test_chat_folds_deltas_edits_and_regenerations(spark):
    log = [
        (1, 1, "message", 10, "user", "Hel"),
        (1, 2, "delta", 10, None, "lo"),
        (1, 3, "message", 11, "assistant", None),
        (1, 4, "delta", 11, None, "draft"),
        (1, 5, "message", 12, "user", "gone with the draft"),
        (1, 6, "regenerate", 11, None, "ignored"),
        (1, 7, "delta", 11, None, "fi"),
        (1, 8, "delta", 11, None, "nal"),
        (1, 9, "message", 13, "user", "typo"),
        (1, 10, "edit", 13, None, "fixed <|im_end|> \\ ok"),
        (1, 11, None, 13, None, "!"),
        (None, None, "message", None, None, "x"),
    ]
    out = {r["conv_id"]: r for r in chat.transcripts(spark.createDataFrame(log, LOG)).withColumn("back", chat.read_back(F.col("formatted"))).withColumn("t", chat.trained_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [tuple(t) for t in out[1]["back"]] == [("user", "Hello"), ("assistant", "final"), ("user", "fixed <|im_end|> \\ ok!")]
    assert out[1]["t"] == "final" and out[1]["formatted"].count(chat.END) == 3
    assert [tuple(t) for t in out[None]["back"]] == [("", "x")]
    assert chat.transcripts(spark.createDataFrame([], LOG)).count() == 0


def test_chat_round_trip(spark):
    r = random.Random(2)
    parts = ["<|im_start|>", "<|im_end|>", "\\", "\\s", "\\n", "\n", "<|", "<\\|", "p", "é😀", "assistant\n"]
    rows = [(i % 40, i, "message", i, r.choice(["user", "assistant", "a\nb", "<|", "\\"]), "".join(r.choices(parts, k=r.randrange(6)))) for i in range(400)]
    out = chat.transcripts(spark.createDataFrame(rows, LOG)).select("conv_id", chat.read_back(F.col("formatted")).alias("b"), chat.trained_text(F.col("formatted"), F.col("loss_spans")).alias("t"))
    for x in out.collect():
        own = [row for row in rows if row[0] == x["conv_id"]]
        assert [tuple(t) for t in x["b"]] == [(row[4], row[5]) for row in own]
        assert x["t"] == "".join(row[5] for row in own if row[4] == "assistant")


# --- personal data, licenses, quality, edits ----------------------------------------------


def test_pii_takes_time_in_proportion_to_the_text():
    import time

    model = pii.fit(*map(np.array, zip(*[([float(i % 7)] * len(pii.FEATURES), i % 2) for i in range(200)])))
    for unit in ("x", "1", ".", "x@", "+1", "1.", "a.", "x(at)", "1 ", "- ", "@.a", "a@b", "1234 5678 9012 3456 "):
        text = "1 " + unit * (1_000_000 // len(unit)) + " b@c.de"
        start = time.process_time()
        pii.base_spans(text)
        proposed = pii.candidates(text)
        assert time.process_time() - start < (1 if len(unit) == 1 else 8), unit
        if len(proposed) < 1000:
            assert pii.all_spans(text, model)[0][0][0] == "email"


def test_pii_sample_is_bounded_and_blind_to_copies(spark):
    mixed = [f"call +1 555 {i:03d} 4567 or {i}.2.3.4, not 1234 5678 9012 {i:04d}" for i in range(50)]
    once = spark.createDataFrame([(t,) for t in mixed], "text string")
    copied = once.unionByName(spark.createDataFrame([(mixed[0],)] * 3000, "text string"))
    a, b = pii.train(once), pii.train(copied)
    assert a.thresholds == b.thresholds and a.trees.prior == b.trees.prior
    x, _ = pii.labelled("b@c.de, 1.2.3.4 and (555) 123-4567; " * 20_000)
    assert len(x) <= pii.PER_TEXT


def test_pii_odd_rows(spark, odd, none):
    model = pii.train(odd)
    found = pii.find(odd, model)
    assert found.count() == 8 and {r["lang"] for r in found.collect()} == {"en", "fr", None}
    masked = pii.redact(odd, model)
    assert masked.filter("doc_id = 5 AND text = 'same text here' AND n_spans = 0").count() == 2 and masked.count() == 8
    assert pii.find(none, pii.train(none)).count() == 0 and pii.redact(none, pii.train(none)).count() == 0


def test_pii_trees_on_held_out_candidates():
    r = random.Random(4)
    texts = []
    for i in range(400):
        phone = f"+1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}"
        mail = f"{r.choice('abc')}x{i}@mail{i % 9}.example.com"
        texts.append(f"la la {phone} tum {mail} te {r.randrange(10**12)} and v{i}.{i % 7} of 12.{i} in 2021-03-04")
    x, y = [], []
    for t in texts[:300]:
        a, b = pii.labelled(t)
        x += a
        y += b
    model = pii.fit(np.array(x), np.array(y))
    hits = 0
    for i, t in enumerate(texts[300:]):
        phone, mail = t.index("+1 ("), t.index("tum ") + 4
        spoken = t[:phone] + t[phone + 3 : mail] + t[mail:].replace("@", " (at) ", 1)
        base, every = pii.all_spans(spoken, model)
        assert base == []
        hits += {k for k, _, _ in every} == {"phone", "email"}
        assert pii.all_spans("version 1.2.3 of 2021-03-04, page 12 to 99, 1234567", model) == ([], [])
    assert hits >= 90


def test_licenses_odd_rows(spark, odd, none):
    assert licenses.scan(odd).filter(F.size("findings") > 0).count() == 0
    assert licenses.scan(none).count() == 0
    spoilt = "x " + licenses.TEMPLATES["MIT"].replace("software", "sofware zz", 1) + " Released under the MIT License. y"
    found = licenses.scan_text(spoilt, licenses.Index(licenses.TEMPLATES))
    assert [f[0] for f in found] == ["MIT", "MIT-line"] and found[0][1] < 1 == found[1][1]
    assert spoilt[found[1][2] : found[1][3]] == "Released under the MIT License"


def test_licenses_repeated_back_to_back():
    index = licenses.Index(licenses.TEMPLATES)
    line = "foo: Released under the MIT License.\n"
    found = licenses.scan_text(line * 1000, index)
    assert found == [("MIT-line", 1.0, k * len(line) + 5, (k + 1) * len(line) - 2) for k in range(1000)]
    for name, text in licenses.TEMPLATES.items():
        assert [f[0] for f in licenses.scan_text(f"{text} " * 3, index)] == [name] * 3
    mixed = ["CC-BY-4.0-line", "MIT-line", "CC-BY-SA-4.0-line", "Apache-2.0-line", "CC-BY-NC-4.0-line", "CC-BY-4.0-line"] * 20
    assert [f[0] for f in licenses.scan_text(" ".join(licenses.TEMPLATES[m] for m in mixed), index)] == mixed


def test_licenses_alignments_equal_aligning_again_left_and_right():
    r = random.Random(6)

    def again(template, words, shift, band, least, base=0):
        matched, first, end = licenses.align(template, words, shift, band)
        if matched < least:
            return []
        return [
            (matched, base + first, base + end),
            *again(template, words[:first], shift, band, least, base),
            *again(template, words[end:], shift - end, band, least, base + end),
        ]

    for _ in range(300):
        template = [r.randint(1, 6) for _ in range(r.randint(4, 9))]
        words = [w for _ in range(r.randint(1, 8)) for w in [*template, *r.choices(range(9), k=r.randint(0, 3))] if r.random() < 0.95]
        shift, band = r.randint(-2, len(words)), r.choice([3, 8, 60])
        expected = again(template, words, shift, band, len(template))
        found = licenses.align_all(template, words, shift, band, len(template))
        assert set(expected) <= set(found)
        assert sum(b - a for _, a, b in found) == len({i for _, a, b in found for i in range(a, b)})


def test_quality_odd_rows(spark, odd, none):
    judged = quality.filter_quality(odd)
    assert judged.count() == 8 and judged.filter("kept").count() == 0
    assert quality.filter_quality(none).count() == 0


def test_quality_sketches_add_up(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.when(F.col("id") % 2 == 0, "a").alias("source"),
        F.concat(F.repeat(F.lit("abcde fghij klm "), 40), F.col("id").cast("string"), F.repeat(F.lit("#"), (F.col("id") % 5).cast("int"))).alias("text"),
    )
    measured = quality.measure(docs)
    whole = quality.merge(quality.sketch(measured))
    parts = quality.merge(quality.sketch(measured.filter("doc_id < 100")).unionByName(quality.sketch(measured.filter("doc_id >= 100"))))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def test_quality_fence_adapts(spark):
    import string

    r = random.Random(8)
    text = lambda n: " ".join("".join(r.choices(string.ascii_lowercase, k=n)) for _ in range(120))
    rows = [(i, "en", "plain", text(5)) for i in range(150)] + [(150 + i, "de", "dense", text(14)) for i in range(150)] + [(999, "en", "plain", text(14))]
    kept = {x["doc_id"] for x in quality.filter_quality(spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")).filter("kept").collect()}
    assert kept == set(range(300))


def test_edit_counts_odd_rows(spark, odd, none):
    path = vocabulary("byte_bpe_50k.tiktoken")
    edits = "array(named_struct('start', CAST(NULL AS BIGINT), 'end', 5L, 'text', CAST(NULL AS STRING)), named_struct('start', 10000000L, 'end', 3L, 'text', ' z'), NULL)"
    out = edit_counts.count(odd.withColumn("edits", F.when(F.col("doc_id") != 3, F.expr(edits))), path).collect()
    for r in out:
        text = r["text"] or ""
        want = text if r["doc_id"] in (3, None) else text[5:] + " z"
        assert r["edited"] == want and r["n_chars"] == len(want)
        assert r["n_tokens"] == len(edit_counts.counter(path)._encoding.encode_ordinary(want))
    assert edit_counts.count(none.withColumn("edits", F.expr(edits)), path).count() == 0


def test_edit_counts_random_edits():
    counts = edit_counts.counter(vocabulary("byte_bpe_50k.tiktoken"))
    r = random.Random(6)
    for _ in range(60):
        text = "".join(r.choice(["ab", " ", "  ", "\n", "é", "'s", "12", ",", "日 "]) for _ in range(r.randrange(400)))
        tree = edit_counts.Tree(text, counts)
        for _ in range(8):
            a = r.randrange(len(text) + 1)
            b, new = a + r.choice([0, 1, 30]), r.choice(["", " ", "x y", "\n\n", " 's"])
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text == text and tree.n_tokens == len(counts._encoding.encode_ordinary(text))


# --- revisits and the join ---------------------------------------------------------------


CAPTURE = "capture_id long, kind string, url string, ts long, status int, headers map<string,string>, payload string"


def test_revisits(spark):
    rows = [
        (1, "response", "HTTP://Host:80/a?b=2&a=1#x", 10, 200, {"ETag": '"v1"', "Content-Type": "t", "Date": "d1"}, "one"),
        (2, "response", "http://host/a?a=1&b=2", 20, 404, {}, "error"),
        (3, "response", "http://host/a?a=1&b=2&utm_x=1", 30, 200, {"etag": 'W/"v2"', "ETAG": "second", "X": "y"}, "two"),
        (4, "revisit", "http://host/a?b=2&a=1", 25, 304, {"ETag": 'W/"v1"', "Date": "d2", "Content-Type": "no"}, None),
        (5, "revisit", "http://host/a?b=2&a=1", 35, 304, {"ETag": '"v1"'}, None),
        (6, "revisit", "http://host/a?b=2&a=1", 35, 304, None, None),
        (7, "revisit", "http://host/a?b=2&a=1", 5, 304, {"ETag": '"v1"'}, None),
        (8, "revisit", None, None, 304, {"ETag": '"v1"'}, None),
        (8, "revisit", None, None, 304, {"ETag": '"v1"'}, None),
    ]
    out = sorted(revisits.resolve(spark.createDataFrame(rows, CAPTURE)).collect(), key=lambda r: r["capture_id"])
    assert [(r["capture_id"], r["outcome"], r["response_id"], r["payload"]) for r in out] == [
        (4, "resolved", 1, "one"), (5, "mismatch", 3, None), (6, "unchecked", 3, None), (7, "missing", None, None),
        (8, "missing", None, None), (8, "missing", None, None),
    ]
    assert out[0]["headers"] == {"etag": 'W/"v1"', "date": "d2", "content-type": "t"}
    assert revisits.resolve(spark.createDataFrame([], CAPTURE)).count() == 0


def test_jaccard_odd_rows(spark, odd, none):
    rows = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.join(odd).collect()), key=str)
    assert rows == sorted([(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 5, 2), (5, 5, 2), (6, 5, 2), (None, None, 0)], key=str)
    assert jaccard.keep_one(odd).count() == 6
    assert jaccard.join(none).count() == 0 == jaccard.keep_one(none).count()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    got = {r["row"]: r["root"] for r in similar.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1 == len({got[i] for i in range(100, 150)}) and got[0] != got[100]


def test_edit_batches_encode_only_what_they_touch(spark):
    """Trees are stored between batches; a long insertion is split into leaves, so a later edit is as cheap as in a text built whole."""
    path = vocabulary("byte_bpe_50k.tiktoken")
    encoding = edit_counts.counter(path)._encoding
    r = random.Random(6)
    texts = {0: "", 1: None, 2: " ".join(f"word{i}" for i in range(5000)), 3: "a\n\n b  c", 4: "one two"}
    stored = edit_counts.build(spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("leaves", F.lit("clash")), path).drop("text")
    assert {x["doc_id"]: x["n_tokens"] for x in stored.collect()} == {i: len(encoding.encode_ordinary(t or "")) for i, t in texts.items()}
    texts = {i: t or "" for i, t in texts.items()}
    for batch in range(4):
        edits = {}
        for i, t in texts.items():
            if batch == 0 and i == 0:
                edits[i] = [(0, 0, " ".join(f"w{k}" for k in range(20_000)))]
                continue
            edits[i] = []
            for _ in range(3):
                at = r.randrange(len(t) + 1)
                edits[i].append((at, at + r.randrange(4), r.choice(["x", "", " new words ", "\n", "é 12"])))
        rows = spark.createDataFrame(list(edits.items()), "doc_id long, edits array<struct<start:long,end:long,text:string>>")
        stored = scaling.materialize(edit_counts.apply(stored.drop("edits").join(rows, "doc_id"), path))
        for i, changes in edits.items():
            for start, end, new in changes:
                texts[i] = texts[i][:start] + new + texts[i][max(start, end) :]
        for x in stored.select("*", edit_counts.text_of(F.col("leaves")).alias("now")).collect():
            i = x["doc_id"]
            assert x["now"] == texts[i] and x["n_tokens"] == len(encoding.encode_ordinary(texts[i])) and x["n_chars"] == len(texts[i])
            if batch:
                assert x["encoded_chars"] < 3000
    none = stored.limit(0)
    assert edit_counts.apply(none, path).count() == 0 and edit_counts.build(none.withColumn("text", F.lit("")), path).count() == 0
