"""Texts that broke an operator once: few words in a chunk, structured texts, many hits."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changefold.llm import bpe, decontam, licenses, lines, minhash, quality, secret_scan, substrings, words

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def thue_morse(a, b, n):
    text = "".join(b if bin(k).count("1") % 2 else a for k in range(n))
    return text, "".join(a if x == b else b for x in text)


def table(spark, texts):
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


@pytest.mark.parametrize("n", range(21))
def test_work_functions_on_few_words(n):
    """Each alone in a chunk, as it comes in a small split."""
    text = " ".join(f"w{k}" for k in range(n))
    column = pa.array([text], pa.large_string())
    assert quality.measures(column)[0].tolist() == [n]
    anchor, many = (x.to_pylist()[0] for x in substrings.anchors(column))
    assert len(anchor) == len(set(anchor)) and sum(many) == max(0, n - 12)
    assert minhash.sketches(column)[0].tolist() == [max(n - 4, min(n, 1))]
    assert len(lines.keys(column)[0].to_pylist()[0]) == min(n, 1)
    items = decontam.Items(["i"], column)
    found = decontam.told(column, *decontam.search(column, items))
    assert found[0].tolist() == [n] and found[3] == ([["i"]] if n else [[]])
    assert [(m["item_word"], m["doc_word"], m["n_words"]) for m in found[4][0]] == ([(0, 0, n)] if n else [])


def test_operators_on_one_partition_of_few_words(spark):
    docs = table(spark, ["hello world"])
    bench = spark.createDataFrame([("i", "hello")], "item_id string, text string")
    for out in (
        bpe.digests(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id"]), licenses.scan(docs, keep=["doc_id"]),
        decontam.scan(docs, bench, keep=["doc_id"])[0], substrings.dedup(docs), minhash.groups(docs), lines.dedup(docs),
        secret_scan.scan(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id"]), quality.judge(docs),
    ):
        assert out.count() == 1
    assert quality.keep_good(docs).count() == 0


@pytest.mark.parametrize(("a", "b", "n"), [("0", "1", 1024), ("-", "=", 1024), ("ab", "ba", 2048)])
def test_words_in_thue_morse_order_are_told_apart(a, b, n):
    one, other = thue_morse(a, b, n)
    found = words.Words(pa.array([one, other], pa.large_string()), words.PLAIN, False)
    assert len(set(found.hashes().tolist())) == 2
    h1, h2 = words.Lines(found).keys()
    assert h1[0] != h1[1] and h2[0] != h2[1]
    sequence = words.Words(pa.array([" ".join(one), " ".join(other)], pa.large_string()), words.PLAIN, False)
    both = words.sequence_hashes(sequence.hashes(), sequence.first[:-1], sequence.first[1:])
    assert both[0] != both[1]


def test_structured_texts_in_the_operators(spark):
    """The two words are no copies of each other in any operator."""
    one, other = thue_morse("-", "=", 1024)
    texts = [one] * 9 + [other]
    kept = {r.doc_id: r for r in lines.dedup(table(spark, texts)).collect()}
    assert all(r.n_dropped == 0 for r in kept.values())
    judged = quality.judge(table(spark, [f"{one}\n{other}\n{' '.join('abcdefghij')}"])).first()
    assert judged.n_dup_lines == 0 and judged.kept
    one, other = thue_morse("0", "1", 1024)
    bench = spark.createDataFrame([("i", one), ("j", " ".join([one] * 10))], "item_id string, text string")
    found, names = decontam.scan(table(spark, [other, " ".join([other] * 12)]), bench, keep=["doc_id"])
    assert all(r[names[3]] == [] for r in found.collect())
    near = minhash.groups(table(spark, [" ".join([x] + list("abcd")) for x in (one, other)])).collect()
    assert sorted(r.component_id for r in near) == [0, 1]
    sub = substrings.dedup(table(spark, [" ".join([x] + list("abcdefghijkl")) for x in (one, other)])).collect()
    assert [r.n_removed for r in sub] == [0, 0]


def test_long_periodic_texts(spark):
    """One anchor and 100,000 windows: stretches stay short, and every window is judged."""
    texts = ["0 " * 100_000, "0 " * 100_000 + "1", "a b c d e f " * 20_000, "x " + "a b c d e f " * 5_000]
    found = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.dedup(table(spark, texts)).collect()}
    assert found == {0: (100_000, 0), 1: (100_001, 100_000), 2: (120_000, 0), 3: (30_001, 30_000)}
    column = pa.array(texts[:1], pa.large_string())
    asked = substrings.anchors(column)[0]
    stretched = [len(w) // substrings.SYMBOL for w in substrings.stretches(
        column, asked, pa.array([[1]], pa.list_(pa.int32())))[-1]]
    assert max(stretched) <= substrings.LONGEST + substrings.WINDOW - 1


def test_many_licences_in_one_text(spark):
    docs = spark.createDataFrame([("CC BY 4.0, " * 20_000,), ("GNU GPL v3 and MIT License, see " * 3_000,)], "text string")
    licenses.scan(docs, keep=[]).collect()
    start = time.perf_counter()
    first, second = licenses.scan(docs, keep=[]).collect()
    assert time.perf_counter() - start < 5
    assert [(d.start, d.end, d.label) for d in first.detections] == [(4 * k, 4 * k + 4, "cc-by-4.0") for k in range(20_000)]
    assert Counter(d.label for d in second.detections) == {"gpl-3": 3_000, "mit": 3_000}


ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)


def base_spans(text):
    """The contract read by Python's own regexes."""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def test_base_spans_of_secrets(spark):
    """On the given texts and on shapes at the borders of the rules."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    more = ["password=short", 'API_KEY: "abcdefgh"', "apikey  =  '12345678", "token:token:abcdefgh", "AKIAAKIA" + "B" * 8,
            "é" * 9 + "Secret = a.b_c-d/e+f=", "f" * 31, "F" * 40, "x" + "0" * 32 + "g", "passwd\n=abcdefgh", None, ""]
    docs = docs.unionByName(spark.createDataFrame(list(enumerate(more, 10**9)), "doc_id long, text string"))
    rows = docs.collect()
    found = secret_scan.scan(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id"]).select(
        "doc_id", F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex")).alias("spans"))
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in found.collect()}
    assert got == {r.doc_id: base_spans(r.text or "") for r in rows}
    assert sum(map(len, got.values())) > 10
    # Invented prose has long words, but no random strings beside the planted shapes.
    spans = secret_scan.scan(docs.filter("doc_id < 1000000000"), RANKS, public_tokenizers.PATTERN, keep=["doc_id"])
    assert spans.filter(F.exists("spans", lambda s: s["kind"] == "random")).count() == 0


def test_digest_of_base_spans(spark):
    told = secret_scan.told(F.array(F.struct(
        F.lit("hex").alias("kind"), F.lit(3).alias("start"), F.lit(35).alias("end"))))
    got = spark.range(1).select(F.sha2(told.cast("binary"), 256)).first()[0]
    assert got == hashlib.sha256(b"hex:3:35").hexdigest()


def near_copies(n, tail):
    """A cluster of n texts, some unlike the first of them but like the others, and strangers."""
    base = [f"w{k}" for k in range(40)]
    texts = [" ".join(base[:36] + [f"x{k}", *base[37:]]) for k in range(n)]
    # A chain that the pivot does not reach: each shares most of its words with the next.
    texts += [" ".join([*(f"t{j}" for j in range(4 * k)), *base[4 * k:]]) for k in range(tail)]
    return texts + [" ".join(f"{k}y{j}" for j in range(12)) for k in range(5)]


def grouped(spark, texts):
    found = minhash.groups(table(spark, texts)).collect()
    return {r.doc_id: r.component_id for r in found}


def exact_groups(texts):
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    up = list(range(len(sets)))

    def top(i):
        return i if up[i] == i else top(up[i])

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return {i: top(i) for i in range(len(sets))}


@pytest.mark.parametrize("block", [2048, 7])
def test_lists_of_several_blocks_have_a_pivot(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = near_copies(40, 4)
    assert grouped(spark, texts) == exact_groups(texts)


def test_a_cluster_costs_as_much_as_its_classes(spark, monkeypatch):
    """Rows that go into blocks, with lists of several blocks: none but for the strangers."""
    monkeypatch.setattr(minhash, "BLOCK", 10)
    seen = []

    def counting(df, keys, work, fields, **more):
        seen.append((work.__name__, df.count()))
        return real(df, keys, work, fields, **more)

    real = minhash.in_groups
    monkeypatch.setattr(minhash, "in_groups", counting)
    sizes = {}
    for n in (60, 120):
        seen.clear()
        grouped(spark, near_copies(n, 0))
        sizes[n] = dict(seen)
    assert sizes[120]["with_pivot"] < 2.3 * sizes[60]["with_pivot"]
    assert sizes[120]["may_be_alike"] < 200 and sizes[120]["links"] < 200


def with_passage(n):
    """n texts with a passage in common that are unlike each other, each third with a near copy."""
    passage = [f"p{k}" for k in range(24)]
    texts = [" ".join(passage + [f"{k}q{j}" for j in range(60)]) for k in range(n)]
    return texts + [t + " more" for t in texts[::3]]


@pytest.mark.parametrize("block", [40, 7])
def test_a_passage_of_many_unlike_texts(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = with_passage(60)
    assert grouped(spark, texts) == exact_groups(texts)


def test_a_passage_costs_as_much_as_its_texts(spark, monkeypatch):
    """Rows that go into blocks, with a passage in so many texts that its lists have many."""
    monkeypatch.setattr(minhash, "BLOCK", 20)
    real, sizes = minhash.in_groups, {}
    for n in (90, 180):
        rows = []

        def counting(df, keys, work, fields, rows=rows, **more):
            if work is minhash.may_be_alike:
                rows.append(df.count())
            return real(df, keys, work, fields, **more)

        monkeypatch.setattr(minhash, "in_groups", counting)
        assert len(set(grouped(spark, with_passage(n)).values())) == n
        sizes[n] = sum(rows)
    assert sizes[180] < 2.5 * sizes[90]


def longest(text, items, window=10):
    """Every maximal verbatim match of a window or more, by trying all pairs of places."""
    doc, out = text.split(), []
    for i, item in items:
        words = item.split()
        least = min(window, len(words))
        for p in range(len(doc)):
            for q in range(len(words)):
                if p and q and doc[p - 1] == words[q - 1]:
                    continue
                n = 0
                while p + n < len(doc) and q + n < len(words) and doc[p + n] == words[q + n]:
                    n += 1
                if n >= least > 0:
                    out.append((i, q, p, n))
    return sorted(out, key=lambda m: (m[2], m[3], m[0], m[1]))


@pytest.mark.parametrize(("block", "pairs"), [(decontam.BLOCK_BYTES, decontam.PAIRS), (60, 5)])
def test_longest_matches_and_their_places(spark, monkeypatch, block, pairs):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontam, "PAIRS", pairs)
    rng = random.Random(4)
    items = [("a", " ".join(f"w{k}" for k in range(30))), ("b", " ".join(f"w{k}" for k in range(12, 40))),
             ("c", "x y"), ("d", "z " * 14), ("e", "")]
    texts = [items[0][1], f"u {items[1][1]} v {items[0][1]}", " ".join(f"w{k}" for k in range(5, 14)),
             "x y x y", "z " * 40, "q " + "z " * 13, ""]
    for _ in range(12):
        cut = [" ".join(t.split()[(k := rng.randint(0, 20)):k + rng.randint(3, 25)]) for _, t in rng.choices(items, k=4)]
        texts.append(" ".join(cut))
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows, names = decontam.scan(table(spark, texts + texts[:3]), bench, keep=["doc_id", "text"])
    for r in rows.collect():
        assert [tuple(m) for m in r[names[4]]] == longest(r.text, items), r.text
