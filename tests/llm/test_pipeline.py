"""The five stages against plain Python over a small corpus with planted cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from changefold.llm import bpe

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = " \t\n\x0b\x0c\r"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def grams(words, n):
    return [tuple(words[k:k + n]) for k in range(len(words) - n + 1)]


def different(rests):
    """How many of some sets are no near copies (a third in common) of one before them."""
    return sum(not any(a == b or 3 * len(a & b) >= len(a | b) > 0 for b in rests[:k]) for k, a in enumerate(rests))


def good(rows):
    """Base rules, then lines that ten texts of a host carry which differ in their other lines."""
    lines, parts = defaultdict(set), {}
    for _, host, text in rows:
        for line in (text or "").split("\n"):
            if words := PLAIN.findall(low(line)):
                key = low(line.strip(BLANK))
                lines[host, key].add(text)
                parts.setdefault(text, {})[key] = set(grams(words, min(5, len(words))))
    found = {at for at, texts in lines.items() if len(texts) >= 10 and different([
        {s for key, x in parts[t].items() if key != at[1] for s in x} for t in sorted(texts)]) >= 10}
    out = []
    for row in rows:
        _, host, text = row
        words = PLAIN.findall(text or "")
        seen = Counter(grams(words, 5))
        hit = {k + d for k, g in enumerate(grams(words, 5)) if seen[g] > 1 for d in range(5)}
        shared = [x for x in (text or "").split("\n") if (host, low(x.strip(BLANK))) in found]
        left = len(words) - sum(len(PLAIN.findall(x)) for x in shared)
        if len(words) >= 10 and 100 * len(hit) <= 20 * len(words) and left >= 10:
            out.append(row)
    return out


def own_lines(rows):
    where = defaultdict(set)
    for i, _, text in rows:
        for line in text.split("\n"):
            where[low(line.strip(BLANK))].add(i)
    return [(i, h, "\n".join(x for x in t.split("\n") if not (k := low(x.strip(BLANK))) or len(where[k]) < 10))
            for i, h, t in rows]


def one_of_each(rows):
    sets = {}
    for i, _, text in rows:
        words = PLAIN.findall(low(text))
        sets[i] = set(grams(words, 5)) or ({tuple(words)} if words else set())
    up = {i: i for i in sets}

    def top(i):
        return i if up[i] == i else top(up[i])

    for a in sets:
        for b in sets:
            if sets[a] and a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return [r for r in rows if top(r[0]) == r[0]]


def unseen(rows, items):
    windows = {g for item in items for words in [ALNUM.findall(low(item or ""))] if words
               for g in grams(words, min(10, len(words)))}
    return [r for r in rows if windows.isdisjoint(
        g for n in {len(w) for w in windows} for g in grams(ALNUM.findall(low(r[2])), n))]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)

    def prose(n):
        return " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(n))

    footer = "All our texts are free to read, é and more"
    item = "Which of these words, in a row, are part of a test that no text may hold?"
    base = prose(80)
    texts = [None, "", " \n\t", "too short", "a b c d e " * 30, base, base, base.replace("a1", "b1"),
             base + " and some more words", prose(40) + " " + item.upper() + " " + prose(20), prose(500)]
    texts += [f"{prose(30)}\n  {footer.upper()}\t\n{prose(12)}" for _ in range(14)]
    texts += [f"{footer}\n{k}" for k in range(3)]
    return [(i, "h" if i % 4 else None, t) for i, t in enumerate(texts)], [item, None, "", "zz9 zz8"]


def test_stages_are_what_plain_python_gives(spark, corpus, tmp_path):
    rows, items = corpus
    docs = spark.createDataFrame([(i, t, "en", h, len(t or "")) for i, h, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(items)], "item_id string, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")

    steps = [good(rows)]
    steps.append(own_lines(steps[-1]))
    steps.append(one_of_each(steps[-1]))
    steps.append(unseen(steps[-1], items))
    assert len(rows) > len(steps[0]) > len(steps[2]) > len(steps[3]) > 10 and steps[0] != steps[1]
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for (name, stage), expected in zip(corpus_pipeline.STAGES, steps, strict=False):
        now = stage(spark, now, str(tmp_path))
        got = {(r.doc_id, r.source, r.text, r.n_chars) for r in now.collect()}
        assert got == {(i, h, t, len(t)) for i, h, t in expected}, name
        now = spark.createDataFrame(now.collect(), docs.schema)

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    expected = set()
    for i, _, text in steps[-1]:
        ids = enc.encode_ordinary(text)
        expected.add((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                      hashlib.sha256(text.encode()).hexdigest()))
    assert {tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == expected
