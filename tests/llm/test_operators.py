"""The operators against plain Python over texts chosen for their corners."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from changefold.llm import bpe, decontam, licenses, lines, minhash, quality, secret_scan, substrings, toxicity, warc

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    words = ["a", "B", "É", "x,", "licence", "the", "\x85", "# |", "😀", "all rights reserved", "CC BY 4.0"]
    base = " ".join(rng.choice(words) + str(k % 23) for k in range(60))
    out = [None, "", " \t", "\n", "a", "a\n\na\n", base, base, base.replace("a7", "b7"), base + "\n" + base,
           "a b " * 3000, "q" * 20000, "Distributed under the GNU General Public License version 2 or later."]
    for _ in range(25):
        out.append("\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))
                             for _ in range(rng.randint(1, 4))))
    return out + ["shared line\n" + str(k) + " own" for k in range(12)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Ids with a null and a repeat; columns whose names the operators use themselves."""
    ids = list(range(len(texts)))
    ids[3], ids[5] = None, 4
    rows = [(i, t, "en", "src0" if k % 3 else None, len(t or ""), 1, "x", "y")
            for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n_words int, drop1 string, found string")


def same(got, expected):
    assert Counter(map(tuple, got)) == Counter(map(tuple, expected))


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_bpe_is_what_tiktoken_gives(docs):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    expected = []
    for i, t in pairs(docs):
        ids = enc.encode_ordinary(t or "")
        expected.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                         hashlib.sha256((t or "").encode()).hexdigest()))
    same(bpe.digests(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id"]).collect(), expected)
    tokens = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id"])
    back = bpe.decode(tokens, RANKS, public_tokenizers.PATTERN, keep=["doc_id"])
    same(back.collect(), [(i, t or "") for i, t in pairs(docs)])
    with pytest.raises(ValueError, match="PATTERN"):
        bpe.digests(docs, RANKS, r"[^ ]+", keep=["doc_id"])
    codec = bpe.codec(RANKS, public_tokenizers.PATTERN)
    assert "".join(codec.pieces(enc.encode_ordinary("é😀中"))) == "é😀中"


def test_license_base_places(docs):
    expected = []
    for i, t in pairs(docs):
        words = ALNUM.findall(low(t))
        at = [(k, label) for phrase, label in licenses.BASE for k in range(len(words))
              if words[k:k + len(phrase.split())] == phrase.split()]
        starts = [k for k, _ in at]
        expected.append((i, len(words), len(at), min(starts, default=None), max(starts, default=None),
                         ",".join(sorted({x for _, x in at}))))
    found = licenses.scan(docs, keep=["doc_id"])
    same(found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",")).collect(), expected)


def test_a_license_inside_another_is_dropped(spark):
    found = licenses.scan(spark.createDataFrame(
        [("GNU General Public License version 2 or later; Apache License 2.0",)], "text string"), keep=[]).first()
    assert found.labels == ["apache-2.0", "gpl", "gpl-2-or-later"]
    assert [(d.start, d.end, d.label) for d in found.detections] == [(0, 8, "gpl-2-or-later"), (8, 12, "apache-2.0")]


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 40])
def test_decontamination(spark, docs, texts, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    items = [("i1", " ".join((texts[6] or "").split()[5:30])), ("i2", "The a"), ("i3", None), ("i1", "own 3"), (None, "b É")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    windows = defaultdict(set)
    for i, t in items:
        words = ALNUM.findall(low(t))
        for k in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[k:k + 10])].add(i)
    expected = []
    for i, t in pairs(docs):
        words, hit, found = ALNUM.findall(low(t)), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if w := windows.get(tuple(words[k:k + size])):
                    hit.update(range(k, k + size))
                    found |= w
        expected.append((i, len(words), len(hit), tuple(sorted(found - {None}))))
    rows, names = decontam.scan(docs, bench.repartition(3), keep=["doc_id"])
    same([(r[0], r[names[0]], sum(r[names[2]]), tuple(r[names[3]])) for r in rows.collect()], expected)
    clean = decontam.clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not e[2] for e in expected)


@pytest.mark.parametrize("crowd", [substrings.CROWD, 1])
def test_substrings(docs, monkeypatch, crowd):
    monkeypatch.setattr(substrings, "CROWD", crowd)
    known = [(i, t) for i, t in pairs(docs) if i is not None]
    owner = {}
    for i, t in known:
        words = PLAIN.findall(t or "")
        for k in range(len(words) - 12):
            w = tuple(words[k:k + 13])
            owner[w] = min(owner.get(w, i), i)
    expected = []
    for i, t in pairs(docs):
        words, gone = PLAIN.findall(t or ""), set()
        for k in range(len(words) - 12):
            if i is not None and owner[tuple(words[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        expected.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    out = substrings.dedup(docs)
    assert out.columns[:len(docs.columns)] == docs.columns
    same([(r[0], r[-2], r[-1], r[1]) for r in out.collect()], expected)


@pytest.mark.parametrize("block_bytes", [minhash.BLOCK_BYTES, 1000])
def test_near_copies(docs, monkeypatch, block_bytes):
    monkeypatch.setattr(minhash, "BLOCK_BYTES", block_bytes)
    sets, up = defaultdict(list), {}
    rows = pairs(docs)
    for i, t in rows:
        words = PLAIN.findall(low(t))
        shingles = frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
        sets[i].append(shingles)
        up[i] = i

    def top(i):
        return i if up[i] == i else top(up[i])

    ids = [i for i in sets if i is not None]
    for a in ids:
        for b in ids:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    seen = Counter()
    expected = []
    for i, _ in rows:
        n = len(sets[i][seen[i]])
        seen[i] += 1
        component = None if i is None else top(i)
        expected.append((i, n, component, component == i))
    same(minhash.groups(docs).collect(), expected)


def test_lines(docs):
    def key(line):
        return low(line.strip(" \t\n\x0b\x0c\r"))

    where = defaultdict(set)
    for i, t in pairs(docs):
        for line in (t or "").split("\n"):
            where[key(line)].add((i, t if i is None else None))
    expected = []
    for i, t in pairs(docs):
        parts = (t or "").split("\n")
        kept = [x for x in parts if not key(x) or len(where[key(x)]) < 10]
        expected.append((i, len(parts), len(parts) - len(kept), "\n".join(kept)))
    out = lines.dedup(docs)
    assert out.columns[:len(docs.columns)] == docs.columns
    same([(r[0], r[-2], r[-1], r[1]) for r in out.collect()], expected)


def test_secrets(spark):
    key = "AKIA" + "Q7" * 8
    text = f'é password = "hunter2secret" {key} token:abc {"0a" * 16} Zx8kQ2vLw9TfB3mNcR7yJd5s some_long_identifier_name_here'
    found = secret_scan.scan(spark.createDataFrame([(text,), (None,), ("",)], "text string"), RANKS,
                             public_tokenizers.PATTERN, keep=[]).collect()
    assert [(s.kind, text[s.start:s.end]) for s in found[0].spans] == [
        ("assign", 'password = "hunter2secret'), ("access", key), ("hex", "0a" * 16), ("random", "Zx8kQ2vLw9TfB3mNcR7yJd5s")]
    assert found[1].spans == found[2].spans == []


def test_random_strings_of_any_shape():
    """Letters alone, 16 characters, and behind words; names and words are none."""
    enc, rng = secret_scan.encoding(RANKS, public_tokenizers.PATTERN), random.Random(1)

    def found(text):
        return [text[a:b] for kind, a, b in secret_scan.spans_of(text, enc) if kind == "random"]

    small = "abcdefghijklmnopqrstuvwxyz"
    for letters, n in ((small, 24), (small + small.upper(), 24), (small + small.upper() + "0123456789", 16)):
        keys = ["".join(rng.choices(letters, k=n)) for _ in range(200)]
        assert sum(found(f"see {key} there") == [key] for key in keys) >= 198
    for before in ("documents/archive/international/information/", "international=", "the_name_of_the_information_archive_"):
        key = "".join(rng.choices(small + small.upper() + "0123456789", k=20))
        assert any(x.endswith(key) for x in found(f"{before}{key}")), before
    for clean in ("internationalization of Donaudampfschiffahrtsgesellschaft", "ACKNOWLEDGEMENTS AND RESPONSIBILITIES",
                  "SparkSessionBuilderFactory.getElementsByTagName", "some_long_identifier_name_here", "=" * 40 + "-" * 40,
                  "documents/archive/international/information", "report-2024-01-15-final-version", "4111111111111111",
                  "123e4567-e89b-12d3-a456-426614174000", "d41d8cd98f00b204e9800998ecf8427e".upper()):
        assert found(clean) == [], clean


def test_warc_round_trip(spark):
    pages = [(1, "http://a/\r\nx", "same"), (2, None, "same"), (2, "u", "same"), (3, "u", ""), (4, "u", None),
             (5, "u", "é" * 70000), (None, "u", "same"), (6, "u", "one")]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    index = warc.write(rows)
    assert index.columns == ["path", "offset", "length", "url", "digest"] and index.count() == len(pages)
    expected = []
    for i, _, html in pages:
        data = (html or "").encode()
        owner = max(p for p, _, h in pages if (h or "") == (html or "") and p is not None)
        expected.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                         "response" if owner == i else "revisit", None if owner == i else owner))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    same(warc.read(index).select(*columns).collect(), expected)
    some = warc.read(index.filter("url = 'u' AND digest IS NOT NULL"))
    assert some.count() == 6
    assert list(warc.ranges([(0, 5), (5, 5), (10 ** 6, 3)])) == [(0, 10, [(0, 5), (5, 5)]), (10 ** 6, 10 ** 6 + 3, [(10 ** 6, 3)])]


def test_quality(docs):
    expected = []
    for i, t in pairs(docs):
        words = PLAIN.findall(t or "")
        grams = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
        hit = {k + d for k in range(len(words) - 4) if grams[tuple(words[k:k + 5])] > 1 for d in range(5)}
        full = [x for x in (t or "").split("\n") if PLAIN.search(x)]
        failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
        expected.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")),
                         len(full) - len(set(full)), len(hit), failed))
    judged = quality.judge(docs)
    same([tuple(r)[:7] for r in judged.collect()], expected)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == judged.filter("kept").count()


def test_templates_of_a_host(spark):
    """Documents that only a host's template makes up go; copies count once."""
    line = "welcome to our site please read the news below and subscribe now"
    rows = [(k, f"{line}\n{k}", "h") for k in range(15)]
    rows += [(100 + k, f"{line}\n" + " ".join(f"w{k}x{j}" for j in range(12)), "h") for k in range(5)]
    rows += [(200 + k, "one and the same clean text of more than ten words in all", "g") for k in range(30)]
    found = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r.doc_id for r in found.filter("kept").collect()} == {*range(100, 105), *range(200, 230)}


def test_templates_of_a_large_host(spark):
    """A line on a few of a host's texts is a template if these differ otherwise; a passage that
    near copies of one text have in common is none."""
    rng = random.Random(3)

    def prose(n):
        return " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 900)}" for _ in range(n))

    line = "Welcome to our site, please read the news below and subscribe"
    rows = [(k, prose(40), "h") for k in range(300)]
    rows += [(300 + k, f"{line}\n{prose(30)}", "h") for k in range(12)]
    rows += [(400 + k, f"{prose(3)}\n {line.upper()}", "h") for k in range(12)]
    # Near copies: three lines each, two words of the last one are others each time.
    first, second, base = prose(12), prose(60), prose(8)
    rows += [(500 + k, f"{first}\n{second}\n{base} {prose(2)}", "h") for k in range(60)]
    # Two template lines on the same short texts, which are unlike each other but for these.
    block = f"{prose(7)}\nto the shop"
    rows += [(800 + k, f"{block}\n{prose(9 if k < 5 else 60)}", "h") for k in range(20)]
    # A line on nine texts only, and one on many texts of another host.
    rows += [(600 + k, f"all of these nine short pages have this line in common\n{prose(3)}", "h") for k in range(9)]
    rows += [(700 + k, f"{line}\n{prose(3)}", f"g{k}") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found, gone = quality.judge(docs), {*range(400, 412), *range(800, 805)}
    assert {r.doc_id for r in found.filter("depleted").collect()} == gone
    assert found.filter("NOT kept").count() == 17
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {r[0] for r in rows} - gone
    # As an output, the texts without these lines; other lines, and other hosts, keep them.
    templates = {line.lower(), block.split("\n")[0], "to the shop"}
    bare = quality.without_templates(docs)
    assert bare.columns[:3] == docs.columns
    texts = {r[0]: (r.text, r[-2], r[-1]) for r in bare.collect()}
    for k, text, host in rows:
        parts = text.split("\n")
        kept = [x for x in parts if host != "h" or x.strip().lower() not in templates]
        assert texts[k] == ("\n".join(kept), len(parts), len(parts) - len(kept)), k


def test_neighbours_are_one_edit_away():
    rng = random.Random(2)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            after = [i + 1]
            for j, y in enumerate(b):
                after.append(min(row[j] + (x != y), row[j + 1] + 1, after[j] + 1))
            row = after
        return row[-1]

    def word(most):
        return "".join(rng.choice("ab") for _ in range(rng.randint(1, most)))

    for _ in range(300):
        terms, asked = {word(6) for _ in range(4)}, word(7)
        assert set(toxicity.Neighbours(terms).of(asked)) == {t for t in terms if distance(t, asked) <= 1}


def test_quotation_is_told_from_abuse():
    lexicon = toxicity.Lexicon({"rotten": 3.0}, {})
    assert [h[4] for h in toxicity.hits("you are rotten rotten", lexicon)[1]] == [False, False]
    assert [h[3:] for h in toxicity.hits('they wrote "rottn" there', lexicon)[1]] == [(True, True)]


def test_empty_tables(spark, docs, tmp_path):
    none = docs.limit(0)
    bench = spark.createDataFrame([], "item_id string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (
        bpe.digests(none, RANKS, public_tokenizers.PATTERN, keep=["doc_id"]), licenses.scan(none, keep=["doc_id"]),
        decontam.clean(none, bench), substrings.dedup(none), minhash.groups(none), lines.dedup(none),
        secret_scan.scan(none, RANKS, public_tokenizers.PATTERN, keep=["doc_id"]), quality.judge(none),
        quality.keep_good(none), toxicity.score(none, toxicity.train(none, labels), keep=["doc_id"]),
        warc.read(warc.write(spark.createDataFrame([], "page_id long, url string, html string"))),
    ):
        assert out.count() == 0
    scores = toxicity.score(docs, toxicity.train(docs, labels), keep=["doc_id"]).collect()
    assert all(0 <= r.score < 0.5 for r in scores)
