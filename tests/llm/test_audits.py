"""Source divergence, filter interaction and URL filters against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from changefold.llm import divergence, filter_audit, url_filter
from tests.llm.test_corners import SCHEMA

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def corpus():
    """Rows of id, text, lang and source: nulls, empty and long texts, repeats, ties, copies."""
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in "aéBcXz" for b in ("", "a", "b", "ß", "Q")]
    rows = []
    for k in range(160):
        text = " ".join(rng.choice(vocabulary) + rng.choice(["", " ", "7", "-", "\n"]) for _ in range(rng.randint(0, 90)))
        rows.append((k, text, rng.choice(["en", "en", "en", "de", None]), rng.choice(["s0", "s0", "s0", "s1", "é", None])))
    rows += [(k, "the same text of some words for all of these rows", "en", "s0") for k in range(200, 230)]
    rows += [(300, None, "en", "s2"), (301, "", "xx", "only"), (302, "1 2 3", "yy", "a"), (303, "one", "yy", "b"),
             (None, "the same text of some words for all of these rows", "en", "s1"), (200, "repeated id", "en", "s1"),
             (None, None, None, None), (304, "word " * 30000, "en", "s1"), (305, "A" * 5000, "en", "s2"),
             (306, "# " * 60, "en", "s2"), (306, "# " * 60, "en", "s2")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    """Beside the columns that are read, some whose names the operators use themselves."""
    rows = [(i, t, lang, source, len(t or ""), 7, "x", 1.5) for i, t, lang, source in corpus]
    return spark.createDataFrame(rows, SCHEMA + ", mask int, part string, term double").repartition(5)


def divergent(rows, min_docs=10, ranks=10):
    """The contract in plain integers."""
    found, in_docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        words = Counter(TERM.findall(low(text)))
        found[lang or "", source or ""].update(words)
        in_docs[lang or ""].update(words.keys())
    out = []
    for lang in {x for x, _ in found}:
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        own = {s: found[x, s] for x, s in found if x == lang}
        total = {t: sum(c[t] for c in own.values()) for t in kept}

        def share(counts):
            of = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (of + 2 * len(kept)) for t in kept}

        q_lang, p = share(total), {s: share(c) for s, c in own.items()}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in own:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(f(p[s][t], q_lang[t]), t) for t in kept if own[s][t] and p[s][t] > q_lang[t]]
            for part, values, most in (("pair", pairs, None), ("term", terms, ranks)):
                values.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(values[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize(("segment", "block", "held"), [(1024, 256, 400_000), (4, 2, 20)])
def test_divergence(docs, corpus, monkeypatch, segment, block, held):
    """One segment and block, then many of a few terms and sources each."""
    for name, value in (("SEGMENT", segment), ("BLOCK", block), ("HELD", held), ("WALKED", 16 * segment)):
        monkeypatch.setattr(divergence, name, value)
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == divergent(corpus)


def test_divergence_of_few_rows(spark, docs):
    assert divergence.audit(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(1, None, None, None, 0), (2, "", None, "b", 0)], SCHEMA)
    assert sorted(tuple(r) for r in divergence.audit(one).collect()) == [
        ("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]
    assert divergence.audit(one.limit(1)).count() == 0


def test_equal_stretches_are_one_node():
    """Sources with the same counts share their whole tree, others what is equal in them."""
    counts = np.zeros((3, 64), np.int64)
    counts[:, 5], counts[2, 40] = 3, 1
    trees = divergence.Trees(counts, 64)
    assert trees.roots[0] == trees.roots[1] != trees.roots[2]
    # All zeros, one with the 3 on its path, and one with the 1, at each level.
    assert [len(left) for left, _ in trees.levels] == [3, 3, 3, 3, 3, 2]
    assert divergence.Trees(np.zeros((2, 0), np.int64), 0).distances(
        np.array([0]), np.array([1]), np.array([0, 0]), 0).tolist() == [0]


def test_shares_of_large_counts_are_exact():
    rng = random.Random(3)
    for _ in range(300):
        terms, of = rng.randint(1, 10**9), rng.randint(1, 10**15)
        n = rng.choice([0, of, rng.randint(0, of)])
        assert divergence.shares(np.array([n]), np.array([of]), terms).tolist() == [
            1 + 10**9 * (n + 2) // (of + 2 * terms)]


def audited(rows, good, toxic):
    """Each order of the filters, applied one after the other."""
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    parts = defaultdict(list)
    for i, text, _, source in rows:
        text, words = text or "", PLAIN.findall(text or "")
        fails = {f for f, bad in (
            ("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)), ("D", re.search(r"[#$%&*|]", text)),
            ("E", i is not None and first[text] < i)) if bad}
        parts[source or ""].append((fails, i in good, i in toxic))
    out = {}
    for part, members in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = members
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[0]]
                left = [m for m in left if f not in m[0]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in m[0] for m in members) - len(gone),
                    sum(m[0] == {f} for m in members), sum(m[1] for m in gone), sum(m[2] for m in gone), f]
        for key, row in out.items():
            if key[0] == part:
                row[6] = shapley[row[6]]
    return sorted((*key, *row) for key, row in out.items())


@pytest.fixture(scope="module")
def labels(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice([0, 1, None]), rng.choice([0, 0, 1])) for k in range(0, 310, 2)]
    return rows + [(0, 1, 1), (0, 0, 0), (None, 1, 1), (10**6, 1, 1), (306, 1, 0)]


@pytest.mark.parametrize("batch", [10_000, 7])
def test_filter_audit(spark, docs, corpus, labels, batch):
    told = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, part string")
    good, toxic = ({i for i, *y in labels if i is not None and y[k] == 1} for k in (0, 1))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = filter_audit.audit(docs, told).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(tuple(r) for r in found) == audited(corpus, good, toxic)


def test_filter_audit_of_few_rows(spark, docs, labels):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), none).count() == 0
    one = filter_audit.audit(spark.createDataFrame([(None, None, None, None, 0)], SCHEMA), none).collect()
    assert sorted(tuple(r) for r in one) == audited([(None, None, None, None)], set(), set())


def test_postings_are_the_sorted_failing_ids(docs, corpus, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = filter_audit.postings(filter_audit.failing(docs, none)).collect()
    found = Counter(r.ids[k] for r in rows for k in r.places[0])
    assert found == Counter(i for i, t, *_ in corpus if len(PLAIN.findall(t or "")) < 50)
    for r in rows:
        known = [i for i in r.ids if i is not None]
        assert known == sorted(known) and all(x == sorted(x) for x in r.places) and len(r.places) == 7
    assert Counter(r.part for r in rows for _ in r.ids) == Counter(s or "" for *_, s in corpus)


def test_galloping_sets():
    rng = random.Random(2)
    for _ in range(200):
        lists = [np.array(sorted(rng.sample(range(40), rng.randint(0, 20))), np.int64) for _ in range(3)]
        sets = [set(x.tolist()) for x in lists]
        assert filter_audit.merged(lists).tolist() == sorted(set().union(*sets))
        assert filter_audit.beyond(lists[0], lists[1]).tolist() == sorted(sets[0] - sets[1])


URLS = [
    "http://a.example.net/en/1", "http://a.example.net/de/1", "https://EXAMPLE.NET/en/?q", "https://b.example.com/de/x#y",
    "https://b.example.com/DE/x", "http://notexample.net", "http://x.org/fr/", "http://x.org/fr", "ftp://y.org?/fr/", None, "",
    "no scheme", "://", "://net", "://net/", "a://b://c/d", "http://u:p@H.Org:80/fr/a/b?c://d/", "http://É.com/é\n/x",
    "x\nhttp://line.net/\npath#f", "http:///en/", "http://h.co.uk/a", "mailto:x://example.com/de/", "http://a.example.com?/de/"]


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return low(host), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def ruled(host, path):
    fits = [(len(name + start), name + start, what) for what, name, start in url_filter.RULES
            if (host == name or host.endswith("." + name)) and path.startswith(start)]
    return max(fits)[1:] if fits else (None, None)


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(k, u, "x", 3) for k, u in enumerate(URLS)] + [(None, URLS[0], "x", 3), (0, URLS[0], "x", 3)],
                                  "page_id long, url string, host string, n int")
    none = spark.createDataFrame([], "page_id long, good int")
    found = url_filter.judge(pages, none).select("page_id", "host", "path", "rule", "verdict").collect()
    expected = []
    for k, u in [*enumerate(URLS), (None, URLS[0]), (0, URLS[0])]:
        host, path = parsed(u)
        rule, verdict = ruled(host, path)
        expected.append((k, host, path, rule, verdict or "allow"))
    assert Counter(map(tuple, found)) == Counter(expected)
    assert url_filter.judge(pages.limit(0), none).count() == 0


def posteriors(hosts):
    """The beta-binomial levels in plain floats: (share, weight) of each host."""
    def above(host):
        parts = host.split(".")
        width = 2 if len(parts[-1]) == 2 and parts[-2:-1] and parts[-2] in url_filter.SECOND_LEVEL else 1
        return ".".join(parts[-width:]), ".".join(parts[-width - 1:])

    def level(groups, mean):
        excess = sum((y - n * mean[g]) ** 2 - n * mean[g] * (1 - mean[g]) for g, (n, y) in groups.items())
        most = sum((n - 1) * n * mean[g] * (1 - mean[g]) for g, (n, y) in groups.items())
        rho = min(max(excess / most if most else 0.5, 1e-6), 0.5)
        worth = 1 / rho - 1
        return {g: ((y + worth * mean[g]) / (n + worth), n + worth) for g, (n, y) in groups.items()}

    sums = [defaultdict(lambda: (0, 0)), defaultdict(lambda: (0, 0))]
    for host, (n, y) in hosts.items():
        for table, key in zip(sums, above(host), strict=True):
            table[key] = (table[key][0] + n, table[key][1] + y)
    suffixes, domains = sums
    top = (sum(y for _, y in hosts.values()) + 1) / (sum(n for n, _ in hosts.values()) + 2)
    s = level(suffixes, dict.fromkeys(suffixes, top))
    up = {above(h)[1]: above(h)[0] for h in hosts}
    d = level(domains, {x: s[up[x]][0] for x in domains})
    return level(dict(hosts), {h: d[above(h)[1]][0] for h in hosts})


def test_reputation_is_shrunk_towards_the_levels_above(spark):
    """Bad hosts with many labels go, one bad label does not; a new host of a bad domain goes,
    one of a good domain stays; a rule wins over both."""
    rng = random.Random(9)
    hosts = {f"h{k}.spam.com": 0.02 for k in range(12)} | {f"h{k}.fine.com": 0.97 for k in range(12)}
    hosts |= {"bad.fine.com": 0.0, "a.shop.co.uk": 0.9, "b.shop.co.uk": 0.95, "": 0.9}
    pages, outcomes, counts = [], [], defaultdict(lambda: [0, 0])
    for host, share in hosts.items():
        for _ in range(40):
            pages.append((len(pages), f"http://{host}/p" if host else "nowhere"))
            good = int(rng.random() < share)
            outcomes.append((pages[-1][0], good))
            counts[host][0] += 1
            counts[host][1] += good
    for host in ("new.spam.com", "new.fine.com", "once.fine.com", "x.org"):
        pages.append((len(pages), f"http://{host}/fr/p"))
        counts[host] = [0, 0]
    outcomes += [(pages[-2][0], 0), (pages[-2][0], 1), (10**6, 0), (None, 0), (pages[0][0], 7), (pages[-1][0], 0)]
    counts["once.fine.com"], counts["x.org"] = [1, 0], [1, 0]
    found = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string"),
                             spark.createDataFrame(outcomes, "page_id long, good int")).collect()
    told = {r.host: r for r in found}
    exact = posteriors({h: tuple(x) for h, x in counts.items()})
    for host, (share, weight) in exact.items():
        spread = url_filter.SURE * (share * (1 - share) / (weight + 1)) ** 0.5
        assert told[host].n_labelled == counts[host][0]
        assert told[host].share == pytest.approx(share) and told[host].highest == pytest.approx(min(1, share + spread))
        if told[host].rule is None:
            assert told[host].verdict == ("block" if share + spread < url_filter.MIN_GOOD else "allow")
    blocked = {h for h, r in told.items() if r.verdict == "block"}
    assert blocked == {*(f"h{k}.spam.com" for k in range(12)), "new.spam.com", "bad.fine.com"}
    assert told["x.org"].rule == "org/fr/" and told["x.org"].verdict == "allow"
