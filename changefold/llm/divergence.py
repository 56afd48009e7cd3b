"""Source divergence audit with hash-consed segment trees.

For each language the terms that enough of its documents have are kept. A source's counts of
the kept terms are a segment tree over term ids; trees are hash-consed, so that equal counts
of a stretch of terms are one node whichever source has them. The distance of two sources
comes from walking both trees at once: a pair of nodes is priced once, however often it is
met, from the prices of its children, at last from pairs of counts.

Terms are dealt to segments of bounded size by a hash, and each segment has a tree of its
own: languages, segments and blocks of sources are worked on apart, and a segment's
distances are sums that add up. Walks go level by level over all pairs of a segment at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changefold.llm.frames import chunks, ship, texts
from changefold.operators.joins import splittable_join
from changefold.session import materialize

MIN_DOCS = 10
RANKS = 10
SCALE = 1_000_000_000
#: Terms of a segment, about; sources that one task compares with as many others.
SEGMENT = 1024
BLOCK = 256
#: Pairs of a term and a source that a task holds before it hands them on (about 80 MB).
HELD = 400_000
#: Leaf pairs that are walked to at once.
WALKED = 1 << 21
#: Bytes of terms stay, A-Z lower-cased; all others part them.
LETTERS = bytes(b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: A document's mark in the low bits of a count.
MARK = 40


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs): a task's counts; the empty term stands for the group.
    ``batches``: lang, source, text."""
    held: dict[tuple[str, str], dict[bytes, int]] = {}
    size = 0

    def ready() -> pa.RecordBatch:
        langs, sources, terms, both = [], [], [], []
        for (lang, source), found in held.items():
            langs += [lang] * len(found)
            sources += [source] * len(found)
            terms += found.keys()
            both += found.values()
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sources, pa.string()),
             pa.array(terms, pa.binary()).cast(pa.string()),
             pa.array([x >> MARK for x in both], pa.int64()),
             pa.array([x & (1 << MARK) - 1 for x in both], pa.int64())],
            names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for part in chunks(batch, 2):
            for lang, source, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                          texts(part.column(2)).to_pylist(), strict=True):
                if (found := held.get((lang, source))) is None:
                    found = held[lang, source] = {b"": 0}
                before = len(found)
                words = text.encode().translate(LETTERS).split()
                own: dict[bytes, int] = {}
                for w in words:
                    own[w] = own.get(w, 0) + 1
                for w, n in own.items():
                    found[w] = found.get(w, 0) + (n << MARK) + 1
                size += len(found) - before
                if size > HELD:
                    yield ready()
                    size = 0
    if held:
        yield ready()


def term_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
                min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, all_n, first), written: how often each source has each kept
    term, and its language; ``first`` is 1 on one row of each term. The empty term, which is
    never kept, stands for the group itself and has n 0.

    Tasks count before the shuffle, which is one: by language and term.
    """
    ship(docs.sparkSession)
    asked = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a)
                          for c, a in ((lang, "lang"), (source, "source"))], F.col(f"`{text}`").alias("text"))
    dealt = asked.mapInArrow(_counts, "lang string, source string, term string, n bigint, docs bigint").repartition(
        "lang", "term")
    counted = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    place = F.row_number().over(same.orderBy("source"))
    own = F.col("term") != ""
    counted = counted.select(
        "lang", "source", "term", "n", F.sum("docs").over(same).alias("in_docs"), F.sum("n").over(same).alias("all_n"),
        F.when(own & (place == 1), 1).otherwise(0).alias("first"))
    return materialize(counted.filter(~own | (F.col("in_docs") >= min_docs)).drop("in_docs"), "terms")


def groups_of(counts: DataFrame) -> DataFrame:
    """(lang, source, group_n, lang_n, terms, block, blocks), written: each group's and each
    language's occurrences of kept terms, the language's kept terms, and where the group
    stands among the blocks of its language."""
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.sum("first").alias("terms"))
    lang = Window.partitionBy("lang")
    number = F.row_number().over(lang.orderBy("source")) - 1
    return materialize(own.select(
        "lang", "source", "group_n", F.sum("group_n").over(lang).alias("lang_n"),
        F.sum("terms").over(lang).alias("terms"), F.floor(number / BLOCK).cast("int").alias("block"),
        F.ceil(F.count("*").over(lang) / BLOCK).cast("int").alias("blocks")), "groups")


def shares(counts: np.ndarray, of: np.ndarray, terms: int) -> np.ndarray:
    """p of some counts in groups of ``of`` occurrences: 10^9 is three times 1,000, so that
    no step leaves 64 bits."""
    over = of + 2 * terms
    rest, out = counts + 2, np.zeros(len(counts), np.int64)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, over)
        out = out * 1000 + digit
    return out + 1


class Trees:
    """Segment trees of the rows of a matrix of counts, one node for equal subtrees.

    ``values``: the counts at the leaves; ``levels``: children of each node, the lowest
    level first; ``roots``: the node of each row. Beyond the ``size`` columns leaves are -1.
    """

    def __init__(self, counts: np.ndarray, size: int):
        width = 1 << max(0, size - 1).bit_length()
        wide = np.full((len(counts), width), -1, np.int64)
        wide[:, :size] = counts
        self.values, nodes = np.unique(wide, return_inverse=True)
        nodes, known = nodes.reshape(wide.shape), len(self.values)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        while nodes.shape[1] > 1:
            found, after = np.unique(nodes[:, 0::2] * known + nodes[:, 1::2], return_inverse=True)
            self.levels.append((found // known, found % known))
            nodes, known = after.reshape(len(nodes), -1), len(found)
        self.roots = nodes[:, 0]

    def distances(self, x: np.ndarray, y: np.ndarray, of: np.ndarray, terms: int) -> np.ndarray:
        """For each pair of rows the sum of (p - q)^2 / (p + q), floored term by term.

        A price hangs on the pair's sums and its two nodes, so that is what is met once.
        """
        pair, a, b = np.arange(len(x)), self.roots[x], self.roots[y]
        met = []
        below = [len(self.values), *(len(left) for left, _ in self.levels)]
        for (left, right), known in zip(reversed(self.levels), reversed(below[:-1]), strict=True):
            a, b = np.concatenate([left[a], right[a]]), np.concatenate([left[b], right[b]])
            keys, place = np.unique((np.concatenate([pair, pair]) * known + a) * known + b, return_inverse=True)
            met.append(place)
            pair, a, b = keys // (known * known), keys // known % known, keys % known
        one, other = self.values[a], self.values[b]
        price = np.zeros(len(pair), np.int64)
        real = one >= 0
        if real.any():
            p = shares(one[real], of[x[pair[real]]], terms)
            q = shares(other[real], of[y[pair[real]]], terms)
            price[real] = (p - q) ** 2 // (p + q)
        for place in reversed(met):
            half = len(place) // 2
            price = price[place[:half]] + price[place[half:]]
        return price


def _compared(table: pa.Table) -> pa.Table:
    """(lang, one, other, value) of the pairs of a unit: a segment's counts in two blocks.

    Rows without a term tell the unit's sources: n is then the group's sum, ``size`` the
    segment's terms and ``terms`` the language's.
    """
    rows = table.to_pydict()
    heads = {s: (n, b) for s, t, n, b in zip(rows["source"], rows["term"], rows["n"], rows["block"], strict=True) if t is None}
    names = sorted(heads)
    at = {s: i for i, s in enumerate(names)}
    head = rows["term"].index(None)
    size, terms = rows["size"][head], rows["terms"][head]
    known = [(at[s], t, n) for s, t, n in zip(rows["source"], rows["term"], rows["n"], strict=True) if t is not None]
    total: dict[str, int] = {}
    for _, t, n in known:
        total[t] = total.get(t, 0) + n
    # Frequent terms first: the rare ones, and those of neither block, share most subtrees.
    number = {t: k for k, t in enumerate(sorted(total, key=lambda t: (-total[t], t)))}
    counts = np.zeros((len(names), size), np.int64)
    for i, t, n in known:
        counts[i, number[t]] = n
    trees = Trees(counts, size)
    of = np.array([heads[s][0] for s in names], np.int64)
    block = np.array([heads[s][1] for s in names])
    one, other = np.nonzero(np.less.outer(np.arange(len(names)), np.arange(len(names)))
                            & ((block[:, None] != block[None, :]) | (rows["b1"][0] == rows["b2"][0])))
    step = max(1, WALKED // max(1, size))
    value = [trees.distances(one[k:k + step], other[k:k + step], of, terms) for k in range(0, len(one), step)]
    return pa.table({
        "lang": pa.array(rows["lang"][:1] * len(one), pa.string()),
        "one": pa.array([names[i] for i in one], pa.string()), "other": pa.array([names[i] for i in other], pa.string()),
        "value": pa.array(np.concatenate([np.zeros(0, np.int64), *value]))})


def pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the distance of each source to each other one of its
    language, 0 where no term is kept."""
    most = groups.agg(F.max("terms")).first()[0] or 0
    segments = max(1, math.ceil(most / SEGMENT))
    seg = F.pmod(F.xxhash64("term"), F.lit(segments)).cast("int").alias("seg")
    kept = counts.filter("term != ''").select("lang", "source", "term", "n", "first", seg)
    sizes = kept.groupBy("lang", "seg").agg(F.sum("first").alias("size"))
    # A language without kept terms has one segment without any.
    none = groups.filter("terms = 0").select("lang", F.lit(0).alias("seg"), F.lit(0).cast("bigint").alias("size")).distinct()
    heads = splittable_join(groups.select("lang", "source", "group_n", "terms", "block", "blocks"),
                            sizes.union(none), "lang", "inner")
    heads = heads.select(groups["lang"], "seg", "source", F.lit(None).cast("string").alias("term"),
                         F.col("group_n").alias("n"), "block", "blocks", "size", "terms")
    where = groups.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), "block", "blocks",
                          F.xxhash64("lang", "source").alias("of_hash"))
    told = kept.join(where, (F.col("lang") == F.col("of_lang")) & (F.col("source") == F.col("of_source"))
                     & (F.xxhash64("lang", "source") == F.col("of_hash")))
    told = told.select("lang", "seg", "source", "term", "n", "block", "blocks",
                       F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("bigint").alias("terms"))
    # Each block meets each other block of its language, and itself, in a unit of its own.
    units = heads.unionByName(told).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "*", F.least("block", "b").alias("b1"), F.greatest("block", "b").alias("b2"))
    found = units.groupBy("lang", "seg", "b1", "b2").applyInArrow(
        _compared, "lang string, one string, other string, value bigint")
    found = materialize(found.groupBy("lang", "one", "other").agg(F.sum("value").alias("value")), "distances")
    return found.select("lang", F.col("one").alias("source"), F.col("other").alias("item"), "value").unionAll(
        found.select("lang", F.col("other").alias("source"), F.col("one").alias("item"), "value"))


def _share(n: str, of: str):
    top = (F.col(n) + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", top, (F.col(of) + 2 * F.col("terms")).cast("decimal(20,0)")) + 1


def outstanding(counts: DataFrame, groups: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a source has more often than its
    language, those that add most to its distance first."""
    told = groups.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), "group_n", "lang_n",
                         "terms", F.xxhash64("lang", "source").alias("of_hash"))
    rows = counts.filter("term != '' AND n > 0").join(
        told, (F.col("lang") == F.col("of_lang")) & (F.col("source") == F.col("of_source"))
        & (F.xxhash64("lang", "source") == F.col("of_hash")))
    rows = rows.select("lang", "source", F.col("term").alias("item"), _share("n", "group_n").alias("p"),
                       _share("all_n", "lang_n").alias("q")).filter("p > q")
    rows = rows.select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks)


def audit(docs: DataFrame, *, min_docs: int = MIN_DOCS, ranks: int = RANKS, **names) -> DataFrame:
    """(lang, source, part, item, value, rank) of parts ``pair`` and ``term``.

    A null text, language or source is an empty string. Rows are documents, also where they
    repeat an id. A source without terms is compared like any other; a language with one
    source has no pairs. All arithmetic is in integers. No rows give no rows.
    """
    counts = term_counts(docs, min_docs=min_docs, **names)
    groups = groups_of(counts)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    both = pairs(counts, groups).withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair")).unionByName(
        outstanding(counts, groups, ranks).withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", "value", "rank")
