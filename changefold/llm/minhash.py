"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set are its distinct five-word shingles; its sketch the smallest ``SKETCH``
of their hashes. Documents with equal sets are one class, and a class is worked on once.
The ``LISTED`` smallest values of a class are kept in inverted lists; classes that meet in
a list are compared on the sketch of their union, those that may be alike on their
whole sets. What comes out of a list are links that hold its alike classes together, not
all its pairs; components of the links are the groups of near copies. In a list of more than
one block all classes are first compared with one of them, and only those that are unlike
it go on to be compared with the list, so that one cluster costs as much as it has classes.
Where these are more than a block still, as with a passage that many unlike texts share, the
list is given up: its classes meet once more, in lists of the rarer values of their sketches.

Two sets with Jaccard 0.75 share none of ``LISTED`` = 8 values with probability 0.25^8, and
the estimate falls below ``SURE`` about once in a million; nothing is capped. The lists of
rarer values hold all pairs that share ``RANKED_SURE`` of the smallest ``RANKED`` values of
their union, which one in 125,000 with Jaccard 0.75 does not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefold.llm.components import smallest_reachable
from changefold.llm.frames import annotate
from changefold.llm.groups import in_groups
from changefold.llm.words import PLAIN, Words, mix, per_text, rolled
from changefold.operators.joins import splittable_join
from changefold.session import materialize

SHINGLE = 5
PERCENT = 75
SKETCH = 64
LISTED = 8
#: Estimates this far below the threshold are four to five standard errors away.
SURE = 0.5
#: Smallest values of a sketch that may go into lists of rarer values, and the share of those of
#: a union that alike classes have in common (13 of 32).
RANKED = 32
RANKED_SURE = 0.4
#: Classes of a list that one task compares with as many others, and bytes of their sets.
BLOCK = 2048
BLOCK_BYTES = 32 << 20
#: Slices of the classes that are compared with one pivot.
SLICES = 64
#: Columns of shingles that are compared in one step.
STEP = 2048


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text behind the other, and their counts.

    A text of fewer words has its whole sequence as its one shingle.
    """
    n = len(column)
    words = Words(column, PLAIN, lower=True)
    hashes, left = words.hashes(), words.left()
    parts, docs = [], []
    for size in range(1, SHINGLE + 1):
        at = left >= SHINGLE if size == SHINGLE else (left == size) & (np.repeat(words.counts, words.counts) == size)
        at = np.flatnonzero(at)
        if len(at):
            parts.append(rolled(hashes, size)[at])
            docs.append(words.doc[at])
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    values, doc = np.concatenate(parts), np.concatenate(docs)
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[new], per_text(doc[new], n)


def _cut(values: np.ndarray, counts: np.ndarray, most: int | None = None) -> list:
    ends = np.cumsum(counts)
    return [values[e - c:e if most is None else e - c + min(c, most)].tobytes() or None
            for e, c in zip(ends, counts, strict=True)]


def sketches(column: pa.Array) -> list:
    """Set size, two hashes of the whole set, its smallest values, and the sketch as bytes."""
    values, counts = shingles(column)
    sums, folded = _set_hashes(values, counts)
    ends = np.cumsum(counts)
    low = [values[e - c:e - c + min(c, LISTED)].view(np.int64) for e, c in zip(ends, counts, strict=True)]
    return [counts, sums, folded, low, _cut(values, counts, SKETCH)]


def _set_hashes(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(values + np.uint64(9)))])
    ends = np.cumsum(counts)
    sums = total[ends] - total[ends - counts]
    folded = np.zeros(len(counts), np.uint64)
    full = counts > 0
    if full.any():
        folded[full] = np.bitwise_xor.reduceat(mix(values + np.uint64(5)), (ends - counts)[full])
    return sums.view(np.int64), folded.view(np.int64)


def whole_sets(column: pa.Array) -> list:
    values, counts = shingles(column)
    return [_set_hashes(values, counts)[0], _cut(values, counts)]


class Joined:
    """Disjoint sets over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


class Overlaps:
    """Sizes of intersections among some sets of values."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        values = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        _, place, count = np.unique(values, return_inverse=True, return_counts=True)
        number = np.cumsum(count > 1) - 1  # only a value of two sets can be in an intersection
        keep = count[place] > 1
        place, owner = number[place[keep]], owner[keep]
        order = np.argsort(place, kind="stable")
        self.place, self.owner = place[order], owner[order]

    def of(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), len(cols)), np.float32)
        total = int(self.place[-1]) + 1 if len(self.place) else 0
        for lo in range(0, total, STEP):
            i, j = np.searchsorted(self.place, [lo, lo + STEP])
            grid = np.zeros((len(self.sets), min(STEP, total - lo)), np.float32)
            grid[self.owner[i:j], self.place[i:j] - lo] = 1
            out += grid[rows] @ grid[cols].T
        return np.rint(out).astype(np.int64)


def _sides(cols: dict) -> tuple[np.ndarray, np.ndarray]:
    """Rows that stand for the group's first block, and for its second (the same if equal)."""
    return (np.flatnonzero(cols["block"] == cols["b1"][0]),
            np.flatnonzero(cols["block"] == cols["b2"][0]))


def may_be_alike(cols: dict) -> list[tuple]:
    """The members of a list's two blocks that may be alike with another one there.

    A pair counts in the list of its smallest common value only, so that it is looked at
    once; whether two classes are alike is estimated on the sketch of their union.
    """
    a, b = _sides(cols)
    if not len(a) or not len(b):
        return []
    sizes, v = cols["n"], cols["v"][:1].view(np.uint64)[0]
    sets = [np.frombuffer(s, np.uint64) for s in cols["sketch"]]
    first = [s[:LISTED] if own is None else np.array(own, np.int64).view(np.uint64)
             for s, own in zip(sets, cols["listed"], strict=True)]
    first = [own[own < v] for own in first]
    tops = np.array([s[-1] if len(s) == SKETCH else np.iinfo(np.uint64).max for s in sets])
    same = cols["b1"][0] == cols["b2"][0]
    whole, lower = Overlaps(sets), Overlaps(first)
    involved = np.zeros(len(sets), bool)
    for lo in range(0, len(a), 256):
        rows = a[lo:lo + 256]
        common = whole.of(rows, b)
        top = np.minimum(tops[rows][:, None], tops[b][None, :])
        held = np.array([np.searchsorted(sets[i], t, "right") for i, t in zip(rows, top, strict=True)])
        held += np.array([np.searchsorted(sets[j], t, "right") for j, t in zip(b, top.T, strict=True)]).T
        ok = (common >= SURE * (held - common)) & (lower.of(rows, b) == 0)
        ok &= (100 * np.minimum.outer(sizes[rows], sizes[b])
               >= PERCENT * np.maximum.outer(sizes[rows], sizes[b]))
        if same:
            ok &= rows[:, None] < b[None, :]
        involved[rows[ok.any(1)]] = True
        involved[b[ok.any(0)]] = True
    return [tuple(cols[k][i] for k in ("turn", "v", "b1", "b2", "block", "c_id", "s1"))
            for i in np.flatnonzero(involved)]


def links(cols: dict) -> list[tuple]:
    """Links that join the alike classes of a list's two blocks, compared on whole sets."""
    a, b = _sides(cols)
    if not len(a) or not len(b):
        return []
    ids = cols["c_id"].tolist()
    sets = [np.frombuffer(s, np.uint64) for s in cols["members"]]
    sizes = np.array([len(s) for s in sets])
    whole, joined, out = Overlaps(sets), Joined(len(ids)), []
    for lo in range(0, len(a), 256):
        rows = a[lo:lo + 256]
        common = whole.of(rows, b)
        union = sizes[rows][:, None] + sizes[b][None, :] - common
        for i, j in zip(*np.nonzero(100 * common >= PERCENT * union), strict=True):
            if joined.join(int(rows[i]), int(b[j])):
                out.append((ids[rows[i]], ids[b[j]]))
    return out


def with_pivot(cols: dict) -> list[tuple]:
    """(p_id, p_s1, c_id, s1) of the members that are alike with their pivot, on whole sets."""
    head = np.flatnonzero(cols["head"])
    if not len(head):
        return []
    pivot = np.frombuffer(cols["members"][head[0]], np.uint64)
    out = []
    for i in np.flatnonzero(cols["head"] == 0):
        own = np.frombuffer(cols["members"][i], np.uint64)
        if PERCENT * max(len(own), len(pivot)) > 100 * min(len(own), len(pivot)):
            continue
        at = np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)
        common = int((pivot[at] == own).sum())
        if 100 * common >= PERCENT * (len(own) + len(pivot) - common):
            out.append(tuple(cols[k][i] for k in ("p_id", "p_s1", "c_id", "s1")))
    return out


def _blocks(classes: Column, shingles: Column) -> Column:
    """Blocks for so many classes with so many shingles in all."""
    return F.greatest(F.ceil(classes / BLOCK), F.ceil(8 * shingles / BLOCK_BYTES)).cast("int")


def _shared(values: DataFrame) -> DataFrame:
    """(v, blocks) of the values that two classes or more have in their lists."""
    often = values.groupBy("v").agg(F.count("*").alias("m"), F.sum("n").alias("all_n")).filter("m > 1").select(
        "v", _blocks(F.col("m"), F.col("all_n")).alias("blocks"))
    return materialize(often, "lists")


def _by_pivot(values: DataFrame, often: DataFrame, sets_of: Callable[[DataFrame], DataFrame],
              ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links with the pivots of lists of several blocks, their members, and what is left of each.

    The pivot is the smallest class. Members that are alike with it hold together through it
    and need not meet each other.
    """
    long = materialize(splittable_join(values, often.filter("blocks > 1"), "v", "inner").select(
        values["v"], "c_id", "s1", "n"), "long-lists")
    pivots = materialize(long.groupBy("v").agg(F.min(F.struct("c_id", "s1")).alias("p")).select(
        "v", F.col("p.c_id").alias("p_id"), F.col("p.s1").alias("p_s1")), "pivots")
    long = materialize(splittable_join(long, pivots, "v", "inner").drop(pivots["v"]), "pivot-lists")
    met = long.filter("c_id != p_id OR s1 != p_s1").select("p_id", "p_s1", "c_id", "s1").distinct()
    met = materialize(met.withColumn("slice", F.pmod(F.xxhash64("c_id", "s1"), F.lit(SLICES)).cast("int")), "pivoted")
    heads = met.select("p_id", "p_s1", "slice").distinct().select(
        "p_id", "p_s1", F.col("p_id").alias("c_id"), F.col("p_s1").alias("s1"), "slice", F.lit(1).alias("head"))
    both = met.withColumn("head", F.lit(0)).unionByName(heads)
    alike = materialize(in_groups(
        both.join(sets_of(both.select("c_id").distinct()), ["c_id", "s1"]), ["p_id", "p_s1", "slice"], with_pivot,
        "p_id bigint, p_s1 bigint, c_id bigint, s1 bigint"), "pivot-links")

    known = alike.unionByName(long.select("p_id", "p_s1", F.col("p_id").alias("c_id"), F.col("p_s1").alias("s1")).distinct())
    known = known.withColumn("held", F.lit(True))
    long = materialize(long.join(known, ["p_id", "p_s1", "c_id", "s1"], "left").select(
        "v", "c_id", "s1", "n", F.coalesce("held", F.lit(False)).alias("held")), "held-lists")
    sizes = long.groupBy("v").agg(*[
        f(F.when(F.col("held") == held, x)).alias(f"{name}_{c}")
        for name, held in (("rest", False), ("others", True))
        for c, f, x in (("m", F.count, F.lit(1)), ("n", F.sum, F.col("n")))]).na.fill(0)
    sizes = sizes.filter("rest_m > 0").withColumns({
        "rest": _blocks(F.col("rest_m"), F.col("rest_n")), "others": _blocks(F.col("others_m"), F.col("others_n")),
        "all": _blocks(F.col("rest_m") + F.col("others_m"), F.col("rest_n") + F.col("others_n"))})
    return alike, long, materialize(sizes, "rests")


def _in_blocks(values: DataFrame, often: DataFrame, long: DataFrame, sizes: DataFrame) -> DataFrame:
    """What is left of the lists, in blocks that meet each other and the others of the list."""
    # Where few hold together, all meet in blocks as one: fewer rows travel.
    apart = F.expr("rest_m * (rest + others) + others_m * rest < (rest_m + others_m) * all")
    sizes = sizes.select("v", apart.alias("apart"), F.when(apart, F.col("rest")).otherwise(F.col("all")).alias("rest"),
                         F.when(apart, F.col("others")).otherwise(0).alias("others"))
    few = splittable_join(values, often.filter("blocks = 1"), "v", "inner").select(
        values["v"], "c_id", "s1", F.lit(False).alias("held"), F.lit(1).alias("rest"), F.lit(0).alias("others"))
    met = splittable_join(long, sizes, "v", "inner").select(
        long["v"], "c_id", "s1", (F.col("held") & F.col("apart")).alias("held"), "rest", "others").unionByName(few)
    own = F.pmod(F.xxhash64("c_id", "s1"), F.when(F.col("held"), F.col("others")).otherwise(F.col("rest"))).cast("int")
    met = met.withColumn("block", F.when(F.col("held"), -1 - own).otherwise(own))
    # A block of the rest meets each other one, itself, and each block (below 0) of the others.
    first = F.when(F.col("held"), F.lit(0)).otherwise(-F.col("others"))
    return met.withColumn("other", F.explode(F.sequence(first, F.col("rest") - 1))).select(
        "v", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"), "block", "c_id", "s1")


def with_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes with the ``RANKED`` smallest values of their sketches as longs."""
    for batch in batches:
        own = [s[:8 * RANKED] for s in batch.column("sketch").to_pylist()]
        ends = np.concatenate([[0], np.cumsum([len(s) // 8 for s in own])]).astype(np.int32)
        values = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(own), np.int64)))
        yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, "own"])


def _rarer(crowd: DataFrame) -> DataFrame:
    """``crowd`` (c_id, s1, n, sketch) and ``listed``, the rarer ones of the smallest values.

    Values of more than a block of the classes go behind the others. In this order, the same
    for all, a class has at most the values that it need not share before the first one that
    it has in common with an alike class: one more is listed, so both list that one.
    """
    held = materialize(crowd.select("c_id", "s1", "n", "sketch").mapInArrow(
        with_values, "c_id bigint, s1 bigint, n bigint, sketch binary, own array<bigint>"), "crowd")
    each = held.select("c_id", "s1", F.explode("own").alias("v"))
    often = materialize(each.groupBy("v").agg(F.count("*").alias("m")).filter(F.col("m") > BLOCK), "common")
    common = splittable_join(each, often, "v", "inner").groupBy("c_id", "s1").agg(
        F.sort_array(F.collect_list(F.struct("m", each["v"])))["v"].alias("common"))
    ranked = F.when(F.col("common").isNull(), F.col("own")).otherwise(
        F.concat(F.array_except("own", "common"), F.col("common")))
    least = F.size("own") - F.ceil(F.size("own") * RANKED_SURE) + 1
    return materialize(held.join(common, ["c_id", "s1"], "left").select(
        "c_id", "s1", "n", "sketch", F.slice(ranked, F.lit(1), least.cast("int")).alias("listed")), "rarer")


def groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Rows that repeat an id are one document in the links and each a row in the result. A
    row without an id is linked with nothing: component_id is null and it is kept. So is a
    text without words, under its own id. No rows give no rows.
    """
    asked = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = materialize(annotate(
        asked, sketches, "n bigint, s1 bigint, s2 bigint, low array<bigint>, sketch binary",
        keep=["doc_id"]), "sketches")

    # Equal sets are one class, named by its smallest id and a hash of the set.
    named = rows.filter("n > 0 AND doc_id IS NOT NULL")
    classes = materialize(named.groupBy("n", "s1", "s2").agg(
        F.min("doc_id").alias("c_id"), F.first("low").alias("low"),
        F.first("sketch").alias("sketch")), "classes")

    def sets_of(need: DataFrame) -> DataFrame:
        """(c_id, s1, members): the whole sets of the classes with the ids ``need``."""
        found = annotate(
            asked.join(need, F.col("doc_id") == F.col("c_id"), "left_semi"), whole_sets,
            "s1 bigint, members binary", keep=["doc_id"])
        return found.filter("members IS NOT NULL").groupBy(F.col("doc_id").alias("c_id"), "s1").agg(
            F.first("members").alias("members"))

    def meet(turn: int, values: DataFrame, often: DataFrame, long: DataFrame, sizes: DataFrame, own: DataFrame) -> DataFrame:
        return materialize(in_groups(
            _in_blocks(values, often, long, sizes).withColumn("turn", F.lit(turn)).join(own, ["c_id", "s1"]),
            ["v", "b1", "b2"], may_be_alike,
            "turn int, v bigint, b1 int, b2 int, block int, c_id bigint, s1 bigint"), "maybe")

    sketch = classes.select("c_id", "s1", "n", "sketch")
    values = classes.select("c_id", "s1", "n", F.explode("low").alias("v"))
    often = _shared(values)
    alike, long, sizes = _by_pivot(values, often, sets_of)
    maybe = meet(0, values, often, long, sizes.filter("rest <= 1"),
                 sketch.withColumn("listed", F.lit(None).cast("array<bigint>")))

    # A list that its pivot leaves with several blocks is given up for those of rarer values.
    crowded = sizes.filter("rest > 1").select("v")
    if crowded.head(1):
        crowd = materialize(long.join(crowded, "v", "left_semi").select("c_id", "s1").distinct(), "crowd-ids")
        listed = _rarer(sketch.join(crowd, ["c_id", "s1"], "left_semi"))
        values = listed.select("c_id", "s1", "n", F.explode("listed").alias("v"))
        often = _shared(values)
        more, long, sizes = _by_pivot(values, often, sets_of)
        alike = alike.unionByName(more)
        maybe = maybe.unionByName(meet(1, values, often, long, sizes, listed))

    sets = sets_of(maybe.select("c_id").distinct())
    linked = materialize(in_groups(
        maybe.join(sets, ["c_id", "s1"]), ["turn", "v", "b1", "b2"], links, "a bigint, b bigint"), "links")

    # The copies of a class are linked with its smallest id.
    members = named.join(classes.select("n", "s1", "s2", "c_id"), ["n", "s1", "s2"]).select(
        "doc_id", "c_id").filter("doc_id != c_id")
    held = alike.select(F.col("p_id").alias("a"), F.col("c_id").alias("b"))
    reach = smallest_reachable(linked, members, held).withColumnRenamed("doc_id", "of_id")
    return rows.join(reach, F.col("doc_id") == F.col("of_id"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
