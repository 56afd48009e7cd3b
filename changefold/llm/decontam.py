"""Benchmark decontamination with suffix arrays of the training texts.

Each chunk of documents is a shard: the suffixes at which a test text could be found are
sorted into a suffix array, and every test suffix of a window's length is looked up there by
binary search. Places that follow each other in document and item are one verbatim match,
as long as it goes: its item, place in the item, place in the document and length are told,
and what matches cover is hit.

The test items travel to the documents in blocks of bounded size, one narrow pass each. The
matches of a block are written before the next one is sent, so that driver and executors
hold one block. No document meets another.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefold.llm.frames import annotate, free_name, texts, wide_hash
from changefold.llm.words import ALNUM, Words, covered, lists, per_text, runs
from changefold.session import materialize

WINDOW = 10
#: Bytes of test items that travel at once; an item that is larger travels alone.
BLOCK_BYTES = 8 << 20
#: Pairs of a hit and an occurrence of its window that are made at once (about 100 MB).
PAIRS = 2_000_000
MATCH = ("item_id", "item_word", "doc_word", "n_words")
FOUND = tuple(zip(MATCH, ("array<string>", "array<int>", "array<int>", "array<int>"), strict=True))


class Items:
    """A block of test items: its words, and its distinct windows in order."""

    def __init__(self, ids: list[str], column: pa.Array, window: int = WINDOW):
        words = Words(column, ALNUM, lower=True)
        hashes = words.hashes()
        self.vocabulary = np.unique(hashes)
        #: 1 and up; 0 is a word of no item, or the end of a text.
        numbers = (np.searchsorted(self.vocabulary, hashes) + 1).astype(np.uint32)
        self.window, left = window, words.left()
        short = np.repeat(words.counts, words.counts) < window
        at = np.flatnonzero((left >= window) | (short & (left == np.repeat(words.counts, words.counts))))
        keys, place = np.unique(windows(numbers, left, at, window), return_inverse=True)
        self.keys = keys
        sizes = np.zeros(len(keys), np.int64)
        sizes[place] = np.minimum(left[at], window)
        self.sizes = sizes
        # A shorter item is found as the beginning of a longer suffix.
        wide = keys.view(np.uint8).reshape(len(keys), 4 * window).copy()
        for k in np.flatnonzero(sizes < window):
            wide[k, 4 * sizes[k]:] = 255
        self.upto = wide.reshape(-1).view(keys.dtype) if len(keys) else keys
        # Where a window stands: word occurs[bounds[w]:bounds[w + 1]], which is in item ``of``.
        order = np.argsort(place, kind="stable")
        self.occurs, self.of, self.first = at[order], words.doc, words.first
        self.bounds = np.searchsorted(place[order], np.arange(len(keys) + 1))
        self.ids = ids
        inner = np.flatnonzero(left >= 2)
        self.pairs = np.unique(numbers[inner].astype(np.uint64) << np.uint64(32)
                               | numbers[np.minimum(inner + 1, len(numbers) - 1)])
        self.least = int(sizes.min()) if len(sizes) else window

    def number(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.uint32)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.uint32)


def windows(numbers: np.ndarray, left: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """The words from each place on as byte strings that sort as suffixes do."""
    out = np.zeros((len(at), window), ">u4")
    for k in range(window):
        inside = left[at] > k
        out[inside, k] = numbers[at[inside] + k]
    return out.reshape(-1).view(f"S{4 * window}")


def suffix_array(numbers: np.ndarray, left: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Places of a shard at which an item's window could begin, in order, and their keys.

    A window can only begin where enough neighbouring words are neighbours in some item.
    """
    ok = (numbers > 0) & (left >= items.least)
    if items.least > 1 and ok.any():
        pair = numbers[:-1].astype(np.uint64) << np.uint64(32) | numbers[1:]
        known = np.zeros(len(numbers), bool)
        at = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0) & (left[:-1] > 1))
        known[at] = np.isin(pair[at], items.pairs)
        # How many known pairs follow from each place on.
        stops = np.flatnonzero(~known)
        following = stops[np.searchsorted(stops, np.arange(len(known)))] - np.arange(len(known))
        ok &= following >= items.least - 1
    at = np.flatnonzero(ok)
    keys = windows(numbers, left, at, items.window)
    order = np.argsort(keys, kind="stable")
    return at[order], keys[order]


def stretched(at: np.ndarray, which: np.ndarray, doc: np.ndarray, items: Items) -> np.ndarray:
    """The longest matches of some hits, which come by place: rows of first word in the shard,
    first word in the block and number of words.

    A pair of a hit and an occurrence of its window lies on the diagonal of their distance;
    pairs in a row there are one match. Pairs are made and joined a bounded number at a time.
    """
    times = items.bounds[which + 1] - items.bounds[which]
    upto = np.cumsum(times)
    runs_of: list[np.ndarray] = []
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, "right")))
        n = times[lo:hi]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        p = np.repeat(at[lo:hi], n)
        q = items.occurs[np.repeat(items.bounds[which[lo:hi]], n) + inner]
        runs_of.append(_joined(np.stack([p, q, np.repeat(items.sizes[which[lo:hi]], n)], axis=1), doc, items.of))
        lo = hi
    found = np.concatenate(runs_of) if runs_of else np.zeros((0, 3), np.int64)
    return _joined(found, doc, items.of) if len(runs_of) > 1 else found


def _joined(found: np.ndarray, doc: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Matches of one diagonal, document and item that overlap, as one."""
    p, q, size = found[np.lexsort((found[:, 0], found[:, 0] - found[:, 1]))].T
    if not len(p):
        return found
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] - q[1:] != p[:-1] - q[:-1]) | (doc[p[1:]] != doc[p[:-1]]) | (of[q[1:]] != of[q[:-1]])
    # All matches of an item that hit have its window's words, so ends come in order.
    new[1:] |= p[1:] >= p[:-1] + size[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    return np.stack([p[first], q[first], p[last] + size[last] - p[first]], axis=1)


def search(column: pa.Array, items: Items) -> list:
    """For each text its longest matches, as lists of item, first word in the item, first word
    in the text and number of words."""
    words = Words(column, ALNUM, lower=True)
    n, left = len(column), words.left()
    numbers = items.number(words.hashes())
    places, keys = suffix_array(numbers, left, items)
    lo = np.searchsorted(keys, items.keys, "left")
    found = np.maximum(np.searchsorted(keys, items.upto, "right") - lo, 0)
    which = np.repeat(np.arange(len(found)), found)
    step = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found)
    at = places[np.repeat(lo, found) + step]
    order = np.argsort(at, kind="stable")
    met = stretched(at[order], which[order], words.doc, items)
    out: list[list] = [[] for _ in range(n)]
    for p, q, size in met[np.lexsort((met[:, 1], met[:, 0]))].tolist():
        i, k = int(words.doc[p]), int(items.of[q])
        out[i].append((items.ids[k], q - int(items.first[k]), p - int(words.first[i]), size))
    return [[[m[k] for m in x] for x in out] for k in range(4)]


def told(column: pa.Array, *matches: pa.Array) -> list:
    """Words of each text, first words and sizes of the spans that its matches cover, the ids
    of the items found, and the matches."""
    words = Words(column, ALNUM, lower=True)
    n = len(column)
    ids, places, firsts, sizes = (
        [x if x is not None else [] for x in (m.to_pylist() if isinstance(m, pa.Array) else m)] for m in matches)
    many = np.array([len(x) for x in firsts], np.int64)
    starts = np.array([f for x in firsts for f in x], np.int64) + np.repeat(words.first[:-1], many)
    hit = covered(starts, np.array([s for x in sizes for s in x], np.int64), len(words.starts))
    begin, end = runs(hit, words.first)
    per = per_text(words.doc[begin], n)
    return [
        words.counts.astype(np.int64),
        lists(begin - words.first[words.doc[begin]], per, pa.int32()),
        lists(end - begin, per, pa.int32()),
        [sorted({i for i in x if i is not None}) for x in ids],
        [[dict(zip(MATCH, m, strict=True)) for m in sorted(zip(*x, strict=True), key=lambda m: (m[2], m[3], m[0] or "", m[1]))]
         for x in zip(ids, places, firsts, sizes, strict=True)],
    ]


def blocks_of(bench: DataFrame, text: str, most: int | None = None) -> tuple[int, int]:
    """Bytes of the items, and the number of blocks that they come in."""
    size = bench.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    return size, max(1, math.ceil(size / (most or BLOCK_BYTES)))


def block(bench: DataFrame, item_id: str, text: str, k: int, many: int) -> Items:
    """One block of the items, which the driver holds while it is sent."""
    asked = bench.select(F.col(f"`{item_id}`").cast("string").alias("item_id"),
                         F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")
    rows = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(many)) == k).collect()
    return Items([r.item_id for r in rows], texts(pa.array([r.text for r in rows], pa.string())))


def scan(docs: DataFrame, bench: DataFrame, *, keep: list[str], text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, list[str]]:
    """The columns ``keep`` of ``docs``, then n_words, span_first, span_size, item_ids and
    matches under free names, which are returned too.

    ``matches``: for each verbatim match of a window or more, as long as it goes, the item,
    its first word in the item and in the document, and its words; an item that stands
    several times is told each time.

    A null or empty text has no words; so has a null item. An item of fewer words than the
    window is one window; one without words is never found. An item without an id is hit
    but not named; rows that repeat an id are one item. Every document row is looked at by
    itself. No items: nothing is hit.
    """
    context = docs.sparkSession.sparkContext
    names = [free_name(docs.columns, c) for c in ("n_words", "span_first", "span_size", "item_ids", "matches")]
    kinds = ("bigint", "array<int>", "array<int>", "array<string>",
             "array<struct<item_id:string,item_word:int,doc_word:int,n_words:int>>")
    fields = ", ".join(f"`{c}` {t}" for c, t in zip(names, kinds, strict=True))
    _, many = blocks_of(bench, item_text)
    if many == 1:
        sent = context.broadcast(block(bench, item_id, item_text, 0, 1))
        return annotate(docs, lambda column: told(column, *search(column, sent.value)), fields, keep=keep, text=text), names

    # The matches of one block after the other, under a hash of the text they are in.
    t1, t2 = wide_hash(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    rows = docs.select(t1.alias("t1"), t2.alias("t2"), F.col(f"`{text}`").alias("text"))
    parts = None
    for k in range(many):
        sent = context.broadcast(block(bench, item_id, item_text, k, many))
        one = annotate(rows, lambda column, sent=sent: search(column, sent.value),
                       ", ".join(f"{c} {t}" for c, t in FOUND), keep=["t1", "t2"])
        one = materialize(one.filter(F.size("doc_word") > 0).dropDuplicates(["t1", "t2"]), "matches")
        sent.destroy()
        parts = one if parts is None else parts.unionByName(one)
    held = [free_name(docs.columns, f"of_{c}") for c in ("t1", "t2", *(c for c, _ in FOUND))]
    parts = parts.groupBy("t1", "t2").agg(*[F.flatten(F.collect_list(c)).alias(c) for c, _ in FOUND])
    parts = parts.toDF(*held)
    met = docs.join(parts, (t1 == F.col(held[0])) & (t2 == F.col(held[1])), "left")
    return annotate(met, told, fields, keep=keep, text=text, also=held[2:]), names


def clean(docs: DataFrame, bench: DataFrame, *, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs."""
    out, names = scan(docs, bench, keep=docs.columns, text=text)
    return out.filter(F.size(names[1]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
