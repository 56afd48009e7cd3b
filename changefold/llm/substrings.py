"""Substring dedup with suffix automata.

The reference of a document are all documents with a smaller id, so it grows with the corpus
and is not broadcast whole: it is cut into shards that meet just the stretches of text that
could match there. The anchor of a window is the smallest hash of its ``GRAM``-word grams;
equal windows have equal anchors. Stretches whose anchor occurs in two documents, of
``LONGEST`` windows at most, go to the shard of that anchor, equal ones once. A shard builds a suffix automaton of its stretches,
streams them through it for matching statistics, and tells for each window the smallest id
that has it. Windows compare by the 64 bits of their anchor and 40 bits of each word.

An anchor may be in a third of all documents. Each task looks at many documents at once, so
that an anchor meets those of other tasks with one row for all of them, and the windows of a
crowded anchor, told by its windows, are dealt out one by one to several shards, by a hash of
all their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changefold.llm.frames import annotate, chunks, free_name, texts
from changefold.llm.groups import in_groups
from changefold.llm.words import PLAIN, Words, covered, lists, mix, per_text, rolled, runs, sequence_hashes
from changefold.session import materialize

WINDOW = 13
GRAM = 6
#: Bytes by which a word is named within a shard, whose windows agree in an anchor's 64 bits.
SYMBOL = 5
#: Pairs of a document and an anchor that a task looks at together (about 25 MB).
PAIRS = 1 << 19
#: Windows beyond which an anchor is crowded, and windows that each of its shards gets.
CROWD = 80_000
SHARE = 10_000
#: Windows of one anchor in a row that make one stretch (a text that repeats a few words for
#: ever has one anchor all along).
LONGEST = 256
#: Crowded anchors that travel to all tasks; beyond it they meet the pairs by shuffle.
BROADCAST_ANCHORS = 100_000
#: Distinct stretches a task holds before it hands them on (about 30 MB).
HELD = 100_000


class Automaton:
    """A suffix automaton of several sequences; each state knows the least owner of a
    sequence in which its words occur."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [None]

    def _state(self, length: int, link: int, follow: dict, least) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.least.append(least)
        return len(self.link) - 1

    def _split(self, parent: int, word, child: int) -> int:
        """The state of the parent's words and ``word``, taken out of ``child``."""
        if self.length[child] == self.length[parent] + 1:
            return child
        new = self._state(self.length[parent] + 1, self.link[child], dict(self.next[child]), self.least[child])
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = new
            parent = self.link[parent]
        self.link[child] = new
        return new

    def add(self, words, owner) -> None:
        last = 0
        for word in words:
            at = last
            if word in self.next[at]:
                last = self._split(at, word, self.next[at][word])
            else:
                last = self._state(self.length[at] + 1, 0, {}, None)
                while at >= 0 and word not in self.next[at]:
                    self.next[at][word] = last
                    at = self.link[at]
                if at >= 0:
                    self.link[last] = self._split(at, word, self.next[at][word])
            if self.least[last] is None or owner < self.least[last]:
                self.least[last] = owner

    def finish(self) -> None:
        """Words that end where longer ones end occur in the same sequences."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up, least = self.link[s], self.least[s]
            if up > 0 and (self.least[up] is None or least < self.least[up]):
                self.least[up] = least

    def least_owners(self, words, window: int) -> list:
        """Matching statistics: for each place at which a match of ``window`` words ends, the
        least owner of those words, None where there is no such match."""
        out, at, size = [], 0, 0
        for word in words:
            while at and word not in self.next[at]:
                at = self.link[at]
                size = self.length[at]
            if word in self.next[at]:
                at, size = self.next[at][word], size + 1
            while at and self.length[self.link[at]] >= window:
                at = self.link[at]
                size = self.length[at]
            out.append(self.least[at] if size >= window else None)
        return out[window - 1:]


def _anchors(words: Words, hashes: np.ndarray, window: int) -> np.ndarray:
    """The anchor of the window that starts at each word (of any value if it is too short)."""
    grams = rolled(hashes, GRAM)
    width = window - GRAM + 1
    out = grams.copy()
    for k in range(1, width):
        end = max(0, len(out) - k)
        out[:end] = np.minimum(out[:end], grams[k:])
    return out


def anchors(column: pa.Array) -> list:
    """The distinct anchors of each text's windows, and how many windows have each."""
    words = Words(column, PLAIN, lower=False)
    found = _anchors(words, words.hashes(), WINDOW)
    at = np.flatnonzero(words.left() >= WINDOW)
    new = np.ones(len(at), bool)
    new[1:] = (found[at[1:]] != found[at[:-1]]) | (words.doc[at[1:]] != words.doc[at[:-1]])
    first = np.flatnonzero(new)  # neighbours mostly share theirs
    many = np.diff(np.append(first, len(at)))
    at = at[first]
    _, first, place = np.unique(mix(found[at] ^ mix(words.doc[at].astype(np.uint64))),
                                return_index=True, return_inverse=True)
    many = np.bincount(place, many, minlength=len(first)).astype(np.int32)
    order = np.argsort(first)
    at, many = at[first[order]], many[order]
    per = per_text(words.doc[at], len(column))
    return [lists(found[at].view(np.int64), per, pa.int64()), lists(many, per, pa.int32())]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, anchor, wins): of the pairs held at once with one anchor, one tells how many
    windows they have, as a negative number if they are several pairs; the others have 0.
    ``batches``: doc_id, anchors, many."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def ready() -> pa.RecordBatch:
        ids, anchor, many = (np.concatenate(x) for x in zip(*held, strict=True))
        _, first, place, count = np.unique(anchor, return_index=True, return_inverse=True, return_counts=True)
        wins = np.zeros(len(anchor), np.int64)
        wins[first] = np.bincount(place, many, minlength=len(first)) * np.where(count > 1, -1, 1)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, anchor, wins)], names=["doc_id", "anchor", "wins"])

    for batch in batches:
        found = batch.column(1)
        ids = np.repeat(batch.column(0).to_numpy(), found.value_lengths().to_numpy())
        held.append((ids, found.flatten().to_numpy(), batch.column(2).flatten().to_numpy()))
        size += len(ids)
        if size > PAIRS:
            yield ready()
            held, size = [], 0
    if size:
        yield ready()


def repeated(docs: DataFrame) -> DataFrame:
    """(of_id, asked, parts): the anchors of each document that other documents have, too, and
    over how many shards an anchor's windows are dealt out."""
    pairs = annotate(docs.filter("doc_id IS NOT NULL"), anchors, "anchors array<bigint>, many array<int>",
                     keep=["doc_id"]).mapInArrow(_pairs, "doc_id bigint, anchor bigint, wins bigint")
    # A pair that others stand for is known to be repeated and goes anywhere.
    alike = Window.partitionBy("anchor", F.when(F.col("wins") == 0, F.col("doc_id")))
    often = materialize(pairs.select(
        "doc_id", "anchor", "wins", F.count("*").over(alike).alias("rows"),
        F.sum(F.abs("wins")).over(alike).alias("total")).filter("wins <= 0 OR rows > 1").select(
        "doc_id", "anchor", "total"), "anchors")
    crowded = materialize(often.filter(F.col("total") > CROWD).groupBy("anchor").agg(
        F.ceil(F.max("total") / min(SHARE, CROWD)).cast("int").alias("parts")), "crowded")
    few = crowded.count() <= BROADCAST_ANCHORS
    told = often.join(F.broadcast(crowded) if few else crowded, "anchor", "left")
    one = F.struct("anchor", F.coalesce("parts", F.lit(1)).alias("parts"))
    found = told.groupBy(F.col("doc_id").alias("of_id")).agg(F.collect_set(one).alias("a"))
    return found.select("of_id", F.col("a.anchor").alias("asked"), F.col("a.parts").alias("parts"))


def stretches(column: pa.Array, asked: pa.Array, parts: pa.Array) -> tuple:
    """The stretches of all texts whose windows have one of the text's ``asked`` anchors: the
    text's place, first word, anchor, a hash of the words, the anchor's shard, and a short
    hash of each word. Windows of an anchor with several ``parts`` are each a stretch."""
    n = len(column)
    words = Words(column, PLAIN, lower=False)
    hashes = words.hashes()
    found = _anchors(words, hashes, WINDOW)
    sizes = np.array([len(x) if x is not None else 0 for x in asked.to_pylist()], np.int64)
    of = np.repeat(np.arange(n), sizes).astype(np.uint64)
    wanted = mix(asked.flatten().to_numpy(zero_copy_only=False).view(np.uint64) ^ mix(of))
    order = np.argsort(wanted)
    wanted, many = wanted[order], parts.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)[order]
    here = mix(found ^ mix(words.doc.astype(np.uint64)))
    ok = words.left() >= WINDOW
    ok &= np.isin(here, wanted)
    border = np.zeros(len(ok) + 1, bool)
    border[words.first] = True
    border[1:-1] |= found[1:] != found[:-1]
    alone = np.flatnonzero(ok & np.isin(here, wanted[many > 1]))
    border[alone] = border[alone + 1] = True
    begin, end = runs(ok, np.flatnonzero(border))
    pieces = (end - begin + LONGEST - 1) // LONGEST
    piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(begin, pieces) + LONGEST * piece
    end = np.minimum(begin + LONGEST, np.repeat(end, pieces))
    stop = end + WINDOW - 1  # words of the stretch are begin:stop
    keys = sequence_hashes(hashes, begin, stop)
    part = keys % many[np.searchsorted(wanted, here[begin])]
    short = hashes.view(np.uint8).reshape(-1, 8)[:, :SYMBOL]
    doc = words.doc[begin]
    return (doc, begin - words.first[doc], found[begin].view(np.int64), keys.view(np.int64), part.astype(np.int32),
            (short[b:s].tobytes() for b, s in zip(begin, stop, strict=True)))


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, part, key, words, owner, top): a task's equal stretches as one row, with the
    least and the greatest id that has them. ``batches``: doc_id, text, asked, parts."""
    held: dict[tuple[int, int, int], list] = {}

    def ready() -> pa.RecordBatch:
        cols = (*([k[i] for k in held] for i in range(3)), *([v[i] for v in held.values()] for i in range(3)))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
            names=["anchor", "part", "key", "words", "owner", "top"])
        held.clear()
        return out

    for batch in batches:
        for part in chunks(batch, 1):
            ids = part.column(0).to_pylist()
            doc, _, anchor, key, number, words = stretches(texts(part.column(1)), part.column(2), part.column(3))
            for i, *which, w in zip(doc.tolist(), anchor.tolist(), number.tolist(), key.tolist(), words, strict=True):
                known = held.get(at := tuple(which))
                if known is None:
                    held[at] = [w, ids[i], ids[i]]
                else:
                    known[1], known[2] = min(known[1], ids[i]), max(known[2], ids[i])
            if len(held) > HELD:
                yield ready()
    yield ready()


def _places(column: pa.Array, asked: pa.Array, parts: pa.Array) -> list:
    """First word, anchor and hash of each stretch."""
    doc, first, anchor, key, *_ = stretches(column, asked, parts)
    per = per_text(doc, len(column))
    return [lists(first, per, pa.int32()), lists(anchor, per, pa.int64()), lists(key, per, pa.int64())]


def symbols(words: bytes) -> list[int]:
    """The words of a stretch, which came as ``SYMBOL`` bytes of their hashes each."""
    out = np.zeros((len(words) // SYMBOL, 8), np.uint8)
    out[:, :SYMBOL] = np.frombuffer(words, np.uint8).reshape(-1, SYMBOL)
    return out.view(np.uint64)[:, 0].tolist()


def shard(cols: dict) -> list[tuple]:
    """(anchor, key, least owners of its windows) of the stretches of one shard. Stretches
    with nothing smaller than the largest id that has them are left out."""
    words = [symbols(x) for x in cols["words"]]
    owners, tops = cols["owner"].tolist(), cols["top"].tolist()
    if len(words) == 1:
        found = [[owners[0]] * (len(words[0]) - WINDOW + 1)]
    else:
        automaton = Automaton()
        for x, owner in zip(words, owners, strict=True):
            automaton.add(x, owner)
        automaton.finish()
        found = [automaton.least_owners(x, WINDOW) for x in words]
    anchor = int(cols["anchor"][0])
    return [(anchor, key, least) for key, least, top in zip(cols["key"].tolist(), found, tops, strict=True)
            if min(least) < top]


def removable(docs: DataFrame) -> DataFrame:
    """(of_id, starts) for the documents of (doc_id, text) that have windows which also start
    in a document with a smaller id: the first words of those windows."""
    asked = repeated(docs)
    # The texts are dealt by id once: both uses here and the caller's share that exchange.
    met = docs.join(asked, F.col("doc_id") == F.col("of_id"), "left")
    # Equal stretches are one row for each task, so a passage of a third of all documents
    # is no load for its shard.
    distinct = met.select("doc_id", "text", "asked", "parts").mapInArrow(
        _distinct, "anchor bigint, part int, key bigint, words binary, owner bigint, top bigint")
    distinct = distinct.repartition("anchor", "part").groupBy("anchor", "part", "key", "words").agg(
        F.min("owner").alias("owner"), F.max("top").alias("top"))
    least = in_groups(distinct, ["anchor", "part"], shard, "anchor bigint, key bigint, least array<bigint>", dealt=True)
    found = annotate(met, _places, "first array<int>, anchor array<bigint>, key array<bigint>",
                     keep=["doc_id"], also=["asked", "parts"]).select(
        "doc_id", F.explode(F.arrays_zip("first", "anchor", "key")).alias("s")).select("doc_id", "s.*")
    back = found.join(least, ["anchor", "key"])
    places = F.filter(
        F.transform("least", lambda owner, i: F.when(owner < F.col("doc_id"), F.col("first") + i)),
        lambda x: x.isNotNull())
    return back.select(F.col("doc_id").alias("of_id"), places.alias("starts")).filter(
        F.size("starts") > 0).groupBy("of_id").agg(F.flatten(F.collect_list("starts")).alias("starts"))


def without(column: pa.Array, starts: pa.Array) -> list:
    """Words of each text, how many go, and the others joined by one blank."""
    words = Words(column, PLAIN, lower=False)
    first = words.first
    sizes = np.array([len(x) if x is not None else 0 for x in starts.to_pylist()], np.int64)
    at = np.repeat(first[:-1], sizes) + starts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    gone = covered(at, WINDOW, len(words.starts))
    data, out = words.data.tobytes(), []
    begins, ends = words.starts.tolist(), words.ends.tolist()
    stay = np.flatnonzero(~gone)
    cut = np.searchsorted(stay, first)
    stay = stay.tolist()
    for i in range(len(column)):
        out.append(b" ".join([data[begins[j]:ends[j]] for j in stay[cut[i]:cut[i + 1]]]).decode())
    return [words.counts.astype(np.int64), per_text(words.doc[gone], len(column)), pa.array(out, pa.large_string())]


def dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``text`` as the words that are left, joined
    by one blank, then ``n_words`` and ``n_removed`` under free names.

    Windows are judged on the texts as given. A null or empty text has no words. A row
    without an id keeps all its words and is no reference; rows that repeat an id are not
    judged against each other. No rows give no rows.
    """
    names = [c for c in (keep or docs.columns) if c != text]
    added = [free_name(docs.columns, c) for c in ("n_words", "n_removed", "left", "of_id", "starts")]
    asked = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    starts = removable(asked).withColumnsRenamed({"of_id": added[3], "starts": added[4]})
    rows = asked if set(names) <= {"doc_id"} and doc_id == "doc_id" and text == "text" else docs
    met = rows.join(starts, F.col(f"`{doc_id}`").cast("long") == F.col(added[3]), "left")
    fields = f"`{added[0]}` bigint, `{added[1]}` bigint, `{added[2]}` string"
    out = annotate(met, without, fields, keep=names, text=text, also=[added[4]])
    return out.select(*[F.col(f"`{added[2]}`").alias(c) if c == text else F.col(f"`{c}`")
                        for c in (keep or docs.columns)], *added[:2])
