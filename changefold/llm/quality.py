"""Quality rules: words, symbols and repeats of a text, and lines that many documents share.

A line that many documents of a host carry is a template of that host, not the document's
own text. Lines are hashed, distinct documents counted per host and line, and a document
with too few words outside the lines above the limit is rejected. Copies of a text count as
one document, and so do texts that are near copies outside the line: a text is not rejected
for being copied. ``judge`` and ``keep_good`` only judge; ``without_templates`` takes the
lines above the limit out of the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefold.llm import lines as line_work
from changefold.llm.frames import annotate, free_name, wide_hash
from changefold.llm.words import (
    LOWER, PLAIN, Lines, Words, covered, lists, mix, per_text, rolled, sequence_hashes, span_hashes,
)
from changefold.session import materialize

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
#: A line is a template if so many texts of a host carry it that differ in the rest of their lines.
LINE_DOCS = 10
#: Marks of the rest of a text: the smallest hash of its shingles under so many seeds.
MARKS = 24
#: Texts with one of the first so many marks in common are compared (Jaccard 0.75: all but 2e-5) ...
MEETING = 8
#: ... and are near copies if they have so many marks in common (Jaccard 0.75: all but 2e-5).
NEAR = 8
#: A document is depleted if fewer words are left outside templates.
WORDS_LEFT = 10

BASE = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint")
LINES = ("h1 array<bigint>, h2 array<bigint>, line_words array<int>, "
         "marks array<int>, marked array<int>, others array<int>")


def measures(column: pa.Array) -> list:
    """The base measures of each text, for each of its distinct lines with a word two hashes
    of the normalised line and the words it has in all its places, and the text's marks."""
    n = len(column)
    words = Words(column, PLAIN, lower=False)
    data = words.data
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])

    repeat = np.zeros(n, np.int64)
    starts = np.flatnonzero(words.left() >= WINDOW)
    if len(starts):
        key = mix(rolled(words.hashes(), WINDOW)[starts] ^ mix(words.doc[starts].astype(np.uint64)))
        _, place, count = np.unique(key, return_inverse=True, return_counts=True)
        hit = covered(starts[count[place] > 1], WINDOW, len(words.starts))
        repeat = per_text(words.doc[hit], n)

    found = Lines(words)
    of = found.doc[found.full]
    begins, ends = found.begins[found.full], found.ends[found.full]
    raw = mix(span_hashes(data, begins, ends) ^ mix(of.astype(np.uint64)))
    dup = per_text(of, n) - per_text(of[np.unique(raw, return_index=True)[1]], n)

    h1, h2 = found.keys()
    _, firsts, place = np.unique(mix(h1 ^ mix(of.astype(np.uint64))), return_index=True, return_inverse=True)
    size = np.bincount(place, (found.w1 - found.w0)[found.full], minlength=len(firsts)).astype(np.int64)
    order = np.argsort(firsts)
    firsts, size = firsts[order], size[order]
    per = per_text(of[firsts], n)

    marks = _marks(words, found, firsts, per)
    cut = words.offsets
    word_chars = _between(chars, words, n)
    return [
        words.counts.astype(np.int64), word_chars, symbols[cut[1:]] - symbols[cut[:-1]], dup, repeat,
        lists(h1[firsts].view(np.int64), per, pa.int64()),
        lists(h2[firsts].view(np.int64), per, pa.int64()),
        lists(size, per, pa.int32()),
        *[lists(x.reshape(-1), MARKS * (per > 0), pa.int32()) for x in marks],
    ]


def _marks(words: Words, found: Lines, firsts: np.ndarray, per: np.ndarray) -> list:
    """For each text with lines and each seed the smallest hash of its shingles, the number of
    the line it lies in, and the smallest hash in its other lines (all ones if it has none).

    A shingle is ``WINDOW`` words of a line in a row, or a shorter line.
    """
    w0, w1 = found.w0[found.full][firsts], found.w1[found.full][firsts]
    hashes = span_hashes(LOWER[words.data], words.starts, words.ends)
    count = np.maximum(w1 - w0 - WINDOW + 1, 1)
    first = np.cumsum(count) - count
    at = np.arange(count.sum()) + np.repeat(w0 - first, count)
    shingles = rolled(hashes, WINDOW)[at]
    short = w1 - w0 < WINDOW
    shingles[first[short]] = sequence_hashes(hashes, w0[short], w1[short])

    own = per[per > 0]
    begin = np.cumsum(own) - own
    low, line, other = (np.zeros((len(own), MARKS), np.int32) for _ in range(3))
    for k in range(MARKS if len(own) else 0):
        least = np.minimum.reduceat(mix(shingles + mix(np.array([k + 1], np.uint64))), first)
        smallest = np.minimum.reduceat(least, begin)
        hits = np.flatnonzero(least == np.repeat(smallest, own))
        holder = hits[np.searchsorted(hits, begin)]
        low[:, k], line[:, k] = smallest.view(np.int64).astype(np.int32), holder - begin
        least[holder] = np.iinfo(np.uint64).max
        other[:, k] = np.minimum.reduceat(least, begin).view(np.int64).astype(np.int32)
    return [low, line, other]


def _between(chars: np.ndarray, words: Words, n: int) -> np.ndarray:
    """Code points inside the words of each text."""
    total = np.concatenate([[0], np.cumsum(chars[words.ends] - chars[words.starts])])
    return total[words.first[1:]] - total[words.first[:-1]]


def base_failed():
    """Too few words, or too large a part of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def shared(seen: DataFrame, least: int = LINE_DOCS) -> DataFrame:
    """The lines of distinct texts that ``least`` texts of their host carry, a row for each
    line and text, with the marks of the rest of the text."""
    often = seen.select("host", F.explode(F.arrays_zip("h1", "h2")).alias("l")).groupBy(
        F.col("host").alias("of_host"), F.col("l.h1").alias("of1"), F.col("l.h2").alias("of2")).agg(
        F.count("*").alias("n_docs")).filter(F.col("n_docs") >= least).drop("n_docs")
    rest = F.transform(F.arrays_zip("marks", "marked", "others"), lambda m: F.when(
        m["marked"] == F.col("at"), m["others"]).otherwise(m["marks"]))
    lines = seen.select("*", F.posexplode(F.arrays_zip("h1", "h2", "line_words")).alias("at", "l")).select(
        "host", "t1", "t2", "n_words", "l.*", rest.alias("rest"))
    return lines.join(often, _same_line()).drop("of_host", "of1", "of2")


def _same_line():
    return (F.col("host").eqNullSafe(F.col("of_host")) & (F.col("h1") == F.col("of1"))
            & (F.col("h2") == F.col("of2")))


def templates(hits: DataFrame, least: int = LINE_DOCS) -> DataFrame:
    """(of_host, of1, of2) of the lines in ``hits`` that ``least`` different texts carry.

    Each text is compared with the smallest text that has a mark with it; a near copy of a
    smaller text does not count. So of any number of near copies one counts, and each text
    that is unlike the others does. No two texts but these meet, and a mark that many
    texts have is split by the adaptive join.
    """
    line = ["host", "h1", "h2"]
    short = F.transform("rest", lambda m: m.bitwiseAND(F.lit(32767)).cast("smallint"))
    marks = hits.select(*line, "t1", "t2", short.alias("rest"), F.posexplode(
        F.slice("rest", 1, MEETING)).alias("seed", "mark"))
    first = marks.groupBy(*line, "seed", "mark").agg(
        F.min(F.struct("t1", "t2", "rest")).alias("first"), F.count("*").alias("n")).filter("n > 1").select(
        F.col("host").alias("of_host"), F.col("h1").alias("of1"), F.col("h2").alias("of2"),
        F.col("seed").alias("of_seed"), F.col("mark").alias("of_mark"), "first")
    met = marks.join(first, _same_line() & (F.col("seed") == F.col("of_seed")) & (F.col("mark") == F.col("of_mark")))
    agree = F.size(F.filter(F.zip_with("rest", "first.rest", lambda a, b: a == b), lambda same: same))
    other = (F.col("t1") != F.col("first.t1")) | (F.col("t2") != F.col("first.t2"))
    copies = met.filter(other & (agree >= NEAR)).select(*line, "t1", "t2").distinct()
    # No join to the counts: the hot lines of the join that follows can then be split.
    counted = hits.select(*line, F.lit(1).alias("n")).unionAll(copies.select(*line, F.lit(-1).alias("n")))
    return counted.groupBy(F.col("host").alias("of_host"), F.col("h1").alias("of1"), F.col("h2").alias("of2")).agg(
        F.sum("n").alias("n")).filter(F.col("n") >= least).drop("n")


def measured(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
             host: str = "source") -> DataFrame:
    """A row for each document: its id, host, two hashes of its text, measures and lines."""
    asked = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{host}`").cast("string").alias("host"),
        F.col(f"`{text}`").alias("text"))
    t1, t2 = wide_hash(F.coalesce("text", F.lit("")))
    return annotate(asked.withColumns({"t1": t1, "t2": t2}), measures, f"{BASE}, {LINES}",
                    keep=["doc_id", "host", "t1", "t2"])


def template_lines(rows: DataFrame) -> DataFrame:
    """(host, t1, t2, n_words, h1, h2, line_words) of the template lines of distinct texts.

    Template lines meet the lines of distinct texts by host and hash; a host with a third
    of all rows is spread over its lines, and a line of most documents is split by the
    adaptive join. Texts that have fewer words anyway fail the base rules.
    """
    columns = ("h1", "h2", "line_words", "marks", "marked", "others", "n_words")
    seen = rows.groupBy("host", "t1", "t2").agg(*[F.first(c).alias(c) for c in columns])
    hits = materialize(shared(seen), "quality-lines")
    return hits.drop("rest").join(templates(hits), _same_line()).drop("of_host", "of1", "of2")


def depleted(rows: DataFrame) -> DataFrame:
    """(host, t1, t2) of the texts with fewer than ``WORDS_LEFT`` words outside templates."""
    left = F.max("n_words") - F.sum("line_words")
    return template_lines(rows).groupBy("host", "t1", "t2").agg(
        left.alias("n_left")).filter(F.col("n_left") < WORDS_LEFT).select("host", "t1", "t2")


def judge(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
          host: str = "source") -> DataFrame:
    """Measures and verdict of every document.

    A null or empty text has no words and fails; a null host is a host of its own; rows
    that repeat an id are judged one by one; no rows give no rows.
    """
    rows = materialize(measured(docs, doc_id=doc_id, text=text, host=host), "quality")
    bad = depleted(rows).withColumn("is_depleted", F.lit(True)).withColumnsRenamed(
        {"host": "of_host", "t1": "of1", "t2": "of2"})
    judged = rows.drop("h1", "h2", "line_words", "marks", "marked", "others").join(
        bad, F.col("host").eqNullSafe(F.col("of_host")) & (F.col("t1") == F.col("of1"))
        & (F.col("t2") == F.col("of2")), "left")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & F.col("is_depleted").isNull()).alias("kept"),
        F.coalesce("is_depleted", F.lit(False)).alias("depleted"))


def keep_good(docs: DataFrame, *, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    Rejected texts are few and meet the documents by a hash of the text and the host, so
    copies go together and rows need no id.
    """
    rows = materialize(measured(docs.select(
        F.lit(None).cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"),
        F.col(f"`{host}`").cast("string").alias("source")), doc_id="doc_id"), "quality")
    failed = rows.filter(base_failed()).select("host", "t1", "t2").distinct()
    out = failed.union(depleted(rows)).distinct()
    names = {c: free_name(docs.columns, f"of_{c}") for c in out.columns}
    out = out.withColumnsRenamed(names)
    t1, t2 = wide_hash(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return docs.join(
        out, F.col(f"`{host}`").cast("string").eqNullSafe(F.col(names["host"]))
        & (t1 == F.col(names["t1"])) & (t2 == F.col(names["t2"])), "left_anti")


def without_templates(docs: DataFrame, *, text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` with ``text`` without the template lines of its host, then ``n_lines`` and
    ``n_dropped`` (under free names, as the last two columns).

    All rows stay, rejected ones too. The other lines are joined by line breaks; a null text
    is one empty line. Template lines meet the documents by host and a hash of the text.
    """
    rows = materialize(measured(docs.select(
        F.lit(None).cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"),
        F.col(f"`{host}`").cast("string").alias("source")), doc_id="doc_id"), "quality")
    drops = template_lines(rows).groupBy("host", "t1", "t2").agg(
        F.collect_list(F.struct("h1", "h2")).alias("drop")).select(
        "host", "t1", "t2", F.col("drop.h1").alias("drop1"), F.col("drop.h2").alias("drop2"))
    names = {c: free_name(docs.columns, f"of_{c}") for c in drops.columns}
    added = [free_name(docs.columns, c) for c in ("n_lines", "n_dropped", "left")]
    t1, t2 = wide_hash(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    met = docs.join(
        drops.withColumnsRenamed(names), F.col(f"`{host}`").cast("string").eqNullSafe(F.col(names["host"]))
        & (t1 == F.col(names["t1"])) & (t2 == F.col(names["t2"])), "left")
    fields = ", ".join(f"`{c}` {t}" for c, t in zip(added, ("bigint", "bigint", "string"), strict=True))
    out = annotate(met, line_work.without, fields, keep=[c for c in docs.columns if c != text], text=text,
                   also=[names["drop1"], names["drop2"]])
    return out.select(*[F.col(f"`{added[2]}`").alias(c) if c == text else F.col(f"`{c}`")
                        for c in docs.columns], *added[:2])
