"""Line dedup: lines that many documents share go from all of them.

Lines are exploded as hashes of their normalised form, distinct documents counted per
hash, and the remaining lines of a document put together again by position.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefold.llm.frames import annotate, doc_key, free_name
from changefold.llm.words import PLAIN, Lines, Words, lists, mix, per_text
from changefold.session import materialize

#: Lines of at least one code point that are in so many documents go.
MIN_DOCS = 10
#: Slices of a line's documents, so that a line of a third of all documents is no load.
SALT = 32


def keys(column: pa.Array) -> list:
    """Two hashes of each distinct line, stripped of ASCII white space and A-Z lower-cased;
    lines of white space have no key."""
    found = Lines(Words(column, PLAIN, lower=False))
    of = found.doc[found.full]
    h1, h2 = found.keys()
    at = np.sort(np.unique(mix(h1 ^ mix(of.astype(np.uint64))), return_index=True)[1])
    per = per_text(of[at], len(column))
    return [lists(h.view(np.int64)[at], per, pa.int64()) for h in (h1, h2)]


def without(column: pa.Array, drop1: pa.Array, drop2: pa.Array) -> list:
    """Lines of each text, how many go, and the others joined by position."""
    found = Lines(Words(column, PLAIN, lower=False))
    gone = np.zeros(len(found.doc), bool)
    h1, h2 = found.keys()
    of, at = found.doc[found.full].astype(np.uint64), np.flatnonzero(found.full)
    sizes = np.array([len(x) if x is not None else 0 for x in drop1.to_pylist()], np.int64)
    if sizes.sum():
        which = mix(np.repeat(np.arange(len(column)), sizes).astype(np.uint64))
        a, b = (x.flatten().to_numpy(zero_copy_only=False).view(np.uint64) for x in (drop1, drop2))
        gone[at] = np.isin(mix(h1 ^ mix(of)) + h2, mix(a ^ which) + b)
    dropped = per_text(found.doc[gone], len(column))
    out = column.to_pylist()
    data = found.words.data
    for i in np.flatnonzero(dropped):
        stay = [j for j in range(found.first[i], found.first[i + 1]) if not gone[j]]
        out[i] = b"\n".join(data[found.begins[j]:found.ends[j]].tobytes() for j in stay).decode()
    return [found.counts, dropped, pa.array(out, pa.large_string())]


def shared(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
           min_docs: int = MIN_DOCS) -> DataFrame:
    """(k_id, k_text, drop1, drop2): for each document the hashes of its lines that at
    least ``min_docs`` documents have; documents without such lines have no row."""
    asked = docs.select(*doc_key(doc_id, text), F.col(f"`{text}`").alias("text"))
    found = annotate(asked, keys, "h1 array<bigint>, h2 array<bigint>", keep=["k_id", "k_text"])
    pairs = found.select("k_id", "k_text", F.explode(F.arrays_zip("h1", "h2")).alias("h")).select(
        "k_id", "k_text", "h.h1", "h.h2")
    pairs = materialize(pairs.distinct(), "lines")
    often = pairs.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs)
    often = often.select("h1", "h2", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("slice"))
    slice_of = F.pmod(F.xxhash64("k_id", "k_text"), F.lit(SALT)).cast("int")
    return (
        pairs.withColumn("slice", slice_of).join(often, ["h1", "h2", "slice"], "left_semi")
        .groupBy("k_id", "k_text").agg(F.collect_list(F.struct("h1", "h2")).alias("drop"))
        .select("k_id", "k_text", F.col("drop.h1").alias("drop1"), F.col("drop.h2").alias("drop2"))
    )


def dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
          min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``text`` as it is left, then ``n_lines`` and ``n_dropped`` (under free
    names, as the last two columns).

    A null text is one empty line and comes back as an empty text; lines of white space
    alone never go. Rows that repeat an id are one document for counting; rows without an
    id are one document if their texts are equal. No rows give no rows.
    """
    names = docs.columns
    added = [free_name(names, c) for c in ("n_lines", "n_dropped", "left")]
    held = [free_name(names, c) for c in ("k_id", "k_text", "drop1", "drop2")]
    drops = shared(docs, doc_id=doc_id, text=text, min_docs=min_docs)
    drops = drops.withColumnsRenamed(dict(zip(drops.columns, held, strict=True)))
    k_id, k_text = doc_key(doc_id, text)
    met = docs.join(drops, (k_id == F.col(held[0])) & (k_text == F.col(held[1])), "left")
    fields = ", ".join(f"`{c}` {t}" for c, t in zip(added, ("bigint", "bigint", "string"), strict=True))
    out = annotate(met, without, fields, keep=[c for c in names if c != text], text=text,
                   also=held[2:])
    return out.select(*[F.col(f"`{added[2]}`").alias(c) if c == text else F.col(f"`{c}`")
                        for c in names], *added[:2])
