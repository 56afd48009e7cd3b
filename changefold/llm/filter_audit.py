"""Filter interaction audit with sorted posting lists.

For each part (source) and each id range the ids that fail a filter are one sorted list; the
documents with good and with toxic labels are two more. What a filter removes after some
others is the difference of its list and the union of theirs. Unions are merged and
differences taken by galloping: the ids of the shorter list are looked up in the longer one
by binary search. Sizes of disjoint ranges add up, so no list is longer than a range, and
what comes out of a range is a fixed number of sums for each part in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefold.llm.frames import annotate, ship
from changefold.session import materialize

FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
#: Bits of a document: one for each filter that it fails, one for each label.
COPY, GOOD, TOXIC = 1 << 4, 1 << 5, 1 << 6
BITS = 7
#: Slices of the copies of a text, so that one of a third of all documents is no load.
SALT = 32

#: What each filter meets: the filters before it, as a set of bits.
CELLS = [(f, before) for f in range(len(FILTERS)) for before in range(1 << len(FILTERS)) if not before >> f & 1]
SUMS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(column: pa.Array) -> list:
    """The filters that each text fails by itself, as bits, and a 128-bit hash of the text."""
    masks, keys = np.zeros(len(column), np.int32), []
    for i, text in enumerate(column.to_pylist()):
        data = text.encode()
        words = data.split()  # at ASCII white space
        fails = (
            len(words) < MIN_WORDS,
            100 * len(set(words)) < DISTINCT_PERCENT * len(words),
            100 * (len(data) - len(data.translate(None, CAPITALS))) > CAPITAL_PERCENT * len(text),
            len(data.translate(None, SYMBOLS)) < len(data),
        )
        masks[i] = sum(fail << k for k, fail in enumerate(fails))
        keys.append(blake2b(data, digest_size=16).digest())
    return [masks, keys]


def failing(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
            part: str = "source", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(part, doc_id, mask, tie) for each document, written: its filters and labels as bits.

    A null text is empty, a null part an empty string. A text is a copy if an equal one has a
    smaller id; rows without an id are no copies and no originals, and have no labels. Rows
    that repeat an id count one by one. An id has a label if any of its rows in ``labels`` does.
    ``tie`` tells equal rows apart.
    """
    asked = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                        F.col(f"`{text}`").alias("text"))
    seen = materialize(annotate(asked, failures, "mask int, text_key binary", keep=["doc_id", "part"]), "audit-texts")
    # An original is dealt to all slices of its copies.
    first = seen.groupBy("text_key").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    first = first.filter("first_id < last_id").select(
        "text_key", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("slice"))
    slice_of = F.pmod(F.xxhash64("doc_id", "part"), F.lit(SALT)).cast("int")
    met = seen.withColumn("slice", slice_of).join(first, ["text_key", "slice"], "left")
    copy = F.when(F.col("first_id") < F.col("doc_id"), COPY).otherwise(0)

    told = labels.select(F.col(f"`{doc_id}`").cast("long").alias("of_id"),
                         (F.col(f"`{quality}`") == 1).alias("good"), (F.col(f"`{toxic}`") == 1).alias("bad"))
    told = told.filter("of_id IS NOT NULL AND (good OR bad)").groupBy("of_id").agg(
        (F.when(F.max("good"), GOOD).otherwise(0) + F.when(F.max("bad"), TOXIC).otherwise(0)).alias("labelled"))
    # Rows without an id, which match nothing, are spread by their text.
    told = told.withColumn("of_key", F.col("of_id"))
    met = met.select("part", "doc_id", (F.col("mask") + copy).alias("mask"),
                     F.coalesce("doc_id", F.xxhash64("text_key")).alias("key"))
    rows = met.join(told, (F.col("key") == F.col("of_key")) & (F.col("doc_id") == F.col("of_id")), "left")
    return materialize(rows.select(
        "part", "doc_id", (F.col("mask") + F.coalesce("labelled", F.lit(0))).alias("mask"),
        F.monotonically_increasing_id().alias("tie")), "audit-rows")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, ids, places): a row for each part in a batch of rows sorted by part and id."""
    for batch in batches:
        if not batch.num_rows:
            continue
        part, mask = batch.column(0).dictionary_encode(), batch.column(2).to_numpy()
        number = part.indices.to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
        rows = list(zip(cuts[:-1], cuts[1:], strict=True))
        yield pa.RecordBatch.from_arrays([
            pa.array([part.dictionary[int(number[i])].as_py() for i, _ in rows], pa.string()),
            pa.array([batch.column(1).slice(i, j - i) for i, j in rows], pa.list_(pa.int64())),
            pa.array([[np.flatnonzero(mask[i:j] >> k & 1).tolist() for k in range(BITS)] for i, j in rows],
                     pa.list_(pa.list_(pa.int32()))),
        ], names=["part", "ids", "places"])


def postings(rows: DataFrame) -> DataFrame:
    """(part, ids, places) of ``failing`` rows: the sorted ids of one range of a part, and for
    each filter, then for good and toxic labels, the places in ``ids`` of those that have it.

    Ranges are cut by part and id, one Arrow batch at most, so a part with a third of all
    rows is many ranges, and a small one is a part of a task.
    """
    ship(rows.sparkSession)
    order = ("part", "doc_id", "tie")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(_lists, "part string, ids array<bigint>, places array<array<int>>")


def gallop(ids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``ids`` stands or would stand in ``among``, and whether it is there."""
    at = np.searchsorted(among, ids)
    there = at < len(among)
    there[there] = among[at[there]] == ids[there]
    return at, there


def merged(lists: list[np.ndarray]) -> np.ndarray:
    """The union of sorted lists: the shorter ones gallop through the longest, one by one."""
    lists = sorted(lists, key=len, reverse=True)
    out = lists[0] if lists else np.zeros(0, np.int64)
    for ids in lists[1:]:
        at, there = gallop(ids, out)
        out = np.insert(out, at[~there], ids[~there])
    return out


def beyond(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The ids that are not among ``others``; the shorter list gallops through the longer."""
    if not len(ids) or not len(others):
        return ids
    if len(ids) <= len(others):
        return ids[~gallop(ids, others)[1]]
    at, there = gallop(others, ids)
    return np.delete(ids, at[there])


def priced(total: int, lists: list[np.ndarray]) -> np.ndarray:
    """A row of ``SUMS`` for each of ``CELLS``, from the lists of one range."""
    fails, good, toxic = lists[:len(FILTERS)], lists[5], lists[6]
    unions = [np.zeros(0, np.int64)]
    for before in range(1, 1 << len(FILTERS)):
        low = (before & -before).bit_length() - 1
        unions.append(merged([unions[before & (before - 1)], fails[low]]))
    every, last = (1 << len(FILTERS)) - 1, len(FILTERS) - 1
    out = np.zeros((len(CELLS), len(SUMS)), np.int64)
    alone = [len(beyond(fails[f], unions[every & ~(1 << f)])) for f in range(len(FILTERS))]
    shapley = [0] * len(FILTERS)
    for row, (f, before) in zip(out, CELLS, strict=True):
        gone = beyond(fails[f], unions[before])
        size = before.bit_count()
        shapley[f] += factorial(size) * factorial(last - size) * len(gone)
        row[:6] = (total - len(unions[before | 1 << f]), len(gone), len(fails[f]) - len(gone), alone[f],
                   len(gone) - len(beyond(gone, good)), len(gone) - len(beyond(gone, toxic)))
    out[:, 6] = [shapley[f] for f, _ in CELLS]
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, filter, before, *SUMS): a task's ranges of one part, which come in a row, as one
    set of cells."""
    part, held = None, None

    def ready() -> pa.RecordBatch:
        f, before = zip(*CELLS, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(CELLS), pa.string()), pa.array(f, pa.int32()), pa.array(before, pa.int32()),
             *(pa.array(x) for x in held.T)], names=["part", "filter", "before", *SUMS])

    for batch in batches:
        for name, ids, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            found = priced(len(ids), [x.values.to_numpy().astype(np.int64) for x in places.values])
            if held is not None and name != part:
                yield ready()
                held = None
            part, held = name, found if held is None else held + found
    if held is not None:
        yield ready()


def audit(docs: DataFrame, labels: DataFrame, **names) -> DataFrame:
    """For each part, order of the filters and step what the step keeps, removes and loses:
    part, filter_order, step and ``SUMS``.

    No rows give no rows. See ``failing`` for nulls, repeats and the names of columns. The
    steps of all orders are a table of 600 rows; they meet 80 sums of each part.
    """
    spark = docs.sparkSession
    cells = postings(failing(docs, labels, **names)).mapInArrow(
        _sums, "part string, filter int, before int, " + ", ".join(f"{c} bigint" for c in SUMS))
    cells = cells.groupBy("part", "filter", "before").agg(*[F.sum(c).alias(c) for c in SUMS])
    steps = [("".join(order), k + 1, FILTERS.index(f), sum(1 << FILTERS.index(g) for g in order[:k]))
             for order in permutations(FILTERS) for k, f in enumerate(order)]
    steps = spark.createDataFrame(steps, "filter_order string, step int, of_filter int, of_before int")
    return cells.join(
        F.broadcast(steps), (F.col("filter") == F.col("of_filter")) & (F.col("before") == F.col("of_before"))
    ).select("part", "filter_order", "step", *SUMS)
