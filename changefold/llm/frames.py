"""Frames of documents: row-wise Arrow work beside the given columns, keys, free names."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a task works on at once (a longer text is worked on alone).
CHUNK_BYTES = 2 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors' Python import this package: Spark sends it to them as a zip."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="package-")), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for p in sorted(package.rglob("*.py")):
            out.write(p, p.relative_to(package.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def free_name(taken: Sequence[str], wish: str) -> str:
    """``wish``, with underscores in front until no column is called so in any case."""
    low = {c.lower() for c in taken}
    while wish.lower() in low:
        wish = f"_{wish}"
    return wish


def texts(column: pa.Array) -> pa.Array:
    """A text column without nulls and with wide offsets."""
    return column.cast(pa.large_string()).fill_null("")


def chunks(batch: pa.RecordBatch, text: int, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts hold about ``most`` bytes."""
    if not batch.num_rows:
        return
    sizes = pc.binary_length(texts(batch.column(text))).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def annotate(docs: DataFrame, work: Callable[..., list], fields: str, *, keep: Sequence[str],
             text: str = "text", also: Sequence[str] = ()) -> DataFrame:
    """The columns ``keep`` of ``docs`` and, for each row, what ``work`` returns.

    ``work`` gets the texts as a large_string array without nulls, then the columns
    ``also``, and returns one array or list for each column of ``fields``. A row depends on its own text only, so a task that is run
    again gives the same rows; nothing is shuffled.
    """
    ship(docs.sparkSession)
    new = T.StructType.fromDDL(fields)
    old = T.StructType([docs.schema[c] for c in keep])
    asked = docs.select(*[F.col(f"`{c}`") for c in [*keep, *also]], F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([*old.fields, *new.fields])
    width, at = len(old.fields), len(keep) + len(also)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in new.fields]
        for batch in batches:
            for part in chunks(batch, at):
                found = work(texts(part.column(at)), *part.columns[width:at])
                made = [x if isinstance(x, pa.Array) and x.type == t else pa.array(x, type=t)
                        for x, t in zip(found, types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], *made], names=schema.names)

    return asked.mapInArrow(run, schema)


def doc_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two longs that name a document: its id, or for a null id a hash of its text.

    Rows that repeat an id are one document; rows without an id are one document if
    their texts are equal.
    """
    none = F.col(f"`{doc_id}`").isNull()
    return [
        F.when(none, F.lit(0)).otherwise(F.col(f"`{doc_id}`").cast("long")).alias("k_id"),
        F.when(none, F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))).otherwise(F.lit(0))
        .cast("long").alias("k_text"),
    ]


def wide_hash(column: Column) -> list[Column]:
    """Two 64-bit hashes of a column with different seeds."""
    return [F.xxhash64(F.lit(1), column), F.xxhash64(F.lit(2), column)]
