"""Work on bounded groups of rows that stream through a sorted partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from changefold.llm.frames import ship

#: Rows a task gathers before it hands them on.
FLUSH = 20_000


def _column(column: pa.ChunkedArray):
    """Integers as numpy, anything else as a list."""
    if pa.types.is_integer(column.type) and not column.null_count:
        return column.to_numpy()
    return column.to_pylist()


def in_groups(df: DataFrame, keys: Sequence[str], work: Callable[[dict], list[tuple]],
              fields: str, *, dealt: bool = False) -> DataFrame:
    """What ``work`` makes of each group of equal ``keys`` (integers without nulls).

    ``dealt``: the rows are partitioned by the keys already.
    Groups are dealt by a shuffle on the keys and come sorted, so a task holds one Arrow
    batch and one group at a time. ``work`` gets a dict of columns and returns rows; its
    groups must be bounded by how the keys are made.
    """
    ship(df.sparkSession)
    schema = T.StructType.fromDDL(fields)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        made_as = to_arrow_schema(schema)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in made_as]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(cols, made_as, strict=True)], schema=made_as)

        rest: pa.Table | None = None
        ready: list[tuple] = []

        def each(table: pa.Table, last: bool) -> pa.Table:
            """Work on all whole groups; what may go on in the next batch is returned."""
            held = [table.column(k).to_numpy() for k in keys]
            new = np.zeros(table.num_rows, bool)
            new[:1] = True
            for x in held:
                new[1:] |= x[1:] != x[:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], table.num_rows)
            upto = table.num_rows if last else int(starts[-1])
            if upto:
                cols = {n: _column(table.column(n).slice(0, upto)) for n in names}
                for i, j in zip(starts, ends, strict=True):
                    if i < upto:
                        ready.extend(work({n: c[i:j] for n, c in cols.items()}) or ())
            return table.slice(upto)

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            rest = each(pa.concat_tables([rest, table]) if rest is not None else table, False)
            if len(ready) >= FLUSH:
                yield out(ready)
                ready.clear()
        if rest is not None and rest.num_rows:
            each(rest, True)
        yield out(ready)

    by_key = df if dealt else df.repartition(*keys)
    return by_key.sortWithinPartitions(*keys).mapInArrow(run, schema)
