"""Raw events with their payloads in binary form, parsed once when they are written.

A payload of JSON text is parsed again by every reader; as a variant it is read in place.
The table has the columns of a raw table, but for ``before_doc`` and ``after_doc``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.sources.events import read_or_empty

COLUMNS = ["event_id", "op", "ts_ms", "source_table", "lsn", "before_doc", "after_doc"]
SCHEMA = (
    "event_id string, op string, ts_ms bigint, source_table string, lsn bigint, "
    "before_doc variant, after_doc variant, load_id bigint"
)


def with_documents(raw: DataFrame) -> DataFrame:
    """Raw events with parsed payloads. Text that is no JSON stops the job, as in landing."""
    docs = [F.parse_json(f"{side}_json").alias(f"{side}_doc") for side in ("before", "after")]
    return raw.select(*COLUMNS[:-2], *docs)


def write_documents(raw: DataFrame, path: str, load_id: int) -> None:
    """Write the events of one load; a repeated load rewrites its own folder."""
    with_documents(raw).write.mode("overwrite").parquet(f"{path}/load_id={load_id}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, SCHEMA)
