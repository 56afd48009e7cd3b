"""Reading attributes out of JSON payload text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changefold.config import Field


def json_text(doc: str | Column, name: str) -> Column:
    """One attribute of a JSON document as text; NULL if absent or null."""
    return F.get_json_object(doc, f"$.{name}")


def record_key(key: str, after: str = "after_json", before: str = "before_json") -> Column:
    """The record's key as a strict bigint, from the new image or else the old one."""
    return F.coalesce(json_text(after, key), json_text(before, key)).cast("bigint")


def text_fields(doc: str | Column, fields: tuple[Field, ...]) -> Column:
    """Read a payload's attributes as text columns, parsing it once.

    Text first and typed casts after it, so a number that arrives as a string
    (or the other way round) is not lost to a JSON type mismatch. As a generator
    it is also not repeated inside filters that are pushed towards it.
    """
    names = [f.name for f in fields]
    return F.json_tuple(doc, *names).alias(*names)


def variant_text(doc: str | Column, name: str) -> Column:
    """One attribute of a variant document as text; NULL if absent, null or no document.

    Numbers come in their shortest form, objects and arrays as NULL.
    """
    return F.try_variant_get(F.col(doc) if isinstance(doc, str) else doc, f"$.{name}", "string")


def variant_key(key: str, after: str = "after_doc", before: str = "before_doc") -> Column:
    """``record_key`` of a variant payload."""
    return F.coalesce(variant_text(after, key), variant_text(before, key)).cast("bigint")


def typed(value: Column, field: Field) -> Column:
    if field.kind == "id":
        out = value.cast("bigint")
    elif field.kind == "money":
        out = to_money(value)
    elif field.kind == "time":
        out = to_naive_timestamp(value)
    else:
        out = value
    if field.default is not None:
        out = F.coalesce(out, F.lit(field.default))
    return out.alias(field.name)


def to_money(text: Column) -> Column:
    """Lenient decimal(12,2): text that is no number becomes NULL."""
    return text.try_cast("decimal(12,2)")


def to_naive_timestamp(text: Column) -> Column:
    """Lenient timestamp without zone; an offset in the text is dropped.

    Only text that starts with a full date and has no outer blanks is read:
    Spark alone would also accept ``2026`` or `` 2026-01-01 ``.
    """
    complete = text.rlike(r"(?s)^\d{4}-\d{1,2}-\d{1,2}(.*\S)?$")
    return F.when(complete, text.try_cast("timestamp_ntz"))


def event_time(ts_ms: str | Column = "ts_ms") -> Column:
    """Epoch milliseconds as a timestamp, milliseconds kept."""
    return F.timestamp_millis(F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms)


def event_date(ts_ms: str | Column = "ts_ms") -> Column:
    return F.to_date(event_time(ts_ms))


def event_id(table: str | Column, key: Column, op: Column, ts_ms: Column, lsn: Column) -> Column:
    """Repeatable event id, for logs whose source sends none."""
    table = F.lit(table) if isinstance(table, str) else table
    parts = [c.cast("string") for c in (table, key, op, ts_ms, lsn)]
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 16)
