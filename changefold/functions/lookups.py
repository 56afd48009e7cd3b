"""Small fixed lookups used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changefold.config import ORDER_STATUSES

# Country codes, flags and operation labels shown to readers.
ISO3 = {
    "IN": "IND", "US": "USA", "GB": "GBR", "AE": "ARE",
    "SG": "SGP", "AU": "AUS", "DE": "DEU", "CA": "CAN",
}
FLAGS = {
    "IN": "🇮🇳", "US": "🇺🇸", "GB": "🇬🇧", "AE": "🇦🇪",
    "SG": "🇸🇬", "AU": "🇦🇺", "DE": "🇩🇪", "CA": "🇨🇦",
}
OP_LABELS = {"c": "Create", "u": "Update", "d": "Delete", "r": "Snapshot"}


def lookup(value: Column, table: dict[str, str | int], default: Column | None = None) -> Column:
    """Map a column through a literal table, inside the running stage (no join)."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    found = F.try_element_at(F.create_map(*entries), value)
    return found if default is None else F.coalesce(found, default)


def iso3(country: Column) -> Column:
    return lookup(country, ISO3)


def flag(country: Column) -> Column:
    return lookup(country, FLAGS, default=F.lit(""))


def op_label(op: Column) -> Column:
    return lookup(op, OP_LABELS, default=op)


def status_rank(status: Column) -> Column:
    return lookup(status, {s: i for i, s in enumerate(ORDER_STATUSES)})
