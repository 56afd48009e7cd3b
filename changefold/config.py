"""What a change log looks like and how its rows are read.

Everything that is particular to one source table is held in ``LogConfig``, so
the operators stay generic; ``ORDERS`` and ``CUSTOMERS`` are two configurations.
"""

from __future__ import annotations

from dataclasses import dataclass

# Names, types and defaults every reader of the tables relies on.
ORDER_STATUSES = ["pending", "confirmed", "shipped", "delivered", "cancelled", "refunded"]
LOST_STATUSES = ["cancelled", "refunded"]
COMPLETED_STATUS = "delivered"
CUSTOMER_TIERS = ["bronze", "silver", "gold", "platinum"]
DEFAULT_CURRENCY = "INR"
DELETE_OP = "d"
EARLIEST = "1900-01-01 00:00:00"
SNAPSHOT_CHECK_COLUMNS = ["tier", "country", "email"]
MAX_ORPHAN_PCT = 5.0


@dataclass(frozen=True)
class Field:
    """One payload attribute: its JSON name, target type and default.

    ``kind`` is ``text``, ``id`` (strict: a bad value stops the job), ``money``
    or ``time`` (lenient: a bad value becomes NULL).
    """

    name: str
    kind: str = "text"
    default: str | None = None


@dataclass(frozen=True)
class LogConfig:
    """A source table whose changes arrive as a log."""

    source_table: str
    raw_table: str
    key: str
    fields: tuple[Field, ...]
    keep_op: bool = False


ORDERS = LogConfig(
    source_table="orders",
    raw_table="raw_orders_cdc",
    key="order_id",
    fields=(
        Field("customer_id", "id"),
        Field("status"),
        Field("amount", "money"),
        Field("currency", default=DEFAULT_CURRENCY),
        Field("created_at", "time"),
        Field("updated_at", "time"),
    ),
    keep_op=True,
)

CUSTOMERS = LogConfig(
    source_table="customers",
    raw_table="raw_customers_cdc",
    key="customer_id",
    fields=(
        Field("full_name"),
        Field("email"),
        Field("country"),
        Field("tier"),
        Field("created_at", "time"),
        Field("updated_at", "time"),
    ),
)

# The log's own order: event time, then log position. The event id only makes
# ties between different events repeatable.
LOG_ORDER = ("ts_ms", "lsn", "event_id")
