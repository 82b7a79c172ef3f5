"""Column expressions (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skuflow.schema import ISO_LOCAL_DATETIME, SALE, TRACE_FORMAT


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quantity_or_zero(quantity: str | Column = "quantity") -> Column:
    """Absent / null quantity counts as 0, widened to LONG before any arithmetic."""
    return F.coalesce(_col(quantity), F.lit(0)).cast("long")


def signed_quantity(type_: str | Column = "type", quantity: str | Column = "quantity") -> Column:
    """Signed stock change of one transaction.

    Exactly ``SALE`` (case-sensitive) subtracts; everything else adds —
    including a null type, whose null comparison falls to ``otherwise``.
    """
    q = quantity_or_zero(quantity)
    return F.when(_col(type_) == F.lit(SALE), -q).otherwise(q)


def trace_line(item: str | Column = "itemID", stock: str | Column = "currentStock") -> Column:
    """Console trace text of an inventory change: ``{ itemID: X -> n``."""
    return F.format_string(TRACE_FORMAT, _col(item), _col(stock))


def iso_now() -> Column:
    """Current local date-time as ISO text (microsecond precision)."""
    return F.date_format(F.current_timestamp(), ISO_LOCAL_DATETIME)


def iso_text(ts: str | Column) -> Column:
    return F.date_format(_col(ts), ISO_LOCAL_DATETIME)


def utf8(c: str | Column) -> Column:
    """Bytes (Kafka key/value) to UTF-8 text; text passes through."""
    return _col(c).cast("string")
