"""Column expressions; all run inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType


def money(c: str | Column) -> Column:
    """A double that holds cents as an exact decimal, so that sums do not depend on their order."""
    return F.col(c).cast("decimal(15,2)") if isinstance(c, str) else c.cast("decimal(15,2)")


def json_long(c: str, path: str) -> Column:
    """A whole number in a JSON text; null if it is missing or no number."""
    return F.get_json_object(c, path).try_cast("bigint")


def micros(c: str, kind: DataType) -> Column:
    """Microseconds since 1970 of a timestamp or date, without a time zone's gaps for those that have none; a whole number as it is."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("bigint") * 86_400_000_000
    if isinstance(kind, TimestampNTZType):
        seconds = F.unix_date(F.col(c).cast("date")).cast("bigint") * 86_400 + F.hour(c) * 3600 + F.minute(c) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    return F.col(c).cast("bigint")
