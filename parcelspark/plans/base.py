"""What every report starts from."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from parcelspark.functions.clock import days_before, epoch_of, event_ts
from parcelspark.functions.jsontext import json_int, json_int_strict, json_text
from parcelspark.operators.events import with_tie_break
from parcelspark.settings import Settings


class Context:
    """The event log, its clock and its date windows."""

    def __init__(self, tables: Mapping[str, DataFrame], settings: Settings, as_of: date | None = None):
        self.tables = tables
        self.settings = settings
        self.as_of = as_of
        self.log = with_tie_break(tables["tracking"])

    def events(self, *statuses: int) -> DataFrame:
        """Events of these statuses; the list reaches the scan as a pushed filter."""
        return self.log.filter(F.col("status").isin(*statuses))

    def between(self, begin: int | None = None, end: int | None = None) -> Column:
        """Events in [begin, end), and the partitions that hold them."""
        return self.tables.between("tracking", begin, end)

    def text(self, key: str) -> Column:
        """A field of an event's JSON text, or the column that holds it."""
        column = self.tables.field("tracking", key)
        return json_text("content", key) if column is None else F.col(column)

    def number(self, key: str, strict: bool = False) -> Column:
        column = self.tables.field("tracking", key)
        if column is None:
            return (json_int_strict if strict else json_int)("content", key)
        return F.col(column).cast("int") if strict else F.col(column).try_cast("int")

    def ts(self, ctime: Column | str = "ctime") -> Column:
        return event_ts(ctime, self.settings.utc_offset_seconds)

    def begin(self, days_ago: int, hours: int = 0) -> int:
        """Epoch second at which the day `days_ago` days before `as_of` begins (plus hours)."""
        return epoch_of(days_before(self.as_of, days_ago), self.settings.utc_offset_seconds, hours)


def has(status: Column, codes) -> Column:
    return status.isin(*codes)


def shipment_attributes(tables, names, prefer: tuple[str, str]) -> dict[str, list[str]]:
    """Which of two shipment tables to read each attribute from."""
    found: dict[str, list[str]] = {t: [] for t in prefer}
    for name in names:
        found[tables.owner(name, *prefer)].append(name)
    return found
