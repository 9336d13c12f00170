"""Source tables under short names, and the columns the reports read from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelspark.operators.dims import status_dim, status_names, status_pairs
from parcelspark.operators.lookup import Keys, bounded_broadcast
from parcelspark.operators.reuse import Kept

# Columns each table must have. Attributes that may live on either of two shipment tables are
# listed in FLOATING and looked for in both.
COLUMNS: dict[str, tuple[str, ...]] = {
    "tracking": ("shipment_id", "status", "station_id", "operator", "user_id", "ctime", "content"),
    "fleet_order": ("shipment_id", "status", "cogs", "pickup_station_id", "station_id"),
    "fleet_order_dwd": (
        "shipment_id", "station_id", "return_station_id", "cogs", "status", "returned_time", "order_type",
    ),
    "shipment_info": (
        "shipment_id", "order_type_id", "order_type_name", "latest_operator_name", "closed_timestamp",
        "delivered_sla_timestamp", "buyer_region_name", "is_warehouse", "is_cross_border",
        "is_marketplace", "is_bulky", "is_open_service", "cogs_amount", "cod_amount",
    ),
    "seller_order": ("shipment_id", "seller_name"),
    "seller_info": ("shipment_id", "shop_id", "seller_name"),
    "buyer_info": ("shipment_id", "buyer_addr_state"),
    "pickup_order": ("pickup_order_id", "ctime", "seller_addr_state", "seller_addr_district"),
    "pickup_alloc": ("pickup_order_id", "pickup_task_id", "pickup_point_id", "allocated_time"),
    "dropoff_order": ("shipment_id", "seller_state", "seller_city"),
    "failed_op_log": ("shipment_id", "station_name", "error_msg", "ctime"),
    "abnormal_log": ("order_id", "ctime", "remark", "new_status"),
    "linehaul_task": ("task_number", "driver_id"),
    "driver": ("driver_id", "driver_name"),
    "station": ("station_id", "station_name"),
    "station_raw": ("id", "station_name"),
    "status_src": ("status", "status_name"),
    "region_index": ("district_code", "gbkk_upc_ops_region", "province", "lh_region"),
}

FLOATING = (
    "is_dropoff", "_4pl_name", "origin_order_path", "updated_order_path_lm_hub_station_name",
    "drop_off_sp", "buyer_name", "buyer_address", "buyer_phone", "seller_shop_id", "seller_shop_name",
)


@dataclass(frozen=True)
class PartitionClock:
    """A partition column that follows from a table's epoch: the day (date, 'yyyy-MM-dd' text or yyyymmdd number) of
    `time` + `offset_seconds`, or up to `slack_days` before or after it. A window on the epoch then names its
    partitions too, so that files of other days are not opened for their statistics."""

    column: str
    offset_seconds: int = 0
    slack_days: int = 0

    def _literal(self, epoch: int, days: int, kind: str) -> Column:
        at = datetime.fromtimestamp(epoch + self.offset_seconds, timezone.utc).date() + timedelta(days=days)
        if kind == "date":
            return F.lit(date(at.year, at.month, at.day))
        return F.lit(at.isoformat()) if kind == "string" else F.lit(int(at.strftime("%Y%m%d")))

    def since(self, epoch: int, kind: str) -> Column:
        return F.col(self.column) >= self._literal(epoch, -self.slack_days, kind)

    def until(self, epoch: int, kind: str) -> Column:
        """Partitions of rows before the epoch second."""
        return F.col(self.column) <= self._literal(epoch - 1, self.slack_days, kind)


class Tables(Mapping[str, DataFrame]):
    """Short name -> DataFrame. Tables are opened when they are first used. What reports keep for
    their branches belongs to the Tables they read and is freed by its `release`."""

    def __init__(
        self,
        openers: Mapping[str, DataFrame | Callable[[], DataFrame]],
        clocks: Mapping[str, PartitionClock] | None = None,
        fields: Mapping[str, Mapping[str, str]] | None = None,
    ):
        """`clocks`: the partition column of a table that follows from its time. `fields`: for a table with a JSON
        column `content`, the column that holds a field's text, by field."""
        self._openers = dict(openers)
        self._clocks, self._fields = dict(clocks or {}), {t: dict(f) for t, f in (fields or {}).items()}
        self._open: dict[str, DataFrame] = {}
        self._dimensions: dict[str, DataFrame] = {}
        self._kept = Kept()

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names: tuple[str, ...] = tuple(COLUMNS), **stated) -> Tables:
        """`root/<name>` per table. The log may be partitioned by any column; the reports filter
        on the stored epoch time, so row-group statistics prune it, and whole partitions are
        left out if `clocks` states how they follow from the time."""
        return cls({n: (lambda n=n: spark.read.parquet(f"{root}/{n}")) for n in names}, **stated)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str], **stated) -> Tables:
        """Short name -> catalog table name."""
        return cls({n: (lambda full=full: spark.table(full)) for n, full in names.items()}, **stated)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            if name not in self._openers:
                raise KeyError(f"no source table {name!r}; known: {sorted(self._openers)}")
            source = self._openers[name]
            df = source() if callable(source) else source
            wanted = [*COLUMNS.get(name, ()), *self._fields.get(name, {}).values()]
            if name in self._clocks:
                wanted.append(self._clocks[name].column)
            missing = [c for c in wanted if c not in df.columns]
            if missing:
                raise ValueError(f"table {name!r} lacks columns {missing}")
            self._open[name] = df
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)

    def dimension(self, name: str) -> DataFrame:
        """A table joined to the log on a column with few, very uneven values. It is broadcast if
        counted small (once per Tables), whatever Spark estimates its size to be."""
        if name not in self._dimensions:
            self._dimensions[name] = bounded_broadcast(self[name])
        return self._dimensions[name]

    def keep(self, df: DataFrame) -> DataFrame:
        """Persist a small intermediate until `release`."""
        return self._kept.keep(df)

    def counted(self, df: DataFrame, key: str = "shipment_id") -> tuple[DataFrame, Keys]:
        """Persist a small intermediate now, until `release`, and list its keys."""
        return self._kept.counted(df, key)

    def between(self, name: str, begin: int | None = None, end: int | None = None, time: str = "ctime") -> Column:
        """Rows of a table whose epoch lies in [begin, end), and their partitions."""
        parts = [F.col(time) >= begin] if begin is not None else []
        if end is not None:
            parts.append(F.col(time) < end)
        clock = self._clocks.get(name)
        if clock is not None:
            kind = dict(self[name].dtypes)[clock.column]
            parts += [] if begin is None else [clock.since(begin, kind)]
            parts += [] if end is None else [clock.until(end, kind)]
        condition = parts[0]
        for part in parts[1:]:
            condition = condition & part
        return condition

    def field(self, name: str, key: str) -> str | None:
        """The column that holds a field of a table's JSON text, if one does."""
        return self._fields.get(name, {}).get(key)

    def release(self) -> None:
        """Free what the reports over these tables kept. Dimensions made of it are made anew."""
        self._kept.release()
        self._dimensions.clear()

    def statuses(self, one_name: bool = False) -> DataFrame:
        """Names of statuses, reduced once per Tables from a source as large as the log; see `dims`."""
        name = "one name per status" if one_name else "status names"
        if name not in self._dimensions:
            if "status pairs" not in self._dimensions:
                # made now: its size is known from then on
                self._dimensions["status pairs"] = self.counted(status_pairs(self["status_src"]), "status")[0]
            make = status_names if one_name else status_dim
            self._dimensions[name] = make(self._dimensions["status pairs"])
        return self._dimensions[name]

    def owner(self, column: str, *candidates: str) -> str:
        """The first of the candidate tables that has the column."""
        for name in candidates:
            if name in self and column in self[name].columns:
                return name
        raise ValueError(f"column {column!r} is in none of {candidates}")
