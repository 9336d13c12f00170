"""Work at one station."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelspark import fixed_values as V
from parcelspark.functions.clock import business_day, next_iso_week
from parcelspark.operators.dims import station_dim
from parcelspark.operators.events import found_in_window
from parcelspark.operators.lookup import as_keys, keyed
from parcelspark.plans.base import Context
from parcelspark.settings import Settings


def overseas_hub_performance(
    spark: SparkSession,
    tables,
    as_of: date,
    *,
    hub: str = "SIP-LMHub",
    sort_centre: str = "3",
    days: int = 18,
    settings: Settings = Settings(),
) -> DataFrame:
    """Every arrival at one overseas hub, with the first receipt at the sort centre; receipts of
    the last `days` business days."""
    ctx = Context(tables, settings, as_of)
    # Candidates out of the window; whether they had an earlier receipt, and when they arrived, is read for them only.
    received, keys = found_in_window(
        tables.counted, ctx.events(*V.RECEIVED), ctx.begin(days, 6), ctx.begin(-1, 6), ("ctime",),
        ctx.text("station_id") == sort_centre, between=ctx.between,
    )
    received = received.select("shipment_id", ctx.ts().alias("received_time"))
    arrived = (
        keyed(ctx.events(*V.LINEHAUL_ARRIVED), keys)
        .filter(ctx.text("dest_station_name") == hub)
        .select("shipment_id", ctx.ts().alias("lhtransported_time"))
    )
    return (
        arrived.join(received, "shipment_id")
        .select(
            "shipment_id",
            F.when(F.col("shipment_id").isNotNull(), settings.home_carrier).alias("channel"),
            "received_time",
            "lhtransported_time",
            business_day(F.col("received_time"), 6).alias("received_date"),
            business_day(F.col("lhtransported_time"), 6).alias("lhtransported_date"),
            next_iso_week(F.col("received_time")).alias("week_num"),
        )
        .orderBy("received_date")
    )


def first_touch_by_operator(
    spark: SparkSession,
    tables,
    as_of: date,
    operators: DataFrame | Iterable[str],
    *,
    station: str = "Sorting center",
    settings: Settings = Settings(),
) -> DataFrame:
    """Shipments first touched at the station on the business day before `as_of`, by one of the
    operators."""
    ctx = Context(tables, settings, as_of)
    here = station_dim(tables.dimension("station").filter(F.col("station_name") == station), "station_name")
    touched, _ = found_in_window(
        tables.counted, ctx.log.join(here, "station_id"), ctx.begin(1, 6), ctx.begin(0, 6),
        ("status", "operator", "ctime", "station_name"), between=ctx.between,
    )
    return (
        keyed(touched, as_keys(spark, operators, "operator"))
        .join(tables.statuses(one_name=True), "status", "left")
        .select(
            "shipment_id",
            "status_name",
            "operator",
            ctx.ts().alias("x_timestamp"),
            business_day(ctx.ts(), 6).alias("received_date"),
            "station_name",
        )
    )
