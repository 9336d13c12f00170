"""Pickups that bypass the first-mile hub, and creation and pickup dates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelspark import fixed_values as V
from parcelspark.operators.dims import station_dim
from parcelspark.operators.events import first, first_event, found_in_window, latest_event, milestones
from parcelspark.operators.lookup import as_keys, keyed
from parcelspark.operators.rules import type_by_name
from parcelspark.plans.base import Context, has
from parcelspark.settings import Settings

# Order types by the full name of the type. Names that carry a brand are added by
# the caller (see `order_types`).
ORDER_TYPES = {"CB": "CB", "BULKY_MARKETPLACE": "BKY"}


def _direct_pickups(spark: SparkSession, ctx: Context, first_days: int, last_days: int, sort_centres, with_seller: bool) -> DataFrame:
    """Shipments picked up in the window and never received at a first-mile hub."""
    tables, status = ctx.tables, F.col("status")
    at_sort = has(status, V.RECEIVED) & F.col("station_id").isin(*sort_centres)
    # The window picks the shipments; receipts of any time are then read for them only.
    pickups, keys = found_in_window(
        tables.counted, ctx.events(*V.PICKED_UP), ctx.begin(first_days), ctx.begin(last_days - 1),
        ("ctime", "user_id", "station_id", "operator"), between=ctx.between,
    )
    pickups = pickups.filter("user_id IS NOT NULL AND operator IS NOT NULL")
    receipts = milestones(
        ctx.events(*V.RECEIVED, *V.FIRST_MILE_RECEIVED),
        {"sort": first(at_sort), "hub": first(has(status, V.FIRST_MILE_RECEIVED))},
        only=keys,
    )
    picked = (
        pickups.join(receipts, "shipment_id", "left")
        .filter("hub IS NULL")
        .select(
            "shipment_id",
            ctx.ts().alias("pickup_time"),
            F.col("user_id").alias("driver_id"),
            F.col("operator").alias("driver_name"),
            F.col("station_id").cast("int").alias("_station_id"),
            F.col("sort").isNotNull().cast("int").alias("is_soc_rec"),
        )
    )
    stations = tables.dimension("station_raw").withColumn("id", F.col("id").cast("int"))
    allocation = tables["pickup_alloc"].select(
        F.col("pickup_order_id").cast("string").alias("shipment_id"),
        "pickup_task_id",
        "pickup_point_id",
        "allocated_time",
    )
    newest = latest_event(
        allocation, cols=("pickup_task_id", "pickup_point_id"),
        order=("allocated_time", "pickup_task_id", "pickup_point_id"), only=keys,
    )
    out = (
        tables["fleet_order"].select("shipment_id", "cogs")
        .join(picked, "shipment_id")
        .join(station_dim(stations, "pickup_station_name", "_station_id", key="id"), "_station_id")
        .filter("pickup_station_name IS NOT NULL")
        .join(newest, "shipment_id", "left")
        .withColumn("is_no_pu_task", F.when(F.col("pickup_task_id") == "", 1).otherwise(0))
    )
    if with_seller:
        sellers = tables["seller_info"].select("shipment_id", "shop_id", "seller_name")
        out = out.join(sellers, "shipment_id", "left")
    return out


def direct_pickup_summary(
    spark: SparkSession,
    tables,
    as_of: date,
    *,
    first_days: int = 30,
    last_days: int = 1,
    sort_centres=V.SORT_CENTRES,
    seller_is_unique: bool = False,
    settings: Settings = Settings(),
) -> DataFrame:
    """Pickups that bypassed the first-mile hub per day, driver and pickup point.

    The seller table adds no column here but counts a shipment once per seller row; with
    `seller_is_unique` the join is left out.
    """
    ctx = Context(tables, settings, as_of)
    rows = _direct_pickups(spark, ctx, first_days, last_days, sort_centres, with_seller=not seller_is_unique)
    return (
        rows.groupBy(F.col("pickup_time").cast("date").alias("report_date"), "driver_id", "pickup_point_id")
        .agg(
            F.count("*").alias("total_order_in_pu_task"),
            F.sum("is_soc_rec").alias("total_soc_rec"),
            (F.count("*") - F.sum("is_soc_rec")).alias("diff"),
            F.sum("is_no_pu_task").alias("total_no_pu_task"),
        )
        .orderBy(F.desc("report_date"), F.asc_nulls_last("driver_id"), F.asc_nulls_last("pickup_point_id"))
    )


def sortation_not_received(
    spark: SparkSession,
    tables,
    as_of: date,
    *,
    first_days: int = 30,
    last_days: int = 1,
    sort_centres=V.SORT_CENTRES,
    settings: Settings = Settings(),
) -> DataFrame:
    """The same pickups one by one, where no task was given or the sort centre got nothing."""
    ctx = Context(tables, settings, as_of)
    return (
        _direct_pickups(spark, ctx, first_days, last_days, sort_centres, with_seller=True)
        .filter((F.col("pickup_task_id") == "") | (F.col("is_soc_rec") == 0))
        .select(
            "shipment_id", "pickup_time", "pickup_task_id", "pickup_point_id", "pickup_station_name",
            "driver_id", "driver_name", "shop_id", "seller_name", "is_soc_rec", "cogs", "is_no_pu_task",
        )
    )


def created_and_pickup_dates(
    spark: SparkSession,
    tables,
    keys: DataFrame | Iterable[str],
    *,
    order_types: Mapping[str, str] | None = None,
    dedupe: bool = False,
    settings: Settings = Settings(),
) -> DataFrame:
    """Creation time and pickup date of the requested shipments.

    Repeated creations and pickups give a row for each pair of them; `dedupe` keeps the first
    of each. `order_types` adds full type names to the known ones.
    """
    ctx = Context(tables, settings)
    wanted = as_keys(spark, keys)
    pick = (lambda e: first_event(e, cols=("ctime",), only=wanted)) if dedupe else (lambda e: keyed(e, wanted))
    created, picked_up = pick(ctx.events(*V.CREATED)), pick(ctx.events(39))
    types = keyed(tables["shipment_info"], wanted).select(
        "shipment_id",
        type_by_name(F.col("order_type_name"), {**ORDER_TYPES, **(order_types or {})}).alias("order_type"),
    )
    return (
        created.select("shipment_id", ctx.ts().alias("created_timestamp"))
        .join(picked_up.select("shipment_id", ctx.ts().cast("date").alias("pickup_done_date")), "shipment_id", "left")
        .join(types, "shipment_id", "left")
        .select("shipment_id", "order_type", "created_timestamp", "pickup_done_date")
    )
