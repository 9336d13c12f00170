"""Current state of requested shipments."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelspark import fixed_values as V
from parcelspark.functions.jsontext import json_int_strict, json_text
from parcelspark.operators.dims import station_dim
from parcelspark.operators.events import last, latest_event, milestones
from parcelspark.operators.lookup import as_keys, keyed
from parcelspark.operators.rules import type_by_flags_contact
from parcelspark.plans.base import Context, has
from parcelspark.settings import Settings

_CONTACTS = ("buyer_name", "buyer_address", "buyer_phone", "seller_shop_id", "seller_shop_name")


def shipment_tracker(
    spark: SparkSession,
    tables,
    keys: DataFrame | Iterable[str],
    *,
    trip=V.TRIP,
    default_partner: str = V.DEFAULT_PARTNER,
    settings: Settings = Settings(),
) -> DataFrame:
    """Latest state, destination, return station, last trip and sack of each requested shipment.
    Starts from one row per shipment instead of joining the whole log to it."""
    ctx = Context(tables, settings)
    wanted = as_keys(spark, keys)
    station = tables.dimension("station")
    state = milestones(
        ctx.log,
        {
            "final": last(None, "status", "station_id", "operator", "ctime"),
            "trip": last(has(F.col("status"), trip), "content"),
        },
        only=wanted,
    ).select(
        "shipment_id",
        F.col("final.status").alias("status"),
        F.col("final.station_id").alias("station_id"),
        F.col("final.operator").alias("operator"),
        ctx.ts("final.ctime").alias("latest_timestamp"),
        json_text("trip.content", "linehaul_task_id").alias("lh_trip_number"),
        json_text("trip.content", "to_number").alias("to_number"),
    )
    masters = (
        keyed(tables["fleet_order_dwd"], wanted)
        .select("shipment_id", "cogs", F.col("station_id").alias("_lm_id"), F.col("return_station_id").alias("_ret_id"))
        .join(station_dim(station, "_lm_station", "_lm_id"), "_lm_id", "left")
        .join(station_dim(station, "return_station_name", "_ret_id"), "_ret_id", "left")
        .drop("_lm_id", "_ret_id")
    )
    types = keyed(tables["shipment_info"], wanted).select("shipment_id", F.col("order_type_id").alias("order_type"))
    return (
        state.join(masters, "shipment_id", "left")
        .join(types, "shipment_id", "left")
        .join(tables.statuses(), "status", "left")
        .join(station_dim(station, "current_station"), "station_id", "left")
        .select(
            "shipment_id",
            "status_name",
            "current_station",
            "operator",
            "order_type",
            "latest_timestamp",
            F.round("cogs").cast("int").alias("cogs"),
            F.when(F.col("operator") == default_partner, default_partner).otherwise(F.col("_lm_station")).alias("lm_destination"),
            "return_station_name",
            "lh_trip_number",
            "to_number",
        )
        .distinct()
    )


def shipment_tracker_contacts(
    spark: SparkSession,
    tables,
    keys: DataFrame | Iterable[str],
    *,
    settings: Settings = Settings(),
) -> DataFrame:
    """Latest state of each requested shipment with seller and buyer contacts."""
    ctx = Context(tables, settings)
    wanted = as_keys(spark, keys)
    owner = {c: tables.owner(c, "shipment_info", "fleet_order") for c in _CONTACTS}
    of = lambda name: [c for c, t in owner.items() if t == name]
    latest = latest_event(ctx.log, cols=("status", "ctime", "content"), only=wanted).select(
        "shipment_id", "status", ctx.ts().alias("latest_timestamp"),
        json_int_strict("content", "station_id").alias("station_id"),
    )
    info = keyed(tables["shipment_info"], wanted).select(
        "shipment_id", type_by_flags_contact().alias("order_type"), "cogs_amount", *of("shipment_info")
    )
    out = latest.join(info, "shipment_id", "left")
    if of("fleet_order"):
        orders = keyed(tables["fleet_order"], wanted).select("shipment_id", *of("fleet_order"))
        out = out.join(orders, "shipment_id", "left")
    return (
        out.join(tables.statuses(one_name=True), "status", "left")
        .join(station_dim(tables.dimension("station")), "station_id", "left")
        .select(
            "shipment_id",
            F.coalesce("order_type", F.lit("MKP")).alias("order_type"),
            F.col("status_name").alias("current_status"),
            "station_name",
            "latest_timestamp",
            "cogs_amount",
            *_CONTACTS,
        )
    )
