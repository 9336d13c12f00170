"""Lost and damaged shipments of one day, with the team that answers for each."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelspark import fixed_values as V
from parcelspark.functions.text import first_list_item, last_list_item, station_code
from parcelspark.operators.dims import station_dim
from parcelspark.operators.events import (
    event_before, first, first_event, found_in_window, last, latest_event, milestones, with_tie_break,
)
from parcelspark.operators.lookup import keyed, role
from parcelspark.operators.rules import responsible_team
from parcelspark.plans.base import Context, has
from parcelspark.settings import Settings

_ATTRIBUTES = (
    "is_dropoff", "cogs", "_4pl_name", "origin_order_path", "updated_order_path_lm_hub_station_name",
    "drop_off_sp",
)


def loss_damage_attribution(
    spark: SparkSession,
    tables,
    as_of: date,
    *,
    losses=V.DAMAGED_OR_LOST,
    before_events=V.DAMAGED_LOST_OR_FOUND,
    settings: Settings = Settings(),
) -> DataFrame:
    """Shipments whose first loss or damage fell on the day before `as_of`.

    That day's losses are found first; every other table is then read only for those shipments,
    and so is the log, once: milestones and the events before losses come out of the same rows.
    """
    ctx = Context(tables, settings, as_of)
    lost, keys = found_in_window(
        tables.counted, ctx.events(*losses), ctx.begin(1), ctx.begin(0), ("status", "ctime"), between=ctx.between
    )
    lost = lost.withColumnRenamed("ctime", "_lost_at")

    status = F.col("status")
    on_trip = has(status, V.TRIP)
    events = tables.keep(
        keyed(ctx.log, keys).select(
            "shipment_id", "status", "station_id", "operator", "ctime", "event_id",
            F.when(on_trip, ctx.text("linehaul_task_id")).alias("_task"),
            F.when(on_trip, ctx.text("to_number")).alias("_sack"),
        )
    )
    history = milestones(
        events,
        {
            "created": first(has(status, V.CREATED)),
            "pickup": first(has(status, V.PICKED_UP)),
            "trip": last(on_trip, "_task", "_sack"),
        },
    ).select(
        "shipment_id",
        ctx.ts("created.ctime").alias("created_timestamp"),
        ctx.ts("pickup.ctime").alias("pickup_timestamp"),
        F.col("trip._task").alias("latest_lh_task_id"),
        F.col("trip._sack").alias("latest_to_number"),
    )

    before = (
        event_before(events, events.filter(status.isin(*before_events)), ("status", "station_id", "ctime", "operator"))
        .select(
            "shipment_id",
            F.col("prev.status").alias("_status"),
            F.col("prev.station_id").alias("_station_id"),
            ctx.ts("prev.ctime").alias("timesatmp_before_dl"),
            F.col("prev.operator").alias("latest_operator"),
        )
        .join(role(tables.statuses(), "status", {"status_name": "latest_status_before_dl"}, "_status"), "_status", "left")
        .join(station_dim(tables.dimension("station"), "latest_station_before_dl", "_station_id"), "_station_id", "left")
        .drop("_status", "_station_id")
    )

    failed = latest_event(
        with_tie_break(tables["failed_op_log"]), cols=("station_name", "error_msg", "ctime"), only=keys
    ).select(
        "shipment_id",
        "error_msg",
        station_code(F.col("station_name")).alias("unsucessful_log_hub"),
        ctx.ts().alias("error_timestamp"),
    )
    remarks = with_tie_break(
        tables["abnormal_log"].filter(F.col("new_status").isin(*losses)).withColumnRenamed("order_id", "shipment_id")
    )
    remark = first_event(remarks, cols=("remark",), only=keys)

    owner = {c: tables.owner(c, "shipment_info", "fleet_order_dwd") for c in _ATTRIBUTES if c != "cogs"}
    owner["cogs"] = "fleet_order_dwd"
    of = lambda name: [c for c, t in owner.items() if t == name]
    info = keyed(tables["shipment_info"], keys).select("shipment_id", "cod_amount", *of("shipment_info"))
    master = keyed(tables["fleet_order_dwd"], keys).select("shipment_id", *of("fleet_order_dwd"))
    seller = keyed(tables["seller_order"], keys).select("shipment_id", "seller_name")

    return (
        lost.join(tables.statuses(one_name=True), "status", "left")
        .join(master, "shipment_id", "left")
        .join(info, "shipment_id", "left")
        .join(seller, "shipment_id", "left")
        .join(history, "shipment_id", "left")
        .join(failed, "shipment_id", "left")
        .join(before, "shipment_id", "left")
        .join(remark, "shipment_id", "left")
        .withColumn("_origin", last_list_item(F.col("origin_order_path")))
        .join(
            station_dim(tables.dimension("station"), "origin_hub_destination", "_origin_id").withColumn(
                "_origin", F.col("_origin_id").cast("string")
            ),
            "_origin",
            "left",
        )
        .select(
            "shipment_id",
            F.col("status_name").alias("latest_status_name"),
            "cod_amount",
            F.col("cogs").cast("double").alias("cogs_amount"),
            "seller_name",
            F.when(F.col("drop_off_sp") == 0, "PICKUP").otherwise("SHUTTLE").alias("original_fm_type"),
            F.when(first_list_item(F.col("origin_order_path")) == "3", "DIRECT")
            .otherwise("SHUTTLE")
            .alias("direct_shuttle_type"),
            F.nullif(F.col("_4pl_name"), F.lit(settings.home_carrier)).alias("_4pl_provider"),
            "latest_lh_task_id",
            "latest_to_number",
            "origin_hub_destination",
            F.col("updated_order_path_lm_hub_station_name").alias("update_hub_destination"),
            "latest_operator",
            "latest_status_before_dl",
            "latest_station_before_dl",
            "timesatmp_before_dl",
            "created_timestamp",
            "pickup_timestamp",
            ctx.ts("_lost_at").cast("date").alias("end_status_timestamp"),
            "error_timestamp",
            "unsucessful_log_hub",
            "error_msg",
            responsible_team(
                F.col("latest_status_before_dl"), F.col("latest_station_before_dl"), F.col("is_dropoff")
            ).alias("lost_pic"),
            "remark",
        )
        .distinct()
        .orderBy("end_status_timestamp")
    )
