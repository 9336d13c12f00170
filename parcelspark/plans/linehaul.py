"""Line-haul reports: trips and sacks, path punctuality, long-path orders."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelspark import fixed_values as V
from parcelspark.functions.clock import business_day, elapsed
from parcelspark.functions.jsontext import json_int, json_text
from parcelspark.functions.text import part_before
from parcelspark.operators.dims import hub_regions, station_dim
from parcelspark.operators.events import first, found_in_window, last, latest_event, latest_version, milestones
from parcelspark.operators.lookup import Keys, as_keys, keyed, lookup_rules, role
from parcelspark.operators.routes import route_rules, route_sla
from parcelspark.plans.base import Context, has
from parcelspark.settings import Settings


def latest_linehaul_and_sack(
    spark: SparkSession,
    tables,
    keys: DataFrame | Iterable[str],
    *,
    trip=V.TRIP,
    settings: Settings = Settings(),
) -> DataFrame:
    """Last trip event of each requested shipment, with trip id and sack number."""
    ctx = Context(tables, settings)
    wanted = as_keys(spark, keys)
    return latest_event(ctx.events(*trip), cols=("status", "content"), only=wanted).select(
        "shipment_id",
        "status",
        json_text("content", "linehaul_task_id").alias("latest_lh_task_id"),
        json_text("content", "to_number").alias("latest_to_number"),
    )


def seller_address(tables, only: Keys | None = None) -> DataFrame:
    """Seller province and district per shipment, or per listed one: newest pickup order, else drop-off order.
    Pickup orders tied for newest, and repeated drop-offs, each give a row."""
    of = lambda df: df if only is None else keyed(df, only)
    orders = tables["pickup_order"].select(
        F.col("pickup_order_id").alias("shipment_id"), "ctime", "seller_addr_state", "seller_addr_district"
    )
    pickup = latest_version(of(orders), "shipment_id", "ctime").drop("ctime")
    dropoff = of(tables["dropoff_order"].select("shipment_id", "seller_state", "seller_city"))
    return (
        of(tables["fleet_order"].select("shipment_id"))
        .join(pickup, "shipment_id", "left")
        .join(dropoff, "shipment_id", "left")
        .select(
            "shipment_id",
            F.coalesce("seller_addr_state", "seller_state").alias("seller_province"),
            F.coalesce("seller_addr_district", "seller_city").alias("seller_district"),
        )
    )


def _with_addresses(df: DataFrame, tables) -> DataFrame:
    regions = tables.dimension("region_index").select("province", "lh_region").distinct()
    df, keys = tables.counted(df)
    return (
        df.join(keyed(tables["buyer_info"].select("shipment_id", "buyer_addr_state"), keys), "shipment_id", "left")
        .join(seller_address(tables, keys), "shipment_id", "left")
        .join(role(regions, "province", {"lh_region": "buyer_region"}, "buyer_addr_state"), "buyer_addr_state", "left")
        .join(role(regions, "province", {"lh_region": "seller_region"}, "seller_province"), "seller_province", "left")
    )


def linehaul_path_performance(
    spark: SparkSession,
    tables,
    as_of: date,
    *,
    with_addresses: bool = False,
    settings: Settings = Settings(),
) -> DataFrame:
    """Shipments that went from one regional centre over the sort centre to another, with trips,
    drivers and four on-time flags. The log is read once, back to 120 days.

    `with_addresses` joins buyer and seller regions. They change no column; tied address
    versions repeat rows.
    """
    ctx = Context(tables, settings, as_of)
    status, station, ctime = F.col("status"), F.col("station_id"), F.col("ctime")
    at_sort, at_pickup = has(station, V.SORT_CENTRES), has(station, V.PICKUP_CENTRES)
    at_delivery, at_any = has(station, V.DELIVERY_CENTRES), has(station, V.ALL_CENTRES)
    received, left, arrived = status == 8, status == 15, status == 36
    loaded = (status == 35) & (ctime >= ctx.begin(60))
    recent = received & (ctime >= ctx.begin(14))

    events = ctx.events(8, 15, 36, 35).filter(
        ctx.between(ctx.begin(120)) & station.isin(*V.SORT_CENTRES, *V.ALL_CENTRES)
    )
    picked = milestones(
        events,
        {
            "soc_in": first(at_sort & received),
            "soc_out": first(at_sort & left),
            "rc_in": first(at_pickup & received),
            "rc_out": first(at_pickup & left),
            "rc_arrived": first(at_pickup & arrived),
            "rc_last": last(at_any & received),
            "pickup_at": first(at_pickup & recent, "station_id"),
            "delivery_at": last(at_delivery & recent, "station_id"),
            "backhaul": first(at_delivery & loaded, "content"),
            "shuttle": first(at_sort & loaded, "content"),
        },
    ).filter((F.col("soc_in.ctime") >= ctx.begin(30, 6)) & (F.col("soc_in.ctime") < ctx.begin(0, 6)))

    raw = tables.dimension("station_raw")
    paths = (
        picked.select(
            "shipment_id",
            F.col("pickup_at.station_id").alias("_pickup_id"),
            F.when(F.col("rc_last.ctime") > F.col("soc_in.ctime"), F.col("delivery_at.station_id")).alias(
                "_delivery_id"
            ),
            (F.col("rc_in.ctime") < F.col("soc_in.ctime")).alias("_before_sort"),
            ctx.ts("rc_in.ctime").alias("xrc_received_time"),
            ctx.ts("soc_in.ctime").alias("min_soc_received"),
            ctx.ts("soc_out.ctime").alias("min_soc_lh_transporting"),
            ctx.ts("rc_out.ctime").alias("min_xrc_lh_transporting_time"),
            ctx.ts("rc_arrived.ctime").alias("min_xrc_lh_transported_time"),
            json_text("backhaul.content", "linehaul_task_id").alias("backhaul_lh_task"),
            json_text("shuttle.content", "linehaul_task_id").alias("shuttle_lh_task"),
        )
        .filter("_before_sort AND _delivery_id IS NOT NULL")
        .withColumn(
            "rc_to_soc_delivery_leadtime",
            elapsed("HOUR", F.col("min_xrc_lh_transporting_time"), F.col("min_xrc_lh_transported_time")).cast("int"),
        )
        .join(station_dim(raw, "pickup_rc_station", "_pickup_id", key="id"), "_pickup_id")
        .join(station_dim(raw, "delivery_rc_station", "_delivery_id", key="id"), "_delivery_id")
    )
    routed = route_sla(paths, route_rules(spark), fixed=True).join(
        tables["fleet_order"].select("shipment_id"), "shipment_id"
    )
    if with_addresses:
        routed = _with_addresses(routed, tables)

    trips = (
        tables["linehaul_task"].select("task_number", "driver_id")
        .join(tables["driver"].select("driver_id", "driver_name"), "driver_id", "left")
    )
    return (
        routed.join(role(trips, "task_number", {"driver_name": "back_haul_driver"}, "backhaul_lh_task"), "backhaul_lh_task", "left")
        .join(role(trips, "task_number", {"driver_name": "shuttle_driver"}, "shuttle_lh_task"), "shuttle_lh_task", "left")
        .select(
            business_day(F.col("min_soc_received"), 6).alias("report_date"),
            "shipment_id",
            "lh_route",
            "pickup_rc_station",
            "backhaul_lh_task",
            "back_haul_driver",
            F.lit("SOCE").alias("soc_station"),
            "shuttle_lh_task",
            "shuttle_driver",
            "delivery_rc_station",
            "is_rc_transporting_ontime",
            "is_rc_transported_ontime",
            "rc_traveling_soc_leadtime_check",
            "is_soc_transporting_ontime",
            F.col("xrc_received_time").alias("pu_rc_received_time"),
            "min_xrc_lh_transporting_time",
            "min_xrc_lh_transported_time",
            "min_soc_received",
            "min_soc_lh_transporting",
            "rc_to_soc_delivery_leadtime",
        )
        .orderBy(F.desc("report_date"), "lh_route")
    )


def long_path_orders(
    spark: SparkSession,
    tables,
    day: date,
    *,
    stations=V.REGIONAL,
    settings: Settings = Settings(),
) -> DataFrame:
    """Shipments first received on `day` at a regional centre, with latest status, the region
    they go to, and the first handover at the same centre.

    Two passes: the first receipts up to that day, then only the events of the shipments found:
    handovers of any time, and for the latest status what happened from that day on.
    """
    ctx = Context(tables, settings, day)
    station = tables.dimension("station")
    begin, end = ctx.begin(0), ctx.begin(-1)
    first_receipts, _ = found_in_window(
        tables.counted, ctx.events(*V.RECEIVED), begin, end, ("ctime", "station_id"), between=ctx.between
    )
    # A few centres' receipts: a much shorter list of keys than that of all receipts of the day.
    received, keys = tables.counted(
        first_receipts.select("shipment_id", F.col("ctime").alias("_rec"), F.col("station_id").alias("_station_id"))
        .join(station_dim(station, "pickup_rc_station_name", "_station_id"), "_station_id")
        .filter(F.col("pickup_rc_station_name").isin(*stations))
        .drop("_station_id")
    )
    handed_over = has(F.col("status"), V.HANDED_OVER)
    picked = milestones(
        ctx.log.filter(handed_over | ctx.between(begin)),
        {"final": last(None, "status", "ctime"), "over": first(handed_over, "ctime", "operator", "content")},
        only=keys,
    ).select(
        "shipment_id",
        F.col("final.status").alias("status"),
        F.col("over.ctime").alias("_over"),
        F.col("over.operator").alias("operator"),
        json_int("over.content", "station_id").alias("_over_id"),
    )

    destinations = (
        keyed(tables["fleet_order"], keys)
        .select("shipment_id", "pickup_station_id", "station_id")
        .join(tables["shipment_info"].select("shipment_id", "buyer_region_name"), "shipment_id", "left")
        .join(station_dim(station, "_dest", "station_id"), "station_id", "left")
    )
    destinations = lookup_rules(
        destinations, hub_regions(spark), {"code": part_before(F.col("_dest"), " ")}, {"region": "_region"}, fixed=True
    ).select("shipment_id", F.coalesce("_region", "buyer_region_name").alias("rc_delivery_station"))

    return (
        received.join(destinations, "shipment_id")
        .join(picked, "shipment_id")
        .join(tables.statuses(one_name=True), "status", "left")
        .join(station_dim(station, "_over_station", "_over_id"), "_over_id", "left")
        .select(
            ctx.ts("_rec").cast("date").alias("rc_received_date"),
            "shipment_id",
            "pickup_rc_station_name",
            "rc_delivery_station",
            F.col("status_name").alias("last_staus_name"),
            F.when(F.col("_over_station") == F.col("pickup_rc_station_name"), ctx.ts("_over")).alias(
                "min_soc_handover_time_stamp"
            ),
            "operator",
        )
        .distinct()
    )
