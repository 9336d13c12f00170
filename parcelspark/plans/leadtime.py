"""Lead times by function and by partner."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelspark import fixed_values as V
from parcelspark.functions.clock import business_day, elapsed, moment
from parcelspark.functions.jsontext import json_int
from parcelspark.operators.dims import station_dim
from parcelspark.operators.events import dwell_hours, first, found_in_window, milestones, neighbours
from parcelspark.operators.lookup import as_keys, keyed
from parcelspark.operators.metrics import mean_interval, pivot_sums
from parcelspark.operators.rules import flow_by_mention, function_of_leg, stations_of_leg, type_by_code
from parcelspark.plans.base import Context, has
from parcelspark.settings import Settings

# Functions in the order of the report's columns.
FUNCTIONS = ("SDOP", "PS", "FM", "RC", "SOC", "LH", "4PL", "LM")
# Centres that hand over to partners.
PARTNER_STATIONS = ("NERC-A", "NERC-B", "SORC-A", "SORC-B", "NORC-A", "NORC-B")


def leadtime_by_function(
    spark: SparkSession,
    tables,
    keys: DataFrame | Iterable[str],
    now: datetime,
    *,
    ignored=V.LEADTIME_IGNORED,
    terminal=V.LEADTIME_TERMINAL,
    settings: Settings = Settings(),
) -> DataFrame:
    """Hours between events, summed per function, forward and return, for the requested
    shipments. `now` is the local time up to which an open shipment's clock runs."""
    ctx = Context(tables, settings)
    status = F.col("status")
    wanted = as_keys(spark, keys)
    log = ctx.log.filter(~status.isin(*ignored))
    # Two fields are taken out of the JSON text before anything is moved. Few shipments' events are kept, so that
    # counting them and looking around reads the log once.
    events = (keyed(log, wanted) if wanted.few else log).select(
        "shipment_id", "status", "station_id", "ctime", "event_id",
        ctx.text("station_name").alias("_partner"),
        ctx.number("station_id", strict=True).alias("_named_id"),
    )
    events = (tables.keep(events) if wanted.few else events).join(
        station_dim(tables.dimension("station"), "_station"), "station_id", "left"
    )
    around = neighbours(
        events, before=("_station",), after=("ctime", "status", "_station"), only=None if wanted.few else wanted
    )
    partner = F.col("_partner")
    named = (
        around.withColumn(
            "_hub",
            F.when(partner.isin(*V.PARTNER_CARRIERS), partner).otherwise(F.coalesce("_station", "prev._station")),
        )
        .join(station_dim(tables.dimension("station"), "_named", "_named_id"), "_named_id", "left")
        # A status with several names must not repeat an event after its hours are known.
        .join(tables.statuses(one_name=True), "status", "left")
        .withColumns(
            stations_of_leg(status, F.col("next.status"), F.col("_hub"), F.col("next._station"), F.col("_named"))
        )
        .select(
            "shipment_id",
            flow_by_mention(F.col("status_name")).alias("_flow"),
            dwell_hours(ctx.ts(), ctx.ts("next.ctime"), status, terminal, moment(now)).alias(
                "_hours"
            ),
            function_of_leg(F.col("_partner"), settings.brand_prefix).alias("_function"),
        )
    )
    columns = {}
    for flow in ("FWD", "RTN"):
        in_flow = F.col("_flow") == flow
        columns[f"leadtime_{flow.lower()}"] = in_flow
        for function in FUNCTIONS:
            columns[f"leadtime_{function.lower()}_{flow.lower()}"] = in_flow & (F.col("_function") == function)
    # Attributes are joined to the sums, not to the events: one row per shipment is moved.
    info = keyed(tables["shipment_info"], wanted).select(
        "shipment_id",
        F.col("delivered_sla_timestamp").cast("date").alias("sla_date"),
        type_by_code(F.col("order_type_id")).alias("order_type"),
    )
    sums = pivot_sums(named, ["shipment_id"], F.col("_hours"), columns)
    return sums.join(info, "shipment_id", "left").select("sla_date", "shipment_id", "order_type", *columns)


def partner_leadtime_summary(
    spark: SparkSession,
    tables,
    as_of: date,
    *,
    first_days: int = 120,
    last_days: int = 1,
    stations=PARTNER_STATIONS,
    settings: Settings = Settings(),
) -> DataFrame:
    """Partner-receive to delivery and handover to delivery, per business day (from 02:00) and
    handover centre."""
    ctx = Context(tables, settings, as_of)
    status = F.col("status")
    received_in, keys = found_in_window(
        tables.counted, ctx.events(*V.PARTNER_RECEIVED), ctx.begin(first_days, 2), ctx.begin(last_days - 1, 2),
        ("ctime",), between=ctx.between,
    )
    around = milestones(
        ctx.events(*V.HANDED_OVER, *V.DELIVERED),
        {"over": first(has(status, V.HANDED_OVER), "ctime", "content"), "delivered": first(has(status, V.DELIVERED))},
        only=keys,
    )
    picked = (
        received_in.join(around, "shipment_id")
        .filter("delivered IS NOT NULL")
        .select(
            ctx.ts().alias("_received"),
            ctx.ts("over.ctime").alias("_over"),
            ctx.ts("delivered.ctime").alias("_delivered"),
            json_int("over.content", "station_id").alias("_over_id"),
        )
        .join(station_dim(tables.dimension("station"), "soc_handover_station", "_over_id"), "_over_id")
        .filter(F.col("soc_handover_station").isin(*stations))
    )
    received, over, delivered = F.col("_received"), F.col("_over"), F.col("_delivered")
    return (
        picked.groupBy(business_day(received, 2).alias("date_3pl_received"), "soc_handover_station")
        .agg(
            F.count("_received").alias("_3pl_received_vol"),
            F.avg(elapsed("MINUTE", received, delivered)).cast("decimal(38,0)").alias("avg_leadtime_rec_to_del"),
            F.avg(elapsed("MINUTE", over, delivered)).cast("decimal(38,0)").alias("avg_leadtime_handover_to_del"),
            mean_interval(delivered - received).alias("leadtime_rec_to_del"),
            mean_interval(delivered - over).alias("leadtime_handover_to_del"),
        )
        .orderBy("date_3pl_received")
    )
