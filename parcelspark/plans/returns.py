"""Return handling at the sort centre."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelspark import fixed_values as V
from parcelspark.functions.clock import business_day, late, on_time, zero_as_missing
from parcelspark.functions.text import district_code
from parcelspark.operators.dims import station_dim
from parcelspark.operators.events import first, found_in_window, latest_event, milestones
from parcelspark.operators.lookup import keyed
from parcelspark.operators.metrics import ratio
from parcelspark.operators.rules import operator_group, return_type
from parcelspark.plans.base import Context, has
from parcelspark.settings import Settings

_BY_TYPE = ("SCOM", "GBKK", "UPC")


def return_receipts(
    spark: SparkSession,
    tables,
    as_of: date,
    *,
    first_days: int = 30,
    last_days: int = 1,
    centre: int = V.RETURN_CENTRE,
    excluded_operators=(),
    settings: Settings = Settings(),
) -> DataFrame:
    """One row per shipment returned to the centre in the window, with its outbound milestones,
    deadline flags and whether it ended lost or damaged.

    Receipts without an operator count only if no operator is excluded. A shipment's latest
    status is looked for from the first day of the window on; its receipt is in that range.
    """
    ctx = Context(tables, settings, as_of)
    status = F.col("status")
    is_receipt = has(status, V.RETURN_RECEIVED)
    for operator in excluded_operators:
        is_receipt = is_receipt & (F.col("operator") != operator)
    at_centre = F.col("station_id") == centre
    # The keys found in the window serve all later reads; those that the look-back drops only cost their rows.
    received, keys = found_in_window(
        tables.counted, ctx.events(*V.RETURN_RECEIVED).filter(at_centre), ctx.begin(first_days, 6),
        ctx.begin(last_days - 1, 6), ("ctime", "operator"), is_receipt, between=ctx.between,
    )
    outbound = milestones(
        ctx.events(*V.RETURN_PACKED, *V.RETURNING, *V.RETURN_LINEHAUL_LEFT).filter(at_centre),
        {
            "packed": first(has(status, V.RETURN_PACKED)),
            "returning": first(has(status, V.RETURNING)),
            "left": first(has(status, V.RETURN_LINEHAUL_LEFT)),
        },
        only=keys,
    )
    picked = received.join(outbound, "shipment_id", "left").select(
        "shipment_id",
        ctx.ts().alias("receive_time"),
        "operator",
        ctx.ts("packed.ctime").alias("packed_time"),
        ctx.ts("returning.ctime").alias("returning_time"),
        ctx.ts("left.ctime").alias("left_time"),
    )
    lost = (
        latest_event(
            ctx.log.filter(ctx.between(ctx.begin(first_days))),
            cols=("status", "ctime"),
            then=F.col("status").isin(*V.DAMAGED_OR_LOST),
            only=keys,
        )
        .select("shipment_id", F.lit(True).alias("damaged_lost"))
    )
    zones = tables.dimension("region_index").groupBy(F.col("district_code").alias("_district")).agg(
        F.min("gbkk_upc_ops_region").alias("_region")
    )
    masters = (
        keyed(tables["fleet_order_dwd"], keys)
        .select("shipment_id", "return_station_id", "order_type", "returned_time")
        .join(station_dim(tables.dimension("station"), "_return_station", "return_station_id"), "return_station_id", "left")
        .withColumn("_district", district_code(F.col("_return_station")))
        .join(zones, "_district", "left")
        .select(
            "shipment_id",
            return_type(F.col("order_type"), F.col("_region")).alias("order_type"),
            ctx.ts(zero_as_missing(F.col("returned_time"))).alias("returned_time"),
        )
    )
    day = F.col("date_received")
    packed, returning, left = F.col("packed_time"), F.col("returning_time"), F.col("left_time")
    return (
        picked.join(masters, "shipment_id", "left")
        .join(lost, "shipment_id", "left")
        .withColumn("date_received", business_day(F.col("receive_time"), 6))
        .withColumns(
            {
                "operator_group": operator_group(F.col("operator")),
                "ontime_received_2am": on_time(F.col("receive_time"), day, 1, 2),
                "late_received": late(F.col("receive_time"), day, 1, 2),
                "packed_by_day_1": on_time(packed, day, 1, 6),
                "packed_by_day_2": on_time(packed, day, 2, 6),
                "returning_by_day_1": on_time(returning, day, 1, 11),
                "handed_over_by_day_1": on_time(left, day, 1, 12),
                # The late handover carries the on-time label too; only its count is used.
                "handed_over_late": late(left, day, 1, 12, "ontime"),
            }
        )
    )


def _by_type(choices: dict[str, Column]) -> Column:
    """One aggregate per order type, chosen by the group's own type."""
    chain = None
    for name, value in choices.items():
        is_type = F.col("order_type") == name
        chain = F.when(is_type, value) if chain is None else chain.when(is_type, value)
    return chain


def return_performance(
    spark: SparkSession,
    tables,
    as_of: date,
    *,
    first_days: int = 30,
    last_days: int = 1,
    centre: int = V.RETURN_CENTRE,
    excluded_operators=(),
    settings: Settings = Settings(),
) -> DataFrame:
    """Return receipts per business day and order type: on-time, in-full and handover figures."""
    rows = return_receipts(
        spark,
        tables,
        as_of,
        first_days=first_days,
        last_days=last_days,
        centre=centre,
        excluded_operators=excluded_operators,
        settings=settings,
    )
    n = lambda c: F.count(F.col(f"`{c}`"))
    outbound = {"SCOM": n("returning_time"), "GBKK": n("packed_time"), "UPC": n("packed_time")}
    punctual = {
        "SCOM": n("returning_by_day_1"),
        "GBKK": n("packed_by_day_1"),
        "UPC": n("packed_by_day_2"),
    }
    total = n("shipment_id")
    each = lambda value: _by_type(dict.fromkeys(_BY_TYPE, value))
    handed_over = n("handed_over_by_day_1").cast("double") + n("handed_over_late").cast("double")
    return (
        rows.groupBy("date_received", "order_type")
        .agg(
            total.alias("overall_received"),
            n("ontime_received_2am").alias("#ontime_received_2am"),
            each(ratio(n("ontime_received_2am"), total)).alias("%ontime_received_2am"),
            each(ratio(n("late_received"), total)).alias("%late_received"),
            _by_type(outbound).cast("double").alias("infull_outbound"),
            _by_type({t: ratio(c, total) for t, c in outbound.items()}).alias("%infull_outbound"),
            _by_type({t: ratio(punctual[t], c) for t, c in outbound.items()}).alias("%ontime_outbound"),
            _by_type(punctual).cast("double").alias("#ontime_outbound"),
            _by_type({"GBKK": handed_over, "UPC": handed_over}).alias("#infull_handover"),
            each(n("damaged_lost").cast("double")).alias("#damaged_lost"),
        )
        .orderBy(F.desc("date_received"))
    )
