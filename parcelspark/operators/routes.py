"""Inter-regional routes and their transit limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelspark import fixed_values as V
from parcelspark.functions.clock import business_day
from parcelspark.operators.dims import regional_pairs
from parcelspark.operators.lookup import bounded_broadcast, inline_table

_SCHEMA = (
    "pickup string, delivery string, lh_route string, depart_hours int, arrive_hours int, "
    "travel_hours int, onward_hours int"
)


def route_rules(spark: SparkSession) -> DataFrame:
    """One row per route with its limits. Hours are signed: they are added to the leg's time."""
    rows = []
    for pickup, delivery in regional_pairs():
        limits = V.PICKUP_LIMITS[pickup]
        elsewhere = 0 if delivery.startswith("NORC") else 1
        rows.append(
            (
                pickup,
                delivery,
                f"{pickup.replace('-', '')}-SOC-{delivery.replace('-', '')}",
                limits["depart"],
                limits["arrive"][elsewhere],
                limits["travel"][elsewhere],
                limits["onward_sign"] * V.ONWARD_HOURS[delivery],
            )
        )
    return inline_table(spark, _SCHEMA, rows)


def _flag(condition):
    return F.when(condition, 1).otherwise(0)


def _day_after(time: str, hours: str):
    return (F.col(time) + F.make_dt_interval(hours=F.col(hours))).cast("date")


def route_sla(
    df: DataFrame,
    rules: DataFrame,
    pickup: str = "pickup_rc_station",
    delivery: str = "delivery_rc_station",
    received: str = "xrc_received_time",
    departed: str = "min_xrc_lh_transporting_time",
    arrived: str = "min_xrc_lh_transported_time",
    sort_received: str = "min_soc_received",
    sort_departed: str = "min_soc_lh_transporting",
    travel: str = "rc_to_soc_delivery_leadtime",
    fixed: bool = False,
) -> DataFrame:
    """Rows on a known route, with its label and four on-time flags (0 when late or unknown). The
    rules are counted before they are broadcast, unless they are `fixed`: those of `route_rules`."""
    received_day = F.col(received).cast("date")
    return (
        df.join(
            F.broadcast(rules) if fixed else bounded_broadcast(rules),
            (F.col(pickup) == F.col("pickup")) & (F.col(delivery) == F.col("delivery")),
            "inner",
        )
        .withColumns(
            {
                "is_rc_transporting_ontime": _flag(_day_after(departed, "depart_hours") <= received_day),
                "is_rc_transported_ontime": _flag(_day_after(arrived, "arrive_hours") <= received_day),
                "rc_traveling_soc_leadtime_check": _flag(F.col(travel) <= F.col("travel_hours")),
                "is_soc_transporting_ontime": _flag(
                    _day_after(sort_departed, "onward_hours") <= business_day(F.col(sort_received), 6)
                ),
            }
        )
        .drop("pickup", "delivery", "depart_hours", "arrive_hours", "travel_hours", "onward_hours")
    )
