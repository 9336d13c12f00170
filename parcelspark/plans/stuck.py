"""Open shipments without a new event for days, and who has to move them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelspark import fixed_values as V
from parcelspark.functions.clock import aging_days
from parcelspark.functions.jsontext import json_int_strict, json_text
from parcelspark.functions.text import district_code, part_before, station_code
from parcelspark.operators import rules as R
from parcelspark.operators.dims import hub_regions, station_dim
from parcelspark.operators.events import first, last, latest_event, milestones, with_tie_break
from parcelspark.operators.lookup import bounded_broadcast, inline_table, keyed, lookup_rules
from parcelspark.plans.base import Context, has
from parcelspark.settings import Settings


def stuck_shipments(
    spark: SparkSession,
    tables,
    as_of: date,
    *,
    statuses=V.OPEN,
    oldest: int = 30,
    youngest: int = 2,
    picked_up_within: int = 30,
    operator_stations: DataFrame | None = None,
    partners: tuple[tuple[str, str], ...] = V.PARTNER_HUBS,
    default_partner: str = V.DEFAULT_PARTNER,
    settings: Settings = Settings(),
) -> DataFrame:
    """Shipments whose latest event is `oldest` to `youngest` days old and open, and which were
    created or picked up less than `picked_up_within` days ago (both 30 days by default; a larger
    `oldest` alone finds no older pickups).

    `operator_stations` (operator, station): where an operator works, used for events without a
    station. The first pass reads the log from `oldest` days ago on: a shipment with a later
    event than the window has that event in it, one without any is out either way. The second
    pass reads older milestones of the shipments that remain.
    """
    ctx = Context(tables, settings, as_of)
    ctime, status = F.col("ctime"), F.col("status")
    window_end = ctx.begin(youngest - 1)
    window = milestones(
        ctx.log.filter(ctx.between(ctx.begin(oldest)) & F.col("shipment_id").startswith(settings.id_prefix)),
        {
            "final": last(None, "status", "ctime", "content"),
            "pickup": first(has(status, (*V.PICKED_UP, *V.CREATED)) & (ctime < window_end)),
        },
    )
    stuck = (
        window.filter(
            F.col("final.status").isin(*statuses)
            & (F.col("final.ctime") < window_end)
            & (aging_days(ctx.ts("pickup.ctime"), as_of) < picked_up_within)
        )
        .join(
            tables["shipment_info"].select(
                "shipment_id", "closed_timestamp", F.col("latest_operator_name").alias("_operator"),
                "is_warehouse", "is_cross_border", "is_marketplace", "is_bulky", "is_open_service", "cogs_amount",
            ),
            "shipment_id",
            "left",
        )
        .filter("closed_timestamp IS NULL")
        .select(
            "shipment_id",
            F.col("final.status").alias("status"),
            ctx.ts("final.ctime").alias("last_timestamp"),
            json_int_strict("final.content", "station_id").alias("station_id"),
            json_text("final.content", "linehaul_task_id").alias("lh_task_id"),
            json_text("final.content", "to_number").alias("to_number"),
            aging_days(ctx.ts("pickup.ctime"), as_of).alias("aging_pickup"),
            "_operator",
            R.type_by_flags_open().alias("order_type"),
            "cogs_amount",
        )
    )
    stuck, keys = tables.counted(stuck)

    older = milestones(
        ctx.events(*V.RETURN_STARTED, *V.LEFT_STATION),
        {"ret": first(has(status, V.RETURN_STARTED)), "lh": last(has(status, V.LEFT_STATION), "operator")},
        only=keys,
    ).select(
        "shipment_id",
        aging_days(ctx.ts("ret.ctime"), as_of).alias("aging_return"),
        F.col("lh.operator").alias("_lh_operator"),
    )
    failed = latest_event(
        with_tie_break(tables["failed_op_log"]), cols=("station_name", "ctime"), only=keys
    ).select(
        "shipment_id", station_code(F.col("station_name")).alias("_failed_hub"), ctx.ts().alias("_failed_at")
    )
    station = tables.dimension("station")
    hubs = (
        keyed(tables["fleet_order_dwd"], keys)
        .select("shipment_id", F.col("station_id").alias("_lm_id"), F.col("return_station_id").alias("_ret_id"))
        .join(station_dim(station, "_lm_station", "_lm_id"), "_lm_id", "left")
        .join(station_dim(station, "_ret_station", "_ret_id"), "_ret_id", "left")
        .drop("_lm_id", "_ret_id")
    )
    # An empty override table keeps one plan for both cases.
    given = operator_stations is not None
    places = operator_stations if given else inline_table(spark, "operator string, station string", [(None, None)])
    places = places.select(F.col("operator").alias("_operator"), F.col("station").alias("_override"))
    places = bounded_broadcast(places.dropDuplicates(["_operator"])) if given else F.broadcast(places)
    found = (
        stuck.join(older, "shipment_id", "left")
        .join(failed, "shipment_id", "left")
        .join(hubs, "shipment_id", "left")
        .join(station_dim(station, "_station"), "station_id", "left")
        .join(places, "_operator", "left")
        .join(
            tables.statuses().withColumn("_named_status", F.col("status")), "status", "left"
        )
    )
    name = F.col("_station")
    found = lookup_rules(found, hub_regions(spark), {"code": station_code(name)}, {"region": "_h_region"}, fixed=True)
    found = lookup_rules(found, hub_regions(spark, "F"), {"code": part_before(name, " ")}, {"region": "_f_region"}, fixed=True)

    code, operator = station_code(name), F.col("_operator")
    by_agent = name.isNull() & operator.contains(settings.agent_mark)
    returning = F.split_part("status_name", F.lit("_"), F.lit(1)) == "Return"
    lm_code = station_code(F.col("_lm_station"))
    failed_hub, _, failed_for = R.later_failure(F.col("_failed_at"), F.col("last_timestamp"), F.col("_failed_hub"))
    classified = found.select(
        "shipment_id",
        R.flow_by_first_word(F.col("status_name")).alias("status_flow"),
        "order_type",
        "cogs_amount",
        F.when(name.isin("SOCE", "Sorting center", *V.REGIONAL), "MM").otherwise("CTO/MM").alias("stuck_function"),
        R.apply_rules(
            [(by_agent, "SOCE"), (name.isNull() & F.col("_override").isNotNull(), F.col("_override"))], code
        ).alias("current_station"),
        R.apply_rules(
            [
                (returning & F.col("_h_region").isNotNull(), F.col("_h_region")),
                (code == "Sorting center", "SOCE"),
                (by_agent, "SOCE"),
                (code.isin(*V.REGIONAL, "SOCE"), code),
                (F.col("_f_region").isNotNull(), F.col("_f_region")),
                (F.col("_h_region").isNotNull(), F.col("_h_region")),
                (R.starts_with_any(name, "F", "D", "H") | (name == "Sorting Center"), "SOCE"),
            ],
            code,
        ).alias("_pic"),
        "last_timestamp",
        F.col("status_name").alias("latest_status_name"),
        F.when(F.col("_named_status").isin(*V.ON_THE_ROAD), F.col("_lh_operator"))
        .otherwise(operator)
        .alias("operator"),
        "aging_pickup",
        aging_days(F.col("last_timestamp"), as_of).alias("aging_last_timestamp"),
        "aging_return",
        failed_hub.alias("unsucessful_log_hub"),
        failed_for.alias("_failed_for"),
        "to_number",
        "lh_task_id",
        R.apply_rules(
            [
                (returning, station_code(F.col("_ret_station"))),
                ((operator == default_partner) | (F.col("_lm_station") == "SOCE"), default_partner),
                *((lm_code.contains(mark), partner) for mark, partner in partners),
            ],
            lm_code,
        ).alias("_hub"),
    ).filter(
        F.col("_hub").isNotNull() & (F.col("current_station") != "SOCW") & (F.col("_failed_for") == "mm")
    )

    zones = tables.dimension("region_index").select(F.col("district_code").alias("_district"), "gbkk_upc_ops_region")
    at, pic, hub = F.col("current_station"), F.col("_pic"), F.col("_hub")
    ships_back = (F.col("status_flow") == "Return") & F.col("order_type").isin("CB", "WH")
    return (
        classified.withColumn("_district", district_code(hub))
        .join(zones, "_district", "left")
        .select(
            F.when(at.isin(*V.REGIONAL), at).otherwise(pic).alias("pic_name"),
            R.apply_rules(
                [
                    (F.col("latest_status_name").isin(*V.LINEHAUL_STATUS_NAMES), "LH"),
                    (pic == "SOCE", "SOC"),
                    (at.isin(*V.REGIONAL), "RC"),
                    (pic.isin(*V.REGIONAL), "RC"),
                ]
            ).alias("station_pic"),
            "shipment_id",
            "status_flow",
            "order_type",
            "cogs_amount",
            "stuck_function",
            "current_station",
            "last_timestamp",
            "latest_status_name",
            "operator",
            "aging_pickup",
            "aging_last_timestamp",
            "aging_return",
            "unsucessful_log_hub",
            "to_number",
            "lh_task_id",
            R.apply_rules([(ships_back, "SCOM"), (hub.isin(*V.REGIONAL, "SOCE"), default_partner)], hub).alias(
                "hub_destination"
            ),
            R.destination_zone(
                F.col("status_flow"), F.col("order_type"), hub, F.col("gbkk_upc_ops_region")
            ).alias("destination_zone"),
        )
        .orderBy(F.desc("aging_pickup"))
    )
