"""Where open shipments are now, counted per delivery hub."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelspark import fixed_values as V
from parcelspark.functions.jsontext import json_text
from parcelspark.functions.text import delivery_hub, delivery_hub_of_any
from parcelspark.operators.events import effective_station, latest_event
from parcelspark.operators.lookup import as_keys
from parcelspark.operators.metrics import pivot_counts
from parcelspark.plans.base import Context
from parcelspark.settings import Settings


def hub_live_backlog(
    spark: SparkSession,
    tables,
    as_of: date,
    *,
    days: int = 45,
    statuses=V.BACKLOG,
    settings: Settings = Settings(),
) -> DataFrame:
    """Shipments by latest status per hub. The first pass reads `days` days of the log; last
    attempts, which may be older, are read only for shipments that need them."""
    ctx = Context(tables, settings, as_of)
    current = tables.keep(
        latest_event(
            ctx.log.filter(
                ctx.between(ctx.begin(days), ctx.begin(-1))
                & F.col("shipment_id").startswith(settings.id_prefix)
            ),
            cols=("status", "station_id", "content"),
            then=F.col("status").isin(*statuses),
        ).select(
            "shipment_id",
            "status",
            "station_id",
            F.when(F.col("status").isin(*V.BACKLOG_AT_DESTINATION), json_text("content", "dest_station_name")).alias(
                "_destination"
            ),
        )
    )
    failed = current.filter(F.col("status").isin(*V.BACKLOG_AT_LAST_ATTEMPT))
    attempts = latest_event(
        ctx.events(*V.LAST_ATTEMPT), cols=("station_id",), only=as_keys(spark, failed)
    ).withColumnRenamed("station_id", "_attempt_id")
    stations = tables.dimension("station").select(
        F.col("station_id").cast("string").alias("_place"), F.col("station_name").alias("_named")
    )
    known_hubs = (
        tables.dimension("station")
        .select(delivery_hub(F.col("station_name")).alias("_known"))
        .filter(F.col("_known").startswith("H"))
        .distinct()
    )
    hub = F.col("_hub")
    placed = (
        current.join(attempts, "shipment_id", "left")
        .withColumn(
            "_place",
            effective_station(
                F.col("status"), F.col("station_id"), F.col("_destination"), F.col("_attempt_id"),
                V.BACKLOG_AT_DESTINATION, V.BACKLOG_AT_LAST_ATTEMPT,
            ),
        )
        .join(stations, "_place", "left")
        .join(tables.statuses(), "status", "left")
        .withColumn("_hub", delivery_hub_of_any(F.coalesce("_named", "_place")))
        .join(known_hubs, hub == F.col("_known"), "left")
        .withColumn("Hub Name", F.when(F.col("_known").isNull(), F.concat(hub, F.lit("-A"))).otherwise(hub))
        .filter(F.col("Hub Name").startswith("H"))
    )
    return pivot_counts(
        placed, ["Hub Name"], {n: F.col("status").isin(*codes) for n, codes in V.BACKLOG_COLUMNS.items()}
    )
