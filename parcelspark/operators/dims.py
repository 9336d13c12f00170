"""Dimensions built out of the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelspark.fixed_values import HUBS_OF_REGION, REGIONAL
from parcelspark.operators.lookup import bounded_broadcast, inline_table


def status_pairs(status_src: DataFrame) -> DataFrame:
    """The (status, name) pairs that occur in a much larger table."""
    return status_src.select("status", "status_name").distinct()


def status_dim(status_src: DataFrame) -> DataFrame:
    """Names of statuses; a status with two names repeats the rows it is joined to.

    Broadcast if few: a status column has few values and is skewed, so joining the log to it by
    shuffle would be the worst plan.
    """
    return bounded_broadcast(status_pairs(status_src))


def status_names(status_src: DataFrame) -> DataFrame:
    """One name per status (the first in alphabet, should a status have several): for reports
    that number events after the name is joined, and so never repeat one."""
    names = status_pairs(status_src).groupBy("status").agg(F.min("status_name").alias("status_name"))
    return bounded_broadcast(names)


def station_dim(station: DataFrame, name: str = "station_name", on: str = "station_id", key: str = "station_id") -> DataFrame:
    """Station names for one role. A size hint on `station` is kept."""
    return station.select(F.col(key).alias(on), F.col("station_name").alias(name))


def hub_regions(spark: SparkSession, prefix: str = "H") -> DataFrame:
    """code, region: the regional centre of each hub (`prefix` H) or first-mile station (F)."""
    rows = [(prefix + hub[1:], region) for region, hubs in HUBS_OF_REGION.items() for hub in hubs]
    return inline_table(spark, "code string, region string", rows)


def regional_pairs() -> list[tuple[str, str]]:
    """Pickup and delivery centres that a route joins: two different areas (the letter after
    the dash is not a different area), and none from the centre that has no pickup route."""
    area = lambda centre: centre.split("-")[0]
    return [(p, d) for p in REGIONAL if p != "SORC-A" for d in REGIONAL if area(p) != area(d)]
