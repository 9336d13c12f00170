"""Parcel-logistics analytics as Spark DataFrame plans."""

from parcelspark.session import build_session
from parcelspark.settings import Settings
from parcelspark.sources.tables import Tables

__all__ = ["Settings", "Tables", "build_session"]
