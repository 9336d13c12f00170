"""The reports. Each is a function (spark, tables, ...) -> DataFrame; nothing is written."""

from parcelspark.plans.backlog import hub_live_backlog
from parcelspark.plans.leadtime import leadtime_by_function, partner_leadtime_summary
from parcelspark.plans.linehaul import latest_linehaul_and_sack, linehaul_path_performance, long_path_orders
from parcelspark.plans.loss import loss_damage_attribution
from parcelspark.plans.pickup import (
    created_and_pickup_dates,
    direct_pickup_summary,
    sortation_not_received,
)
from parcelspark.plans.returns import return_performance
from parcelspark.plans.station import first_touch_by_operator, overseas_hub_performance
from parcelspark.plans.stuck import stuck_shipments
from parcelspark.plans.tracker import shipment_tracker, shipment_tracker_contacts

__all__ = [
    "created_and_pickup_dates",
    "direct_pickup_summary",
    "first_touch_by_operator",
    "hub_live_backlog",
    "latest_linehaul_and_sack",
    "leadtime_by_function",
    "linehaul_path_performance",
    "long_path_orders",
    "loss_damage_attribution",
    "overseas_hub_performance",
    "partner_leadtime_summary",
    "return_performance",
    "shipment_tracker",
    "shipment_tracker_contacts",
    "sortation_not_received",
    "stuck_shipments",
]
