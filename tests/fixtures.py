"""Hand-made source tables: give the columns that matter, the others are NULL."""

from __future__ import annotations

from datetime import datetime, timezone

from parcelspark import Tables

OFFSET = 7 * 3600

SCHEMAS = {
    "tracking": "event_id long, shipment_id string, status int, station_id int, operator string, user_id long, ctime long, content string",
    "fleet_order": "shipment_id string, status int, cogs double, pickup_station_id int, station_id int",
    "fleet_order_dwd": "shipment_id string, station_id int, return_station_id int, cogs double, status int, returned_time long, order_type int",
    "shipment_info": (
        "shipment_id string, order_type_id string, order_type_name string, latest_operator_name string, "
        "closed_timestamp timestamp_ntz, delivered_sla_timestamp timestamp_ntz, buyer_region_name string, "
        "is_warehouse boolean, is_cross_border boolean, is_marketplace boolean, is_bulky boolean, is_open_service boolean, "
        "cogs_amount double, cod_amount double, is_dropoff boolean, _4pl_name string, origin_order_path string, "
        "updated_order_path_lm_hub_station_name string, drop_off_sp int, buyer_name string, buyer_address string, "
        "buyer_phone string, seller_shop_id long, seller_shop_name string"
    ),
    "seller_order": "shipment_id string, seller_name string",
    "seller_info": "shipment_id string, shop_id long, seller_name string",
    "buyer_info": "shipment_id string, buyer_addr_state string",
    "pickup_order": "pickup_order_id string, ctime long, seller_addr_state string, seller_addr_district string",
    "pickup_alloc": "pickup_order_id string, pickup_task_id string, pickup_point_id long, allocated_time long",
    "dropoff_order": "shipment_id string, seller_state string, seller_city string",
    "failed_op_log": "event_id long, shipment_id string, station_name string, error_msg string, ctime long",
    "abnormal_log": "event_id long, order_id string, ctime long, remark string, new_status int",
    "linehaul_task": "task_number string, driver_id long",
    "driver": "driver_id long, driver_name string",
    "station": "station_id int, station_name string",
    "station_raw": "id long, station_name string",
    "status_src": "status int, status_name string",
    "region_index": "district_code string, gbkk_upc_ops_region string, province string, lh_region string",
}


def at(text: str) -> int:
    """Epoch seconds of a local time 'YYYY-MM-DD HH:MM[:SS]'."""
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp()) - OFFSET


def frame(spark, schema: str, rows):
    names = [f.strip().split()[0] for f in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def make(spark, **rows) -> Tables:
    """Tables from lists of dicts; the tables not given are empty. Events are numbered in order."""
    for log in ("tracking", "failed_op_log", "abnormal_log"):
        for i, r in enumerate(rows.get(log, [])):
            r.setdefault("event_id", i)
    return Tables({n: frame(spark, s, rows.get(n, [])) for n, s in SCHEMAS.items()})


def event(shipment: str, status: int, when: str, **more) -> dict:
    return {"shipment_id": shipment, "status": status, "ctime": at(when), **more}
