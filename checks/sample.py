"""Parcel tables derived from the star-schema sample, so that every report can run on it.

Each derived table is one SELECT over the given tables, whole and unfiltered by id, so its size
follows theirs. The same text serves Spark and the SQL check; `Dialect` holds the few
spellings that differ. A `Mix` sets which statuses and stations occur.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from parcelspark import Tables
from parcelspark.fixed_values import HUBS_OF_REGION

GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)
HUBS = [hub for hubs in HUBS_OF_REGION.values() for hub in hubs]

STATUS_NAMES = {
    0: "Created", 1: "LMHub_Assigned", 2: "LMHub_Returned", 8: "SOC_Received", 9: "Reallocate", 10: "Onhold",
    11: "Damaged", 12: "Lost", 13: "SOC_Pickup_Done", 15: "SOC_LHTransporting", 18: "SOC_Handover",
    32: "SP_Received", 33: "SOC_Pickup_Onhold", 34: "SOC_Pickup_Handedover", 35: "SOC_LHPacked",
    36: "SOC_LHTransported", 39: "FMHub_Pickup_Done", 40: "FMHub_Received", 42: "FMHub_Inbound",
    47: "FMHub_LHTransporting", 48: "FMHub_LHTransported", 56: "Return_LMHub_LHTransporting",
    58: "Return_SOC_Received", 62: "Return_SOC_Packed", 63: "Return_SOC_Returning",
    64: "Return_SOC_LHTransporting", 65: "Return_SOC_LHTransported", 81: "Delivered", 86: "3PL_Handover",
    89: "3PL_Received", 96: "Exception_Found", 114: "Transporting_to_sp", 117: "Return_SOC_Returned",
    233: "LMHub_LHTransporting", 234: "LMHub_LHTransported",
}

STATIONS = {
    3: "Sorting center", 242: "SOCE", 78: "SOCW", 71: "CERC", 77: "NERC-A", 82: "NERC-B", 983: "NORC-A",
    1350: "SORC-A", 1479: "NORC-B", 1480: "SORC-B", 5: "FSATH- สาทร", 6: "DJOMT-B-จอมทอง",
    7: "Partner Shop 7", 8: "Brand Point 8", 9: "Kerry Depot", 10: "Ninja Depot", 11: "SIP-LMHub",
}

OPERATORS = ("IND0001", "CAB0002", "DWS0003", "MQB0004", "Flash", "agent07", "rider.a", "lead.x", "lead.y", None)


@dataclass(frozen=True)
class Mix:
    """Statuses and stations that occur in the log. `strict`: no text where a number belongs.
    `renamed`: some statuses have a second name."""

    statuses: tuple[int, ...]
    stations: tuple[int | None, ...] = (3, 242, 71, 77, 82, 983, 1479, 1480, 1350, 78, None)
    named: tuple[int, ...] = (3, 71, 77, 82, 983, 1479, 1480, 242)
    strict: bool = False
    renamed: bool = False


class Dialect:
    def __init__(self, spark: bool):
        self.spark = spark

    def text(self, value) -> str:
        return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)

    def at(self, values, index: str) -> str:
        """values[index % len]"""
        items = ", ".join(self.text(v) for v in values)
        index = f"CAST({index} % {len(values)} + 1 AS INT)"
        return f"element_at(array({items}), {index})" if self.spark else f"list_extract([{items}], {index})"

    def div(self, a: str, b: int) -> str:
        return f"(({a}) div {b})" if self.spark else f"(({a}) // {b})"

    def seconds(self, ts: str) -> str:
        if self.spark:
            return f"timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {ts})"
        return f"date_sub('second', TIMESTAMP '1970-01-01 00:00:00', {ts})"


# Hundredths of an event value: a cheap number that differs from row to row.
K = "CAST(floor(value * 100) AS BIGINT) % 100"


def shipment(number: str) -> str:
    return f"'PT' || lpad(CAST({number} AS STRING), 9, '0')"


def derived(d: Dialect, mix: Mix) -> dict[str, str]:
    """Table name -> SELECT over the given tables (`{events}` and so on)."""
    offset = 25_200
    case = lambda key, mapping: "CASE " + key + " " + " ".join(
        f"WHEN {c} THEN '{n}'" for c, n in mapping.items()
    )
    log = f"(SELECT event_id, ts, user_id, event_type, {K} AS k, " \
          f"event_id * 31 + user_id * 17 + {K} * 7 AS h FROM {{events}}) e"
    code = d.at(HUBS, "p_partkey")
    number = "user_id * 4 + event_id % 4"
    status = d.at(mix.statuses, "h")
    not_a_number = '\'{"station_id": "x", "station_name": "Kerry"}\'' if not mix.strict else "'{}'"
    dest = (
        f"CASE {d.div('h', 11)} % 4 WHEN 0 THEN 'SIP-LMHub' WHEN 1 THEN 'FSATH- สาทร' "
        f"ELSE {d.at(HUBS, d.div('h', 13))} || ' - Town' END"
    )
    full = (
        f"'{{{{\"station_id\": ' || CAST({d.at(mix.named, d.div('h', 5))} AS STRING) || "
        f"', \"station_name\": \"' || {d.at(('Flash', 'Kerry', 'Ninja Van', 'Own', 'Own', 'Own', 'Own'), d.div('h', 7))} || "
        f"'\", \"dest_station_name\": \"' || {dest} || "
        f"'\", \"linehaul_task_id\": \"LT' || CAST(h % 200 AS STRING) || "
        f"'\", \"to_number\": \"TO' || CAST(event_id AS STRING) || '\"}}}}'"
    )
    broken = "'{{\"station_id\": 3, \"to_number\": '"
    not_a_number = not_a_number.replace("{", "{{").replace("}", "}}")
    sid = shipment("o_orderkey")
    second = f" || CASE WHEN {status} % 3 = 0 AND k % 2 = 0 THEN ' (renamed)' ELSE '' END" if mix.renamed else ""
    station_name = (
        case("p_partkey", STATIONS)
        + f" ELSE CASE p_partkey % 4 WHEN 2 THEN 'F' || substring({code}, 2) WHEN 3 THEN 'D' || substring({code}, 2) "
        f"ELSE {code} END || ' - ' || p_name END"
    )
    return {
        "tracking": f"""
            SELECT event_id, {shipment(number)} AS shipment_id, {status} AS status,
                   CASE WHEN {d.div('h', 3)} % 5 = 4 THEN CAST((h * 13) % 2500 AS INT)
                        ELSE {d.at(mix.stations, d.div('h', 3))} END AS station_id,
                   {d.at(OPERATORS, d.div('h', 3))} AS operator,
                   CASE WHEN k % 10 <> 9 THEN h % 100 END AS user_id,
                   {d.seconds('ts')} - {offset} AS ctime,
                   CASE k % 20 WHEN 0 THEN NULL WHEN 1 THEN {broken} WHEN 2 THEN {not_a_number}
                        ELSE {full} END AS content
            FROM {log}""",
        "status_src": f"""
            SELECT {status} AS status, {case(status, STATUS_NAMES)} ELSE 'Step_' || CAST({status} AS STRING) END{second} AS status_name
            FROM {log}""",
        "failed_op_log": f"""
            SELECT event_id, {shipment(number)} AS shipment_id, 'E' || CAST(k AS STRING) AS error_msg,
                   {d.at(('HPHIT-A - Town', 'Sorting center', 'FSWAN - Town', 'SOCE - x', 'NERC-A', 'SOCE'), 'h')} AS station_name,
                   {d.seconds('ts')} - {offset} + 7200 AS ctime
            FROM {log} WHERE event_type = 'error'""",
        "abnormal_log": f"""
            SELECT event_id, {shipment(number)} AS order_id, 'remark ' || CAST(event_id AS STRING) AS remark,
                   {d.at((11, 12, 13), 'h')} AS new_status, {d.seconds('ts')} - {offset} AS ctime
            FROM {log} WHERE event_type = 'purchase'""",
        "station": f"SELECT CAST(p_partkey AS INT) AS station_id, {station_name} AS station_name FROM {{part}}",
        "station_raw": f"SELECT p_partkey AS id, {station_name} AS station_name FROM {{part}}",
        "fleet_order": f"""
            SELECT {sid} AS shipment_id, {d.at(mix.statuses, 'o_orderkey')} AS status, o_totalprice AS cogs,
                   CAST(o_custkey % 2000 AS INT) AS pickup_station_id, CAST((o_orderkey * 7) % 2000 AS INT) AS station_id
            FROM {{orders}}""",
        "fleet_order_dwd": f"""
            SELECT {sid} AS shipment_id, {d.at(mix.statuses, 'o_orderkey')} AS status, o_totalprice AS cogs,
                   CAST((o_orderkey * 7) % 2000 AS INT) AS station_id,
                   CAST((o_orderkey * 11) % 2000 AS INT) AS return_station_id,
                   CASE WHEN o_orderstatus = 'P' THEN 0 ELSE {d.seconds('o_orderdate')} END AS returned_time,
                   CAST(o_orderkey % 7 AS INT) AS order_type
            FROM {{orders}}""",
        "shipment_info": f"""
            SELECT {sid} AS shipment_id, CAST(o_orderkey % 16 AS STRING) AS order_type_id,
                   {d.at(('CB', 'Own Express', 'OPEN_STANDARD', 'BULKY_MARKETPLACE', 'OTHER'), 'o_orderkey')} AS order_type_name,
                   {d.at(OPERATORS, d.div('o_orderkey', 2))} AS latest_operator_name,
                   CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS closed_timestamp,
                   o_orderdate AS delivered_sla_timestamp,
                   'Area ' || CAST(o_custkey % 5 AS STRING) AS buyer_region_name,
                   o_orderpriority = '1-URGENT' AS is_warehouse, o_orderpriority = '2-HIGH' AS is_cross_border,
                   o_orderkey % 3 = 0 AS is_marketplace, o_orderkey % 2 = 0 AS is_bulky, o_custkey % 2 = 0 AS is_open_service,
                   o_totalprice AS cogs_amount, o_totalprice AS cod_amount,
                   CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority IN ('3-MEDIUM', '5-LOW') END AS is_dropoff,
                   {d.at(('HOME', 'Kerry', None), 'o_orderkey')} AS _4pl_name,
                   '[' || CAST(o_orderkey % 5 AS STRING) || ', 71, ' || CAST((o_orderkey * 3) % 2000 AS STRING) || ']' AS origin_order_path,
                   'HPHIT-A - Town' AS updated_order_path_lm_hub_station_name,
                   CAST(o_orderkey % 2 AS INT) AS drop_off_sp,
                   'Buyer ' || CAST(o_custkey AS STRING) AS buyer_name, 'Road ' || CAST(o_custkey AS STRING) AS buyer_address,
                   CAST(o_custkey AS STRING) AS buyer_phone, o_custkey AS seller_shop_id,
                   'Shop ' || CAST(o_custkey AS STRING) AS seller_shop_name
            FROM {{orders}}""",
        "seller_order": f"SELECT {sid} AS shipment_id, 'Seller ' || CAST(o_custkey AS STRING) AS seller_name FROM {{orders}}",
        "seller_info": f"""
            SELECT {sid} AS shipment_id, o_custkey AS shop_id, 'Seller ' || CAST(o_custkey AS STRING) AS seller_name
            FROM {{orders}}""",
        "buyer_info": f"SELECT {sid} AS shipment_id, 'Province ' || CAST(o_custkey % 25 AS STRING) AS buyer_addr_state FROM {{orders}}",
        "dropoff_order": f"""
            SELECT {sid} AS shipment_id, 'Province ' || CAST(o_custkey % 20 AS STRING) AS seller_state, 'City' AS seller_city
            FROM {{orders}} WHERE o_orderstatus = 'P'""",
        "pickup_order": f"""
            SELECT {shipment('l_orderkey')} AS pickup_order_id, {d.seconds('l_shipdate')} AS ctime,
                   'Province ' || CAST(l_suppkey % 25 AS STRING) AS seller_addr_state,
                   'District ' || CAST(l_partkey % 50 AS STRING) AS seller_addr_district
            FROM {{lineitem}}""",
        "pickup_alloc": f"""
            SELECT {shipment('l_orderkey')} AS pickup_order_id,
                   CASE WHEN l_orderkey % 3 <> 0 AND l_linenumber <> 2 THEN {d.seconds('l_shipdate')} END AS allocated_time,
                   CASE WHEN l_returnflag = 'R' THEN '' ELSE 'TASK' || CAST(l_partkey AS STRING) END AS pickup_task_id,
                   l_suppkey AS pickup_point_id
            FROM {{lineitem}}""",
        "linehaul_task": "SELECT 'LT' || CAST(s_suppkey AS STRING) AS task_number, s_suppkey * 2 AS driver_id FROM {supplier}",
        "driver": "SELECT s_suppkey AS driver_id, s_name AS driver_name FROM {supplier}",
        "region_index": f"""
            SELECT substring({d.at(HUBS, 'n_nationkey * 3')}, 2, 4) AS district_code,
                   {d.at(('GBKK', 'UPC', '4PL', 'NORTH'), 'n_nationkey')} AS gbkk_upc_ops_region,
                   'Province ' || CAST(n_nationkey AS STRING) AS province, r_name AS lh_region
            FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey""",
    }


def read(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, mix: Mix) -> Tables:
    """The derived tables as lazy DataFrames."""

    given: dict[str, DataFrame] = {}

    def opener(sql: str):
        def open_table() -> DataFrame:
            used = [n for n in GIVEN if f"{{{n}}}" in sql]
            for n in used:
                if n not in given:
                    given[n] = read(spark, sf_dir, n)
            return spark.sql(sql, **{n: given[n] for n in used})

        return open_table

    return Tables({name: opener(sql) for name, sql in derived(Dialect(True), mix).items()})


def with_clause(mix: Mix, *names: str) -> str:
    """The derived tables as common table expressions for the SQL check."""
    views = {n: n for n in GIVEN}
    queries = derived(Dialect(False), mix)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({queries[n].format(**views)})" for n in names)
