"""The sixteen reports on tables derived from the sample, with SQL written apart from them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from checks.registry import query
from checks.sample import Mix, tables, with_clause
from parcelspark import Settings, fixed_values as V, plans
from parcelspark.plans.linehaul import seller_address

SETTINGS = Settings(id_prefix="PT")


def ts(ctime: str = "ctime") -> str:
    return f"make_timestamp(({ctime} + 25200) * 1000000)"


def js(key: str, content: str = "content") -> str:
    return f"CASE WHEN json_valid({content}) THEN json_extract_string({content}, '$.{key}') END"


def js_int(key: str, content: str = "content") -> str:
    return f"TRY_CAST({js(key, content)} AS INT)"


def day6(t: str) -> str:
    return f"CAST({t} - INTERVAL 6 HOUR AS DATE)"


def codes(values) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def numbered(source: str, columns: str, where: str = "TRUE", descending: bool = False) -> str:
    way = "DESC" if descending else "ASC"
    return (
        f"(SELECT {columns} FROM {source} WHERE {where} "
        f"QUALIFY row_number() OVER (PARTITION BY shipment_id ORDER BY ctime {way}, event_id {way}) = 1)"
    )


STATUS_MAP = "(SELECT DISTINCT status, status_name FROM status_src)"
HUB_LIST = ", ".join(f"('{h}', '{r}')" for r, hs in V.HUBS_OF_REGION.items() for h in hs)

# --- loss and damage ----------------------------------------------------------------------

LOSS = Mix((0, 39, 13, 11, 12, 96, 46, 47, 35, 15, 8, 9, 89, 32, 33, 34, 58, 65, 114, 10))


@query(
    "report_loss_damage_attribution",
    with_clause(
        LOSS, "tracking", "status_src", "failed_op_log", "abnormal_log", "station", "fleet_order_dwd",
        "shipment_info", "seller_order",
    )
    + f"""
, lost AS (
    SELECT * FROM {numbered('tracking', 'shipment_id, status, ctime', 'status IN (11, 12)')}
    WHERE CAST({ts()} AS DATE) = DATE '2024-01-10'),
seen AS (
    SELECT shipment_id, status,
           lag(status) OVER w AS p_status, lag(station_id) OVER w AS p_station,
           lag(ctime) OVER w AS p_ctime, lag(operator) OVER w AS p_operator
    FROM tracking WINDOW w AS (PARTITION BY shipment_id ORDER BY ctime, event_id)),
before AS (
    SELECT seen.*, n.status_name AS s, st.station_name AS at
    FROM seen LEFT JOIN {STATUS_MAP} n ON n.status = p_status
    LEFT JOIN station st ON st.station_id = p_station WHERE seen.status IN (11, 12, 96))
SELECT DISTINCT lost.shipment_id, nm.status_name AS latest_status_name, i.cod_amount,
    CAST(m.cogs AS DOUBLE) AS cogs_amount, so.seller_name,
    CASE WHEN i.drop_off_sp = 0 THEN 'PICKUP' ELSE 'SHUTTLE' END AS original_fm_type,
    CASE WHEN list_extract(string_split(trim(i.origin_order_path, '[]'), ', '), 1) = '3' THEN 'DIRECT' ELSE 'SHUTTLE' END AS direct_shuttle_type,
    CASE WHEN i._4pl_name <> 'HOME' THEN i._4pl_name END AS _4pl_provider,
    trip.lt AS latest_lh_task_id, trip.tn AS latest_to_number, oh.station_name AS origin_hub_destination,
    i.updated_order_path_lm_hub_station_name AS update_hub_destination,
    b.p_operator AS latest_operator, b.s AS latest_status_before_dl, b.at AS latest_station_before_dl,
    {ts('b.p_ctime')} AS timesatmp_before_dl, {ts('c.ctime')} AS created_timestamp, {ts('p.ctime')} AS pickup_timestamp,
    CAST({ts('lost.ctime')} AS DATE) AS end_status_timestamp, {ts('f.ctime')} AS error_timestamp,
    split_part(f.station_name, ' -', 1) AS unsucessful_log_hub, f.error_msg,
    CASE WHEN b.s ^@ '3PL' THEN '4PL'
         WHEN regexp_matches(b.s, '^(SP|DOP)') OR b.s = 'Auto_to_Pending_Drop_off' THEN 'SP'
         WHEN b.s LIKE 'Return_FM%' OR b.s LIKE 'Return_LM%' OR regexp_matches(b.s, '^(FM|LM|Exc)') OR b.s IN ('Delivering', 'Onhold', 'SOC_Pickup_Done') THEN 'CTO'
         WHEN b.at IN ('SOCE', 'Sorting center', 'SOCW') AND (b.s LIKE 'Return_SOC%' OR b.s ^@ 'SOC' OR b.s = 'Reallocate') THEN 'MM'
         WHEN b.s = 'Created' THEN 'MM'
         WHEN regexp_matches(b.s, '^Return_SOC_LHTransport(ing|ed)$') THEN 'CTO/MM'
         WHEN b.s IN ('SOC_Pickup_Onhold', 'SOC_Pickup_Failed', 'Transporting_to_sp', 'Transported_to_sp') THEN 'SP/CTO'
         WHEN b.s IN ('SOC_Received', 'SOC_Packing', 'SOC_Packed', 'SOC_Handover', 'Reallocate') THEN 'CTO'
         WHEN b.s = 'SOC_Pickup_Handedover' THEN CASE i.is_dropoff WHEN TRUE THEN 'SP/CTO' WHEN FALSE THEN 'CTO/MM' END
    END AS lost_pic, r.remark
FROM lost
LEFT JOIN {STATUS_MAP} nm ON nm.status = lost.status
LEFT JOIN fleet_order_dwd m ON m.shipment_id = lost.shipment_id
LEFT JOIN shipment_info i ON i.shipment_id = lost.shipment_id
LEFT JOIN seller_order so ON so.shipment_id = lost.shipment_id
LEFT JOIN {numbered('tracking', 'shipment_id, ctime', 'status = 0')} c ON c.shipment_id = lost.shipment_id
LEFT JOIN {numbered('tracking', 'shipment_id, ctime', 'status IN (39, 13)')} p ON p.shipment_id = lost.shipment_id
LEFT JOIN {numbered('failed_op_log', 'shipment_id, station_name, error_msg, ctime', descending=True)} f ON f.shipment_id = lost.shipment_id
LEFT JOIN before b ON b.shipment_id = lost.shipment_id
LEFT JOIN station oh ON CAST(oh.station_id AS VARCHAR) = list_extract(string_split(trim(i.origin_order_path, '[]'), ', '), -1)
LEFT JOIN {numbered('tracking', f"shipment_id, {js('linehaul_task_id')} AS lt, {js('to_number')} AS tn", f'status IN {codes(V.TRIP)}', True)} trip
    ON trip.shipment_id = lost.shipment_id
LEFT JOIN (SELECT order_id, arg_min(remark, (ctime, event_id)) AS remark FROM abnormal_log WHERE new_status IN (11, 12) GROUP BY order_id) r
    ON r.order_id = lost.shipment_id""",
)
def _(spark, sf):
    return plans.loss_damage_attribution(spark, tables(spark, sf, LOSS), date(2024, 1, 11), settings=SETTINGS)


# --- stuck shipments ----------------------------------------------------------------------

STUCK = Mix((39, 13, 0, 8, 9, 15, 18, 36, 47, 48, 58, 64, 65, 56, 233, 234, 86, 10), strict=True,
            named=(3, 71, 77, 82, 983, 1479, 1480, 242, 1, 2, 13, 21, 22, 46, 55, 90, 111, 1900, 2400, 78))
PLACES = (("lead.x", "SORC-A"), ("lead.y", "NERC-B"))


@query(
    "report_stuck_shipments",
    with_clause(
        STUCK, "tracking", "status_src", "failed_op_log", "station", "fleet_order_dwd", "shipment_info", "region_index"
    )
    + f"""
, hub_region(code, region) AS (VALUES {HUB_LIST}),
newest AS {numbered('tracking', 'shipment_id, status, content, ctime', descending=True)},
picked AS (
    SELECT shipment_id, date_diff('day', CAST(min({ts()}) AS DATE), DATE '2024-01-31') + 1 AS aging_pickup
    FROM tracking WHERE status IN (39, 13, 0) AND CAST({ts()} AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-29'
    GROUP BY shipment_id),
base AS (
    SELECT n.shipment_id, n.status, {ts('n.ctime')} AS last_ts, {js_int('station_id', 'n.content')} AS at_id,
           {js('linehaul_task_id', 'n.content')} AS lh_task_id, {js('to_number', 'n.content')} AS to_number,
           i.*EXCLUDE (shipment_id), aging_pickup
    FROM newest n JOIN picked USING (shipment_id) LEFT JOIN shipment_info i ON i.shipment_id = n.shipment_id
    WHERE n.status IN {codes(V.OPEN)} AND i.closed_timestamp IS NULL AND aging_pickup < 30
      AND n.shipment_id LIKE 'PT%' AND CAST({ts('n.ctime')} AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-29'),
wide AS (
    SELECT base.*, nm.status_name, nm.status AS named_status, st.station_name AS at_name,
           split_part(st.station_name, ' -', 1) AS code, split_part(lm.station_name, ' -', 1) AS lm_code,
           lm.station_name AS lm_name, split_part(rt.station_name, ' -', 1) AS rt_code,
           f.hub AS f_hub, f.at_ts AS f_ts, ret.aging_return, lh.operator AS lh_operator,
           hh.region AS h_region, fh.region AS f_region
    FROM base
    LEFT JOIN {STATUS_MAP} nm ON nm.status = base.status
    LEFT JOIN station st ON st.station_id = base.at_id
    LEFT JOIN fleet_order_dwd m ON m.shipment_id = base.shipment_id
    LEFT JOIN station lm ON lm.station_id = m.station_id
    LEFT JOIN station rt ON rt.station_id = m.return_station_id
    LEFT JOIN {numbered('failed_op_log', f"shipment_id, split_part(station_name, ' -', 1) AS hub, {ts()} AS at_ts", descending=True)} f
        ON f.shipment_id = base.shipment_id
    LEFT JOIN (SELECT shipment_id, date_diff('day', CAST(min({ts()}) AS DATE), DATE '2024-01-31') + 1 AS aging_return
               FROM tracking WHERE status IN (10, 58, 95) GROUP BY shipment_id) ret ON ret.shipment_id = base.shipment_id
    LEFT JOIN {numbered('tracking', 'shipment_id, operator', 'status IN (47, 15, 233, 56, 64)', True)} lh ON lh.shipment_id = base.shipment_id
    LEFT JOIN hub_region hh ON hh.code = split_part(st.station_name, ' -', 1)
    LEFT JOIN hub_region fh ON 'F' || fh.code[2:] = split_part(st.station_name, ' ', 1)),
judged AS (
    SELECT *, CASE WHEN status_name ^@ 'Return_' OR status_name = 'Return' THEN 'Return' ELSE 'Forward' END AS status_flow,
        CASE WHEN is_warehouse THEN 'WH' WHEN is_cross_border THEN 'CB' WHEN is_marketplace THEN 'MKP'
             WHEN is_bulky THEN 'BKY' WHEN is_open_service THEN 'NS' ELSE 'MKP' END AS order_type,
        CASE WHEN at_name IS NOT NULL THEN code WHEN latest_operator_name LIKE '%agent%' THEN 'SOCE'
             ELSE CASE latest_operator_name WHEN 'lead.x' THEN 'SORC-A' WHEN 'lead.y' THEN 'NERC-B' END END AS current_station,
        CASE WHEN status_name ^@ 'Return_' AND h_region IS NOT NULL THEN h_region
             WHEN code = 'Sorting center' THEN 'SOCE'
             WHEN at_name IS NULL AND latest_operator_name LIKE '%agent%' THEN 'SOCE'
             WHEN code IN {codes((*V.REGIONAL, 'SOCE'))} THEN code
             WHEN coalesce(f_region, h_region) IS NOT NULL THEN coalesce(f_region, h_region)
             WHEN regexp_matches(at_name, '^[FDH]') OR at_name = 'Sorting Center' THEN 'SOCE' ELSE code END AS pic,
        CASE WHEN status_name ^@ 'Return_' THEN rt_code
             WHEN latest_operator_name = 'Flash' OR lm_name = 'SOCE' THEN 'Flash'
             WHEN contains(lm_code, 'Kerry') THEN 'Kerry' WHEN contains(lm_code, 'Ninja') THEN 'Ninja van' ELSE lm_code END AS hub
    FROM wide)
SELECT CASE WHEN current_station IN {codes(V.REGIONAL)} THEN current_station ELSE pic END AS pic_name,
    CASE WHEN status_name IN {codes(V.LINEHAUL_STATUS_NAMES)} THEN 'LH' WHEN pic = 'SOCE' THEN 'SOC'
         WHEN current_station IN {codes(V.REGIONAL)} OR pic IN {codes(V.REGIONAL)} THEN 'RC' END AS station_pic,
    shipment_id, status_flow, order_type, cogs_amount,
    CASE WHEN at_name IN {codes((*V.REGIONAL, 'SOCE', 'Sorting center'))} THEN 'MM' ELSE 'CTO/MM' END AS stuck_function,
    current_station, last_ts AS last_timestamp, status_name AS latest_status_name,
    CASE WHEN named_status IN {codes(V.ON_THE_ROAD)} THEN lh_operator ELSE latest_operator_name END AS operator,
    aging_pickup, date_diff('day', CAST(last_ts AS DATE), DATE '2024-01-31') + 1 AS aging_last_timestamp, aging_return,
    CASE WHEN f_ts > last_ts THEN f_hub END AS unsucessful_log_hub, to_number, lh_task_id,
    CASE WHEN status_flow = 'Return' AND order_type IN ('CB', 'WH') THEN 'SCOM'
         WHEN hub IN {codes((*V.REGIONAL, 'SOCE'))} THEN 'Flash' ELSE hub END AS hub_destination,
    CASE WHEN status_flow = 'Return' AND order_type IN ('CB', 'WH') THEN 'GBKK'
         WHEN hub IN {codes(V.REGIONAL)} THEN '4PL' WHEN hub IN {codes(V.ZONE_CENTRAL_HUBS)} THEN 'GBKK'
         WHEN hub IN {codes(V.ZONE_UPCOUNTRY_HUBS)} THEN 'UPC' WHEN z.gbkk_upc_ops_region IS NULL THEN '4PL'
         WHEN z.gbkk_upc_ops_region IN ('GBKK', '4PL') THEN z.gbkk_upc_ops_region ELSE 'UPC' END AS destination_zone
FROM judged LEFT JOIN region_index z ON z.district_code = substring(split_part(hub, '-', 1), 2, 4)
WHERE hub IS NOT NULL AND current_station <> 'SOCW'
  AND NOT coalesce(f_ts > last_ts AND regexp_matches(f_hub, '^[HFD4]'), FALSE)""",
)
def _(spark, sf):
    places = spark.createDataFrame(PLACES, "operator string, station string")
    return plans.stuck_shipments(
        spark, tables(spark, sf, STUCK), date(2024, 1, 31), operator_stations=places, settings=SETTINGS
    )


# --- pickups ------------------------------------------------------------------------------

PICKUP = Mix((13, 39, 8, 15, 36, 8, 39, 13, 35, 18, 42, 47, 8, 15, 36, 35, 58, 62, 64, 81, 89, 96, 2, 5))
_PICKED = (
    with_clause(
        PICKUP, "tracking", "fleet_order", "station_raw", "pickup_alloc", "seller_info"
    )
    + f"""
, pick AS {numbered('tracking', f'shipment_id, {ts()} AS pickup_time, user_id, station_id, operator', 'status IN (13, 39)')},
seen AS (
    SELECT shipment_id, bool_or(status = 8 AND station_id IN (3, 242)) AS sorted, bool_or(status = 42) AS at_hub
    FROM tracking GROUP BY shipment_id),
alloc AS (
    SELECT pickup_order_id, pickup_task_id, pickup_point_id FROM pickup_alloc
    QUALIFY row_number() OVER (PARTITION BY pickup_order_id
                               ORDER BY allocated_time DESC NULLS LAST, pickup_task_id DESC, pickup_point_id DESC) = 1),
direct AS (
    SELECT o.shipment_id, o.cogs, pick.pickup_time, user_id AS driver_id, operator AS driver_name, station_name,
           CAST(coalesce(sorted, FALSE) AS INT) AS is_soc_rec, pickup_task_id, pickup_point_id, shop_id, seller_name,
           CAST(coalesce(pickup_task_id = '', FALSE) AS INT) AS no_task
    FROM fleet_order o JOIN pick ON pick.shipment_id = o.shipment_id
    LEFT JOIN seen ON seen.shipment_id = o.shipment_id
    LEFT JOIN station_raw s ON s.id = pick.station_id
    LEFT JOIN alloc ON alloc.pickup_order_id = o.shipment_id
    LEFT JOIN seller_info si ON si.shipment_id = o.shipment_id
    WHERE NOT coalesce(at_hub, FALSE) AND CAST(pickup_time AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
      AND user_id IS NOT NULL AND operator IS NOT NULL AND station_name IS NOT NULL)"""
)


@query(
    "report_direct_pickup_summary",
    _PICKED
    + """
SELECT CAST(pickup_time AS DATE) AS report_date, driver_id, pickup_point_id, count(*) AS total_order_in_pu_task,
    CAST(sum(is_soc_rec) AS BIGINT) AS total_soc_rec, CAST(count(*) - sum(is_soc_rec) AS BIGINT) AS diff,
    CAST(sum(no_task) AS BIGINT) AS total_no_pu_task
FROM direct GROUP BY ALL""",
)
def _(spark, sf):
    return plans.direct_pickup_summary(spark, tables(spark, sf, PICKUP), date(2024, 1, 31), settings=SETTINGS)


@query(
    "report_sortation_not_received",
    _PICKED
    + """
SELECT shipment_id, pickup_time, pickup_task_id, pickup_point_id, station_name AS pickup_station_name, driver_id,
    driver_name, shop_id, seller_name, is_soc_rec, cogs, no_task AS is_no_pu_task
FROM direct WHERE no_task = 1 OR is_soc_rec = 0""",
)
def _(spark, sf):
    return plans.sortation_not_received(spark, tables(spark, sf, PICKUP), date(2024, 1, 31), settings=SETTINGS)


@query(
    "report_direct_pickup_summary_unique_seller",
    _PICKED
    + """
SELECT CAST(pickup_time AS DATE) AS report_date, driver_id, pickup_point_id, count(DISTINCT shipment_id) AS total_order_in_pu_task,
    CAST(sum(is_soc_rec) AS BIGINT) AS total_soc_rec, CAST(count(*) - sum(is_soc_rec) AS BIGINT) AS diff,
    CAST(sum(no_task) AS BIGINT) AS total_no_pu_task
FROM (SELECT DISTINCT * EXCLUDE (shop_id, seller_name) FROM direct) GROUP BY ALL""",
)
def _(spark, sf):
    t = tables(spark, sf, PICKUP)
    return plans.direct_pickup_summary(spark, t, date(2024, 1, 31), seller_is_unique=True, settings=SETTINGS)


DATES = Mix((0, 39, 8, 36, 0, 39, 15))


def _all_orders(t):
    return t["fleet_order"].select("shipment_id")


@query(
    "report_created_and_pickup_dates",
    with_clause(DATES, "tracking", "shipment_info", "fleet_order")
    + f"""
SELECT c.shipment_id,
    CASE i.order_type_name WHEN 'CB' THEN 'CB' WHEN 'Own Express' THEN 'WH' WHEN 'OPEN_STANDARD' THEN 'OSV'
         WHEN 'BULKY_MARKETPLACE' THEN 'BKY' ELSE CASE WHEN i.shipment_id IS NOT NULL THEN 'MKP' END END AS order_type,
    {ts('c.ctime')} AS created_timestamp, CAST({ts('p.ctime')} AS DATE) AS pickup_done_date
FROM tracking c LEFT JOIN (SELECT * FROM tracking WHERE status = 39) p ON p.shipment_id = c.shipment_id
LEFT JOIN shipment_info i ON i.shipment_id = c.shipment_id
WHERE c.status = 0 AND c.shipment_id IN (SELECT shipment_id FROM fleet_order)""",
)
def _(spark, sf):
    t = tables(spark, sf, DATES)
    return plans.created_and_pickup_dates(
        spark, t, _all_orders(t), order_types={"Own Express": "WH", "OPEN_STANDARD": "OSV"}, settings=SETTINGS
    )


@query(
    "report_created_and_pickup_dates_deduped",
    with_clause(DATES, "tracking", "shipment_info", "fleet_order")
    + f"""
SELECT c.shipment_id,
    CASE i.order_type_name WHEN 'CB' THEN 'CB' WHEN 'Own Express' THEN 'WH' WHEN 'OPEN_STANDARD' THEN 'OSV'
         WHEN 'BULKY_MARKETPLACE' THEN 'BKY' ELSE CASE WHEN i.shipment_id IS NOT NULL THEN 'MKP' END END AS order_type,
    {ts('c.ctime')} AS created_timestamp, CAST({ts('p.ctime')} AS DATE) AS pickup_done_date
FROM {numbered('tracking', 'shipment_id, ctime', 'status = 0')} c
LEFT JOIN {numbered('tracking', 'shipment_id, ctime', 'status = 39')} p ON p.shipment_id = c.shipment_id
LEFT JOIN shipment_info i ON i.shipment_id = c.shipment_id
WHERE c.shipment_id IN (SELECT shipment_id FROM fleet_order)""",
)
def _(spark, sf):
    t = tables(spark, sf, DATES)
    return plans.created_and_pickup_dates(
        spark, t, _all_orders(t), order_types={"Own Express": "WH", "OPEN_STANDARD": "OSV"}, dedupe=True, settings=SETTINGS
    )


# --- lead times ---------------------------------------------------------------------------

LEAD = Mix((8, 15, 36, 47, 48, 64, 65, 56, 235, 86, 87, 233, 234, 39, 42, 81, 0, 58, 73, 11), strict=True, renamed=True,
           stations=(3, 242, 71, 77, 1, 2, 6, 7, 8, 13, 1479, None, 2400, 44, 55, 66, 983))
_OUT, _IN = codes(V.LEADTIME_DEPARTED), codes(V.LEADTIME_ARRIVED)


def _by_name(e: str, extra: str = "FALSE") -> str:
    return (
        f"CASE WHEN {e} ^@ 'H' THEN 'LM' WHEN {e} ^@ 'F' THEN 'FM' WHEN {e} ^@ 'D' THEN 'SDOP' WHEN {e} ^@ 'Partner' THEN 'PS' "
        f"WHEN {e} ^@ 'SOC' OR {extra} THEN 'SOC' WHEN {e} IN {codes(V.REGIONAL)} THEN 'RC' WHEN {e} ^@ 'Brand' THEN 'PS' END"
    )


_FUNCTIONS = ("sdop", "ps", "fm", "rc", "soc", "lh", "4pl", "lm")
_LEAD_COLUMNS = ", ".join(
    f"CAST(sum(hours) FILTER (WHERE flow = '{flow}') AS BIGINT) AS leadtime_{flow.lower()}, "
    + ", ".join(
        f"CAST(sum(hours) FILTER (WHERE pic = '{f.upper()}' AND flow = '{flow}') AS BIGINT) AS leadtime_{f}_{flow.lower()}"
        for f in _FUNCTIONS
    )
    for flow in ("FWD", "RTN")
)


@query(
    "report_leadtime_by_function",
    with_clause(LEAD, "tracking", "status_src", "station", "shipment_info", "fleet_order")
    + f"""
, names AS (SELECT status, min(status_name) AS status_name FROM status_src GROUP BY status),
walk AS (
    SELECT t.shipment_id, t.status, n.status_name, {ts()} AS at_ts, s.station_name AS st, {js('station_name')} AS partner,
        {js_int('station_id')} AS named_id, lead({ts()}) OVER w AS next_ts, lead(s.station_name) OVER w AS next_st,
        lead(t.status) OVER w AS next_status, lag(s.station_name) OVER w AS prev_st
    FROM tracking t LEFT JOIN station s ON s.station_id = t.station_id LEFT JOIN names n ON n.status = t.status
    WHERE t.status NOT IN {codes(V.LEADTIME_IGNORED)} AND t.shipment_id IN (SELECT shipment_id FROM fleet_order)
    WINDOW w AS (PARTITION BY t.shipment_id ORDER BY ctime, event_id)),
step AS (
    SELECT w.*, g.station_name AS named, i.order_type_id, i.delivered_sla_timestamp,
        CASE WHEN partner IN ('Flash', 'Kerry', 'Ninja Van') THEN partner ELSE coalesce(st, prev_st) END AS hub
    FROM walk w LEFT JOIN station g ON g.station_id = w.named_id
    LEFT JOIN shipment_info i ON i.shipment_id = w.shipment_id),
leg AS (
    SELECT *, coalesce(hub, named) AS own,
        CASE WHEN status IN {_OUT} AND next_status NOT IN {_IN} THEN next_st ELSE hub END AS e1,
        CASE WHEN status IN {_IN} THEN next_st ELSE hub END AS e2 FROM step),
timed AS (
    SELECT CAST(delivered_sla_timestamp AS DATE) AS sla_date, shipment_id,
        CASE WHEN order_type_id = '0' THEN 'WH' WHEN order_type_id = '1' THEN 'CB' WHEN order_type_id = '12' THEN 'NS'
             WHEN order_type_id IN ('2', '6', '9', '14', '15') THEN 'MKP' WHEN order_type_id IN ('7', '8') THEN 'BKY' END AS order_type,
        CASE WHEN contains(status_name, 'Return') THEN 'RTN' ELSE 'FWD' END AS flow,
        CASE WHEN next_ts IS NOT NULL THEN date_sub('hour', at_ts, next_ts)
             WHEN status NOT IN {codes(V.LEADTIME_TERMINAL)} THEN date_sub('hour', at_ts, TIMESTAMP '2024-02-01 09:30:00') END AS hours,
        CASE WHEN partner IN ('Flash', 'Kerry', 'Ninja Van') THEN '4PL'
             WHEN status IN {_OUT} AND next_status IN {_IN} THEN 'LH'
             ELSE coalesce({_by_name('e1')}, {_by_name('e2', "own = 'Sorting center'")}, {_by_name('own', "own = 'Sorting center'")}) END AS pic
    FROM leg)
SELECT sla_date, shipment_id, order_type, {_LEAD_COLUMNS} FROM timed GROUP BY ALL""",
)
def _(spark, sf):
    t = tables(spark, sf, LEAD)
    return plans.leadtime_by_function(spark, t, _all_orders(t), datetime(2024, 2, 1, 9, 30), settings=SETTINGS)


PARTNER = Mix((89, 18, 81, 8, 36))


def seconds(column: str):
    return F.col(column).cast("interval second").cast("decimal(18,6)").cast("double")


@query(
    "report_partner_leadtime_summary",
    with_clause(PARTNER, "tracking", "station")
    + f"""
, main AS (
    SELECT r.at_ts AS rec, o.at_ts AS over, d.at_ts AS del, s.station_name
    FROM {numbered('tracking', f'shipment_id, {ts()} AS at_ts', 'status = 89')} r
    JOIN {numbered('tracking', f"shipment_id, {ts()} AS at_ts, {js_int('station_id')} AS id", 'status = 18')} o USING (shipment_id)
    JOIN {numbered('tracking', f'shipment_id, {ts()} AS at_ts', 'status = 81')} d USING (shipment_id)
    JOIN station s ON s.station_id = o.id
    WHERE s.station_name IN ('NERC-A', 'NERC-B', 'SORC-A', 'SORC-B', 'NORC-A', 'NORC-B')
      AND CAST(r.at_ts - INTERVAL 2 HOUR AS DATE) BETWEEN DATE '2023-10-03' AND DATE '2024-01-30')
SELECT CAST(rec - INTERVAL 2 HOUR AS DATE) AS date_3pl_received, station_name AS soc_handover_station,
    count(*) AS _3pl_received_vol,
    CAST(CAST(avg(date_sub('minute', rec, del)) AS DECIMAL(38, 0)) AS BIGINT) AS avg_leadtime_rec_to_del,
    CAST(CAST(avg(date_sub('minute', over, del)) AS DECIMAL(38, 0)) AS BIGINT) AS avg_leadtime_handover_to_del,
    round(avg(date_sub('second', rec, del)), 6) AS leadtime_rec_to_del,
    round(avg(date_sub('second', over, del)), 6) AS leadtime_handover_to_del
FROM main GROUP BY ALL""",
)
def _(spark, sf):
    df = plans.partner_leadtime_summary(spark, tables(spark, sf, PARTNER), date(2024, 1, 31), settings=SETTINGS)
    # Plain numbers compare alike in both engines.
    return df.withColumns(
        {
            "avg_leadtime_rec_to_del": F.col("avg_leadtime_rec_to_del").cast("long"),
            "avg_leadtime_handover_to_del": F.col("avg_leadtime_handover_to_del").cast("long"),
            "leadtime_rec_to_del": seconds("leadtime_rec_to_del"),
            "leadtime_handover_to_del": seconds("leadtime_handover_to_del"),
        }
    )


# --- line-haul ----------------------------------------------------------------------------

TRIPS = Mix((46, 47, 35, 15, 211, 233, 55, 56, 62, 64, 8, 36, 81))


@query(
    "report_latest_linehaul_and_sack",
    with_clause(TRIPS, "tracking", "fleet_order")
    + f"""
SELECT * FROM {numbered('tracking', f"shipment_id, status, {js('linehaul_task_id')} AS latest_lh_task_id, {js('to_number')} AS latest_to_number",
                        f'status IN {codes(V.TRIP)} AND shipment_id IN (SELECT shipment_id FROM fleet_order)', True)}""",
)
def _(spark, sf):
    t = tables(spark, sf, TRIPS)
    return plans.latest_linehaul_and_sack(spark, t, _all_orders(t), settings=SETTINGS)


PATHS = Mix((8, 15, 35, 36, 8, 8, 15), stations=(3, 242, 71, 77, 82, 983, 1479, 1480, 1350, 3, 71, 77, 82, 983, 1479, 1480, 78))
_SORT, _PU, _DEL, _ANY = "(3, 242)", codes(V.PICKUP_CENTRES), codes(V.DELIVERY_CENTRES), codes(V.ALL_CENTRES)
_AREA = lambda c: f"split_part({c}, '-', 1)"
_MOVED = {"CERC": (-5, -9, 4, -1), "NERC-A": (-5, -10, 5, -1), "NERC-B": (-5, -10, 5, -1), "NORC-A": (-3, -10, 7, -1),
          "NORC-B": (2, -10, 12, 1), "SORC-B": (5, -11, 16, 1)}
_LIMITS = ", ".join(f"('{c}', {a}, {b}, {t}, {s})" for c, (a, b, t, s) in _MOVED.items())


def _path_sql(extra_join: str = "") -> str:
    return f"""
, limits(pu, a, b, c, sign) AS (VALUES {_LIMITS}),
onward(del, d) AS (VALUES ('NERC-A', 17), ('NERC-B', 16), ('NORC-A', 17), ('NORC-B', 16), ('SORC-A', 13), ('SORC-B', 12), ('CERC', 18)),
log AS (SELECT *, {ts()} AS t FROM tracking WHERE {ts()} >= TIMESTAMP '2023-10-03'),
times AS (
    SELECT shipment_id, min(t) FILTER (WHERE station_id IN {_SORT} AND status = 8) AS soc_in,
        min(t) FILTER (WHERE station_id IN {_SORT} AND status = 15) AS soc_out,
        min(t) FILTER (WHERE station_id IN {_PU} AND status = 8) AS rc_in,
        min(t) FILTER (WHERE station_id IN {_PU} AND status = 15) AS rc_out,
        min(t) FILTER (WHERE station_id IN {_PU} AND status = 36) AS rc_there,
        max(t) FILTER (WHERE station_id IN {_ANY} AND status = 8) AS rc_last
    FROM log GROUP BY shipment_id),
pu AS {numbered('log', 'shipment_id, station_id', f"status = 8 AND station_id IN {_PU} AND t >= TIMESTAMP '2024-01-17'")},
de AS {numbered('log', 'shipment_id, station_id', f"status = 8 AND station_id IN {_DEL} AND t >= TIMESTAMP '2024-01-17'", True)},
back AS {numbered('log', f"shipment_id, {js('linehaul_task_id')} AS lt", f"status = 35 AND station_id IN {_DEL} AND t >= TIMESTAMP '2023-12-02'")},
shut AS {numbered('log', f"shipment_id, {js('linehaul_task_id')} AS lt", f"status = 35 AND station_id IN {_SORT} AND t >= TIMESTAMP '2023-12-02'")},
trips AS (SELECT task_number, driver_name FROM linehaul_task LEFT JOIN driver USING (driver_id)),
paths AS (
    SELECT x.*, s1.station_name AS pu_name, s2.station_name AS del_name, back.lt AS back_lt, shut.lt AS shut_lt,
        CAST(date_sub('hour', rc_out, rc_there) AS INT) AS hours
    FROM fleet_order o JOIN times x ON x.shipment_id = o.shipment_id
    LEFT JOIN pu ON pu.shipment_id = x.shipment_id LEFT JOIN station_raw s1 ON s1.id = pu.station_id
    LEFT JOIN de ON de.shipment_id = x.shipment_id LEFT JOIN station_raw s2 ON s2.id = de.station_id
    LEFT JOIN back ON back.shipment_id = x.shipment_id LEFT JOIN shut ON shut.shipment_id = x.shipment_id
    {extra_join}
    WHERE {day6('soc_in')} BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' AND rc_in < soc_in AND rc_last > soc_in)
SELECT {day6('soc_in')} AS report_date, p.shipment_id, replace(pu_name, '-', '') || '-SOC-' || replace(del_name, '-', '') AS lh_route,
    pu_name AS pickup_rc_station, back_lt AS backhaul_lh_task, b.driver_name AS back_haul_driver, 'SOCE' AS soc_station,
    shut_lt AS shuttle_lh_task, s.driver_name AS shuttle_driver, del_name AS delivery_rc_station,
    CAST(coalesce(CAST(rc_out + a * INTERVAL 1 HOUR AS DATE) <= CAST(rc_in AS DATE), FALSE) AS INT) AS is_rc_transporting_ontime,
    CAST(coalesce(CAST(rc_there + (CASE WHEN pu_name = 'NERC-B' AND del_name ^@ 'NORC' THEN -11 ELSE b END) * INTERVAL 1 HOUR AS DATE)
                  <= CAST(rc_in AS DATE), FALSE) AS INT) AS is_rc_transported_ontime,
    CAST(coalesce(hours <= (CASE WHEN pu_name = 'NERC-B' AND del_name ^@ 'NORC' THEN 8 ELSE c END), FALSE) AS INT) AS rc_traveling_soc_leadtime_check,
    CAST(coalesce(CAST(soc_out + sign * d * INTERVAL 1 HOUR AS DATE) <= {day6('soc_in')}, FALSE) AS INT) AS is_soc_transporting_ontime,
    rc_in AS pu_rc_received_time, rc_out AS min_xrc_lh_transporting_time, rc_there AS min_xrc_lh_transported_time,
    soc_in AS min_soc_received, soc_out AS min_soc_lh_transporting, hours AS rc_to_soc_delivery_leadtime
FROM paths p JOIN limits ON pu = pu_name JOIN onward ON del = del_name
LEFT JOIN trips b ON b.task_number = back_lt LEFT JOIN trips s ON s.task_number = shut_lt
WHERE {_AREA('pu_name')} <> {_AREA('del_name')}"""


@query(
    "report_linehaul_path_performance",
    with_clause(PATHS, "tracking", "fleet_order", "station_raw", "linehaul_task", "driver") + _path_sql(),
)
def _(spark, sf):
    return plans.linehaul_path_performance(spark, tables(spark, sf, PATHS), date(2024, 1, 31), settings=SETTINGS)


@query(
    "report_linehaul_path_performance_with_addresses",
    with_clause(
        PATHS, "tracking", "fleet_order", "station_raw", "linehaul_task", "driver", "buyer_info", "pickup_order",
        "dropoff_order", "region_index",
    )
    + _path_sql(
        """LEFT JOIN buyer_info bi ON bi.shipment_id = o.shipment_id
    LEFT JOIN (SELECT pickup_order_id, seller_addr_state FROM pickup_order
               QUALIFY ctime = max(ctime) OVER (PARTITION BY pickup_order_id)) po ON po.pickup_order_id = o.shipment_id
    LEFT JOIN dropoff_order dr ON dr.shipment_id = o.shipment_id
    LEFT JOIN (SELECT DISTINCT province, lh_region FROM region_index) r1 ON r1.province = bi.buyer_addr_state
    LEFT JOIN (SELECT DISTINCT province, lh_region FROM region_index) r2 ON r2.province = coalesce(po.seller_addr_state, dr.seller_state)"""
    ),
)
def _(spark, sf):
    return plans.linehaul_path_performance(
        spark, tables(spark, sf, PATHS), date(2024, 1, 31), with_addresses=True, settings=SETTINGS
    )


@query(
    "seller_address",
    with_clause(PATHS, "fleet_order", "pickup_order", "dropoff_order")
    + """
SELECT f.shipment_id, coalesce(p.seller_addr_state, d.seller_state) AS seller_province,
    coalesce(p.seller_addr_district, d.seller_city) AS seller_district
FROM fleet_order f
LEFT JOIN (SELECT * FROM pickup_order QUALIFY ctime = max(ctime) OVER (PARTITION BY pickup_order_id)) p ON p.pickup_order_id = f.shipment_id
LEFT JOIN dropoff_order d ON d.shipment_id = f.shipment_id""",
)
def _(spark, sf):
    return seller_address(tables(spark, sf, PATHS))


LONG = Mix((8, 15, 18, 36, 81, 58, 64), stations=(71, 77, 82, 983, 1479, 1480, 1350, 3, 242))


@query(
    "report_long_path_orders",
    with_clause(LONG, "tracking", "status_src", "station", "fleet_order", "shipment_info")
    + f"""
, hub_region(code, region) AS (VALUES {HUB_LIST})
SELECT DISTINCT CAST({ts('r.ctime')} AS DATE) AS rc_received_date, r.shipment_id, s.station_name AS pickup_rc_station_name,
    coalesce(h.region, i.buyer_region_name) AS rc_delivery_station, n.status_name AS last_staus_name,
    CASE WHEN os.station_name = s.station_name THEN {ts('o.ctime')} END AS min_soc_handover_time_stamp, o.operator
FROM {numbered('tracking', 'shipment_id, station_id, ctime', 'status = 8')} r
JOIN station s ON s.station_id = r.station_id
JOIN {numbered('tracking', 'shipment_id, status', descending=True)} l ON l.shipment_id = r.shipment_id
LEFT JOIN {STATUS_MAP} n ON n.status = l.status
JOIN fleet_order f ON f.shipment_id = r.shipment_id
LEFT JOIN shipment_info i ON i.shipment_id = r.shipment_id
LEFT JOIN station ds ON ds.station_id = f.station_id
LEFT JOIN hub_region h ON h.code = split_part(ds.station_name, ' ', 1)
LEFT JOIN {numbered('tracking', f"shipment_id, operator, ctime, {js_int('station_id')} AS at_id", 'status = 18')} o ON o.shipment_id = r.shipment_id
LEFT JOIN station os ON os.station_id = o.at_id
WHERE CAST({ts('r.ctime')} AS DATE) = DATE '2024-01-03' AND s.station_name IN {codes(V.REGIONAL)}""",
)
def _(spark, sf):
    return plans.long_path_orders(spark, tables(spark, sf, LONG), date(2024, 1, 3), settings=SETTINGS)


# --- backlog ------------------------------------------------------------------------------

BACKLOG = Mix((*V.BACKLOG, 1, 10, 67, 15, 36, 8, 81))
_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE status IN {codes(c)}) AS \"{n}\"" for n, c in V.BACKLOG_COLUMNS.items()
)


@query(
    "report_hub_live_backlog",
    with_clause(BACKLOG, "tracking", "status_src", "station")
    + f"""
, now AS {numbered('tracking', 'shipment_id, status, station_id, content', f"shipment_id LIKE 'PT%' AND CAST({ts()} AS DATE) BETWEEN DATE '2023-12-17' AND DATE '2024-01-31'", True)},
attempt AS {numbered('tracking', 'shipment_id, station_id', 'status IN (1, 10, 67)', True)},
place AS (
    SELECT now.status, CASE WHEN now.status IN (15, 36, 64, 65) THEN {js('dest_station_name')}
        WHEN now.status IN (2, 5, 49, 50, 119, 120, 115, 116) THEN CAST(attempt.station_id AS VARCHAR)
        ELSE CAST(now.station_id AS VARCHAR) END AS place
    FROM now LEFT JOIN attempt USING (shipment_id) WHERE now.status IN {codes(sorted(set(V.BACKLOG)))}),
named AS (SELECT p.status, coalesce(s.station_name, p.place) AS nm FROM place p LEFT JOIN station s ON CAST(s.station_id AS VARCHAR) = p.place),
hub AS (
    SELECT status, CASE WHEN nm = 'FSATH- สาทร' THEN 'HSATH' WHEN nm = 'DJOMT-B-จอมทอง' THEN 'HJOMT-B'
        WHEN regexp_matches(nm, '^[FD]') THEN 'H' || substring(split_part(nm, ' -', 1), 2) ELSE split_part(nm, ' -', 1) END AS code FROM named),
known AS (SELECT DISTINCT split_part(station_name, ' -', 1) AS code FROM station WHERE station_name LIKE 'H%'
          UNION SELECT 'HSATH' FROM station WHERE station_name = 'FSATH- สาทร' UNION SELECT 'HJOMT-B' FROM station WHERE station_name = 'DJOMT-B-จอมทอง'),
final AS (SELECT status, CASE WHEN known.code IS NULL THEN hub.code || '-A' ELSE hub.code END AS h FROM hub LEFT JOIN known ON known.code = hub.code)
SELECT h AS "Hub Name", {_COUNTS} FROM final WHERE h LIKE 'H%' GROUP BY h""",
)
def _(spark, sf):
    return plans.hub_live_backlog(spark, tables(spark, sf, BACKLOG), date(2024, 1, 31), settings=SETTINGS)


# --- one station --------------------------------------------------------------------------

OVERSEAS = Mix((8, 36, 8, 15, 36), named=(3, 3, 71, 77))


@query(
    "report_overseas_hub_performance",
    with_clause(OVERSEAS, "tracking")
    + f"""
SELECT a.shipment_id, 'HOME' AS channel, {ts('r.ctime')} AS received_time, {ts('a.ctime')} AS lhtransported_time,
    {day6(ts('r.ctime'))} AS received_date, {day6(ts('a.ctime'))} AS lhtransported_date,
    CAST(week({ts('r.ctime')}) + 1 AS INT) AS week_num
FROM tracking a JOIN {numbered('tracking', 'shipment_id, ctime', f"status = 8 AND {js('station_id')} = '3'")} r ON r.shipment_id = a.shipment_id
WHERE a.status = 36 AND {js('dest_station_name', 'a.content')} = 'SIP-LMHub'
  AND {day6(ts('r.ctime'))} BETWEEN DATE '2024-01-13' AND DATE '2024-01-31'""",
)
def _(spark, sf):
    return plans.overseas_hub_performance(spark, tables(spark, sf, OVERSEAS), date(2024, 1, 31), settings=SETTINGS)


TOUCH = Mix((8, 9, 15, 18, 36, 58), stations=(3, 242, 3, 77, 71))


@query(
    "report_first_touch_by_operator",
    with_clause(TOUCH, "tracking", "status_src", "station")
    + f"""
SELECT shipment_id, status_name, operator, t AS x_timestamp, {day6('t')} AS received_date, station_name
FROM (SELECT tr.*, {ts()} AS t, s.station_name FROM tracking tr JOIN station s ON s.station_id = tr.station_id
      WHERE s.station_name = 'Sorting center'
      QUALIFY row_number() OVER (PARTITION BY shipment_id ORDER BY ctime, event_id) = 1) x
LEFT JOIN {STATUS_MAP} n ON n.status = x.status
WHERE {day6('t')} = DATE '2024-01-02' AND operator IN ('IND0001', 'CAB0002', 'Flash', 'rider.a', 'lead.x')""",
)
def _(spark, sf):
    operators = ["IND0001", "CAB0002", "Flash", "rider.a", "lead.x"]
    return plans.first_touch_by_operator(
        spark, tables(spark, sf, TOUCH), date(2024, 1, 3), operators, settings=SETTINGS
    )


# --- returns ------------------------------------------------------------------------------

RETURNS = Mix((58, 62, 63, 117, 64, 11, 12, 8, 58, 62), stations=(3, 3, 3, 242, 3, 71, 3))


def _rate(num: str, den: str) -> str:
    return f"CAST(count({num}) AS DOUBLE) / CAST(count({den}) AS DOUBLE)"


_OUTBOUND = "CASE WHEN order_type = 'SCOM' THEN returning_ts ELSE pack_ts END"
_PUNCTUAL = (
    "CASE order_type WHEN 'SCOM' THEN CASE WHEN returning_ts <= day + INTERVAL 35 HOUR THEN 1 END "
    "WHEN 'GBKK' THEN CASE WHEN pack_ts <= day + INTERVAL 30 HOUR THEN 1 END "
    "ELSE CASE WHEN pack_ts <= day + INTERVAL 54 HOUR THEN 1 END END"
)


@query(
    "report_return_performance",
    with_clause(RETURNS, "tracking", "station", "fleet_order_dwd", "region_index")
    + f"""
, got AS (
    SELECT * FROM {numbered('tracking', f'shipment_id, operator, {ts()} AS rec_ts', "status = 58 AND station_id = 3 AND operator <> 'lead.x'")}
    WHERE {day6('rec_ts')} BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'),
first_at AS (
    SELECT shipment_id, min({ts()}) FILTER (WHERE status = 62) AS pack_ts,
        min({ts()}) FILTER (WHERE status IN (63, 117)) AS returning_ts, min({ts()}) FILTER (WHERE status = 64) AS left_ts
    FROM tracking WHERE station_id = 3 GROUP BY shipment_id),
gone AS (SELECT shipment_id, 1 AS gone FROM {numbered('tracking', 'shipment_id, status', descending=True)} WHERE status IN (11, 12)),
rows_ AS (
    SELECT got.shipment_id, {day6('rec_ts')} AS date_received, CAST({day6('rec_ts')} AS TIMESTAMP) AS day, rec_ts, pack_ts,
        returning_ts, left_ts, gone,
        CASE WHEN m.shipment_id IS NULL THEN NULL WHEN m.order_type IN (0, 1) THEN 'SCOM'
             WHEN z.gbkk_upc_ops_region = 'GBKK' THEN 'GBKK' ELSE 'UPC' END AS order_type
    FROM got LEFT JOIN first_at USING (shipment_id) LEFT JOIN gone USING (shipment_id)
    LEFT JOIN fleet_order_dwd m ON m.shipment_id = got.shipment_id
    LEFT JOIN station s ON s.station_id = m.return_station_id
    LEFT JOIN region_index z ON z.district_code = substring(split_part(s.station_name, '-', 1), 2, 4)),
flags AS (
    SELECT *, CASE WHEN rec_ts <= day + INTERVAL 26 HOUR THEN 1 END AS ok, CASE WHEN rec_ts > day + INTERVAL 26 HOUR THEN 1 END AS late,
        {_OUTBOUND} AS out_ts, {_PUNCTUAL} AS punctual FROM rows_)
SELECT date_received, order_type, count(*) AS overall_received, count(ok) AS "#ontime_received_2am",
    CASE WHEN order_type IS NOT NULL THEN {_rate('ok', '*')} END AS "%ontime_received_2am",
    CASE WHEN order_type IS NOT NULL THEN {_rate('late', '*')} END AS "%late_received",
    CASE WHEN order_type IS NOT NULL THEN CAST(count(out_ts) AS DOUBLE) END AS "infull_outbound",
    CASE WHEN order_type IS NOT NULL THEN {_rate('out_ts', '*')} END AS "%infull_outbound",
    CASE WHEN order_type IS NOT NULL THEN {_rate('punctual', 'out_ts')} END AS "%ontime_outbound",
    CASE WHEN order_type IS NOT NULL THEN CAST(count(punctual) AS DOUBLE) END AS "#ontime_outbound",
    CASE WHEN order_type IN ('GBKK', 'UPC') THEN CAST(count(left_ts) AS DOUBLE) END AS "#infull_handover",
    CASE WHEN order_type IS NOT NULL THEN CAST(count(gone) AS DOUBLE) END AS "#damaged_lost"
FROM flags GROUP BY date_received, order_type""",
)
def _(spark, sf):
    return plans.return_performance(
        spark, tables(spark, sf, RETURNS), date(2024, 1, 31), excluded_operators=("lead.x",), settings=SETTINGS
    )


_RECEIPTS = with_clause(RETURNS, "tracking", "station", "fleet_order_dwd", "region_index") + f"""
, got AS (
    SELECT * FROM {numbered('tracking', f'shipment_id, operator, {ts()} AS rec_ts', "status = 58 AND station_id = 3")}
    WHERE {day6('rec_ts')} BETWEEN DATE '2024-01-01' AND DATE '2024-01-30')
SELECT got.shipment_id, got.operator, rec_ts AS receive_time, {ts('nullif(m.returned_time, 0)')} AS returned_time,
    rec_ts <= CAST({day6('rec_ts')} AS TIMESTAMP) + INTERVAL 26 HOUR AS on_time
FROM got LEFT JOIN fleet_order_dwd m ON m.shipment_id = got.shipment_id"""


@query("report_return_receipts", _RECEIPTS)
def _(spark, sf):
    """The rows behind the return report."""
    rows = plans.returns.return_receipts(spark, tables(spark, sf, RETURNS), date(2024, 1, 31), settings=SETTINGS)
    on_time = F.col("ontime_received_2am").isNotNull()
    return rows.select("shipment_id", "operator", "receive_time", "returned_time", on_time.alias("on_time"))


# --- trackers -----------------------------------------------------------------------------

TRACK = Mix((8, 15, 18, 36, 46, 47, 35, 81, 58, 64, 233), strict=True)


@query(
    "report_shipment_tracker",
    with_clause(TRACK, "tracking", "status_src", "station", "fleet_order_dwd", "fleet_order", "shipment_info")
    + f"""
SELECT DISTINCT l.shipment_id, n.status_name, s.station_name AS current_station, l.operator, i.order_type_id AS order_type,
    {ts('l.ctime')} AS latest_timestamp, CAST(round(m.cogs) AS INT) AS cogs,
    CASE WHEN l.operator = 'Flash' THEN 'Flash' ELSE lm.station_name END AS lm_destination,
    rt.station_name AS return_station_name, t.lt AS lh_trip_number, t.tn AS to_number
FROM {numbered('tracking', 'shipment_id, status, station_id, operator, ctime', descending=True)} l
LEFT JOIN {STATUS_MAP} n ON n.status = l.status
LEFT JOIN station s ON s.station_id = l.station_id
LEFT JOIN fleet_order_dwd m ON m.shipment_id = l.shipment_id
LEFT JOIN station lm ON lm.station_id = m.station_id LEFT JOIN station rt ON rt.station_id = m.return_station_id
LEFT JOIN shipment_info i ON i.shipment_id = l.shipment_id
LEFT JOIN {numbered('tracking', f"shipment_id, {js('linehaul_task_id')} AS lt, {js('to_number')} AS tn", f'status IN {codes(V.TRIP)}', True)} t
    ON t.shipment_id = l.shipment_id
WHERE l.shipment_id IN (SELECT shipment_id FROM fleet_order)""",
)
def _(spark, sf):
    t = tables(spark, sf, TRACK)
    return plans.shipment_tracker(spark, t, _all_orders(t), settings=SETTINGS)


@query(
    "report_shipment_tracker_contacts",
    with_clause(TRACK, "tracking", "status_src", "station", "fleet_order", "shipment_info")
    + f"""
SELECT l.shipment_id, CASE WHEN is_warehouse THEN 'WH' WHEN is_cross_border THEN 'CB' WHEN is_open_service THEN 'OSV'
    WHEN is_bulky THEN 'BKY' ELSE 'MKP' END AS order_type, n.status_name AS current_status, s.station_name,
    {ts('l.ctime')} AS latest_timestamp, i.cogs_amount, i.buyer_name, i.buyer_address, i.buyer_phone, i.seller_shop_id, i.seller_shop_name
FROM {numbered('tracking', f"shipment_id, status, ctime, {js_int('station_id')} AS at_id", descending=True)} l
LEFT JOIN {STATUS_MAP} n ON n.status = l.status LEFT JOIN station s ON s.station_id = l.at_id
LEFT JOIN shipment_info i ON i.shipment_id = l.shipment_id
WHERE l.shipment_id IN (SELECT shipment_id FROM fleet_order)""",
)
def _(spark, sf):
    t = tables(spark, sf, TRACK)
    return plans.shipment_tracker_contacts(spark, t, _all_orders(t), settings=SETTINGS)
