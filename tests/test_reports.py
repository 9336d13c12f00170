"""Reports on hand-made tables; expected rows were worked out on paper."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from parcelspark import Settings, plans
from parcelspark.plans.linehaul import seller_address
from tests.fixtures import at, event, make

AS_OF = date(2024, 1, 31)
JSON = '{"station_id": %s, "linehaul_task_id": "LT1", "to_number": "TO1", "dest_station_name": "%s"}'


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*[f"`{c}`" for c in columns]) if columns else df).collect()]


def test_latest_trip_and_sack(spark):
    t = make(
        spark,
        tracking=[
            event("A", 47, "2024-01-01 00:00", content=JSON % (3, "x")),
            event("A", 15, "2024-01-02 00:00", content='{"linehaul_task_id": 7, "to_number": '),
            event("A", 8, "2024-01-03 00:00", content=JSON % (3, "x")),
            event("B", 8, "2024-01-03 00:00", content=JSON % (3, "x")),
            event("C", 64, "2024-01-03 00:00", content='{"linehaul_task_id": 7}'),
            event("D", 64, "2024-01-03 00:00", content=JSON % (3, "x")),
        ],
    )
    got = plans.latest_linehaul_and_sack(spark, t, ["A", "B", "C", "C", "Z"])
    assert sorted(rows(got)) == [("A", 15, None, None), ("C", 64, "7", None)]


def test_repeated_events_multiply_unless_deduplicated(spark):
    t = make(
        spark,
        tracking=[
            event("A", 0, "2024-01-01 00:00"), event("A", 0, "2024-01-01 01:00"),
            event("A", 39, "2024-01-02 23:59"), event("A", 39, "2024-01-03 00:00"),
            event("B", 0, "2024-01-01 00:00"),
        ],
        shipment_info=[{"shipment_id": "A", "order_type_name": "Own"}],
    )
    got = plans.created_and_pickup_dates(spark, t, ["A", "B"], order_types={"Own": "WH"})
    assert sorted(rows(got, "shipment_id", "order_type", "pickup_done_date"), key=str) == [
        ("A", "WH", date(2024, 1, 2)), ("A", "WH", date(2024, 1, 2)),
        ("A", "WH", date(2024, 1, 3)), ("A", "WH", date(2024, 1, 3)), ("B", None, None),
    ]
    once = plans.created_and_pickup_dates(spark, t, ["A", "B"], dedupe=True)
    assert sorted(rows(once), key=str) == [
        ("A", "MKP", datetime(2024, 1, 1), date(2024, 1, 2)), ("B", None, datetime(2024, 1, 1), None),
    ]


STATIONS = [
    {"station_id": 3, "station_name": "Sorting center"}, {"station_id": 242, "station_name": "SOCE"},
    {"station_id": 71, "station_name": "CERC"}, {"station_id": 77, "station_name": "NERC-A"},
    {"station_id": 1, "station_name": "HPHIT-A - Town"}, {"station_id": 2, "station_name": "FSWAN - Town"},
    {"station_id": 4, "station_name": "DQQQQ - Town"}, {"station_id": 5, "station_name": "FSATH- สาทร"},
    {"station_id": 6, "station_name": "SOCW"}, {"station_id": 7, "station_name": "HZZZZ - Town"},
]
NAMES = [
    {"status": s, "status_name": n}
    for s, n in [
        (0, "Created"), (8, "SOC_Received"), (11, "Damaged"), (12, "Lost"), (15, "SOC_LHTransporting"),
        (39, "FMHub_Pickup_Done"), (58, "Return_SOC_Received"), (47, "FMHub_LHTransporting"), (8, "SOC_Received"),
    ]
]


def test_loss_of_the_day_before(spark):
    t = make(
        spark,
        station=STATIONS,
        status_src=NAMES,
        tracking=[
            # Lost on the 30th; created, picked up, on a trip, last seen at the sort centre.
            event("A", 0, "2024-01-01 08:00"),
            event("A", 39, "2024-01-02 08:00"),
            event("A", 13, "2024-01-02 09:00"),
            event("A", 47, "2024-01-03 08:00", content=JSON % (3, "x")),
            event("A", 8, "2024-01-04 08:00", station_id=3, operator="op1"),
            event("A", 11, "2024-01-30 23:59:59"),
            event("A", 12, "2024-01-31 08:00"),
            # First loss on another day.
            event("B", 11, "2024-01-29 23:59:59"), event("B", 11, "2024-01-30 08:00"),
            event("C", 11, "2024-01-31 00:00:00"),
            # Lost without any history or attributes.
            event("D", 12, "2024-01-30 00:00:00"),
        ],
        failed_op_log=[
            {"shipment_id": "A", "ctime": at("2024-01-05 08:00"), "error_msg": "old", "station_name": "X - y"},
            {"shipment_id": "A", "ctime": at("2024-01-06 08:00"), "error_msg": "new", "station_name": "HQ - y"},
        ],
        abnormal_log=[
            {"order_id": "A", "ctime": at("2024-01-30 08:00"), "remark": "second", "new_status": 11},
            {"order_id": "A", "ctime": at("2024-01-29 08:00"), "remark": "first", "new_status": 12},
            {"order_id": "A", "ctime": at("2024-01-28 08:00"), "remark": "other", "new_status": 1},
        ],
        fleet_order_dwd=[{"shipment_id": "A", "cogs": 5.0}],
        shipment_info=[
            {"shipment_id": "A", "drop_off_sp": 0, "_4pl_name": "HOME", "origin_order_path": "[3, 71, 1]", "cod_amount": 2.0}
        ],
        seller_order=[{"shipment_id": "A", "seller_name": "S"}],
    )
    got = plans.loss_damage_attribution(spark, t, AS_OF)
    assert len(got.columns) == 24
    picked = rows(
        got, "shipment_id", "latest_status_name", "original_fm_type", "direct_shuttle_type", "_4pl_provider",
        "latest_lh_task_id", "origin_hub_destination", "latest_operator", "latest_status_before_dl",
        "latest_station_before_dl", "created_timestamp", "pickup_timestamp", "error_msg", "unsucessful_log_hub",
        "lost_pic", "remark",
    )
    assert sorted(picked, key=str) == [
        # The later loss event is an event to look behind as well, so A has two rows.
        ("A", "Damaged", "PICKUP", "DIRECT", None, "LT1", "HPHIT-A - Town", "op1", "SOC_Received", "Sorting center",
         datetime(2024, 1, 1, 8), datetime(2024, 1, 2, 8), "new", "HQ", "MM", "first"),
        ("A", "Damaged", "PICKUP", "DIRECT", None, "LT1", "HPHIT-A - Town", None, "Damaged", None,
         datetime(2024, 1, 1, 8), datetime(2024, 1, 2, 8), "new", "HQ", None, "first"),
        ("D", "Lost", "SHUTTLE", "SHUTTLE", *[None] * 12),
    ]


def stuck_log(shipment, last_status=8, last="2024-01-20 08:00", pickup="2024-01-10 08:00", station=3):
    return [event(shipment, 39, pickup), event(shipment, last_status, last, content=JSON % (station, "x"))]


def test_stuck_shipments_window_and_owner(spark):
    log = [
        *stuck_log("A"),
        *stuck_log("B", station=1), *stuck_log("C", station=2), *stuck_log("D", station=4),
        *stuck_log("E", station=71), *stuck_log("F", station=6),  # F: excluded station
        *stuck_log("G", last="2024-01-30 00:00"),  # too young
        *stuck_log("H", last="2024-01-29 23:59:59"),
        *stuck_log("I", pickup="2024-01-02 23:59:59"),  # picked up 30 days ago
        *stuck_log("J", pickup="2024-01-03 00:00"),
        *stuck_log("K"), event("K", 81, "2024-01-30 08:00"),  # delivered since
        *stuck_log("L"),  # closed
        *stuck_log("M", last_status=58, station=1),
        *stuck_log("N", station=99), *stuck_log("O", station=99), *stuck_log("P", station=99),
        *stuck_log("Q", last_status=15), event("Q", 47, "2024-01-15 08:00", operator="driver"),
        *stuck_log("R"), *stuck_log("S"), *stuck_log("T"),
        *stuck_log("U"),  # no destination
    ]
    log = [e if e.get("operator") or e["status"] != 15 else {**e, "operator": "trip"} for e in log]
    masters = [
        {"shipment_id": s, "station_id": 1, "return_station_id": 2}
        for s in "ABCDEFGHIJKLMNOPQRST"
    ]
    info = [{"shipment_id": "L", "closed_timestamp": datetime(2024, 1, 1)}]
    info += [{"shipment_id": "N", "latest_operator_name": "agent1"}, {"shipment_id": "O", "latest_operator_name": "lead"}]
    t = make(
        spark,
        tracking=log,
        station=STATIONS,
        status_src=NAMES,
        fleet_order_dwd=masters,
        shipment_info=info,
        failed_op_log=[
            {"shipment_id": "R", "ctime": at("2024-01-21 08:00"), "station_name": "HQ - y"},
            {"shipment_id": "S", "ctime": at("2024-01-19 08:00"), "station_name": "HQ - y"},
            {"shipment_id": "T", "ctime": at("2024-01-21 08:00"), "station_name": "SOCE"},
        ],
        region_index=[{"district_code": "PHIT", "gbkk_upc_ops_region": "NORTH"}],
    )
    places = spark.createDataFrame([("lead", "SORC-A")], "operator string, station string")
    got = plans.stuck_shipments(spark, t, AS_OF, operator_stations=places)
    assert len(got.columns) == 19
    owner = {r.shipment_id: r for r in got.collect()}
    assert {s: (r.pic_name, r.station_pic, r.current_station, r.stuck_function) for s, r in owner.items()} == {
        "A": ("SOCE", "SOC", "Sorting center", "MM"),
        "B": ("NORC-A", "RC", "HPHIT-A", "CTO/MM"),
        "C": ("CERC", "RC", "FSWAN", "CTO/MM"),
        "D": ("SOCE", "SOC", "DQQQQ", "CTO/MM"),
        "E": ("CERC", "RC", "CERC", "MM"),
        "H": ("SOCE", "SOC", "Sorting center", "MM"),
        "J": ("SOCE", "SOC", "Sorting center", "MM"),
        "M": ("NORC-A", "RC", "HPHIT-A", "CTO/MM"),
        "N": ("SOCE", "SOC", "SOCE", "CTO/MM"),
        "O": ("SORC-A", "RC", "SORC-A", "CTO/MM"),
        "Q": ("SOCE", "LH", "Sorting center", "MM"),
        "S": ("SOCE", "SOC", "Sorting center", "MM"),
        "T": ("SOCE", "SOC", "Sorting center", "MM"),
    }
    assert owner["A"].aging_pickup == 22 and owner["A"].aging_last_timestamp == 12
    assert (owner["A"].hub_destination, owner["A"].destination_zone) == ("HPHIT-A", "UPC")
    assert (owner["M"].status_flow, owner["M"].hub_destination, owner["M"].destination_zone) == ("Return", "FSWAN", "4PL")
    assert owner["M"].aging_return == 12 and owner["A"].aging_return is None
    assert owner["Q"].operator == "trip" and owner["O"].operator == "lead"
    assert owner["T"].unsucessful_log_hub == "SOCE" and owner["S"].unsucessful_log_hub is None


def test_a_district_listed_twice_repeats_the_row(spark):
    t = make(
        spark,
        tracking=stuck_log("A"),
        station=STATIONS,
        status_src=NAMES,
        fleet_order_dwd=[{"shipment_id": "A", "station_id": 1}],
        region_index=[
            {"district_code": "PHIT", "gbkk_upc_ops_region": "GBKK"}, {"district_code": "PHIT", "gbkk_upc_ops_region": None},
        ],
    )
    got = plans.stuck_shipments(spark, t, AS_OF)
    assert sorted(rows(got, "shipment_id", "destination_zone")) == [("A", "4PL"), ("A", "GBKK")]


def pickup_tables(spark):
    good = dict(user_id=9, operator="driver", station_id=3)
    return make(
        spark,
        station_raw=[{"id": 3, "station_name": "S"}],
        tracking=[
            event("A", 39, "2024-01-30 23:59:59", **good), event("A", 8, "2024-01-31 08:00", station_id=242),
            event("B", 13, "2024-01-30 08:00", **good), event("B", 8, "2024-01-31 08:00", station_id=71),
            event("C", 39, "2024-01-30 08:00", **good), event("C", 42, "2024-01-30 09:00"),
            event("D", 39, "2023-12-31 23:59:59", **good), event("D", 39, "2024-01-30 08:00", **good),
            event("E", 39, "2024-01-01 00:00", **good),
            event("F", 39, "2024-01-30 08:00", user_id=9, station_id=3),
            event("G", 39, "2024-01-30 08:00", user_id=9, operator="driver", station_id=4),
            event("H", 39, "2024-01-31 00:00", **good),
        ],
        fleet_order=[{"shipment_id": s, "cogs": 1.0} for s in "ABCDEFGH"],
        pickup_alloc=[
            {"pickup_order_id": "A", "pickup_task_id": "old", "pickup_point_id": 1, "allocated_time": 1},
            {"pickup_order_id": "A", "pickup_task_id": "", "pickup_point_id": 5, "allocated_time": 2},
            {"pickup_order_id": "B", "pickup_task_id": "T", "pickup_point_id": 5, "allocated_time": 2},
        ],
        seller_info=[
            {"shipment_id": "B", "shop_id": 1, "seller_name": "x"}, {"shipment_id": "B", "shop_id": 2, "seller_name": "y"},
        ],
    )


def test_direct_pickups(spark):
    t = pickup_tables(spark)
    assert rows(plans.direct_pickup_summary(spark, t, AS_OF)) == [
        (date(2024, 1, 30), 9, 5, 3, 1, 2, 1), (date(2024, 1, 1), 9, None, 1, 0, 1, 0),
    ]
    assert rows(plans.direct_pickup_summary(spark, t, AS_OF, seller_is_unique=True))[0] == (
        date(2024, 1, 30), 9, 5, 2, 1, 1, 1,
    )
    detail = plans.sortation_not_received(spark, t, AS_OF)
    assert len(detail.columns) == 12
    assert sorted(rows(detail, "shipment_id", "shop_id", "is_soc_rec", "is_no_pu_task"), key=str) == [
        ("A", None, 1, 1), ("B", 1, 0, 0), ("B", 2, 0, 0), ("E", None, 0, 0),
    ]


def test_leadtime_by_function(spark):
    t = make(
        spark,
        station=STATIONS,
        status_src=NAMES,
        tracking=[
            event("A", 0, "2024-01-01 00:00", station_id=1),  # left out
            event("A", 39, "2024-01-01 00:00", station_id=2),
            event("A", 47, "2024-01-01 02:30", station_id=2),
            event("A", 48, "2024-01-01 07:00", station_id=3),
            event("A", 58, "2024-01-01 10:00", content='{"station_id": 71}'),  # no station: the one before
            event("B", 8, "2024-01-01 00:00", content='{"station_id": 1, "station_name": "Kerry"}'),
            event("B", 81, "2024-01-02 01:00", station_id=1),
            event("C", 8, "2024-01-01 00:00", station_id=1),
        ],
        shipment_info=[
            {"shipment_id": "A", "order_type_id": "12", "delivered_sla_timestamp": datetime(2024, 1, 5, 9)},
        ],
    )
    got = {r.shipment_id: r for r in plans.leadtime_by_function(spark, t, ["A", "B"], datetime(2024, 1, 2, 9, 59)).collect()}
    assert set(got) == {"A", "B"}
    a = got["A"]
    assert (a.sla_date, a.order_type, a.leadtime_fwd, a.leadtime_fm_fwd, a.leadtime_lh_fwd) == (
        date(2024, 1, 5), "NS", 9, 2, 4,
    )
    # At the sort centre for 3 hours, and 23 whole hours until now on the way back.
    assert (a.leadtime_soc_fwd, a.leadtime_rtn, a.leadtime_soc_rtn, a.leadtime_rc_rtn) == (3, 23, 23, None)
    b = got["B"]
    assert (b.leadtime_fwd, b.leadtime_4pl_fwd, b.leadtime_lm_fwd, b.leadtime_rtn) == (25, 25, None, None)
    assert len(a) == 21


def test_partner_leadtime(spark):
    station = JSON % (77, "x")
    t = make(
        spark,
        station=STATIONS,
        tracking=[
            event("A", 18, "2024-01-01 00:00", content=station), event("A", 89, "2024-01-02 01:59:59"),
            event("A", 81, "2024-01-02 03:59:59"),
            event("B", 18, "2024-01-01 00:00", content=station), event("B", 89, "2024-01-01 02:00:00"),
            event("B", 81, "2024-01-01 05:01:00"),
            event("C", 18, "2024-01-01 00:00", content=station), event("C", 89, "2024-01-01 02:00:00"),
            event("D", 18, "2024-01-01 00:00", content=JSON % (71, "x")), event("D", 89, "2024-01-01 02:00:00"),
            event("D", 81, "2024-01-01 05:00:00"),
            event("E", 18, "2024-01-01 00:00", content=station), event("E", 89, "2024-01-31 02:00:00"),
            event("E", 81, "2024-01-31 05:00:00"),
        ],
    )
    assert rows(plans.partner_leadtime_summary(spark, t, AS_OF)) == [
        # (120 + 181) / 2 minutes, rounded half up; (27 h 59 min 59 s + 5 h 1 min) / 2.
        (date(2024, 1, 1), "NERC-A", 2, Decimal(151), Decimal(990), timedelta(minutes=150, seconds=30),
         timedelta(hours=16, minutes=30, seconds=29, milliseconds=500)),
    ]


def test_return_performance(spark):
    here = dict(station_id=3, operator="op")
    t = make(
        spark,
        station=STATIONS,
        tracking=[
            # SCOM, on time; returning exactly at the deadline.
            event("A", 58, "2024-01-10 06:00", **here), event("A", 63, "2024-01-11 11:00", **here),
            # SCOM, late receipt (03:00 next morning), never sent out, lost in the end.
            event("B", 58, "2024-01-11 03:00", **here), event("B", 11, "2024-01-12 03:00"),
            # GBKK: packed one second late, left late.
            event("C", 58, "2024-01-10 07:00", **here), event("C", 62, "2024-01-11 06:00:01", **here),
            event("C", 64, "2024-01-11 12:00:01", **here),
            # UPC: nothing outbound.
            event("D", 58, "2024-01-10 07:00", **here),
            # No master.
            event("E", 58, "2024-01-10 07:00", **here),
            # Not counted: other station, excluded operator, outside the window.
            event("F", 58, "2024-01-10 07:00", station_id=4, operator="op"),
            event("G", 58, "2024-01-10 07:00", station_id=3, operator="robot"),
            event("H", 58, "2024-01-31 06:00", **here),
        ],
        fleet_order_dwd=[
            {"shipment_id": "A", "order_type": 0}, {"shipment_id": "B", "order_type": 1},
            {"shipment_id": "C", "order_type": 5, "return_station_id": 1},
            {"shipment_id": "D", "order_type": 5, "return_station_id": 2},
        ],
        region_index=[{"district_code": "PHIT", "gbkk_upc_ops_region": "GBKK"}],
    )
    got = plans.return_performance(spark, t, AS_OF, excluded_operators=("robot",))
    by_type = {r.order_type: tuple(r)[2:] for r in got.collect()}
    assert by_type.pop("SCOM") == (2, 1, 0.5, 0.5, 1.0, 0.5, 1.0, 1.0, None, 1.0)
    assert by_type.pop("GBKK") == (1, 1, 1.0, 0.0, 1.0, 1.0, 0.0, 0.0, 1.0, 0.0)
    upc = by_type.pop("UPC")
    assert upc[:6] == (1, 1, 1.0, 0.0, 0.0, 0.0) and upc[6] != upc[6] and upc[7:] == (0.0, 0.0, 0.0)
    assert by_type == {None: (1, 1, *[None] * 8)}


def path_log(shipment, pickup=71, delivery=77):
    return [
        event(shipment, 8, "2024-01-20 08:00", station_id=pickup),
        event(shipment, 35, "2024-01-20 09:00", station_id=pickup, content=JSON % (1, "x")),
        event(shipment, 15, "2024-01-20 10:00", station_id=pickup),
        event(shipment, 36, "2024-01-20 13:00", station_id=pickup),
        event(shipment, 8, "2024-01-20 14:00", station_id=3),
        event(shipment, 35, "2024-01-20 15:00", station_id=3, content='{"linehaul_task_id": "LT2"}'),
        event(shipment, 15, "2024-01-20 16:00", station_id=242),
        event(shipment, 8, "2024-01-21 08:00", station_id=delivery),
    ]


def path_tables(spark, **more):
    return make(
        spark,
        station_raw=[{"id": s["station_id"], "station_name": s["station_name"]} for s in STATIONS],
        fleet_order=[{"shipment_id": s} for s in "ABC"],
        linehaul_task=[{"task_number": "LT1", "driver_id": 1}],
        driver=[{"driver_id": 1, "driver_name": "Somchai"}],
        **more,
    )


def test_linehaul_paths(spark):
    early = [e for e in path_log("C") if e["station_id"] != 77]
    t = path_tables(spark, tracking=[*path_log("A"), *path_log("B", 71, 71), *early])
    got = plans.linehaul_path_performance(spark, t, AS_OF)
    assert len(got.columns) == 20
    assert rows(got)[0] == (
        date(2024, 1, 20), "A", "CERC-SOC-NERCA", "CERC", "LT1", "Somchai", "SOCE", "LT2", None, "NERC-A", 1, 1, 1, 1,
        datetime(2024, 1, 20, 8), datetime(2024, 1, 20, 10), datetime(2024, 1, 20, 13), datetime(2024, 1, 20, 14),
        datetime(2024, 1, 20, 16), 3,
    )
    assert got.count() == 1


def test_tied_addresses_repeat_a_path(spark):
    t = path_tables(
        spark,
        tracking=path_log("A"),
        pickup_order=[
            {"pickup_order_id": "A", "ctime": 5, "seller_addr_state": "P1", "seller_addr_district": "D1"},
            {"pickup_order_id": "A", "ctime": 5, "seller_addr_state": "P2", "seller_addr_district": "D2"},
            {"pickup_order_id": "A", "ctime": 4, "seller_addr_state": "P3"},
        ],
        dropoff_order=[{"shipment_id": "B", "seller_state": "P9", "seller_city": "C9"}],
    )
    assert plans.linehaul_path_performance(spark, t, AS_OF).count() == 1
    assert plans.linehaul_path_performance(spark, t, AS_OF, with_addresses=True).count() == 2
    assert sorted(rows(seller_address(t)), key=str) == [
        ("A", "P1", "D1"), ("A", "P2", "D2"), ("B", "P9", "C9"), ("C", None, None),
    ]


def test_long_path_orders(spark):
    t = make(
        spark,
        station=STATIONS,
        status_src=NAMES,
        tracking=[
            event("A", 18, "2024-01-19 09:00", operator="op", content=JSON % (71, "x")),
            event("A", 8, "2024-01-20 00:00", station_id=71), event("A", 15, "2024-01-22 00:00"),
            event("B", 8, "2024-01-20 23:59:59", station_id=77), event("B", 18, "2024-01-21 09:00", content=JSON % (71, "x")),
            event("C", 8, "2024-01-19 23:59:59", station_id=71), event("C", 8, "2024-01-20 08:00", station_id=71),
            event("D", 8, "2024-01-20 08:00", station_id=3),
            event("E", 8, "2024-01-20 08:00", station_id=71),
        ],
        fleet_order=[{"shipment_id": s, "station_id": i} for s, i in [("A", 1), ("B", 7), ("C", 1), ("D", 1)]],
        shipment_info=[{"shipment_id": "B", "buyer_region_name": "South"}],
    )
    got = plans.long_path_orders(spark, t, date(2024, 1, 20))
    assert sorted(rows(got), key=str) == [
        (date(2024, 1, 20), "A", "CERC", "NORC-A", "SOC_LHTransporting", datetime(2024, 1, 19, 9), "op"),
        (date(2024, 1, 20), "B", "NERC-A", "South", None, None, None),
    ]


def test_backlog_places_and_counts(spark):
    t = make(
        spark,
        station=STATIONS,
        status_src=[{"status": s, "status_name": "x"} for s in (39, 15, 2, 64, 1, 8)],
        tracking=[
            event("PA", 39, "2024-01-30 08:00", station_id=2),  # FSWAN: no H station of that name
            event("PB", 15, "2024-01-30 08:00", station_id=3, content=JSON % (3, "1")),  # destination given as id
            event("PC", 15, "2024-01-30 08:00", station_id=3, content=JSON % (3, "HPHIT-A - Town")),
            event("PD", 1, "2023-06-01 08:00", station_id=1), event("PD", 2, "2024-01-30 08:00", station_id=3),
            event("PE", 64, "2024-01-30 08:00", content=JSON % (3, "FSATH- สาทร")),
            event("PF", 39, "2023-12-16 23:59:59", station_id=1),  # too old
            event("PG", 39, "2024-01-30 08:00", station_id=1), event("PG", 8, "2024-01-31 23:59:59", station_id=1),
            event("PH", 39, "2024-01-30 08:00", station_id=1), event("PH", 8, "2024-02-01 00:00", station_id=1),
            event("XX", 39, "2024-01-30 08:00", station_id=1),  # other id prefix
            event("PI", 39, "2024-01-30 08:00", station_id=3),
        ],
    )
    got = plans.hub_live_backlog(spark, t, AS_OF, settings=Settings(id_prefix="P"))
    assert len(got.columns) == 24
    assert sorted(
        rows(got, "Hub Name", "FM Module Forward Incoming", "LM Module Forward Incoming", "LM Module Forward Processing",
             "LM Module Return Total", "All Total")
    ) == [("HPHIT-A", 1, 2, 1, 0, 4), ("HSATH", 0, 0, 0, 1, 1), ("HSWAN-A", 1, 0, 0, 0, 1)]


def test_overseas(spark):
    t = make(
        spark,
        tracking=[
            event("A", 8, "2024-01-13 06:00", content=JSON % (3, "x")), event("A", 36, "2024-01-14 05:59", content=JSON % (1, "SIP-LMHub")),
            event("A", 36, "2024-01-15 06:00", content=JSON % (1, "SIP-LMHub")), event("A", 36, "2024-01-15 06:00", content=JSON % (1, "y")),
            event("B", 8, "2024-01-13 05:59:59", content=JSON % (3, "x")), event("B", 36, "2024-01-14 08:00", content=JSON % (1, "SIP-LMHub")),
            event("C", 8, "2024-01-14 08:00", content=JSON % (71, "x")), event("C", 36, "2024-01-14 08:00", content=JSON % (1, "SIP-LMHub")),
        ],
    )
    got = plans.overseas_hub_performance(spark, t, AS_OF)
    assert sorted(rows(got, "shipment_id", "channel", "received_date", "lhtransported_date", "week_num")) == [
        ("A", "HOME", date(2024, 1, 13), date(2024, 1, 13), 3), ("A", "HOME", date(2024, 1, 13), date(2024, 1, 15), 3),
    ]


def test_first_touch(spark):
    t = make(
        spark,
        station=STATIONS,
        status_src=NAMES,
        tracking=[
            event("A", 39, "2024-01-30 05:00", station_id=2, operator="a"), event("A", 8, "2024-01-30 06:00", station_id=3, operator="a"),
            event("B", 8, "2024-01-30 05:59:59", station_id=3, operator="a"), event("B", 8, "2024-01-30 08:00", station_id=3, operator="a"),
            event("C", 8, "2024-01-31 05:59:59", station_id=3, operator="b"),
            event("D", 8, "2024-01-31 05:59:59", station_id=3, operator="c"),
            event("E", 8, "2024-01-31 06:00", station_id=3, operator="a"),
        ],
    )
    got = plans.first_touch_by_operator(spark, t, AS_OF, ["a", "b"])
    assert sorted(rows(got)) == [
        ("A", "SOC_Received", "a", datetime(2024, 1, 30, 6), date(2024, 1, 30), "Sorting center"),
        ("C", "SOC_Received", "b", datetime(2024, 1, 31, 5, 59, 59), date(2024, 1, 30), "Sorting center"),
    ]


def test_trackers(spark):
    t = make(
        spark,
        station=STATIONS,
        status_src=NAMES,
        tracking=[
            event("A", 47, "2024-01-01 00:00", content=JSON % (2, "x")),
            event("A", 8, "2024-01-02 00:00", station_id=3, operator="Flash", content=JSON % (71, "x")),
            event("B", 8, "2024-01-02 00:00", station_id=3),
            event("C", 8, "2024-01-02 00:00", station_id=3),
        ],
        fleet_order_dwd=[{"shipment_id": "A", "station_id": 1, "return_station_id": 2, "cogs": 2.5}],
        shipment_info=[
            {"shipment_id": "A", "order_type_id": "2", "is_bulky": True, "buyer_name": "N", "seller_shop_id": 4, "cogs_amount": 2.5}
        ],
    )
    got = plans.shipment_tracker(spark, t, ["A", "B"])
    assert sorted(rows(got), key=str) == [
        ("A", "SOC_Received", "Sorting center", "Flash", "2", datetime(2024, 1, 2), 3, "Flash", "FSWAN - Town", "LT1", "TO1"),
        ("B", "SOC_Received", "Sorting center", None, None, datetime(2024, 1, 2), *[None] * 5),
    ]
    contacts = plans.shipment_tracker_contacts(spark, t, ["A", "B"])
    assert sorted(rows(contacts), key=str) == [
        ("A", "BKY", "SOC_Received", "CERC", datetime(2024, 1, 2), 2.5, "N", None, None, 4, None),
        ("B", "MKP", "SOC_Received", None, datetime(2024, 1, 2), *[None] * 6),
    ]


def test_a_value_that_is_no_station_number_raises_in_the_contact_sheet(spark):
    t = make(
        spark, station=STATIONS, tracking=[event("A", 8, "2024-01-01 00:00", content='{"station_id": "x"}')]
    )
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        plans.shipment_tracker_contacts(spark, t, ["A"]).collect()
