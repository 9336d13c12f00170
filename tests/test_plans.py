"""What the physical plans look like on stored tables."""

import re
from datetime import date, datetime

import pytest

from pyspark.sql import functions as F

from parcelspark import Tables, plans
from parcelspark.functions.jsontext import json_text
from parcelspark.operators import events as E
from parcelspark.operators.lookup import as_keys
from parcelspark.sources.tables import PartitionClock
from tests.fixtures import SCHEMAS, event, frame, make
from tests.test_reports import NAMES, STATIONS

AS_OF = date(2024, 1, 31)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    made = make(
        spark,
        station=STATIONS,
        status_src=NAMES,
        tracking=[event("A", s, f"2024-01-{d:02d} 08:00", station_id=3) for d, s in enumerate((0, 39, 8, 15, 36, 58, 11), 1)],
    )
    for name in SCHEMAS:
        made[name].write.parquet(f"{root}/{name}")
    return Tables.from_parquet(spark, root)


REPORTS = {
    "loss": lambda s, t: plans.loss_damage_attribution(s, t, AS_OF),
    "stuck": lambda s, t: plans.stuck_shipments(s, t, AS_OF),
    "direct": lambda s, t: plans.direct_pickup_summary(s, t, AS_OF),
    "leadtime": lambda s, t: plans.leadtime_by_function(s, t, ["A"], datetime(2024, 1, 31)),
    "trip": lambda s, t: plans.latest_linehaul_and_sack(s, t, ["A"]),
    "path": lambda s, t: plans.linehaul_path_performance(s, t, AS_OF),
    "backlog": lambda s, t: plans.hub_live_backlog(s, t, AS_OF),
    "long": lambda s, t: plans.long_path_orders(s, t, date(2024, 1, 3)),
    "overseas": lambda s, t: plans.overseas_hub_performance(s, t, AS_OF),
    "sortation": lambda s, t: plans.sortation_not_received(s, t, AS_OF),
    "touch": lambda s, t: plans.first_touch_by_operator(s, t, AS_OF, ["op"]),
    "dates": lambda s, t: plans.created_and_pickup_dates(s, t, ["A"]),
    "partner": lambda s, t: plans.partner_leadtime_summary(s, t, AS_OF),
    "returns": lambda s, t: plans.return_performance(s, t, AS_OF),
    "tracker": lambda s, t: plans.shipment_tracker(s, t, ["A"]),
    "contacts": lambda s, t: plans.shipment_tracker_contacts(s, t, ["A"]),
}
ONE_SCAN = ("trip", "path", "tracker", "contacts")


def physical(df, filters: int = 100) -> str:
    """The plan as text; `filters`: how much of a scan's pushed filters is spelt out."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", filters)
    return df._jdf.queryExecution().executedPlan().toString()


def log_scans(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan parquet" in line and "/tracking]" in line]


@pytest.mark.parametrize("name", REPORTS)
def test_no_python_and_no_pairing_of_all_rows(spark, stored, name):
    plan = physical(REPORTS[name](spark, stored))
    assert not re.search(r"Python|Pandas|Arrow", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ONE_SCAN)
def test_the_log_is_read_once(spark, stored, name):
    assert len(log_scans(physical(REPORTS[name](spark, stored)))) == 1


def test_the_window_reaches_the_wide_scan_and_the_look_back_is_narrow(spark, stored):
    log = stored["tracking"].filter("status = 8")
    found = E.first_event_in_window(log, 1000, 2000, ("ctime", "operator", "content"))
    wide, narrow = log_scans(physical(found, 1000))
    assert "GreaterThanOrEqual(ctime,1000)" in wide and "LessThan(ctime,2000)" in wide
    assert "ReadSchema: struct<shipment_id:string,status:int,ctime:bigint>" in narrow
    touch = log_scans(physical(REPORTS["touch"](spark, stored), 1000))
    assert any("GreaterThanOrEqual(ctime," in s for s in touch)
    narrow = [s for s in touch if "GreaterThanOrEqual(ctime," not in s]
    assert narrow and all("operator" not in s.split("ReadSchema")[1] for s in narrow)


@pytest.mark.parametrize("name", ["direct", "overseas", "partner", "returns", "sortation", "touch"])
def test_the_look_back_drops_other_keys_before_it_moves_any(spark, stored, name):
    """Earlier rows meet the broadcast hashes of the candidates below the distinct, in the task that reads them."""
    plan = REPORTS[name](spark, stored)._jdf.queryExecution().optimizedPlan().toString()
    look_back = [part for part in plan.split("Join LeftAnti")[1:]]
    assert look_back
    distinct = look_back[0].index("Aggregate [_earlier")
    assert look_back[0].index("Join LeftSemi, (xxhash64(", distinct) > distinct


BUILD_JOBS = {"stuck": 7, "returns": 7, "backlog": 7, "direct": 7, "sortation": 7, "partner": 7, "overseas": 7, "leadtime": 8, "loss": 11, "long": 11}


@pytest.mark.parametrize("name", BUILD_JOBS)
def test_few_jobs_run_while_a_report_is_built(spark, stored, name):
    stored.release()
    for table in stored:
        stored[table]
    group = f"build-{name}"
    spark.sparkContext.setJobGroup(group, name)
    try:
        REPORTS[name](spark, stored)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= BUILD_JOBS[name]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_listed_keys_filter_the_log_before_it_is_reduced(spark, stored):
    """In each of the three ways no shipment is reduced that is not asked for, but for chance matches of a hash."""
    log = stored["tracking"]
    for limits in ({}, {"max_rows": 1}, {"max_rows": 1, "max_hash_bytes": 0}):
        keys = as_keys(spark, ["A", "B"], **limits)
        plan = E.latest_event(log, cols=("status",), only=keys)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.rindex("Join LeftSemi") > plan.index("Aggregate")


def test_losses_read_the_log_for_their_shipments_once(spark, stored):
    plan = physical(REPORTS["loss"](spark, stored), 1000)
    with_operator = {s.split("FileScan")[1] for s in log_scans(plan) if "operator" in s.split("ReadSchema")[1]}
    assert len(with_operator) == 1 and "Window" not in plan


def test_windows_name_their_partitions(spark, stored, tmp_path):
    """With a clock stated, windows prune partitions, and the rows are the same."""
    rows = [event(f"S{i % 9}", s, f"2024-01-{1 + i % 30:02d} {i % 24:02d}:30", station_id=(3, 71, 77)[i % 3], operator="op", user_id=i, event_id=i)
            for i, s in enumerate((8, 15, 36, 39, 58, 11, 62, 63, 89, 81) * 30)]
    made = make(spark, station=STATIONS, status_src=NAMES, tracking=rows, fleet_order=[{"shipment_id": f"S{i}", "cogs": 1.0} for i in range(9)])
    plain = {n: made[n] for n in SCHEMAS}
    seconds = F.timestamp_add("SECOND", F.col("ctime"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    for kind in ("date", "string", "int"):
        day = {"date": seconds.cast("date"), "string": seconds.cast("date").cast("string"),
               "int": F.date_format(seconds, "yyyyMMdd").cast("int")}[kind]
        path = f"{tmp_path}/{kind}"
        plain["tracking"].withColumn("day", day).write.partitionBy("day").parquet(path)
        schema = f"{SCHEMAS['tracking']}, day {kind}"
        log = spark.read.schema(schema).parquet(path)
        clocked = Tables({**plain, "tracking": log}, clocks={"tracking": PartitionClock("day")})
        unclocked = Tables({**plain, "tracking": log})
        for name in ("direct", "backlog", "returns", "loss", "stuck", "touch", "partner", "overseas"):
            with_clock, without = (REPORTS[name](spark, t) for t in (clocked, unclocked))
            plan = physical(with_clock, 1000)
            filters = [s.split("PartitionFilters: [")[1].split("]")[0] for s in plan.splitlines() if "FileScan parquet" in s and f"/{kind}]" in s]
            assert any("day" in f for f in filters), name
            assert sorted(map(str, with_clock.collect())) == sorted(map(str, without.collect())), name
    with pytest.raises(ValueError, match="lacks columns \\['day'\\]"):
        Tables(plain, clocks={"tracking": PartitionClock("day")})["tracking"]


def test_a_clock_allows_for_its_slack():
    clock = PartitionClock("day", offset_seconds=3600, slack_days=1)
    assert "2024-01-01" in str(clock.since(1704150000, "string")) and "2024-01-03" in str(clock.until(1704150001, "string"))


def test_fields_beside_the_json_text_are_read_instead(spark, tmp_path):
    """The overseas report reads no JSON text where its fields have columns, and gives the same rows."""
    rows = [event(f"S{i % 7}", (8, 48, 36)[i % 3], f"2024-01-{10 + i % 20:02d} 08:00", event_id=i,
                  content='{"station_id": %d, "dest_station_name": "%s"}' % ((3, 5)[i % 2], ("SIP-LMHub", "x")[i % 4 == 0]))
            for i in range(200)] + [event("S1", 8, "2024-01-02 00:00", content="{broken"), event("S2", 8, "2024-01-02 00:00")]
    made = make(spark, tracking=rows)
    typed = made["tracking"].withColumns({"c_station": json_text("content", "station_id"), "c_dest": json_text("content", "dest_station_name")})
    typed.write.parquet(f"{tmp_path}/tracking")
    log = spark.read.parquet(f"{tmp_path}/tracking")
    with_fields = Tables({"tracking": log}, fields={"tracking": {"station_id": "c_station", "dest_station_name": "c_dest"}})
    without = Tables({"tracking": log})
    found, plain = (plans.overseas_hub_performance(spark, t, AS_OF) for t in (with_fields, without))
    assert found.count() and sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    assert "content" not in physical(found, 1000) and "content" in physical(plain, 1000)


def test_lead_times_move_no_json_text(spark, stored):
    plan = physical(REPORTS["leadtime"](spark, stored))
    assert all("content" not in line for line in plan.split("InMemoryTableScan")[0].splitlines() if "Exchange" in line)


def test_filters_reach_the_scan(spark, stored):
    (trip,) = log_scans(physical(REPORTS["trip"](spark, stored)))
    assert "In(status, [15,211,233,35,46,47,55,56,62,64])" in trip
    assert "station_id" not in trip.split("ReadSchema")[1]
    (path,) = log_scans(physical(REPORTS["path"](spark, stored)))
    assert "GreaterThanOrEqual(ctime," in path and "In(station_id," in path
    for scan in log_scans(physical(REPORTS["stuck"](spark, stored))):
        assert "GreaterThanOrEqual(ctime," in scan or "In(status," in scan
    attempts = [s for s in log_scans(physical(REPORTS["backlog"](spark, stored))) if "In(status, [1,10,67])" in s]
    assert attempts and all("content" not in s.split("ReadSchema")[1] for s in attempts)


def test_picks_are_reduced_before_the_shuffle(spark, stored):
    log = stored["tracking"]
    for df in (E.latest_event(log, cols=("status",)), E.milestones(log, {"f": E.first(None, "status")})):
        plan = physical(df)
        assert plan.count("Exchange") == 1
        assert re.search(r"Aggregate.*\n.*Sort.*\n.*Exchange.*\n.*partial_", plan) or "partial_" in plan.split("Exchange")[1]
    ties = physical(E.latest_version(log, "shipment_id", "ctime"))
    assert "WindowGroupLimit" in ties.split("Exchange")[1]


def test_neighbours_take_one_shuffle_when_no_key_is_large(spark, stored):
    df = E.neighbours(stored["tracking"], before=("status",), after=("ctime",))
    assert physical(df).count("Exchange") == 1


def test_a_hot_key_is_spread_over_tasks(spark):
    """Four of five rows belong to one key: after slicing no task holds more than a part of them."""
    rows = [event("hot" if i % 5 else f"s{i}", 8, f"2024-01-{1 + i % 28:02d} {i % 24:02d}:00", event_id=i) for i in range(2000)]
    df = frame(spark, SCHEMAS["tracking"], rows)
    plan = physical(E.neighbours(df, before=("status",), max_rows_per_key=100))
    assert re.search(r"hashpartitioning\(shipment_id#\d+, _slice#\d+L", plan)


def test_missing_tables_and_columns_are_named(spark):
    with pytest.raises(KeyError, match="no source table 'tracking'"):
        Tables({})["tracking"]
    with pytest.raises(ValueError, match="lacks columns \\['user_id', 'content'\\]"):
        Tables({"tracking": frame(spark, SCHEMAS["tracking"], []).drop("user_id", "content")})["tracking"]
