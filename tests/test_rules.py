import pytest
from pyspark.sql import functions as F

from parcelspark import fixed_values as V
from parcelspark.operators import lookup as L, metrics as M, rules as R
from parcelspark.operators.dims import hub_regions, regional_pairs
from parcelspark.operators.routes import route_rules, route_sla

# (status before the loss, station, dropped off by the seller) -> team
TEAMS = [
    ("3PL_Received", "SOCE", None, "4PL"),
    ("SP_Received", None, None, "SP"),
    ("DOP_Received", None, None, "SP"),
    ("Auto_to_Pending_Drop_off", None, None, "SP"),
    ("FMHub_Received", None, None, "CTO"),
    ("Return_FMHub_Received", None, None, "CTO"),
    ("LMHub_Received", None, None, "CTO"),
    ("Return_LMHub_Received", None, None, "CTO"),
    ("Exception_Found", None, None, "CTO"),
    ("Delivering", None, None, "CTO"),
    ("Onhold", None, None, "CTO"),
    ("SOC_Pickup_Done", "SOCE", None, "CTO"),
    ("SOC_Received", "SOCE", None, "MM"),
    ("SOC_Received", "Sorting center", None, "MM"),
    ("Return_SOC_Received", "SOCW", None, "MM"),
    ("Reallocate", "SOCE", None, "MM"),
    ("Created", None, None, "MM"),
    ("Return_SOC_LHTransporting", "CERC", None, "CTO/MM"),
    ("Return_SOC_LHTransported", None, None, "CTO/MM"),
    ("SOC_Pickup_Onhold", None, None, "SP/CTO"),
    ("SOC_Pickup_Failed", None, None, "SP/CTO"),
    ("Transporting_to_sp", None, None, "SP/CTO"),
    ("Transported_to_sp", None, None, "SP/CTO"),
    ("SOC_Received", "CERC", None, "CTO"),
    ("SOC_Packing", None, None, "CTO"),
    ("SOC_Packed", None, None, "CTO"),
    ("SOC_Handover", None, None, "CTO"),
    ("Reallocate", "CERC", None, "CTO"),
    ("SOC_Pickup_Handedover", None, True, "SP/CTO"),
    ("SOC_Pickup_Handedover", None, False, "CTO/MM"),
    ("SOC_Pickup_Handedover", None, None, None),
    ("Something", None, None, None),
    (None, "SOCE", True, None),
    # Rules further down that an earlier prefix hides.
    ("FMHub_LHTransporting", None, None, "CTO"),
    ("FMHub_LHTransported", None, None, "CTO"),
    ("Exception_LHTransporting", None, None, "CTO"),
    ("Return_LMHub_LHTransporting", None, None, "CTO"),
    ("LMHub_LHTransported", None, None, "CTO"),
    ("Return_FMHub_LHTransporting", None, None, "CTO"),
    ("FMHub_Pickup_Onhold", None, None, "CTO"),
    ("FMHub_PendingReceive", None, None, "CTO"),
    ("FMHub_Pickup_Handedover", None, True, "CTO"),
    ("FMHub_Pickup_Handedover", None, False, "CTO"),
    ("Return_SOC_LHTransporting", "SOCE", None, "MM"),
    ("SOC_Pickup_Onhold", "SOCE", None, "MM"),
    ("SOC_Pickup_Handedover", "SOCE", True, "MM"),
]


def test_every_team_rule(spark):
    df = spark.createDataFrame(
        [(i, s, st, d) for i, (s, st, d, _) in enumerate(TEAMS)], "i int, s string, st string, d boolean"
    )
    rows = df.select("i", R.responsible_team(F.col("s"), F.col("st"), F.col("d")).alias("t")).collect()
    got = {r.i: r.t for r in rows}
    assert [(TEAMS[i], got[i]) for i in got if got[i] != TEAMS[i][3]] == []


LEGS = [
    # status, next status, partner, hub, next station, named station -> function
    (8, 15, "Kerry", "HABCD", None, None, "4PL"),
    (47, 48, None, "HABCD", "FABCD", None, "LH"),
    (47, 8, None, "HABCD", "FABCD", None, "FM"),
    (47, None, None, "HABCD", "FABCD", None, "LM"),
    (47, 8, None, "HABCD", None, None, "LM"),
    (48, 8, None, "XABCD", "DABCD", None, "SDOP"),
    (8, 9, None, "HABCD", "FABCD", None, "LM"),
    (8, 9, None, "Partner 1", None, None, "PS"),
    (8, 9, None, "Brand 1", None, None, "PS"),
    (8, 9, None, "SOCE", None, None, "SOC"),
    (8, 9, None, "Sorting center", None, None, "SOC"),
    (8, 9, None, "CERC", None, None, "RC"),
    (8, 9, None, None, None, "NERC-A", "RC"),
    (8, 9, None, None, None, "Sorting center", "SOC"),
    (8, 9, None, "Elsewhere", None, "HABCD", None),
    (8, 9, None, None, None, None, None),
]


def test_function_of_leg(spark):
    df = spark.createDataFrame(
        [(i, *leg[:6]) for i, leg in enumerate(LEGS)],
        "i int, s int, n int, partner string, hub string, nxt string, named string",
    )
    c = F.col
    df = df.withColumns(R.stations_of_leg(c("s"), c("n"), c("hub"), c("nxt"), c("named")))
    got = {r.i: r.f for r in df.select("i", R.function_of_leg(c("partner"), "Brand").alias("f")).collect()}
    assert [(LEGS[i], f) for i, f in got.items() if f != LEGS[i][6]] == []


def test_order_types_differ_in_order_and_label(spark):
    flags = "is_warehouse boolean, is_cross_border boolean, is_marketplace boolean, is_bulky boolean, is_open_service boolean"
    rows = [
        (True, True, True, True, True), (False, True, True, True, True), (False, False, True, True, True),
        (False, False, False, True, True), (False, False, False, False, True), (None, None, None, None, None),
    ]
    got = spark.createDataFrame(rows, flags).select(R.type_by_flags_open(), R.type_by_flags_contact()).collect()
    assert [tuple(r) for r in got] == [
        ("WH", "WH"), ("CB", "CB"), ("MKP", "OSV"), ("BKY", "OSV"), ("NS", "OSV"), ("MKP", "MKP"),
    ]


def test_first_match_wins_and_null_does_not_match(spark):
    x = F.col("id")
    rule = R.apply_rules([(F.lit(None).cast("boolean"), "null"), (x < 2, "low"), (x < 3, "mid")], "high")
    assert [r.v for r in spark.range(4).select(rule.alias("v")).collect()] == ["low", "low", "mid", "high"]


def test_hub_regions(spark):
    rows = hub_regions(spark).collect()
    assert len(rows) == len({r.code for r in rows}) == 132
    assert {r.code: r.region for r in hub_regions(spark, "F").collect()}["FTONG"] == "CERC"


def test_every_route_once(spark):
    rows = route_rules(spark).collect()
    assert len(rows) == len({r.lh_route for r in rows}) == len(regional_pairs()) == 31
    assert not any(r.pickup == "SORC-A" for r in rows)
    limits = {r.lh_route: r for r in rows}
    row = limits["NERCB-SOC-NORCA"]
    assert (row.depart_hours, row.arrive_hours, row.travel_hours, row.onward_hours) == (-5, -11, 8, -17)
    row = limits["NERCB-SOC-CERC"]
    assert (row.depart_hours, row.arrive_hours, row.travel_hours, row.onward_hours) == (-5, -10, 5, -18)
    assert limits["NORCB-SOC-CERC"].onward_hours == 18
    assert limits["SORCB-SOC-NERCA"].depart_hours == 5


@pytest.mark.parametrize(
    "pickup, delivery, times, flags",
    [
        # received, departed, arrived, sort received, sort departed
        ("CERC", "NERC-A", ("01 10:00", "02 04:59", "02 08:59", "02 10:00", "03 16:59"), (1, 1, 1, 1)),
        ("CERC", "NERC-A", ("01 10:00", "02 05:00", "02 10:00", "02 10:00", "03 17:00"), (0, 0, 0, 0)),
        ("NORC-B", "CERC", ("01 10:00", "01 21:59", "02 09:59", "02 10:00", "02 05:59"), (1, 1, 1, 1)),
        ("NORC-B", "CERC", ("01 10:00", "01 22:00", "02 11:00", "02 10:00", "02 06:00"), (0, 0, 0, 0)),
        ("CERC", "NERC-A", ("01 10:00", None, None, "02 10:00", None), (0, 0, 0, 0)),
        ("CERC", "CERC", ("01 10:00", "01 11:00", "01 12:00", "02 10:00", "02 11:00"), None),
        (None, "CERC", ("01 10:00", "01 11:00", "01 12:00", "02 10:00", "02 11:00"), None),
    ],
)
def test_route_flags(spark, pickup, delivery, times, flags):
    names = ("xrc_received_time", "min_xrc_lh_transporting_time", "min_xrc_lh_transported_time", "min_soc_received",
             "min_soc_lh_transporting")
    ts = lambda t: F.lit(t and f"2024-01-{t}:00").cast("timestamp_ntz")
    df = spark.range(1).select(
        F.lit(pickup).cast("string").alias("pickup_rc_station"),
        F.lit(delivery).alias("delivery_rc_station"),
        *[ts(t).alias(n) for t, n in zip(times, names)],
    )
    hours = F.timestamp_diff("HOUR", F.col(names[1]), F.col(names[2]))
    got = route_sla(df.withColumn("rc_to_soc_delivery_leadtime", hours), route_rules(spark)).select(
        "is_rc_transporting_ontime", "is_rc_transported_ontime", "rc_traveling_soc_leadtime_check",
        "is_soc_transporting_ontime",
    ).collect()
    assert [tuple(r) for r in got] == ([flags] if flags else [])


def test_ratio(spark):
    df = spark.createDataFrame([(1, 2), (0, 0), (3, 0)], "n long, d long")
    got = [r.v for r in df.select(M.ratio(F.col("n"), F.col("d")).alias("v")).collect()]
    assert got[0] == 0.5 and got[1] != got[1] and got[2] == float("inf")


def test_parts_add_up_and_empty_sums_are_null(spark):
    df = spark.range(10).withColumn("g", F.col("id") % 2)
    low = F.col("id") < 4
    row = M.pivot_counts(df, ["g"], {"low": low, "high": ~low, "none": F.lit(False)}).orderBy("g").collect()
    assert [tuple(r) for r in row] == [(0, 2, 3, 0), (1, 2, 3, 0)]
    sums = M.pivot_sums(df, ["g"], F.col("id"), {"none": F.lit(False), "all": F.lit(True)}).orderBy("g").collect()
    assert [tuple(r) for r in sums] == [(0, None, 20), (1, None, 25)]


def test_keys_present_absent_repeated_and_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "shipment_id string, v int")
    keys = L.as_keys(spark, ["a", "a", "z", None])
    assert sorted(r.v for r in L.keyed(df, keys).collect()) == [1, 2]
    assert L.keyed(df, L.as_keys(spark, [])).count() == 0


def test_beyond_the_bound_nothing_is_broadcast(spark):
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    keys = spark.range(100).selectExpr("CAST(id AS STRING) AS shipment_id")
    assert "strategy=broadcast" in plan(L.bounded_broadcast(keys, 100))
    assert "strategy=broadcast" not in plan(L.bounded_broadcast(keys, 99))


def test_backlog_columns_are_consistent():
    columns = V.BACKLOG_COLUMNS
    assert len(columns) == 23
    assert len(set(columns["All Total"])) == 43 == len(columns["All Total"])
    for part in ("FM Module Forward", "FM Module Return", "LM Module Forward", "LM Module Return"):
        pieces = [set(columns[f"{part} {p}"]) for p in ("Incoming", "Inbound", "Processing", "Outbound")]
        assert sum(map(len, pieces)) == len(set(columns[f"{part} Total"]))


def test_a_mean_interval_whose_sum_exceeds_64_bits(spark):
    took = spark.sql("SELECT id, timestamp_ntz'9999-12-31 00:00:00' - timestamp_ntz'0001-01-01 00:00:00' AS d FROM range(100)")
    assert took.agg(M.mean_interval(F.col("d"))).first()[0] == took.first().d


def test_a_mean_interval_is_that_of_avg(spark):
    micros = [(0, 0), (0, 1), (1, -1), (1, 0), (2, 86_400_000_001), (2, 5), (2, -8), (3, None), (4, 7), (4, None)]
    rows = spark.createDataFrame(micros, "k int, us long").withColumn("d", F.expr("make_dt_interval(0, 0, 0, us / 1000000.0)"))
    for d in (F.col("d"), F.expr("date_add(date'2024-01-01', k) - date'2023-12-30'")):
        found = rows.groupBy("k").agg(M.mean_interval(d).alias("mean"), F.avg(d).alias("avg"))
        assert found.schema["mean"].dataType == found.schema["avg"].dataType
        assert all(r.mean == r.avg for r in found.collect())
    assert rows.where("k > 9").agg(M.mean_interval(F.col("d"))).first()[0] is None
