from collections import defaultdict

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from parcelspark.operators import events as E
from parcelspark.operators.lookup import as_keys, key_list, keyed
from tests.fixtures import SCHEMAS, at, event, frame, make

STATUSES = (0, 8, 11, 39)


def log(spark, rows):
    return frame(spark, SCHEMAS["tracking"], rows)


logs = st.lists(
    st.tuples(st.sampled_from("abc"), st.sampled_from(STATUSES), st.one_of(st.none(), st.integers(0, 6))),
    min_size=1,
    max_size=40,
)


def as_rows(drawn):
    return [
        {"event_id": i, "shipment_id": s, "status": c, "ctime": t, "operator": f"op{i}", "station_id": i}
        for i, (s, c, t) in enumerate(drawn)
    ]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs)
def test_picks_equal_brute_force(spark, drawn):
    """Milestones, first_event and latest_event against sorting in Python; a NULL time comes last both ways."""
    rows = as_rows(drawn)
    by_key = defaultdict(list)
    for r in rows:
        by_key[r["shipment_id"]].append(r)
    df = log(spark, rows)
    got = {
        r.shipment_id: r
        for r in E.milestones(
            df,
            {
                "f": E.first(F.col("status") == 8, "operator", "ctime"),
                "l": E.last(None, "status", "event_id"),
                "t": E.last(F.col("status").isin(0, 39)),
            },
        ).collect()
    }
    firsts = {r.shipment_id: r.event_id for r in E.first_event(df, cols=("event_id",)).collect()}
    up = lambda r: (r["ctime"] is None, r["ctime"] or 0, r["event_id"])
    down = lambda r: (r["ctime"] is not None, r["ctime"] or 0, r["event_id"])
    for key, all_rows in by_key.items():
        eights = sorted((r for r in all_rows if r["status"] == 8), key=up)
        times = [r["ctime"] for r in all_rows if r["status"] in (0, 39) and r["ctime"] is not None]
        row = got[key]
        assert (row.f and row.f.operator) == (eights[0]["operator"] if eights else None)
        assert row.l.event_id == max(all_rows, key=down)["event_id"]
        assert (row.t and row.t.ctime) == (max(times) if times else None)
        assert firsts[key] == min(all_rows, key=up)["event_id"]


def test_a_null_key_is_cut_like_any_other(spark, monkeypatch):
    rows = as_rows([(None if i % 3 else "a", i % 5, 60 * i) for i in range(60)])
    df = log(spark, rows)
    w = Window.partitionBy("shipment_id").orderBy("ctime", "event_id")
    plain = df.select("event_id", F.lag("status").over(w).alias("status"))
    for listed in (1000, 1):
        monkeypatch.setattr(E, "MAX_LISTED_KEYS", listed)
        cut = E.neighbours(df, before=("status",), max_rows_per_key=4).select("event_id", "prev.status")
        assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs, st.integers(0, 3), st.integers(0, 4))
def test_first_event_in_window_equals_brute_force(spark, drawn, begin, length):
    rows = as_rows(drawn)
    want = set()
    for key in {r["shipment_id"] for r in rows}:
        timed = [r for r in rows if r["shipment_id"] == key and r["ctime"] is not None and r["status"] != 9]
        if timed:
            least = min(timed, key=lambda r: (r["ctime"], r["event_id"]))
            if begin <= least["ctime"] < begin + length:
                want.add((key, least["event_id"]))
    got = E.first_event_in_window(log(spark, rows), begin, begin + length, ("event_id",), F.col("status") != 9)
    assert {tuple(r) for r in got.collect()} == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs, st.one_of(st.none(), st.integers(1, 4)), st.integers(1, 5))
def test_neighbours_equal_plain_windows_however_they_are_cut(spark, drawn, slice_seconds, max_rows):
    df = log(spark, as_rows(drawn))
    w = Window.partitionBy("shipment_id").orderBy(F.col("ctime").asc_nulls_last(), "event_id")
    plain = df.select("event_id", F.lag("status").over(w).alias("status"), F.lead("operator").over(w).alias("operator"))
    cut = E.neighbours(
        df, before=("status",), after=("operator",), max_rows_per_key=max_rows, slice_seconds=slice_seconds
    ).select("event_id", "prev.status", "next.operator")
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))


def test_more_large_keys_than_are_listed(spark, monkeypatch):
    monkeypatch.setattr(E, "MAX_LISTED_KEYS", 1)
    rows = [event(s, i, f"2024-01-01 {i:02d}:00", event_id=n * 100 + i) for n, s in enumerate("abc") for i in range(12)]
    df = log(spark, rows)
    got = E.neighbours(df, before=("status",), max_rows_per_key=2, slice_seconds=7200)
    for r in got.select("status", F.col("prev.status").alias("p")).collect():
        assert r.p == (r.status - 1 if r.status else None)


def test_a_null_neighbour_value_is_not_a_missing_neighbour(spark):
    rows = [event("a", 0, "2024-01-01 00:00", operator="x", event_id=0), event("a", 8, "2024-01-01 05:00", event_id=1),
            event("a", 9, "2024-01-01 10:00", event_id=2)]
    got = E.neighbours(log(spark, rows), before=("operator",), max_rows_per_key=1, slice_seconds=3600)
    assert {r.status: (r.prev is None, r.prev and r.prev.operator) for r in got.collect()} == {
        0: (True, None), 8: (False, "x"), 9: (False, None),
    }


def test_filter_before_and_after_the_pick(spark):
    rows = [event("a", 8, "2024-01-01 00:00"), event("a", 11, "2024-01-02 00:00"), event("b", 8, "2024-01-01 00:00")]
    df = make(spark, tracking=rows)["tracking"]
    after = E.latest_event(df, cols=("status",), then=F.col("status") == 8)
    before = E.latest_event(df, cols=("status",), where=F.col("status") == 8)
    assert [r.shipment_id for r in after.collect()] == ["b"]
    assert sorted(r.shipment_id for r in before.collect()) == ["a", "b"]


def test_ties_are_broken_by_id_or_kept(spark):
    rows = [event("a", 8, "2024-01-01 00:00"), event("a", 9, "2024-01-01 00:00")]
    df = make(spark, tracking=rows)["tracking"]
    assert E.first_event(df, cols=("status",)).first().status == 8
    assert E.latest_event(df, cols=("status",)).first().status == 9
    assert E.latest_version(df, "shipment_id", "ctime").count() == 2


def test_a_log_without_ids_gets_repeatable_ones(spark):
    df = log(spark, as_rows([("a", 8, 1), ("a", 9, 1)])).drop("event_id")
    first, second = (
        {(r.status, r.event_id) for r in E.with_tie_break(d).collect()} for d in (df, df.repartition(3))
    )
    assert first == second and len({i for _, i in first}) == 2


def test_dwell(spark):
    now = F.lit("2024-01-03 00:00").cast("timestamp_ntz")
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    hours = lambda nxt, status: one(E.dwell_hours(ts("2024-01-01 00:30"), nxt, F.lit(status), (81,), now))
    assert hours(ts("2024-01-01 02:00"), 8) == 1
    assert hours(ts(None), 8) == 47
    assert hours(ts(None), 81) is None
    assert hours(ts("2024-01-01 02:00"), 81) == 1


def test_epoch_helper_matches_the_clock():
    assert at("1970-01-01 07:00") == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs, st.integers(0, 3), st.integers(0, 4), st.sampled_from([0, 60, 1 << 20]))
def test_the_keyed_look_back_is_the_same_at_any_bound(spark, drawn, begin, length, bound):
    rows = as_rows(drawn) + [{"event_id": 100 + i, "shipment_id": None, "status": 8, "ctime": i} for i in range(drawn[0][2] or 3)]
    df = log(spark, rows)
    listed = []  # rows of the list, before those with earlier rows are left out

    def counted(found, on):
        listed.append(found.count())
        return found, key_list(found, on, listed[0], 0, 0, bound)

    found, keys = E.found_in_window(counted, df, begin, begin + length, ("event_id",), F.col("status") != 9)
    assert (keys.hashes is None) == (bound < 40 * listed[0])
    plain = E.first_event_in_window(df, begin, begin + length, ("event_id",), F.col("status") != 9)
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs, st.sampled_from([1, 2, 16]))
def test_the_event_before_equals_brute_force(spark, drawn, max_targets):
    """Several targets a key, equal and missing times; crowded keys are windowed."""
    rows = as_rows(drawn)
    up = lambda r: (r["ctime"] is None, r["ctime"] or 0, r["event_id"])
    want = []
    for r in rows:
        if r["status"] in (8, 11):
            earlier = [e for e in rows if e["shipment_id"] == r["shipment_id"] and up(e) < up(r)]
            want.append((r["shipment_id"], r["event_id"], max(earlier, key=up)["operator"] if earlier else None))
    df = log(spark, rows)
    got = E.event_before(df, df.filter("status IN (8, 11)"), ("operator", "status"), max_targets=max_targets)
    assert sorted((r.shipment_id, r.event_id, r.prev and r.prev.operator) for r in got.collect()) == sorted(want, key=lambda w: w[:2])


def test_frequent_keys_are_all_named(spark, monkeypatch):
    df = log(spark, as_rows([(("a", "b", None, f"k{i}")[min(i % 10, 3)], 8, i) for i in range(1000)]))
    assert dict(E.frequent(df, "shipment_id", 50)) == {"a": 100, "b": 100, None: 100}
    assert E.frequent(df, "shipment_id", 1000) == [] and E.frequent(df, "shipment_id", 100) == []
    monkeypatch.setattr(E, "MAX_LISTED_KEYS", 2)
    assert E.frequent(df, "shipment_id", 50) is None  # more than are listed
    monkeypatch.setattr(E, "SKETCH_ERROR", 0.1)
    assert E.frequent(df, "shipment_id", 150) is None  # the sketch may miss one


def test_key_lists_of_any_length_give_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(E, "MAX_ROWS_PER_KEY", 10)
    rows = as_rows([(("a", "b", "c", None, f"k{i % 40}")[min(i % 9, 4)], i % 5, i // 3) for i in range(300)])
    df = log(spark, rows)
    wanted = ["a", "k4", "k5", "k39", "none", None]
    for run in (
        lambda k: E.latest_event(df, cols=("status", "event_id"), only=k),
        lambda k: E.milestones(df, {"f": E.first(F.col("status") == 1, "event_id")}, only=k),
        lambda k: E.neighbours(df, before=("status",), after=("event_id",), only=k, max_rows_per_key=7),
        lambda k: keyed(df, k),
    ):
        listed, hashes, shuffled = (
            as_keys(spark, wanted, **limits) for limits in ({}, {"max_rows": 0}, {"max_rows": 0, "max_hash_bytes": 0})
        )
        assert listed.few and hashes.hashes is not None and shuffled.hashes is None
        got = [sorted(map(str, run(k).collect())) for k in (listed, hashes, shuffled)]
        assert got[0] == got[1] == got[2] and got[0]


def test_many_keys_are_matched_after_the_picks(spark):
    """Beyond the broadcast bound the results stay the same."""
    rows = [event(s, st_, f"2024-01-0{d} 0{d}:00", event_id=d) for s in "abc" for d, st_ in ((1, 8), (2, 11), (3, 39))]
    df = log(spark, rows)
    few, many = (as_keys(spark, ["a", "c", "c"], max_rows=n) for n in (10, 1))
    assert few.few and not many.few
    for run in (
        lambda k: E.latest_event(df, cols=("status",), only=k),
        lambda k: E.milestones(df, {"f": E.first(F.col("status") == 11, "event_id")}, only=k),
        lambda k: E.neighbours(df, before=("status",), only=k, max_rows_per_key=1, slice_seconds=10),
        lambda k: E.neighbours(df, after=("status",), only=k),
    ):
        got = [sorted(map(str, run(k).collect())) for k in (few, many)]
        assert got[0] == got[1] and got[0]
    aggregate = E.latest_event(df, cols=("status",), only=many)._jdf.queryExecution().optimizedPlan().toString()
    assert aggregate.index("Join LeftSemi") < aggregate.index("Aggregate")
