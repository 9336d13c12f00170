"""The single operators on the given tables, each with its SQL."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from checks.registry import query
from checks.sample import HUBS, read
from parcelspark import fixed_values as V
from parcelspark.functions import clock, jsontext, text
from parcelspark.operators.reuse import Kept
from parcelspark.operators import events as E, lookup as L, metrics as M, rules as R
from parcelspark.operators.dims import hub_regions, status_dim
from parcelspark.operators.routes import route_rules, route_sla

BY_TIME = ("ts", "event_id")
AS_OF = date(2024, 1, 31)


def events(spark, sf):
    return read(spark, sf, "events")


def k():
    return jsontext.json_int("props", "k")


K = "CAST(json_extract_string(props, '$.k') AS INT)"
HUB_LIST = ", ".join(f"('{h}', '{r}')" for r, hs in V.HUBS_OF_REGION.items() for h in hs)


# --- first, last, previous and next -------------------------------------------------------


@query(
    "first_event",
    """SELECT user_id, event_id, ts, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def _(spark, sf):
    return E.first_event(events(spark, sf), "user_id", ("event_id", "ts", "event_type"), BY_TIME)


@query(
    "latest_event",
    """SELECT user_id, event_id, ts, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(spark, sf):
    return E.latest_event(events(spark, sf), "user_id", ("event_id", "ts", "event_type", "value"), BY_TIME)


@query(
    "latest_then_filter",
    """SELECT user_id, ts, event_type FROM (
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    WHERE event_type IN ('click', 'view')""",
)
def _(spark, sf):
    return E.latest_event(
        events(spark, sf), "user_id", ("ts", "event_type"), BY_TIME, then=F.col("event_type").isin("click", "view")
    )


@query(
    "filter_then_latest",
    """SELECT user_id, ts, event_type FROM events WHERE event_type IN ('click', 'view')
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(spark, sf):
    return E.latest_event(
        events(spark, sf), "user_id", ("ts", "event_type"), BY_TIME, where=F.col("event_type").isin("click", "view")
    )


@query(
    "milestones",
    """SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS signup_ts,
        max(ts) FILTER (WHERE event_type = 'purchase') AS purchase_ts,
        arg_max(value, (ts, event_id)) FILTER (WHERE event_type = 'purchase') AS purchase_value,
        arg_min(event_id, (ts, event_id)) FILTER (WHERE event_type = 'error' AND value > 100) AS big_error_id,
        arg_max(event_type, (ts, event_id)) AS latest_type
    FROM events GROUP BY user_id""",
)
def _(spark, sf):
    kind = F.col("event_type")
    return E.milestones(
        events(spark, sf),
        {
            "signup": E.first(kind == "signup", "ts"),
            "purchase": E.last(kind == "purchase", "ts", "value"),
            "big_error": E.first((kind == "error") & (F.col("value") > 100), "event_id"),
            "latest": E.last(None, "event_type"),
        },
        "user_id",
        BY_TIME,
    ).select(
        "user_id",
        F.col("signup.ts").alias("signup_ts"),
        F.col("purchase.ts").alias("purchase_ts"),
        F.col("purchase.value").alias("purchase_value"),
        F.col("big_error.event_id").alias("big_error_id"),
        F.col("latest.event_type").alias("latest_type"),
    )


@query(
    "milestone_times",
    """SELECT user_id, min(ts) FILTER (WHERE event_type = 'view') AS first_view,
        max(ts) FILTER (WHERE event_type = 'view') AS last_view, max(ts) AS last_any
    FROM events GROUP BY user_id""",
)
def _(spark, sf):
    view = F.col("event_type") == "view"
    picks = {"first": E.first(view, "ts"), "last": E.last(view, "ts"), "any": E.last(None, "ts")}
    return E.milestones(events(spark, sf), picks, "user_id", BY_TIME).select(
        "user_id", F.col("first.ts").alias("first_view"), F.col("last.ts").alias("last_view"), F.col("any.ts").alias("last_any")
    )


_UNTIMED = "SELECT user_id, event_id, event_type, CASE WHEN user_id % 5 = 0 OR event_id % 4 = 0 THEN NULL ELSE ts END AS ts FROM events"


def _untimed(spark, sf):
    has_none = (F.col("user_id") % 5 == 0) | (F.col("event_id") % 4 == 0)
    return events(spark, sf).withColumn("ts", F.when(~has_none, F.col("ts")))


@query(
    "first_and_latest_without_times",
    f"""WITH e AS ({_UNTIMED})
    SELECT * FROM (SELECT user_id, event_id AS first_id, event_type AS first_type FROM e
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) = 1)
    JOIN (SELECT user_id, event_id AS last_id FROM e
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1) USING (user_id)""",
)
def _(spark, sf):
    """Rows without a time come last both ways; a key with no other row is not lost."""
    df = _untimed(spark, sf)
    first = E.first_event(df, "user_id", ("event_id", "event_type"), BY_TIME)
    last = E.milestones(df, {"last": E.last(None, "event_id", "ts")}, "user_id", BY_TIME)
    return first.join(last, "user_id").select(
        "user_id", F.col("event_id").alias("first_id"), F.col("event_type").alias("first_type"), F.col("last.event_id").alias("last_id")
    )


@query(
    "first_event_in_window",
    """WITH e AS (SELECT *, nullif(user_id % 40, 0) AS key FROM events WHERE event_type IN ('click', 'view'))
    SELECT key, event_id, event_type FROM (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY key, event_type ORDER BY ts, event_id) = 1)
    WHERE ts >= (SELECT min(ts) + INTERVAL 6 HOUR FROM events) AND ts < (SELECT min(ts) + INTERVAL 30 DAY FROM events)""",
)
def _(spark, sf):
    """Keys whose first event of a kind lies in the window, the NULL key among them."""
    df = _with_epoch(spark, sf).withColumn("key", F.when(F.col("user_id") % 40 != 0, F.col("user_id") % 40))
    start = df.agg(F.min("at")).first()[0]
    cols = ("event_id", "event_type")
    parts = [
        E.first_event_in_window(df, start + 6 * 3600, start + 30 * 86400, cols, F.col("event_type") == kind, "key", ("at", "event_id"))
        for kind in ("click", "view")
    ]
    return parts[0].union(parts[1])


@query(
    "found_in_window",
    """WITH e AS (SELECT *, nullif(user_id % 40, 0) AS key FROM events WHERE event_type = 'click')
    SELECT key, event_id, value FROM (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts, event_id) = 1)
    WHERE ts >= (SELECT min(ts) + INTERVAL 6 HOUR FROM events) AND ts < (SELECT min(ts) + INTERVAL 30 DAY FROM events)""",
)
def _(spark, sf):
    """The same for one kind, with the candidates kept and earlier rows looked for by their hashes."""
    df = _with_epoch(spark, sf).withColumn("key", F.when(F.col("user_id") % 40 != 0, F.col("user_id") % 40))
    start = df.agg(F.min("at")).first()[0]
    found, _ = E.found_in_window(
        Kept().counted, df, start + 6 * 3600, start + 30 * 86400, ("event_id", "value"), F.col("event_type") == "click", "key",
        ("at", "event_id"),
    )
    return found


_BEFORE = """SELECT event_id, prev_id, prev_type FROM (
        SELECT event_id, event_type, lag(event_id) OVER w AS prev_id, lag(event_type) OVER w AS prev_type FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = 'error'"""


def _before(spark, sf, **options):
    log = events(spark, sf)
    targets = Kept().keep(log.filter("event_type = 'error'").select("user_id", *BY_TIME))
    found = E.event_before(log, targets, ("event_id", "event_type"), "user_id", BY_TIME, **options)
    return found.select("event_id", F.col("prev.event_id").alias("prev_id"), F.col("prev.event_type").alias("prev_type"))


@query("event_before", _BEFORE)
def _(spark, sf):
    """The event before each of some events, by an as-of pick."""
    return _before(spark, sf, max_targets=1000)


@query("event_before_crowded", _BEFORE)
def _(spark, sf):
    """The same where most keys have too many targets for pairs."""
    return _before(spark, sf, max_targets=2)


_NULL_KEYS = """SELECT event_id, lag(event_type) OVER w AS prev_type, lead(event_id) OVER w AS next_id
    FROM (SELECT *, nullif(user_id % 7, 3) AS key FROM events) WINDOW w AS (PARTITION BY key ORDER BY ts, event_id)"""


def _null_keys(spark, sf, **options):
    df = events(spark, sf).withColumn("key", F.when(F.col("user_id") % 7 != 3, F.col("user_id") % 7))
    found = E.neighbours(df, before=("event_type",), after=("event_id",), key="key", order=BY_TIME, **options)
    return found.select("event_id", F.col("prev.event_type").alias("prev_type"), F.col("next.event_id").alias("next_id"))


@query("neighbours_null_key", _NULL_KEYS)
def _(spark, sf):
    """NULL is a key of its own, and large enough to be cut."""
    return _null_keys(spark, sf, max_rows_per_key=16)


@query("neighbours_null_key_unlisted", _NULL_KEYS)
def _(spark, sf):
    """The same when there are too many large keys to list."""
    before, E.MAX_LISTED_KEYS = E.MAX_LISTED_KEYS, 2
    try:
        return _null_keys(spark, sf, max_rows_per_key=16)
    finally:
        E.MAX_LISTED_KEYS = before


_PREVIOUS = """SELECT event_id, user_id, event_type, lag(event_type) OVER w AS prev_type, lag(ts) OVER w AS prev_ts,
    lag(value) OVER w AS prev_value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


def _previous(spark, sf, **options):
    df = E.neighbours(
        events(spark, sf), before=("event_type", "ts", "value"), key="user_id", order=BY_TIME, **options
    )
    return df.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("prev.event_type").alias("prev_type"),
        F.col("prev.ts").alias("prev_ts"),
        F.col("prev.value").alias("prev_value"),
    )


@query("prev_event", _PREVIOUS)
def _(spark, sf):
    return _previous(spark, sf)


@query("prev_event_in_slices", _PREVIOUS)
def _(spark, sf):
    """The same rows when every key is a large one; the width of the slices follows the counts."""
    return _previous(spark, sf, max_rows_per_key=8)


def _with_epoch(spark, sf):
    return events(spark, sf).withColumn("at", F.timestamp_diff("SECOND", F.expr(clock.EPOCH), F.col("ts")))


@query(
    "neighbours_in_slices",
    """SELECT event_id, user_id, lag(event_type) OVER w AS prev_type, lead(event_type) OVER w AS next_type,
        lead(value) OVER w AS next_value
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def _(spark, sf):
    """Every key above ten rows is treated as a large one and cut by the day."""
    df = E.neighbours(
        _with_epoch(spark, sf), before=("event_type",), after=("event_type", "value"), key="user_id",
        order=("at", "event_id"), max_rows_per_key=10, slice_seconds=86_400,
    )
    return df.select(
        "event_id",
        "user_id",
        F.col("prev.event_type").alias("prev_type"),
        F.col("next.event_type").alias("next_type"),
        F.col("next.value").alias("next_value"),
    )


@query(
    "next_event_dwell",
    """SELECT event_id, user_id, CASE WHEN nx IS NOT NULL THEN date_sub('hour', ts, nx)
        WHEN event_type <> 'purchase' THEN date_sub('hour', ts, TIMESTAMP '2024-01-31 12:00:00') END AS dwell_hours
    FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM events)""",
)
def _(spark, sf):
    df = E.neighbours(events(spark, sf), after=("ts",), key="user_id", order=BY_TIME)
    now = clock.moment(datetime(2024, 1, 31, 12))
    hours = E.dwell_hours(F.col("ts"), F.col("next.ts"), F.col("event_type"), ("purchase",), now)
    return df.select("event_id", "user_id", hours.alias("dwell_hours"))


@query(
    "lag_as_fill",
    f"""SELECT event_id, user_id, CASE WHEN n_name IS NULL THEN lag(n_name) OVER (PARTITION BY user_id ORDER BY ts, event_id)
        ELSE n_name END AS station
    FROM events LEFT JOIN nation ON n_nationkey = {K}""",
)
def _(spark, sf):
    """The neighbour is taken after the join, so an unmatched event has a NULL name itself."""
    stations = read(spark, sf, "nation").select(F.col("n_nationkey").alias("_k"), "n_name")
    named = events(spark, sf).withColumn("_k", k()).join(stations, "_k", "left")
    df = E.neighbours(named, before=("n_name",), key="user_id", order=BY_TIME)
    return df.select("event_id", "user_id", F.coalesce("n_name", "prev.n_name").alias("station"))


@query(
    "argmax_ties",
    """SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_shipdate FROM lineitem l
    JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem GROUP BY l_orderkey) x
    ON x.l_orderkey = l.l_orderkey AND x.m = l.l_shipdate""",
)
def _(spark, sf):
    lines = read(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    return E.latest_version(lines, "l_orderkey", "l_shipdate")


@query(
    "argmax_tie_broken",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1""",
)
def _(spark, sf):
    cols = ("l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    return E.latest_event(
        read(spark, sf, "lineitem"), "l_orderkey", cols, ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")
    )


@query(
    "unranked_repeats",
    """SELECT a.user_id, a.ts AS signup_ts, CAST(b.ts AS DATE) AS purchase_date FROM events a
    LEFT JOIN events b ON b.user_id = a.user_id AND b.event_type = 'purchase' WHERE a.event_type = 'signup'""",
)
def _(spark, sf):
    e = events(spark, sf)
    bought = e.filter("event_type = 'purchase'").select("user_id", F.col("ts").cast("date").alias("purchase_date"))
    return (
        e.filter("event_type = 'signup'")
        .select("user_id", F.col("ts").alias("signup_ts"))
        .join(bought, "user_id", "left")
    )


@query(
    "fanout_dedup",
    """SELECT DISTINCT x.user_id, x.event_type, x.ts FROM events e LEFT JOIN (
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) x
    ON x.user_id = e.user_id""",
)
def _(spark, sf):
    """Joining the log to its own latest rows and removing repeats gives the latest rows."""
    return E.latest_event(events(spark, sf), "user_id", ("event_type", "ts"), BY_TIME)


@query(
    "effective_station",
    f"""SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN json_extract_string(props, '$.k')
        WHEN event_type = 'error' THEN CAST(attempt AS VARCHAR) ELSE CAST(event_id % 25 AS VARCHAR) END AS place
    FROM events LEFT JOIN (SELECT user_id, arg_max({K}, (ts, event_id)) AS attempt FROM events
        WHERE event_type = 'signup' GROUP BY user_id) USING (user_id)""",
)
def _(spark, sf):
    e = events(spark, sf)
    attempts = E.latest_event(
        e.withColumn("attempt", k()), "user_id", ("attempt",), BY_TIME, where=F.col("event_type") == "signup"
    )
    place = E.effective_station(
        F.col("event_type"), F.col("event_id") % 25, jsontext.json_text("props", "k"), F.col("attempt"),
        ("click", "view"), ("error",),
    )
    return e.join(attempts, "user_id", "left").select("event_id", place.alias("place"))


# --- time ---------------------------------------------------------------------------------


def _business_day(hours):
    @query(
        f"business_day_{hours}h",
        f"""SELECT CASE WHEN ts >= CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL {hours} HOUR THEN CAST(ts AS DATE)
            ELSE CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS DATE) END AS day, count(*) AS n FROM events GROUP BY 1""",
    )
    def _(spark, sf):
        day = clock.business_day(F.col("ts"), hours).alias("day")
        return events(spark, sf).groupBy(day).agg(F.count("*").alias("n"))


_business_day(6)
_business_day(2)


@query(
    "epoch_to_local_time",
    """SELECT event_id, make_timestamp((CAST(date_sub('second', TIMESTAMP '1970-01-01', ts) AS BIGINT) + 25200) * 1000000) AS local_ts
    FROM events""",
)
def _(spark, sf):
    return _with_epoch(spark, sf).select("event_id", clock.event_ts("at", 25_200).alias("local_ts"))


@query(
    "deadline_flags",
    """SELECT event_id, CASE WHEN ts <= CAST(d AS TIMESTAMP) + INTERVAL 20 HOUR THEN 'ontime' END AS by_20h,
        CASE WHEN ts > CAST(d AS TIMESTAMP) + INTERVAL 20 HOUR THEN 'late' END AS after_20h,
        CASE WHEN ts <= CAST(d AS TIMESTAMP) + INTERVAL 26 HOUR THEN 'ontime' END AS by_2am
    FROM (SELECT *, CAST(ts - INTERVAL 6 HOUR AS DATE) AS d FROM events)""",
)
def _(spark, sf):
    t, day = F.col("ts"), clock.business_day(F.col("ts"), 6)
    return events(spark, sf).select(
        "event_id",
        clock.on_time(t, day, 0, 20).alias("by_20h"),
        clock.late(t, day, 0, 20).alias("after_20h"),
        clock.on_time(t, day, 1, 2).alias("by_2am"),
    )


@query(
    "aging_days",
    """SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') + 1 AS INT) AS aging FROM orders""",
)
def _(spark, sf):
    aging = clock.aging_days(F.col("o_orderdate"), date(2001, 8, 2))
    return read(spark, sf, "orders").select("o_orderkey", aging.alias("aging"))


@query(
    "elapsed_units",
    """SELECT event_id, date_sub('hour', ts, p) AS back_hours, date_sub('minute', p, ts) AS minutes,
        CAST(date_diff('day', CAST(p AS DATE), CAST(ts AS DATE)) AS INT) AS days
    FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)""",
)
def _(spark, sf):
    df = E.neighbours(events(spark, sf), before=("ts",), key="user_id", order=BY_TIME)
    before, at = F.col("prev.ts"), F.col("ts")
    return df.select(
        "event_id",
        clock.elapsed("HOUR", at, before).alias("back_hours"),
        clock.elapsed("MINUTE", before, at).alias("minutes"),
        F.datediff(at.cast("date"), before.cast("date")).alias("days"),
    )


@query("iso_week", "SELECT o_orderkey, CAST(week(o_orderdate) + 1 AS INT) AS week_num FROM orders")
def _(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", clock.next_iso_week(F.col("o_orderdate")).alias("week_num"))


@query(
    "iso_text_to_timestamp",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS at FROM orders""",
)
def _(spark, sf):
    iso = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss'+07:00'")
    return read(spark, sf, "orders").select("o_orderkey", clock.iso_timestamp(iso).alias("at"))


@query(
    "look_back_window",
    """SELECT event_id, date_trunc('hour', ts) AS hour FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-20' AND DATE '2024-01-30'""",
)
def _(spark, sf):
    """Closed day window, compared on the stored column so that it can prune the scan."""
    begin, end = clock.days_before(AS_OF, 11), clock.days_before(AS_OF, 0)
    t = F.col("ts")
    rows = events(spark, sf).filter(
        (t >= clock.midnight(clock.day_lit(begin))) & (t < clock.midnight(clock.day_lit(end)))
    )
    return rows.select("event_id", F.date_trunc("hour", t).cast("timestamp_ntz").alias("hour"))


@query(
    "day_between_timestamps",
    """SELECT event_id FROM events WHERE CAST(ts - INTERVAL 6 HOUR AS DATE)
    BETWEEN date_trunc('day', TIMESTAMP '2024-01-31') - INTERVAL 18 DAY AND date_trunc('day', TIMESTAMP '2024-01-20')""",
)
def _(spark, sf):
    """A day compared with timestamps counts as its midnight."""
    low, high = (clock.midnight(clock.day_lit(d)) for d in (clock.days_before(AS_OF, 18), date(2024, 1, 20)))
    return events(spark, sf).filter(clock.business_day(F.col("ts"), 6).between(low, high)).select("event_id")


@query(
    "zero_as_missing",
    """SELECT event_id, CASE WHEN k <> 0 THEN make_timestamp((k + 25200) * 1000000) END AS at
    FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
)
def _(spark, sf):
    at = clock.event_ts(clock.zero_as_missing(k().cast("long")), 25_200)
    return events(spark, sf).select("event_id", at.alias("at"))


@query(
    "interval_average",
    """SELECT o_orderpriority, CAST(CAST(avg(d) AS DECIMAL(38, 0)) AS BIGINT) AS avg_days, round(avg(d * 86400.0), 6) AS avg_seconds,
        count(*) AS n
    FROM (SELECT o_orderpriority, date_diff('day', o_orderdate, l_shipdate) AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
    GROUP BY 1""",
)
def _(spark, sf):
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_orderdate")
    lines = read(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    took = F.col("l_shipdate") - F.col("o_orderdate")
    return (
        lines.join(o, "l_orderkey")
        .groupBy("o_orderpriority")
        .agg(
            F.avg(clock.elapsed("DAY", F.col("o_orderdate"), F.col("l_shipdate"))).cast("decimal(38,0)").alias("avg_days"),
            M.mean_interval(took).alias("avg_seconds"),
            F.count("*").alias("n"),
        )
        .withColumn("avg_days", F.col("avg_days").cast("long"))
        .withColumn(
            "avg_seconds", F.col("avg_seconds").cast("interval second").cast("decimal(18,6)").cast("double")
        )
    )


# --- text and JSON ------------------------------------------------------------------------

_BROKEN = "CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 1) WHEN event_type = 'view' THEN '{\"k\": \"v' || event_id || '\"}' ELSE props END"


@query(
    "json_path_cast",
    f"""SELECT event_id, CASE WHEN json_valid(doc) THEN json_extract_string(doc, '$.k') END AS k_text,
        TRY_CAST(CASE WHEN json_valid(doc) THEN json_extract_string(doc, '$.k') END AS INT) AS k_int
    FROM (SELECT event_id, {_BROKEN} AS doc FROM events)""",
)
def _(spark, sf):
    """Broken documents and missing numbers give NULL."""
    docs = events(spark, sf).select("event_id", F.expr(_BROKEN).alias("doc"))
    return docs.select(
        "event_id", jsontext.json_text("doc", "k").alias("k_text"), jsontext.json_int("doc", "k").alias("k_int")
    )


@query(
    "json_strict_cast",
    f"SELECT event_id, {K} AS k FROM events",
)
def _(spark, sf):
    return events(spark, sf).select("event_id", jsontext.json_int_strict("props", "k").alias("k"))


@query(
    "json_key_join",
    f"SELECT event_id, n_name FROM events JOIN nation ON n_nationkey = {K}",
)
def _(spark, sf):
    stations = read(spark, sf, "nation").select("n_nationkey", "n_name")
    return events(spark, sf).withColumn("n_nationkey", k()).join(stations, "n_nationkey").select("event_id", "n_name")


@query(
    "split_part_first_last",
    """SELECT p_partkey, split_part(p_type || ', ' || p_name, ',', 1) AS first_item,
        trim(list_extract(string_split(p_type || ', ' || p_name, ','), -1)) AS last_item
    FROM part""",
)
def _(spark, sf):
    path = F.concat(F.lit("["), F.col("p_type"), F.lit(", "), F.col("p_name"), F.lit("]"))
    return read(spark, sf, "part").select(
        "p_partkey", text.first_list_item(path).alias("first_item"), text.last_list_item(path).alias("last_item")
    )


def _names(spark, sf):
    """Station-like names out of the part table."""
    kinds = F.element_at(F.array(*[F.lit(x) for x in "FDHS"]), (F.col("p_partkey") % 4 + 1).cast("int"))
    name = F.concat(kinds, F.upper(F.substr("p_type", F.lit(1), F.lit(4))), F.lit(" - "), F.col("p_name"))
    irregular = R.apply_rules([(F.col("p_size") == i, n) for i, n in enumerate(text.IRREGULAR_HUBS, 1)], name)
    return read(spark, sf, "part").select("p_partkey", irregular.alias("name"))


_NAMES = """(SELECT p_partkey, CASE p_size WHEN 1 THEN 'FSATH- สาทร' WHEN 2 THEN 'DJOMT-B-จอมทอง'
    ELSE list_extract(['F', 'D', 'H', 'S'], CAST(p_partkey % 4 + 1 AS INT)) || upper(p_type[:4]) || ' - ' || p_name END AS name FROM part)"""


@query(
    "hub_normalise",
    f"""SELECT p_partkey, CASE name WHEN 'FSATH- สาทร' THEN 'HSATH' WHEN 'DJOMT-B-จอมทอง' THEN 'HJOMT-B'
        ELSE CASE WHEN name[1] IN ('F', 'D') THEN 'H' || split_part(name, ' -', 1)[2:] ELSE split_part(name, ' -', 1) END END AS hub
    FROM {_NAMES}""",
)
def _(spark, sf):
    return _names(spark, sf).select("p_partkey", text.delivery_hub_of_any(F.col("name")).alias("hub"))


@query(
    "missing_match_suffix",
    """SELECT c_custkey, CASE WHEN s.n IS NULL THEN 'NATION_' || c_nationkey || '-A' ELSE s.n END AS hub FROM customer
    LEFT JOIN (SELECT DISTINCT 'NATION_' || s_nationkey AS n FROM supplier WHERE s_acctbal > 5000) s ON s.n = 'NATION_' || c_nationkey""",
)
def _(spark, sf):
    label = lambda c: F.concat(F.lit("NATION_"), F.col(c).cast("string"))
    known = (
        read(spark, sf, "supplier").filter("s_acctbal > 5000").select(label("s_nationkey").alias("_known")).distinct()
    )
    own = label("c_nationkey")
    return (
        read(spark, sf, "customer")
        .join(L.bounded_broadcast(known), own == F.col("_known"), "left")
        .select(
            "c_custkey",
            F.when(F.col("_known").isNull(), F.concat(own, F.lit("-A"))).otherwise(own).alias("hub"),
        )
    )


@query(
    "like_patterns",
    """SELECT p_partkey, p_name LIKE 'red%' AS prefix, p_name LIKE '%ring%' AS inside, p_name LIKE 's_all%' AS one_char,
        p_type LIKE 'ECONOMY' AS whole, p_type LIKE '-A' AS never FROM part""",
)
def _(spark, sf):
    name, kind = F.col("p_name"), F.col("p_type")
    return read(spark, sf, "part").select(
        "p_partkey",
        name.like("red%").alias("prefix"),
        name.like("%ring%").alias("inside"),
        name.like("s_all%").alias("one_char"),
        kind.like("ECONOMY").alias("whole"),
        kind.like("-A").alias("never"),
    )


# --- rules --------------------------------------------------------------------------------

_STATUS_WORDS = (
    "3PL_Received", "SP_Received", "DOP_Received", "FMHub_LHTransporting", "Return_LMHub_Received", "Exception_Found",
    "Delivering", "SOC_Pickup_Done", "SOC_Received", "Return_SOC_LHTransporting", "Reallocate", "Created",
    "SOC_Pickup_Onhold", "SOC_Pickup_Handedover", "Transported_to_sp", "SOC_Packing", "Auto_to_Pending_Drop_off", "Other",
    "Return-LMHub_Packed", "Return SOC_Lost", "ReturnSOC_Lost",
)
_WORD_LIST = ", ".join(f"'{w}'" for w in _STATUS_WORDS)


@query(
    "rule_cascade",
    f"""SELECT event_id, CASE WHEN s ^@ '3PL' THEN '4PL' WHEN s ^@ 'SP' OR s ^@ 'DOP' OR s = 'Auto_to_Pending_Drop_off' THEN 'SP'
        WHEN s LIKE 'Return_FM%' OR s LIKE 'Return_LM%' OR regexp_matches(s, '^(FM|LM|Exc)') OR s IN ('Delivering', 'Onhold', 'SOC_Pickup_Done') THEN 'CTO'
        WHEN place IN ('SOCE', 'SOCW') AND (s LIKE 'Return_SOC%' OR regexp_matches(s, '^SOC|^Reallocate$')) THEN 'MM' WHEN s = 'Created' THEN 'MM'
        WHEN s ^@ 'Return_SOC_LHTransport' THEN 'CTO/MM'
        WHEN s IN ('SOC_Pickup_Onhold', 'SOC_Pickup_Failed', 'Transporting_to_sp', 'Transported_to_sp') THEN 'SP/CTO'
        WHEN s IN ('SOC_Received', 'SOC_Packing', 'SOC_Packed', 'SOC_Handover', 'Reallocate') THEN 'CTO'
        WHEN s = 'SOC_Pickup_Handedover' THEN CASE drop_off WHEN TRUE THEN 'SP/CTO' WHEN FALSE THEN 'CTO/MM' END END AS team
    FROM (SELECT event_id, list_extract([{_WORD_LIST}], CAST({K} % {len(_STATUS_WORDS)} + 1 AS INT)) AS s,
        CASE event_type WHEN 'click' THEN 'SOCE' WHEN 'view' THEN 'SOCW' WHEN 'error' THEN 'CERC' END AS place,
        CASE WHEN value < 100 THEN event_type = 'click' END AS drop_off FROM events)""",
)
def _(spark, sf):
    word = F.element_at(F.array(*[F.lit(w) for w in _STATUS_WORDS]), k() % len(_STATUS_WORDS) + 1)
    kind = F.col("event_type")
    at = R.apply_rules([(kind == "click", "SOCE"), (kind == "view", "SOCW"), (kind == "error", "CERC")])
    drop_off = F.when(F.col("value") < 100, kind == "click")
    return events(spark, sf).select("event_id", R.responsible_team(word, at, drop_off).alias("team"))


@query(
    "rule_lookup",
    f"""SELECT p_partkey, h.region AS hub_region, f.region AS first_mile_region FROM (
        SELECT p_partkey, list_extract([{", ".join(repr(h) for h in HUBS)}], CAST(p_partkey % {len(HUBS) + 9} + 1 AS INT)) AS code FROM part) p
    LEFT JOIN (VALUES {HUB_LIST}) h(code, region) ON h.code = p.code
    LEFT JOIN (VALUES {HUB_LIST}) f(code, region) ON 'F' || f.code[2:] = 'F' || p.code[2:]""",
)
def _(spark, sf):
    codes = F.array(*[F.lit(h) for h in HUBS])
    code = F.try_element_at(codes, (F.col("p_partkey") % (len(HUBS) + 9) + 1).cast("int"))
    df = read(spark, sf, "part").select("p_partkey", code.alias("code"))
    df = L.lookup_rules(df, hub_regions(spark), {"code": F.col("code")}, {"region": "hub_region"})
    first_mile = F.concat(F.lit("F"), F.substr(F.col("code"), F.lit(2)))
    df = L.lookup_rules(df, hub_regions(spark, "F"), {"code": first_mile}, {"region": "first_mile_region"})
    return df.select("p_partkey", "hub_region", "first_mile_region")


_CENTRES = ", ".join(f"'{c}'" for c in V.REGIONAL)


@query(
    "route_sla",
    f"""WITH legs AS (
        SELECT l_orderkey, l_linenumber, l_partkey, list_extract([{_CENTRES}], CAST(l_suppkey % 7 + 1 AS INT)) AS pu,
            list_extract([{_CENTRES}], CAST(l_partkey % 7 + 1 AS INT)) AS del, l_shipdate AS rc_in,
            l_shipdate + CAST(l_quantity AS INT) * INTERVAL 1 HOUR AS rc_out,
            l_shipdate + CAST(l_quantity + l_linenumber AS INT) * INTERVAL 1 HOUR AS there,
            l_shipdate + CAST(l_partkey % 40 AS INT) * INTERVAL 1 HOUR AS soc_out FROM lineitem),
    lim(pu, a, b, c, sign) AS (VALUES ('CERC', -5, -9, 4, -1), ('NERC-A', -5, -10, 5, -1), ('NERC-B', -5, -10, 5, -1),
        ('NORC-A', -3, -10, 7, -1), ('NORC-B', 2, -10, 12, 1), ('SORC-B', 5, -11, 16, 1)),
    onward(del, d) AS (VALUES ('NERC-A', 17), ('NERC-B', 16), ('NORC-A', 17), ('NORC-B', 16), ('SORC-A', 13), ('SORC-B', 12), ('CERC', 18))
    SELECT l_orderkey, l_linenumber, l_partkey, replace(pu, '-', '') || '-SOC-' || replace(del, '-', '') AS lh_route,
        CAST(CAST(rc_out + a * INTERVAL 1 HOUR AS DATE) <= CAST(rc_in AS DATE) AS INT) AS f1,
        CAST(CAST(there + CASE WHEN pu = 'NERC-B' AND del LIKE 'NORC%' THEN -11 ELSE b END * INTERVAL 1 HOUR AS DATE) <= CAST(rc_in AS DATE) AS INT) AS f2,
        CAST(date_sub('hour', rc_out, there) <= CASE WHEN pu = 'NERC-B' AND del LIKE 'NORC%' THEN 8 ELSE c END AS INT) AS f3,
        CAST(CAST(soc_out + sign * d * INTERVAL 1 HOUR AS DATE) <= CAST(there - INTERVAL 6 HOUR AS DATE) AS INT) AS f4
    FROM legs JOIN lim USING (pu) JOIN onward USING (del) WHERE split_part(pu, '-', 1) <> split_part(del, '-', 1)""",
)
def _(spark, sf):
    centres = F.array(*[F.lit(c) for c in V.REGIONAL])
    pick = lambda c: F.element_at(centres, (F.col(c) % 7 + 1).cast("int"))
    hours = lambda h: F.col("l_shipdate") + F.make_dt_interval(hours=h.cast("int"))
    legs = read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        pick("l_suppkey").alias("pickup_rc_station"),
        pick("l_partkey").alias("delivery_rc_station"),
        F.col("l_shipdate").alias("xrc_received_time"),
        hours(F.col("l_quantity")).alias("min_xrc_lh_transporting_time"),
        hours(F.col("l_quantity") + F.col("l_linenumber")).alias("min_xrc_lh_transported_time"),
        hours(F.col("l_quantity") + F.col("l_linenumber")).alias("min_soc_received"),
        hours(F.col("l_partkey") % 40).alias("min_soc_lh_transporting"),
    ).withColumn(
        "rc_to_soc_delivery_leadtime",
        clock.elapsed("HOUR", F.col("min_xrc_lh_transporting_time"), F.col("min_xrc_lh_transported_time")),
    )
    return route_sla(legs, route_rules(spark)).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "lh_route",
        F.col("is_rc_transporting_ontime").alias("f1"),
        F.col("is_rc_transported_ontime").alias("f2"),
        F.col("rc_traveling_soc_leadtime_check").alias("f3"),
        F.col("is_soc_transporting_ontime").alias("f4"),
    )


@query(
    "order_type_rules",
    """SELECT o_orderkey, CASE WHEN a THEN 'WH' WHEN b THEN 'CB' WHEN c THEN 'MKP' WHEN d THEN 'BKY' WHEN e THEN 'NS' ELSE 'MKP' END AS by_flags_open,
        CASE WHEN a THEN 'WH' WHEN b THEN 'CB' WHEN e THEN 'OSV' WHEN d THEN 'BKY' ELSE 'MKP' END AS by_flags_contact,
        CASE WHEN n = 0 THEN 'WH' WHEN n = 1 THEN 'CB' WHEN n = 12 THEN 'NS' WHEN n IN (2, 6, 9, 14, 15) THEN 'MKP' WHEN n IN (7, 8) THEN 'BKY' END AS by_code,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'CB' WHEN '2-HIGH' THEN 'WH' ELSE 'MKP' END AS by_name,
        CASE WHEN n < 2 THEN 'SCOM' WHEN n = 3 THEN 'GBKK' ELSE 'UPC' END AS for_return
    FROM (SELECT *, o_orderkey % 16 AS n, o_orderpriority = '1-URGENT' AS a, o_orderpriority = '2-HIGH' AS b, o_orderstatus = 'F' AS c,
        o_orderkey % 2 = 0 AS d, o_orderkey % 3 = 0 AS e FROM orders)""",
)
def _(spark, sf):
    n = F.col("o_orderkey") % 16
    flags = {
        "is_warehouse": F.col("o_orderpriority") == "1-URGENT",
        "is_cross_border": F.col("o_orderpriority") == "2-HIGH",
        "is_marketplace": F.col("o_orderstatus") == "F",
        "is_bulky": F.col("o_orderkey") % 2 == 0,
        "is_open_service": F.col("o_orderkey") % 3 == 0,
    }
    return (
        read(spark, sf, "orders")
        .withColumns(flags)
        .select(
            "o_orderkey",
            R.type_by_flags_open().alias("by_flags_open"),
            R.type_by_flags_contact().alias("by_flags_contact"),
            R.type_by_code(n.cast("string")).alias("by_code"),
            R.type_by_name(F.col("o_orderpriority"), {"1-URGENT": "CB", "2-HIGH": "WH"}).alias("by_name"),
            R.return_type(n, F.when(n == 3, "GBKK").otherwise("UPC")).alias("for_return"),
        )
    )


@query(
    "flow_and_operator_rules",
    f"""SELECT event_id, CASE WHEN split_part(s, '_', 1) = 'Return' THEN 'Return' ELSE 'Forward' END AS by_first_word,
        CASE WHEN s LIKE '%Return%' THEN 'RTN' ELSE 'FWD' END AS by_mention,
        CASE WHEN o LIKE 'IND%' THEN 'IND000001' WHEN o LIKE 'CAB%' THEN 'CAB000001' WHEN o LIKE 'DWS%' THEN 'DWS000001'
             WHEN o LIKE 'MQB%' THEN 'MQB000001' ELSE 'return_agent' END AS operator_group
    FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'Return_SOC' WHEN 'view' THEN 'LM_Return' ELSE 'SOC' END AS s,
        list_extract(['IND', 'CAB', 'DWS', 'MQB', 'MAN'], CAST({K} % 5 + 1 AS INT)) || event_id AS o FROM events)""",
)
def _(spark, sf):
    kind = F.col("event_type")
    status = R.apply_rules([(kind == "click", "Return_SOC"), (kind == "view", "LM_Return")], "SOC")
    stems = F.array(*[F.lit(x) for x in ("IND", "CAB", "DWS", "MQB", "MAN")])
    operator = F.concat(F.element_at(stems, k() % 5 + 1), F.col("event_id").cast("string"))
    return events(spark, sf).select(
        "event_id",
        R.flow_by_first_word(status).alias("by_first_word"),
        R.flow_by_mention(status).alias("by_mention"),
        R.operator_group(operator).alias("operator_group"),
    )


_PLACES = ("HQ1", "FQ1", "DQ1", "Partner 1", "SOCE", "CERC", "Brand 1", "Sorting center", "Other")
_PLACE_LIST = ", ".join(f"'{p}'" for p in _PLACES)
_WHO = (
    lambda e, extra: f"CASE WHEN {e} ^@ 'H' THEN 'LM' WHEN {e} ^@ 'F' THEN 'FM' WHEN {e} ^@ 'D' THEN 'SDOP' WHEN {e} ^@ 'Partner' THEN 'PS' "
    f"WHEN {e} ^@ 'SOC' OR {extra} THEN 'SOC' WHEN {e} IN ({_CENTRES}) THEN 'RC' WHEN {e} ^@ 'Brand' THEN 'PS' END"
)


@query(
    "function_attribution",
    f"""SELECT event_id, CASE WHEN partner = 'Kerry' THEN '4PL' WHEN st IN (47, 15) AND nx IN (48, 36) THEN 'LH'
        ELSE coalesce({_WHO('e1', 'FALSE')}, {_WHO('e2', "own = 'Sorting center'")}, {_WHO('own', "own = 'Sorting center'")}) END AS fn
    FROM (SELECT *, coalesce(hub, named) AS own, CASE WHEN st IN (47, 15) AND nx NOT IN (48, 36) THEN nhub ELSE hub END AS e1,
            CASE WHEN st IN (48, 36) THEN nhub ELSE hub END AS e2
        FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'Kerry' END AS partner,
            list_extract([47, 15, 48, 36, 8], CAST({K} % 5 + 1 AS INT)) AS st, list_extract([36, 8, 48, 15, NULL], CAST(event_id % 5 + 1 AS INT)) AS nx,
            CASE WHEN value < 200 THEN list_extract([{_PLACE_LIST}], CAST({K} % 9 + 1 AS INT)) END AS hub,
            CASE WHEN value > 50 THEN list_extract([{_PLACE_LIST}], CAST(event_id % 9 + 1 AS INT)) END AS nhub,
            list_extract([{_PLACE_LIST}], CAST(user_id % 9 + 1 AS INT)) AS named FROM events))""",
)
def _(spark, sf):
    one_of = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))
    e = events(spark, sf)
    read_as = R.stations_of_leg(
        one_of((47, 15, 48, 36, 8), k()),
        one_of((36, 8, 48, 15, None), F.col("event_id")),
        F.when(F.col("value") < 200, one_of(_PLACES, k())),
        F.when(F.col("value") > 50, one_of(_PLACES, F.col("event_id"))),
        one_of(_PLACES, F.col("user_id")),
    )
    partner = F.when(F.col("event_type") == "error", "Kerry")
    return e.withColumns(read_as).select("event_id", R.function_of_leg(partner, "Brand").alias("fn"))


@query(
    "destination_zone",
    """SELECT o_orderkey, CASE WHEN flow = 'Return' AND t IN ('CB', 'WH') THEN 'GBKK' WHEN hub = 'CERC' THEN '4PL' WHEN hub = 'HNKCS' THEN 'GBKK'
        WHEN hub = 'HAUTH' THEN 'UPC' WHEN z IS NULL THEN '4PL' WHEN z NOT IN ('GBKK', '4PL') THEN 'UPC' ELSE z END AS zone
    FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Return' ELSE 'Forward' END AS flow,
        list_extract(['CB', 'WH', 'MKP'], CAST(o_orderkey % 3 + 1 AS INT)) AS t,
        list_extract(['CERC', 'HNKCS', 'HAUTH', 'HX', 'HY'], CAST(o_custkey % 5 + 1 AS INT)) AS hub,
        list_extract(['GBKK', '4PL', 'NORTH', NULL], CAST(o_orderkey % 4 + 1 AS INT)) AS z FROM orders)""",
)
def _(spark, sf):
    one_of = lambda values, c: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(c) % len(values) + 1).cast("int"))
    zone = R.destination_zone(
        F.when(F.col("o_orderstatus") == "F", "Return").otherwise("Forward"),
        one_of(("CB", "WH", "MKP"), "o_orderkey"),
        one_of(("CERC", "HNKCS", "HAUTH", "HX", "HY"), "o_custkey"),
        one_of(("GBKK", "4PL", "NORTH", None), "o_orderkey"),
    )
    return read(spark, sf, "orders").select("o_orderkey", zone.alias("zone"))


@query(
    "later_failure",
    """SELECT user_id, CASE WHEN f > l THEN hub END AS hub, CASE WHEN f > l THEN f END AS failed_at,
        CASE WHEN f > l AND hub[1] IN ('H', 'F', 'D', '4') THEN 'others' ELSE 'mm' END AS failed_for
    FROM (SELECT user_id, max(ts) FILTER (WHERE event_type = 'purchase') AS l, max(ts) FILTER (WHERE event_type = 'error') AS f,
        list_extract(['HA', 'SOCE', '4PL'], CAST(user_id % 3 + 1 AS INT)) AS hub FROM events GROUP BY user_id)""",
)
def _(spark, sf):
    kind = F.col("event_type")
    seen = E.milestones(
        events(spark, sf), {"l": E.last(kind == "purchase", "ts"), "f": E.last(kind == "error", "ts")}, "user_id", BY_TIME
    )
    hubs = F.array(F.lit("HA"), F.lit("SOCE"), F.lit("4PL"))
    hub = F.element_at(hubs, (F.col("user_id") % 3 + 1).cast("int"))
    logged, at, for_whom = R.later_failure(F.col("f.ts"), F.col("l.ts"), hub)
    return seen.select("user_id", logged.alias("hub"), at.alias("failed_at"), for_whom.alias("failed_for"))


@query(
    "operator_override",
    """SELECT event_id, CASE WHEN n_name IS NOT NULL THEN n_name WHEN event_type = 'click' THEN 'SOCE' ELSE o.station END AS station
    FROM events LEFT JOIN nation ON n_nationkey = CAST(json_extract_string(props, '$.k') AS INT)
    LEFT JOIN (SELECT s_suppkey, s_name AS station FROM supplier) o ON o.s_suppkey = user_id""",
)
def _(spark, sf):
    """An operator's usual station stands in where the event has none."""
    places = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("_place"))
    stations = read(spark, sf, "nation").select(F.col("n_nationkey").alias("_k"), "n_name")
    df = events(spark, sf).withColumn("_k", k()).join(stations, "_k", "left").join(places, "user_id", "left")
    station = R.apply_rules(
        [(F.col("n_name").isNotNull(), F.col("n_name")), (F.col("event_type") == "click", "SOCE")], F.col("_place")
    )
    return df.select("event_id", station.alias("station"))


# --- joins --------------------------------------------------------------------------------


@query(
    "status_dim_dedup",
    """SELECT e.event_id, d.name FROM events e LEFT JOIN (SELECT DISTINCT event_type, upper(event_type) AS name FROM events) d
    ON d.event_type = e.event_type""",
)
def _(spark, sf):
    source = events(spark, sf).select(
        F.col("event_type").alias("status"), F.upper("event_type").alias("status_name")
    )
    log = events(spark, sf).select("event_id", F.col("event_type").alias("status"))
    return log.join(status_dim(source), "status", "left").select("event_id", F.col("status_name").alias("name"))


@query(
    "role_joins",
    """SELECT c_custkey, o.n_name AS origin, d.n_name AS destination FROM customer
    LEFT JOIN nation o ON o.n_nationkey = c_nationkey LEFT JOIN nation d ON d.n_nationkey = c_custkey % 30""",
)
def _(spark, sf):
    nation = read(spark, sf, "nation")
    return (
        read(spark, sf, "customer")
        .withColumn("to_key", (F.col("c_custkey") % 30).cast("int"))
        .join(L.role(nation, "n_nationkey", {"n_name": "origin"}, "c_nationkey"), "c_nationkey", "left")
        .join(L.role(nation, "n_nationkey", {"n_name": "destination"}, "to_key"), "to_key", "left")
        .select("c_custkey", "origin", "destination")
    )


@query(
    "cast_key_join",
    """SELECT event_id, n_name FROM events LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = json_extract_string(props, '$.k')""",
)
def _(spark, sf):
    stations = read(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("_k"), "n_name")
    return (
        events(spark, sf)
        .withColumn("_k", jsontext.json_text("props", "k"))
        .join(stations, "_k", "left")
        .select("event_id", "n_name")
    )


@query(
    "substring_key_join",
    """SELECT c_custkey, r_name FROM customer LEFT JOIN region ON r_name[2:5] = substring(split_part('X' || r_hint, '-', 1), 3, 4)
    """.replace("FROM customer", "FROM (SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'ASIA-1' WHEN 'HOUSEHOLD' THEN 'EUROPE-2' ELSE 'NONE-3' END AS r_hint FROM customer)"),
)
def _(spark, sf):
    """The join key is a part of a name; the other side need not be unique."""
    hint = R.apply_rules(
        [(F.col("c_mktsegment") == "MACHINERY", "ASIA-1"), (F.col("c_mktsegment") == "HOUSEHOLD", "EUROPE-2")], "NONE-3"
    )
    regions = read(spark, sf, "region").select(text.district_code(F.col("r_name")).alias("_code"), "r_name")
    return (
        read(spark, sf, "customer")
        .withColumn("_code", text.district_code(hint))
        .join(regions, "_code", "left")
        .select("c_custkey", "r_name")
    )


@query(
    "semi_lookup",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')""",
)
def _(spark, sf):
    wanted = events(spark, sf).filter("event_type = 'purchase'").select(F.col("user_id").alias("o_custkey"))
    keys = L.as_keys(spark, wanted, "o_custkey")
    return L.keyed(read(spark, sf, "orders"), keys).select("o_orderkey", "o_totalprice")


@query(
    "value_list_match",
    """SELECT o_orderkey FROM orders WHERE o_orderpriority = ANY (VALUES ('1-URGENT'), ('2-HIGH')) AND o_orderstatus NOT IN ('F')""",
)
def _(spark, sf):
    inline = L.inline_table(spark, "o_orderpriority string", [("1-URGENT",), ("2-HIGH",)])
    rows = read(spark, sf, "orders").filter(~F.col("o_orderstatus").isin("F"))
    return rows.join(F.broadcast(inline), "o_orderpriority", "left_semi").select("o_orderkey")


@query(
    "not_in_null",
    """SELECT event_id FROM events WHERE nullif(event_type, 'error') NOT IN ('click', 'view')""",
)
def _(spark, sf):
    """A NULL is neither in nor outside a list."""
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    return events(spark, sf).filter(~kind.isin("click", "view")).select("event_id")


@query(
    "three_valued_logic",
    """SELECT o_orderkey, (t = '' OR s = 1) AS either, t <> 'TASK' AS differs, coalesce(t = '', FALSE) AS is_empty
    FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN 'TASK' END AS t, CAST(o_orderkey % 2 AS INT) AS s FROM orders)""",
)
def _(spark, sf):
    task = R.apply_rules([(F.col("o_orderstatus") == "F", ""), (F.col("o_orderstatus") == "O", "TASK")])
    s = F.col("o_orderkey") % 2
    return read(spark, sf, "orders").select(
        "o_orderkey",
        ((task == "") | (s == 1)).alias("either"),
        (task != "TASK").alias("differs"),
        F.when(task == "", True).otherwise(False).alias("is_empty"),
    )


@query(
    "left_join_made_inner",
    """SELECT o_orderkey, l_partkey, l_shipdate FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    WHERE l_shipdate IS NOT NULL AND o_orderstatus IS NOT NULL""",
)
def _(spark, sf):
    lines = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_shipdate")
    return read(spark, sf, "orders").filter("o_orderstatus IS NOT NULL").select("o_orderkey").join(
        lines.filter("l_shipdate IS NOT NULL"), "o_orderkey"
    )


@query(
    "fact_left_join",
    """SELECT o_orderkey, o_orderstatus, l_partkey, l_linenumber FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
)
def _(spark, sf):
    lines = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber")
    return read(spark, sf, "orders").select("o_orderkey", "o_orderstatus").join(lines, "o_orderkey", "left")


@query(
    "null_fallback",
    """SELECT o_orderkey, coalesce(s.s_name, 'Customer ' || c.c_nationkey) AS name FROM orders
    LEFT JOIN supplier s ON s.s_suppkey = o_custkey LEFT JOIN customer c ON c.c_custkey = o_custkey""",
)
def _(spark, sf):
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("o_custkey"), "s_name")
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    fallback = F.concat(F.lit("Customer "), F.col("c_nationkey").cast("string"))
    return (
        read(spark, sf, "orders").select("o_orderkey", "o_custkey").join(s, "o_custkey", "left").join(c, "o_custkey", "left")
        .select("o_orderkey", F.coalesce("s_name", fallback).alias("name"))
    )


# --- aggregates ---------------------------------------------------------------------------


@query(
    "pivot_counts",
    """SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS "Clicks", count(*) FILTER (WHERE event_type IN ('click', 'view')) AS "Looks Total",
        count(nullif(value > 100, FALSE)) FILTER (WHERE event_type = 'error') AS "Errors > 100", count(*) FILTER (WHERE event_type = 'none') AS "None"
    FROM events GROUP BY user_id""",
)
def _(spark, sf):
    kind = F.col("event_type")
    return M.pivot_counts(
        events(spark, sf),
        ["user_id"],
        {
            "Clicks": kind == "click",
            "Looks Total": kind.isin("click", "view"),
            "Errors > 100": (kind == "error") & (F.col("value") > 100),
            "None": kind == "none",
        },
    )


@query(
    "pivot_sums",
    f"""SELECT user_id, CAST(sum({K}) FILTER (WHERE event_type = 'click') AS BIGINT) AS k_click,
        CAST(sum({K}) FILTER (WHERE event_type = 'none') AS BIGINT) AS k_none FROM events GROUP BY user_id""",
)
def _(spark, sf):
    kind = F.col("event_type")
    return M.pivot_sums(events(spark, sf), ["user_id"], k(), {"k_click": kind == "click", "k_none": kind == "none"})


@query(
    "ratio_nan",
    """SELECT user_id, CAST(count(*) FILTER (WHERE event_type = 'click' AND value > 150) AS DOUBLE)
        / CAST(count(*) FILTER (WHERE event_type = 'view' AND value > 150) AS DOUBLE) AS share
    FROM events GROUP BY user_id""",
)
def _(spark, sf):
    big = F.col("value") > 150
    n = lambda kind: M.count_where((F.col("event_type") == kind) & big)
    return events(spark, sf).groupBy("user_id").agg(M.ratio(n("click"), n("view")).alias("share"))


@query(
    "avg_decimal",
    """SELECT l_returnflag, CAST(CAST(avg(l_linenumber) AS DECIMAL(38, 0)) AS BIGINT) AS avg_line, count(*) AS n FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    return (
        read(spark, sf, "lineitem")
        .groupBy("l_returnflag")
        .agg(F.avg("l_linenumber").cast("decimal(38,0)").cast("long").alias("avg_line"), F.count("*").alias("n"))
    )


@query(
    "counts_and_case_sums",
    """SELECT l_suppkey, count(*) AS n, count(nullif(l_returnflag, 'R')) AS kept, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
        CAST(count(*) - sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS diff
    FROM lineitem GROUP BY l_suppkey""",
)
def _(spark, sf):
    flag = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return (
        read(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.count("*").alias("n"),
            F.count(F.nullif(F.col("l_returnflag"), F.lit("R"))).alias("kept"),
            flag(F.col("l_returnflag") == "R").alias("returned"),
            (F.count("*") - flag(F.col("l_linestatus") == "F")).alias("diff"),
        )
    )


@query(
    "aggregate_by_group_key",
    """SELECT o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN count(*) FILTER (WHERE o_orderstatus = 'F')
        WHEN '2-HIGH' THEN count(*) FILTER (WHERE o_orderstatus = 'O') END AS picked, count(*) AS n FROM orders GROUP BY 1""",
)
def _(spark, sf):
    key = F.col("o_orderpriority")
    n = lambda s: M.count_where(F.col("o_orderstatus") == s)
    return (
        read(spark, sf, "orders")
        .groupBy("o_orderpriority")
        .agg(F.when(key == "1-URGENT", n("F")).when(key == "2-HIGH", n("O")).alias("picked"), F.count("*").alias("n"))
    )


@query(
    "group_expr",
    """SELECT DISTINCT CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE p_type END AS bucket, p_brand FROM part""",
)
def _(spark, sf):
    size = F.col("p_size")
    bucket = R.apply_rules([(size < 10, "small"), (size < 30, "medium")], F.col("p_type"))
    return read(spark, sf, "part").select(bucket.alias("bucket"), "p_brand").distinct()


@query(
    "distinct_dim",
    """SELECT c_custkey, d.seg FROM customer LEFT JOIN (SELECT DISTINCT c_nationkey, c_mktsegment AS seg FROM customer WHERE c_acctbal > 9000) d
    ON d.c_nationkey = customer.c_nationkey""",
)
def _(spark, sf):
    customer = read(spark, sf, "customer")
    rich = (
        customer.filter("c_acctbal > 9000").select("c_nationkey", F.col("c_mktsegment").alias("seg")).distinct()
    )
    return customer.select("c_custkey", "c_nationkey").join(rich, "c_nationkey", "left").select("c_custkey", "seg")


@query(
    "mixed_order",
    """SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1 DESC, 2""",
)
def _(spark, sf):
    return (
        read(spark, sf, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("day"), F.asc_nulls_last("o_orderpriority"))
    )


@query(
    "casts_and_literals",
    """SELECT *, 'SOCE' AS soc_station, CAST(round(c_acctbal) AS INT) AS whole, CAST(c_custkey AS VARCHAR) AS key_text,
        CAST(c_nationkey AS DOUBLE) AS nation_double, CASE WHEN c_acctbal > 0 THEN 'credit' END AS sign FROM customer""",
)
def _(spark, sf):
    return read(spark, sf, "customer").withColumns(
        {
            "soc_station": F.lit("SOCE"),
            "whole": F.round("c_acctbal").cast("int"),
            "key_text": F.col("c_custkey").cast("string"),
            "nation_double": F.col("c_nationkey").cast("double"),
            "sign": F.expr("if(c_acctbal > 0, 'credit', NULL)"),
        }
    )
