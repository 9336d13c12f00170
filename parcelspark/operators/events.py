"""First, last, previous and next events of a shipment.

Picks are aggregates (`min_by` / `max_by`), not ranked windows: each task reduces a shipment to
one candidate before the shuffle, so that no task holds all events of a shipment, and any number
of picks shares one scan. A pick of more than the time sorts each task's rows by shipment first.

Events are ordered by (time, event id); the id breaks ties, so results are repeatable. An event
without a time comes after all others, forwards and backwards.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelspark.functions.clock import EPOCH
from parcelspark.operators.lookup import Keys, hashed, keyed

KEY = "shipment_id"
TIME = "ctime"
TIE = "event_id"


def with_tie_break(log: DataFrame, name: str = TIE) -> DataFrame:
    """Add an event id where the log has none: a hash of the whole row, so that a recomputed
    task gives the same order."""
    if name in log.columns:
        return log
    return log.withColumn(name, F.xxhash64(*[F.col(c) for c in log.columns]))


@dataclass(frozen=True)
class Pick:
    """One event per key: the earliest (or latest) for which `where` holds."""

    where: Column | None = None
    last: bool = False
    cols: tuple[str, ...] = (TIME,)


def first(where: Column | None = None, *cols: str) -> Pick:
    return Pick(where, False, cols or (TIME,))


def last(where: Column | None = None, *cols: str) -> Pick:
    return Pick(where, True, cols or (TIME,))


def _aggregate(pick: Pick, order: Sequence[str]) -> Column:
    time = order[0]
    wanted = F.lit(True) if pick.where is None else pick.where
    if tuple(pick.cols) == (time,):
        # The time alone needs no tie-break and fits a hash aggregate.
        extreme = F.max if pick.last else F.min
        at = extreme(F.when(wanted, F.col(time)))
        return F.when(at.isNotNull(), F.struct(at.alias(time)))
    by = F.max_by if pick.last else F.min_by
    return by(F.struct(*pick.cols), F.when(wanted, _ranked(order, pick.last)))


def _ranked(order: Sequence[str], is_last: bool) -> Column:
    """What the earliest (smallest) or latest (largest) is taken by: a row without a time comes after all others
    either way, and is picked only if there is no other."""
    time = F.col(order[0])
    return F.struct((time.isNotNull() if is_last else time.isNull()).alias("_known"), *order)


def _for_keys(df: DataFrame, only: Keys | None, reduce: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`reduce(df)` for the listed keys. Rows are matched before they are reduced: against the keys, or
    their hashes, where those are broadcast, so that each task reduces what it has read. Beyond
    that they are matched by shuffle, after which all rows of a key lie in one task: the keys with
    very many rows, few by arithmetic, are reduced first instead."""
    if only is None:
        return reduce(df)
    if only.few:
        return reduce(keyed(df, only))
    if only.hashes is not None:
        return reduce(hashed(df, only)).join(only.df, only.on, "left_semi")
    heavy = frequent(df, only.on, MAX_ROWS_PER_KEY)
    if heavy is None:
        return keyed(reduce(df), only)
    listed = [r[0] for r in heavy if r[0] is not None]
    if not listed:
        return reduce(keyed(df, only))
    is_heavy = F.coalesce(F.col(only.on).isin(listed), F.lit(False))
    return reduce(keyed(df.filter(~is_heavy), only)).unionByName(keyed(reduce(df.filter(is_heavy)), only))


def milestones(
    df: DataFrame,
    picks: Mapping[str, Pick],
    key: str = KEY,
    order: Sequence[str] = (TIME, TIE),
    only: Keys | None = None,
) -> DataFrame:
    """One row per key and one struct column per pick, from a single pass over `df`.
    A pick without an event is NULL."""
    columns = [_aggregate(p, order).alias(n) for n, p in picks.items()]
    return _for_keys(df, only, lambda rows: rows.groupBy(key).agg(*columns))


def _one_event(df, key, cols, order, where, only, is_last) -> DataFrame:
    names = tuple(c for c in (cols or df.columns) if c != key)
    rows = df if where is None else df.filter(where)
    picked = (F.max_by if is_last else F.min_by)(F.struct(*names), _ranked(order, is_last))
    reduced = _for_keys(rows, only, lambda r: r.groupBy(key).agg(picked.alias("_row")))
    return reduced.select(key, "_row.*")


def first_event(
    df: DataFrame,
    key: str = KEY,
    cols: Sequence[str] | None = None,
    order: Sequence[str] = (TIME, TIE),
    where: Column | None = None,
    then: Column | None = None,
    only: Keys | None = None,
) -> DataFrame:
    """The earliest row per key. `where` selects rows before the pick, `then` after it."""
    picked = _one_event(df, key, cols, order, where, only, False)
    return picked if then is None else picked.filter(then)


def latest_event(
    df: DataFrame,
    key: str = KEY,
    cols: Sequence[str] | None = None,
    order: Sequence[str] = (TIME, TIE),
    where: Column | None = None,
    then: Column | None = None,
    only: Keys | None = None,
) -> DataFrame:
    """The latest row per key. `where` selects rows before the pick, `then` after it."""
    picked = _one_event(df, key, cols, order, where, only, True)
    return picked if then is None else picked.filter(then)


def _plain_between(time: str) -> Callable[[int | None, int | None], Column]:
    return lambda begin, end: F.col(time) < end if begin is None else (F.col(time) >= begin) & (F.col(time) < end)


def found_in_window(
    counted: Callable[[DataFrame, str], tuple[DataFrame, Keys]],
    log: DataFrame,
    begin: int,
    end: int,
    cols: Sequence[str],
    where: Column | None = None,
    key: str = KEY,
    order: Sequence[str] = (TIME, TIE),
    between: Callable[[int | None, int | None], Column] | None = None,
) -> tuple[DataFrame, Keys]:
    """The earliest row of each key for which `where` holds, if its time lies in [begin, end); and a list of keys
    that has those found, and others with such a row in the window.

    The window reaches the scan of the columns wanted: only its rows are reduced and moved. They are kept (`counted`,
    as of `Tables`), and a second scan looks for earlier rows of their keys only: it reads the key, the time and what
    `where` needs, and drops what is not among the broadcast hashes of the keys before anything is moved. With too
    many hashes to broadcast, the distinct keys of all earlier rows are moved. NULL is a key like any other.
    `between` gives the condition of a window, by default on the time alone.
    """
    rows = log if where is None else log.filter(where)
    between = between or _plain_between(order[0])
    found, keys = counted(first_event(rows.filter(between(begin, end)), key, cols, order), key)
    before = hashed(rows.filter(between(None, begin)), keys, key).select(F.col(key).alias("_earlier")).distinct()
    return found.join(before, F.col(key).eqNullSafe(F.col("_earlier")), "left_anti"), keys


def first_event_in_window(
    log: DataFrame,
    begin: int,
    end: int,
    cols: Sequence[str],
    where: Column | None = None,
    key: str = KEY,
    order: Sequence[str] = (TIME, TIE),
) -> DataFrame:
    """The same in one lazy plan, which keeps nothing: the distinct keys of all earlier rows are moved."""
    uncounted = lambda found, on: (found, Keys(found.select(on), on, False))
    return found_in_window(uncounted, log, begin, end, cols, where, key, order)[0]


def event_before(
    log: DataFrame,
    targets: DataFrame,
    cols: Sequence[str],
    key: str = KEY,
    order: Sequence[str] = (TIME, TIE),
    max_targets: int = 16,
) -> DataFrame:
    """Key and order columns of each target event, with the `cols` of the event before it in struct `prev` (NULL if
    there is none).

    An as-of pick: the greatest (time, id) below the target's, by `max_by`, so that each task reduces the events it has
    read to one a target. An event meets every target of its key; keys with more targets than `max_targets` are
    windowed instead, and an event is never paired with more. Targets should be few, or kept. Rows that repeat an
    event id count as one event.
    """
    at = F.struct(*(part for c in order for part in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))))
    wanted = targets.select(key, *order).distinct()
    per_key = wanted.groupBy(key).agg(F.count("*").alias("_n"))
    is_few = F.col("_n") <= max_targets
    few = wanted.join(per_key.filter(is_few), key, "left_semi").select(key, at.alias("_at"))
    many = per_key.filter(~is_few).select(key)
    earlier = log.select(F.col(key).alias("_of"), at.alias("_when"), F.struct(*cols).alias("_row"))
    met = few.join(earlier, (F.col(key) == F.col("_of")) & (F.col("_when") < F.col("_at")), "left")
    back = [F.col(f"_at.{c}").alias(c) for c in order]
    picked = met.groupBy(key, "_at").agg(F.max_by("_row", "_when").alias("prev")).select(key, *back, "prev")
    if many.isEmpty():
        return picked
    crowded = neighbours(log.select(key, *dict.fromkeys((*order, *cols))).join(many, key, "left_semi"), before=cols, key=key, order=order)
    crowded = crowded.select(key, *order, "prev").join(
        wanted.select(F.col(key).alias("_of"), at.alias("_at")), (F.col(key) == F.col("_of")) & (at == F.col("_at")), "left_semi"
    )
    return picked.unionByName(crowded)


def latest_version(df: DataFrame, key: str, version: str) -> DataFrame:
    """All rows that carry the highest version of their key; ties are kept. Spark limits the
    ranked groups before the shuffle, so older versions are not moved."""
    w = Window.partitionBy(key).orderBy(F.col(version).desc_nulls_last())
    return (
        df.withColumn("_rank", F.rank().over(w))
        .filter((F.col("_rank") == 1) & F.col(version).isNotNull())
        .drop("_rank")
    )


# A key with more rows than this is cut into time slices before it is windowed.
MAX_ROWS_PER_KEY = 5_000_000
# Above this many such keys the slices are laid over every key instead of a list of them.
MAX_LISTED_KEYS = 1_000


# Keys that a task's sketch of frequent keys holds. It errs by this share of all rows at most, at twice which no
# frequent key is missed.
SKETCHED_KEYS, SKETCH_ERROR = 10_000, 3.5 / 16_384


def frequent(df: DataFrame, key: str, more_than: int) -> list | None:
    """(key, estimate) of every key with more than so many rows, and perhaps of others with nearly as many; None where
    a sketch cannot tell: very many rows beside `more_than`, or more than MAX_LISTED_KEYS such keys. One row a task
    is moved. NULL may be one of the keys."""
    sketch = F.expr(f"approx_top_k(`{key}`, {MAX_LISTED_KEYS + 1}, {SKETCHED_KEYS})")
    rows, top = df.agg(F.count("*"), sketch).first()
    if rows <= more_than:
        return []
    if more_than < 2 * SKETCH_ERROR * rows:
        return None
    found = [(r["item"], r["count"]) for r in top if r["count"] > more_than]
    return None if len(found) > MAX_LISTED_KEYS else found


def _is_one_of(key: str, values: list) -> Column:
    """Whether the key is one of the values, among which NULL may be."""
    found = F.coalesce(F.col(key).isin([v for v in values if v is not None]), F.lit(False))
    return found | F.col(key).isNull() if any(v is None for v in values) else found


def _slice(
    df: DataFrame, key: str, time: str, only: Keys | None, max_rows: int, slice_seconds: int | None
) -> tuple[Column, Column] | None:
    """None when no key is large, else the slice number and whether the key is cut: time slices for large keys (NULL
    may be one), 0 for the others. Slices are made narrow enough to hold `max_rows` rows on average, a second at least.
    A sketch of frequent keys says which keys to count; where it cannot tell, rows are counted per key. At most
    MAX_LISTED_KEYS + 1 keys reach the driver."""
    rows = df if only is None else keyed(df, only) if only.few else hashed(df, only)
    likely = frequent(rows, key, max_rows)
    if likely is not None and not likely:
        return None
    seconds = F.col(time)
    if dict(df.dtypes)[time].startswith("timestamp"):
        seconds = F.timestamp_diff("SECOND", F.expr(EPOCH), seconds)
    counts = (rows if likely is None else rows.filter(_is_one_of(key, [r[0] for r in likely]))).groupBy(key).agg(
        F.count("*").alias("n"), (F.max(seconds) - F.min(seconds) + 1).cast("double").alias("span")
    )
    width = F.greatest(F.lit(1).cast("long"), F.floor(F.col("span") * max_rows / F.col("n")))
    large = counts.filter(F.col("n") > max_rows).select(key, width.alias("width"))
    listed = large.limit(MAX_LISTED_KEYS + 1).collect()
    if not listed:
        return None
    too_many = len(listed) > MAX_LISTED_KEYS
    if slice_seconds is None:
        slice_seconds = large.agg(F.min("width")).first()[0] if too_many else min(r.width for r in listed)
    # Events without a time come last, as in the order of the window.
    by_time = F.coalesce(F.floor(seconds / slice_seconds), F.lit(2**62))
    if too_many:
        return by_time, F.lit(True)
    is_large = _is_one_of(key, [r[0] for r in listed])
    return F.when(is_large, by_time).otherwise(F.lit(0).cast("long")), is_large


def neighbours(
    df: DataFrame,
    before: Sequence[str] = (),
    after: Sequence[str] = (),
    key: str = KEY,
    order: Sequence[str] = (TIME, TIE),
    only: Keys | None = None,
    max_rows_per_key: int = MAX_ROWS_PER_KEY,
    slice_seconds: int | None = None,
) -> DataFrame:
    """Every row with the `before` columns of the event before it in struct `prev`, and the
    `after` columns of the event after it in struct `next` (NULL at the ends).

    One shuffle on the key when no key is large. A large key is windowed slice by slice, and
    the rows at the slice edges take their neighbour from the nearest slice that has rows: the
    result is the same, and no task holds more than one key's slice.
    """
    part = _slice(df, key, order[0], only, max_rows_per_key, slice_seconds)
    rows = df if only is None else keyed(df, only)
    if part is None:
        w = Window.partitionBy(key)
    else:
        # Stated, because rows already placed by key alone would otherwise stay where they are.
        number, is_cut = part
        rows = rows.withColumn("_slice", number).repartition(key, "_slice")
        w = Window.partitionBy(key, "_slice")
    w = w.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    out = rows
    if before:
        out = out.withColumn("prev", F.lag(F.struct(*before)).over(w))
    if after:
        out = out.withColumn("next", F.lead(F.struct(*after)).over(w))
    if part is None:
        return out

    at = F.struct(*order)
    ends = []
    if before:
        ends.append(F.max_by(F.struct(*before), at).alias("_tail"))
    if after:
        ends.append(F.min_by(F.struct(*after), at).alias("_head"))
    slices = Window.partitionBy(key).orderBy("_slice")
    edges = rows.filter(is_cut).groupBy(key, "_slice").agg(*ends)
    if before:
        edges = edges.withColumn("_tail", F.lag("_tail").over(slices))
    if after:
        edges = edges.withColumn("_head", F.lead("_head").over(slices))
    edges = edges.withColumnsRenamed({key: "_edge_key", "_slice": "_edge_slice"})
    same = F.col(key).eqNullSafe(F.col("_edge_key")) & (F.col("_slice") == F.col("_edge_slice"))
    out = out.join(edges, same, "left")
    if before:
        out = out.withColumn("prev", F.coalesce("prev", "_tail"))
    if after:
        out = out.withColumn("next", F.coalesce("next", "_head"))
    return out.drop("_slice", "_tail", "_head", "_edge_key", "_edge_slice")


def dwell_hours(
    ts: Column, next_ts: Column, status: Column, terminal: Sequence[int], now: Column
) -> Column:
    """Whole hours until the next event; an open last event runs until `now`."""
    gap = F.timestamp_diff("HOUR", ts, next_ts)
    return F.when(gap.isNull() & ~status.isin(*terminal), F.timestamp_diff("HOUR", ts, now)).otherwise(gap)


def effective_station(
    status: Column,
    station: Column,
    destination: Column,
    attempt_station: Column,
    at_destination: Sequence[int],
    at_attempt: Sequence[int],
) -> Column:
    """The station, as text, that answers for a shipment: its destination while it travels
    there, the station of the last attempt after a failed one, else where the event happened."""
    return (
        F.when(status.isin(*at_destination), destination)
        .when(status.isin(*at_attempt), attempt_station.cast("string"))
        .otherwise(station.cast("string"))
    )


__all__ = [
    "KEY", "TIE", "TIME", "Pick", "dwell_hours", "effective_station", "event_before", "first", "first_event",
    "first_event_in_window", "found_in_window", "frequent", "last", "latest_event", "latest_version", "milestones", "neighbours", "with_tie_break",
]
