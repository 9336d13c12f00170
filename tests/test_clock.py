from datetime import date, datetime

from pyspark.sql import functions as F

from parcelspark.functions import clock
from tests.fixtures import OFFSET, at


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_event_time_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Asia/Bangkok", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            got = one(spark, clock.event_ts(F.lit(at("2024-03-10 02:30")).cast("long"), OFFSET))
            assert got == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_epoch_of_is_the_inverse_of_event_ts(spark):
    got = one(spark, clock.event_ts(F.lit(clock.epoch_of(date(2024, 2, 29), OFFSET, 6)), OFFSET))
    assert got == datetime(2024, 2, 29, 6)


def test_business_day_changes_exactly_at_its_hour(spark):
    cases = [
        ("2024-01-02 05:59:59", 6, date(2024, 1, 1)),
        ("2024-01-02 06:00:00", 6, date(2024, 1, 2)),
        ("2024-01-02 01:59:59", 2, date(2024, 1, 1)),
        ("2024-01-02 02:00:00", 2, date(2024, 1, 2)),
    ]
    for text, hours, expected in cases:
        assert one(spark, clock.business_day(ntz(text), hours)) == expected


def test_deadline_itself_is_on_time(spark):
    day = clock.day_lit(date(2024, 1, 1))
    assert one(spark, clock.on_time(ntz("2024-01-02 02:00:00"), day, 1, 2)) == "ontime"
    assert one(spark, clock.late(ntz("2024-01-02 02:00:00"), day, 1, 2)) is None
    assert one(spark, clock.on_time(ntz("2024-01-02 02:00:01"), day, 1, 2)) is None
    assert one(spark, clock.late(ntz("2024-01-02 02:00:01"), day, 1, 2)) == "late"
    assert one(spark, clock.on_time(F.lit(None).cast("timestamp_ntz"), day, 1, 2)) is None
    assert one(spark, clock.late(F.lit(None).cast("timestamp_ntz"), day, 1, 2)) is None


def test_elapsed_counts_whole_units_toward_zero(spark):
    assert one(spark, clock.elapsed("HOUR", ntz("2024-01-01 00:59"), ntz("2024-01-01 02:00"))) == 1
    assert one(spark, clock.elapsed("HOUR", ntz("2024-01-01 02:00"), ntz("2024-01-01 00:01"))) == -1


def test_aging_counts_both_ends(spark):
    assert one(spark, clock.aging_days(ntz("2024-01-30 23:59"), date(2024, 1, 31))) == 2


def test_iso_text_keeps_the_wall_clock(spark):
    assert one(spark, clock.iso_timestamp(F.lit("2024-01-01T10:00:00+07:00"))) == datetime(2024, 1, 1, 10)


def test_week_and_zero(spark):
    assert one(spark, clock.next_iso_week(ntz("2024-12-30 00:00"))) == 2
    assert one(spark, clock.zero_as_missing(F.lit(0))) is None
    assert one(spark, clock.zero_as_missing(F.lit(5))) == 5


def test_moment_is_taken_as_it_reads(spark):
    assert one(spark, clock.moment(datetime(2024, 1, 31, 9, 30, 0, 5))) == datetime(2024, 1, 31, 9, 30, 0, 5)
