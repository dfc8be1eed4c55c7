from datetime import datetime, timedelta

import pytest

from conftest import AS_OF, at, rows
from tillwatch.functions import clock


def held(frame, span, texts, **options):
    df = frame("t ts", [(at(text),) for text in texts])
    return [str(row[0]) for row in rows(df.filter(span.covers("t", **options)))]


def test_the_five_range_kinds_differ_at_the_old_edge(frame):
    times = [
        "2024-02-29 00:00:00", "2024-02-29 18:29:59", "2024-02-29 18:30:00", "2024-03-01 00:00:00",
        "2024-03-01 18:29:59.999999", "2024-03-01 18:30:00", "2024-03-02 00:00:00",
    ]

    def kept(kind, days=30):
        return len(held(frame, clock.rolling(AS_OF, kind, days), times))

    assert kept("date_after_instant") == 1  # the 30th day back, 1 March, starts before 18:30
    assert kept("dates") == 4
    assert kept("day_start") == 4
    assert kept("instant") == 2
    assert kept("calendar_month") == 5  # 31 March less a month is 29 February, same time


def test_date_after_instant_keeps_the_oldest_day_at_midnight():
    midnight = datetime(2024, 3, 31)
    assert clock.rolling(midnight, "date_after_instant").start == datetime(2024, 3, 1)
    later = midnight + timedelta(seconds=1)
    assert clock.rolling(later, "date_after_instant").start == datetime(2024, 3, 2)


def test_unknown_range_kind_is_refused():
    with pytest.raises(ValueError):
        clock.rolling(AS_OF, "decade")


def test_settle_lag_keeps_its_edge(frame):
    span = clock.today(AS_OF).settled(AS_OF, timedelta(minutes=5))
    times = ["2024-03-30 23:59:59.999999", "2024-03-31 00:00:00", "2024-03-31 18:25:00",
             "2024-03-31 18:25:00.000001"]
    assert held(frame, span, times) == ["2024-03-31 00:00:00", "2024-03-31 18:25:00"]


def test_a_shift_moves_the_bounds_not_the_column(frame):
    span = clock.today(AS_OF)
    times = ["2024-03-30 17:59:59", "2024-03-30 18:00:00", "2024-03-31 17:59:59", "2024-03-31 18:00:00"]
    six = timedelta(hours=6)
    assert held(frame, span, times, shift=six) == ["2024-03-30 18:00:00", "2024-03-31 17:59:59"]


def test_yesterday_loses_its_last_fraction(frame):
    times = ["2024-03-29 23:59:59", "2024-03-30 00:00:00", "2024-03-30 23:59:59",
             "2024-03-30 23:59:59.500000", "2024-03-31 00:00:00"]
    assert held(frame, clock.yesterday(AS_OF), times) == ["2024-03-30 00:00:00", "2024-03-30 23:59:59"]


def test_previous_week_starts_on_sunday():
    sunday = datetime(2024, 3, 31, 9)
    assert clock.previous_week(sunday) == clock.Span(
        start=datetime(2024, 3, 24), before=datetime(2024, 3, 31)
    )
    saturday = datetime(2024, 3, 30, 9)
    assert clock.previous_week(saturday).start == datetime(2024, 3, 17)


def test_previous_month_of_january_is_december():
    assert clock.previous_month(datetime(2024, 1, 31, 5)) == clock.Span(
        start=datetime(2023, 12, 1), before=datetime(2024, 1, 1)
    )


def test_months_back_clips_to_the_month_end():
    assert clock.months_back(datetime(2023, 3, 31, 1, 2)) == datetime(2023, 2, 28, 1, 2)
    assert clock.months_back(datetime(2024, 1, 15)) == datetime(2023, 12, 15)
    assert clock.months_back(datetime(2024, 12, 31), 1) == datetime(2024, 11, 30)


def test_whole_days_ago(frame):
    times = [f"2024-03-{day} {clock_time}" for day in (27, 28, 30, 31)
             for clock_time in ("00:00:00", "23:59:59")]
    span = clock.last_days(AS_OF, 3, 1)
    assert held(frame, span, times) == [
        "2024-03-28 00:00:00", "2024-03-28 23:59:59", "2024-03-30 00:00:00", "2024-03-30 23:59:59",
    ]


def test_hull_covers_both_spans():
    lag = timedelta(minutes=3)
    just_after_midnight = datetime(2024, 3, 31, 0, 10)
    day = clock.today(just_after_midnight).settled(just_after_midnight, lag)
    recent = clock.Span(start=just_after_midnight - timedelta(minutes=30)).settled(
        just_after_midnight, lag
    )
    both = day.hull(recent)
    assert both == clock.Span(start=datetime(2024, 3, 30, 23, 40), upto=datetime(2024, 3, 31, 0, 7))
    assert clock.EVER.hull(day) == clock.Span(upto=None)


def test_null_times_are_in_no_span_but_ever(frame):
    df = frame("t ts", [(None,)])
    assert df.filter(clock.today(AS_OF).covers("t")).count() == 0
    assert df.filter(clock.EVER.covers("t")).count() == 1


def test_bucket_labels(frame):
    df = frame("t ts", [(at("2024-03-01 03:59:59"),), (None,)])
    labels = df.select(
        clock.bucket_text("hour", "t"), clock.bucket_text("day", "t"),
        clock.bucket_text("day", "t", timedelta(hours=-6)), clock.bucket_text("hour_number", "t"),
    )
    assert rows(labels) == [("03", "2024-03-01", "2024-02-29", 3), (None, None, None, None)]
