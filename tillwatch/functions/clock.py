"""The injected clock: time spans as plain bounds on a raw timestamp column.

A span is turned into ``ts >= literal AND ts <= literal`` on the *stored* column. A time-zone shift
moves the literals, not the column, so every span reaches the file scan as a pushed filter.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

NO_SHIFT = timedelta(0)
DAY = timedelta(days=1)


def instant(at: datetime) -> Column:
    """Literal without time zone; Spark widens it when the column carries one."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def midnight(at: datetime) -> datetime:
    return at.replace(hour=0, minute=0, second=0, microsecond=0)


def months_back(at: datetime, months: int = 1) -> datetime:
    """Same day and time, ``months`` earlier; clipped to the last day of a shorter month."""
    index = at.year * 12 + at.month - 1 - months
    year, month = divmod(index, 12)
    last_day = calendar.monthrange(year, month + 1)[1]
    return at.replace(year=year, month=month + 1, day=min(at.day, last_day))


def moved(ts: str | Column, shift: timedelta = NO_SHIFT) -> Column:
    column = F.col(ts) if isinstance(ts, str) else ts
    return column + F.lit(shift) if shift else column


@dataclass(frozen=True)
class Span:
    """Bounds on a timestamp: ``start <= t``, ``after < t``, ``t < before``, ``t <= upto``."""

    start: datetime | None = None
    after: datetime | None = None
    before: datetime | None = None
    upto: datetime | None = None

    def covers(self, ts: str | Column, shift: timedelta = NO_SHIFT) -> Column:
        """Predicate on the stored column, for times that are read as ``ts + shift``."""
        column = F.col(ts) if isinstance(ts, str) else ts
        held = F.lit(True)
        if self.start is not None:
            held = held & (column >= instant(self.start - shift))
        if self.after is not None:
            held = held & (column > instant(self.after - shift))
        if self.before is not None:
            held = held & (column < instant(self.before - shift))
        if self.upto is not None:
            held = held & (column <= instant(self.upto - shift))
        return held

    def settled(self, as_of: datetime, lag: timedelta) -> Span:
        """Leave out rows younger than ``lag``; their status may still change."""
        newest = as_of - lag
        return replace(self, upto=newest if self.upto is None else min(self.upto, newest))

    def edges(self) -> tuple[datetime | None, datetime | None]:
        """The lowest and the highest bound, whether the span holds them or not."""
        low = self.start if self.after is None else max(self.start or self.after, self.after)
        ends = [end for end in (self.before, self.upto) if end is not None]
        return low, min(ends) if ends else None

    def hull(self, other: Span) -> Span:
        """One span around both, to read two overlapping spans in a single scan."""
        lows, highs = zip(self.edges(), other.edges(), strict=True)
        return Span(
            start=None if None in lows else min(lows),
            upto=None if None in highs else max(highs),
        )


EVER = Span()


def today(as_of: datetime) -> Span:
    return days_back(as_of, 0)


def days_back(as_of: datetime, days: int) -> Span:
    """Exactly the calendar day ``days`` before ``as_of``."""
    start = midnight(as_of) - days * DAY
    return Span(start=start, before=start + DAY)


def since_day(as_of: datetime, days: int = 0) -> Span:
    """From the midnight ``days`` before ``as_of``, without an upper end."""
    return Span(start=midnight(as_of) - days * DAY)


def through_day(span: Span, as_of: datetime, days: int) -> Span:
    """``span`` up to and including the calendar day ``days`` before ``as_of``."""
    return replace(span, before=midnight(as_of) - (days - 1) * DAY)


def rolling(as_of: datetime, kind: str, days: int = 30) -> Span:
    """Trailing range. The kinds differ only at the old edge:

    ``date_after_instant``  the row's date, as midnight, is not before the instant ``days`` ago, so
                            the oldest day is left out unless ``as_of`` is itself a midnight;
    ``dates``               ``days + 1`` whole calendar days (``day_start`` is the same bound);
    ``instant``             not before the instant ``days`` ago;
    ``calendar_month``      not before the same day and time one month earlier.
    """
    if kind == "date_after_instant":
        edge = as_of - days * DAY
        first = midnight(edge)
        return Span(start=first if first == edge else first + DAY)
    if kind in ("dates", "day_start"):
        return since_day(as_of, days)
    if kind == "instant":
        return Span(start=as_of - days * DAY)
    if kind == "calendar_month":
        return Span(start=months_back(as_of))
    raise ValueError(f"unknown range kind: {kind}")


def yesterday(as_of: datetime) -> Span:
    """Yesterday up to 23:59:59 sharp; the last fraction of a second is not part of it."""
    day = midnight(as_of)
    return Span(start=day - DAY, upto=day - timedelta(seconds=1))


def last_days(as_of: datetime, first: int, last: int) -> Span:
    """Whole calendar days from ``first`` to ``last`` days ago, both included."""
    return through_day(since_day(as_of, first), as_of, last)


def previous_week(as_of: datetime) -> Span:
    """The last full week before ``as_of``; weeks start on Sunday."""
    this_week = midnight(as_of) - ((as_of.weekday() + 1) % 7) * DAY
    return Span(start=this_week - 7 * DAY, before=this_week)


def previous_month(as_of: datetime) -> Span:
    this_month = midnight(as_of).replace(day=1)
    return Span(start=months_back(this_month), before=this_month)


@dataclass(frozen=True)
class Bucket:
    """A time bucket: grouped by a narrow key, written as text only after the aggregation."""

    key: object
    label: object


BUCKETS = {
    "hour": Bucket(F.hour, lambda key: F.lpad(key.cast("string"), 2, "0")),
    "day": Bucket(F.to_date, lambda key: key.cast("string")),
    "hour_number": Bucket(F.hour, lambda key: key),
}


def bucket_text(bucket: str, ts: str | Column, shift: timedelta = NO_SHIFT) -> Column:
    """The label of one row, for reports that list rows instead of grouping them."""
    rule = BUCKETS[bucket]
    return rule.label(rule.key(moved(ts, shift)))


def text_may_lie_in(text: str | Column, span: Span, most: int = 70) -> Column:
    """Plain comparisons that every text of a time in ``span`` meets; texts that meet them still have to be read.

    Texts that start with the year sort by it, so each day (in longer spans month or year) is a range of texts, with
    and without leading zeros. Texts that start otherwise (blanks, a sign, more zeros) may be any time and are all
    let through; they sort before ``1`` or after the digits. Such comparisons are pushed into the file scan.
    """
    column = F.col(text) if isinstance(text, str) else text
    low, high = span.edges()
    if low is None or high is None or high < low or high.year > 9999 or low.year < 1000:
        return F.lit(True)
    ranges: list[tuple[str, str]] = []
    if (high - low) / DAY <= most:
        for n in range((midnight(high) - midnight(low)) // DAY + 1):
            day = midnight(low) + n * DAY
            for month in {f"{day.month:02d}", str(day.month)}:
                ranges += [_texts_from(f"{day.year}-{month}-{number}") for number in {f"{day.day:02d}", str(day.day)}]
                if day.day == 1:  # a month alone is its first day, and a year alone too
                    ranges.append((f"{day.year}-{month}", f"{day.year}-{month}-"))
            if day.day == day.month == 1:
                ranges.append((f"{day.year}", f"{day.year}-"))
    else:
        ranges = [_texts_from(f"{year}") for year in range(low.year, high.year + 1)]
    held = (column < F.lit("1")) | (column >= F.lit("\x7f"))
    reached = ""
    for first, below in sorted(ranges):
        if below > reached:
            held, reached = held | ((column >= F.lit(first)) & (column < F.lit(below))), below
    return held


def _texts_from(prefix: str) -> tuple[str, str]:
    """The first text with the prefix, and the first one after all of them."""
    return prefix, prefix[:-1] + chr(ord(prefix[-1]) + 1)
