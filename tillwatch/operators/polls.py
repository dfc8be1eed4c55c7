"""Reports that are asked for again and again: a poll reads what is new and merges it with what is settled.

``latest_by_key_polled`` keeps the newest value per key with a high-water mark. ``settled_hours`` keeps sums of settled days, by
hour, and reads the open day; rows that change a settled day later correct it, whatever they change.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.functions.clock import BUCKETS, DAY, NO_SHIFT, Span, instant, midnight, moved
from tillwatch.functions.numbers import money
from tillwatch.operators.cohort import Dims, entity_totals, named_dims
from tillwatch.operators.health import FIVE_MINUTES, baseline_and_judged, threshold_series
from tillwatch.sources.state import State

HOUR = timedelta(hours=1)


def latest_by_key_polled(
    fact: DataFrame,
    columns: Mapping[str, str],
    state: State,
    as_of: datetime,
    *,
    key: str = "mobile_operator",
    value: str = "vendor_name",
    order: str = "id",
    ts: str = "create_date",
    lateness: timedelta = DAY,
) -> DataFrame:
    """One wide row: per key the value of its latest row, as ``latest_by_key_pivot`` gives it.

    The state has one row per key. A poll reads the rows from the last poll's clock less ``lateness`` on, by which time
    every row has come in, and merges them: the larger order wins, so rows that are read again, or come in late with a
    smaller order than the mark, change nothing or what they have to. The first poll reads all.
    """
    wanted = list(dict.fromkeys(columns.values()))
    known = state.read()
    about = {"key": key, "value": value, "order": order, "ts": ts, "wanted": sorted(wanted)}
    rows = fact.filter(F.col(key).isin(*wanted) & F.col(order).isNotNull())
    fresh = known is None or {k: known[1].get(k) for k in about} != about
    if not fresh:
        mark = datetime.fromisoformat(known[1]["polled"])
        rows = rows.filter(Span(start=min(mark, as_of) - lateness).covers(ts))
    latest = rows.select(F.col(key).alias("key"), F.col(order).alias("order"), F.col(value).alias("value"))
    if not fresh:
        latest = latest.unionByName(known[0])
    # one candidate per key and task, and one row per wanted key in the end
    latest = latest.groupBy("key").agg(F.max("order").alias("order"), F.max_by("value", "order").alias("value"))
    kept = state.replace(latest.coalesce(1), about | {"polled": as_of.isoformat()})
    return kept.agg(*[F.max(F.when(F.col("key") == name, F.col("value"))).alias(column) for column, name in columns.items()])


def _whole_hour(at: datetime) -> datetime:
    return at.replace(minute=0, second=0, microsecond=0)


def settled_hours(
    fact: DataFrame,
    state: State,
    as_of: datetime,
    span: Span,
    sums: Mapping[str, Column],
    *,
    dims: Dims = (),
    where: Column | None = None,
    ts: str = "create_date",
    shift: timedelta = NO_SHIFT,
    settle: timedelta = HOUR,
    changed: str | None = None,
) -> DataFrame:
    """(key_day, key_hour, dims, sums) over the rows of ``span``; the caller adds them up as it needs them.

    A day is settled ``settle`` after its end. Its sums are stored once, by hour, and from then on its rows are not read
    again: a poll reads the open day, and the two hours that the span's ends may cut. The sums have to be such
    that adding them up is right (counts and sums). ``changed`` names the column that tells when a row was last written;
    days in which a row was written since the last poll (less ``settle``) are summed anew, so rows that come in late, and
    rows that get another status or amount, count as if all had been read. Without it settled days stay as they are.
    A state of other sums, dimensions or conditions is not used but replaced.
    """
    at = moved(ts, shift)
    named = named_dims(dims)
    rows = fact if where is None else fact.filter(where)

    def summed(part: DataFrame) -> DataFrame:
        keys = [BUCKETS["day"].key(at).alias("key_day"), BUCKETS["hour"].key(at).alias("key_hour")]
        return part.groupBy(*keys, *[c.alias(name) for name, c in named.items()]).agg(*[c.alias(name) for name, c in sums.items()])

    start, end = span.edges()
    first_day = None if start is None else midnight(start)
    open_at = midnight(as_of + shift - settle)
    kept = _settled_days(rows, state, as_of, summed, first_day, open_at, {
        "sums": {name: str(c) for name, c in sums.items()}, "dims": {name: str(c) for name, c in named.items()},
        "where": str(where), "ts": ts, "shift": str(shift)}, ts, shift, settle, changed)

    # whole hours of settled days come from the state, the rest of the span is read
    low = None if start is None else _whole_hour(start) + (HOUR if start > _whole_hour(start) else timedelta(0))
    if span.after is not None and low is not None and low == start:
        low = start + HOUR
    high = open_at if end is None else min(open_at, _whole_hour(end))
    if low is not None and low >= high:
        return summed(rows.filter(span.covers(ts, shift)))
    hour = F.col("key_day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("key_hour"))
    whole = kept.filter(Span(start=low, before=high).covers(hour))
    rest = Span(start=high).covers(ts, shift)
    if low is not None:
        rest = rest | Span(before=low).covers(ts, shift)
    return whole.unionByName(summed(rows.filter(span.covers(ts, shift) & rest)))


def _settled_days(
    rows: DataFrame, state: State, as_of: datetime, summed, first_day: datetime | None, open_at: datetime, what: dict,
    ts: str, shift: timedelta, settle: timedelta, changed: str | None,
) -> DataFrame:
    """The state's rows from ``first_day`` to ``open_at``, after newly settled and changed days have been summed."""
    known = state.read()
    if known is not None:
        about = known[1]
        since = None if about["first"] is None else datetime.fromisoformat(about["first"])
        reaches = since is None or (first_day is not None and since <= first_day)
        if about["what"] != what or not reaches or datetime.fromisoformat(about["open"]) > open_at:
            known = None
    spans = [Span(start=first_day, before=open_at)]
    redone: list[date] = []
    kept = None
    if known is not None:
        kept, about = known
        stored_to = datetime.fromisoformat(about["open"])
        if changed is not None:
            written = Span(start=datetime.fromisoformat(about["polled"]) - settle).covers(changed)
            late = rows.filter(written & Span(start=first_day, before=stored_to).covers(ts, shift))
            # at most the days of the span
            redone = [r["day"] for r in late.select(F.to_date(moved(ts, shift)).alias("day")).distinct().collect()]
        if stored_to == open_at and not redone:
            return kept
        spans = [Span(start=stored_to, before=open_at)] if stored_to < open_at else []
        for day in redone:
            begin = datetime.combine(day, datetime.min.time())
            spans.append(Span(start=begin, before=begin + DAY))
        kept = kept.filter(F.col("key_day") >= F.lit(first_day.date())) if first_day is not None else kept
        kept = kept.filter(~F.col("key_day").isin(*redone)) if redone else kept
    read = F.lit(False)
    for part in spans:
        read = read | part.covers(ts, shift)
    fresh = summed(rows.filter(read))
    first = None if first_day is None else first_day.isoformat()
    about = {"what": what, "first": first, "open": open_at.isoformat(), "polled": as_of.isoformat()}
    return state.replace(fresh if kept is None else kept.unionByName(fresh), about)


def threshold_vs_today_polled(
    fact: DataFrame,
    state: State,
    as_of: datetime,
    *,
    baseline_bad: Column,
    today_bad: Column | None = None,
    ts: str = "create_date",
    shift: timedelta = NO_SHIFT,
    weeks: int = 4,
    lag: timedelta = FIVE_MINUTES,
    day_lag: int = 0,
    zero_fill: bool = False,
    changed: str | None = None,
) -> DataFrame:
    """``threshold_vs_today`` for a report that is polled: the trailing weeks come from settled days."""
    today_bad = baseline_bad if today_bad is None else today_bad
    baseline, judged = baseline_and_judged(as_of, weeks, lag, day_lag)
    sums = {"bad": F.count_if(baseline_bad), "bad_today": F.count_if(today_bad)}
    hours = settled_hours(
        fact, state, as_of, baseline.hull(judged), sums, where=baseline_bad | today_bad, ts=ts, shift=shift, changed=changed,
    )
    # both spans end together, so the judged rows are those of the judged day
    on_day = F.col("key_day") == F.lit(judged.start.date())
    daily = hours.groupBy("key_hour", "key_day").agg(
        F.sum("bad").alias("bad"), F.coalesce(F.sum(F.when(on_day, F.col("bad_today"))), F.lit(0)).alias("bad_today")
    )
    return threshold_series(daily, baseline, zero_fill)


def cohort_with_entity_total_polled(
    fact: DataFrame, state: State, as_of: datetime, span: Span, entity: str, *, ts: str = "create_date", changed: str | None = None,
) -> DataFrame:
    """``cohort_with_entity_total`` for a report that is polled: days and totals are summed from settled days."""
    sums = {"txn_count": F.count("status"), "total_amount": F.sum(money("amount"))}
    hours = settled_hours(
        fact, state, as_of, span, sums, dims=(entity, "status"), where=F.col(entity).isNotNull(), ts=ts, changed=changed,
    )
    daily = hours.groupBy(BUCKETS["day"].label(F.col("key_day")).alias("day"), entity, "status").agg(
        F.sum("txn_count").alias("txn_count"), F.sum("total_amount").alias("total_amount")
    )
    return entity_totals(daily, entity)
