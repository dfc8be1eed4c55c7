"""Service health: today's outcome next to the success rate of the last half hour."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.functions import fixed_values as fixed
from tillwatch.functions.classify import health_of_count, health_of_rate, response_status
from tillwatch.functions.clock import BUCKETS, NO_SHIFT, Span, days_back, midnight, moved, today
from tillwatch.functions.numbers import MONEY, money, percent, total_where, whole_part
from tillwatch.functions.text import two_decimals
from tillwatch.sources.reports import label_union, with_grouped_digits

FIVE_MINUTES = timedelta(minutes=5)
HALF_HOUR = timedelta(minutes=30)
THREE_MINUTES = timedelta(minutes=3)


def threshold_vs_today(
    fact: DataFrame,
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
) -> DataFrame:
    """Per hour of day: the mean daily number of bad rows in the trailing weeks, and today's number.

    Both series come from one scan and one shuffle of daily counts. The mean covers the days that
    have a bad row in that hour, unless ``zero_fill`` divides by all days of the range. ``day_lag``
    moves the judged day back and ends the baseline with that day, instead of ``lag`` before now.
    """
    today_bad = baseline_bad if today_bad is None else today_bad
    baseline, judged = baseline_and_judged(as_of, weeks, lag, day_lag)
    in_baseline = baseline.covers(ts, shift) & baseline_bad
    in_today = judged.covers(ts, shift) & today_bad
    at = moved(ts, shift)
    hour = BUCKETS["hour"]
    daily = (
        fact.filter(baseline.hull(judged).covers(ts, shift))
        .filter(in_baseline | in_today)
        .groupBy(hour.key(at).alias("key_hour"), F.to_date(at).alias("key_day"))
        .agg(F.count_if(in_baseline).alias("bad"), F.count_if(in_today).alias("bad_today"))
    )
    return threshold_series(daily, baseline, zero_fill)


def baseline_and_judged(as_of: datetime, weeks: int, lag: timedelta, day_lag: int) -> tuple[Span, Span]:
    """The trailing weeks, and the day that is compared with them; both end together."""
    oldest = Span(start=as_of - timedelta(weeks=weeks))
    judged = days_back(as_of, day_lag)
    if day_lag:
        return Span(start=oldest.start, before=judged.before), judged
    return oldest.settled(as_of, lag), judged.settled(as_of, lag)


def threshold_series(daily: DataFrame, baseline: Span, zero_fill: bool) -> DataFrame:
    """The two series from (key_hour, key_day, bad, bad_today), one row per hour and day."""
    hour = BUCKETS["hour"]
    days = F.count_if(F.col("bad") > 0)
    if zero_fill:
        last = baseline.before - timedelta(microseconds=1) if baseline.before else baseline.upto
        days = F.lit((midnight(last) - midnight(baseline.start)).days + 1)
    hourly = daily.groupBy("key_hour").agg(
        F.when(
            F.sum("bad") > 0,
            F.round(
                F.try_divide(F.sum("bad").cast("decimal(20,0)"), days.cast("decimal(20,0)")), 2
            ),
        ).alias("mean"),
        F.nullif(F.sum("bad_today"), F.lit(0)).alias("now"),
    )
    series = F.array(
        F.struct(
            F.lit(fixed.BASELINE_SERIES).alias("txn"), F.col("mean").cast("double").alias("txn_count")
        ),
        F.struct(
            F.lit(fixed.TODAY_SERIES).alias("txn"), F.col("now").cast("double").alias("txn_count")
        ),
    )
    return (
        hourly.select(hour.label(F.col("key_hour")).alias("hour"), F.explode(series).alias("s"))
        .select("hour", "s.*")
        .filter(F.col("txn_count").isNotNull())
    )


@dataclass(frozen=True)
class Roles:
    """What a service calls a success, a reversal and so on. Free predicates: they may overlap, and a
    row may be in none. ``hits`` of ``attempts`` give the success rate."""

    success: Column
    reverse: Column
    failed: Column
    dispute: Column
    hits: Column | None = None
    attempts: Column | None = None


def status_roles(
    success: Sequence[str] = ("SUCCESS",),
    reverse: Sequence[str] = ("REVERSE",),
    failed: Sequence[str] | Column = ("FAILED",),
    dispute: Column | None = None,
    hits: Column | None = None,
    attempts: Column | None = None,
) -> Roles:
    """Roles by status. A dispute is any status not listed, unless ``dispute`` says otherwise."""
    status = F.col("status")
    if isinstance(failed, Column):
        if dispute is None:
            raise ValueError("a condition for failed rows needs one for disputes")
        failed_rows, listed = failed, ()
    else:
        failed_rows, listed = status.isin(*failed), (*success, *reverse, *failed)
    return Roles(
        success=status.isin(*success),
        reverse=status.isin(*reverse),
        failed=failed_rows,
        dispute=~status.isin(*listed) if dispute is None else dispute,
        hits=hits,
        attempts=attempts,
    )


def service_health(
    fact: DataFrame,
    as_of: datetime,
    roles: Roles,
    *,
    where: Column | None = None,
    by: str | None = None,
    members: Sequence[str] = (),
    ts: str = "create_date",
    amount: str = "amount",
    shift: timedelta = NO_SHIFT,
    window: timedelta = HALF_HOUR,
    lag: timedelta = THREE_MINUTES,
    today_lag: timedelta | None = None,
    low: int = 30,
    high: int = 70,
    keep_empty: bool = True,
) -> DataFrame:
    """Today's counts and amount, and the success rate of the last ``window``, in a single pass.

    The day and the window overlap, so one scan feeds conditional aggregates for both. With ``by``
    the services share a table and one scan serves all ``members``; a member without rows still has
    its row. ``keep_empty=False`` drops a service without rows today.
    """
    day = today(as_of).settled(as_of, lag if today_lag is None else today_lag)
    recent = Span(start=as_of - window).settled(as_of, lag)
    rows = fact.filter(day.hull(recent).covers(ts, shift))
    if where is not None:
        rows = rows.filter(where)
    if by is not None:
        rows = rows.filter(F.col(by).isin(*members))

    aggregates = _measures(roles, day.covers(ts, shift), recent.covers(ts, shift), moved(ts, shift), amount)
    if by is None:
        measured = rows.agg(*aggregates)
    else:
        names = F.explode(F.array(*[F.lit(member) for member in members])).alias(by)
        listed = fact.sparkSession.range(0, 1, 1, 1).select(names)
        measured = listed.join(rows.groupBy(by).agg(*aggregates), by, "left")
    if not keep_empty:
        measured = measured.filter(F.col("day_rows") > 0)

    return measured.select(*([by] if by else []), *_board_columns(as_of, F.col, low, high))


def _measures(roles: Roles, in_day: Column, in_window: Column, time: Column, amount: str) -> list[Column]:
    hits = roles.success if roles.hits is None else roles.hits
    attempts = in_window if roles.attempts is None else in_window & roles.attempts
    return [
        F.max(F.when(in_day & roles.success, time)).alias("last_success"),
        F.count_if(in_day & roles.success).alias("success"),
        F.count_if(in_day & roles.reverse).alias("reverse"),
        F.count_if(in_day & roles.failed).alias("failed"),
        F.count_if(in_day & roles.dispute).alias("dispute"),
        total_where(money(amount), in_day & roles.success).alias("amount"),
        F.count_if(in_window & hits).alias("hits"),
        F.count_if(attempts).alias("attempts"),
        F.count_if(in_day).alias("day_rows"),
    ]


def _board_columns(as_of: datetime, measure: Callable[[str], Column], low: int, high: int) -> list[Column]:
    def number(name: str) -> Column:
        return F.coalesce(measure(name), F.lit(0)).alias(name)

    rate = percent(measure("hits"), measure("attempts"))
    rate_text = F.concat(two_decimals(rate), F.lit("%"))
    return [
        F.lit(as_of.date().isoformat()).cast("date").alias("date"),
        F.coalesce(F.date_format(measure("last_success"), "HH:mm"), F.lit("00:00")).alias("last_success_time"),
        *[number(name) for name in ("success", "reverse", "failed", "dispute")],
        F.coalesce(whole_part(measure("amount")), F.lit(0)).alias("success_amount"),
        health_of_rate(rate, low, high).alias("health"),
        F.coalesce(rate_text, F.lit("0%")).alias("success_rate"),
    ]


@dataclass(frozen=True)
class Service:
    """One of several services in the same table, with the options of ``service_health``."""

    roles: Roles
    where: Column | None = None
    window: timedelta = HALF_HOUR
    today_lag: timedelta | None = None
    low: int = 30
    high: int = 70
    keep_empty: bool = True


def services_health(
    fact: DataFrame,
    as_of: datetime,
    services: Mapping[str, Service],
    *,
    ts: str = "create_date",
    amount: str = "amount",
    shift: timedelta = NO_SHIFT,
    lag: timedelta = THREE_MINUTES,
) -> DataFrame:
    """``service_health`` of several services of one table, each in its row with its name in ``service``.

    All are measured in one scan without a shuffle of rows: services may overlap, and a row counts for each of
    its services. The scan is bounded by the day and the widest window, and by the services' conditions
    where every service has one.
    """
    days = {name: today(as_of).settled(as_of, lag if one.today_lag is None else one.today_lag) for name, one in services.items()}
    recent = {name: Span(start=as_of - one.window).settled(as_of, lag) for name, one in services.items()}
    hull = reduce(Span.hull, [*days.values(), *recent.values()])
    rows = fact.filter(hull.covers(ts, shift))
    conditions = [one.where for one in services.values()]
    if all(condition is not None for condition in conditions):
        rows = rows.filter(reduce(Column.__or__, conditions))

    measured = []
    for name, one in services.items():
        own = F.lit(True) if one.where is None else one.where
        in_day, in_window = own & days[name].covers(ts, shift), own & recent[name].covers(ts, shift)
        parts = _measures(one.roles, in_day, in_window, moved(ts, shift), amount)
        measured.append(F.struct(*parts).alias(f"service {len(measured)}"))
    lines = []
    for n, (name, one) in enumerate(services.items()):
        of = F.col(f"service {n}")
        line = F.struct(F.lit(name).alias("service"), *_board_columns(as_of, of.getField, one.low, one.high))
        lines.append(line if one.keep_empty else F.when(of["day_rows"] > 0, line))
    return rows.agg(*measured).select(F.inline(F.array_compact(F.array(*lines))))


def log_service_health(
    log: DataFrame,
    as_of: datetime,
    *,
    where: Column | None = None,
    ts: str = "create_date",
    amount_path: str = "$.amount",
    window: timedelta = HALF_HOUR,
    lag: timedelta = THREE_MINUTES,
) -> DataFrame:
    """Health of a service known only by its response texts; judged by the number of recent successes.

    ``where`` limits today's rows; the recent successes are counted over the whole log. No row when
    nothing was logged today.
    """
    day = today(as_of)
    recent = Span(start=as_of - window).settled(as_of, lag)
    response = F.col("response")
    rows = (
        log.filter(day.hull(recent).covers(ts))
        .withColumn("outcome", response_status(response, F.lit("FAILED")))
        .withColumn("paid", F.get_json_object(response, amount_path).try_cast(MONEY))
    )
    in_day = day.covers(ts) if where is None else day.covers(ts) & where
    outcome = F.col("outcome")
    success = in_day & (outcome == "SUCCESS")
    measured = rows.agg(
        F.max(F.when(success, F.col(ts))).alias("last_success"),
        F.count_if(success).alias("success"),
        F.count_if(in_day & (outcome == "REVERSED")).alias("reverse"),
        F.count_if(in_day & ~outcome.isin("SUCCESS", "REVERSED")).alias("failed"),
        F.sum(
            F.when(success, F.col("paid")).when(in_day, F.lit(0).cast(MONEY))
        ).alias("amount"),
        F.count_if(in_day).alias("day_rows"),
        F.count_if(recent.covers(ts) & (outcome == "SUCCESS")).alias("recent"),
    ).filter(F.col("day_rows") > 0)
    # A rate below one percent is written without its leading zero.
    rate = F.regexp_replace(two_decimals(percent(F.col("success"), F.col("day_rows"))), r"^0\.", ".")
    return measured.select(
        F.lit(as_of.date().isoformat()).cast("date").alias("date"),
        F.coalesce(F.date_format("last_success", "HH:mm"), F.lit("00:00")).alias("last_success_time"),
        "success",
        "reverse",
        "failed",
        F.lit(0).cast("bigint").alias("dispute"),
        F.round("amount", 0).cast("bigint").alias("success_amount"),
        health_of_count(F.col("recent")).alias("health"),
        F.concat(rate, F.lit("%")).alias("success_rate"),
    )


def health_board(services: Mapping[str, DataFrame], by: str | None = None) -> DataFrame:
    """One board over all services, amounts with thousands separators.

    A part that still carries a ``by`` column holds several services; its label becomes
    ``name (member)``. A part with a ``service`` column brings the names itself.
    """
    parts = {}
    for name, part in services.items():
        if "service" in part.columns:
            part = part.select(F.col("service").alias("member"), *[c for c in part.columns if c != "service"])
        elif by is not None and by in part.columns:
            member = F.concat(F.lit(f"{name} ("), F.col(by), F.lit(")"))
            part = part.select(member.alias("member"), *[c for c in part.columns if c != by])
        else:
            part = part.select(F.lit(name).alias("member"), "*")
        parts[name] = part
    board = label_union(parts, "part").drop("part").withColumnRenamed("member", "service")
    return with_grouped_digits(board, "success_amount")
