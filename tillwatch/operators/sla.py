"""Growth, daily totals and weekly satisfaction over several services."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwatch.functions.clock import NO_SHIFT, Span
from tillwatch.functions.numbers import money, percent
from tillwatch.operators.cohort import status_cohort


def daily_growth(
    fact: DataFrame, span: Span, *, per_status: bool = False, ts: str = "create_date"
) -> DataFrame:
    """Amount growth in percent against the previous row, 0 where there is none to compare with.

    Rows are days x statuses in that order, so the previous row may be another status of the same
    day; ``per_status`` compares with the previous day of the same status instead. The previous row
    is found inside the day, or is the last row of the day before: the only window without a key
    runs over one row per day.
    """
    daily = status_cohort(
        fact, span, "day", ts=ts, counted="status", amount_name="total_amount"
    )
    total = F.col("total_amount")
    if per_status:
        before = F.lag("total_amount").over(Window.partitionBy("status").orderBy("day"))
        compared = daily.withColumn("before", before)
    else:
        in_day = Window.partitionBy("day").orderBy(F.asc_nulls_last("status"))
        # Whole rows are compared, so both branches need the same columns and share one shuffle.
        last = F.max(F.struct(F.col("status").isNull(), "status", "total_amount", "txn_count"))
        days = daily.groupBy("day").agg(last.alias("last"))
        before_day = F.lag(F.col("last.total_amount")).over(Window.orderBy("day"))
        days = days.select("day", before_day.alias("day_before"))
        placed = daily.withColumns(
            {"place": F.row_number().over(in_day), "in_day": F.lag("total_amount").over(in_day)}
        )
        before = F.when(F.col("place") == 1, F.col("day_before")).otherwise(F.col("in_day"))
        compared = placed.join(days, "day", "left").withColumn("before", before)
    change = (total - F.col("before")).cast("decimal(24,2)") * F.lit(100)
    growth = F.when(F.coalesce(F.col("before"), F.lit(0)) == 0, F.lit(0)).otherwise(
        F.round(F.try_divide(change, F.col("before").cast("decimal(22,2)")), 2)
    )
    return compared.select(
        "day", "status", "txn_count", "total_amount", growth.alias("total_amount_growth")
    )


@dataclass(frozen=True)
class ServiceTotal:
    """What counts for one service: its table, rows and time span."""

    name: str
    fact: DataFrame
    span: Span
    where: Column | None = None
    ts: str = "create_date"
    shift: timedelta = NO_SHIFT

    def rows(self) -> Column:
        held = self.span.covers(self.ts, self.shift)
        return held if self.where is None else held & self.where


def daily_service_totals(services: Sequence[ServiceTotal]) -> DataFrame:
    """Count and amount per service; a service without rows has count 0 and no amount.

    Services on the same table share one scan, each with its own conditional aggregates.
    """
    tables: dict[int, list[ServiceTotal]] = {}
    for service in services:
        tables.setdefault(id(service.fact), []).append(service)
    parts = []
    for group in tables.values():
        aggregates, rows = [], []
        for n, service in enumerate(group):
            held = service.rows()
            aggregates += [
                F.count_if(held).alias(f"count_{n}"),
                F.sum(F.when(held, money("amount"))).alias(f"amount_{n}"),
            ]
            rows.append(
                F.struct(
                    F.lit(service.name).alias("service"),
                    F.col(f"count_{n}").alias("txn_count"),
                    F.col(f"amount_{n}").alias("total_amount"),
                )
            )
        anyone = reduce(lambda a, b: a | b, [service.rows() for service in group])
        hull = _hull([(service.span, service.ts, service.shift) for service in group])
        wide = group[0].fact.filter(hull).filter(anyone).agg(*aggregates)
        parts.append(wide.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def _hull(spans: Sequence[tuple[Span, str, timedelta]]) -> Column:
    """Plain bounds around the spans of one table, for the scan: an OR of conditions prunes nothing.

    Spans on different columns have no common bound.
    """
    if len({ts for _, ts, _ in spans}) > 1:
        return F.lit(True)

    def stored(span: Span, shift: timedelta) -> Span:
        ends = {name: getattr(span, name) for name in ("start", "after", "before", "upto")}
        return Span(**{name: end if end is None else end - shift for name, end in ends.items()})

    return reduce(Span.hull, [stored(span, shift) for span, _, shift in spans]).covers(spans[0][1])


@dataclass(frozen=True)
class Satisfaction:
    """How one service of a family is judged: which rows are attempts and which went well."""

    family: str
    fact: DataFrame
    service: Column
    satisfied: Column
    where: Column | None = None
    attempt: Column | None = None
    ts: str = "create_date"
    shift: timedelta = NO_SHIFT


def weekly_satisfaction(services: Sequence[Satisfaction], week: Span) -> DataFrame:
    """Attempts and satisfied attempts per service, with family and grand totals.

    Percentages of the totals are computed from the summed counts. Without attempts there is none.
    Services on the same table share one scan: a row is counted under each service that it belongs to.
    """
    tables: dict[int, list[Satisfaction]] = {}
    for judged in services:
        tables.setdefault(id(judged.fact), []).append(judged)
    parts = []
    for group in tables.values():
        entries = []
        for judged in group:
            held = week.covers(judged.ts, judged.shift)
            held = held if judged.where is None else held & judged.where
            attempt = F.lit(True) if judged.attempt is None else judged.attempt
            entries.append(F.when(held, F.struct(
                F.lit(judged.family).alias("family"),
                judged.service.cast("string").alias("service"),
                attempt.alias("attempt"),
                judged.satisfied.alias("good"),
            )))
        hull = _hull([(week, judged.ts, judged.shift) for judged in group])
        counted = group[0].fact.filter(hull).select(F.inline(F.array_compact(F.array(*entries))))
        parts.append(counted.groupBy("family", "service").agg(
            F.count_if("attempt").alias("total_attempt"), F.count_if("good").alias("satisfactory")
        ))
    counts = reduce(DataFrame.unionByName, parts)
    level = (
        F.when(F.grouping("family") == 1, "total")
        .when(F.grouping("service") == 1, "family")
        .otherwise("service")
    )
    return (
        counts.rollup("family", "service")
        .agg(
            F.sum("total_attempt").alias("total_attempt"),
            F.sum("satisfactory").alias("satisfactory"),
            level.alias("level"),
        )
        .filter(F.col("total_attempt").isNotNull())
        .select(
            "level",
            "family",
            "service",
            "total_attempt",
            "satisfactory",
            F.round(percent(F.col("satisfactory"), F.col("total_attempt")), 2).alias(
                "satisfaction_level"
            ),
        )
    )
