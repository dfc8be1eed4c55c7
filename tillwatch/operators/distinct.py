"""Exact distinct counts over several spans and buckets at once, from one reading of the rows.

The distinct users of an hour, a day and a month do not add up, and counting each anew reads and shuffles the rows as
often. Here the set is kept the other way round: one row per member (and dimensions), with a bitmap of the buckets of each
span in which it occurs. Bitmaps merge by OR, so tasks send one row per member whatever the number of its
rows, states of several polls can be merged, and a bucket's distinct members are the bits that are set.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.functions.clock import BUCKETS, DAY, NO_SHIFT, Span, midnight, moved
from tillwatch.operators.cohort import Dims, named_dims

#: Bits of a bitmap; the sign is left alone.
MOST_BUCKETS = 62


@dataclass(frozen=True)
class Buckets:
    """A span and how it is counted: by ``hour`` of the day, by ``day``, or as a ``whole``."""

    span: Span
    by: str = "whole"

    def number(self) -> int:
        if self.by == "whole":
            return 1
        if self.by == "hour":
            return 24
        start, end = self.span.edges()
        if start is None or end is None:
            raise ValueError("days are counted in a span with two ends")
        days = (midnight(end) - midnight(start)) // DAY + 1
        if days > MOST_BUCKETS:
            raise ValueError(f"a span of {days} days; at most {MOST_BUCKETS} fit one bitmap")
        return days

    def bit(self, at: Column) -> Column:
        if self.by == "whole":
            return F.lit(0)
        if self.by == "hour":
            return F.hour(at)
        return F.datediff(at.cast("date"), F.lit(midnight(self.span.edges()[0]).date()))

    def label(self, bit: int) -> str | None:
        if self.by == "whole":
            return None
        if self.by == "hour":
            return f"{bit:02d}"
        return str((midnight(self.span.edges()[0]) + bit * DAY).date())


def member_bitmaps(
    rows: DataFrame, member: Column, spans: Mapping[str, Buckets], *, dims: Dims = (), ts: str = "create_date",
    shift: timedelta = NO_SHIFT,
) -> DataFrame:
    """(dims, member, in_<span>...): for every member the buckets of each span in which it has a row."""
    hull = reduce(Span.hull, [b.span for b in spans.values()])
    at = moved(ts, shift)
    marks = []
    for name, buckets in spans.items():
        buckets.number()
        held = F.when(buckets.span.covers(ts, shift), F.call_function("shiftleft", F.lit(1).cast("long"), buckets.bit(at)))
        marks.append(F.coalesce(F.bit_or(held), F.lit(0).cast("long")).alias(f"in_{name}"))
    keys = [column.alias(name) for name, column in named_dims(dims).items()]
    return rows.filter(hull.covers(ts, shift)).groupBy(*keys, member.alias("member")).agg(*marks)


def merged_bitmaps(one: DataFrame, other: DataFrame) -> DataFrame:
    """The bitmaps of both readings together; rows that both have read count once."""
    both = one.unionByName(other)
    marks = [c for c in both.columns if c.startswith("in_")]
    keys = [c for c in both.columns if c not in marks]
    return both.groupBy(*keys).agg(*[F.bit_or(c).alias(c) for c in marks])


def counts_of(bitmaps: DataFrame, spans: Mapping[str, Buckets], *, dims: Dims = (), count_name: str = "user_count") -> DataFrame:
    """(span, bucket, dims, count) of the distinct members; a group whose rows have no member counts 0.

    One sum per bucket, added up by the tasks before anything is shuffled; the result's rows are made afterwards.
    """
    names = list(named_dims(dims))
    sums, cells = [], []
    for name, buckets in spans.items():
        for bit in range(buckets.number()):
            column = f"{name}_{bit}"
            set_here = F.shiftright(F.col(f"in_{name}"), bit).bitwiseAND(F.lit(1)) == 1
            sums.append(F.count_if(set_here).alias(f"any_{column}"))
            sums.append(F.count_if(set_here & F.col("member").isNotNull()).alias(f"n_{column}"))
            cells.append(F.when(F.col(f"any_{column}") > 0, F.struct(
                F.lit(name).alias("span"), F.lit(buckets.label(bit)).cast("string").alias("bucket"), F.col(f"n_{column}").alias(count_name))))
    wide = bitmaps.groupBy(*names).agg(*sums)
    return wide.select(*names, F.inline(F.array_compact(F.array(*cells)))).select("span", "bucket", *names, count_name)
