"""One hourly summary of a fact, and the cohorts of several reports summed from it.

A dozen cohorts of the same table differ in their span, bucket and dimensions only. The summary reads
the table once for all of them: each row is counted under its date, hour, dimensions and the spans it
lies in. Whether a row lies in a span is decided on the row itself, so the cohorts are exact, settle lags
and ranges that start at a time of day included.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.functions.clock import BUCKETS, NO_SHIFT, Span, moved
from tillwatch.functions.numbers import money
from tillwatch.operators.cohort import Dims, named_dims


def hourly_summary(
    fact: DataFrame,
    spans: Mapping[str, Span],
    dims: Dims,
    *,
    where: Column | None = None,
    ts: str = "create_date",
    shift: timedelta = NO_SHIFT,
    amount: str = "amount",
) -> DataFrame:
    """Rows and money per date, hour, dimensions and membership in each of the spans."""
    hull = reduce(Span.hull, spans.values())
    rows = fact.filter(hull.covers(ts, shift))
    if where is not None:
        rows = rows.filter(where)
    at = moved(ts, shift)
    keys = [BUCKETS["day"].key(at).alias("key_day"), BUCKETS["hour"].key(at).alias("key_hour")]
    keys += [column.alias(name) for name, column in named_dims(dims).items()]
    keys += [span.covers(ts, shift).alias(f"in_{name}") for name, span in spans.items()]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(money(amount)).alias("money")
    )


def cohort_from_summary(
    summary: DataFrame,
    span: str,
    bucket: str,
    *,
    dims: Dims = ("status",),
    where: Column | None = None,
    counted: str | None = None,
    count_name: str | None = "txn_count",
    amount_name: str | None = "total_amount",
) -> DataFrame:
    """The cohort of one named span. ``counted`` leaves the rows without that dimension uncounted."""
    rows = summary.filter(F.col(f"in_{span}"))
    if where is not None:
        rows = rows.filter(where)
    counted_rows = F.col("rows")
    if counted is not None:
        counted_rows = F.when(F.col(counted).isNotNull(), counted_rows).otherwise(F.lit(0))
    aggregates = []
    if count_name is not None:
        aggregates.append(F.sum(counted_rows).alias(count_name))
    if amount_name is not None:
        aggregates.append(F.sum("money").alias(amount_name))
    named = named_dims(dims)
    grouped = rows.groupBy(
        F.col(f"key_{bucket}"), *[column.alias(name) for name, column in named.items()]
    ).agg(*aggregates)
    label = BUCKETS[bucket].label(F.col(f"key_{bucket}")).alias(bucket)
    return grouped.select(label, *grouped.columns[1:])


def cohorts_from_summary(
    summary: DataFrame,
    cohorts: Mapping[str, tuple[str, str, Column | None]],
    *,
    dims: Dims = ("status",),
    label: str = "report",
) -> DataFrame:
    """Several cohorts (name -> span, bucket, condition) in one pass over the summary.

    Each row of the summary is counted under every cohort that it belongs to; the bucket is text in a
    column ``bucket``, for the cohorts may differ in it.
    """
    named = named_dims(dims)
    entries = []
    for name, (span, bucket, where) in cohorts.items():
        held = F.col(f"in_{span}") if where is None else F.col(f"in_{span}") & where
        entries.append(F.when(held, F.struct(
            F.lit(name).alias(label),
            BUCKETS[bucket].label(F.col(f"key_{bucket}")).alias("bucket"),
            *[column.alias(dim) for dim, column in named.items()],
            "rows",
            "money",
        )))
    rows = summary.select(F.inline(F.array_compact(F.array(*entries))))
    return rows.groupBy(label, "bucket", *named).agg(
        F.sum("rows").alias("txn_count"), F.sum("money").alias("total_amount")
    )
