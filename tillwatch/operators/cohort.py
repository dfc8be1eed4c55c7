"""Time-bucketed cohorts: counts and amounts by hour or day and any dimensions.

All cohorts share one shape: a pushed time span, one hash aggregation with map-side partial sums,
and labels written after the aggregation. Where a dimension or a log has to be joined, the fact is
aggregated down to the join key first, so the join never sees single fact rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwatch.functions import fixed_values as fixed
from tillwatch.functions.classify import (
    duration_label,
    failure_reason,
    fold_unlisted,
    registration_status,
    service_direction,
    wallet_status,
    with_suffix,
)
from tillwatch.functions.clock import BUCKETS, EVER, NO_SHIFT, Span, moved, text_may_lie_in
from tillwatch.functions.numbers import money, percent, rows_where
from tillwatch.functions.text import concat_skip_null

Dims = Sequence[str] | Mapping[str, Column]


def named_dims(dims: Dims) -> dict[str, Column]:
    if isinstance(dims, Mapping):
        return dict(dims)
    return {name: F.col(name) for name in dims}


def grouped_by_bucket(
    rows: DataFrame,
    ts: str | Column,
    buckets: str | Sequence[str],
    dims: Dims,
    aggregates: Sequence[Column],
    shift: timedelta = NO_SHIFT,
) -> DataFrame:
    """Group by narrow bucket keys and dimensions, then write the bucket labels."""
    buckets = (buckets,) if isinstance(buckets, str) else tuple(buckets)
    named = named_dims(dims)
    keys = [BUCKETS[b].key(moved(ts, shift)).alias(f"key_{b}") for b in buckets]
    grouped = rows.groupBy(*keys, *[column.alias(name) for name, column in named.items()])
    result = grouped.agg(*aggregates)
    done = result.columns[len(buckets) + len(named):]
    labels = [BUCKETS[b].label(F.col(f"key_{b}")).alias(b) for b in buckets]
    return result.select(*labels, *named, *done)


def status_cohort(
    fact: DataFrame,
    span: Span,
    bucket: str | Sequence[str] = "hour",
    *,
    dims: Dims = ("status",),
    where: Column | None = None,
    ts: str = "create_date",
    shift: timedelta = NO_SHIFT,
    label_shift: timedelta | None = None,
    counted: str | None = None,
    count_name: str | None = "txn_count",
    amount: str | None = "amount",
    amount_name: str = "total_amount",
) -> DataFrame:
    """Rows and money per time bucket and dimensions.

    ``counted`` counts the non-NULL values of a column instead of rows. ``label_shift`` lets the
    bucket label use another shift than the filter.
    """
    rows = fact.filter(span.covers(ts, shift))
    if where is not None:
        rows = rows.filter(where)
    aggregates = []
    if count_name is not None:
        aggregates.append(F.count(counted or F.lit(1)).alias(count_name))
    if amount is not None:
        aggregates.append(F.sum(money(amount)).alias(amount_name))
    shown = shift if label_shift is None else label_shift
    return grouped_by_bucket(rows, ts, bucket, dims, aggregates, shown)


def not_success_breakdown(
    fact: DataFrame,
    span: Span,
    bucket: str = "hour",
    *,
    dims: Sequence[str] = ("status", "mobile_operator", "description"),
    measure: str = "count",
    ts: str = "create_date",
) -> DataFrame:
    """Everything that did not succeed, by count or by amount. Rows without a status are left out."""
    return status_cohort(
        fact, span, bucket, dims=dims, ts=ts, where=~F.col("status").isin("SUCCESS"),
        count_name="txn_count" if measure == "count" else None,
        amount="amount" if measure == "amount" else None,
    )


def folded_status_cohort(
    fact: DataFrame,
    span: Span,
    bucket: str = "hour",
    *,
    listed: Sequence[str] = ("SUCCESS", "FAILED", "REFUNDED"),
    result: str = "result",
    where: Column | None = None,
    ts: str = "create_date",
) -> DataFrame:
    """Cohort with the rare statuses folded into one, and the provider's own result beside it."""
    dims = {
        "status": fold_unlisted(F.col("status"), listed),
        "result": F.coalesce(F.col(result), F.lit("NULL")),
    }
    return status_cohort(fact, span, bucket, dims=dims, where=where, ts=ts, counted="status")


def dimension_cohort(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    label: str,
    span: Span,
    bucket: str = "hour",
    *,
    dimension_key: str | None = None,
    ts: str = "create_date",
) -> DataFrame:
    """Status cohort named by a joined dimension.

    The fact is summed per dimension key before the join: the join and the second aggregation see one
    row per bucket, key and status, however hot a key is.
    """
    small = status_cohort(fact, span, bucket, dims=(key, "status"), ts=ts, counted="status")
    names = dimension.select(F.col(dimension_key or key).alias(key), F.col(label).alias("label"))
    return (
        small.join(names, key)
        .groupBy(bucket, F.col("label").alias(label), "status")
        .agg(F.sum("txn_count").alias("txn_count"), F.sum("total_amount").alias("total_amount"))
    )


def duration_cohort(
    fact: DataFrame,
    span: Span,
    bucket: str = "hour",
    *,
    by: str | None = None,
    ts: str = "create_date",
    end: str = "update_date",
    longest: str = fixed.LONGEST_DURATION,
) -> DataFrame:
    """Rows per duration class, and per vendor or operator when ``by`` names one."""
    dims = {"duration": duration_label(F.col(ts), F.col(end), longest)}
    if by is not None:
        dims["by_label"] = F.coalesce(F.col(by), F.lit(""))
    counts = status_cohort(fact, span, bucket, dims=dims, ts=ts, amount=None)
    if by is None:
        return counts
    label = concat_skip_null(F.col("by_label"), F.lit(" - ("), F.col("duration"), F.lit(")"))
    return counts.select(bucket, "duration", label.alias(f"{by}_duration"), "txn_count")


def top_reasons(
    fact: DataFrame,
    span: Span,
    bucket: str = "hour",
    *,
    n: int = 5,
    reason: Column | None = None,
    monthly: bool = False,
    where: Column | None = None,
    counted: str | None = None,
    share: bool = False,
    ts: str = "create_date",
) -> DataFrame:
    """The ``n`` most frequent failure reasons of each bucket; ties go to the smaller text.

    Ranking runs on the grouped counts, and tasks drop all but their own first ``n`` per bucket
    before the shuffle. ``share`` adds each reason's percentage of its bucket.
    """
    text = failure_reason(F.col("description"), monthly) if reason is None else reason
    not_success = F.col("status") != "SUCCESS" if where is None else where
    counts = status_cohort(
        fact, span, bucket, dims={"description": text}, where=not_success, ts=ts,
        counted=counted, amount=None,
    )
    order = Window.partitionBy(bucket).orderBy(F.desc("txn_count"), F.asc("description"))
    top = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)
    top = top.drop("place")
    if not share:
        return top
    totals = counts.groupBy(bucket).agg(F.sum("txn_count").alias("bucket_count"))
    share_of = F.round(percent(F.col("txn_count"), F.col("bucket_count")), 2)
    return top.join(totals, bucket).select(
        bucket, "description", "txn_count", share_of.alias("percentage")
    )


def provider_status_monthly(
    fact: DataFrame,
    span: Span,
    *,
    only_status: str | None = None,
    ts: str = "create_date",
) -> DataFrame:
    """Wallet-provider outcomes per day. With ``only_status`` the provider status names itself."""
    provider = F.col("provider_status")
    where = None if only_status is None else provider == only_status
    otherwise = F.col("status") if only_status is None else provider
    dims = {
        "provider_status": provider,
        "provider_code": F.col("provider_code"),
        "status": wallet_status(provider, otherwise),
    }
    return status_cohort(fact, span, "day", dims=dims, where=where, ts=ts)


def status_summary(
    fact: DataFrame,
    span: Span,
    statuses: Sequence[str] = ("SUCCESS", "REVERSE", "DISPUTE"),
    *,
    ts: str = "create_date",
) -> DataFrame:
    """One wide row: count and amount of each status."""
    is_status = {name: F.col("status") == name for name in statuses}
    zero = F.lit(0).cast("decimal(18,2)")
    return fact.filter(span.covers(ts)).agg(
        *[rows_where(held, f"{name.lower()}_count") for name, held in is_status.items()],
        *[
            F.sum(F.when(held, money("amount")).otherwise(zero)).alias(f"{name.lower()}_amount")
            for name, held in is_status.items()
        ],
    )


def lifetime_dispute(fact: DataFrame, status: str = "DISPUTE") -> DataFrame:
    return fact.filter(F.col("status") == status).agg(
        rows_where(name="dispute_count"),
        F.coalesce(F.sum(money("amount")), F.lit(0)).alias("dispute_amount"),
    )


def cohort_with_entity_total(
    fact: DataFrame, span: Span, entity: str, *, ts: str = "create_date"
) -> DataFrame:
    """Daily cohort whose entity label carries the entity's total over the whole span.

    The total is a window over the daily sums: an entity has at most days x statuses of them.
    """
    daily = status_cohort(
        fact, span, "day", dims=(entity, "status"), where=F.col(entity).isNotNull(), ts=ts,
        counted="status",
    )
    return entity_totals(daily, entity)


def entity_totals(daily: DataFrame, entity: str) -> DataFrame:
    """(day, entity, status, txn_count, total_amount) with the entity's total in its label."""
    total = F.sum("total_amount").over(Window.partitionBy(entity))
    label = with_suffix(F.col(entity), F.concat(F.lit("Total: "), total.cast("string")))
    return daily.select("day", label.alias(entity), "status", "txn_count", "total_amount")


def assignee_kpi(tickets: DataFrame, span: Span, action: str = "EMAIL") -> DataFrame:
    """Tickets per day, assignee and status."""
    named = (F.col("action_type") == action) & (F.col("assignee") != "")
    return status_cohort(
        tickets, span, "day", dims=("assignee", "status"), where=named, ts="created_at",
        counted="assignee", count_name="ticket_count", amount=None,
    )


def reconciliation_rollups(
    recon: DataFrame,
    *,
    idle: str = "NO ACTION NEEDED",
    split: Sequence[str] = ("NAGAD", "ROCKET"),
    ts: str = "create_date",
) -> DataFrame:
    """Six groupings of the reconciliation table, stacked under ``report``.

    The table is read and shuffled once, at the finest grain; each of those few rows is then copied
    to the groupings it belongs to and summed again.
    """
    base = recon.groupBy(
        F.to_date(ts).alias("day"), "service_name", "txn_type", "proposed_decision"
    ).agg(rows_where(), F.sum(money("amount")).alias("total_amount"))

    service, kind, decision = F.col("service_name"), F.col("txn_type"), F.col("proposed_decision")
    open_item = decision != idle
    direction = service_direction(service, kind, split)
    groupings = {
        "overall": (None, {}),
        "service": (None, {"service": service, "txn_type": kind}),
        "direction": (None, {"txn_type": kind}),
        "decision": (open_item, {"decision": decision}),
        "service_decision": (open_item, {"service": direction, "decision": decision}),
        "direction_decision": (open_item, {"txn_type": kind, "decision": decision}),
    }
    none = F.lit(None).cast("string")
    copies = []
    for name, (held, keys) in groupings.items():
        cells = [keys.get(k, none).alias(k) for k in ("service", "txn_type", "decision")]
        copy = F.struct(F.lit(name).alias("report"), *cells)
        copies.append(copy if held is None else F.when(held, copy))
    return (
        base.select("day", "txn_count", "total_amount", F.explode(F.array(*copies)).alias("g"))
        .filter(F.col("g").isNotNull())
        .select("g.*", "day", "txn_count", "total_amount")
        .groupBy("report", "day", "service", "txn_type", "decision")
        .agg(F.sum("txn_count").alias("txn_count"), F.sum("total_amount").alias("total_amount"))
        .withColumn("day", F.col("day").cast("string"))
    )


def event_counts(
    events: DataFrame,
    span: Span,
    *,
    where: Column,
    dims: Dims = ("event_name", "message"),
    with_day: bool = True,
    ts: str = "created_at",
) -> DataFrame:
    """Hourly application events by name, message or any other dimension."""
    return status_cohort(
        events, span, ("hour", "day") if with_day else "hour", dims=dims, where=where, ts=ts,
        count_name="event_count", amount=None,
    )


def cashback_cohort(
    cashback: DataFrame,
    span: Span,
    bucket: str = "hour",
    *,
    range_on: str = "update_date",
    only_failed: bool = False,
    at: str = "update_date",
) -> DataFrame:
    """Cashback records by the time in a text column; a text that is no time has no bucket.

    The monthly forms are bucketed by the text time but ranged by the real creation time. A range of the text time is
    also one of texts, which the scan can skip by; only what it lets through is read as a time.
    """
    read = cashback.withColumn("text_time", F.col(at).try_cast("timestamp_ntz"))
    if range_on == at:
        rows = read.filter(text_may_lie_in(at, span) & span.covers("text_time"))
    else:
        rows = read.filter(span.covers(range_on))
    dims = ["txn_status"]
    if only_failed:
        rows = rows.filter(F.col("txn_status") == "FAILED")
        dims += ["wallet", "cashback_txn_id"]
    return grouped_by_bucket(rows, "text_time", bucket, dims, [rows_where()])


def registration_funnel(
    profiles: DataFrame,
    span: Span,
    bucket: str = "hour",
    *,
    label_shift: timedelta = timedelta(hours=6),
) -> DataFrame:
    """Completed and attempted registrations; the label is moved to local time, the filter is not."""
    dims = {"status": registration_status(F.col("identity_status"), F.col("is_pin_set"))}
    return status_cohort(
        profiles, span, bucket, dims=dims, ts="created_at", label_shift=label_shift,
        count_name="registrations", amount=None,
    )


def package_sales(
    purchases: DataFrame,
    span: Span = EVER,
    bucket: str | Sequence[str] = ("day", "hour"),
    *,
    where: Column | None = None,
    labelled: bool = True,
    counted: str | None = "status",
) -> DataFrame:
    """Sold packages by price and status, with the price times the number sold."""
    sold = status_cohort(
        purchases, span, bucket, dims=("amount", "status"), where=where, ts="created_at",
        counted=counted, amount=None,
    )
    value = F.col("amount") * F.col("txn_count").cast("decimal(20,0)")
    sold = sold.withColumn("total_amount", value)
    if not labelled:
        return sold
    label = F.concat(
        F.col("status"), F.lit("("), F.col("amount").cast("string"), F.lit("tk package)")
    )
    return sold.withColumn("status_with_package", label)
