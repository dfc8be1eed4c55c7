"""Text messages: cohorts and the monthly bill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.functions import fixed_values as fixed
from tillwatch.functions.classify import message_status, segments
from tillwatch.functions.clock import Span
from tillwatch.functions.numbers import rows_where
from tillwatch.functions.text import grouped_digits
from tillwatch.operators.cohort import grouped_by_bucket


def sms_cohort(
    messages: DataFrame,
    span: Span,
    bucket: str = "hour_number",
    *,
    channels: Sequence[str],
    merge_folded: bool = False,
    ts: str = "request_time",
) -> DataFrame:
    """Messages per channel, operator and status, with the code ``0`` shown as success.

    Grouping is by the stored status, so both spellings of success keep a row each;
    ``merge_folded`` groups by the shown status instead.
    """
    rows = messages.filter(span.covers(ts) & F.col("channel").isin(*channels))
    shown = message_status(F.col("message_status"))
    dims = {
        "channel": F.col("channel"),
        "telecom_operator": F.col("telecom_operator"),
        "status": shown if merge_folded else F.col("message_status"),
    }
    counts = grouped_by_bucket(rows, ts, bucket, dims, [rows_where(name="message_count")])
    return counts.withColumn("status", message_status(F.col("status")))


def sms_bill(
    messages: DataFrame,
    month: Span | None,
    *,
    unicode_channels: Sequence[str],
    plain_channels: Sequence[str],
    where: Column | None = None,
    rate: str = fixed.SEGMENT_RATE,
    formatted: bool = False,
    ts: str = "request_time",
) -> DataFrame:
    """Billed segments and their price per channel, and a total row over all channels."""
    channel = F.col("channel")
    rows = messages.filter(channel.isin(*unicode_channels, *plain_channels))
    if month is not None:
        rows = rows.filter(month.covers(ts))
    if where is not None:
        rows = rows.filter(where)
    billed = segments(channel, F.col("message_body"), unicode_channels, plain_channels)
    per_channel = rows.groupBy("channel").agg(F.sum(billed).alias("n"))
    price = F.lit(rate).cast("decimal(10,2)")
    bill = (
        per_channel.rollup("channel")
        .agg(F.sum("n").alias("sms_count"))
        .select(
            F.coalesce("channel", F.lit("Total")).alias("channel"),
            F.coalesce("sms_count", F.lit(0)).alias("sms_count"),
            (F.coalesce("sms_count", F.lit(0)).cast("decimal(20,0)") * price).alias("bill"),
        )
    )
    if not formatted:
        return bill
    return bill.select(
        "channel",
        grouped_digits(F.col("sms_count").cast("decimal(20,0)"), 2).alias("sms_count"),
        grouped_digits(F.col("bill"), 2).alias("bill"),
    )
