"""Status counts of a running stream, in place of polling the last half hour again and again.

A window is final once the newest row seen is ``lateness`` past its end; it is then written once and never
corrected. A row that arrives later than that is lost to the stream, and a row counts with the status that it
had on arrival: where statuses change, feed a stream of settled rows, or take the batch report as the truth.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.functions.numbers import money, percent
from tillwatch.operators.health import Roles

HALF_HOUR = timedelta(minutes=30)
FIVE_MINUTES = timedelta(minutes=5)


def _seconds(span: timedelta) -> str:
    return f"{int(span.total_seconds())} seconds"


def live_status(
    stream: DataFrame,
    roles: Roles,
    *,
    by: tuple[str, ...] = (),
    ts: str = "create_date",
    window: timedelta = HALF_HOUR,
    slide: timedelta = FIVE_MINUTES,
    lateness: timedelta = HALF_HOUR,
) -> DataFrame:
    """Counts, amount and success rate per sliding window, and per service when ``by`` names one.

    ``lateness`` is how much later than the newest row a row may arrive and still count; rows beyond it
    are dropped from windows that are final. It is no settle lag: it delays the result, not the range.
    State is one row per open window and service, whatever the number of transactions.
    """
    hits = roles.success if roles.hits is None else roles.hits
    attempts = F.lit(True) if roles.attempts is None else roles.attempts
    # Watermarks need a time with a zone; the session's zone applies, as it does in the labels.
    timed = stream.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark(
        "event_time", _seconds(lateness)
    )
    counts = timed.groupBy(F.window("event_time", _seconds(window), _seconds(slide)), *by).agg(
        F.count_if(roles.success).alias("success"),
        F.count_if(roles.reverse).alias("reverse"),
        F.count_if(roles.failed).alias("failed"),
        F.count_if(roles.dispute).alias("dispute"),
        F.sum(F.when(roles.success, money("amount"))).alias("success_amount"),
        F.count_if(hits).alias("hits"),
        F.count_if(attempts).alias("attempts"),
    )
    rate: Column = F.round(percent(F.col("hits"), F.col("attempts")), 2)
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *by,
        "success",
        "reverse",
        "failed",
        "dispute",
        "success_amount",
        rate.alias("success_rate"),
    )


def checkpoint_location(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """A folder for a query's progress in the shared folder the session names.

    ``fallback`` is used only where the session names none; on a cluster it must be shared too.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if shared is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{shared.rstrip('/')}/{name}"


def publish_stream(
    windows: DataFrame,
    name: str,
    root: str,
    *,
    checkpoint_root: str | None = None,
    once: bool = False,
    every: timedelta = FIVE_MINUTES,
) -> StreamingQuery:
    """Append every final window to the report folder, exactly once across restarts."""
    spark = windows.sparkSession
    writer = (
        windows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_location(spark, name, checkpoint_root))
        .option("path", f"{root}/{name}")
    )
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=_seconds(every)).start()
