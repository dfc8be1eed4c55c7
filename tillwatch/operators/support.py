"""Support work: resolved tickets and spent hours per agent and day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwatch.functions.clock import instant, midnight, since_day, today
from tillwatch.functions.text import contains_first, title_words

REPORT_DAYS = 30


def agent_of(address: Column, agents: Mapping[str, str]) -> Column:
    """The agent whose key occurs in the address, NULL if none does. Order decides between keys."""
    return contains_first(address, dict(agents))


def agent_days(
    rows: DataFrame, as_of: datetime, agents: Mapping[str, str], days: int = REPORT_DAYS
) -> DataFrame:
    """Every agent on today and each of the ``days`` before."""
    last = midnight(as_of)
    dates = F.sequence(
        instant(last - timedelta(days=days)).cast("date"), instant(last).cast("date")
    )
    names = F.array(*[F.lit(name) for name in dict.fromkeys(agents.values())])
    return (
        rows.sparkSession.range(0, 1, 1, 1)
        .select(F.explode(dates).alias("date"))
        .select("date", F.explode(names).alias("agent"))
    )


def latest_journals(
    journals: DataFrame,
    issues: DataFrame,
    emails: DataFrame,
    statuses: DataFrame,
    as_of: datetime,
    *,
    staff: Sequence[int],
    days: int = REPORT_DAYS,
    closed: Sequence[str] = ("Closed", "Resolved"),
    ts: str = "created_on",
) -> DataFrame:
    """The last journal entries of staff on closed tickets opened by others; ties all stay.

    An entry older than its writer's last one on the same ticket cannot be the ticket's last, so
    entries are first reduced to one row per ticket and writer, ``rows`` counting the ties. The joins
    and the final window then see at most one row per ticket and staff address.
    """
    entries = journals.filter(since_day(as_of, days).covers(ts)).filter(
        F.col("user_id").isin(*staff)
    )
    at_time = entries.groupBy(F.col("journalized_id").alias("ticket"), "user_id", ts).agg(
        F.count(F.lit(1)).alias("rows")
    )
    last = F.max(F.struct(F.col(ts).alias("at"), "rows")).alias("last")
    written = at_time.groupBy("ticket", "user_id").agg(last).select("ticket", "user_id", "last.*")
    closed_ids = statuses.filter(F.col("name").isin(*closed)).select(F.col("id").alias("status_id"))
    tickets = (
        issues.filter(~F.col("author_id").isin(*staff) & F.col("category_id").isNull())
        .join(closed_ids, "status_id")
        .select(F.col("id").alias("ticket"), "subject")
    )
    work = written.join(tickets, "ticket").join(emails.select("user_id", "address"), "user_id")
    newest = F.max("at").over(Window.partitionBy("ticket"))
    return (
        work.withColumn("newest", newest)
        .filter(F.col("at") == F.col("newest"))
        .select("ticket", "at", "subject", "address", "rows")
    )


def resolution_counts(
    resolved: DataFrame, as_of: datetime, agents: Mapping[str, str], days: int = REPORT_DAYS
) -> DataFrame:
    """Resolved tickets per day and agent over the last 31 days, zeros included."""
    counts = resolved.groupBy(
        F.to_date("at").alias("date"), agent_of(F.col("address"), agents).alias("agent")
    ).agg(F.sum("rows").alias("n"))
    spine = agent_days(resolved, as_of, agents, days)
    return spine.join(counts, ["date", "agent"], "left").select(
        F.col("date").cast("string").alias("date"),
        "agent",
        F.coalesce("n", F.lit(0)).alias("ticket_count"),
    )


def resolution_pivot(
    resolved: DataFrame, as_of: datetime, agents: Mapping[str, str]
) -> DataFrame:
    """Today's rows per address and subject beside the agent's total, and a grand total row."""
    today_rows = resolved.filter(today(as_of).covers("at")).select(
        "address",
        title_words(F.col("subject")).alias("subject"),
        agent_of(F.col("address"), agents).alias("agent"),
        "rows",
    )
    # One aggregate gives the leaves, each agent's total and the grand total.
    level = F.grouping_id("agent", "address", "subject")
    counts = (
        today_rows.filter(F.col("agent").isNotNull())
        .rollup("agent", "address", "subject")
        .agg(F.sum("rows").alias("n"), level.alias("level"))
        .filter(F.col("level").isin(0, 3, 7) & F.col("n").isNotNull())
    )
    # An agent's rows are as many as its addresses' subjects of one day.
    agent_rows = Window.partitionBy("agent")
    total = F.max(F.when(F.col("level") == 3, F.col("n"))).over(agent_rows)
    grand = F.col("level") == 7
    return counts.withColumn("total_resolved", total).filter(F.col("level") != 3).select(
        F.when(grand, F.lit("Grand Total")).otherwise(F.col("address")).alias("address"),
        F.when(~grand, F.col("total_resolved")).alias("total_resolved"),
        F.when(grand, F.lit("")).otherwise(F.col("subject")).alias("subject"),
        F.col("n").alias("ticket_count"),
    )


def first_entries(
    issues: DataFrame,
    entries: DataFrame,
    emails: DataFrame,
    statuses: DataFrame,
    as_of: datetime,
    *,
    staff: Sequence[int],
    days: int = REPORT_DAYS,
    ts: str = "start_date",
    entry_order: str = "id",
) -> DataFrame:
    """One row per issue opened by staff: its first time entry and its author's address.

    Journals only multiply rows that are reduced to the first again, so they are not read.
    """
    opened = issues.filter(since_day(as_of, days).covers(ts)).filter(
        F.col("author_id").isin(*staff)
    )
    known = statuses.select(F.col("id").alias("status_id")).distinct()
    # Only the entries of the opened issues are grouped.
    mine = opened.select(F.col("id").alias("issue_id"))
    hours = entries.join(mine, "issue_id", "left_semi").groupBy(F.col("issue_id").alias("ticket")).agg(
        F.min_by("hours", entry_order).alias("hours")
    )
    addresses = emails.groupBy(F.col("user_id").alias("author_id")).agg(
        F.min("address").alias("address")
    )
    return (
        opened.join(known, "status_id")
        .select(F.col("id").alias("ticket"), F.col(ts).alias("at"), "subject", "author_id")
        .join(addresses, "author_id")
        .join(hours, "ticket")
        .select("ticket", "at", "subject", "address", "hours", F.lit(1).cast("bigint").alias("rows"))
    )


def operation_hours(
    first: DataFrame, as_of: datetime, agents: Mapping[str, str], days: int = REPORT_DAYS
) -> DataFrame:
    """Hours per day and agent over the last 31 days, summed and then rounded up."""
    spent = first.groupBy(
        F.to_date("at").alias("date"), agent_of(F.col("address"), agents).alias("agent")
    ).agg(F.ceil(F.sum(F.col("hours").cast("decimal(18,4)"))).cast("bigint").alias("n"))
    spine = agent_days(first, as_of, agents, days)
    return spine.join(spent, ["date", "agent"], "left").select(
        F.col("date").cast("string").alias("date"),
        "agent",
        F.coalesce("n", F.lit(0)).alias("hourly_count"),
    )
