"""Listings and single-row look-ups: details, latest values, distinct transitions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillwatch.functions import fixed_values as fixed
from tillwatch.functions.classify import wallet_status
from tillwatch.functions.clock import BUCKETS, Span, bucket_text, instant
from tillwatch.functions.text import between_markers, extract, grouped_digits, looks_like_object
from tillwatch.operators.newest import Found, Newest, answers_since, newest_rows


def as_of_stamp(spark: SparkSession, as_of: datetime) -> DataFrame:
    """The report's clock as text."""
    one = spark.range(0, 1, 1, 1)
    return one.select(F.date_format(instant(as_of), "yyyy-MM-dd HH:mm").alias("date_time"))


def newest_stamp(fact: DataFrame, ts: str = "create_date") -> DataFrame:
    """The stamp of a replayed table: the time of its newest row."""
    return fact.agg(F.date_format(F.max(ts), "yyyy-MM-dd HH:mm").alias("date_time"))


def latest_by_key_pivot(
    fact: DataFrame,
    columns: dict[str, str],
    *,
    key: str = "mobile_operator",
    value: str = "vendor_name",
    order: str = "id",
) -> DataFrame:
    """One wide row: per key the value of its latest row.

    An aggregate keeps one candidate per key and task, so the table is never shuffled or sorted.
    """
    latest = [
        F.max_by(F.col(value), F.when(F.col(key) == name, F.col(order))).alias(column)
        for column, name in columns.items()
    ]
    return fact.filter(F.col(key).isin(*columns.values())).agg(*latest)


def txn_detail(
    fact: DataFrame,
    span: Span,
    *,
    only_status: str | None = None,
    ts: str = "create_date",
) -> DataFrame:
    """Every transaction of the span with its canonical provider status."""
    provider = F.col("provider_status")
    rows = fact.filter(span.covers(ts))
    if only_status is not None:
        rows = rows.filter(provider == only_status)
    return rows.select(
        "id",
        bucket_text("hour", ts).alias("hour"),
        ts,
        "amount",
        "provider_status",
        "provider_code",
        wallet_status(provider, F.col("status")).alias("status"),
        "txn_number",
        "wallet",
    )


def _succeeded(where: Column | None) -> Column:
    good = F.col("status") == "SUCCESS"
    return good if where is None else good & where


def _latest_success(fact: DataFrame, vendors: Sequence[str], where: Column | None) -> DataFrame:
    """The request id of each listed vendor's latest success."""
    good = fact.filter(_succeeded(where) & F.col("vendor_name").isin(*vendors))
    latest = F.max_by(F.col("request_id").cast("string"), "id").alias("request_id")
    return good.groupBy("vendor_name").agg(latest)


def _found_success(
    fact: DataFrame, vendors: Sequence[str], where: Column | None, search: Newest
) -> dict[str, Found]:
    """Each listed vendor's latest success, searched from the newest rows on."""
    return newest_rows(
        fact, ["request_id"], search, where=_succeeded(where), key="vendor_name", wanted=vendors
    )


def _answers(
    fact: DataFrame, log: DataFrame, vendors: Sequence[str], where: Column | None,
    request_like: Column, search: Newest | None, log_ts: str,
) -> DataFrame:
    """Log rows that answer the vendors' latest successes, with ``vendor_name``.

    Without a search all history is read and the requests, one per listed vendor, are broadcast. With one
    the requests are known beforehand: their ids and their time are conditions of the log's scan.
    """
    if search is None:
        latest = _latest_success(fact, vendors, where)
        return log.filter(request_like).join(F.broadcast(latest), "request_id")
    found = _found_success(fact, vendors, where, search)
    ids = {vendor: f.row["request_id"] for vendor, f in found.items() if f.row["request_id"] is not None}
    since = answers_since(log, list(found.values()), search, log_ts)
    asked = [F.when(F.col("request_id") == id, F.lit(vendor)) for vendor, id in ids.items()]
    vendor = F.explode(F.array_compact(F.array(*asked, F.lit(None).cast("string"))))
    return since.filter(F.col("request_id").isin(*ids.values()) & request_like).withColumn("vendor_name", vendor)


def latest_marked_balances(
    fact: DataFrame,
    log: DataFrame,
    vendors: dict[str, str],
    request_marker: str,
    *,
    before: str = fixed.BALANCE_BEFORE,
    after: str = fixed.BALANCE_AFTER,
    search: Newest | None = None,
    log_ts: str = "create_date",
) -> DataFrame:
    """Balances that vendors reported with their latest success, side by side in one row.

    No row unless every vendor has an answer; of several answers to one request the newest counts.
    ``vendors`` maps an output name to the vendor. With ``search`` the successes are looked for newest first.
    """
    answers = _answers(
        fact, log, tuple(vendors.values()), None, F.col("request").like(request_marker), search, log_ts
    )
    balance = between_markers(F.col("response"), before, after)
    cells = []
    for name, vendor in vendors.items():
        newest = F.when(F.col("vendor_name") == vendor, F.col("id"))
        cells += [
            F.max_by("request", newest).alias(f"request_{name}"),
            F.max_by(balance, newest).alias(f"balance_{name}"),
        ]
    wide = answers.agg(*cells)
    for name in vendors:
        wide = wide.filter(F.col(f"request_{name}").isNotNull())
    return wide


def latest_json_balance(
    log: DataFrame,
    request_marker: str,
    *,
    balance_path: str = "$.merchantBalance",
    time_pattern: str = fixed.REQUEST_TIME_FIELD,
    order: str = "id",
    search: Newest | None = None,
) -> DataFrame:
    """The balance in the latest JSON answer of a provider, and the time named in its request.

    With ``search`` the answer is looked for newest first, and its row is read again by its number and time alone.
    """
    wanted = F.ilike("request", F.lit(request_marker)) & looks_like_object(F.col("response"))
    if search is not None:
        found = newest_rows(log, [order], search, where=wanted, order=order).get(None)
        if found is None:
            log = log.filter(F.lit(False))
        else:
            at = F.col(search.ts).isNull() if found.ts is None else F.col(search.ts) == instant(found.ts)
            log = log.filter((F.col(order) == found.order) & at)
    latest = log.filter(wanted).orderBy(F.desc(order)).limit(1)
    asked_at = F.try_to_timestamp(extract(F.col("request"), time_pattern), F.lit("yyyyMMddHHmmss"))
    balance = F.get_json_object("response", balance_path).try_cast("decimal(38,2)")
    return latest.select(
        "request",
        F.date_format(asked_at, "yyyy/MM/dd HH:mm:ss").alias("request_time"),
        grouped_digits(balance).alias("balance"),
    )


def guarded_json_balance(
    fact: DataFrame,
    log: DataFrame,
    vendor: str,
    request_marker: str,
    *,
    where: Column | None = None,
    balance_path: str = "$.new_balance",
    search: Newest | None = None,
    log_ts: str = "create_date",
) -> DataFrame:
    """The balance in the answer to a vendor's latest success, or a fixed text if it holds none."""
    like = F.ilike("request", F.lit(request_marker))
    answers = _answers(fact, log, (vendor,), where, like, search, log_ts)
    response = F.col("response")
    balance = F.get_json_object(response, balance_path).try_cast("decimal(38,2)")
    shown = F.when(looks_like_object(response), grouped_digits(balance))
    return answers.select(
        "request", "response", F.coalesce(shown, F.lit(fixed.NOT_JSON)).alias("balance")
    )


def decode_and_enrich(
    report: DataFrame,
    profile: DataFrame,
    *,
    coded: str = "wallet",
    keep: tuple[str, ...] = ("day", "hour"),
    status: str = fixed.PROFILE_MISSING,
    start: int = fixed.USER_ID_START,
    length: int = fixed.USER_ID_LENGTH,
    offset: int = fixed.USER_ID_OFFSET,
    key: str = "user_id",
    columns: dict[str, str] | None = None,
) -> DataFrame:
    """User ids decoded from fixed positions of an identifier, with blanks where no profile fits.

    The report's rows all stay: profiles are reduced to one per user before the left join.
    """
    columns = columns or {
        "biz_name": "biz_name", "wallet_no": "wallet_no", "current_merchant_id": "merchant_id"
    }
    digits = F.substring(coded, start, length)
    wanted = report.filter((F.col("status") == status) & digits.rlike("^[0-9]+$")).select(
        *keep,
        F.col(coded).alias("previous_merchant_id"),
        "status",
        (digits.cast("bigint") - F.lit(offset)).alias("user_id"),
    )
    # Only the wanted users' profiles are grouped.
    found = profile.select(
        F.col(key).alias("user_id"), F.struct(*columns.values()).alias("profile")
    ).join(wanted.select("user_id"), "user_id", "left_semi")
    found = found.groupBy("user_id").agg(F.max("profile").alias("profile"))
    return wanted.join(found, "user_id", "left").select(
        *keep,
        "previous_merchant_id",
        "status",
        "user_id",
        *[
            F.coalesce(F.col("profile")[source].cast("string"), F.lit("")).alias(name)
            for name, source in columns.items()
        ],
    )


def audit_transitions(
    audit: DataFrame,
    span: Span,
    bucket: str = "hour",
    *,
    old: str = "CUSTOMER",
    new: Sequence[str] = ("MERCHANT", "MICRO_MERCHANT"),
    ts: str = "create_date",
) -> DataFrame:
    """Distinct changes of user type."""
    changed = (F.col("old_value") == old) & F.col("new_value").isin(*new)
    return audit.filter(span.covers(ts) & changed).select(
        "user_id",
        bucket_text(bucket, ts).alias(bucket),
        F.col("new_value").alias("new_user_type"),
        F.col("old_value").alias("old_user_type"),
        "updated_by",
    ).distinct()


def form_open_events(
    events: DataFrame,
    span: Span,
    *,
    event_name: str,
    label: str,
    user: str = "user_id",
    ts: str = "created_at",
) -> DataFrame:
    """Distinct openings with the number of records of the same id and user.

    The records are counted per id, user and hour first; the window then adds at most a few counts.
    """
    opened = events.filter(span.covers(ts) & (F.col("event_name") == event_name))
    counts = opened.groupBy(
        "id", F.col(user).alias("user_id"), BUCKETS["hour"].key(F.col(ts)).alias("key_hour")
    ).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("id", "user_id"))
    return counts.select(
        "id",
        BUCKETS["hour"].label(F.col("key_hour")).alias("hour"),
        F.lit(label).alias("event_name"),
        "user_id",
        total.alias("transaction_count"),
    )


def latest_events(
    events: DataFrame,
    event_name: str,
    *,
    only_errors: bool = False,
    n: int = 50,
    columns: tuple[str, ...] = ("level", "event_name", "message", "details"),
    order: str = "id",
    ts: str = "created_at",
) -> DataFrame:
    """The newest ``n`` events of one name; every task keeps its own newest ``n`` only."""
    named = events.filter(F.col("event_name") == event_name)
    if only_errors:
        named = named.filter(F.col("level") != "INFO")
    newest = named.orderBy(F.desc(order)).limit(n)
    return newest.select(
        order, F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("date_time"), *columns
    )


def active_plans(plans: DataFrame) -> DataFrame:
    return plans.filter(F.col("is_active")).select(
        "id", "name", "subscription_type", "regular_price", "offer_price", "is_active", "updated_at"
    )
