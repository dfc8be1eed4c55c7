"""Cohorts over request logs, alone or joined to their transactions.

Joins are on request ids. Both sides are reduced to distinct (id, label) rows first, with map-side
combining, so an id that fills a third of the log reaches the join as a handful of rows.

A log keeps all answers ever given. Where answers are known to lie within some time of their request,
``log_span`` says so, and the scan skips the rest; without it the whole log is searched.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.functions import fixed_values as fixed
from tillwatch.functions.classify import (
    card_action,
    credited,
    response_error,
    response_status,
    with_suffix,
)
from tillwatch.functions.clock import BUCKETS, NO_SHIFT, Span, bucket_text
from tillwatch.functions.numbers import money
from tillwatch.functions.text import code_and_message, extract, extract_last, marked
from tillwatch.operators.cohort import grouped_by_bucket
from tillwatch.operators.distinct import Buckets, counts_of, member_bitmaps

#: Parts into which the rows of one entity are spread for the join with its count.
SALTS = 32


def log_status_cohort(
    log: DataFrame,
    span: Span,
    bucket: str = "hour",
    *,
    where: Column | None = None,
    ts: str = "create_date",
) -> DataFrame:
    """Requests per status, the status read out of the response text."""
    rows = log.filter(span.covers(ts))
    if where is not None:
        rows = rows.filter(where)
    dims = {"status": response_status(F.col("response"), F.col("response"))}
    return grouped_by_bucket(rows, ts, bucket, dims, [F.count("request_id").alias("request_count")])


def error_unique_users(
    log: DataFrame,
    span: Span,
    bucket: str = "hour",
    *,
    where: Column | None = None,
    ts: str = "create_date",
) -> DataFrame:
    """Distinct receiver wallets per error. Unanswered requests are not errors and are left out."""
    response = F.col("response")
    rows = log.filter(span.covers(ts)).filter(~credited(response))
    if where is not None:
        rows = rows.filter(where)
    wallet = extract_last(F.col("request"), fixed.RECEIVER_WALLET_KEY)
    dims = {"status": response_error(response, response)}
    return grouped_by_bucket(rows, ts, bucket, dims, [F.count_distinct(wallet).alias("user_count")])


def error_users_by_span(
    log: DataFrame, spans: Mapping[str, Buckets], *, where: Column | None = None, ts: str = "create_date",
) -> DataFrame:
    """Distinct receiver wallets per error, for several spans and buckets from one reading of the log."""
    response = F.col("response")
    rows = log.filter(~credited(response))
    if where is not None:
        rows = rows.filter(where)
    wallet = extract_last(F.col("request"), fixed.RECEIVER_WALLET_KEY)
    dims = {"status": response_error(response, response)}
    return counts_of(member_bitmaps(rows, wallet, spans, dims=dims, ts=ts), spans, dims=dims)


def _answers(
    log: DataFrame, request_marker: str | None, log_span: Span | None, log_ts: str = "create_date"
) -> DataFrame:
    """The log rows that may answer: of the marked requests, and of the given time."""
    answers = log if log_span is None else log.filter(log_span.covers(log_ts))
    return answers if request_marker is None else answers.filter(marked(F.col("request"), request_marker))


def _distinct_labels(
    fact: DataFrame, log: DataFrame, span: Span, bucket: str, label: Column, ts: str
) -> DataFrame:
    """(id, bucket, label), each combination once, for the ids on both sides.

    The buckets of one id are collected: there are at most as many as the span has hours or days, and
    the fact is shuffled once. Labels are not bounded, so they stay rows.
    """
    requests = fact.filter(span.covers(ts)).groupBy("request_id").agg(
        F.collect_set(BUCKETS[bucket].key(F.col(ts))).alias("buckets")
    )
    responses = log.select("request_id", label.alias("label")).distinct()
    return requests.join(responses, "request_id").select(
        "request_id", F.explode("buckets").alias("key_bucket"), "label"
    )


def _requests_per_label(pairs: DataFrame, bucket: str, name: str) -> DataFrame:
    # Every (id, bucket, label) is unique here, so counting rows counts distinct requests.
    counts = pairs.groupBy("key_bucket", "label").agg(F.count(F.lit(1)).alias("request_count"))
    written = BUCKETS[bucket].label(F.col("key_bucket")).alias(bucket)
    return counts.select(written, F.col("label").alias(name), "request_count")


def xml_code_cohort(
    fact: DataFrame,
    log: DataFrame,
    span: Span,
    bucket: str = "hour",
    *,
    where: Column | None = None,
    request_marker: str | None = None,
    log_span: Span | None = None,
    pattern: str = fixed.CODE_AND_MESSAGE,
    ts: str = "create_date",
) -> DataFrame:
    """Distinct requests per ``code -> message`` found in the provider's markup."""
    fact = fact if where is None else fact.filter(where)
    asked = _answers(log, request_marker, log_span)
    label = code_and_message(F.col("response"), pattern)
    pairs = _distinct_labels(fact, asked, span, bucket, label, ts)
    return _requests_per_label(pairs, bucket, "code_message")


def xml_codes_by_span(
    fact: DataFrame,
    log: DataFrame,
    spans: Mapping[str, Buckets],
    *,
    where: Column | None = None,
    request_marker: str | None = None,
    log_span: Span | None = None,
    pattern: str = fixed.CODE_AND_MESSAGE,
    ts: str = "create_date",
) -> DataFrame:
    """``xml_code_cohort`` for several spans and buckets: one reading of each table, and one join for all of them.

    A request enters the join as one row with its buckets, an answer as one row per distinct label.
    """
    fact = fact if where is None else fact.filter(where)
    requests = member_bitmaps(fact.filter(F.col("request_id").isNotNull()), F.col("request_id"), spans, ts=ts)
    label = code_and_message(F.col("response"), pattern)
    answers = _answers(log, request_marker, log_span).select(F.col("request_id").alias("member"), label.alias("code_message")).distinct()
    return counts_of(requests.join(answers, "member"), spans, dims=("code_message",), count_name="request_count")


def raw_response_cohort(
    fact: DataFrame,
    log: DataFrame,
    span: Span,
    bucket: str = "hour",
    *,
    where: Column | None = None,
    request_marker: str | None = None,
    log_span: Span | None = None,
    hidden_marker: str = fixed.SENSITIVE_MARKER,
    dictionary: bool = False,
    ts: str = "create_date",
) -> DataFrame:
    """Distinct unsuccessful requests per full response text.

    ``dictionary`` counts by a key of 16 bytes instead of the text, which pays where texts are long and repeat: a
    text moves once per task and value, to the dictionary that turns keys into texts again, while the log is
    read twice. Two texts of one key are found there and fail the report.
    """
    bad = fact.filter(F.col("status") != "SUCCESS")
    bad = bad if where is None else bad.filter(where)
    asked = _answers(log, request_marker, log_span).filter(
        ~marked(F.col("response"), hidden_marker)
    )
    if not dictionary:
        pairs = _distinct_labels(bad, asked, span, bucket, F.col("response"), ts)
        return _requests_per_label(pairs, bucket, "response")
    key = F.unhex(F.md5(F.col("response").cast("binary")))
    counts = _requests_per_label(_distinct_labels(bad, asked, span, bucket, key, ts), bucket, "key")
    return counts.join(_texts_by_key(asked, key), "key").select(bucket, "response", "request_count")


def _texts_by_key(log: DataFrame, key: Column) -> DataFrame:
    """(key, response), one row per key; fails where one key stands for two texts."""
    texts = log.groupBy(key.alias("key")).agg(F.min("response").alias("low"), F.max("response").alias("high"))
    clash = F.raise_error(F.lit("two response texts have the same key"))
    return texts.select("key", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(clash).alias("response"))


def bank_response_cohort(
    requests: DataFrame,
    log: DataFrame,
    span: Span,
    bucket: str = "hour",
    *,
    bank: DataFrame | None = None,
    where: Column | None = None,
    ts: str = "issue_time",
    shift: timedelta = NO_SHIFT,
    label_shift: timedelta | None = None,
    log_span: Span | None = None,
    log_ts: str | None = None,
    log_key: str = "np_txn_request_id",
    key: str = fixed.RESPONSE_MESSAGE_KEY,
) -> DataFrame:
    """Requests by status and by the message of the bank's answer, or by a fixed label without one.

    The log is counted per (request, message) before the left join, so repeated answers arrive as a
    multiplier instead of as rows. The bank name is joined to the final small groups. ``log_span`` bounds
    the time ``log_ts`` at which the answers were logged.
    """
    if log_span is not None:
        if log_ts is None:
            raise ValueError("a span of the log needs the log's time column")
        log = log.filter(log_span.covers(log_ts))
    rows = requests.filter(span.covers(ts, shift))
    if where is not None:
        rows = rows.filter(where)
    message = F.coalesce(
        extract_last(F.col("response_text"), key), F.lit(fixed.NO_BANK_LOG)
    )
    answers = (
        log.filter(F.col(log_key).isNotNull())
        .groupBy(F.col(log_key).alias("id"), message.alias("response_message"))
        .agg(F.count(F.lit(1)).alias("answers"))
    )
    shown = shift if label_shift is None else label_shift
    times = F.coalesce(F.col("answers"), F.lit(1))
    joined = rows.join(answers, "id", "left")
    dims = {
        "status": F.col("status"),
        "response_message": F.coalesce("response_message", F.lit(fixed.NO_BANK_LOG)),
    }
    if bank is not None:
        dims["swift_code"] = F.col("bank_swift_code")
    counts = grouped_by_bucket(
        joined, ts, bucket, dims,
        [
            F.sum(F.when(F.col("id").isNotNull(), times).otherwise(0)).alias("request_count"),
            F.sum(money("amount") * times.cast("decimal(10,0)")).alias("total_amount"),
        ],
        shown,
    )
    if bank is None:
        return counts
    return (
        counts.join(bank.select("swift_code", "bank_name"), "swift_code")
        .groupBy(bucket, "status", "response_message", "bank_name")
        .agg(
            F.sum("request_count").alias("request_count"),
            F.sum("total_amount").alias("total_amount"),
        )
    )


def reverse_reasons(
    fact: DataFrame,
    log: DataFrame,
    bucket: str = "day",
    *,
    span: Span | None = None,
    status: str = "REVERSE",
    request_marker: str = fixed.CARD_REQUEST,
    log_span: Span | None = None,
    entity: str = "bank_name",
    ts: str = "create_date",
) -> DataFrame:
    """Every reversed transaction with its action code; labels carry how often bank and code occur.

    The occurrences are grouped counts joined back, not windows over the rows: a bank with a third of
    all reversals is counted by every task, and its rows meet its count in ``SALTS`` parts. Codes have at most
    one count per known code and one for the rest, so that side is broadcast. Facts and log are read and
    joined once for the rows and both counts.
    """
    reversed_rows = fact.filter(F.col("status") == status)
    if span is not None:
        reversed_rows = reversed_rows.filter(span.covers(ts))
    code = F.get_json_object("response", "$.actionCode")
    answers = _answers(log, request_marker, log_span).select(
        "request_id", code.alias("action_code")
    )
    rows = reversed_rows.join(answers, "request_id").select(
        "id", F.col(ts).alias("at"), F.col(entity).alias("entity"), "status", "action_code",
        card_action(F.col("action_code")).alias("meaning"),
        F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("part"),
    )
    return _with_occurrences(rows).select(
        "id",
        bucket_text(bucket, "at").alias(bucket),
        with_suffix(F.col("entity"), F.col("entity_rows")).alias(f"{entity}_with_count"),
        "status",
        "action_code",
        with_suffix(F.col("meaning"), F.col("meaning_rows")).alias("meaning_with_count"),
    )


def _with_occurrences(rows: DataFrame) -> DataFrame:
    """``rows`` (entity, meaning, part, ...) with the numbers of rows of the entity and of the meaning.

    Spark plans a named subquery anew for each use, unless it holds a value that would differ between the
    uses: then all of them read one exchange. ``once`` is such a value; nothing reads it.
    """
    return rows.sparkSession.sql(
        f"""
        WITH joined AS (SELECT *, rand() AS once FROM {{rows}}),
             pairs AS (SELECT entity, meaning, count(*) AS n FROM joined GROUP BY entity, meaning),
             entities AS (SELECT entity, sum(n) AS entity_rows FROM pairs GROUP BY entity),
             spread AS (SELECT *, explode(sequence(0L, {SALTS - 1}L)) AS part FROM entities),
             meanings AS (SELECT meaning, sum(n) AS meaning_rows FROM pairs GROUP BY meaning)
        SELECT /*+ BROADCAST(meanings) */ joined.*, entity_rows, meaning_rows
        FROM joined
        JOIN meanings ON joined.meaning = meanings.meaning
        LEFT JOIN spread ON joined.entity = spread.entity AND joined.part = spread.part
        """,
        rows=rows,
    )


def first_response_per_request(
    fact: DataFrame,
    log: DataFrame,
    span: Span,
    bucket: str = "day",
    *,
    statuses: tuple[str, ...] = ("REVERSE", "UNKNOWN", "REVERSIBLE"),
    columns: tuple[str, ...] = ("status", "amount", "bank_swift_code", "channel"),
    request_marker: str | None = None,
    log_span: Span | None = None,
    log_order: str = "id",
    fetch: bool = False,
    ts: str = "create_date",
) -> DataFrame:
    """One row per failed request: its transaction and the first answer logged for it.

    Both sides are reduced to their first row per request by an aggregate with map-side combining.
    Both reductions leave the rows hashed by request id, so the join adds no shuffle.

    ``fetch`` is for long answers to few failed requests: the first answers are found by number alone, and
    the log is read again for the texts of those found. Spark then broadcasts these or, on large tables,
    filters the second reading by a Bloom filter of them, so that other texts stay where they are.
    ``log_order`` has to tell the answers of a request apart then.
    """
    failed = fact.filter(span.covers(ts) & F.col("status").isin(*statuses))
    asked = _answers(log, request_marker, log_span)
    first_rows = failed.groupBy("request_id").agg(
        F.min(F.struct(ts, *columns)).alias("row")
    )
    if fetch:
        wanted = failed.select("request_id").distinct()
        numbers = asked.join(wanted, "request_id").groupBy("request_id").agg(F.min(log_order).alias("first"))
        texts = asked.select(
            F.col("request_id").alias("asked_id"), F.col(log_order).alias("number"), F.struct("response").alias("answer"))
        first_answers = numbers.join(
            texts, (F.col("request_id") == F.col("asked_id")) & F.col("first").eqNullSafe(F.col("number")))
    else:
        first_answers = asked.groupBy("request_id").agg(
            F.min(F.struct(log_order, "response")).alias("answer")
        )
    return first_rows.join(first_answers, "request_id").select(
        "request_id",
        bucket_text(bucket, F.col("row")[ts]).alias(bucket),
        *[F.col("row")[name].alias(name) for name in columns],
        F.coalesce(F.col("answer")["response"], F.lit(fixed.NULL_RESPONSE)).alias("response"),
    )


def unanswered_requests(log: DataFrame, span: Span, *, ts: str = "create_date") -> DataFrame:
    """Requests that were sent and never answered."""
    open_requests = (
        F.col("request_id").isNotNull() & F.col("request").isNotNull() & F.col("response").isNull()
    )
    return log.filter(span.covers(ts) & open_requests).select(
        bucket_text("day", ts).alias("day"),
        bucket_text("hour", ts).alias("hour"),
        F.col("request_id").alias("rrn"),
        F.lit(fixed.TIMEOUT_LABEL).alias("response"),
    )


def tag_fields(
    log: DataFrame,
    span: Span | None = None,
    *,
    fields: dict[str, str] | None = None,
    json_path: str | None = "$.xml",
    keep: tuple[str, ...] = ("id", "create_date", "update_date", "request_id"),
    where: Column | None = None,
    ts: str = "create_date",
) -> DataFrame:
    """Tagged fields out of markup, stored bare or inside a JSON text.

    A row without any of the fields disappears; a row with some of them has NULL for the others.
    """
    fields = fields or {"field_id_32_value": fixed.FIELD_32, "field_id_39_value": fixed.FIELD_39}
    rows = log if span is None else log.filter(span.covers(ts))
    if where is not None:
        rows = rows.filter(where)
    response = F.col("response")
    markup = response if json_path is None else F.get_json_object(response, json_path)
    found = rows.select(
        *keep, *[extract(markup, pattern).alias(name) for name, pattern in fields.items()]
    )
    return found.filter(F.coalesce(*[F.col(name) for name in fields]).isNotNull())
