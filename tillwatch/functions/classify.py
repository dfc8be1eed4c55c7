"""Classifiers: one column expression each, built from the fixed values."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, functions as F

from tillwatch.functions import fixed_values as fixed
from tillwatch.functions.text import extract_last, marked


def any_like(text: Column, patterns: Sequence[str]) -> Column:
    held = F.lit(False)
    for pattern in patterns:
        held = held | marked(text, pattern)
    return held


def within(start: Column, end: Column, limit: timedelta) -> Column:
    """``end - start`` is at most ``limit``, to the microsecond."""
    return (end - start) <= F.lit(limit)


def duration_label(start: Column, end: Column, longest: str = fixed.LONGEST_DURATION) -> Column:
    """Duration class; an unknown duration counts as the longest."""
    ladder = F
    for limit, label in fixed.DURATION_CLASSES:
        ladder = ladder.when(within(start, end, limit), F.lit(label))
    return ladder.otherwise(F.lit(longest))


def health_of_rate(rate: Column, low: int, high: int) -> Column:
    return (
        F.when(rate.isNull() | (rate == 0), "DOWN")
        .when(rate < low, "NOT OK")
        .when(rate <= high, "ACCEPTABLE")
        .otherwise("OK")
    )


def health_of_count(successes: Column) -> Column:
    return (
        F.when(successes < 5, "NOT OK").when(successes <= 20, "ACCEPTABLE").otherwise("OK")
    )


def response_error(response: Column, otherwise: Column) -> Column:
    """The last ``message`` of a response, else its last ``error``, else ``otherwise``."""
    return F.coalesce(
        extract_last(response, fixed.MESSAGE_KEY),
        extract_last(response, fixed.ERROR_KEY),
        otherwise,
    )


def credited(response: Column) -> Column:
    return marked(response, fixed.CREDIT_MARKER)


def response_status(response: Column, otherwise: Column) -> Column:
    return F.when(credited(response), F.lit("SUCCESS")).otherwise(
        response_error(response, otherwise)
    )


def wallet_status(provider_status: Column, otherwise: Column) -> Column:
    ladder = F
    for raw, canonical in fixed.WALLET_STATUS.items():
        ladder = ladder.when(provider_status == raw, F.lit(canonical))
    return ladder.otherwise(otherwise)


def fold_unlisted(status: Column, listed: Sequence[str], into: str = "DISPUTE") -> Column:
    """Statuses outside the list become ``into``; NULL stays NULL."""
    return F.when(~status.isin(*listed), F.lit(into)).otherwise(status)


def failure_reason(description: Column, monthly: bool = False) -> Column:
    """Reason template of a free-text description; the monthly rules know no queue message."""
    ladder = F.when(description.isNull(), F.lit("NULL"))
    for pattern, reason in fixed.REASONS:
        ladder = ladder.when(description.like(pattern), F.lit(reason))
    no_credit = fixed.NO_CREDIT_MONTH if monthly else fixed.NO_CREDIT_TODAY
    ladder = ladder.when(description.like(no_credit), F.lit(fixed.NO_CREDIT_REASON))
    if not monthly:
        pattern, reason = fixed.QUEUED
        ladder = ladder.when(description.like(pattern), F.lit(reason))
    return ladder.otherwise(description)


def card_action(code: Column) -> Column:
    meanings = F.create_map(*[F.lit(x) for pair in fixed.CARD_ACTIONS.items() for x in pair])
    return F.coalesce(F.try_element_at(meanings, code), F.lit(fixed.OTHER_ACTION))


def segments(channel: Column, text: Column, unicode_channels, plain_channels) -> Column:
    """Billed segments: one, and one more for every length limit the text exceeds."""
    length = F.char_length(text)

    def count(limits):
        return sum((F.coalesce((length > n).cast("int"), F.lit(0)) for n in limits), F.lit(1))

    return (
        F.when(channel.isin(*unicode_channels), count(fixed.UNICODE_SEGMENTS))
        .when(channel.isin(*plain_channels), count(fixed.PLAIN_SEGMENTS))
        .otherwise(F.lit(1))
    )


def message_status(status: Column) -> Column:
    return F.when(status == "0", F.lit("SUCCESS")).otherwise(status)


def registration_status(identity: Column, pin_set: Column) -> Column:
    return F.when((identity == "VERIFIED") & pin_set, F.lit(fixed.REGISTERED)).otherwise(
        F.lit(fixed.ATTEMPTED)
    )


def bank_rail(routing_code: Column, own_code: str) -> Column:
    return F.when(routing_code == own_code, F.lit("CBS")).otherwise(F.lit("EFT"))


def bank_in_time(routing_code: Column, issued: Column, requested: Column, own_code: str) -> Column:
    """Each rail has its own limit: 5 minutes inside the bank, 3 days between banks."""
    return F.when(routing_code == own_code, within(issued, requested, timedelta(minutes=5))).when(
        routing_code != own_code, within(issued, requested, timedelta(days=3))
    )


def service_direction(service: Column, direction: Column, split: Sequence[str]) -> Column:
    joined = F.concat(
        F.coalesce(service, F.lit("")), F.lit("-"), F.coalesce(direction, F.lit(""))
    )
    return F.when(service.isin(*split), joined).otherwise(service)


def sync_phase(message: Column) -> Column:
    return F.when(message.like("%request%"), F.lit("request received")).when(
        message.like("%response%"), F.lit("response generated")
    )


def countable_attempt(response: Column) -> Column:
    return any_like(response, fixed.COUNTABLE_ATTEMPTS)


def with_suffix(name: Column, suffix: Column) -> Column:
    """``name (suffix)``; NULL when either is NULL."""
    return F.concat(name, F.lit(" ("), suffix.cast("string"), F.lit(")"))
