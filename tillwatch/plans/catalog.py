"""The full set of published reports, declared over named tables.

``catalog`` binds every report to its tables, time span and parameters; ``run_reports`` publishes
them. A report that fails is noted and leaves its published version alone; the others go on.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from threading import Lock

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.functions import clock
from tillwatch.functions import fixed_values as fixed
from tillwatch.functions.classify import (
    bank_in_time,
    bank_rail,
    countable_attempt,
    credited,
    duration_label,
    sync_phase,
    within,
)
from tillwatch.functions.clock import EVER
from tillwatch.functions.text import concat_skip_null
from tillwatch.operators import billing, cohort, detail, health, logs, polls, sla, support
from tillwatch.operators.newest import Newest
from tillwatch.operators.summary import cohort_from_summary, hourly_summary
from tillwatch.sources.reports import publish, read_report
from tillwatch.sources.state import State

LOGGER = logging.getLogger(__name__)

MINUTES_5 = timedelta(minutes=5)
MINUTES_20 = timedelta(minutes=20)
LOCAL = timedelta(hours=6)

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Settings:
    """What differs between deployments. Markers are LIKE patterns on logged requests.

    A setting that is None has to be given, unless the reports of ``NEEDED`` that read it are left out.
    """

    # Message channels: unicode texts and plain texts are billed by different segment lengths.
    unicode_channels: tuple[str, ...] | None = None
    plain_channels: tuple[str, ...] | None = None
    billed_operator: str = "BANGLALINK"
    billed_senders: tuple[str, ...] = ("70", "72", "67")
    # Provider endpoints in request logs.
    markup_gateway: str | None = None
    json_gateway: str | None = None
    transfer_gateway: str | None = None
    balance_gateway: str | None = None
    wallet_balance_gateway: str | None = None
    reseller_gateway: str | None = None
    # How long before its request an answer may be logged at most; None searches the whole log.
    answer_slack: timedelta | None = None
    # How far the order of a table's ids may be off that of its times; None reads all history for latest balances.
    newest_slack: timedelta | None = None
    # A shared folder for what polls keep (trailing weeks, latest vendors); None reads all of it every time.
    state: str | None = None
    # Table -> the column that says when a row was last written; settled days of other tables are not read again.
    written: Mapping[str, str] = field(default_factory=dict)
    # The column of bank answers that says when they were logged, if there is one.
    bank_answer_time: str | None = None
    # Support staff: user ids, and address key -> agent name in order of precedence.
    staff: tuple[int, ...] | None = None
    agents: Mapping[str, str] | None = None
    # Fixed dates.
    unanswered_since: datetime = datetime(2025, 4, 1)
    tags_from: datetime = datetime(2025, 1, 1)
    tags_to: datetime = datetime(2025, 3, 1)
    # Codes and event names of the source systems.
    own_bank: str = "CIBLBDDH"
    form_event: str = "event_sqr_rtlr_form_open"
    backup_message: str = "data-backup-done"
    upload_events: tuple[str, ...] = (
        "v6_device_to_server_sync", "v5_device_to_server_sync", "device_to_server_sync_v4"
    )
    sync_event: str = "sync_app_event"
    login_event: str = "user-login-api-v2"
    lookup_event: str = "wallet-lookup-api-v2"


#: Settings without a default, and the reports that read them.
NEEDED: Mapping[str, tuple[str, ...]] = {
    "unicode_channels": ("messages_today", "messages_month", "messages_bill"),
    "plain_channels": ("messages_today", "messages_month", "messages_bill"),
    "markup_gateway": ("rocket_out_today_codes", "rocket_out_month_codes"),
    "json_gateway": ("nagad_out_today_responses", "nagad_out_month_responses"),
    "transfer_gateway": ("transfer_month_reasons", "transfer_today_reasons"),
    "balance_gateway": ("balance_robi_airtel",),
    "wallet_balance_gateway": ("balance_nagad",),
    "reseller_gateway": ("balance_reseller",),
    "staff": ("tickets_resolved", "tickets_resolved_today", "hours_spent", "hours_spent_today"),
    "agents": ("tickets_resolved", "tickets_resolved_today", "hours_spent", "hours_spent_today"),
}


@dataclass(frozen=True)
class Report:
    """One published report. ``covers`` is the number of monitoring statements it answers."""

    build: Callable[[], DataFrame]
    order: tuple[str | Column, ...] = ()
    on_empty: str = "keep"
    target: str = "main"
    covers: int = 1


class Summary:
    """A small aggregate that several reports are summed from.

    With a folder it is computed once, written there under a name of its own (the clock and a run id),
    and read by all of them. Without one each report computes what it needs of it.
    """

    def __init__(self, build: Callable[[], DataFrame], work: str | None, name: str, as_of: datetime):
        self._build = build
        self._path = work and f"{work}/{name}-{as_of:%Y%m%dT%H%M%S}-{uuid.uuid4().hex}"
        self._written: DataFrame | None = None
        self._lock = Lock()

    def __call__(self) -> DataFrame:
        if self._path is None:
            return self._build()
        with self._lock:
            if self._written is None:
                summary = self._build()
                summary.write.parquet(self._path)
                reader = summary.sparkSession.read.schema(summary.schema)
                self._written = reader.parquet(self._path)
        return self._written


def catalog(
    tables: Tables,
    as_of: datetime,
    settings: Settings,
    decoded: Callable[[], DataFrame] | None = None,
    work: str | None = None,
    without: Iterable[str] = (),
) -> dict[str, Report]:
    """Every report at ``as_of``. ``decoded`` supplies the earlier report whose ids are decoded.

    ``work`` is a shared folder for the summaries that reports have in common. ``without`` names reports
    to leave out; a setting that one of the others needs and that is missing is an error.
    """
    left_out = set(without)
    missing = [
        f"{setting} ({', '.join(name for name in names if name not in left_out)})"
        for setting, names in NEEDED.items()
        if getattr(settings, setting) is None and not left_out.issuperset(names)
    ]
    if missing:
        raise ValueError(f"settings are missing: {'; '.join(missing)}")
    groups = (
        _baselines, _health, _recharge, _wallet_in, _wallet_out, _bank, _transfer, _card, _qr, _balances,
        _summaries, _registration, _events, _sales, _messages, _support,
    )
    reports: dict[str, Report] = {}
    for group in groups:
        reports |= group(tables, as_of, settings)
    for group in (_recharge_cohorts, _wallet_out_cohorts, _card_in_cohorts):
        reports |= group(tables, as_of, work)
    if decoded is not None:
        reports["qr_inactive_users"] = Report(
            lambda: detail.decode_and_enrich(decoded(), tables["profile"]), target="users"
        )
    return {name: report for name, report in reports.items() if name not in left_out}


def run_reports(
    reports: Mapping[str, Report],
    roots: Mapping[str, str],
    only: Iterable[str] | None = None,
    at_once: int = 4,
) -> dict[str, int | str]:
    """Publish reports; the result gives each one's number of rows, or the error that stopped it.

    Reports do not depend on each other, so a few of them are submitted at the same time and fill the
    cluster while others wait for their last tasks.
    """

    def run(name: str) -> int | str:
        report = reports[name]
        try:
            return publish(
                report.build(), name, roots[report.target], on_empty=report.on_empty,
                order=report.order,
            )
        except Exception as error:  # whatever stops one report must not stop the others
            LOGGER.warning("report %s was not published: %s", name, error)
            return f"{type(error).__name__}: {error}"

    names = list(reports if only is None else only)
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(names, pool.map(run, names), strict=True))


def published(tables: Tables, name: str, root: str) -> Callable[[], DataFrame]:
    """A published report as the input of another one."""
    spark = next(iter(tables.values())).sparkSession
    return lambda: read_report(spark, name, root)


# --- spans and row conditions ------------------------------------------------------------------


def _month(as_of: datetime) -> clock.Span:
    return clock.rolling(as_of, "date_after_instant")


def _calendar_month(as_of: datetime) -> clock.Span:
    return clock.rolling(as_of, "calendar_month")


def _settled_today(as_of: datetime) -> clock.Span:
    return clock.today(as_of).settled(as_of, MINUTES_5)


def _settled_month(as_of: datetime, lag: timedelta = MINUTES_5) -> clock.Span:
    return _month(as_of).settled(as_of, lag)


def _answers_of(
    span: clock.Span | None, settings: Settings, shift: timedelta = clock.NO_SHIFT
) -> clock.Span | None:
    """Where the answers to the requests of ``span`` are logged; the span's times are read as stored + shift."""
    if span is None or span.start is None or settings.answer_slack is None:
        return None
    return clock.Span(start=span.start - shift - settings.answer_slack)


def _is(column: str, *values: str) -> Column:
    return F.col(column).isin(*values)


def _not_success() -> Column:
    return F.col("status") != "SUCCESS"


def _asked() -> Column:
    return F.col("request_id").isNotNull() & ~F.ilike("request", F.lit(fixed.HEX_REQUEST))


def _credited() -> Column:
    return credited(F.col("response"))


def _own_cash_out(settings: Settings) -> Column:
    return _is("txn_request_type", "CASH_OUT") & _is("bank_swift_code", settings.own_bank)


def _interbank_cash_out(settings: Settings) -> Column:
    other = F.col("bank_swift_code") != settings.own_bank
    return _is("txn_request_type", "CASH_OUT") & other & _is("channel", "BEFTN")


# --- groups of reports -------------------------------------------------------------------------


def _baselines(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    bank = {"ts": "issue_time", "shift": LOCAL}
    bad = _not_success()
    judged = {
        "qr": ("issuer_log", _asked() & ~_credited(), {}),
        "recharge": ("recharge", bad, {"today_bad": ~_is("status", "SUCCESS", "CHECKOUT")}),
        "nagad_in": ("nagad_in", _is("nagad_status", "Failed"), {}),
        "nagad_out": ("wallet_out", bad & _is("financial_institute", "NAGAD"), {}),
        "rocket_in": ("rocket_in", bad, {}),
        "rocket_out": ("wallet_out", bad & _is("financial_institute", "ROCKET"), {}),
        "own_bank": ("bank_request", bad & _is("channel", "CBL"), bank),
        "interbank": (
            "bank_request",
            ~_is("status", "SUCCESS", "REQUESTED") & _is("channel", "BEFTN"),
            bank | {"day_lag": 3},
        ),
        "card_out": ("card_out", bad, {}),
        "transfer": ("bank_transfer", bad & _is("channel", "NPSB", "MTB"), {}),
    }

    def report(name: str, table: str, condition: Column, options: dict) -> Report:
        def build() -> DataFrame:
            state = _state(tables[table], settings, name)
            if state is None:
                return health.threshold_vs_today(tables[table], as_of, baseline_bad=condition, **options)
            return polls.threshold_vs_today_polled(
                tables[table], state, as_of, baseline_bad=condition, changed=settings.written.get(table), **options
            )

        return Report(build, order=("hour", "txn"))

    return {f"threshold_{name}": report(f"threshold_{name}", *parts) for name, parts in judged.items()}


def _state(table: DataFrame, settings: Settings, name: str) -> State | None:
    return None if settings.state is None else State(table.sparkSession, settings.state, name)


def _newest(as_of: datetime, settings: Settings) -> Newest | None:
    return None if settings.newest_slack is None else Newest(as_of, slack=settings.newest_slack)


def _health(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    status, amount = F.col("status"), F.col("amount")
    hour = timedelta(minutes=60)

    def of(table: str, roles: health.Roles, **options) -> DataFrame:
        return health.service_health(tables[table], as_of, roles, **options)

    def build() -> DataFrame:
        judged_in = ~(_is("nagad_status", "Ready", "Aborted", "Cancelled") & _is("status", "FAILED"))
        judged_in = judged_in & (status != "CHECKOUT")
        listed_in = ("SUCCESS", "REFUNDED", "FAILED", "ORDER_ERR", "CHECKOUT", "INITIATED")
        requested = ("SUCCESS", "REQUESTED", "PENDING")
        cash_out = _is("txn_request_type", "CASH_OUT")
        services = {
            "RECHARGE": of(
                "recharge", health.status_roles(reverse=("REVERSED",)),
                by="mobile_operator", members=("GP", "BL", "ROBI", "AIRTEL", "TT"),
            ),
            "NAGAD IN": of("nagad_in", health.status_roles(
                reverse=("REFUNDED",), failed=_is("nagad_status", "Failed"),
                dispute=~status.isin(*listed_in),
                hits=_is("status", "SUCCESS") & judged_in, attempts=judged_in,
            )),
            "ROCKET IN": of("rocket_in", health.status_roles(
                reverse=("REFUNDED",), failed=_is("result", "FAILED"),
                dispute=~status.isin("SUCCESS", "REFUNDED", "FAILED"),
                attempts=F.col("result") != "TIMEOUT",
            )),
            "WALLET OUT": health.services_health(tables["wallet_out"], as_of, {
                "ROCKET OUT": health.Service(
                    health.status_roles(
                        failed=_is("status", "FAILED") & (amount >= 10),
                        dispute=~status.isin("SUCCESS", "REVERSE", "FAILED"),
                        hits=_is("status", "SUCCESS") & (amount >= 10), attempts=amount >= 10,
                    ),
                    where=_is("financial_institute", "ROCKET"),
                ),
                "NAGAD OUT": health.Service(health.status_roles(), where=_is("financial_institute", "NAGAD")),
            }),
            "VISA CARD": of("card_out", health.status_roles(), window=hour, low=50),
            "SQR PAYMENT": health.log_service_health(tables["issuer_log"], as_of, where=_asked()),
            "BANK": health.services_health(tables["bank_request"], as_of, {
                "CBL": health.Service(
                    health.status_roles(
                        failed=~_is("status", "SUCCESS"), dispute=_is("status", "DISPUTE", "PENDING")
                    ),
                    where=_own_cash_out(settings) & _is("channel", "CBL"), low=50,
                ),
                "BEFTN": health.Service(
                    health.status_roles(success=requested, reverse=("REVERSIBLE",)),
                    where=cash_out & _is("channel", "BEFTN"), window=hour,
                    today_lag=timedelta(0), keep_empty=False,
                ),
            }, ts="issue_time", shift=LOCAL),
            "NPSB INSTANT": of(
                "bank_transfer", health.status_roles(dispute=_is("status", "UNKNOWN")),
                where=_is("channel", "NPSB", "MTB"), low=50,
            ),
        }
        return health.health_board(services, by="mobile_operator")

    return {"service_health": Report(build, order=("service",), covers=14)}


def _recharge(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    today, month = _settled_today(as_of), _settled_month(as_of)
    calendar_month = _calendar_month(as_of)

    def table() -> DataFrame:
        return tables["recharge"]

    def bad(span, bucket) -> Report:
        return Report(lambda: cohort.not_success_breakdown(table(), span, bucket), (bucket,))

    def reasons(span, bucket, **options) -> Report:
        return Report(
            lambda: cohort.top_reasons(table(), span, bucket, **options),
            (bucket, F.desc("txn_count")), on_empty="replace",
        )

    def cashback(span, bucket, target="main", **options) -> Report:
        return Report(
            lambda: cohort.cashback_cohort(tables["cashback"], span, bucket, **options), (bucket,),
            target=target,
        )

    operators = {
        "airtel": "AIRTEL", "grameenphone": "GP", "banglalink": "BL", "teletalk": "TT", "robi": "ROBI"
    }
    def vendors() -> DataFrame:
        state = _state(table(), settings, "recharge_vendors")
        if state is None:
            return detail.latest_by_key_pivot(table(), operators)
        return polls.latest_by_key_polled(table(), operators, state, as_of)

    return {
        "recharge_today_breakdown": bad(today, "hour"),
        "recharge_month_breakdown": bad(calendar_month, "day"),
        "recharge_vendors": Report(vendors),
        "report_time": Report(lambda: detail.as_of_stamp(table().sparkSession, as_of)),
        "recharge_today_reasons": reasons(today, "hour"),
        "recharge_month_reasons": reasons(month, "day", monthly=True, counted="txn_id"),
        "cashback_today": cashback(today, "hour"),
        "cashback_month": cashback(calendar_month, "day", range_on="create_date"),
        "cashback_failed": cashback(
            calendar_month, "day", target="users", range_on="create_date", only_failed=True
        ),
    }


def _recharge_cohorts(tables: Tables, as_of: datetime, work: str | None) -> dict[str, Report]:
    """Twelve reports over one reading of the recharges."""
    spans = {
        "today": _settled_today(as_of),
        "month": _settled_month(as_of),
        "calendar_month": _calendar_month(as_of),
    }

    def build() -> DataFrame:
        dims = {name: F.col(name) for name in ("status", "mobile_operator", "vendor_name")}
        dims["duration"] = duration_label(F.col("create_date"), F.col("update_date"))
        return hourly_summary(tables["recharge"], spans, dims)

    summary = Summary(build, work, "recharge_hourly", as_of)
    label = concat_skip_null(F.col("status"), F.lit("  ("), F.col("mobile_operator"), F.lit(")"))
    by_label = {"status_operator": label}
    by_operator = ("status", "mobile_operator")
    bad = ~_is("status", "SUCCESS")

    def cohorts(span, bucket, **options) -> Report:
        return Report(lambda: cohort_from_summary(summary(), span, bucket, **options), (bucket,))

    def durations(span, bucket, by=None) -> Report:
        duration = F.col("duration")
        if by is None:
            # This report spells its last class differently.
            spelled = F.when(
                duration == fixed.LONGEST_DURATION, F.lit(fixed.LONGEST_DURATION_RECHARGE)
            ).otherwise(duration)
            return cohorts(span, bucket, dims={"duration": spelled}, amount_name=None)
        named = concat_skip_null(F.col(by), F.lit(" - ("), duration, F.lit(")"))
        dims = {"duration": duration, f"{by}_duration": named}
        return cohorts(span, bucket, dims=dims, amount_name=None)

    return {
        "recharge_today": cohorts("today", "hour", dims=by_operator, counted="status"),
        "recharge_month": cohorts("month", "day", counted="status"),
        "recharge_today_count": cohorts("today", "hour", dims=by_label, amount_name=None),
        "recharge_month_count": cohorts("calendar_month", "day", dims=by_label, amount_name=None),
        "recharge_today_amount": cohorts("today", "hour", dims=by_label),
        "recharge_month_amount": cohorts(
            "calendar_month", "day", dims=by_label, where=_is("status", "SUCCESS")
        ),
        "recharge_today_failed": cohorts(
            "today", "hour", dims=by_operator, where=bad, amount_name=None
        ),
        "recharge_today_failed_amount": cohorts(
            "today", "hour", dims=by_operator, where=bad, count_name=None
        ),
        "recharge_today_duration": durations("today", "hour"),
        "recharge_month_duration": durations("month", "day"),
        "recharge_today_duration_vendor": durations("today", "hour", "vendor_name"),
        "recharge_today_duration_operator": durations("today", "hour", "mobile_operator"),
    }


def _wallet_in(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    started = ("ORDER_ERR", "INITIATED", "CHECKOUT")
    known = ("SUCCESS", "FAILED", "REFUNDED")

    def provider() -> DataFrame:
        return tables["nagad_in"].withColumnsRenamed(
            {
                "nagad_status": "provider_status",
                "nagad_status_code": "provider_code",
                "tp_transaction_number": "txn_number",
            }
        )

    def folded(table, span, bucket, **options) -> Report:
        return Report(
            lambda: cohort.folded_status_cohort(tables[table], span, bucket, **options), (bucket,),
            on_empty="replace",
        )

    def details(only_status=None) -> Report:
        return Report(
            lambda: detail.txn_detail(provider(), clock.today(as_of), only_status=only_status),
            (F.desc("id"),),
        )

    def monthly(only_status=None) -> Report:
        return Report(
            lambda: cohort.provider_status_monthly(
                provider(), _calendar_month(as_of), only_status=only_status
            ),
            (F.desc("day"), F.desc("txn_count")),
        )

    return {
        "rocket_in_today": folded("rocket_in", _settled_today(as_of), "hour"),
        "rocket_in_month": folded("rocket_in", _settled_month(as_of, MINUTES_20), "day"),
        "nagad_in_today": folded(
            "nagad_in", _settled_today(as_of), "hour", listed=known + started, result="nagad_status",
            where=~_is("status", *started),
        ),
        "nagad_in_month": folded(
            "nagad_in", _settled_month(as_of), "day", result="nagad_status",
            where=~_is("status", *started),
        ),
        "nagad_in_today_detail": details(),
        "nagad_in_month_status": monthly(),
        "nagad_in_today_failed": details("Failed"),
        "nagad_in_month_failed": monthly("Failed"),
    }


def _wallet_out(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    rocket, nagad = _is("financial_institute", "ROCKET"), _is("financial_institute", "NAGAD")

    def codes(span, bucket) -> Report:
        return Report(
            lambda: logs.xml_code_cohort(
                tables["wallet_out"], tables["wallet_out_log"], span, bucket, where=rocket,
                request_marker=settings.markup_gateway, log_span=_answers_of(span, settings),
            ),
            (bucket, F.desc("request_count")),
        )

    def responses(span, bucket) -> Report:
        return Report(
            lambda: logs.raw_response_cohort(
                tables["wallet_out"], tables["wallet_out_log"], span, bucket, where=nagad,
                request_marker=settings.json_gateway, log_span=_answers_of(span, settings), dictionary=True,
            ),
            (F.desc(bucket), F.desc("request_count")),
        )

    return {
        "rocket_out_today_codes": codes(clock.today(as_of), "hour"),
        "rocket_out_month_codes": codes(_settled_month(as_of), "day"),
        "nagad_out_today_responses": responses(clock.today(as_of), "hour"),
        "nagad_out_month_responses": responses(_month(as_of), "day"),
    }


def _wallet_out_cohorts(tables: Tables, as_of: datetime, work: str | None) -> dict[str, Report]:
    spans = {
        "today": clock.today(as_of), "month": clock.rolling(as_of, "dates").settled(as_of, MINUTES_5)
    }
    dims = ("financial_institute", "status")
    both = _is("financial_institute", "ROCKET", "NAGAD")
    summary = Summary(
        lambda: hourly_summary(tables["wallet_out"], spans, dims, where=both),
        work, "wallet_out_hourly", as_of,
    )

    def cohorts(span, bucket) -> Report:
        return Report(
            lambda: cohort_from_summary(summary(), span, bucket, dims=dims, counted="status"), (bucket,)
        )

    return {
        "wallet_out_today": cohorts("today", "hour"), "wallet_out_month": cohorts("month", "day")
    }


def _bank(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    local = {"ts": "issue_time", "shift": LOCAL}
    interbank = _is("txn_request_type", "CASH_OUT") & _is("channel", "BEFTN")
    three_days_ago, month = clock.days_back(as_of, 3), clock.last_days(as_of, 30, 3)

    def answers(span, bucket, where, bank=False, **options) -> Report:
        return Report(
            lambda: logs.bank_response_cohort(
                tables["bank_request"], tables["bank_answer"], span, bucket,
                bank=tables["bank"] if bank else None, where=where, log_ts=settings.bank_answer_time,
                log_span=_answers_of(span, settings, LOCAL) if settings.bank_answer_time else None,
                **local, **options,
            ),
            (bucket, F.desc("request_count")),
        )

    def cohorts(span, bucket) -> Report:
        return Report(
            lambda: cohort.status_cohort(
                tables["bank_request"], span, bucket, where=interbank, **local
            ),
            (bucket,) if isinstance(bucket, str) else bucket,
        )

    own, other = _own_cash_out(settings), _interbank_cash_out(settings)
    return {
        "own_bank_today": answers(clock.since_day(as_of), "hour", own),
        # The range is local, the label is the stored time.
        "own_bank_month": answers(
            clock.since_day(as_of, 30), "day", own, label_shift=clock.NO_SHIFT
        ),
        "interbank_day": answers(three_days_ago, "hour", other, bank=True),
        "interbank_month": answers(month, "day", other, bank=True),
        "interbank_day_status": cohorts(three_days_ago, ("day", "hour")),
        "interbank_month_status": cohorts(month, "day"),
    }


def _transfer(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    instant = _is("channel", "NPSB", "MTB")

    def first_responses(span, bucket) -> Report:
        return Report(
            lambda: logs.first_response_per_request(
                tables["bank_transfer"], tables["bank_log"], span, bucket,
                request_marker=settings.transfer_gateway, log_span=_answers_of(span, settings), fetch=True,
            ),
            (F.desc("request_id"),),
        )

    return {
        "transfer_month_reasons": first_responses(clock.since_day(as_of, 30), "day"),
        "transfer_today_reasons": first_responses(clock.today(as_of), "hour"),
        "transfer_today": Report(
            lambda: cohort.status_cohort(
                tables["bank_transfer"], _settled_today(as_of), "hour",
                dims=("status", "amount", "bank_swift_code"), where=instant, amount=None,
            ),
            ("hour",),
        ),
        "transfer_month": Report(
            lambda: cohort.status_cohort(
                tables["bank_transfer"], _calendar_month(as_of), "day",
                dims=("status", "bank_swift_code"), where=instant,
            ),
            ("day", "bank_swift_code", "status"),
        ),
        "transfer_unanswered": Report(
            lambda: logs.unanswered_requests(
                tables["issuer_log"], clock.Span(after=settings.unanswered_since)
            )
        ),
    }


def _card(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    today = clock.today(as_of)

    def reasons(bucket, span=None) -> Report:
        return Report(
            lambda: logs.reverse_reasons(
                tables["card_out"], tables["bank_log"], bucket, span=span,
                log_span=_answers_of(span, settings),
            ),
            (F.desc("id"),),
        )

    return {
        "card_out_today": Report(
            lambda: cohort.status_cohort(
                tables["card_out"], today, "hour", dims=("bank_name", "status"), counted="status"
            ),
            ("hour",),
        ),
        "card_out_month": Report(
            lambda: cohort.cohort_with_entity_total(
                tables["card_out"], _settled_month(as_of), "bank_name"
            ),
            (F.desc("day"),),
        ),
        "card_out_summary": Report(lambda: cohort.status_summary(tables["card_out"], today)),
        "card_out_disputes": Report(lambda: cohort.lifetime_dispute(tables["card_out"])),
        "card_out_reasons": reasons("day"),
        "card_out_today_reasons": reasons("hour", today),
    }


def _card_in_cohorts(tables: Tables, as_of: datetime, work: str | None) -> dict[str, Report]:
    spans = {"today": clock.today(as_of), "month": _calendar_month(as_of)}
    summary = Summary(
        lambda: hourly_summary(tables["card_in"], spans, ("status", "card_type")),
        work, "card_in_hourly", as_of,
    )

    def cohorts(span, bucket, dims=("status",), where=None) -> Report:
        return Report(
            lambda: cohort_from_summary(summary(), span, bucket, dims=dims, where=where),
            (F.desc(bucket),), target="cards",
        )

    by_card = {"dims": ("card_type", "status"), "where": _is("status", "SUCCESS")}
    return {
        "card_in_today": cohorts("today", "hour"),
        "card_in_month": cohorts("month", "day"),
        "card_in_today_card": cohorts("today", "hour", **by_card),
        "card_in_month_card": cohorts("month", "day", **by_card),
    }


def _qr(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    today, month = _settled_today(as_of), _settled_month(as_of)
    finished_days = clock.through_day(_month(as_of), as_of, 1)

    def zero(build, *order) -> Report:
        return Report(build, order, on_empty="zero_row")

    def statuses(span, bucket) -> Report:
        return zero(
            lambda: logs.log_status_cohort(tables["issuer_log"], span, bucket, where=_asked()),
            bucket, F.desc("request_count"),
        )

    def acquirers(span, bucket) -> Report:
        return zero(
            lambda: cohort.dimension_cohort(
                tables["qr_payment"], tables["acquirer"], "acquirer_id", "acquirer", span, bucket
            ),
            bucket,
        )

    def users(span, bucket) -> Report:
        return zero(
            lambda: logs.error_unique_users(tables["issuer_log"], span, bucket, where=_asked()),
            F.desc(bucket), F.desc("user_count"),
        )

    return {
        "qr_log_today": statuses(today, "hour"),
        "qr_acquirer_today": acquirers(today, "hour"),
        "qr_error_users_today": users(today, "hour"),
        "qr_log_month": statuses(month, "day"),
        "qr_acquirer_month": acquirers(month, "day"),
        "qr_error_users_month": users(month, "day"),
        "qr_growth": zero(
            lambda: sla.daily_growth(tables["qr_payment"], finished_days), F.desc("day"), "status"
        ),
        "qr_tag_fields": Report(
            lambda: logs.tag_fields(
                tables["issuer_log"],
                clock.Span(start=settings.tags_from, upto=settings.tags_to),
                where=F.ilike("request", F.lit(fixed.HEX_REQUEST)),
            ),
            (F.desc("id"),), target="users",
        ),
    }


def _balances(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    return {
        "balance_robi_airtel": Report(
            lambda: detail.latest_marked_balances(
                tables["recharge"], tables["recharge_log"], {"robi": "ROBI", "airtel": "AIRTEL"},
                settings.balance_gateway, search=_newest(as_of, settings),
            )
        ),
        "balance_nagad": Report(
            lambda: detail.latest_json_balance(
                tables["recharge_log"], settings.wallet_balance_gateway, search=_newest(as_of, settings)
            )
        ),
        "balance_reseller": Report(
            lambda: detail.guarded_json_balance(
                tables["recharge"], tables["recharge_log"], "PAYSTATION", settings.reseller_gateway,
                where=_is("number_of_try", "0"), search=_newest(as_of, settings),
            )
        ),
    }


def _summaries(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    good = _is("status", "SUCCESS")
    start, end = F.col("create_date"), F.col("update_date")
    issued, answered, swift = F.col("issue_time"), F.col("request_time"), F.col("bank_swift_code")

    def totals() -> DataFrame:
        yesterday = clock.yesterday(as_of)

        def total(name, table, where=None) -> sla.ServiceTotal:
            held = good if where is None else good & where
            return sla.ServiceTotal(name, tables[table], yesterday, held)

        bank = tables["bank_request"]
        local = {"ts": "issue_time", "shift": LOCAL}
        return sla.daily_service_totals(
            [
                total("Recharge", "recharge"),
                sla.ServiceTotal("CBL", bank, yesterday, good & _is("channel", "CBL"), **local),
                # Bank-to-bank transfers settle late: three whole days, whatever their status.
                sla.ServiceTotal(
                    "BEFTN", bank, clock.last_days(as_of, 3, 1), _is("channel", "BEFTN"), **local
                ),
                total("Nagad Money in", "nagad_in"),
                total("Rocket money in", "rocket_in"),
                total("Nagad Money Out", "wallet_out", _is("financial_institute", "NAGAD")),
                total("Rocket Money Out", "wallet_out", _is("financial_institute", "ROCKET")),
                total("SQR Payment", "qr_payment"),
                total("VISA Card Transfer", "card_out"),
                total("NPSB", "bank_transfer", _is("channel", "NPSB")),
                total("MTB", "bank_transfer", _is("channel", "MTB")),
            ]
        )

    def satisfaction() -> DataFrame:
        ended = _is("status", "FAILED", "SUCCESS")

        def money_in(table, name) -> sla.Satisfaction:
            return sla.Satisfaction(
                "Money In", tables[table], F.lit(name), within(start, end, MINUTES_5), ended
            )

        services = [
            sla.Satisfaction(
                "Money Out", tables["wallet_out"], F.col("financial_institute"),
                within(start, end, timedelta(minutes=1)), _is("status", "REVERSE", "SUCCESS", "FAILED"),
            ),
            sla.Satisfaction(
                "Money Out", tables["bank_request"], bank_rail(swift, settings.own_bank),
                bank_in_time(swift, issued, answered, settings.own_bank),
                _is("txn_request_type", "CASH_OUT") & ended, ts="issue_time", shift=LOCAL,
            ),
            sla.Satisfaction(
                "Recharge", tables["recharge"], F.lit("Recharge"),
                within(start, end, timedelta(seconds=350)),
            ),
            money_in("nagad_in", "Nagad IN"),
            money_in("rocket_in", "Rocket IN"),
            money_in("card_in", "Card In"),
            sla.Satisfaction(
                "Super QR Payment", tables["issuer_log"], F.lit("Super QR Payment"), _credited(),
                _asked(), countable_attempt(F.col("response")),
            ),
        ]
        return sla.weekly_satisfaction(services, clock.previous_week(as_of))

    return {
        "daily_totals": Report(totals, covers=11),
        "weekly_satisfaction": Report(satisfaction, ("level", "family", "service"), covers=7),
        "reconciliation": Report(
            lambda: cohort.reconciliation_rollups(tables["reconciliation"]),
            ("report", F.desc("day")), covers=6,
        ),
        "mail_kpi": Report(
            lambda: cohort.assignee_kpi(tables["support_mail"], _calendar_month(as_of)),
            (F.desc("day"),),
        ),
    }


def _registration(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    def funnel(span, bucket) -> Report:
        return Report(
            lambda: cohort.registration_funnel(tables["profile"], span, bucket), (F.desc(bucket),)
        )

    def approved(span, bucket) -> Report:
        return Report(lambda: detail.audit_transitions(tables["audit"], span, bucket))

    return {
        "registration_today": funnel(clock.today(as_of), "hour"),
        "registration_month": funnel(clock.since_day(as_of, 30), "day"),
        "qr_form_opened": Report(
            lambda: detail.form_open_events(
                tables["app_event"], clock.today(as_of), event_name=settings.form_event,
                label="SQR_FORM_OPENED",
            ),
            (F.desc("id"),),
        ),
        "qr_approved_today": approved(clock.today(as_of), "hour"),
        "qr_approved_month": approved(_calendar_month(as_of), "day"),
    }


def _events(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    today = clock.today(as_of)
    sync = _is("event_name", settings.sync_event)
    error = _is("level", "ERROR")

    def counts(where, dims, with_day=True) -> Report:
        return Report(
            lambda: cohort.event_counts(
                tables["event"], today, where=where, dims=dims, with_day=with_day
            ),
            ("hour",),
        )

    def latest(name, only_errors=False, user=False) -> Report:
        columns = ("level", "event_name", "message", "details") + (("user_id",) if user else ())
        return Report(
            lambda: detail.latest_events(
                tables["event"], name, only_errors=only_errors, columns=columns
            ),
            (F.desc("id"),),
        )

    return {
        "backup_today": counts(
            _is("message", settings.backup_message), ("event_name", "message")
        ),
        "backup_errors_today": counts(
            error & _is("event_name", *settings.upload_events), ("event_name", "message", "details")
        ),
        "sync_today": counts(
            sync & _is("level", "INFO"), {"message": sync_phase(F.col("message"))}, with_day=False
        ),
        "sync_errors_today": counts(sync & error, ("level", "event_name", "message")),
        "login_latest": latest(settings.login_event),
        "login_errors": latest(settings.login_event, only_errors=True),
        "lookup_latest": latest(settings.lookup_event, user=True),
        "lookup_errors": latest(settings.lookup_event, only_errors=True, user=True),
    }


def _sales(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    def sales(span, bucket, **options) -> Report:
        return Report(
            lambda: cohort.package_sales(tables["purchase"], span, bucket, **options),
            (F.desc("day"),),
        )

    return {
        "packages_today": sales(clock.today(as_of), ("day", "hour")),
        "packages_month": sales(_calendar_month(as_of), "day"),
        "packages_active": Report(lambda: detail.active_plans(tables["plan"]), (F.desc("id"),)),
        "packages_sold": sales(
            EVER, "day", where=_is("status", "PURCHASED"), labelled=False, counted=None
        ),
    }


def _messages(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    channels = (*(settings.unicode_channels or ()), *(settings.plain_channels or ()))
    billed = (
        _is("telco_identifier_id", *settings.billed_senders)
        & _is("message_status", "0", "SUCCESS")
        & _is("telecom_operator", settings.billed_operator)
    )

    def cohorts(span, bucket) -> Report:
        return Report(
            lambda: billing.sms_cohort(tables["message"], span, bucket, channels=channels),
            (F.desc(bucket),), on_empty="replace",
        )

    return {
        "messages_today": cohorts(
            clock.since_day(as_of).settled(as_of, MINUTES_5), "hour_number"
        ),
        "messages_month": cohorts(_calendar_month(as_of), "day"),
        "messages_bill": Report(
            lambda: billing.sms_bill(
                tables["message"], clock.previous_month(as_of), where=billed, formatted=True,
                unicode_channels=settings.unicode_channels, plain_channels=settings.plain_channels,
            )
        ),
    }


def _support(tables: Tables, as_of: datetime, settings: Settings) -> dict[str, Report]:
    people = ("email", "issue_status")

    def resolved() -> DataFrame:
        return support.latest_journals(
            tables["journal"], tables["issue"], *[tables[name] for name in people], as_of,
            staff=settings.staff,
        )

    def spent() -> DataFrame:
        return support.first_entries(
            tables["issue"], tables["time_entry"], *[tables[name] for name in people], as_of,
            staff=settings.staff,
        )

    def pivot(rows) -> Report:
        return Report(
            lambda: support.resolution_pivot(rows(), as_of, settings.agents),
            ("address", "subject"), covers=0,
        )

    return {
        "tickets_resolved": Report(
            lambda: support.resolution_counts(resolved(), as_of, settings.agents), ("date", "agent")
        ),
        "tickets_resolved_today": pivot(resolved),
        "hours_spent": Report(
            lambda: support.operation_hours(spent(), as_of, settings.agents), ("date", "agent")
        ),
        "hours_spent_today": pivot(spent),
    }
