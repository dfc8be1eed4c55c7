"""The checked queries: every report operator on the test tables, at a fixed clock."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwatch.functions import clock
from tillwatch.functions.classify import bank_in_time, bank_rail, countable_attempt, credited, sync_phase, within
from tillwatch.functions.clock import EVER
from tillwatch.functions.fixed_values import HEX_REQUEST, PROFILE_MISSING
from tillwatch.functions.text import concat_skip_null
from tillwatch.operators import billing, cohort, detail, health, logs, polls, sla, support
from tillwatch.operators.distinct import Buckets
from tillwatch.operators.newest import Newest
from tillwatch.operators.summary import cohorts_from_summary, hourly_summary
from tillwatch.sources import roles
from tillwatch.sources.reports import label_union, normalise
from tillwatch.sources.state import State, work_folder

Query = Callable[[SparkSession, str], DataFrame]

NOW = roles.EVENTS_CLOCK
LATER = roles.ORDERS_CLOCK
SIX_HOURS = timedelta(hours=6)
FIVE_MINUTES = timedelta(minutes=5)
TODAY = clock.today(NOW)
TODAY_SETTLED = TODAY.settled(NOW, FIVE_MINUTES)
MONTH = clock.rolling(NOW, "date_after_instant")
MONTH_SETTLED = MONTH.settled(NOW, FIVE_MINUTES)
CALENDAR_MONTH = clock.rolling(NOW, "calendar_month")
CHANNELS = ("user", "assistant", "system")
STAFF = (0, 1, 2, 3, 4)

REGISTRY: dict[str, Query] = {}


def checked(query: Query) -> Query:
    """Register a query under its function name, with publishable cells."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalise(query(spark, sf_dir))

    REGISTRY[query.__name__] = run
    return query


def asked():
    """Requests a service answers for: known id, not an internal one."""
    return F.col("request_id").isNotNull() & ~F.ilike("request", F.lit(HEX_REQUEST))


# --- failure baselines -------------------------------------------------------------------------


@checked
def r01_threshold_vs_today(spark, sf_dir):
    status = F.col("status")
    return health.threshold_vs_today(
        roles.txn(spark, sf_dir), NOW,
        baseline_bad=status != "SUCCESS", today_bad=~status.isin("SUCCESS", "PENDING"),
    )


@checked
def r01_threshold_shifted(spark, sf_dir):
    return health.threshold_vs_today(
        roles.txn(spark, sf_dir), NOW, baseline_bad=F.col("status") != "SUCCESS", shift=SIX_HOURS,
    )


@checked
def r01_threshold_lagged(spark, sf_dir):
    return health.threshold_vs_today(
        roles.txn(spark, sf_dir), NOW, baseline_bad=F.col("status") == "FAILED",
        shift=SIX_HOURS, day_lag=3,
    )


@checked
def r01_threshold_log(spark, sf_dir):
    return health.threshold_vs_today(
        roles.txn_log(spark, sf_dir), NOW,
        baseline_bad=asked() & ~credited(F.col("response")),
    )


@checked
def r01_threshold_zero_fill(spark, sf_dir):
    return health.threshold_vs_today(
        roles.txn(spark, sf_dir), NOW, baseline_bad=F.col("status") == "FAILED", zero_fill=True,
    )


def polled(spark, sf_dir, report, table=roles.txn, clocks=(timedelta(days=9, hours=7), timedelta(days=2), timedelta(0))):
    """The last of several polls; the earlier ones saw only what had been written by then."""
    state = State(spark, work_folder(spark), "polled")
    for before in clocks:
        as_of = NOW - before
        seen = table(spark, sf_dir)
        found = report(seen.filter(clock.Span(upto=as_of).covers("create_date")) if before else seen, state, as_of)
    return found


@checked
def r01_threshold_polled(spark, sf_dir):
    """The trailing weeks summed from settled days, after polls of nine and two days before."""
    status = F.col("status")
    return polled(spark, sf_dir, lambda txn, state, as_of: polls.threshold_vs_today_polled(
        txn, state, as_of, baseline_bad=status != "SUCCESS", today_bad=~status.isin("SUCCESS", "PENDING"),
    ))


@checked
def r01_threshold_polled_shifted(spark, sf_dir):
    return polled(spark, sf_dir, lambda txn, state, as_of: polls.threshold_vs_today_polled(
        txn, state, as_of, baseline_bad=F.col("status") == "FAILED", shift=SIX_HOURS, day_lag=3,
    ))


# --- service health ----------------------------------------------------------------------------


def recharge_roles():
    return health.status_roles(reverse=("REVERSED",))


@checked
def r02_service_health(spark, sf_dir):
    return health.service_health(roles.txn(spark, sf_dir), NOW, recharge_roles())


@checked
def r02_health_by_operator(spark, sf_dir):
    return health.service_health(
        roles.txn(spark, sf_dir), NOW, recharge_roles(),
        by="mobile_operator", members=(*roles.OPERATORS, "SILENT"),
    )


@checked
def r02_health_own_rate(spark, sf_dir):
    """Overlapping roles, a rate of its own, a wider window and a shifted clock."""
    status = F.col("status")
    own = health.status_roles(
        success=("SUCCESS", "PENDING"), reverse=("REVERSED",),
        failed=("FAILED",), dispute=~status.isin("SUCCESS"),
        hits=(status == "SUCCESS") & (F.col("amount") >= 10), attempts=F.col("amount") >= 10,
    )
    return health.service_health(
        roles.txn(spark, sf_dir), NOW, own, shift=SIX_HOURS, window=timedelta(minutes=600),
        today_lag=timedelta(0), low=20, high=70, keep_empty=False,
    )


@checked
def r03_log_service_health(spark, sf_dir):
    return health.log_service_health(roles.txn_log(spark, sf_dir), NOW, where=asked())


@checked
def r04_health_board(spark, sf_dir):
    recharge = {
        f"RECHARGE ({name})": health.Service(recharge_roles(), F.col("mobile_operator") == name) for name in roles.OPERATORS
    }
    card = health.Service(recharge_roles(), F.col("vendor_name") == "V1", window=timedelta(minutes=60), low=50)
    services = {
        "PAYMENTS": health.services_health(roles.txn(spark, sf_dir), NOW, {**recharge, "VISA CARD": card}),
        "SQR PAYMENT": health.log_service_health(roles.txn_log(spark, sf_dir), NOW, where=asked()),
    }
    return health.health_board(services)


# --- cohorts -----------------------------------------------------------------------------------


@checked
def r05_status_cohort_hour(spark, sf_dir):
    return cohort.status_cohort(
        roles.txn(spark, sf_dir), TODAY_SETTLED, dims=("status", "mobile_operator"), counted="status"
    )


@checked
def r05_status_cohort_day(spark, sf_dir):
    return cohort.status_cohort(
        roles.txn(spark, sf_dir), MONTH_SETTLED, "day", counted="status"
    )


@checked
def r05_status_cohort_label(spark, sf_dir):
    label = concat_skip_null(
        F.col("status"), F.lit("  ("), F.col("mobile_operator"), F.lit(")")
    )
    return cohort.status_cohort(
        roles.txn(spark, sf_dir), CALENDAR_MONTH, "day", dims={"status_operator": label}
    )


@checked
def r05_status_cohort_day_hour(spark, sf_dir):
    return cohort.status_cohort(
        roles.txn(spark, sf_dir), clock.days_back(NOW, 3), ("day", "hour"), shift=SIX_HOURS
    )


@checked
def r05_cohorts_from_summary(spark, sf_dir):
    """Three cohorts of different spans, buckets and dimensions over one reading of the table."""
    spans = {"today": TODAY_SETTLED, "month": CALENDAR_MONTH, "ever": EVER}
    hourly = hourly_summary(roles.txn(spark, sf_dir), spans, ("status", "mobile_operator"))

    return cohorts_from_summary(hourly, {
        "today": ("today", "hour", None),
        "month": ("month", "day", F.col("mobile_operator") == "GP"),
        "ever": ("ever", "day", None),
    })


@checked
def r05_status_cohort_history(spark, sf_dir):
    return cohort.status_cohort(roles.orders_fact(spark, sf_dir), EVER, "day")


@checked
def r06_not_success_breakdown(spark, sf_dir):
    return cohort.not_success_breakdown(roles.txn(spark, sf_dir), CALENDAR_MONTH, "day")


@checked
def r06_not_success_amount(spark, sf_dir):
    return cohort.not_success_breakdown(
        roles.txn(spark, sf_dir), TODAY_SETTLED, dims=("status", "mobile_operator"), measure="amount"
    )


@checked
def r07_folded_status_cohort(spark, sf_dir):
    return cohort.folded_status_cohort(
        roles.txn(spark, sf_dir), TODAY_SETTLED, result="provider_status"
    )


@checked
def r07_folded_status_month(spark, sf_dir):
    return cohort.folded_status_cohort(
        roles.txn(spark, sf_dir), MONTH.settled(NOW, timedelta(minutes=20)), "day",
        result="provider_status", where=~F.col("status").isin("REVERSED"),
    )


@checked
def r08_dimension_cohort(spark, sf_dir):
    return cohort.dimension_cohort(
        roles.orders_fact(spark, sf_dir), roles.customer(spark, sf_dir), "custkey", "c_mktsegment",
        EVER, "day", dimension_key="c_custkey",
    )


@checked
def r09_duration_cohort(spark, sf_dir):
    return cohort.duration_cohort(roles.txn(spark, sf_dir), MONTH_SETTLED, "day")


@checked
def r09_duration_by_vendor(spark, sf_dir):
    return cohort.duration_cohort(roles.txn(spark, sf_dir), TODAY_SETTLED, by="vendor_name")


@checked
def r10_top_reasons(spark, sf_dir):
    return cohort.top_reasons(roles.txn(spark, sf_dir), TODAY_SETTLED)


@checked
def r10_top_reasons_month(spark, sf_dir):
    return cohort.top_reasons(
        roles.txn(spark, sf_dir), MONTH_SETTLED, "day", monthly=True, counted="txn_number", share=True
    )


def _described(txn: DataFrame) -> DataFrame:
    """Descriptions in the words of the sources: every template of a reason, near misses, and none."""
    id = F.col("id").cast("string")
    again = " same recharge service within 2.00 minutes of last successful transaction as last transfer amount is same as current requested amount."
    texts = [
        F.concat(F.lit("invalid transfer value "), id),
        F.concat(F.lit("The mobile number 0"), id, F.lit(" cannot use the"), F.lit(again)),
        F.concat(F.lit("x 3006202:The mobile number 0"), id, F.lit(" cannot use the any recharge service within 3.00 minutes of last successful "
                       "transaction as last transfer amount is same as current requested amount. y")),
        F.concat(F.lit("Your current request to transfer "), id, F.lit(" TAKA cannot be processed as you do not have enough credit.")),
        F.lit("Your current request to transfer 5TAKA cannot be processed as you do not have enough credit."),
        F.concat(F.lit("Your request to recharge 0"), (F.col("id") % 2).cast("string"), F.lit(" is already in queue. Please wait for sometime.")),
        F.lit("Invalid transfer value"),
        F.lit(None).cast("string"),
    ]
    return txn.withColumn("description", F.element_at(F.array(*texts), (F.col("id") % len(texts) + 1).cast("int")))


@checked
def r10_reason_templates(spark, sf_dir):
    return cohort.top_reasons(_described(roles.txn(spark, sf_dir)), TODAY_SETTLED, n=8)


@checked
def r10_reason_templates_month(spark, sf_dir):
    return cohort.top_reasons(_described(roles.txn(spark, sf_dir)), MONTH_SETTLED, "day", n=8, monthly=True)


@checked
def r11_latest_by_key_pivot(spark, sf_dir):
    columns = {
        "airtel": "AIRTEL", "grameenphone": "GP", "banglalink": "BL", "teletalk": "TT", "robi": "ROBI"
    }
    return detail.latest_by_key_pivot(roles.txn(spark, sf_dir), columns)


@checked
def r11_latest_by_key_polled(spark, sf_dir):
    """The newest vendors kept between polls; a poll reads the last day's rows."""
    columns = {
        "airtel": "AIRTEL", "grameenphone": "GP", "banglalink": "BL", "teletalk": "TT", "robi": "ROBI"
    }
    return polled(spark, sf_dir, lambda txn, state, as_of: polls.latest_by_key_polled(txn, columns, state, as_of))


@checked
def r12_newest_stamp(spark, sf_dir):
    """The clock of a replayed table."""
    return detail.newest_stamp(roles.txn(spark, sf_dir))


# --- logs --------------------------------------------------------------------------------------


@checked
def r13_bank_response_cohort(spark, sf_dir):
    return logs.bank_response_cohort(
        roles.orders_fact(spark, sf_dir), roles.line_log(spark, sf_dir), EVER, "day",
        ts="create_date",
    )


@checked
def r13_bank_response_by_bank(spark, sf_dir):
    return logs.bank_response_cohort(
        roles.orders_fact(spark, sf_dir), roles.line_log(spark, sf_dir),
        clock.through_day(EVER, LATER, 3), "day", bank=roles.banks(spark, sf_dir),
        ts="create_date", shift=SIX_HOURS, where=F.col("bank_swift_code") != "7",
    )


@checked
def r13_bank_response_label(spark, sf_dir):
    """The filter reads the shifted time, the label the stored one."""
    return logs.bank_response_cohort(
        roles.txn(spark, sf_dir),
        roles.txn_log(spark, sf_dir), clock.since_day(NOW, 30), "day", ts="create_date",
        shift=SIX_HOURS, label_shift=timedelta(0),
    )


@checked
def r13_bank_response_recent(spark, sf_dir):
    """Only answers logged from a day before the span on are searched."""
    span = clock.since_day(NOW, 10)
    return logs.bank_response_cohort(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), span, "day", ts="create_date",
        log_span=clock.Span(start=span.start - timedelta(days=1)), log_ts="create_date",
    )


@checked
def r14_log_status_cohort(spark, sf_dir):
    return logs.log_status_cohort(roles.txn_log(spark, sf_dir), TODAY_SETTLED, where=asked())


@checked
def r14_log_status_month(spark, sf_dir):
    return logs.log_status_cohort(roles.txn_log(spark, sf_dir), MONTH_SETTLED, "day", where=asked())


@checked
def r15_error_unique_users(spark, sf_dir):
    return logs.error_unique_users(roles.txn_log(spark, sf_dir), TODAY_SETTLED, where=asked())


@checked
def r15_error_unique_users_month(spark, sf_dir):
    return logs.error_unique_users(roles.txn_log(spark, sf_dir), MONTH_SETTLED, "day", where=asked())


def _spans():
    return {
        "today": Buckets(TODAY_SETTLED, "hour"), "month": Buckets(MONTH_SETTLED, "day"), "all": Buckets(MONTH_SETTLED),
    }


@checked
def r15_error_users_by_span(spark, sf_dir):
    """Distinct users by hour, by day and of the whole month from one reading of the log."""
    return logs.error_users_by_span(roles.txn_log(spark, sf_dir), _spans(), where=asked())


@checked
def r17_xml_codes_by_span(spark, sf_dir):
    return logs.xml_codes_by_span(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), _spans(), request_marker="%requestDateTime%",
    )


@checked
def r16_daily_growth(spark, sf_dir):
    whole_days = clock.through_day(MONTH, NOW, 1)
    return sla.daily_growth(roles.txn(spark, sf_dir), whole_days)


@checked
def r16_daily_growth_per_status(spark, sf_dir):
    whole_days = clock.through_day(MONTH, NOW, 1)
    return sla.daily_growth(roles.txn(spark, sf_dir), whole_days, per_status=True)


@checked
def r17_xml_code_cohort(spark, sf_dir):
    return logs.xml_code_cohort(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), MONTH_SETTLED, "day",
        request_marker="%requestDateTime%",
    )


@checked
def r17_xml_code_today(spark, sf_dir):
    return logs.xml_code_cohort(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), TODAY,
        where=F.col("vendor_name") == "V1",
    )


@checked
def r18_raw_response_cohort(spark, sf_dir):
    return logs.raw_response_cohort(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), MONTH, "day",
        where=F.col("mobile_operator") == "GP", request_marker="%requestdatetime%",
    )


@checked
def r18_raw_response_lines(spark, sf_dir):
    return logs.raw_response_cohort(
        roles.orders_fact(spark, sf_dir), roles.line_log(spark, sf_dir), EVER, "day"
    )


@checked
def r18_raw_response_dictionary(spark, sf_dir):
    return logs.raw_response_cohort(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), MONTH, "hour", request_marker="%requestdatetime%",
        dictionary=True,
    )


@checked
def r19_cohort_with_entity_total(spark, sf_dir):
    return cohort.cohort_with_entity_total(roles.orders_fact(spark, sf_dir), EVER, "priority")


@checked
def r19_entity_total_polled(spark, sf_dir):
    """Days and totals of the month summed from settled days."""
    return polled(spark, sf_dir, lambda txn, state, as_of: polls.cohort_with_entity_total_polled(
        txn, state, as_of, clock.rolling(as_of, "date_after_instant"), "vendor_name",
    ))


@checked
def r20_status_summary(spark, sf_dir):
    return cohort.status_summary(roles.orders_fact(spark, sf_dir), EVER, ("F", "O", "P"))


@checked
def r21_lifetime_dispute(spark, sf_dir):
    return cohort.lifetime_dispute(roles.orders_fact(spark, sf_dir), "P")


@checked
def r22_reverse_reasons(spark, sf_dir):
    return logs.reverse_reasons(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), status="REVERSED",
        request_marker="%receiver_wallet%", entity="mobile_operator",
    )


@checked
def r22_reverse_reasons_today(spark, sf_dir):
    return logs.reverse_reasons(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), "hour", span=TODAY,
        status="REVERSED", request_marker="%receiver_wallet%", entity="mobile_operator",
    )


@checked
def r23_first_response_per_request(spark, sf_dir):
    return logs.first_response_per_request(
        roles.orders_fact(spark, sf_dir), roles.line_log(spark, sf_dir), EVER,
        statuses=("F", "P"), columns=("status", "amount", "priority"), request_marker="%SUPPLIER%",
    )


@checked
def r23_first_response_fetched(spark, sf_dir):
    return logs.first_response_per_request(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), MONTH, "hour", statuses=("REVERSED", "FAILED"),
        columns=("status", "amount", "mobile_operator"), fetch=True,
    )


@checked
def r24_unanswered_requests(spark, sf_dir):
    return logs.unanswered_requests(
        roles.txn_log(spark, sf_dir), clock.Span(after=clock.midnight(NOW) - timedelta(days=25))
    )


# --- details and look-ups ----------------------------------------------------------------------


def stamped(report: DataFrame) -> DataFrame:
    """Times as text: both engines write them alike."""
    return report.withColumn("create_date", F.date_format("create_date", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@checked
def r25_txn_detail(spark, sf_dir):
    return stamped(detail.txn_detail(roles.txn(spark, sf_dir), TODAY))


@checked
def r25_txn_detail_failed(spark, sf_dir):
    return stamped(detail.txn_detail(roles.txn(spark, sf_dir), EVER, only_status="Failed"))


@checked
def r26_provider_status_monthly(spark, sf_dir):
    return cohort.provider_status_monthly(roles.txn(spark, sf_dir), CALENDAR_MONTH)


@checked
def r26_provider_failed_monthly(spark, sf_dir):
    return cohort.provider_status_monthly(
        roles.txn(spark, sf_dir), CALENDAR_MONTH, only_status="Failed"
    )


@checked
def r26_provider_states(spark, sf_dir):
    """All states a provider reports, and one that nobody knows."""
    states = F.array(*[F.lit(s) for s in (
        "Ready", "Success", "Failed", "Aborted", "Cancelled", "Refunded", "TransactionInProgress", "Lost")])
    txn = roles.txn(spark, sf_dir).withColumn("provider_status", F.try_element_at(states, (F.col("id") % 9 + 1).cast("int")))
    return cohort.provider_status_monthly(txn, CALENDAR_MONTH)


@checked
def r27_latest_balance(spark, sf_dir):
    return detail.latest_marked_balances(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), {"one": "V1", "two": "V2"},
        "%requestDateTime%", search=Newest(NOW),
    )


@checked
def r27_latest_balance_history(spark, sf_dir):
    """Without a search: the latest of all history in one job."""
    return detail.latest_marked_balances(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), {"one": "V1", "two": "V2"},
        "%requestDateTime%",
    )


@checked
def r27_latest_json_balance(spark, sf_dir):
    return detail.latest_json_balance(
        roles.txn_log(spark, sf_dir), "%REQUESTDATETIME%", balance_path="$.new_balance", search=Newest(NOW)
    )


@checked
def r27_guarded_balance(spark, sf_dir):
    return detail.guarded_json_balance(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), "V0", "%receiver%", search=Newest(NOW)
    )


@checked
def r27_guarded_balance_rare(spark, sf_dir):
    """A success that lies far back: the search has to go on through several slices."""
    rare = F.col("create_date") < F.lit("2024-01-09 05:00:00").cast("timestamp_ntz")
    return detail.guarded_json_balance(
        roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir), "V0", "%receiver%", where=rare,
        search=Newest(NOW, first=timedelta(minutes=30), growth=4),
    )


@checked
def r28_tag_fields(spark, sf_dir):
    return logs.tag_fields(
        roles.markup(spark, sf_dir), json_path=None, keep=("page_id", "url"),
        fields={"title": r"<title>([^<]+)</title>", "language": r'<html lang="([^"]+)"'},
    )


@checked
def r28_tag_fields_json(spark, sf_dir):
    """Markup inside a JSON text: both fields, one of them, none, and texts that are no JSON."""
    id = F.col("id").cast("string")
    one, two = (F.concat(F.lit(f'<field id=\\"{n}\\" value=\\"'), id, F.lit('\\"/>')) for n in (32, 39))
    parts = F.array(F.concat(one, two), one, two, F.lit("<field/>"))
    markup = F.element_at(parts, (F.col("id") % 4 + 1).cast("int"))
    log = roles.txn_log(spark, sf_dir).withColumn("update_date", F.col("create_date")).withColumn("response", F.when(
        F.col("id") % 5 == 0, markup).otherwise(F.concat(F.lit('{"xml": "'), markup, F.lit('"}'))))
    return logs.tag_fields(log, TODAY, keep=("id", "request_id"))


@checked
def r29_decode_and_enrich(spark, sf_dir):
    customer = roles.customer(spark, sf_dir)
    report = customer.select(
        F.col("c_nationkey").cast("string").alias("day"), F.col("c_name").alias("wallet"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lit("SUCCESS"))
        .when(F.col("c_nationkey") % 3 == 1, F.lit(PROFILE_MISSING)).alias("status"),
    )
    return detail.decode_and_enrich(
        report, customer, keep=("day",), start=10, offset=7, key="c_custkey",
        columns={"biz_name": "c_mktsegment", "current_merchant_id": "c_name"},
    )


# --- daily, weekly, reconciliation -------------------------------------------------------------


@checked
def r30_daily_service_totals(spark, sf_dir):
    txn = roles.txn(spark, sf_dir)
    success = F.col("status") == "SUCCESS"
    yesterday = clock.yesterday(NOW)
    services = [
        sla.ServiceTotal("Recharge", txn, yesterday, success),
        sla.ServiceTotal("Bank", txn, yesterday, success & (F.col("vendor_name") == "V1"),
                         shift=SIX_HOURS),
        sla.ServiceTotal("Transfer", txn, clock.last_days(NOW, 3, 1), shift=SIX_HOURS),
        sla.ServiceTotal("Silent", txn, yesterday, F.col("status") == "NEVER"),
    ]
    services += [
        sla.ServiceTotal(f"Money {name}", txn, yesterday, success & (F.col("mobile_operator") == name))
        for name in roles.OPERATORS
    ]
    return sla.daily_service_totals(services)


@checked
def r31_weekly_satisfaction(spark, sf_dir):
    txn, log = roles.txn(spark, sf_dir), roles.txn_log(spark, sf_dir)
    start, end, status = F.col("create_date"), F.col("update_date"), F.col("status")

    def quick(**limit):
        return within(start, end, timedelta(**limit))

    services = [
        sla.Satisfaction("Money Out", txn, F.col("mobile_operator"), quick(seconds=60),
                         where=status.isin("REVERSED", "SUCCESS", "FAILED")),
        sla.Satisfaction("Recharge", txn, F.lit("Recharge"), quick(seconds=350), shift=SIX_HOURS),
        sla.Satisfaction("Money In", txn, F.concat(F.col("vendor_name"), F.lit(" IN")),
                         quick(minutes=5), where=status.isin("FAILED", "SUCCESS")),
        sla.Satisfaction("Super QR Payment", log, F.lit("Super QR Payment"),
                         credited(F.col("response")), where=asked(),
                         attempt=countable_attempt(F.col("response"))),
    ]
    return sla.weekly_satisfaction(services, clock.previous_week(NOW))


@checked
def r31_bank_rail(spark, sf_dir):
    """Two bank rails, each with its own limit, and attempts by all their markers."""
    swift, id = F.col("bank_swift_code"), F.col("id")
    issued, answered = F.col("create_date"), F.col("update_date")
    bank = roles.txn(spark, sf_dir).withColumn(
        "bank_swift_code", F.when(id % 5 != 4, F.when(id % 3 == 0, F.lit("OWN")).otherwise(F.lit("OTHER")))
    ).withColumn("update_date", F.timestamp_add("HOUR", (id % 8) * 12 * F.when(id % 2 == 0, 1).otherwise(0), answered))
    markers = F.array(*[F.lit(m) for m in (
        "{NPSB transfer credit}", "User profile not found", "Failed due to Amount falls within fail rate", "a Timeout", "Something went wrong", "else")])
    log = roles.txn_log(spark, sf_dir).withColumn("response", F.element_at(markers, (id % 6 + 1).cast("int")))
    services = [
        sla.Satisfaction("Money Out", bank, bank_rail(swift, "OWN"), bank_in_time(swift, issued, answered, "OWN"),
                         where=F.col("status") != "PENDING", shift=SIX_HOURS),
        sla.Satisfaction("Super QR Payment", log, F.lit("Super QR Payment"), credited(F.col("response")), where=asked(),
                         attempt=countable_attempt(F.col("response"))),
    ]
    return sla.weekly_satisfaction(services, clock.previous_week(NOW))


@checked
def r32_recon_rollups(spark, sf_dir):
    return cohort.reconciliation_rollups(roles.recon(spark, sf_dir), split=("A", "R"))


@checked
def r33_assignee_kpi(spark, sf_dir):
    tickets = roles.orders_fact(spark, sf_dir).select(
        "created_at", "status", F.col("priority").alias("assignee"),
        F.when(F.col("amount") < 300000, "EMAIL").otherwise("CALL").alias("action_type"),
    )
    return cohort.assignee_kpi(tickets, EVER)


@checked
def r34_registration_funnel(spark, sf_dir):
    return cohort.registration_funnel(roles.profiles(spark, sf_dir), clock.since_day(NOW, 30), "day")


@checked
def r34_registration_today(spark, sf_dir):
    return cohort.registration_funnel(roles.profiles(spark, sf_dir), TODAY)


@checked
def r35_audit_transitions(spark, sf_dir):
    return detail.audit_transitions(roles.audit(spark, sf_dir), CALENDAR_MONTH, "day")


@checked
def r35_audit_transitions_today(spark, sf_dir):
    return detail.audit_transitions(roles.audit(spark, sf_dir), TODAY)


@checked
def r36_form_open_events(spark, sf_dir):
    """The user stands for the form's id, so that ids repeat."""
    events = roles.app_events(spark, sf_dir).withColumn("id", F.col("user_id"))
    return detail.form_open_events(events, EVER, event_name="view", label="FORM_OPENED")


@checked
def r37_event_counts(spark, sf_dir):
    return cohort.event_counts(
        roles.app_events(spark, sf_dir), TODAY, where=F.col("message").like("request%")
    )


@checked
def r37_event_errors(spark, sf_dir):
    wanted = (F.col("level") == "ERROR") & F.col("event_name").isin("error", "purchase")
    return cohort.event_counts(
        roles.app_events(spark, sf_dir), EVER, where=wanted,
        dims=("level", "event_name", "message", "details"),
    )


@checked
def r37_event_phases(spark, sf_dir):
    return cohort.event_counts(
        roles.app_events(spark, sf_dir), TODAY, where=F.col("level") == "INFO",
        dims={"message": sync_phase(F.col("message"))}, with_day=False,
    )


@checked
def r38_latest_events(spark, sf_dir):
    return detail.latest_events(roles.app_events(spark, sf_dir), "signup")


@checked
def r38_latest_errors(spark, sf_dir):
    return detail.latest_events(
        roles.app_events(spark, sf_dir), "error", only_errors=True,
        columns=("level", "event_name", "message", "details", "user_id"),
    )


# --- sales, cashback, messages -----------------------------------------------------------------


@checked
def r39_package_sales(spark, sf_dir):
    return cohort.package_sales(roles.purchases(spark, sf_dir), TODAY)


@checked
def r39_package_sales_month(spark, sf_dir):
    return cohort.package_sales(roles.purchases(spark, sf_dir), CALENDAR_MONTH, "day")


@checked
def r39_package_sales_lifetime(spark, sf_dir):
    return cohort.package_sales(
        roles.purchases(spark, sf_dir), EVER, "day", where=F.col("status") == "PURCHASED",
        labelled=False, counted=None,
    )


@checked
def r40_active_plans(spark, sf_dir):
    return detail.active_plans(roles.plans(spark, sf_dir))


def _cashback(spark, sf_dir):
    """Every fifth user writes a time nobody can read."""
    return roles.txn(spark, sf_dir).select(
        "create_date",
        F.when(F.col("mobile_operator") == "TT", "pending").otherwise(F.col("update_text")).alias(
            "update_date"
        ),
        F.col("status").alias("txn_status"),
        "wallet",
        F.col("provider_code").alias("cashback_txn_id"),
    )


@checked
def r41_cashback_cohort(spark, sf_dir):
    return cohort.cashback_cohort(_cashback(spark, sf_dir), TODAY_SETTLED)


@checked
def r41_cashback_month(spark, sf_dir):
    return cohort.cashback_cohort(
        _cashback(spark, sf_dir), CALENDAR_MONTH, "day", range_on="create_date"
    )


@checked
def r41_cashback_failed(spark, sf_dir):
    return cohort.cashback_cohort(
        _cashback(spark, sf_dir), CALENDAR_MONTH, "day", range_on="create_date", only_failed=True
    )


@checked
def r42_sms_cohort(spark, sf_dir):
    return billing.sms_cohort(roles.messages(spark, sf_dir), EVER, channels=CHANNELS)


@checked
def r42_sms_cohort_merged(spark, sf_dir):
    return billing.sms_cohort(
        roles.messages(spark, sf_dir), EVER, "day", channels=CHANNELS, merge_folded=True
    )


@checked
def r43_sms_bill(spark, sf_dir):
    return billing.sms_bill(
        roles.messages(spark, sf_dir), None, unicode_channels=("user", "system"),
        plain_channels=("assistant",), where=F.col("message_status").isin("0", "SUCCESS"),
    )


@checked
def r43_sms_bill_month(spark, sf_dir):
    return billing.sms_bill(
        roles.messages(spark, sf_dir), clock.previous_month(clock.midnight(NOW)),
        unicode_channels=("user",), plain_channels=("assistant", "system"), formatted=True,
    )


# --- support -----------------------------------------------------------------------------------


def _resolved(spark, sf_dir):
    return support.latest_journals(
        roles.journals(spark, sf_dir), roles.issues(spark, sf_dir), roles.emails(spark, sf_dir),
        roles.ticket_statuses(spark, sf_dir), NOW, staff=STAFF,
    )


@checked
def r44_ticket_resolution(spark, sf_dir):
    return support.resolution_counts(_resolved(spark, sf_dir), NOW, roles.AGENTS)


@checked
def r44_ticket_pivot(spark, sf_dir):
    return support.resolution_pivot(_resolved(spark, sf_dir), NOW, roles.AGENTS)


def _spent(spark, sf_dir):
    return support.first_entries(
        roles.issues(spark, sf_dir), roles.time_entries(spark, sf_dir), roles.emails(spark, sf_dir),
        roles.ticket_statuses(spark, sf_dir), NOW, staff=STAFF,
    )


@checked
def r45_operation_hours(spark, sf_dir):
    return support.operation_hours(_spent(spark, sf_dir), NOW, roles.AGENTS)


@checked
def r45_operation_pivot(spark, sf_dir):
    return support.resolution_pivot(_spent(spark, sf_dir), NOW, roles.AGENTS)
