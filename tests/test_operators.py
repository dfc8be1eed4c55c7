"""Golden rows: the edges each report has to get right."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, at, cash, rows
from tillwatch.functions import clock
from tillwatch.functions.clock import EVER
from tillwatch.operators import billing, cohort, detail, health, logs, sla, support

TXN = "id long, create_date ts, status string, amount money"


def test_cohort_counts_values_and_rows(frame):
    fact = frame(TXN, [
        (1, at("2024-03-31 00:00:00"), "SUCCESS", cash("1.10")),
        (2, at("2024-03-31 00:59:59"), None, cash("0")),
        (3, at("2024-03-31 00:10:00"), "SUCCESS", None),
        (4, at("2024-03-30 23:59:59"), "SUCCESS", cash("5")),
        (5, None, "SUCCESS", cash("5")),
    ])
    today = clock.today(AS_OF)
    assert rows(cohort.status_cohort(fact, today)) == [
        ("00", None, 1, cash("0.00")), ("00", "SUCCESS", 2, cash("1.10")),
    ]
    assert rows(cohort.status_cohort(fact, today, counted="status")) == [
        ("00", None, 0, cash("0.00")), ("00", "SUCCESS", 2, cash("1.10")),
    ]


def test_label_may_use_another_shift_than_the_filter(frame):
    fact = frame(TXN, [(1, at("2024-03-30 20:00:00"), "OK", cash("1"))])
    six = timedelta(hours=6)
    span = clock.today(AS_OF)
    assert rows(cohort.status_cohort(fact, span, "day", shift=six))[0][0] == "2024-03-31"
    unshifted = cohort.status_cohort(fact, span, "day", shift=six, label_shift=timedelta(0))
    assert rows(unshifted)[0][0] == "2024-03-30"


def test_folded_cohort_groups_by_the_folded_status(frame):
    fact = frame(TXN + ", result string", [
        (1, AS_OF, "ODD", cash("1"), None), (2, AS_OF, "STRANGE", cash("2"), None),
        (3, AS_OF, "FAILED", cash("4"), "X"),
    ])
    assert rows(cohort.folded_status_cohort(fact, clock.today(AS_OF))) == [
        ("18", "DISPUTE", "NULL", 2, cash("3.00")), ("18", "FAILED", "X", 1, cash("4.00")),
    ]


def test_dimension_rows_multiply_like_a_join(frame):
    fact = frame("k string, create_date ts, status string, amount money", [
        ("a", AS_OF, "OK", cash("1")), ("a", AS_OF, "OK", cash("2")), ("b", AS_OF, "OK", cash("4")),
        ("missing", AS_OF, "OK", cash("8")), (None, AS_OF, "OK", cash("9")),
    ])
    dim = frame("k string, name string", [("a", "One"), ("a", "Two"), ("b", "One")])
    assert rows(cohort.dimension_cohort(fact, dim, "k", "name", EVER)) == [
        ("18", "One", "OK", 3, cash("7.00")), ("18", "Two", "OK", 2, cash("3.00")),
    ]


def test_top_reasons_break_ties_by_text_and_show_shares(frame):
    names = ["b"] * 3 + ["a"] * 3 + ["c"] * 2 + ["d", "e", "f"]
    fact = frame("create_date ts, status string, description string",
                 [(AS_OF, "FAILED", name) for name in names] + [(AS_OF, "SUCCESS", "zzz")])
    top = cohort.top_reasons(fact, clock.today(AS_OF), share=True)
    assert rows(top) == [
        ("18", "a", 3, cash("27.27")), ("18", "b", 3, cash("27.27")), ("18", "c", 2, cash("18.18")),
        ("18", "d", 1, cash("9.09")), ("18", "e", 1, cash("9.09")),
    ]


def test_status_summary_of_nothing(frame):
    empty = frame(TXN, [])
    assert rows(cohort.status_summary(empty, EVER)) == [(0, 0, 0, None, None, None)]
    assert rows(cohort.lifetime_dispute(empty)) == [(0, cash("0.00"))]


def test_reconciliation_leaves_idle_and_unknown_decisions_out(frame):
    recon = frame(
        "create_date ts, service_name string, txn_type string, proposed_decision string, amount money",
        [
            (AS_OF, "NAGAD", "IN", "NO ACTION NEEDED", cash("1")),
            (AS_OF, "NAGAD", "IN", "REFUND", cash("2")),
            (AS_OF, "CARD", "IN", None, cash("4")),
            (AS_OF, "NAGAD", None, "REFUND", cash("8")),
        ],
    )
    found = {}
    for report, day, service, kind, decision, count, amount in rows(cohort.reconciliation_rollups(recon)):
        assert day == "2024-03-31"
        found.setdefault(report, []).append((service, kind, decision, count, str(amount)))
    assert found == {
        "overall": [(None, None, None, 4, "15.00")],
        "service": [("CARD", "IN", None, 1, "4.00"), ("NAGAD", "IN", None, 2, "3.00"),
                    ("NAGAD", None, None, 1, "8.00")],
        "direction": [(None, "IN", None, 3, "7.00"), (None, None, None, 1, "8.00")],
        "decision": [(None, None, "REFUND", 2, "10.00")],
        "service_decision": [("NAGAD-", None, "REFUND", 1, "8.00"),
                             ("NAGAD-IN", None, "REFUND", 1, "2.00")],
        "direction_decision": [(None, "IN", "REFUND", 1, "2.00"), (None, None, "REFUND", 1, "8.00")],
    }


def test_cashback_text_times(frame):
    table = frame(
        "create_date ts, update_date string, txn_status string, wallet string, cashback_txn_id string",
        [
            (AS_OF, "2024-03-31 10:00:00", "OK", "w", "1"), (AS_OF, "later", "OK", "w", "2"),
            (AS_OF, "2024-03-31 18:25:00.000001", "OK", "w", "3"), (AS_OF, None, "FAILED", "w", "4"),
        ],
    )
    settled = clock.today(AS_OF).settled(AS_OF, timedelta(minutes=5))
    assert rows(cohort.cashback_cohort(table, settled)) == [("10", "OK", 1)]
    month = clock.rolling(AS_OF, "calendar_month")
    assert rows(cohort.cashback_cohort(table, month, "day", range_on="create_date")) == [
        ("2024-03-31", "OK", 2), (None, "FAILED", 1), (None, "OK", 1),
    ]


# --- baselines and health ----------------------------------------------------------------------


def test_baseline_averages_only_days_with_bad_rows(frame):
    def bad(day, count, hour="10"):
        return [(0, at(f"2024-03-{day:02d} {hour}:00:00"), "FAILED", None)] * count

    fact = frame(TXN, bad(10, 1) + bad(11, 2) + bad(12, 2) + bad(31, 4) + bad(1, 9) + bad(31, 7, "19"))
    found = rows(health.threshold_vs_today(fact, AS_OF, baseline_bad=F.col("status") != "SUCCESS"))
    # (1 + 2 + 2 + today's 4) / 4 days; 1 March is older than four weeks; 19:00 is still to come.
    assert found == [("10", "last 4week not success avg", 2.25), ("10", "today not success", 4.0)]


def test_baseline_mean_is_rounded_half_up(frame):
    days = [(0, at(f"2024-03-{day:02d} 10:00:00"), "FAILED", None) for day in range(10, 18)]
    fact = frame(TXN, days + days[:1])
    found = rows(health.threshold_vs_today(fact, AS_OF, baseline_bad=F.col("status") == "FAILED"))
    assert found == [("10", "last 4week not success avg", 1.13)]  # 9 / 8 = 1.125


def test_health_counts_null_status_only_in_the_rate(frame):
    now = AS_OF - timedelta(minutes=10)
    fact = frame(TXN, [
        (1, now, "SUCCESS", cash("10.99")), (2, now, None, cash("5")), (3, now, "FAILED", cash("5")),
        (4, AS_OF - timedelta(minutes=2), "SUCCESS", cash("5")),
        (5, AS_OF - timedelta(minutes=3), "ODD", cash("5")),
    ])
    assert rows(health.service_health(fact, AS_OF, health.status_roles())) == [
        (at("2024-03-31 00:00:00").date(), "18:20", 1, 0, 1, 1, 10, "NOT OK", "25.00%")
    ]


def test_health_of_silent_services(frame):
    fact = frame(TXN + ", operator string", [
        (1, AS_OF - timedelta(minutes=10), "FAILED", cash("1"), "A"),
    ])
    one = health.service_health(fact, AS_OF, health.status_roles(), by="operator", members=("A", "B"))
    day = AS_OF.date()
    assert rows(one) == [
        ("A", day, "00:00", 0, 0, 1, 0, 0, "DOWN", "0.00%"),
        ("B", day, "00:00", 0, 0, 0, 0, 0, "DOWN", "0%"),
    ]
    nothing = fact.filter("false")
    assert len(rows(health.service_health(nothing, AS_OF, health.status_roles()))) == 1
    assert rows(health.service_health(nothing, AS_OF, health.status_roles(), keep_empty=False)) == []


def test_health_window_reaches_over_midnight(frame):
    early = datetime(2024, 3, 31, 0, 10)
    fact = frame(TXN, [(1, at("2024-03-30 23:45:00"), "SUCCESS", cash("1"))])
    found = rows(health.service_health(fact, early, health.status_roles()))
    assert found[0][1:] == ("00:00", 0, 0, 0, 0, 0, "OK", "100.00%")


def test_rate_of_its_own_without_attempts_is_down(frame):
    fact = frame(TXN, [(1, AS_OF - timedelta(minutes=10), "SUCCESS", cash("1"))])
    roles = health.status_roles(attempts=F.col("amount") >= 10, hits=F.col("amount") >= 10)
    found = rows(health.service_health(fact, AS_OF, roles))[0]
    assert found[-2:] == ("DOWN", "0%")


def test_log_health(frame):
    schema = "create_date ts, request_id string, request string, response string"
    recent = AS_OF - timedelta(minutes=5)
    log = frame(schema, [(recent, "1", "hex", '{"NPSB transfer credit"}')] * 5 + [
        (recent, "2", "post", '{"a": "NPSB transfer credit", "amount": "2.50"}'),
        (recent, "3", "post", '{"error": "no"}'),
    ] + [(recent, "4", "post", None)] * 299)
    asked = ~F.ilike("request", F.lit("%hex%"))
    found = rows(health.log_service_health(log, AS_OF, where=asked))
    # One success of 301 today; six recent ones, as internal requests count there.
    assert found == [(AS_OF.date(), "18:25", 1, 0, 300, 0, 3, "ACCEPTABLE", ".33%")]
    assert rows(health.log_service_health(log.filter("false"), AS_OF, where=asked)) == []


def test_board_labels_and_amounts(frame):
    fact = frame(TXN + ", operator string", [
        (1, AS_OF - timedelta(minutes=10), "SUCCESS", cash("1234567.89"), "A"),
    ])
    roles = health.status_roles()
    board = health.health_board({
        "Top-up": health.service_health(fact, AS_OF, roles, by="operator", members=("A",)),
        "Card": health.service_health(fact, AS_OF, roles),
    }, by="operator")
    found = {row["service"]: row["success_amount"] for row in board.collect()}
    assert found == {"Top-up (A)": "1,234,567", "Card": "1,234,567"}


def test_roles_with_a_condition_need_a_dispute(spark):
    with pytest.raises(ValueError):
        health.status_roles(failed=F.lit(True))


# --- logs --------------------------------------------------------------------------------------


LOG = "id long, request_id string, create_date ts, request string, response string"


def test_unanswered_requests_are_no_errors(frame):
    log = frame(LOG, [
        (1, "a", AS_OF, '{"receiver_wallet_no": "W1"}', None),
        (2, "b", AS_OF, '{"receiver_wallet_no": "W1"}', '{"error": "x"}'),
        (3, "c", AS_OF, '{"receiver_wallet_no": "W1"}', '{"error": "x"}'),
        (4, "d", AS_OF, "no wallet", '{"error": "x"}'),
        (5, None, AS_OF, "r", None), (6, "f", AS_OF, None, None),
    ])
    assert rows(logs.error_unique_users(log, clock.today(AS_OF))) == [("18", "x", 1)]
    assert rows(logs.unanswered_requests(log, clock.Span(after=AS_OF - timedelta(1)))) == [
        ("2024-03-31", "18", "a", "RC_85(TIMEOUT)")
    ]
    assert rows(logs.unanswered_requests(log, clock.Span(after=AS_OF))) == []


def test_requests_without_a_bank_answer(frame):
    requests = frame("id long, issue_time ts, status string, amount money, bank_swift_code string", [
        (1, AS_OF, "OK", cash("10"), "S1"), (2, AS_OF, "OK", cash("1"), "S2"),
        (3, AS_OF, "OK", cash("2"), "S9"),
    ])
    answer = '{"responseMessage": "done"}'
    log = frame("np_txn_request_id long, response_text string", [
        (1, answer), (1, answer), (1, "garbled"), (None, answer), (7, answer),
    ])
    today = clock.today(AS_OF)
    assert rows(logs.bank_response_cohort(requests, log, today)) == [
        ("18", "OK", "No data in bank_txn_log", 3, cash("13.00")), ("18", "OK", "done", 2, cash("20.00")),
    ]
    bank = frame("swift_code string, bank_name string", [("S1", "First"), ("S2", "Second")])
    assert rows(logs.bank_response_cohort(requests, log, today, bank=bank)) == [
        ("18", "OK", "No data in bank_txn_log", "First", 1, cash("10.00")),
        ("18", "OK", "No data in bank_txn_log", "Second", 1, cash("1.00")),
        ("18", "OK", "done", "First", 2, cash("20.00")),
    ]


def test_reverse_reason_counts(frame):
    fact = frame("id long, request_id string, create_date ts, bank_name string, status string", [
        (1, "a", AS_OF, "B", "REVERSE"), (2, "b", AS_OF, None, "REVERSE"),
        (3, "c", AS_OF, "B", "REVERSE"), (4, "d", AS_OF, "B", "SUCCESS"),
    ])
    log = frame(LOG, [
        (1, "a", AS_OF, "VisaFundTransferDto", '{"actionCode": "05"}'),
        (2, "b", AS_OF, "VisaFundTransferDto", '{"actionCode": "05"}'),
        (3, "c", AS_OF, "x visafundtransferdto", "not json"),
        (4, "c", AS_OF, "other", '{"actionCode": "05"}'),
    ])
    assert rows(logs.reverse_reasons(fact, log)) == [
        (1, "2024-03-31", "B (2)", "REVERSE", "05", "05-Do not honor (2)"),
        (2, "2024-03-31", None, "REVERSE", "05", "05-Do not honor (2)"),
        (3, "2024-03-31", "B (2)", "REVERSE", None, "Other (1)"),
    ]


def test_first_response_is_the_lowest_log_row(frame):
    fact = frame("request_id string, create_date ts, status string, amount money, "
                 "bank_swift_code string, channel string", [
        ("a", AS_OF, "REVERSE", cash("1"), "S", "NPSB"), ("b", AS_OF, "UNKNOWN", cash("2"), "S", "MTB"),
        ("c", AS_OF, "SUCCESS", cash("3"), "S", "MTB"), ("d", AS_OF, "REVERSE", cash("4"), "S", "MTB"),
    ])
    log = frame(LOG, [
        (7, "a", AS_OF, "r", "later"), (3, "a", AS_OF, "r", "first"), (1, "b", AS_OF, "r", None),
        (2, "b", AS_OF, "r", "answered"), (4, "c", AS_OF, "r", "x"),
    ])
    assert rows(logs.first_response_per_request(fact, log, clock.today(AS_OF))) == [
        ("a", "2024-03-31", "REVERSE", cash("1.00"), "S", "NPSB", "first"),
        ("b", "2024-03-31", "UNKNOWN", cash("2.00"), "S", "MTB", "response: NULL"),
    ]


def test_tag_fields_drop_rows_without_any_tag(frame):
    log = frame(LOG + ", update_date ts", [
        (1, "a", AS_OF, "hex", '{"xml": "<field id=\\"32\\" value=\\"X\\"/>"}', AS_OF),
        (2, "b", AS_OF, "hex", '{"xml": "<field id=\\"39\\" value=\\"Y\\"/>"}', AS_OF),
        (3, "c", AS_OF, "hex", '{"xml": "<none/>"}', AS_OF), (4, "d", AS_OF, "hex", "bad json", AS_OF),
        (5, "e", AS_OF, "hex", None, AS_OF),
    ])
    found = rows(logs.tag_fields(log, keep=("id",)))
    assert found == [(1, "X", None), (2, None, "Y")]


# --- look-ups ----------------------------------------------------------------------------------


def test_latest_value_per_key_may_be_null(frame):
    fact = frame("id long, mobile_operator string, vendor_name string", [
        (1, "GP", "old"), (2, "GP", None), (3, "BL", "V"), (9, "ZZ", "other"),
    ])
    columns = {"gp": "GP", "bl": "BL", "tt": "TT"}
    assert rows(detail.latest_by_key_pivot(fact, columns)) == [(None, "V", None)]


FACT = "id long, request_id string, vendor_name string, status string, number_of_try string"


def test_marked_balances_need_both_vendors(frame):
    fact = frame(FACT, [(1, "r1", "ROBI", "SUCCESS", "0"), (2, "r2", "ROBI", "SUCCESS", "0"),
                        (3, "r3", "ROBI", "FAILED", "0"), (4, "a1", "AIRTEL", "SUCCESS", "0")])
    log = frame(LOG, [
        (1, "r1", AS_OF, "api", "Your new balance is 1 TAKA"),
        (2, "r2", AS_OF, "api", "Your new balance is 2.50 TAKA"),
        (3, "r2", AS_OF, "other", "Your new balance is 9 TAKA"),
        (4, "a1", AS_OF, "api", "no balance here"),
    ])
    vendors = {"robi": "ROBI", "airtel": "AIRTEL"}
    found = detail.latest_marked_balances(fact, log, vendors, "%api%")
    assert rows(found) == [("api", "2.50", "api", None)]
    assert rows(detail.latest_marked_balances(fact, log.filter("id < 4"), vendors, "%api%")) == []


def test_json_balances(frame):
    log = frame(LOG, [
        (1, "a", AS_OF, "X requestDateTime=20240331101112&b", '{"merchantBalance": "1234567.5"}'),
        (2, "b", AS_OF, "x requestDateTime=2024", "not json"),
    ])
    assert rows(detail.latest_json_balance(log, "%x%")) == [
        ("X requestDateTime=20240331101112&b", "2024/03/31 10:11:12", "1,234,568")
    ]
    fact = frame(FACT, [(1, "a", "P", "SUCCESS", "0"), (2, "b", "P", "SUCCESS", "1")])
    good = detail.guarded_json_balance(
        fact, log, "P", "%x%", where=F.col("number_of_try") == "0", balance_path="$.merchantBalance"
    )
    assert rows(good)[0][2] == "1,234,568"
    bad = detail.guarded_json_balance(fact, log, "P", "%x%")
    assert rows(bad) == [("x requestDateTime=2024", "not json", "Invalid or non-JSON response")]


def test_decode_keeps_every_report_row(frame):
    report = frame("day string, hour string, wallet string, status string", [
        ("d", "1", "ABCDEF124445560xx", "User profile not found"),
        ("d", "2", "ABCDEF124445599xx", "User profile not found"),
        ("d", "3", "ABCDEFnot digits", "User profile not found"),
        ("d", "4", "ABCDEF124445560xx", "other"), ("d", "5", None, "User profile not found"),
        ("d", "6", "ABCDEF124445560xx", "User profile not found"),
    ])
    profile = frame("user_id long, biz_name string, wallet_no string, merchant_id string", [
        (5, "Shop", None, "M5"), (6, "Else", "W", "M6"),
    ])
    found = rows(detail.decode_and_enrich(report, profile))
    assert found == [
        ("d", "1", "ABCDEF124445560xx", "User profile not found", 5, "Shop", "", "M5"),
        ("d", "2", "ABCDEF124445599xx", "User profile not found", 44, "", "", ""),
        ("d", "6", "ABCDEF124445560xx", "User profile not found", 5, "Shop", "", "M5"),
    ]


def test_form_openings_count_over_hours(frame):
    events = frame("id long, created_at ts, event_name string, user_id long", [
        (1, at("2024-03-31 10:00:00"), "open", 7), (1, at("2024-03-31 10:30:00"), "open", 7),
        (1, at("2024-03-31 11:00:00"), "open", 7), (1, at("2024-03-31 11:00:00"), "open", None),
        (1, at("2024-03-31 11:00:00"), "shut", 7),
    ])
    found = detail.form_open_events(events, clock.today(AS_OF), event_name="open", label="OPENED")
    assert rows(found) == [
        (1, "10", "OPENED", 7, 3), (1, "11", "OPENED", 7, 3), (1, "11", "OPENED", None, 1),
    ]


def test_latest_events_skip_levels_that_are_unknown(frame):
    events = frame("id long, created_at ts, level string, event_name string, message string, "
                   "details string", [(n, AS_OF, level, "e", "m", "d") for n, level in
                                      enumerate(["INFO", "ERROR", "WARN", None, "ERROR"])])
    newest = detail.latest_events(events, "e", only_errors=True, n=2)
    assert [row[0] for row in rows(newest)] == [2, 4]


def test_stamps(spark, frame):
    assert rows(detail.as_of_stamp(spark, AS_OF)) == [("2024-03-31 18:30",)]
    assert rows(detail.newest_stamp(frame("create_date ts", []))) == [(None,)]


# --- growth, totals, satisfaction --------------------------------------------------------------


def test_growth_compares_with_the_previous_row(frame):
    fact = frame(TXN, [
        (1, at("2024-03-28 01:00:00"), "A", cash("100")), (2, at("2024-03-28 01:00:00"), "B", cash("0")),
        (3, at("2024-03-30 01:00:00"), "A", cash("50")), (4, at("2024-03-30 01:00:00"), "B", cash("75")),
        (5, at("2024-03-30 01:00:00"), None, cash("25")), (6, at("2024-03-31 00:00:00"), "A", cash("1")),
    ])
    span = clock.through_day(clock.rolling(AS_OF, "date_after_instant"), AS_OF, 1)
    assert [(row[0], row[1], row[4]) for row in rows(sla.daily_growth(fact, span))] == [
        ("2024-03-28", "A", cash("0.00")),  # nothing before
        ("2024-03-28", "B", cash("-100.00")),  # against A of the same day
        ("2024-03-30", "A", cash("0.00")),  # against B of the day before, which is 0
        ("2024-03-30", "B", cash("50.00")),
        ("2024-03-30", None, cash("-66.67")),
    ]
    own = rows(sla.daily_growth(fact, span, per_status=True))
    assert [(row[0], row[1], row[4]) for row in own] == [
        ("2024-03-28", "A", cash("0.00")), ("2024-03-28", "B", cash("0.00")),
        ("2024-03-30", "A", cash("-50.00")), ("2024-03-30", "B", cash("0.00")),
        ("2024-03-30", None, cash("0.00")),
    ]


def test_daily_totals_keep_silent_services(frame):
    fact = frame(TXN, [
        (1, at("2024-03-30 23:59:59"), "SUCCESS", cash("5")),
        (2, at("2024-03-30 23:59:59.500000"), "SUCCESS", cash("7")),
        (3, at("2024-03-30 00:00:00"), "FAILED", cash("9")),
    ])
    yesterday = clock.yesterday(AS_OF)
    services = [
        sla.ServiceTotal("good", fact, yesterday, F.col("status") == "SUCCESS"),
        sla.ServiceTotal("any", fact, yesterday),
        sla.ServiceTotal("none", fact, yesterday, F.col("status") == "NEVER"),
        sla.ServiceTotal("empty table", fact.filter("false"), yesterday),
    ]
    assert rows(sla.daily_service_totals(services)) == [
        ("any", 2, cash("14.00")), ("empty table", 0, None), ("good", 1, cash("5.00")),
        ("none", 0, None),
    ]


def test_satisfaction_totals_are_recomputed_from_counts(frame):
    start = at("2024-03-25 10:00:00")
    table = frame("create_date ts, ok boolean", [(start, True)] + [(start, False)] * 2)
    other = frame("create_date ts, ok boolean", [(start, True)] * 7)
    never = table.filter("false")
    services = [
        sla.Satisfaction("Out", table, F.lit("x"), F.col("ok")),
        sla.Satisfaction("Out", other, F.lit("y"), F.col("ok")),
        sla.Satisfaction("In", other, F.lit("z"), F.col("ok"), attempt=F.lit(False)),
        sla.Satisfaction("Silent", never, F.lit("s"), F.col("ok")),
    ]
    assert rows(sla.weekly_satisfaction(services, clock.previous_week(AS_OF))) == [
        ("family", "In", None, 0, 7, None),
        ("family", "Out", None, 10, 8, cash("80.00")),
        ("service", "In", "z", 0, 7, None),
        ("service", "Out", "x", 3, 1, cash("33.33")),
        ("service", "Out", "y", 7, 7, cash("100.00")),
        ("total", None, None, 10, 15, cash("150.00")),
    ]


# --- messages and support ----------------------------------------------------------------------


def test_both_spellings_of_success_keep_their_rows(frame):
    messages = frame(
        "request_time ts, channel string, telecom_operator string, message_status string", [
            (AS_OF, "otp", "x", "0"), (AS_OF, "otp", "x", "SUCCESS"), (AS_OF, "otp", "x", "SUCCESS"),
            (AS_OF, "spam", "x", "0"),
        ])
    today = clock.since_day(AS_OF)
    assert rows(billing.sms_cohort(messages, today, channels=("otp",))) == [
        (18, "otp", "x", "SUCCESS", 1), (18, "otp", "x", "SUCCESS", 2),
    ]
    merged = billing.sms_cohort(messages, today, channels=("otp",), merge_folded=True)
    assert rows(merged) == [(18, "otp", "x", "SUCCESS", 3)]


def test_bill_of_december_in_january(frame):
    january = datetime(2024, 1, 31, 12)
    messages = frame("request_time ts, channel string, message_body string", [
        (at("2023-12-01 00:00:00"), "otp", "x" * 161), (at("2023-12-31 23:59:59"), "text", "y" * 71),
        (at("2024-01-01 00:00:00"), "text", "y"), (at("2023-11-30 23:59:59"), "text", "y"),
    ])

    def bill(month, **options):
        return billing.sms_bill(
            messages, month, unicode_channels=("text",), plain_channels=("otp",), **options
        )

    december = clock.previous_month(january)
    assert rows(bill(december)) == [
        ("Total", 4, cash("1.12")), ("otp", 2, cash("0.56")), ("text", 2, cash("0.56")),
    ]
    assert rows(bill(december, formatted=True))[0] == ("Total", "4.00", "1.12")


AGENTS = {"ann.lee": "ANN", "bob": "BOB"}
STAFF = (1, 2)


def tracker(frame):
    journals = frame("id long, journalized_id long, user_id long, created_on ts", [
        (1, 10, 1, at("2024-03-31 09:00:00")), (2, 10, 2, at("2024-03-31 10:00:00")),
        (3, 10, 2, at("2024-03-31 10:00:00")), (4, 10, 9, at("2024-03-31 11:00:00")),
        (5, 11, 1, at("2024-03-01 00:00:00")), (6, 11, 1, at("2024-02-29 23:59:59")),
        (7, 12, 1, at("2024-03-30 00:00:00")), (8, 13, 1, at("2024-03-30 00:00:00")),
        (9, 14, 1, at("2024-03-30 00:00:00")),
    ])
    issues = frame("id long, author_id long, status_id long, category_id long, subject string, "
                   "start_date ts", [
        (10, 5, 1, None, "pay  FAILED", AS_OF), (11, 5, 2, None, "slow", AS_OF),
        (12, 1, 1, None, "own ticket", at("2024-03-30 00:00:00")), (13, 5, 3, None, "open", AS_OF),
        (14, 5, 1, 4, "filed", AS_OF), (15, 2, 1, None, "two  entries", AS_OF),
        (16, 2, 9, None, "unknown status", AS_OF),
    ])
    emails = frame("user_id long, address string", [(1, "ann.lee@x"), (2, "bob@x"), (9, "zed@x")])
    statuses = frame("id long, name string", [(1, "Closed"), (2, "Resolved"), (3, "Open")])
    entries = frame("id long, issue_id long, hours double", [
        (1, 15, 0.3), (2, 15, 9.0), (3, 12, 1.2), (4, 12, 5.0), (5, 16, 1.0),
    ])
    return journals, issues, emails, statuses, entries


def test_resolved_tickets(frame):
    journals, issues, emails, statuses, _ = tracker(frame)
    resolved = support.latest_journals(journals, issues, emails, statuses, AS_OF, staff=STAFF)
    counts = {row[:2]: row[2] for row in rows(support.resolution_counts(resolved, AS_OF, AGENTS))}
    assert len(counts) == 31 * 2
    # Two entries share ticket 10's last time; ticket 11 was written on the first day of the range.
    assert {key: n for key, n in counts.items() if n} == {
        ("2024-03-31", "BOB"): 2, ("2024-03-01", "ANN"): 1,
    }
    assert rows(support.resolution_pivot(resolved, AS_OF, AGENTS)) == [
        ("Grand Total", None, "", 2), ("bob@x", 2, "Pay Failed", 2),
    ]


def test_spent_hours(frame):
    _, issues, emails, statuses, entries = tracker(frame)
    first = support.first_entries(issues, entries, emails, statuses, AS_OF, staff=STAFF)
    hours = {row[:2]: row[2] for row in rows(support.operation_hours(first, AS_OF, AGENTS))}
    assert {key: n for key, n in hours.items() if n} == {
        ("2024-03-31", "BOB"): 1, ("2024-03-30", "ANN"): 2,
    }
    assert rows(support.resolution_pivot(first, AS_OF, AGENTS)) == [
        ("Grand Total", None, "", 1), ("bob@x", 1, "Two Entries", 1),
    ]
    nobody = first.filter("false")
    assert rows(support.resolution_pivot(nobody, AS_OF, AGENTS)) == []
