"""Every published report over one small payments business."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from conftest import AS_OF, at, cash, rows
from tillwatch.plans.catalog import NEEDED, Settings, catalog, published, run_reports
from tillwatch.sources.reports import publish, read_report
from tillwatch.sources.tables import FileTable, Tables

SETTINGS = Settings(
    unicode_channels=("text",), plain_channels=("otp",), staff=(1, 2),
    agents={"ann": "ANN", "bob": "BOB"}, unanswered_since=datetime(2024, 1, 1),
    tags_from=datetime(2024, 1, 1), tags_to=datetime(2024, 12, 31),
    markup_gateway="%", json_gateway="%", transfer_gateway="%", balance_gateway="%",
    wallet_balance_gateway="%", reseller_gateway="%",
)

SCHEMAS = {
    "recharge": "id long, request_id string, txn_id string, create_date ts, update_date ts, status string, "
                "amount money, mobile_operator string, vendor_name string, description string, "
                "number_of_try string",
    "recharge_log": "id long, request_id string, create_date ts, update_date ts, request string, "
                    "response string",
    "cashback": "create_date ts, update_date string, txn_status string, wallet string, "
                "cashback_txn_id string",
    "nagad_in": "id long, create_date ts, update_date ts, amount money, status string, "
                "nagad_status string, nagad_status_code string, tp_transaction_number string, "
                "wallet string",
    "rocket_in": "id long, create_date ts, update_date ts, amount money, status string, result string",
    "wallet_out": "id long, request_id string, create_date ts, update_date ts, "
                  "financial_institute string, status string, amount money",
    "card_out": "id long, request_id string, create_date ts, bank_name string, status string, "
                "amount money",
    "card_in": "id long, create_date ts, update_date ts, status string, card_type string, amount money",
    "bank_transfer": "request_id string, create_date ts, status string, amount money, "
                     "bank_swift_code string, channel string",
    "bank_request": "id long, issue_time ts, request_time ts, status string, amount money, "
                    "bank_swift_code string, channel string, txn_request_type string",
    "bank_answer": "np_txn_request_id long, response_text string",
    "bank": "swift_code string, bank_name string",
    "qr_payment": "create_date ts, acquirer_id string, status string, amount money",
    "acquirer": "acquirer_id string, acquirer string",
    "reconciliation": "create_date ts, service_name string, txn_type string, "
                      "proposed_decision string, amount money",
    "support_mail": "created_at ts, assignee string, status string, action_type string",
    "profile": "user_id long, biz_name string, wallet_no string, merchant_id string, created_at ts, "
               "identity_status string, is_pin_set boolean",
    "audit": "user_id long, create_date ts, old_value string, new_value string, updated_by string",
    "app_event": "id long, created_at ts, event_name string, user_id long",
    "event": "id long, created_at ts, level string, event_name string, message string, "
             "details string, user_id long",
    "purchase": "created_at ts, amount money, status string",
    "plan": "id long, name string, subscription_type string, regular_price money, offer_price money, "
            "is_active boolean, updated_at ts",
    "message": "request_time ts, channel string, telecom_operator string, telco_identifier_id string, "
               "message_status string, message_body string",
    "issue": "id long, author_id long, status_id long, category_id long, subject string, start_date ts",
    "journal": "id long, journalized_id long, user_id long, created_on ts",
    "email": "user_id long, address string",
    "issue_status": "id long, name string",
    "time_entry": "id long, issue_id long, hours double",
}
SCHEMAS |= {f"{name}_log": SCHEMAS["recharge_log"] for name in ("wallet_out", "bank", "issuer")}

RECENT = AS_OF - timedelta(minutes=10)
YESTERDAY = at("2024-03-30 10:00:00")
LAST_WEEK = at("2024-03-26 10:00:00")
QUICK = timedelta(seconds=30)
UTC = timedelta(hours=6)

ROWS = {
    "recharge": [
        (1, "q1", "t1", RECENT, RECENT + QUICK, "SUCCESS", cash("10"), "GP", "ROBI", None, "0"),
        (2, "q2", "t2", RECENT, None, "CHECKOUT", cash("20"), "GP", "AIRTEL", "invalid transfer value 1",
         "0"),
        (3, "q3", "t3", YESTERDAY, YESTERDAY + QUICK, "SUCCESS", cash("40"), "BL", "AIRTEL", None, "0"),
        (4, "q4", "t4", LAST_WEEK, LAST_WEEK + QUICK, "FAILED", cash("80"), "BL", "X", "other", "1"),
        (5, "q5", "t5", LAST_WEEK, LAST_WEEK + 20 * QUICK, "SUCCESS", cash("1"), "TT", "PAYSTATION", None,
         "0"),
    ],
    "recharge_log": [
        (1, "q1", RECENT, RECENT, "api", "Your new balance is 77 TAKA"),
        (2, "q3", RECENT, RECENT, "api", "Your new balance is 88.5 TAKA"),
        (3, "q5", RECENT, RECENT, "api requestDateTime=20240331101112",
         '{"new_balance": "1234.5", "merchantBalance": "5000"}'),
    ],
    "cashback": [(RECENT, "2024-03-31 10:00:00", "FAILED", "w1", "c1")],
    "nagad_in": [
        (1, RECENT, RECENT + QUICK, cash("5"), "SUCCESS", "Success", "000", "n1", "w1"),
        (2, RECENT, None, cash("6"), "FAILED", "Failed", "100", "n2", "w2"),
        (3, RECENT, None, cash("6"), "FAILED", "Aborted", "101", "n3", "w2"),
        (4, LAST_WEEK, LAST_WEEK + QUICK, cash("7"), "SUCCESS", "Success", "000", "n4", "w3"),
    ],
    "rocket_in": [
        (1, RECENT, RECENT + QUICK, cash("5"), "SUCCESS", None),
        (2, RECENT, None, cash("6"), "FAILED", "TIMEOUT"),
        (3, RECENT, None, cash("6"), "FAILED", "FAILED"),
        (4, LAST_WEEK, LAST_WEEK + 30 * QUICK, cash("7"), "SUCCESS", None),
    ],
    "wallet_out": [
        (1, "o1", RECENT, RECENT + QUICK, "ROCKET", "SUCCESS", cash("100")),
        (2, "o2", RECENT, None, "ROCKET", "FAILED", cash("5")),
        (3, "o3", RECENT, None, "NAGAD", "FAILED", cash("50")),
        (4, "o4", YESTERDAY, YESTERDAY + QUICK, "NAGAD", "SUCCESS", cash("60")),
        (5, "o5", LAST_WEEK, LAST_WEEK + QUICK, "NAGAD", "SUCCESS", cash("60")),
        (6, "o6", RECENT, None, "OTHER", "FAILED", cash("50")),
    ],
    "wallet_out_log": [
        (1, "o1", RECENT, RECENT, "r", "<ResponseCode>0</ResponseCode><ResponseMessage>ok</ResponseMessage>"),
        (2, "o3", RECENT, RECENT, "r", "refused"), (3, "o3", RECENT, RECENT, "r", '{"sensitiveData": 1}'),
    ],
    "card_out": [
        (1, "c1", RECENT, "City", "SUCCESS", cash("500")), (2, "c2", RECENT, "City", "REVERSE", cash("50")),
        (3, "c3", YESTERDAY, "Town", "DISPUTE", cash("70")), (4, "c4", YESTERDAY, "Town", "SUCCESS", cash("9")),
    ],
    "card_in": [
        (1, RECENT, RECENT + QUICK, "SUCCESS", "VISA", cash("11")),
        (2, LAST_WEEK, LAST_WEEK + QUICK, "FAILED", "MASTER", cash("12")),
    ],
    "bank_transfer": [
        ("b1", RECENT, "SUCCESS", cash("30"), "S1", "NPSB"), ("b2", RECENT, "REVERSE", cash("31"), "S1", "MTB"),
        ("b3", YESTERDAY, "SUCCESS", cash("32"), "S2", "MTB"), ("b4", RECENT, "SUCCESS", cash("1"), "S1", "X"),
    ],
    "bank_log": [
        (1, "b2", RECENT, RECENT, "r", None), (2, "b2", RECENT, RECENT, "r", "late"),
        (3, "c2", RECENT, RECENT, "VisaFundTransferDto", '{"actionCode": "91"}'),
    ],
    "bank_request": [
        (1, RECENT - UTC, RECENT - UTC + QUICK, "SUCCESS", cash("200"), "CIBLBDDH", "CBL", "CASH_OUT"),
        (2, YESTERDAY - UTC, None, "REQUESTED", cash("300"), "S1", "BEFTN", "CASH_OUT"),
        (3, at("2024-03-28 09:00:00") - UTC, None, "FAILED", cash("400"), "S1", "BEFTN", "CASH_OUT"),
        (4, LAST_WEEK - UTC, LAST_WEEK - UTC + QUICK, "FAILED", cash("1"), "CIBLBDDH", "CBL", "CASH_OUT"),
        (5, LAST_WEEK - UTC, LAST_WEEK + QUICK, "SUCCESS", cash("1"), "S1", "BEFTN", "CASH_OUT"),
        (6, RECENT - UTC, RECENT - UTC, "SUCCESS", cash("9"), "CIBLBDDH", "CBL", "CASH_IN"),
    ],
    "bank_answer": [(1, '{"responseMessage": "done"}'), (3, '{"responseMessage": "no account"}')],
    "bank": [("S1", "First"), ("S2", "Second")],
    "qr_payment": [
        (RECENT, "A1", "SUCCESS", cash("15")), (YESTERDAY, "A1", "SUCCESS", cash("10")),
        (at("2024-03-29 10:00:00"), "A1", "SUCCESS", cash("5")),
    ],
    "acquirer": [("A1", "Acquirer one")],
    "issuer_log": [
        (1, "i1", RECENT, RECENT, "post", '{"x": "NPSB transfer credit", "amount": "15"}'),
        (2, "i2", RECENT, RECENT, '{"receiver_wallet_no": "w9"}', '{"error": "User profile not found"}'),
        (3, "i3", RECENT, RECENT, "hex dump", '{"xml": "<field id=\\"39\\" value=\\"85\\""}'),
        (4, "i4", RECENT, RECENT, "post", None),
        (5, "i5", LAST_WEEK, LAST_WEEK, "post", '{"x": "NPSB transfer credit"}'),
        (6, "i6", LAST_WEEK, LAST_WEEK, "post", "timeout"),
    ],
    "reconciliation": [(RECENT, "NAGAD", "IN", "REFUND", cash("3"))],
    "support_mail": [(RECENT, "ann", "OPEN", "EMAIL"), (RECENT, "", "OPEN", "EMAIL")],
    "profile": [(5, "Shop", "w5", "M5", RECENT, "VERIFIED", True), (6, None, None, None, RECENT, None, None)],
    "audit": [(5, RECENT, "CUSTOMER", "MERCHANT", "ann"), (5, RECENT, "CUSTOMER", "MERCHANT", "ann")],
    "app_event": [(1, RECENT, "event_sqr_rtlr_form_open", 5)],
    "event": [
        (1, RECENT, "INFO", "backup", "data-backup-done", "d", 5),
        (2, RECENT, "ERROR", "device_to_server_sync_v4", "m", "d", 5),
        (3, RECENT, "INFO", "sync_app_event", "a request", "d", 5),
        (4, RECENT, "ERROR", "sync_app_event", "a response", "d", 5),
        (5, RECENT, "INFO", "user-login-api-v2", "m", "d", 5),
        (7, RECENT, "ERROR", "user-login-api-v2", "m", "d", 5),
        (6, RECENT, "WARN", "wallet-lookup-api-v2", "m", "d", 5),
    ],
    "purchase": [(RECENT, cash("99"), "PURCHASED"), (RECENT, cash("99"), "PURCHASED")],
    "plan": [(1, "basic", "monthly", cash("99"), cash("79"), True, RECENT),
             (2, "old", "monthly", cash("99"), cash("79"), False, RECENT)],
    "message": [
        (RECENT, "otp", "BANGLALINK", "70", "0", "x"),
        (at("2024-02-29 23:00:00"), "otp", "BANGLALINK", "70", "0", "x" * 161),
        (at("2024-02-10 23:00:00"), "text", "BANGLALINK", "72", "SUCCESS", "x" * 71),
        (at("2024-02-10 23:00:00"), "text", "OTHER", "72", "SUCCESS", "x"),
    ],
    "issue": [(10, 5, 1, None, "pay failed", RECENT), (15, 2, 1, None, "own", RECENT)],
    "journal": [(1, 10, 1, RECENT)],
    "email": [(1, "ann@x"), (2, "bob@x")],
    "issue_status": [(1, "Closed")],
    "time_entry": [(1, 15, 1.5)],
}

DECODED = [("2024-03-31", "18", "ABCDEF124445560xx", "User profile not found")]


@pytest.fixture(scope="module")
def business(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name, schema in SCHEMAS.items():
        schema = schema.replace(" ts", " timestamp_ntz").replace(" money", " decimal(18,2)")
        spark.createDataFrame(ROWS[name], schema).coalesce(1).write.parquet(str(root / name))
    return Tables(spark, {name: FileTable(str(root / name)) for name in SCHEMAS})


@pytest.fixture(scope="module")
def run(spark, business, tmp_path_factory):
    """All reports, published once."""
    base = tmp_path_factory.mktemp("reports")
    roots = {target: str(base / target) for target in ("main", "users", "cards")}
    earlier = spark.createDataFrame(DECODED, "day string, hour string, wallet string, status string")
    publish(earlier, "qr_failed_users", roots["main"])
    reports = catalog(
        business, AS_OF, SETTINGS, decoded=published(business, "qr_failed_users", roots["main"]),
        work=str(base / "work"),
    )
    return reports, run_reports(reports, roots), roots


@pytest.fixture
def report(spark, run):
    reports, _, roots = run
    return lambda name: rows(read_report(spark, name, roots[reports[name].target]))


def test_the_catalog_answers_every_statement(run):
    reports, _, _ = run
    assert sum(report.covers for report in reports.values()) == 139


def test_every_report_is_published_with_rows(run):
    _, done, _ = run
    assert {name: n for name, n in done.items() if not isinstance(n, int) or n < 1} == {}


def test_health_board(report):
    board = {row[0]: row[2:] for row in report("service_health")}
    assert set(board) == {
        "RECHARGE (GP)", "RECHARGE (BL)", "RECHARGE (ROBI)", "RECHARGE (AIRTEL)", "RECHARGE (TT)",
        "NAGAD IN", "ROCKET IN", "ROCKET OUT", "NAGAD OUT", "VISA CARD", "SQR PAYMENT", "CBL",
        "NPSB INSTANT",
    }  # the bank-to-bank service has no row on a day without transfers
    assert board["RECHARGE (GP)"] == ("18:20", 1, 0, 0, 1, "10", "ACCEPTABLE", "50.00%")
    assert board["RECHARGE (TT)"] == ("00:00", 0, 0, 0, 0, "0", "DOWN", "0%")
    # An aborted attempt is no attempt: one success and one failure count.
    assert board["NAGAD IN"] == ("18:20", 1, 0, 1, 0, "5", "ACCEPTABLE", "50.00%")
    # Unknown results are no attempts either: one success over one failure.
    assert board["ROCKET IN"] == ("18:20", 1, 0, 1, 0, "5", "OK", "100.00%")
    assert board["ROCKET OUT"] == ("18:20", 1, 0, 0, 0, "100", "OK", "100.00%")
    assert board["NAGAD OUT"] == ("00:00", 0, 0, 1, 0, "0", "DOWN", "0.00%")
    assert board["VISA CARD"] == ("18:20", 1, 1, 0, 0, "500", "ACCEPTABLE", "50.00%")
    assert board["SQR PAYMENT"] == ("18:20", 1, 0, 2, 0, "15", "NOT OK", "33.33%")
    assert board["CBL"] == ("18:20", 1, 0, 0, 0, "200", "OK", "100.00%")
    assert board["NPSB INSTANT"] == ("18:20", 1, 1, 0, 0, "30", "ACCEPTABLE", "50.00%")


def test_baselines(report):
    assert report("threshold_recharge") == [("10", "last 4week not success avg", 1.0),
                                            ("18", "last 4week not success avg", 1.0)]
    # Bank-to-bank: the judged day is three days back and ends the baseline.
    assert report("threshold_interbank") == [
        ("09", "last 4week not success avg", 1.0), ("09", "today not success", 1.0),
    ]
    # An unanswered request is not counted as unsuccessful.
    assert report("threshold_qr") == [
        ("10", "last 4week not success avg", 1.0), ("18", "last 4week not success avg", 1.0),
        ("18", "today not success", 1.0),
    ]


def test_daily_and_weekly_summaries(report):
    totals = {row[0]: row[1:] for row in report("daily_totals")}
    assert len(totals) == 11
    assert totals["Recharge"] == (1, 40.0) and totals["MTB"] == (1, 32.0)
    assert totals["BEFTN"] == (2, 700.0) and totals["CBL"] == (0, None)
    weekly = {(row[0], row[1], row[2]): row[3:] for row in report("weekly_satisfaction")}
    assert weekly["service", "Money Out", "CBS"] == (1, 1, 100.0)
    assert weekly["service", "Money Out", "EFT"] == (2, 1, 50.0)
    assert weekly["service", "Money In", "Rocket IN"] == (1, 0, 0.0)
    assert weekly["service", "Super QR Payment", "Super QR Payment"] == (2, 1, 50.0)
    assert weekly["family", "Money Out", None] == (5, 4, 80.0)
    total = weekly["total", None, None]
    leaves = [value for key, value in weekly.items() if key[0] == "service"]
    assert total[:2] == (sum(v[0] for v in leaves), sum(v[1] for v in leaves))


def test_banks_and_cards(report):
    assert report("interbank_day") == [("09", "FAILED", "no account", "First", 1, 400.0)]
    assert report("own_bank_today") == [("18", "SUCCESS", "done", 1, 200.0)]
    assert report("interbank_day_status") == [("2024-03-28", "09", "FAILED", 1, 400.0)]
    assert report("card_out_month") == [
        ("2024-03-30", "Town (Total: 79.00)", "DISPUTE", 1, 70.0),
        ("2024-03-30", "Town (Total: 79.00)", "SUCCESS", 1, 9.0),
        ("2024-03-31", "City (Total: 550.00)", "REVERSE", 1, 50.0),
        ("2024-03-31", "City (Total: 550.00)", "SUCCESS", 1, 500.0),
    ]
    assert report("card_out_disputes") == [(1, 70.0)]
    assert report("transfer_today_reasons") == [
        ("b2", "18", "REVERSE", 31.0, "S1", "MTB", "response: NULL")
    ]


def test_balances_and_ids(report):
    assert report("balance_robi_airtel") == [("api", "77", "api", "88.5")]
    assert report("balance_reseller")[0][2] == "1,235"
    assert report("balance_nagad")[0][1:] == ("2024/03/31 10:11:12", "5,000")
    assert report("qr_inactive_users") == [
        ("2024-03-31", "18", "ABCDEF124445560xx", "User profile not found", 5, "Shop", "w5", "M5")
    ]
    assert report("qr_tag_fields")[0][-2:] == (None, "85")


def test_bills_and_support(report):
    assert report("messages_bill") == [
        ("Total", "4.00", "1.12"), ("otp", "2.00", "0.56"), ("text", "2.00", "0.56"),
    ]
    assert [row for row in report("tickets_resolved") if row[2]] == [("2024-03-31", "ANN", 1)]
    assert [row for row in report("hours_spent") if row[2]] == [("2024-03-31", "BOB", 2)]
    assert report("packages_today")[0][2:] == (99.0, "PURCHASED", 2, 198.0, "PURCHASED(99.00tk package)")


def test_shared_summaries_change_nothing(business, run):
    reports, _, _ = run
    alone = catalog(business, AS_OF, SETTINGS)
    summed = [name for name in reports
              if name.startswith(("card_in_", "wallet_out_", "recharge_today_duration"))]
    assert len(summed) == 9
    for name in (*summed, "recharge_today", "recharge_month_amount", "recharge_today_failed_amount"):
        assert rows(alone[name].build()) == rows(reports[name].build()), name


def test_recharge_reports(report):
    assert report("recharge_today") == [
        ("18", "CHECKOUT", "GP", 1, 20.0), ("18", "SUCCESS", "GP", 1, 10.0),
    ]
    assert report("recharge_month_count") == [
        ("2024-03-26", "FAILED  (BL)", 1), ("2024-03-26", "SUCCESS  (TT)", 1),
        ("2024-03-30", "SUCCESS  (BL)", 1), ("2024-03-31", "CHECKOUT  (GP)", 1),
        ("2024-03-31", "SUCCESS  (GP)", 1),
    ]
    assert report("recharge_today_failed_amount") == [("18", "CHECKOUT", "GP", 20.0)]
    assert report("recharge_today_duration") == [
        ("18", "1 min or less", 1), ("18", "greater then 1 hour", 1),
    ]
    assert report("recharge_today_duration_vendor") == [
        ("18", "1 min or less", "ROBI - (1 min or less)", 1),
        ("18", "greater than 1 hour", "AIRTEL - (greater than 1 hour)", 1),
    ]


def test_looking_for_answers_near_their_requests_changes_nothing(business, run):
    reports, _, _ = run
    near = replace(SETTINGS, answer_slack=timedelta(hours=1))
    narrowed = catalog(business, AS_OF, near)
    for name in ("rocket_out_today_codes", "nagad_out_month_responses", "transfer_today_reasons",
                 "card_out_today_reasons"):
        assert rows(narrowed[name].build()) == rows(reports[name].build())


def test_polling_and_searching_newest_first_change_nothing(business, run, tmp_path):
    reports, _, _ = run
    written = {name: "update_date" for name in ("nagad_in", "rocket_in", "wallet_out")}
    polled = replace(SETTINGS, newest_slack=timedelta(hours=1), state=str(tmp_path), written=written)
    names = [n for n in reports if n.startswith(("threshold_", "balance_"))] + ["recharge_vendors"]
    for as_of in (AS_OF - timedelta(days=2), AS_OF, AS_OF):
        plain, kept = catalog(business, as_of, SETTINGS), catalog(business, as_of, polled)
        for name in names:
            assert rows(kept[name].build()) == rows(plain[name].build()), name
    assert len(list(tmp_path.iterdir())) == 11


@pytest.mark.parametrize("setting", sorted(NEEDED))
def test_a_missing_setting_is_an_error_by_name(business, setting):
    without = replace(SETTINGS, **{setting: None})
    with pytest.raises(ValueError, match=f"settings are missing: {setting} .*{NEEDED[setting][0]}"):
        catalog(business, AS_OF, without)
    reports = catalog(business, AS_OF, without, without=NEEDED[setting])
    assert not set(NEEDED[setting]) & set(reports)


def test_every_needed_setting_belongs_to_known_reports(business):
    reports = catalog(business, AS_OF, SETTINGS)
    assert {name for names in NEEDED.values() for name in names} <= set(reports)


def test_summaries_of_two_catalogs_do_not_meet(business, tmp_path):
    work = str(tmp_path / "work")
    for as_of in (AS_OF, AS_OF - timedelta(days=1)):
        catalog(business, as_of, SETTINGS, work=work)["recharge_today"].build().collect()
    assert len(list((tmp_path / "work").iterdir())) == 2


def test_one_failing_report_does_not_stop_the_others(business, run, tmp_path):
    reports, _, _ = run
    broken = dict(business)
    del broken["plan"]
    reports = catalog(broken, AS_OF, SETTINGS)
    roots = {target: str(tmp_path / target) for target in ("main", "users", "cards")}
    done = run_reports(reports, roots, only=["packages_active", "packages_month"])
    assert done["packages_month"] == 1 and "plan" in str(done["packages_active"])


def test_empty_tables_publish_nothing_or_zeros(business, tmp_path):
    empty = {name: table.filter("false") for name, table in business.items()}
    reports = catalog(empty, AS_OF, SETTINGS)
    roots = {target: str(tmp_path / target) for target in ("main", "users", "cards")}
    chosen = ["qr_log_today", "qr_growth", "nagad_in_today", "card_in_today", "service_health"]
    assert run_reports(reports, roots, only=chosen) == {
        "qr_log_today": 1, "qr_growth": 1, "nagad_in_today": 0, "card_in_today": 0,
        "service_health": 12,
    }
