"""Joined and grouped reports against brute force, with a third of all rows on one key."""

import random
from collections import Counter, defaultdict
from datetime import timedelta
from decimal import Decimal

import pytest

from conftest import AS_OF, rows
from tillwatch.functions import clock
from tillwatch.functions.clock import EVER
from tillwatch.operators import cohort, detail, logs, sla, support
from tillwatch.operators.summary import cohort_from_summary, hourly_summary

N = 3000


def hot(rng, n, share=0.34):
    """Key 0 with probability ``share``, otherwise one of ``n`` keys."""
    return 0 if rng.random() < share else rng.randrange(1, n)


@pytest.fixture(scope="module")
def business(spark):
    """Facts and logs whose ids, banks and texts are all skewed, with duplicates on both sides."""
    rng = random.Random(7)
    fact, log = [], []
    for n in range(N):
        at = AS_OF - timedelta(minutes=rng.randrange(0, 3 * 24 * 60))
        fact.append((n, f"r{hot(rng, 400)}", at, ["REVERSE", "SUCCESS", "FAILED", None][rng.randrange(4)],
                     Decimal(rng.randrange(0, 100000)) / 100, f"bank{hot(rng, 9)}"))
    for n in range(N):
        text = f"<ResponseCode>{hot(rng, 5)}</ResponseCode> <ResponseMessage>m</ResponseMessage>"
        response = rng.choice([text, f'{{"actionCode": "{rng.choice(["05", "61", "77"])}"}}', None])
        log.append((n, f"r{hot(rng, 400)}", f"VisaFundTransferDto {n}", response))
    fact_df = spark.createDataFrame(
        fact, "id long, request_id string, create_date timestamp_ntz, status string, "
              "amount decimal(18,2), bank_name string")
    log_df = spark.createDataFrame(
        log, "id long, request_id string, request string, response string")
    return fact, log, fact_df, log_df


def day(at):
    return at.date().isoformat()


def by_request(log):
    answers = defaultdict(list)
    for row in log:
        answers[row[1]].append(row)
    return answers


def test_codes_and_raw_responses(business):
    fact, log, fact_df, log_df = business
    answers = by_request(log)
    codes, raw = defaultdict(set), defaultdict(set)
    for _, request, at, status, *_ in fact:
        for _, _, _, response in answers[request]:
            label = None
            if response and response.startswith("<"):
                label = response.split(">")[1].split("<")[0] + " -> m"
            codes[day(at), label].add(request)
            if status not in ("SUCCESS", None) and response is not None:
                raw[day(at), response].add(request)
    found = logs.xml_code_cohort(fact_df, log_df, EVER, "day")
    assert Counter(map(tuple, found.collect())) == Counter(
        (*key, len(requests)) for key, requests in codes.items())
    found = logs.raw_response_cohort(fact_df, log_df, EVER, "day")
    wanted = Counter((*key, len(requests)) for key, requests in raw.items())
    assert Counter(map(tuple, found.collect())) == wanted
    by_key = logs.raw_response_cohort(fact_df, log_df, EVER, "day", dictionary=True)
    assert by_key.columns == found.columns and Counter(map(tuple, by_key.collect())) == wanted


def test_bank_answers_multiply_their_request(business, spark):
    fact, _, fact_df, _ = business
    rng = random.Random(3)
    answers = [(hot(rng, N), f'{{"responseMessage": "{rng.choice("ab")}"}}') for _ in range(N)]
    log_df = spark.createDataFrame(answers, "np_txn_request_id long, response_text string")
    texts = defaultdict(list)
    for request, text in answers:
        texts[request].append(text[21])
    count, total = Counter(), Counter()
    for n, _, at, status, amount, _ in fact:
        for message in texts[n] or ["No data in bank_txn_log"]:
            count[day(at), status, message] += 1
            total[day(at), status, message] += amount
    found = logs.bank_response_cohort(fact_df, log_df, EVER, "day", ts="create_date")
    assert {tuple(row)[:3]: tuple(row)[3:] for row in found.collect()} == {
        key: (count[key], total[key]) for key in count}


def test_reversals_carry_the_counts_of_all_their_rows(business):
    fact, log, fact_df, log_df = business
    answers, meant = by_request(log), []
    names = {"05": "05-Do not honor", "61": "61-Exceeds approval amount limit"}
    for n, request, at, status, _, bank in fact:
        if status == "REVERSE":
            for _, _, _, response in answers[request]:
                code = response[16:18] if response and response.startswith("{") else None
                meant.append((n, day(at), bank, code, names.get(code, "Other")))
    banks, meanings = Counter(row[2] for row in meant), Counter(row[4] for row in meant)
    wanted = Counter((n, at, f"{bank} ({banks[bank]})", "REVERSE", code, f"{text} ({meanings[text]})")
                     for n, at, bank, code, text in meant)
    assert Counter(map(tuple, logs.reverse_reasons(fact_df, log_df).collect())) == wanted


def test_first_responses(business):
    fact, log, fact_df, log_df = business
    first = {}
    for n, request, _, response in log:
        first.setdefault(request, response or "response: NULL")
    failed = {}
    for _, request, at, status, amount, bank in fact:
        if status == "REVERSE":
            row = (at, status, amount, bank)
            failed[request] = min(failed.get(request, row), row)
    wanted = Counter((request, day(row[0]), *row[1:], first[request])
                     for request, row in failed.items() if request in first)
    found = logs.first_response_per_request(
        fact_df, log_df, EVER, columns=("status", "amount", "bank_name"))
    assert Counter(map(tuple, found.collect())) == wanted
    fetched = logs.first_response_per_request(
        fact_df, log_df, EVER, columns=("status", "amount", "bank_name"), fetch=True)
    assert fetched.columns == found.columns and Counter(map(tuple, fetched.collect())) == wanted


def test_entity_totals_and_dimensions(business, spark):
    fact, _, fact_df, _ = business
    totals, count, amount = Counter(), Counter(), Counter()
    for _, _, at, status, paid, bank in fact:
        totals[bank] += paid
        count[day(at), bank, status] += status is not None
        amount[day(at), bank, status] += paid
    found = cohort.cohort_with_entity_total(fact_df, EVER, "bank_name")
    assert Counter(map(tuple, found.collect())) == Counter(
        (at, f"{bank} (Total: {totals[bank]})", status, n, amount[at, bank, status])
        for (at, bank, status), n in count.items())
    dim = spark.createDataFrame([(f"bank{n}", f"group {n % 2}") for n in range(9)],
                                "bank_name string, grp string")
    grouped = Counter()
    for (at, bank, status), n in count.items():
        grouped[at, f"group {int(bank[4:]) % 2}", status] += n
    found = cohort.dimension_cohort(fact_df, dim, "bank_name", "grp", EVER, "day")
    assert {tuple(row)[:3]: row[3] for row in found.collect()} == dict(grouped)


def test_growth_follows_day_and_status_order(business):
    fact, _, fact_df, _ = business
    amounts = Counter()
    for _, _, at, status, paid, _ in fact:
        amounts[day(at), status] += paid
    order = sorted(amounts, key=lambda key: (key[0], key[1] is None, key[1] or ""))
    wanted, before = [], None
    for key in order:
        growth = Decimal(0)
        if before:
            growth = ((amounts[key] - before) * 100 / before).quantize(Decimal("0.01"), "ROUND_HALF_UP")
        wanted.append((*key, amounts[key], growth))
        before = amounts[key]
    found = sla.daily_growth(fact_df, EVER).drop("txn_count")
    assert Counter(map(tuple, found.collect())) == Counter(wanted)


def test_top_reasons_of_a_hot_bucket(spark):
    rng = random.Random(11)
    data = [(AS_OF - timedelta(hours=hot(rng, 10)), "FAILED", f"reason {hot(rng, 60, 0.2)}")
            for _ in range(N)]
    df = spark.createDataFrame(data, "create_date timestamp_ntz, status string, description string")
    counts = defaultdict(Counter)
    for at, _, reason in data:
        counts[f"{at:%H}"][reason] += 1
    wanted = [(hour, reason, n) for hour, reasons in counts.items()
              for reason, n in sorted(reasons.items(), key=lambda item: (-item[1], item[0]))[:5]]
    assert rows(cohort.top_reasons(df, EVER)) == sorted(wanted, key=lambda r: [str(c) for c in r])


def test_tickets_of_one_busy_issue(spark):
    rng = random.Random(5)
    journals = [(n, hot(rng, 200), rng.randrange(0, 5), AS_OF - timedelta(hours=rng.randrange(0, 600)))
                for n in range(N)]
    issues = [(n, 50, n % 3, None, f"subject {n}") for n in range(200)]
    emails = [(n, f"agent{n}@x") for n in range(5)]
    statuses = [(0, "Closed"), (1, "Resolved"), (2, "Open")]
    staff = (0, 1, 2)
    work = [(n, ticket, user, at) for n, ticket, user, at in journals
            if user in staff and ticket % 3 != 2 and at.date() >= (AS_OF - timedelta(days=30)).date()]
    newest = {}
    for _, ticket, _, at in work:
        newest[ticket] = max(newest.get(ticket, at), at)
    wanted = Counter((day(at), f"A{user}") for _, ticket, user, at in work if at == newest[ticket])
    resolved = support.latest_journals(
        spark.createDataFrame(
            journals, "id long, journalized_id long, user_id long, created_on timestamp_ntz"),
        spark.createDataFrame(
            issues, "id long, author_id long, status_id long, category_id long, subject string"),
        spark.createDataFrame(emails, "user_id long, address string"),
        spark.createDataFrame(statuses, "id long, name string"), AS_OF, staff=staff)
    agents = {f"agent{n}": f"A{n}" for n in range(5)}
    found = support.resolution_counts(resolved, AS_OF, agents)
    assert {tuple(row)[:2]: row[2] for row in found.collect() if row[2]} == dict(wanted)


def test_forms_and_latest_values(spark):
    rng = random.Random(2)
    data = [(hot(rng, 50), AS_OF - timedelta(minutes=rng.randrange(0, 900)), "open", hot(rng, 3), n)
            for n in range(N)]
    df = spark.createDataFrame(
        data, "id long, created_at timestamp_ntz, event_name string, user_id long, place long")
    today = [(i, at, user) for i, at, _, user, _ in data if at.date() == AS_OF.date()]
    sizes = Counter((i, user) for i, _, user in today)
    wanted = {(i, f"{at:%H}", "L", user, sizes[i, user]) for i, at, user in today}
    found = detail.form_open_events(df, clock.today(AS_OF), event_name="open", label="L").collect()
    assert len(found) == len(wanted) and set(map(tuple, found)) == wanted
    latest = {user: place for _, _, _, user, place in data}
    pivot = detail.latest_by_key_pivot(
        df.withColumnRenamed("user_id", "k"), {"a": 0, "b": 1, "c": 2}, key="k", value="place",
        order="place")
    assert rows(pivot) == [(latest[0], latest[1], latest[2])]


def test_clock_and_rows_moved_together_change_nothing(business):
    _, _, fact_df, _ = business
    from pyspark.sql import functions as F

    from tillwatch.operators.health import service_health, status_roles

    week = timedelta(days=7)
    moved = fact_df.withColumn("create_date", F.col("create_date") - F.lit(week))
    here = rows(service_health(fact_df, AS_OF, status_roles()).drop("date"))
    there = rows(service_health(moved, AS_OF - week, status_roles()).drop("date"))
    assert here == there


def test_cohorts_of_one_summary_equal_their_own_readings(business):
    _, _, fact_df, _ = business
    spans = {
        "settled": clock.today(AS_OF).settled(AS_OF, timedelta(minutes=5)),
        "instant": clock.rolling(AS_OF, "instant", 1), "days": clock.last_days(AS_OF, 2, 1), "ever": EVER,
    }
    shift = timedelta(hours=6)
    for moved in (timedelta(0), shift):
        summary = hourly_summary(fact_df, spans, ("status", "bank_name"), shift=moved)
        for name, span in spans.items():
            for bucket in ("hour", "day"):
                own = cohort.status_cohort(fact_df, span, bucket, shift=moved, counted="status")
                summed = cohort_from_summary(summary, name, bucket, counted="status")
                assert rows(summed) == rows(own), (name, bucket, moved)


def test_bucket_counts_add_up(business):
    _, _, fact_df, _ = business
    span = clock.rolling(AS_OF, "instant", 2)
    kept = fact_df.filter(span.covers("create_date")).count()
    for bucket in ("hour", "day"):
        counts = cohort.status_cohort(fact_df, span, bucket, dims=("status", "bank_name"))
        assert sum(row["txn_count"] for row in counts.collect()) == kept
