"""Polled reports: after every poll equal to reading everything, and what a poll reads."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, cash, rows
from test_plans import scans
from tillwatch.functions import clock
from tillwatch.functions.clock import EVER, Span
from tillwatch.operators import cohort, detail, health, polls
from tillwatch.sources.state import State

SCHEMA = "id long, create_date ts, written ts, mobile_operator string, vendor_name string, status string, amount money"
COLUMNS = {"a": "A", "b": "B", "c": "C", "never": "N"}


def bad():
    return F.col("status") != "SUCCESS"


def story(seed, days=40, per_day=25, start=datetime(2024, 2, 20)):
    """(visible from, row): rows come in late by up to a day, a few much later, and some change afterwards."""
    rng = random.Random(seed)
    out = []
    for id in range(days * per_day):
        at = start + timedelta(days=id / per_day, seconds=rng.uniform(-4000, 4000))
        seen = at + timedelta(minutes=rng.choice((0, 1, 30, 600, 60 * 24 * 6 if rng.random() < 0.1 else 0)))
        row = [id, at, seen, rng.choice("ABBCX"), rng.choice("VW"), rng.choice(("SUCCESS", "FAILED", None)), cash(rng.randrange(1, 90))]
        out.append((seen, tuple(row)))
        if rng.random() < 0.1:
            later = seen + timedelta(hours=rng.uniform(1, 200))
            out.append((later, tuple([*row[:2], later, *row[3:5], "REVERSED", row[6]])))
    return out


def visible(events, as_of):
    """What a reader finds at ``as_of``: of each id what was written last by then."""
    table = {}
    for seen, row in sorted(events, key=lambda e: e[0]):
        if seen <= as_of:
            table[row[0]] = row
    return list(table.values())


CLOCKS = [AS_OF - timedelta(days=20, hours=3), AS_OF - timedelta(days=19, hours=20), AS_OF - timedelta(days=9), AS_OF - timedelta(days=9),
          AS_OF - timedelta(hours=14), AS_OF]


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_by_key_equals_a_full_read_after_every_poll(spark, frame, tmp_path, seed):
    events = [(seen, row) for seen, row in story(seed) if seen - row[1] <= timedelta(days=1)]
    state = State(spark, str(tmp_path), "latest")
    for as_of in CLOCKS:
        fact = frame(SCHEMA, visible(events, as_of))
        got = polls.latest_by_key_polled(fact, COLUMNS, state, as_of)
        assert rows(got) == rows(detail.latest_by_key_pivot(fact, COLUMNS))
        assert got.columns == list(COLUMNS)


def test_a_late_row_of_a_smaller_id_counts_for_its_key(spark, frame, tmp_path):
    state = State(spark, str(tmp_path), "latest")
    first = [(9, AS_OF, AS_OF, "A", "new", "S", cash(1)), (2, AS_OF - timedelta(days=30), AS_OF, "B", "old", "S", cash(1))]
    assert rows(polls.latest_by_key_polled(frame(SCHEMA, first), COLUMNS, state, AS_OF)) == [("new", "old", None, None)]
    late = [*first, (5, AS_OF - timedelta(hours=2), AS_OF, "B", "late", "S", cash(1)), (4, AS_OF, AS_OF, "A", "smaller", "S", cash(1))]
    assert rows(polls.latest_by_key_polled(frame(SCHEMA, late), COLUMNS, state, AS_OF + timedelta(hours=1))) == [("new", "late", None, None)]
    # another key column is another state
    found = polls.latest_by_key_polled(frame(SCHEMA, late), {"s": "S"}, state, AS_OF, key="status")
    assert rows(found) == [("new",)]


def threshold(function, fact, *args, **options):
    return rows(function(fact, *args, baseline_bad=bad(), today_bad=F.col("status") == "FAILED", **options))


@pytest.mark.parametrize("seed,options", [(3, {}), (4, {"shift": timedelta(hours=6)}), (5, {"day_lag": 3, "shift": timedelta(hours=-2)}), (6, {"zero_fill": True, "weeks": 2})])
def test_baseline_equals_a_full_read_after_every_poll(spark, frame, tmp_path, seed, options):
    events = story(seed)
    state = State(spark, str(tmp_path), "weeks")
    for as_of in CLOCKS:
        fact = frame(SCHEMA, visible(events, as_of))
        got = threshold(polls.threshold_vs_today_polled, fact, state, as_of, changed="written", **options)
        assert got == threshold(health.threshold_vs_today, fact, as_of, **options)


def test_entity_totals_equal_a_full_read_after_every_poll(spark, frame, tmp_path):
    events = story(7)
    state = State(spark, str(tmp_path), "month")
    for as_of in CLOCKS:
        fact = frame(SCHEMA, visible(events, as_of))
        for span in (clock.rolling(as_of, "date_after_instant", 12), clock.rolling(as_of, "instant", 5).settled(as_of, timedelta(minutes=7))):
            got = polls.cohort_with_entity_total_polled(fact, state, as_of, span, "vendor_name", changed="written")
            assert rows(got) == rows(cohort.cohort_with_entity_total(fact, span, "vendor_name"))


def test_spans_without_ends_within_an_hour_and_of_the_past(spark, frame, tmp_path):
    fact = frame(SCHEMA, [row for _, row in story(8, days=12)])
    state = State(spark, str(tmp_path), "any")
    as_of = datetime(2024, 3, 1, 10, 20)
    spans = [EVER, Span(start=as_of - timedelta(minutes=5)), Span(after=datetime(2024, 2, 25, 4), upto=datetime(2024, 2, 27, 9, 30)),
             Span(after=datetime(2024, 2, 25, 4, 10), before=datetime(2024, 2, 25, 4, 50)), clock.today(as_of), Span(before=datetime(2024, 2, 26))]
    for span in spans:
        hours = polls.settled_hours(fact, state, as_of, span, {"n": F.count(F.lit(1))}, dims=("status",))
        got = rows(hours.groupBy("key_day", "key_hour", "status").agg(F.sum("n")))
        want = fact.filter(span.covers("create_date")).groupBy(F.to_date("create_date"), F.hour("create_date"), "status").count()
        assert got == rows(want)


def test_settled_rows_are_not_read_again(spark, frame, tmp_path):
    """The state holds the past: when the files of the past are gone, the report is the same."""
    events = [row for _, row in story(9) if row[1] <= AS_OF]
    state = State(spark, str(tmp_path), "weeks")
    fact = frame(SCHEMA, events)
    want = threshold(polls.threshold_vs_today_polled, fact, state, AS_OF)
    edge = AS_OF - timedelta(weeks=4) + timedelta(hours=1)
    kept = [row for row in events if row[1] >= clock.midnight(AS_OF) or row[1] <= edge]
    assert len(kept) < len(events) / 3
    assert threshold(polls.threshold_vs_today_polled, frame(SCHEMA, kept), state, AS_OF) == want
    # another rule does not use these sums
    other = polls.threshold_vs_today_polled(fact, state, AS_OF, baseline_bad=F.col("status") == "FAILED")
    assert rows(other) == rows(health.threshold_vs_today(fact, AS_OF, baseline_bad=F.col("status") == "FAILED"))


def test_a_poll_pushes_the_open_day_into_the_scan(spark, frame, tmp_path):
    frame(SCHEMA, [row for _, row in story(10)]).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    state = State(spark, str(tmp_path), "weeks")
    polls.threshold_vs_today_polled(fact, state, AS_OF, baseline_bad=bad())
    pushed = [p for columns, p in scans(polls.threshold_vs_today_polled(fact, state, AS_OF, baseline_bad=bad())) if "create_date" in columns]
    assert len(pushed) == 1
    assert "Or(GreaterThanOrEqual(create_date,2024-03-31T00:00),LessThan(create_date,2024-03-03T19:00))" in pushed[0]


def test_a_failing_poll_leaves_the_state(spark, frame, tmp_path):
    state = State(spark, str(tmp_path), "s")
    state.replace(spark.range(3), {"k": 1})
    with pytest.raises(Exception, match="boom"):
        state.replace(spark.range(5).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), {"k": 2})
    found, about = state.read()
    assert found.count() == 3 and about == {"k": 1}
    for k in range(4):
        state.replace(spark.range(k), {"k": k})
    assert state.read()[0].count() == 3 and len(list((tmp_path / "s" / "versions").iterdir())) == 2
    assert State(spark, str(tmp_path), "none").read() is None
