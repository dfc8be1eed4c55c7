"""Distinct counts of several spans from bitmaps, against counting each anew."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, at, rows
from test_plans import plan
from tillwatch.functions import clock
from tillwatch.functions.clock import EVER, Span
from tillwatch.operators import logs
from tillwatch.operators.distinct import Buckets, counts_of, member_bitmaps, merged_bitmaps

SCHEMA = "create_date ts, user string, status string"
MONTH = clock.rolling(AS_OF, "date_after_instant").settled(AS_OF, timedelta(minutes=5))
SPANS = {"today": Buckets(clock.today(AS_OF), "hour"), "month": Buckets(MONTH, "day"), "all": Buckets(MONTH), "week": Buckets(clock.previous_week(AS_OF), "hour")}


def some_rows(seed, n=800):
    rng = random.Random(seed)
    return [(AS_OF - timedelta(hours=rng.choice((rng.uniform(-3, 20), rng.uniform(0, 900)))), rng.choice((None, *(f"u{k}" for k in range(30)), *["hot"] * 15)),
             rng.choice(("x", "y", None))) for _ in range(n)] + [(None, "u", "x")]


def anew(fact, spans, shift=clock.NO_SHIFT):
    out = []
    for name, b in spans.items():
        when = clock.moved("create_date", shift)
        bucket = {"hour": F.date_format(when, "HH"), "day": F.date_format(when, "yyyy-MM-dd"), "whole": F.lit(None).cast("string")}[b.by]
        held = fact.filter(b.span.covers("create_date", shift))
        out += rows(held.groupBy(F.lit(name).alias("span"), bucket.alias("bucket"), "status").agg(F.count_distinct("user")))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,shift", [(1, clock.NO_SHIFT), (2, timedelta(hours=6)), (3, timedelta(hours=-5))])
def test_equals_counting_every_bucket_anew(frame, seed, shift):
    fact = frame(SCHEMA, some_rows(seed))
    found = counts_of(member_bitmaps(fact, F.col("user"), SPANS, dims=("status",), shift=shift), SPANS, dims=("status",))
    assert sorted(rows(found), key=str) == anew(fact, SPANS, shift)


def test_bitmaps_of_several_readings_merge(frame):
    data = some_rows(4)
    parts = [frame(SCHEMA, data[:500]), frame(SCHEMA, data[300:])]  # rows that both have read count once
    one, other = (member_bitmaps(p, F.col("user"), SPANS, dims=("status",)) for p in parts)
    found = counts_of(merged_bitmaps(one, other), SPANS, dims=("status",))
    assert sorted(rows(found), key=str) == anew(frame(SCHEMA, data), SPANS)


def test_one_scan_and_one_row_per_member_reaches_the_shuffle(spark, frame, tmp_path):
    frame(SCHEMA, some_rows(5)).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    found = plan(counts_of(member_bitmaps(fact, F.col("user"), SPANS, dims=("status",)), SPANS, dims=("status",)))
    assert found.count("FileScan") == 1 and "Expand" not in found and found.count("Exchange") == 2
    assert "partial_bit_or" in found


def test_days_need_an_end_and_fit_a_bitmap():
    for span in (EVER, Span(start=AS_OF), Span(start=AS_OF - timedelta(days=80), upto=AS_OF)):
        with pytest.raises(ValueError):
            Buckets(span, "day").number()
    assert Buckets(Span(start=AS_OF - timedelta(days=61), upto=AS_OF), "day").number() == 62


def test_codes_of_requests_with_several_answers(frame):
    log = "id long, request_id string, create_date ts, request string, response string"
    answer = "<ResponseCode>{}</ResponseCode> <ResponseMessage>m</ResponseMessage>"
    fact = frame("id long, request_id string, create_date ts", [
        (1, "a", at("2024-03-31 01:10:00")), (2, "a", at("2024-03-31 05:10:00")), (3, "b", at("2024-03-30 01:00:00")), (4, None, at("2024-03-31 01:00:00")),
        (5, "c", at("2024-03-31 01:30:00"))])
    answers = frame(log, [(1, "a", AS_OF, "q", answer.format(1)), (2, "a", AS_OF, "q", answer.format(1)), (3, "a", AS_OF, "q", answer.format(2)),
                          (4, "b", AS_OF, "q", answer.format(1)), (5, None, AS_OF, "q", answer.format(1)), (6, "c", AS_OF, "q", "none")])
    spans = {"today": SPANS["today"], "all": SPANS["all"]}
    assert rows(logs.xml_codes_by_span(fact, answers, spans)) == [
        ("all", None, "1 -> m", 2), ("all", None, "2 -> m", 1), ("all", None, None, 1),
        ("today", "01", "1 -> m", 1), ("today", "01", "2 -> m", 1), ("today", "01", None, 1),
        ("today", "05", "1 -> m", 1), ("today", "05", "2 -> m", 1)]
