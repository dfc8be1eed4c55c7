"""Ranges of times that are stored as text: pushed comparisons that lose no text the cast can read."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, rows
from test_plans import scans
from tillwatch.functions import clock
from tillwatch.functions.clock import EVER, Span, text_may_lie_in
from tillwatch.operators import cohort

SPANS = [clock.today(AS_OF), clock.rolling(AS_OF, "instant", 12).settled(AS_OF, timedelta(minutes=5)), Span(start=AS_OF - timedelta(days=500), upto=AS_OF),
         Span(start=datetime(2023, 12, 29), before=datetime(2024, 1, 3)), Span(after=AS_OF, before=AS_OF + timedelta(hours=30)), EVER, Span(start=AS_OF)]


def written(rng, at):
    forms = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%d", " %Y-%m-%d %H:%M", "\t%Y-%m-%d", "+%Y-%m-%d", "00%Y-%m-%d", "%Y-%m-%d %H:%M:%S+06:00",
             "%Y-%m", "%Y", "%Y-%-m-%-d %-H:%M:%S", "%Y-%m-%-d", "%Y-%-m-%d", "%d/%m/%Y", "\x7f%Y-%m-%d", "pending", "", " %Y-%m-%d", "%Y-%m-%d %H:%M:%S "]
    return at.strftime(rng.choice(forms))


@pytest.mark.parametrize("seed", [1, 2])
def test_no_readable_text_of_the_span_is_lost(spark, seed):
    rng = random.Random(seed)
    texts = [written(rng, AS_OF + timedelta(hours=rng.choice((rng.uniform(-40, 40), rng.uniform(-9000, 3000))))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "told string").withColumn("at", F.col("told").try_cast("timestamp_ntz"))
    for span in SPANS:
        inside = span.covers("at")
        if span is not EVER:
            assert df.filter(inside).count() > 0
        assert df.filter(inside & ~F.coalesce(text_may_lie_in("told", span), F.lit(False))).filter("at is not null").count() == 0
    today = df.filter(text_may_lie_in("told", SPANS[0]) & (F.col("told") >= "1") & (F.col("told") < "\x7f"))
    assert {r.told[:4] for r in today.collect()} == {"2024"}


def test_the_range_reaches_the_scan(spark, frame, tmp_path):
    data = [(AS_OF, "2024-03-31 10:00:00", "SUCCESS"), (AS_OF, "2024-3-31 10:05:00", "SUCCESS"), (AS_OF, " 2024-03-31 11:00:00", "FAILED"),
            (AS_OF, "2024-03-30 23:59:59", "SUCCESS"), (AS_OF, "pending", "SUCCESS")]
    frame("create_date ts, update_date string, txn_status string", data).write.parquet(str(tmp_path / "cashback"))
    report = cohort.cashback_cohort(spark.read.parquet(str(tmp_path / "cashback")), clock.today(AS_OF))
    assert rows(report) == [("10", "SUCCESS", 2), ("11", "FAILED", 1)]
    (_, pushed), = scans(report)
    assert "GreaterThanOrEqual(update_date,2024-03-31),LessThan(update_date,2024-03-32)" in pushed
    assert "GreaterThanOrEqual(update_date,2024-3-31)" in pushed and "LessThan(update_date,1)" in pushed
