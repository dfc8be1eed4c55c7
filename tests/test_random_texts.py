"""Text rules against plain Python over random texts built from their own building blocks."""

import random
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tillwatch.functions import classify, clock, text

N = 1500


def texts(rng, pieces, longest=8):
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(longest))) for _ in range(N)]


def test_last_value_of_a_key(spark):
    rng = random.Random(1)
    pieces = ['"k":', '"k"', ' "', '"', "a", "bc", "\n", " ", "{", "}", ", ", '"k": "v"', '"k": ""']
    data = texts(rng, pieces)
    found = spark.createDataFrame([(t,) for t in data], "t string").select(
        text.extract_last(F.col("t"), '"k":')).collect()
    for value, (got,) in zip(data, found, strict=True):
        match = re.search(r'(?s).*"k":\s*"([^"]+)"', value)
        assert got == (match.group(1) if match else None), repr(value)


def test_response_status_ladder(spark):
    rng = random.Random(2)
    pieces = ["{", "}", "npsb transfer credit", "NPSB Transfer Credit", '"message": "', '"error": "',
              '"', "x", "\n", " ", '"message":', "no"]
    data = texts(rng, pieces)
    column = classify.response_status(F.col("t"), F.lit("FAILED"))
    found = spark.createDataFrame([(t,) for t in data], "t string").select(column).collect()
    seen = set()
    for value, (got,) in zip(data, found, strict=True):
        wanted = "FAILED"
        if re.search(r"(?s)\{.*npsb transfer credit.*\}", value.lower()):
            wanted = "SUCCESS"
        else:
            for key in ("message", "error"):
                match = re.search(rf'(?s).*"{key}":\s*"([^"]+)"', value)
                if match:
                    wanted = match.group(1)
                    break
        seen.add(wanted)
        assert got == wanted, repr(value)
    assert {"SUCCESS", "FAILED"} < seen


def test_balances_codes_and_titles(spark):
    rng = random.Random(3)
    pieces = ["Your new balance is ", " TAKA", "12.5", "7", "\n", " ", "x-y", "it's", "<ResponseCode>",
              "</ResponseCode>", "<ResponseMessage>", "</ResponseMessage>"]
    data = texts(rng, pieces, 12)
    code = r"<ResponseCode>(.*?)</ResponseCode>.*?<ResponseMessage>(.*?)</ResponseMessage>"
    found = spark.createDataFrame([(t,) for t in data], "t string").select(
        text.between_markers(F.col("t"), "Your new balance is ", " TAKA"),
        text.code_and_message(F.col("t"), code), text.title_words(F.col("t"))).collect()
    for value, (balance, pair, title) in zip(data, found, strict=True):
        match = re.search(r"(?s)Your new balance is (.*?) TAKA", value)
        assert balance == (match.group(1) if match else None), repr(value)
        match = re.search(f"(?s){code}", value)
        assert pair == (" -> ".join(match.groups()) if match else None), repr(value)
        assert title == " ".join(value.title().split()), repr(value)


def test_spans_against_dates_and_times(spark):
    rng = random.Random(4)
    base = datetime(2024, 2, 27)
    times = [base + timedelta(seconds=rng.randrange(0, 40 * 86400)) for _ in range(N)]
    times += [base + timedelta(days=n) for n in range(40)]
    table = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    six = timedelta(hours=6)
    for as_of in (datetime(2024, 3, 31, 18, 30), datetime(2024, 4, 1), datetime(2024, 3, 1, 0, 2)):
        day, ago = as_of.date(), timedelta(days=30)
        rules = {
            "today": (clock.today(as_of), lambda t: t.date() == day),
            "settled": (clock.today(as_of).settled(as_of, timedelta(minutes=5)),
                        lambda t: t.date() == day and t <= as_of - timedelta(minutes=5)),
            "date_after_instant": (clock.rolling(as_of, "date_after_instant"),
                                   lambda t: datetime(t.year, t.month, t.day) >= as_of - ago),
            "dates": (clock.rolling(as_of, "dates"), lambda t: t.date() >= day - ago),
            "days": (clock.last_days(as_of, 9, 3),
                     lambda t: day - timedelta(days=9) <= t.date() <= day - timedelta(days=3)),
            "week": (clock.previous_week(as_of),
                     lambda t: 0 < (day - timedelta(days=(day.weekday() + 1) % 7) - t.date()).days <= 7),
            "month": (clock.previous_month(as_of),
                      lambda t: (t.year, t.month) == ((day.replace(day=1) - timedelta(days=1)).year,
                                                      (day.replace(day=1) - timedelta(days=1)).month)),
        }
        for name, (span, rule) in rules.items():
            for shift in (timedelta(0), six):
                kept = table.filter(span.covers("t", shift)).count()
                assert kept == sum(rule(t + shift) for t in times), (name, as_of, shift)
