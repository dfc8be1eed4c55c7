from datetime import timedelta

from pyspark.sql import functions as F

from conftest import at, cash
from tillwatch.functions import classify, fixed_values as fixed, numbers, text


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_duration_classes_keep_their_edges(frame):
    start = at("2024-03-31 10:00:00")
    gaps = [60, 60.9, 120, 300, 600, 600.000001, 3600, 3601, None, -5]
    df = frame("a ts, b ts", [
        (start, None if gap is None else start + timedelta(seconds=gap)) for gap in gaps
    ])
    assert values(df, classify.duration_label(F.col("a"), F.col("b"))) == [
        "1 min or less", "2 min or less", "2 min or less", "5 min or less", "10 min or less",
        "1 hr or less", "1 hr or less", "greater than 1 hour", "greater than 1 hour", "1 min or less",
    ]


def test_health_labels(frame):
    df = frame("r decimal(20,7)", [(cash(v),) if v else (None,) for v in
                                   (None, "0", "0.01", "29.99", "30", "70", "70.01", "100")])
    assert values(df, classify.health_of_rate(F.col("r"), 30, 70)) == [
        "DOWN", "DOWN", "NOT OK", "NOT OK", "ACCEPTABLE", "ACCEPTABLE", "OK", "OK",
    ]
    counts = frame("n long", [(0,), (4,), (5,), (20,), (21,)])
    assert values(counts, classify.health_of_count(F.col("n"))) == [
        "NOT OK", "NOT OK", "ACCEPTABLE", "ACCEPTABLE", "OK",
    ]


def test_response_status_takes_the_last_message(frame):
    df = frame("r string", [
        ('{"x": "npsb TRANSFER credit"}',),
        ('{"message": "one", "message":   "two"}',),
        ('{"error": "bad"}',),
        ('{"message": "", "error": "bad"}',),
        ('line one\n"message": "after a break"\nmore',),
        ("plain text",),
        ('{"note": "NPSB transfer credit without the closing brace"',),
        (None,),
    ])
    assert values(df, classify.response_status(F.col("r"), F.lit("FAILED"))) == [
        "SUCCESS", "two", "bad", "bad", "after a break", "FAILED", "FAILED", "FAILED",
    ]
    raw = values(df, classify.response_status(F.col("r"), F.col("r")))
    assert raw[5] == "plain text" and raw[7] is None


def test_reasons(frame):
    duplicate = (
        "The mobile number 017 cannot use the same recharge service within 2.00 minutes of last "
        "successful transaction as last transfer amount is same as current requested amount."
    )
    queued = "Your request to recharge 017 is already in queue. Please wait for sometime."
    no_credit = (
        "x Your current request to transfer 20TAKA cannot be processed as you do not have enough credit. y"
    )
    df = frame("d string", [(None,), ("invalid transfer value 3",), (duplicate,),
                            ("3006202:" + duplicate,), (queued,), (no_credit,), ("other",)])
    assert values(df, classify.failure_reason(F.col("d"))) == [
        "NULL", "Invalid Transfer Value", "duplicate 2 minutes", "3006202:" + duplicate,
        "Your request to recharge {rcvr_num} is already in queue. Please wait for sometime.",
        fixed.NO_CREDIT_REASON, "other",
    ]
    # The monthly rules know no queue message, and want a blank before the currency.
    assert values(df, classify.failure_reason(F.col("d"), monthly=True))[4:] == [
        queued, no_credit, "other",
    ]


def test_status_folding_and_provider_status(frame):
    df = frame("s string, p string", [("SUCCESS", "Success"), ("ODD", "TransactionInProgress"),
                                      (None, None), ("FAILED", "Weird")])
    assert values(df, classify.fold_unlisted(F.col("s"), ("SUCCESS", "FAILED"))) == [
        "SUCCESS", "DISPUTE", None, "FAILED",
    ]
    assert values(df, classify.wallet_status(F.col("p"), F.col("s"))) == [
        "SUCCESS", "IN_PROGRESS", None, "FAILED",
    ]


def test_card_actions(frame):
    df = frame("c string", [("05",), ("61",), ("00",), (None,)])
    assert values(df, classify.card_action(F.col("c"))) == [
        "05-Do not honor", "61-Exceeds approval amount limit", "Other", "Other",
    ]


def test_segments_change_at_their_limits(frame):
    lengths = {"text": {70: 1, 71: 2, 134: 2, 135: 3, 201: 3, 202: 4, 268: 4, 269: 5},
               "code": {160: 1, 161: 2, 306: 2, 307: 3, 459: 3, 460: 4, 612: 4, 613: 5, 765: 5, 766: 6},
               "other": {900: 1}}
    cases = [(channel, "é" * n, count) for channel, ns in lengths.items() for n, count in ns.items()]
    cases += [("text", None, 1), (None, "x" * 900, 1)]
    df = frame("c string, t string, n long", cases)
    found = df.select(classify.segments(F.col("c"), F.col("t"), ("text",), ("code",)), "n").collect()
    assert all(row[0] == row[1] for row in found)


def test_bank_rail_limits(frame):
    start = at("2024-03-01 00:00:00")
    df = frame("c string, a ts, b ts", [
        ("OWN", start, start + timedelta(minutes=5)), ("OWN", start, start + timedelta(minutes=5.1)),
        ("FAR", start, start + timedelta(days=3)), ("FAR", start, start + timedelta(days=3.1)),
        (None, start, start),
    ])
    in_time = classify.bank_in_time(F.col("c"), F.col("a"), F.col("b"), "OWN")
    assert values(df, in_time) == [True, False, True, False, None]
    assert values(df, classify.bank_rail(F.col("c"), "OWN")) == ["CBS", "CBS", "EFT", "EFT", "EFT"]


def test_countable_attempts(frame):
    df = frame("r string", [("a TIMEOUT b",), ("user profile NOT found",), ("fine",), (None,)])
    assert values(df, F.coalesce(classify.countable_attempt(F.col("r")), F.lit(False))) == [
        True, True, False, False,
    ]


def test_text_helpers(frame):
    df = frame("t string", [
        ("Your new balance is 12.50 TAKA, then Your new balance is 3 TAKA",), ("no balance",),
        ("Your new balance is 12.50",), (None,),
    ])
    assert values(df, text.between_markers(F.col("t"), fixed.BALANCE_BEFORE, fixed.BALANCE_AFTER)) == [
        "12.50", None, None, None,
    ]
    objects = frame("t string", [("{}",), ("{\n}",), ("{",), ("x{}",), (None,)])
    assert values(objects, text.looks_like_object(F.col("t"))) == [True, True, False, False, None]
    words = ["  pay   FAILED again ", "they're x-ray 3d\tlast\nline", "été-ÉTÉ", "", "a", "-b c_d"]
    titles = frame("t string", [(word,) for word in words])
    assert values(titles, text.title_words(F.col("t"))) == [" ".join(w.title().split()) for w in words]
    parts = frame("a string, b string", [("x", None)])
    assert values(parts, text.concat_skip_null(F.col("a"), F.lit("-"), F.col("b"))) == ["x-"]
    assert values(parts, classify.with_suffix(F.col("a"), F.col("b"))) == [None]


def test_a_marker_search_equals_ilike(frame):
    texts = ["{NPSB transfer CREDIT}", "npsb transfer credit", "}NPSB transfer credit{", "{x}", "", None,
             "{\nNPSB transfer credit\n}", "a_b-c", "aXb-c"]
    df = frame("t string", [(text_,) for text_ in texts])
    for pattern in ("%{%NPSB transfer credit%}%", "%npsb%", "%", "a_b%c", "{%}", "%{%x%}"):
        wanted = values(df, F.ilike(F.col("t"), F.lit(pattern)))
        assert values(df, text.marked(F.col("t"), pattern)) == wanted
        negated = values(df, ~text.marked(F.col("t"), pattern))
        assert negated == [None if held is None else not held for held in wanted]


def test_the_last_value_of_a_key(frame):
    df = frame("t string", [
        ('"k": "a", "k": "b"',), ('"k": "a", "k": null',), ('"k": "a", "k": ""',), ('"k":\n "a"',),
        ('"k" : "a"',), ('"k": "open',), ("none",), (None,),
    ])
    assert values(df, text.extract_last(F.col("t"), '"k":')) == [
        "b", "a", "a", "a", None, None, None, None,
    ]


def test_code_and_message_may_be_empty(frame):
    df = frame("t string", [
        ("<ResponseCode></ResponseCode>\n<ResponseMessage>none</ResponseMessage>",),
        ("<ResponseCode>7</ResponseCode>",), (None,),
    ])
    assert values(df, text.code_and_message(F.col("t"), fixed.CODE_AND_MESSAGE)) == [
        " -> none", None, None,
    ]


def test_numbers_round_half_up_and_truncate(frame):
    df = frame("n decimal(20,3)", [(cash("2.5"),), (cash("1234567.891"),), (cash("-2.5"),)])
    assert values(df, text.grouped_digits(F.col("n"))) == ["3", "1,234,568", "-3"]
    assert values(df, numbers.whole_part(F.col("n"))) == [2, 1234567, -2]
    assert values(df, text.two_decimals(F.col("n"))) == ["2.50", "1234567.89", "-2.50"]
    ratio = frame("a long, b long", [(1, 3), (1, 0)])
    assert values(ratio, F.round(numbers.percent(F.col("a"), F.col("b")), 2)) == [cash("33.33"), None]
