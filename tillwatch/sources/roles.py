"""The test tables seen as the tables of a payments business.

Column renames and derived values only: no view filters, limits or samples its table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tillwatch.functions.numbers import MONEY

EVENTS_CLOCK = datetime(2024, 1, 29, 18, 30)
ORDERS_CLOCK = datetime(2001, 7, 15, 12, 0)

OPERATORS = ("GP", "BL", "ROBI", "AIRTEL", "TT")
AGENTS = {f"agent{n}": f"AGENT_{n}" for n in range(5)}


# Schemas by path, as a catalog would keep them: only the first read opens the files' footers.
_SCHEMAS: dict[str, StructType] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions: status and provider status from the event type, operator from the user."""
    kind, uid, eid = F.col("event_type"), F.col("user_id"), F.col("event_id")
    micros = F.round(F.col("value") * 10_000_000).cast("bigint")
    finished = F.when(eid % 11 != 0, F.timestamp_add("MICROSECOND", micros, F.col("ts")))
    return events(spark, sf_dir).select(
        eid.alias("id"),
        eid.cast("string").alias("request_id"),
        F.col("ts").alias("create_date"),
        finished.alias("update_date"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("update_text"),
        F.col("value").cast(MONEY).alias("amount"),
        F.when(kind == "purchase", "SUCCESS").when(kind == "signup", "REVERSED")
        .when(kind == "error", "FAILED").otherwise("PENDING").alias("status"),
        F.element_at(F.array(*[F.lit(o) for o in OPERATORS]), (uid % 5 + 1).cast("int")).alias(
            "mobile_operator"
        ),
        F.concat(F.lit("V"), (eid % 3).cast("string")).alias("vendor_name"),
        F.concat(kind, F.lit(" "), F.col("props")).alias("description"),
        F.when(kind == "purchase", "Success").when(kind == "error", "Failed")
        .when(kind == "signup", "Refunded").when(kind == "view", "Ready").alias("provider_status"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("provider_code"),
        F.concat(F.lit("T"), eid.cast("string")).alias("txn_number"),
        F.concat(F.lit("W"), uid.cast("string")).alias("wallet"),
        uid.alias("user_id"),
    )


def txn_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log: JSON, markup and free-text responses, one in seven requests unanswered."""
    kind, uid, eid = F.col("event_type"), F.col("user_id"), F.col("event_id")
    k = F.regexp_extract("props", "([0-9]+)", 1)
    paid = F.col("value").cast(MONEY).cast("string")
    lit = F.lit
    response = (
        F.when(
            kind == "purchase",
            F.concat(
                lit('{"status": "NPSB transfer credit", "amount": "'), paid,
                lit('", "actionCode": "'), F.lpad(k, 2, "0"), lit('", "new_balance": "'), paid,
                lit('", "note": "Your new balance is '), paid, lit(' TAKA", "props": '),
                F.col("props"), lit("}"),
            ),
        )
        .when(
            kind == "error",
            F.concat(
                lit('{"message": "first", "props": '), F.col("props"), lit(', "message": "Failed '),
                k, lit('"}'),
            ),
        )
        .when(kind == "click", F.concat(lit('{"error": "timeout '), k, lit('"}')))
        .when(
            kind == "signup",
            F.concat(
                lit('{"actionCode": "'), F.lpad(k, 2, "0"), lit('", "responseMessage": "back '), k,
                lit('"}'),
            ),
        )
        .otherwise(
            F.concat(
                lit("<ResponseCode>"), k, lit("</ResponseCode>\n<ResponseMessage>seen "), k,
                lit("</ResponseMessage> Your new balance is "), paid, lit(" TAKA."),
            )
        )
    )
    request = F.concat(
        F.when(uid % 13 == 0, "hex ").otherwise("post "),
        lit('{"receiver_wallet_no": "W'), uid.cast("string"), lit('"} requestDateTime='),
        F.date_format("ts", "yyyyMMddHHmmss"),
    )
    return events(spark, sf_dir).select(
        eid.alias("id"),
        eid.cast("string").alias("request_id"),
        F.col("ts").alias("create_date"),
        request.alias("request"),
        F.when(eid % 7 != 0, response).alias("response"),
        (eid - eid % 10).alias("np_txn_request_id"),
        F.when(eid % 7 != 0, response).alias("response_text"),
        F.col("event_type"),
    )


def orders_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("request_id"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderdate").alias("create_date"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.col("o_orderpriority").alias("priority"),
        (F.col("o_custkey") % 25).cast("string").alias("bank_swift_code"),
    )


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer")


def nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "nation")


def banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nation(spark, sf_dir).select(
        F.col("n_nationkey").cast("string").alias("swift_code"), F.col("n_name").alias("bank_name")
    )


def line_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as the answers logged for their order."""
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("request_id"),
        F.col("l_orderkey").alias("np_txn_request_id"),
        (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("request"),
        F.concat(
            F.lit('{"responseMessage": "'), F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus"),
            F.lit('", "quantity": '), F.col("l_quantity").cast("int").cast("string"), F.lit("}"),
        ).alias("response"),
    ).withColumn("response_text", F.col("response"))


def recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as reconciliation items; the decision comes from the line number."""
    line = F.col("l_linenumber")
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("create_date"),
        F.col("l_returnflag").alias("service_name"),
        F.col("l_linestatus").alias("txn_type"),
        F.when(line <= 2, "NO ACTION NEEDED").when(line <= 4, "REFUND").when(line <= 6, "CREDIT")
        .alias("proposed_decision"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
    )


def markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").alias("response"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat turns as text messages; the time is derived from the conversation and turn numbers."""
    conv, turn = F.col("conv_id"), F.col("turn")
    minutes = (conv * 37 + turn).cast("bigint")
    start = F.lit("2023-12-20 00:00:00").cast("timestamp_ntz")
    return _table(spark, sf_dir, "conversations").select(
        F.timestamp_add("MINUTE", minutes, start).alias("request_time"),
        F.col("role").alias("channel"),
        F.concat(F.lit("telco "), (conv % 3).cast("string")).alias("telecom_operator"),
        F.when(turn % 4 == 0, "0").when(turn % 4 == 1, "SUCCESS").when(turn % 4 == 2, "FAILED")
        .alias("message_status"),
        F.col("text").alias("message_body"),
    )


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("created_at"),
        F.when(kind == "error", "ERROR").otherwise("INFO").alias("level"),
        kind.alias("event_name"),
        F.concat(
            F.when(F.col("value") < 40, "request ").when(F.col("value") < 80, "response ")
            .otherwise("note "),
            F.regexp_extract("props", "([0-9]+)", 1),
        ).alias("message"),
        F.col("props").alias("details"),
        F.col("user_id"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("user_id"),
        F.col("ts").alias("created_at"),
        F.when(F.col("event_type") == "purchase", "VERIFIED").otherwise("OPEN").alias(
            "identity_status"
        ),
        (F.col("value") > 40).alias("is_pin_set"),
    )


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return events(spark, sf_dir).select(
        F.col("user_id"),
        F.col("ts").alias("create_date"),
        F.when(kind.isin("click", "view"), "CUSTOMER").otherwise("AGENT").alias("old_value"),
        F.when(F.col("value") < 30, "MERCHANT").when(F.col("value") < 60, "MICRO_MERCHANT")
        .otherwise("CUSTOMER").alias("new_value"),
        F.concat(F.lit("by "), kind).alias("updated_by"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return events(spark, sf_dir).select(
        F.col("ts").alias("created_at"),
        ((k % 4 + 1) * 100).cast(MONEY).alias("amount"),
        F.when(F.col("event_type") == "purchase", "PURCHASED").otherwise(F.upper("event_type")).alias(
            "status"
        ),
    )


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("subscription_type"),
        F.col("p_retailprice").cast(MONEY).alias("regular_price"),
        (F.col("p_retailprice").cast(MONEY) - F.col("p_size")).cast(MONEY).alias("offer_price"),
        (F.col("p_size") > 25).alias("is_active"),
        F.col("p_brand").alias("updated_at"),
    )


def journals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as journal entries: the user is the ticket, ten people write them."""
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("journalized_id"),
        (F.col("event_id") % 10).alias("user_id"),
        F.col("ts").alias("created_on"),
    )


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticket per user, dated by the user's last event."""
    uid = F.col("id")
    return (
        events(spark, sf_dir)
        .groupBy(F.col("user_id").alias("id"))
        .agg(F.max("ts").alias("start_date"), F.min("event_type").alias("kind"))
        .select(
            "id",
            "start_date",
            F.concat(F.lit("  issue  "), F.col("kind"), F.lit(" report")).alias("subject"),
            (uid % 13).alias("author_id"),
            (uid % 4).cast("int").alias("status_id"),
            F.when(uid % 5 == 0, uid).alias("category_id"),
        )
    )


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses by nation key, so that keys 0 to 4 belong to the five agents."""
    return nation(spark, sf_dir).select(
        F.col("n_nationkey").cast("bigint").alias("user_id"),
        F.concat(F.lit("agent"), F.col("n_nationkey").cast("string"), F.lit("@desk")).alias("address"),
    )


def ticket_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return nation(spark, sf_dir).select(
        key.alias("id"),
        F.when(key % 4 == 0, "Closed").when(key % 4 == 1, "Resolved").otherwise("Open").alias("name"),
    )


def time_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("issue_id"),
        (F.col("value") / 10).cast("decimal(18,4)").alias("hours"),
    )
