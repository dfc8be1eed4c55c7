"""SQL twins of the checked queries, written for DuckDB over the plain test tables.

They state each report directly, with joins, windows and ``DISTINCT`` over single rows, so that the
rearranged Spark plans are compared with something built another way.
"""

from __future__ import annotations

NOW = "TIMESTAMP '2024-01-29 18:30:00'"
DAY = "DATE '2024-01-29'"
LATER_DAY = "DATE '2001-07-15'"

TXN = """txn AS (
  SELECT event_id AS id, CAST(event_id AS VARCHAR) AS request_id, ts AS create_date,
    CASE WHEN event_id % 11 <> 0
      THEN ts + to_microseconds(CAST(round(value * 10000000) AS BIGINT)) END AS update_date,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS update_text,
    CAST(value AS DECIMAL(18,2)) AS amount,
    CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'signup' THEN 'REVERSED'
      WHEN 'error' THEN 'FAILED' ELSE 'PENDING' END AS status,
    CASE user_id % 5 WHEN 0 THEN 'GP' WHEN 1 THEN 'BL' WHEN 2 THEN 'ROBI' WHEN 3 THEN 'AIRTEL'
      ELSE 'TT' END AS mobile_operator,
    'V' || (event_id % 3) AS vendor_name,
    event_type || ' ' || props AS description,
    CASE event_type WHEN 'purchase' THEN 'Success' WHEN 'error' THEN 'Failed'
      WHEN 'signup' THEN 'Refunded' WHEN 'view' THEN 'Ready' END AS provider_status,
    regexp_extract(props, '([0-9]+)', 1) AS provider_code,
    'T' || event_id AS txn_number, 'W' || user_id AS wallet, user_id
  FROM events)"""

LOG = """log0 AS (
  SELECT *, regexp_extract(props, '([0-9]+)', 1) AS k,
    CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS paid FROM events),
log AS (
  SELECT event_id AS id, CAST(event_id AS VARCHAR) AS request_id, ts AS create_date,
    (CASE WHEN user_id % 13 = 0 THEN 'hex ' ELSE 'post ' END) || '{"receiver_wallet_no": "W'
      || user_id || '"} requestDateTime=' || strftime(ts, '%Y%m%d%H%M%S') AS request,
    CASE WHEN event_id % 7 <> 0 THEN CASE event_type
      WHEN 'purchase' THEN '{"status": "NPSB transfer credit", "amount": "' || paid
        || '", "actionCode": "' || lpad(k, 2, '0') || '", "new_balance": "' || paid
        || '", "note": "Your new balance is ' || paid || ' TAKA", "props": ' || props || '}'
      WHEN 'error' THEN '{"message": "first", "props": ' || props || ', "message": "Failed ' || k
        || '"}'
      WHEN 'click' THEN '{"error": "timeout ' || k || '"}'
      WHEN 'signup' THEN '{"actionCode": "' || lpad(k, 2, '0') || '", "responseMessage": "back '
        || k || '"}'
      ELSE '<ResponseCode>' || k || '</ResponseCode>' || chr(10) || '<ResponseMessage>seen ' || k
        || '</ResponseMessage> Your new balance is ' || paid || ' TAKA.' END END AS response,
    event_id - event_id % 10 AS np_txn_request_id, event_type
  FROM log0)"""

ORDERS = """fact AS (
  SELECT o_orderkey AS id, o_orderkey AS request_id, o_custkey AS custkey, o_orderdate AS create_date,
    o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
    o_orderpriority AS priority, CAST(o_custkey % 25 AS VARCHAR) AS bank_swift_code FROM orders)"""

LINES = """lines AS (
  SELECT l_orderkey AS request_id, l_partkey * 10 + l_linenumber AS id,
    'supplier ' || l_suppkey AS request,
    '{"responseMessage": "' || l_returnflag || '-' || l_linestatus || '", "quantity": '
      || CAST(l_quantity AS INTEGER) || '}' AS response FROM lineitem)"""

APP = """app AS (
  SELECT event_id AS id, ts AS created_at, user_id,
    CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, event_type AS event_name,
    (CASE WHEN value < 40 THEN 'request ' WHEN value < 80 THEN 'response ' ELSE 'note ' END)
      || regexp_extract(props, '([0-9]+)', 1) AS message, props AS details
  FROM events)"""

PURCHASES = """purchases AS (
  SELECT ts AS created_at,
    CAST((CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 4 + 1) * 100 AS DECIMAL(18,2))
      AS amount,
    CASE WHEN event_type = 'purchase' THEN 'PURCHASED' ELSE upper(event_type) END AS status
  FROM events)"""

MESSAGES = """messages AS (
  SELECT TIMESTAMP '2023-12-20 00:00:00' + to_minutes(conv_id * 37 + turn) AS request_time,
    role AS channel, 'telco ' || (conv_id % 3) AS telecom_operator,
    CASE turn % 4 WHEN 0 THEN '0' WHEN 1 THEN 'SUCCESS' WHEN 2 THEN 'FAILED' END AS message_status,
    text AS message_body FROM conversations)"""

CASHBACK = f"""{TXN}, cashback AS (
  SELECT create_date,
    TRY_CAST(CASE WHEN mobile_operator = 'TT' THEN 'pending' ELSE update_text END AS TIMESTAMP) AS told,
    status AS txn_status, wallet, provider_code AS cashback_txn_id FROM txn)"""

TICKETS = """journals AS (
  SELECT event_id AS id, user_id AS journalized_id, event_id % 10 AS user_id, ts AS created_on
  FROM events),
issues AS (
  SELECT user_id AS id, max(ts) AS start_date,
    '  issue  ' || min(event_type) || ' report' AS subject, user_id % 13 AS author_id,
    user_id % 4 AS status_id, CASE WHEN user_id % 5 = 0 THEN user_id END AS category_id
  FROM events GROUP BY user_id),
emails AS (
  SELECT n_nationkey AS user_id, 'agent' || n_nationkey || '@desk' AS address FROM nation),
statuses AS (
  SELECT n_nationkey AS id,
    CASE n_nationkey % 4 WHEN 0 THEN 'Closed' WHEN 1 THEN 'Resolved' ELSE 'Open' END AS name
  FROM nation),
entries AS (
  SELECT event_id AS id, user_id AS issue_id, CAST(value / 10 AS DECIMAL(18,4)) AS hours FROM events),
agents AS (SELECT 'agent' || n AS key, 'AGENT_' || n AS agent FROM range(5) r(n)),
spine AS (
  SELECT CAST(d AS DATE) AS day, agent
  FROM generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-01-29', INTERVAL 1 DAY) s(d), agents)"""

RESOLVED = f"""{TICKETS},
work AS (
  SELECT j.id, j.journalized_id AS ticket, j.created_on AS at, i.subject, e.address
  FROM journals j JOIN issues i ON i.id = j.journalized_id JOIN emails e ON e.user_id = j.user_id
    JOIN statuses s ON s.id = i.status_id
  WHERE j.user_id IN (0, 1, 2, 3, 4) AND i.author_id NOT IN (0, 1, 2, 3, 4)
    AND CAST(j.created_on AS DATE) >= {DAY} - 30 AND s.name IN ('Closed', 'Resolved')
    AND i.category_id IS NULL),
rows_kept AS (
  SELECT a.* FROM work a WHERE NOT EXISTS (
    SELECT 1 FROM work b WHERE b.ticket = a.ticket AND b.id <> a.id AND b.at > a.at))"""

SPENT = f"""{TICKETS},
work AS (
  SELECT i.id AS ticket, i.start_date AS at, i.subject, m.address, e.hours,
    row_number() OVER (PARTITION BY i.id ORDER BY e.id, m.address) AS place
  FROM issues i JOIN emails m ON m.user_id = i.author_id JOIN statuses s ON s.id = i.status_id
    JOIN entries e ON e.issue_id = i.id
  WHERE i.author_id IN (0, 1, 2, 3, 4) AND CAST(i.start_date AS DATE) >= {DAY} - 30),
rows_kept AS (SELECT * FROM work WHERE place = 1)"""

PIVOT = f"""
, named AS (
  SELECT r.address, g.agent, r.subject
  FROM rows_kept r JOIN agents g ON contains(r.address, g.key) WHERE CAST(r.at AS DATE) = {DAY}),
titled AS (
  SELECT address, agent, (SELECT string_agg(upper(w[1]) || lower(substr(w, 2)), ' ')
    FROM (SELECT unnest(string_split_regex(trim(subject), '\\s+')) AS w)) AS subject FROM named),
totals AS (SELECT agent, count(*) AS total_resolved FROM titled GROUP BY agent)
SELECT address, total_resolved, subject, count(*) AS ticket_count
FROM titled JOIN totals USING (agent) GROUP BY ALL
UNION ALL SELECT 'Grand Total', NULL, '', count(*) FROM titled HAVING count(*) > 0"""

ASKED = "request_id IS NOT NULL AND request NOT ILIKE '%hex%'"

LAST_ERROR = """coalesce(
    nullif(regexp_extract(response, '(?s).*"message":\\s*"([^"]+)"', 1), ''),
    nullif(regexp_extract(response, '(?s).*"error":\\s*"([^"]+)"', 1), ''), {otherwise})"""

STATUS_OF = (
    "CASE WHEN response ILIKE '%{{%NPSB transfer credit%}}%' THEN 'SUCCESS' ELSE "
    + LAST_ERROR + " END"
)

DURATION = """CASE WHEN update_date - create_date <= INTERVAL 60 SECOND THEN '1 min or less'
    WHEN update_date - create_date <= INTERVAL 120 SECOND THEN '2 min or less'
    WHEN update_date - create_date <= INTERVAL 300 SECOND THEN '5 min or less'
    WHEN update_date - create_date <= INTERVAL 600 SECOND THEN '10 min or less'
    WHEN update_date - create_date <= INTERVAL 3600 SECOND THEN '1 hr or less'
    ELSE 'greater than 1 hour' END"""

# The rows of each time span.
ON_DAY = f"CAST(create_date AS DATE) = {DAY}"
SETTLED = f"create_date <= {NOW} - INTERVAL 5 MINUTE"
TODAY = f"{ON_DAY} AND {SETTLED}"
MONTH = f"CAST(create_date AS DATE) >= {NOW} - INTERVAL 30 DAY"
MONTH_SETTLED = f"{MONTH} AND {SETTLED}"
CALENDAR_MONTH = f"create_date >= {NOW} - INTERVAL 1 MONTH"


def hour(ts: str = "create_date") -> str:
    return f"strftime({ts}, '%H')"


def day(ts: str = "create_date") -> str:
    return f"strftime({ts}, '%Y-%m-%d')"


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def ratio(part: str, whole: str) -> str:
    """``part / whole`` to two decimals, half up, for whole numbers that are not negative."""
    return f"((200 * ({part}) + ({whole})) // nullif(2 * ({whole}), 0)) / 100.0"


def percent_text(part: str, whole: str) -> str:
    hundredths = f"CAST((20000 * ({part}) + ({whole})) // nullif(2 * ({whole}), 0) AS BIGINT)"
    return f"printf('%d.%02d%%', {hundredths} // 100, {hundredths} % 100)"


def threshold(cte, base_bad, today_bad, at, base_span, today_span, per_day=True, table="txn"):
    mean = ratio("sum(n)", "count(*)" if per_day else "29")
    return f"""WITH {cte}, daily AS (
  SELECT {hour(at)} AS hour, {day(at)} AS d, count(*) AS n FROM {table}
  WHERE {base_span} AND {base_bad} GROUP BY ALL)
SELECT hour, 'last 4week not success avg' AS txn, {dbl(mean)} AS txn_count FROM daily GROUP BY hour
UNION ALL
SELECT {hour(at)}, 'today not success', {dbl('count(*)')} FROM {table}
WHERE {today_span} AND {today_bad} GROUP BY 1"""


def health(group="", where="TRUE", at="create_date", success="status = 'SUCCESS'",
           dispute="status NOT IN ('SUCCESS', 'REVERSED', 'FAILED')", hits=None, attempts="TRUE",
           minutes=30, today_lag=3, low=30, high=70, members=None, money=False, label=None):
    """One row per service: a one-day spine joined to today's rows, and the recent rate beside it."""
    hits = hits or success
    spine = f"SELECT {DAY} AS d" if members is None else (
        f"SELECT {DAY} AS d, unnest({list(members)}) AS g")
    key = "1" if members is None else group
    same = "TRUE" if members is None else "s.g = t.g"
    same_rate = "TRUE" if members is None else "s.g = r.g"
    amount = "coalesce(trunc(t.amount), 0)"
    shown = f"format('{{:,}}', CAST({amount} AS BIGINT))" if money else f"CAST({amount} AS BIGINT)"
    name = f"{label}, " if label else ("s.g AS " + group + ", " if members is not None else "")
    pct = "100.0 * r.hits / nullif(r.tries, 0)"
    return f"""SELECT {name}strftime(s.d, '%Y-%m-%d') AS date,
  coalesce(strftime(t.last_success, '%H:%M'), '00:00') AS last_success_time,
  coalesce(t.success, 0) AS success, coalesce(t.reverse, 0) AS reverse,
  coalesce(t.failed, 0) AS failed, coalesce(t.dispute, 0) AS dispute, {shown} AS success_amount,
  CASE WHEN coalesce({pct}, 0) = 0 THEN 'DOWN' WHEN {pct} < {low} THEN 'NOT OK'
    WHEN {pct} <= {high} THEN 'ACCEPTABLE' ELSE 'OK' END AS health,
  coalesce({percent_text('r.hits', 'r.tries')}, '0%') AS success_rate
FROM ({spine}) s LEFT JOIN (
  SELECT {key} AS g, max({at}) FILTER ({success}) AS last_success, count(*) FILTER ({success}) AS success,
    count(*) FILTER (status = 'REVERSED') AS reverse, count(*) FILTER (status = 'FAILED') AS failed,
    count(*) FILTER ({dispute}) AS dispute, sum(amount) FILTER ({success}) AS amount
  FROM txn WHERE CAST({at} AS DATE) = {DAY} AND {at} <= {NOW} - INTERVAL {today_lag} MINUTE
    AND {where} GROUP BY 1) t ON {same}
LEFT JOIN (
  SELECT {key} AS g, count(*) FILTER ({hits}) AS hits, count(*) FILTER ({attempts}) AS tries FROM txn
  WHERE {at} >= {NOW} - INTERVAL {minutes} MINUTE AND {at} <= {NOW} - INTERVAL 3 MINUTE
    AND {where} GROUP BY 1) r ON {same_rate}"""


def log_health(money=False, label=""):
    amount = "CAST(round(sum(CASE WHEN status = 'SUCCESS' THEN amount ELSE 0 END)) AS BIGINT)"
    shown = f"format('{{:,}}', {amount})" if money else amount
    rate = percent_text("count(*) FILTER (status = 'SUCCESS')", "count(*)")
    return f"""SELECT {label}strftime(create_date, '%Y-%m-%d') AS date,
  coalesce(strftime(max(create_date) FILTER (status = 'SUCCESS'), '%H:%M'), '00:00')
    AS last_success_time,
  count(*) FILTER (status = 'SUCCESS') AS success, count(*) FILTER (status = 'REVERSED') AS reverse,
  count(*) FILTER (status NOT IN ('SUCCESS', 'REVERSED')) AS failed, CAST(0 AS BIGINT) AS dispute,
  {shown} AS success_amount,
  CASE WHEN any_value(recent.n) < 5 THEN 'NOT OK' WHEN any_value(recent.n) <= 20 THEN 'ACCEPTABLE'
    ELSE 'OK' END AS health,
  regexp_replace({rate}, '^0\\.', '.') AS success_rate
FROM (SELECT create_date, {STATUS_OF.format(otherwise="'FAILED'")} AS status,
    CASE WHEN starts_with(response, '{{') THEN
      TRY_CAST(json_extract_string(response, '$.amount') AS DECIMAL(18,2)) END AS amount
  FROM log WHERE {ON_DAY} AND {ASKED}) q,
  (SELECT count(*) FILTER ({STATUS_OF.format(otherwise="'FAILED'")} = 'SUCCESS') AS n FROM log
   WHERE create_date >= {NOW} - INTERVAL 30 MINUTE AND create_date <= {NOW} - INTERVAL 3 MINUTE)
  recent
GROUP BY strftime(create_date, '%Y-%m-%d')"""


def cohort(cte, table, bucket, dims, where, measures):
    shown = ", ".join(dims)
    return f"WITH {cte} SELECT {bucket}, {shown}, {measures} FROM {table} WHERE {where} GROUP BY ALL"


COUNT_AND_TOTAL = f"count(*) AS txn_count, {dbl('sum(amount)')} AS total_amount"
WALLET = """CASE provider_status WHEN 'Ready' THEN 'READY' WHEN 'Success' THEN 'SUCCESS'
    WHEN 'Failed' THEN 'FAILED' WHEN 'Refunded' THEN 'REFUNDED' ELSE {otherwise} END"""
DETAIL = f"""SELECT id, {hour()} AS hour, strftime(create_date, '%Y-%m-%d %H:%M:%S.%f') AS create_date, {dbl('amount')} AS amount, provider_status, provider_code,
  {WALLET.format(otherwise='status')} AS status, txn_number, wallet FROM txn"""

OPERATORS = ("GP", "BL", "ROBI", "AIRTEL", "TT")
SHIFTED = "create_date + INTERVAL 6 HOUR"

FOLDED = """CASE WHEN status NOT IN ('SUCCESS', 'FAILED', 'REFUNDED') THEN 'DISPUTE' ELSE status END
    AS folded"""


def folded(bucket, name, where):
    return f"""WITH {TXN}, f AS (SELECT *, {FOLDED} FROM txn)
SELECT {bucket} AS {name}, folded AS status, coalesce(provider_status, 'NULL') AS result,
  count(status) AS txn_count, {dbl('sum(amount)')} AS total_amount
FROM f WHERE {where} GROUP BY {bucket}, folded, coalesce(provider_status, 'NULL')"""


def top_reasons(bucket, name, where, extra=""):
    return f"""WITH {TXN}, ranked AS (
  SELECT {bucket} AS {name}, description, count(*) AS txn_count,
    row_number() OVER (PARTITION BY {bucket} ORDER BY count(*) DESC, description) AS place,
    sum(count(*)) OVER (PARTITION BY {bucket}) AS bucket_count
  FROM txn WHERE {where} AND status <> 'SUCCESS' GROUP BY 1, 2)
SELECT {name}, description, txn_count{extra} FROM ranked WHERE place <= 5"""


def described_reasons(bucket, name, where, monthly):
    """The reason of each kind of text by the number that chose it, without looking at the text."""
    queued = ("'Your request to recharge 0' || (id % 2) || ' is already in queue. Please wait for sometime.'" if monthly
              else "'Your request to recharge {rcvr_num} is already in queue. Please wait for sometime.'")
    tight = ("'Your current request to transfer 5TAKA cannot be processed as you do not have enough credit.'" if monthly
             else "'Your current request to transfer {amount} TAKA cannot be processed as you do not have enough credit'")
    return f"""WITH {TXN}, reasons AS (
  SELECT *, CASE id % 8 WHEN 0 THEN 'Invalid Transfer Value' WHEN 1 THEN 'duplicate 2 minutes' WHEN 2 THEN 'duplicate 3 minutes'
    WHEN 3 THEN 'Your current request to transfer {{amount}} TAKA cannot be processed as you do not have enough credit'
    WHEN 4 THEN {tight} WHEN 5 THEN {queued} WHEN 6 THEN 'Invalid transfer value' ELSE 'NULL' END AS reason FROM txn),
ranked AS (
  SELECT {bucket} AS {name}, reason AS description, count(*) AS txn_count,
    row_number() OVER (PARTITION BY {bucket} ORDER BY count(*) DESC, reason) AS place
  FROM reasons WHERE {where} AND status <> 'SUCCESS' GROUP BY 1, 2)
SELECT {name}, description, txn_count FROM ranked WHERE place <= 8"""


def totalled(counts):
    """Services, families and all of (family, service, n, g)."""
    return f"""{counts}, sums AS (
  SELECT 'service' AS level, family, service, n, g FROM counts
  UNION ALL SELECT 'family', family, NULL, sum(n), sum(g) FROM counts GROUP BY family
  UNION ALL SELECT 'total', NULL, NULL, sum(n), sum(g) FROM counts)
SELECT level, family, service, CAST(n AS BIGINT) AS total_attempt, CAST(g AS BIGINT) AS satisfactory,
  {dbl(ratio('100 * CAST(g AS BIGINT)', 'CAST(n AS BIGINT)'))} AS satisfaction_level FROM sums"""


def bank_response(source, bucket, where, by_bank=False):
    bank = "JOIN nation b ON CAST(b.n_nationkey AS VARCHAR) = f.bank_swift_code" if by_bank else ""
    name = "b.n_name AS bank_name, " if by_bank else ""
    cte, fact, log, key, text = source
    return f"""WITH {cte}
SELECT {bucket} AS day, f.status,
  coalesce(nullif(regexp_extract(l.{text}, '(?s).*"responseMessage":\\s*"([^"]+)"', 1), ''),
    'No data in bank_txn_log') AS response_message, {name}count(f.id) AS request_count,
  {dbl('sum(f.amount)')} AS total_amount
FROM {fact} f {bank} LEFT JOIN {log} l ON l.{key} = f.id WHERE {where} GROUP BY ALL"""


def growth(over):
    cents = "CAST((total - before) * 1000000 AS HUGEINT)"
    base = "CAST(before * 100 AS HUGEINT)"
    half_up = f"sign({cents}) * ((2 * abs({cents}) + {base}) // (2 * {base}))"
    return f"""WITH {TXN}, daily AS (
  SELECT {day()} AS day, status, count(status) AS txn_count, sum(amount) AS total,
    lag(sum(amount)) OVER ({over}) AS before
  FROM txn WHERE {MONTH} AND CAST(create_date AS DATE) < {DAY} GROUP BY 1, 2)
SELECT day, status, txn_count, {dbl('total')} AS total_amount,
  CASE WHEN coalesce(before, 0) = 0 THEN 0.0::DOUBLE
    ELSE {dbl(half_up)} / 100 END AS total_amount_growth FROM daily"""


CODE = r"(?s)<ResponseCode>(.*?)</ResponseCode>.*?<ResponseMessage>(.*?)</ResponseMessage>"


def xml_codes(bucket, name, where):
    return f"""WITH {TXN}, {LOG}
SELECT {bucket} AS {name},
  CASE WHEN regexp_matches(l.response, '{CODE}') THEN regexp_extract(l.response, '{CODE}', 1)
    || ' -> ' || regexp_extract(l.response, '{CODE}', 2) END AS code_message,
  count(DISTINCT t.request_id) AS request_count
FROM txn t JOIN log l ON l.request_id = t.request_id WHERE {where} GROUP BY 1, 2"""


def of(alias, condition):
    return condition.replace("create_date", f"{alias}.create_date")


CODES = {
    "04": "04-Pick-up",
    "05": "05-Do not honor",
    "12": "12-Invalid transaction",
    "14": "14-Invalid card number (no such number)",
    "15": "15-No such issuer",
    "54": "54-Expired card",
    "57": "57-Transaction not permitted to cardholder",
    "59": "59-Suspected fraud",
    "61": "61-Exceeds approval amount limit",
    "62": "62-This VISA card is restricted for transactions. Please communicate with the issuer bank",
    "75": "75-Allowable number of PIN entry tries exceeded",
    "91": "91-Receiver account is not valid. Please recheck the VISA card details",
    "93": "93-Transaction cannot be completed – violation of law",
    "96": "96-System malfunction",
}
MEANING = "CASE code " + " ".join(f"WHEN '{c}' THEN '{m}'" for c, m in CODES.items()) + " ELSE 'Other' END"


def reverse_reasons(bucket, name, where):
    return f"""WITH {TXN}, {LOG}, joined AS (
  SELECT t.id, {bucket} AS {name}, t.mobile_operator, t.status,
    CASE WHEN starts_with(l.response, '{{') THEN json_extract_string(l.response, '$.actionCode') END
      AS code
  FROM txn t JOIN log l ON l.request_id = t.request_id
  WHERE t.status = 'REVERSED' AND l.request ILIKE '%receiver_wallet%' AND {where}),
meant AS (SELECT *, {MEANING} AS meaning FROM joined)
SELECT id, {name}, status, code AS action_code,
  mobile_operator || ' (' || count(*) OVER (PARTITION BY mobile_operator) || ')'
    AS mobile_operator_with_count,
  meaning || ' (' || count(*) OVER (PARTITION BY meaning) || ')' AS meaning_with_count
FROM meant"""


def latest_success(vendor, where="TRUE"):
    return f"""(SELECT request_id FROM txn WHERE vendor_name = '{vendor}' AND status = 'SUCCESS' AND {where}
    ORDER BY id DESC LIMIT 1)"""


def guarded_balance(where="TRUE"):
    return f"""WITH {TXN}, {LOG}
SELECT request, response, coalesce(CASE WHEN regexp_matches(response, '(?s)^\\{{.*\\}}$') THEN
  {WHOLE.format("CAST(json_extract_string(response, '$.new_balance') AS DECIMAL(38,2))")} END,
  'Invalid or non-JSON response') AS balance
FROM log WHERE request_id = {latest_success('V0', where)} AND request ILIKE '%receiver%'"""


def by_span(cte, source, dim, counted):
    """The same distinct count for today by hour, for the month by day and as a whole."""
    parts = [("today", TODAY, hour()), ("month", MONTH_SETTLED, day()), ("all", MONTH_SETTLED, "CAST(NULL AS VARCHAR)")]
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS span, {bucket} AS bucket, {dim}, {counted} FROM source WHERE {where} GROUP BY ALL"
        for name, where, bucket in parts)
    return f"WITH {cte}, source AS ({source}) {rows}"


BALANCE = "nullif(regexp_extract({0}.response, '(?s)Your new balance is (.*?) TAKA', 1), '')"
WHOLE = "format('{{:,}}', CAST(round({0}) AS BIGINT))"


def service_total(name, where):
    return f"""SELECT '{name}' AS service, count(*) AS txn_count, {dbl('sum(amount)')} AS total_amount
FROM txn WHERE {where}"""


YESTERDAY = f"BETWEEN {DAY} - INTERVAL 1 DAY AND {DAY} - INTERVAL 1 SECOND"
GOOD = "status = 'SUCCESS' AND "

WEEK = ("CAST({0} AS DATE) >= DATE '2024-01-21' AND CAST({0} AS DATE) < DATE '2024-01-28'")


def satisfaction(family, service, table, attempt, good, where):
    return f"""SELECT '{family}' AS family, {service} AS service, count(*) FILTER ({attempt}) AS n,
  count(*) FILTER ({good}) AS g FROM {table} WHERE {where} GROUP BY ALL"""


def quick(seconds):
    return f"update_date - create_date <= INTERVAL {seconds} SECOND"


ATTEMPTS = " OR ".join(
    f"response ILIKE '{p}'"
    for p in ("%{%NPSB transfer credit%}%", "%User profile not found%",
              "%Failed due to Amount falls within fail rate%", "%timeout%", "%Something went wrong%")
)

RECON = """recon AS (
  SELECT CAST(l_shipdate AS DATE) AS d, l_returnflag AS service, l_linestatus AS kind,
    CASE WHEN l_linenumber <= 2 THEN 'NO ACTION NEEDED' WHEN l_linenumber <= 4 THEN 'REFUND'
      WHEN l_linenumber <= 6 THEN 'CREDIT' END AS decision,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem)"""


def recon_part(report, service="NULL", kind="NULL", decision="NULL", where="TRUE"):
    return f"""SELECT '{report}' AS report, strftime(d, '%Y-%m-%d') AS day,
  CAST({service} AS VARCHAR) AS service, CAST({kind} AS VARCHAR) AS txn_type,
  CAST({decision} AS VARCHAR) AS decision, {COUNT_AND_TOTAL} FROM recon WHERE {where}
GROUP BY 1, 2, 3, 4, 5"""


OPEN = "decision <> 'NO ACTION NEEDED'"
DIRECTION = "CASE WHEN service IN ('A', 'R') THEN service || '-' || kind ELSE service END"


def funnel(bucket, name, where):
    return f"""SELECT {bucket} AS {name},
  CASE WHEN event_type = 'purchase' AND value > 40 THEN 'SUCCESSFULLY COMPLETED REGISTRATION'
    ELSE 'ATTEMPTED' END AS status, count(*) AS registrations
FROM events WHERE {where} GROUP BY ALL"""


def transitions(bucket, name, where):
    return f"""SELECT DISTINCT user_id, {bucket} AS {name},
  CASE WHEN value < 30 THEN 'MERCHANT' ELSE 'MICRO_MERCHANT' END AS new_user_type,
  'CUSTOMER' AS old_user_type, 'by ' || event_type AS updated_by
FROM events WHERE event_type IN ('click', 'view') AND value < 60 AND {where}"""


def sales(buckets, where, label=True, counted="status"):
    text = ", status || '(' || amount || 'tk package)' AS status_with_package" if label else ""
    total = f"amount * count({counted})"
    shown = ", ".join(f"{expression} AS {name}" for name, expression in buckets.items())
    return f"""WITH {PURCHASES} SELECT {shown}, {dbl('amount')} AS amount, status,
  count({counted}) AS txn_count, {dbl(total)} AS total_amount{text}
FROM purchases WHERE {where} GROUP BY {', '.join(buckets.values())}, purchases.amount, status"""


SEGMENTS = """CASE WHEN channel IN ({u}) THEN CASE WHEN length(message_body) > 268 THEN 5
      WHEN length(message_body) > 201 THEN 4 WHEN length(message_body) > 134 THEN 3
      WHEN length(message_body) > 70 THEN 2 ELSE 1 END
    ELSE CASE WHEN length(message_body) > 765 THEN 6 WHEN length(message_body) > 612 THEN 5
      WHEN length(message_body) > 459 THEN 4 WHEN length(message_body) > 306 THEN 3
      WHEN length(message_body) > 160 THEN 2 ELSE 1 END END"""


def bill(unicode_channels, where, formatted=False):
    count, cost = "CAST(sum(n) AS BIGINT)", "CAST(sum(n) AS BIGINT) * CAST(0.28 AS DECIMAL(10,2))"
    if formatted:
        count, cost = f"format('{{:,.2f}}', {dbl(count)})", f"format('{{:,.2f}}', {dbl(cost)})"
    else:
        cost = dbl(cost)
    return f"""WITH {MESSAGES}, billed AS (
  SELECT channel, sum({SEGMENTS.format(u=unicode_channels)}) AS n FROM messages
  WHERE channel IN ('user', 'assistant', 'system') AND {where} GROUP BY channel)
SELECT channel, {count} AS sms_count, {cost} AS bill FROM billed GROUP BY channel
UNION ALL SELECT 'Total', {count}, {cost} FROM billed"""


ORACLE = {
    "r01_threshold_vs_today": threshold(
        TXN, "status <> 'SUCCESS'", "status NOT IN ('SUCCESS', 'PENDING')", "create_date",
        f"create_date >= {NOW} - INTERVAL 28 DAY AND {SETTLED}", TODAY),
    "r01_threshold_shifted": threshold(
        TXN, "status <> 'SUCCESS'", "status <> 'SUCCESS'", SHIFTED,
        f"{SHIFTED} >= {NOW} - INTERVAL 28 DAY AND {SHIFTED} <= {NOW} - INTERVAL 5 MINUTE",
        f"CAST({SHIFTED} AS DATE) = {DAY} AND {SHIFTED} <= {NOW} - INTERVAL 5 MINUTE"),
    "r01_threshold_lagged": threshold(
        TXN, "status = 'FAILED'", "status = 'FAILED'", SHIFTED,
        f"{SHIFTED} >= {NOW} - INTERVAL 28 DAY AND CAST({SHIFTED} AS DATE) <= {DAY} - 3",
        f"CAST({SHIFTED} AS DATE) = {DAY} - 3"),
    "r01_threshold_log": threshold(
        LOG, f"{ASKED} AND response NOT ILIKE '%{{%NPSB transfer credit%}}%'",
        f"{ASKED} AND response NOT ILIKE '%{{%NPSB transfer credit%}}%'", "create_date",
        f"create_date >= {NOW} - INTERVAL 28 DAY AND {SETTLED}", TODAY, table="log"),
    "r01_threshold_zero_fill": threshold(
        TXN, "status = 'FAILED'", "status = 'FAILED'", "create_date",
        f"create_date >= {NOW} - INTERVAL 28 DAY AND {SETTLED}", TODAY, per_day=False),
    "r02_service_health": f"WITH {TXN} {health()}",
    "r02_health_by_operator":
        f"WITH {TXN} {health('mobile_operator', members=(*OPERATORS, 'SILENT'))}",
    "r02_health_own_rate": f"WITH {TXN} " + health(
        at=SHIFTED, success="status IN ('SUCCESS', 'PENDING')", dispute="status <> 'SUCCESS'",
        hits="status = 'SUCCESS' AND amount >= 10", attempts="amount >= 10", minutes=600,
        today_lag=0, low=20),
    "r03_log_service_health": f"WITH {LOG} {log_health()}",
    "r04_health_board": f"WITH {TXN}, {LOG} "
        + health("mobile_operator", members=OPERATORS, money=True,
                 label="'RECHARGE (' || s.g || ')' AS service")
        + " UNION ALL "
        + health(where="vendor_name = 'V1'", minutes=60, low=50, money=True,
                 label="'VISA CARD' AS service")
        + " UNION ALL " + log_health(money=True, label="'SQR PAYMENT' AS service, "),
    "r05_status_cohort_hour": cohort(
        TXN, "txn", f"{hour()} AS hour", ["status", "mobile_operator"], TODAY, COUNT_AND_TOTAL),
    "r05_status_cohort_day": cohort(
        TXN, "txn", f"{day()} AS day", ["status"], MONTH_SETTLED, COUNT_AND_TOTAL),
    "r05_status_cohort_label": cohort(
        TXN, "txn", f"{day()} AS day",
        ["concat(status, '  (', mobile_operator, ')') AS status_operator"], CALENDAR_MONTH,
        COUNT_AND_TOTAL),
    "r05_status_cohort_day_hour": cohort(
        TXN, "txn", f"{day(SHIFTED)} AS day, {hour(SHIFTED)} AS hour", ["status"],
        f"CAST({SHIFTED} AS DATE) = {DAY} - 3", COUNT_AND_TOTAL),
    "r05_cohorts_from_summary": f"WITH {TXN} " + " UNION ALL ".join(
        f"""SELECT '{report}' AS report, {bucket} AS bucket, status, {COUNT_AND_TOTAL}
FROM txn WHERE {where} GROUP BY {bucket}, status"""
        for report, bucket, where in (
            ("today", hour(), TODAY),
            ("month", day(), f"{CALENDAR_MONTH} AND mobile_operator = 'GP'"),
            ("ever", day(), "TRUE"),
        )),
    "r05_status_cohort_history": cohort(
        ORDERS, "fact", f"{day()} AS day", ["status"], "TRUE", COUNT_AND_TOTAL),
    "r06_not_success_breakdown": cohort(
        TXN, "txn", f"{day()} AS day", ["status", "mobile_operator", "description"],
        f"{CALENDAR_MONTH} AND status NOT IN ('SUCCESS')", "count(*) AS txn_count"),
    "r06_not_success_amount": cohort(
        TXN, "txn", f"{hour()} AS hour", ["status", "mobile_operator"],
        f"{TODAY} AND status NOT IN ('SUCCESS')", f"{dbl('sum(amount)')} AS total_amount"),
    "r07_folded_status_cohort": folded(hour(), "hour", TODAY),
    "r07_folded_status_month": folded(
        day(), "day", f"{MONTH} AND create_date <= {NOW} - INTERVAL 20 MINUTE "
        "AND status NOT IN ('REVERSED')"),
    "r08_dimension_cohort": f"""WITH {ORDERS}
SELECT {day()} AS day, c_mktsegment, status, count(status) AS txn_count,
  {dbl('sum(amount)')} AS total_amount
FROM fact JOIN customer ON c_custkey = custkey GROUP BY ALL""",
    "r09_duration_cohort": cohort(
        TXN, "txn", f"{day()} AS day", [f"{DURATION} AS duration"], MONTH_SETTLED,
        "count(*) AS txn_count"),
    "r09_duration_by_vendor": cohort(
        TXN, "txn", f"{hour()} AS hour",
        [f"{DURATION} AS duration", f"concat(vendor_name, ' - (', {DURATION}, ')') AS vendor_name_duration"],
        TODAY, "count(*) AS txn_count"),
    "r10_top_reasons": top_reasons(hour(), "hour", TODAY),
    "r10_top_reasons_month": top_reasons(
        day(), "day", MONTH_SETTLED,
        f", {dbl(ratio('100 * txn_count', 'CAST(bucket_count AS BIGINT)'))} AS percentage"),
    "r10_reason_templates": described_reasons(hour(), "hour", TODAY, False),
    "r10_reason_templates_month": described_reasons(day(), "day", MONTH_SETTLED, True),
    "r11_latest_by_key_pivot": f"""WITH {TXN}, latest AS (
  SELECT mobile_operator AS o, vendor_name AS v,
    row_number() OVER (PARTITION BY mobile_operator ORDER BY id DESC) AS place FROM txn)
SELECT max(v) FILTER (o = 'AIRTEL') AS airtel, max(v) FILTER (o = 'GP') AS grameenphone,
  max(v) FILTER (o = 'BL') AS banglalink, max(v) FILTER (o = 'TT') AS teletalk,
  max(v) FILTER (o = 'ROBI') AS robi FROM latest WHERE place = 1""",
    "r12_newest_stamp": "SELECT strftime(max(ts), '%Y-%m-%d %H:%M') AS date_time FROM events",
    "r13_bank_response_cohort": bank_response(
        (f"{ORDERS}, {LINES}", "fact", "lines", "request_id", "response"),
        day("f.create_date"), "TRUE"),
    "r13_bank_response_by_bank": bank_response(
        (f"{ORDERS}, {LINES}", "fact", "lines", "request_id", "response"),
        day("f.create_date + INTERVAL 6 HOUR"),
        f"CAST(f.create_date + INTERVAL 6 HOUR AS DATE) <= {LATER_DAY} - 3 "
        "AND f.bank_swift_code <> '7'", by_bank=True),
    "r13_bank_response_label": bank_response(
        (f"{TXN}, {LOG}", "txn", "log", "np_txn_request_id", "response"), day("f.create_date"),
        f"CAST(f.create_date + INTERVAL 6 HOUR AS DATE) >= {DAY} - 30"),
    "r13_bank_response_recent": bank_response(
        (f"{TXN}, {LOG}, late AS (SELECT * FROM log WHERE CAST(create_date AS DATE) >= {DAY} - 11)",
         "txn", "late", "np_txn_request_id", "response"), day("f.create_date"),
        f"CAST(f.create_date AS DATE) >= {DAY} - 10"),
    "r14_log_status_cohort": cohort(
        LOG, "log", f"{hour()} AS hour", [f"{STATUS_OF.format(otherwise='response')} AS status"],
        f"{TODAY} AND {ASKED}", "count(request_id) AS request_count"),
    "r14_log_status_month": cohort(
        LOG, "log", f"{day()} AS day", [f"{STATUS_OF.format(otherwise='response')} AS status"],
        f"{MONTH_SETTLED} AND {ASKED}", "count(request_id) AS request_count"),
    "r15_error_unique_users": cohort(
        LOG, "log", f"{hour()} AS hour", [f"{LAST_ERROR.format(otherwise='response')} AS status"],
        f"{TODAY} AND {ASKED} AND response NOT ILIKE '%{{%NPSB transfer credit%}}%'",
        """count(DISTINCT nullif(regexp_extract(request,
          '(?s).*"receiver_wallet_no":\\s*"([^"]+)"', 1), '')) AS user_count"""),
    "r15_error_unique_users_month": cohort(
        LOG, "log", f"{day()} AS day", [f"{LAST_ERROR.format(otherwise='response')} AS status"],
        f"{MONTH_SETTLED} AND {ASKED} AND response NOT ILIKE '%{{%NPSB transfer credit%}}%'",
        """count(DISTINCT nullif(regexp_extract(request,
          '(?s).*"receiver_wallet_no":\\s*"([^"]+)"', 1), '')) AS user_count"""),
    "r15_error_users_by_span": by_span(
        LOG, f"""SELECT create_date, {LAST_ERROR.format(otherwise='response')} AS status,
          nullif(regexp_extract(request, '(?s).*"receiver_wallet_no":\\s*"([^"]+)"', 1), '') AS wallet FROM log
          WHERE {ASKED} AND response NOT ILIKE '%{{%NPSB transfer credit%}}%'""",
        "status", "count(DISTINCT wallet) AS user_count"),
    "r17_xml_codes_by_span": by_span(
        f"{TXN}, {LOG}", f"""SELECT t.create_date, t.request_id,
          CASE WHEN regexp_matches(l.response, '{CODE}') THEN regexp_extract(l.response, '{CODE}', 1)
            || ' -> ' || regexp_extract(l.response, '{CODE}', 2) END AS code_message
          FROM txn t JOIN log l ON l.request_id = t.request_id WHERE l.request ILIKE '%requestDateTime%'""",
        "code_message", "count(DISTINCT request_id) AS request_count"),
    "r16_daily_growth": growth(f"ORDER BY {day()}, status"),
    "r16_daily_growth_per_status": growth(f"PARTITION BY status ORDER BY {day()}"),
    "r17_xml_code_cohort": xml_codes(
        day("t.create_date"), "day",
        of("t", MONTH_SETTLED) + " AND l.request ILIKE '%requestDateTime%'"),
    "r17_xml_code_today": xml_codes(
        hour("t.create_date"), "hour", of("t", ON_DAY) + " AND t.vendor_name = 'V1'"),
    "r18_raw_response_cohort": f"""WITH {TXN}, {LOG}
SELECT {day('t.create_date')} AS day, l.response, count(DISTINCT t.request_id) AS request_count
FROM txn t JOIN log l ON l.request_id = t.request_id
WHERE {of('t', MONTH)} AND t.status <> 'SUCCESS' AND t.mobile_operator = 'GP'
  AND l.request ILIKE '%requestdatetime%' AND l.response NOT ILIKE '%"sensitiveData"%'
GROUP BY ALL""",
    "r18_raw_response_lines": f"""WITH {ORDERS}, {LINES}
SELECT {day('t.create_date')} AS day, l.response, count(DISTINCT t.request_id) AS request_count
FROM fact t JOIN lines l ON l.request_id = t.request_id
WHERE t.status <> 'SUCCESS' AND l.response NOT ILIKE '%"sensitiveData"%' GROUP BY ALL""",
    "r18_raw_response_dictionary": f"""WITH {TXN}, {LOG}
SELECT {hour('t.create_date')} AS hour, l.response, count(DISTINCT t.request_id) AS request_count
FROM txn t JOIN log l ON l.request_id = t.request_id
WHERE {of('t', MONTH)} AND t.status <> 'SUCCESS'
  AND l.request ILIKE '%requestdatetime%' AND l.response NOT ILIKE '%"sensitiveData"%'
GROUP BY ALL""",
    "r19_cohort_with_entity_total": f"""WITH {ORDERS},
totals AS (SELECT priority, sum(amount) AS total FROM fact GROUP BY priority)
SELECT {day()} AS day, f.priority || ' (Total: ' || total || ')' AS priority, status,
  count(status) AS txn_count, {dbl('sum(amount)')} AS total_amount
FROM fact f JOIN totals t ON t.priority = f.priority
GROUP BY {day()}, f.priority, total, status""",
    "r19_entity_total_polled": f"""WITH {TXN}, f AS (SELECT * FROM txn WHERE {MONTH}),
totals AS (SELECT vendor_name, sum(amount) AS total FROM f GROUP BY vendor_name)
SELECT {day()} AS day, f.vendor_name || ' (Total: ' || total || ')' AS vendor_name, status,
  count(status) AS txn_count, {dbl('sum(amount)')} AS total_amount
FROM f JOIN totals t ON t.vendor_name = f.vendor_name
GROUP BY {day()}, f.vendor_name, total, status""",
    "r20_status_summary": f"""WITH {ORDERS}
SELECT count(*) FILTER (status = 'F') AS f_count, count(*) FILTER (status = 'O') AS o_count,
  count(*) FILTER (status = 'P') AS p_count,
  {dbl("sum(CASE WHEN status = 'F' THEN amount ELSE 0 END)")} AS f_amount,
  {dbl("sum(CASE WHEN status = 'O' THEN amount ELSE 0 END)")} AS o_amount,
  {dbl("sum(CASE WHEN status = 'P' THEN amount ELSE 0 END)")} AS p_amount FROM fact""",
    "r21_lifetime_dispute": f"""WITH {ORDERS} SELECT count(*) AS dispute_count,
  {dbl('coalesce(sum(amount), 0)')} AS dispute_amount FROM fact WHERE status = 'P'""",
    "r22_reverse_reasons": reverse_reasons(day("t.create_date"), "day", "TRUE"),
    "r22_reverse_reasons_today": reverse_reasons(
        hour("t.create_date"), "hour", of("t", ON_DAY)),
    "r23_first_response_per_request": f"""WITH {ORDERS}, {LINES}, joined AS (
  SELECT f.request_id, {day('f.create_date')} AS day, f.status, f.amount, f.priority, l.response,
    row_number() OVER (PARTITION BY f.request_id ORDER BY l.id, l.response) AS place
  FROM fact f JOIN lines l ON l.request_id = f.request_id
  WHERE f.status IN ('F', 'P') AND l.request ILIKE '%SUPPLIER%')
SELECT request_id, day, status, {dbl('amount')} AS amount, priority,
  coalesce(response, 'response: NULL') AS response FROM joined WHERE place = 1""",
    "r23_first_response_fetched": f"""WITH {TXN}, {LOG}, joined AS (
  SELECT t.request_id, {hour('t.create_date')} AS hour, t.status, t.amount, t.mobile_operator, l.response,
    row_number() OVER (PARTITION BY t.request_id ORDER BY l.id, l.response) AS place
  FROM txn t JOIN log l ON l.request_id = t.request_id
  WHERE {of('t', MONTH)} AND t.status IN ('REVERSED', 'FAILED'))
SELECT request_id, hour, status, {dbl('amount')} AS amount, mobile_operator,
  coalesce(response, 'response: NULL') AS response FROM joined WHERE place = 1""",
    "r24_unanswered_requests": f"""WITH {LOG}
SELECT {day()} AS day, {hour()} AS hour, request_id AS rrn, 'RC_85(TIMEOUT)' AS response FROM log
WHERE request_id IS NOT NULL AND request IS NOT NULL AND response IS NULL
  AND create_date > DATE '2024-01-04'""",
    "r25_txn_detail": f"WITH {TXN} {DETAIL} WHERE {ON_DAY}",
    "r25_txn_detail_failed": f"WITH {TXN} {DETAIL} WHERE provider_status = 'Failed'",
    "r26_provider_status_monthly": f"""WITH {TXN}, w AS (
  SELECT *, {WALLET.format(otherwise='status')} AS canonical FROM txn)
SELECT {day()} AS day, provider_status, provider_code, canonical AS status, {COUNT_AND_TOTAL}
FROM w WHERE {CALENDAR_MONTH} GROUP BY {day()}, provider_status, provider_code, canonical""",
    "r26_provider_failed_monthly": f"""WITH {TXN}, w AS (
  SELECT *, {WALLET.format(otherwise='provider_status')} AS canonical FROM txn)
SELECT {day()} AS day, provider_status, provider_code, canonical AS status, {COUNT_AND_TOTAL}
FROM w WHERE {CALENDAR_MONTH} AND provider_status = 'Failed'
GROUP BY {day()}, provider_status, provider_code, canonical""",
    "r26_provider_states": f"""WITH {TXN}, w AS (
  SELECT * REPLACE (CASE id % 9 WHEN 0 THEN 'Ready' WHEN 1 THEN 'Success' WHEN 2 THEN 'Failed' WHEN 3 THEN 'Aborted'
      WHEN 4 THEN 'Cancelled' WHEN 5 THEN 'Refunded' WHEN 6 THEN 'TransactionInProgress' WHEN 7 THEN 'Lost' END AS provider_status),
    CASE id % 9 WHEN 0 THEN 'READY' WHEN 1 THEN 'SUCCESS' WHEN 2 THEN 'FAILED' WHEN 3 THEN 'ABORTED' WHEN 4 THEN 'CANCELLED'
      WHEN 5 THEN 'REFUNDED' WHEN 6 THEN 'IN_PROGRESS' ELSE status END AS canonical FROM txn)
SELECT {day()} AS day, provider_status, provider_code, canonical AS status, {COUNT_AND_TOTAL}
FROM w WHERE {CALENDAR_MONTH} GROUP BY {day()}, provider_status, provider_code, canonical""",
    "r27_latest_balance": f"""WITH {TXN}, {LOG}
SELECT a.request AS request_one, {BALANCE.format('a')} AS balance_one,
  b.request AS request_two, {BALANCE.format('b')} AS balance_two
FROM log a LEFT JOIN log b ON b.request_id = {latest_success('V2')}
WHERE a.request_id = {latest_success('V1')} AND a.request LIKE '%requestDateTime%'
  AND b.request LIKE '%requestDateTime%'""",
    "r27_latest_json_balance": f"""WITH {LOG}
SELECT request, strftime(strptime(regexp_extract(request, 'requestDateTime=([0-9]+)', 1),
    '%Y%m%d%H%M%S'), '%Y/%m/%d %H:%M:%S') AS request_time,
  {WHOLE.format("CAST(json_extract_string(response, '$.new_balance') AS DECIMAL(38,2))")} AS balance
FROM log WHERE request ILIKE '%REQUESTDATETIME%'
  AND regexp_matches(response, '(?s)^\\{{.*\\}}$') ORDER BY id DESC LIMIT 1""",
    "r27_guarded_balance": guarded_balance(),
    "r27_guarded_balance_rare": guarded_balance("create_date < TIMESTAMP '2024-01-09 05:00:00'"),
    "r28_tag_fields": """SELECT * FROM (
  SELECT page_id, url, nullif(regexp_extract(html, '(?s)<title>([^<]+)</title>', 1), '') AS title,
    nullif(regexp_extract(html, '(?s)<html lang="([^"]+)"', 1), '') AS language FROM pages)
WHERE title IS NOT NULL OR language IS NOT NULL""",
    "r28_tag_fields_json": f"""WITH {LOG}
SELECT id, request_id, CASE WHEN id % 4 IN (0, 1) THEN CAST(id AS VARCHAR) END AS field_id_32_value,
  CASE WHEN id % 4 IN (0, 2) THEN CAST(id AS VARCHAR) END AS field_id_39_value
FROM log WHERE {ON_DAY} AND id % 4 <> 3 AND id % 5 <> 0""",
    "r29_decode_and_enrich": """WITH decoded AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS day, c_name AS previous_merchant_id,
    'User profile not found' AS status, CAST(substr(c_name, 10, 9) AS BIGINT) - 7 AS user_id
  FROM customer WHERE c_nationkey % 3 = 1 AND regexp_matches(substr(c_name, 10, 9), '^[0-9]+$'))
SELECT d.*, coalesce(c.c_mktsegment, '') AS biz_name, coalesce(c.c_name, '') AS current_merchant_id
FROM decoded d LEFT JOIN customer c ON c.c_custkey = d.user_id""",
    "r30_daily_service_totals": f"WITH {TXN} " + " UNION ALL ".join(
        [service_total("Recharge", f"{GOOD} create_date {YESTERDAY}"),
         service_total("Bank", f"{GOOD} vendor_name = 'V1' AND {SHIFTED} {YESTERDAY}"),
         service_total("Transfer", f"CAST({SHIFTED} AS DATE) BETWEEN {DAY} - 3 AND {DAY} - 1"),
         service_total("Silent", "status = 'NEVER'")]
        + [service_total(f"Money {o}", f"{GOOD} mobile_operator = '{o}' AND create_date {YESTERDAY}")
           for o in OPERATORS]),
    "r31_weekly_satisfaction": f"WITH {TXN}, {LOG}, counts AS (" + " UNION ALL ".join([
        satisfaction("Money Out", "mobile_operator", "txn", "TRUE", quick(60),
                     "status IN ('REVERSED', 'SUCCESS', 'FAILED') AND " + WEEK.format("create_date")),
        satisfaction("Recharge", "'Recharge'", "txn", "TRUE", quick(350), WEEK.format(SHIFTED)),
        satisfaction("Money In", "vendor_name || ' IN'", "txn", "TRUE", quick(300),
                     "status IN ('FAILED', 'SUCCESS') AND " + WEEK.format("create_date")),
        satisfaction("Super QR Payment", "'Super QR Payment'", "log", ATTEMPTS,
                     "response ILIKE '%{%NPSB transfer credit%}%'",
                     f"{ASKED} AND " + WEEK.format("create_date")),
    ]) + f"""), sums AS (
  SELECT 'service' AS level, family, service, n, g FROM counts
  UNION ALL SELECT 'family', family, NULL, sum(n), sum(g) FROM counts GROUP BY family
  UNION ALL SELECT 'total', NULL, NULL, sum(n), sum(g) FROM counts)
SELECT level, family, service, CAST(n AS BIGINT) AS total_attempt, CAST(g AS BIGINT) AS satisfactory,
  {dbl(ratio('100 * CAST(g AS BIGINT)', 'CAST(n AS BIGINT)'))} AS satisfaction_level FROM sums""",
    "r31_bank_rail": totalled(f"WITH {TXN}, {LOG}, " + """
bank AS (
  SELECT create_date, status, CASE WHEN id % 5 <> 4 THEN CASE WHEN id % 3 = 0 THEN 'OWN' ELSE 'OTHER' END END AS swift,
    update_date + to_hours(CASE WHEN id % 2 = 0 THEN (id % 8) * 12 ELSE 0 END) - create_date AS took FROM txn),
said AS (SELECT create_date, id, id % 6 AS kind FROM log WHERE """ + ASKED + """),
counts AS (""" + satisfaction(
        "Money Out", "CASE WHEN swift = 'OWN' THEN 'CBS' ELSE 'EFT' END", "bank", "TRUE",
        "(swift = 'OWN' AND took <= INTERVAL 5 MINUTE) OR (swift <> 'OWN' AND took <= INTERVAL 72 HOUR)",
        "status <> 'PENDING' AND " + WEEK.format(SHIFTED))
        + " UNION ALL " + satisfaction(
        "Super QR Payment", "'Super QR Payment'", "said", "kind <> 5", "kind = 0", WEEK.format("create_date")) + ")"),
    "r32_recon_rollups": f"WITH {RECON} " + " UNION ALL ".join([
        recon_part("overall"),
        recon_part("service", service="service", kind="kind"),
        recon_part("direction", kind="kind"),
        recon_part("decision", decision="decision", where=OPEN),
        recon_part("service_decision", service=DIRECTION, decision="decision", where=OPEN),
        recon_part("direction_decision", kind="kind", decision="decision", where=OPEN),
    ]),
    "r33_assignee_kpi": f"""SELECT {day('o_orderdate')} AS day, o_orderpriority AS assignee,
  o_orderstatus AS status, count(o_orderpriority) AS ticket_count
FROM orders WHERE CAST(o_totalprice AS DECIMAL(18,2)) < 300000 AND o_orderpriority <> ''
GROUP BY ALL""",
    "r34_registration_funnel": funnel(
        day("ts + INTERVAL 6 HOUR"), "day", f"CAST(ts AS DATE) >= {DAY} - 30"),
    "r34_registration_today": funnel(
        hour("ts + INTERVAL 6 HOUR"), "hour", f"CAST(ts AS DATE) = {DAY}"),
    "r35_audit_transitions": transitions(
        day("ts"), "day", f"ts >= {NOW} - INTERVAL 1 MONTH"),
    "r35_audit_transitions_today": transitions(hour("ts"), "hour", f"CAST(ts AS DATE) = {DAY}"),
    "r36_form_open_events": f"""WITH {APP} SELECT DISTINCT user_id AS id, {hour('created_at')} AS hour,
  'FORM_OPENED' AS event_name, user_id, count(*) OVER (PARTITION BY user_id) AS transaction_count
FROM app WHERE event_name = 'view'""",
    "r37_event_counts": f"""WITH {APP} SELECT {hour('created_at')} AS hour, {day('created_at')} AS day,
  event_name, message, count(*) AS event_count FROM app
WHERE message LIKE 'request%' AND CAST(created_at AS DATE) = {DAY} GROUP BY ALL""",
    "r37_event_errors": f"""WITH {APP} SELECT {hour('created_at')} AS hour, {day('created_at')} AS day,
  level, event_name, message, details, count(*) AS event_count FROM app
WHERE level = 'ERROR' AND event_name IN ('error', 'purchase') GROUP BY ALL""",
    "r37_event_phases": f"""WITH {APP}, phased AS (
  SELECT *, CASE WHEN message LIKE '%request%' THEN 'request received'
    WHEN message LIKE '%response%' THEN 'response generated' END AS phase FROM app)
SELECT {hour('created_at')} AS hour, phase AS message, count(*) AS event_count FROM phased
WHERE level = 'INFO' AND CAST(created_at AS DATE) = {DAY} GROUP BY ALL""",
    "r38_latest_events": f"""WITH {APP} SELECT id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS date_time,
  level, event_name, message, details FROM app WHERE event_name = 'signup' ORDER BY id DESC LIMIT 50""",
    "r38_latest_errors": f"""WITH {APP} SELECT id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS date_time,
  level, event_name, message, details, user_id FROM app
WHERE event_name = 'error' AND level <> 'INFO' ORDER BY id DESC LIMIT 50""",
    "r39_package_sales": sales(
        {"day": day("created_at"), "hour": hour("created_at")},
        f"CAST(created_at AS DATE) = {DAY}"),
    "r39_package_sales_month": sales(
        {"day": day("created_at")}, f"created_at >= {NOW} - INTERVAL 1 MONTH"),
    "r39_package_sales_lifetime": sales(
        {"day": day("created_at")}, "status = 'PURCHASED'", label=False, counted="*"),
    "r40_active_plans": f"""SELECT p_partkey AS id, p_name AS name, p_type AS subscription_type,
  {dbl('CAST(p_retailprice AS DECIMAL(18,2))')} AS regular_price,
  {dbl('CAST(p_retailprice AS DECIMAL(18,2)) - p_size')} AS offer_price, TRUE AS is_active,
  p_brand AS updated_at FROM part WHERE p_size > 25""",
    "r41_cashback_cohort": f"""WITH {CASHBACK} SELECT {hour('told')} AS hour, txn_status,
  count(*) AS txn_count FROM cashback
WHERE CAST(told AS DATE) = {DAY} AND told <= {NOW} - INTERVAL 5 MINUTE GROUP BY ALL""",
    "r41_cashback_month": f"""WITH {CASHBACK} SELECT {day('told')} AS day, txn_status,
  count(*) AS txn_count FROM cashback WHERE {CALENDAR_MONTH} GROUP BY ALL""",
    "r41_cashback_failed": f"""WITH {CASHBACK} SELECT {day('told')} AS day, txn_status, wallet,
  cashback_txn_id, count(*) AS txn_count FROM cashback
WHERE {CALENDAR_MONTH} AND txn_status = 'FAILED' GROUP BY ALL""",
    "r42_sms_cohort": f"""WITH {MESSAGES} SELECT CAST(hour(request_time) AS INTEGER) AS hour_number,
  channel, telecom_operator,
  CASE WHEN message_status = '0' THEN 'SUCCESS' ELSE message_status END AS status,
  count(*) AS message_count FROM messages WHERE channel IN ('user', 'assistant', 'system')
GROUP BY hour(request_time), channel, telecom_operator, message_status""",
    "r42_sms_cohort_merged": f"""WITH {MESSAGES}, shown AS (
  SELECT *, CASE WHEN message_status = '0' THEN 'SUCCESS' ELSE message_status END AS seen FROM messages)
SELECT {day('request_time')} AS day, channel, telecom_operator, seen AS status,
  count(*) AS message_count FROM shown WHERE channel IN ('user', 'assistant', 'system')
GROUP BY {day('request_time')}, channel, telecom_operator, seen""",
    "r43_sms_bill": bill("'user', 'system'", "message_status IN ('0', 'SUCCESS')"),
    "r43_sms_bill_month": bill(
        "'user'", "request_time >= DATE '2023-12-01' AND request_time < DATE '2024-01-01'",
        formatted=True),
    "r44_ticket_resolution": f"""WITH {RESOLVED},
counts AS (
  SELECT CAST(r.at AS DATE) AS day, g.agent, count(*) AS n
  FROM rows_kept r JOIN agents g ON contains(r.address, g.key) GROUP BY ALL)
SELECT strftime(s.day, '%Y-%m-%d') AS date, s.agent, coalesce(c.n, 0) AS ticket_count
FROM spine s LEFT JOIN counts c ON c.day = s.day AND c.agent = s.agent""",
    "r44_ticket_pivot": f"WITH {RESOLVED} {PIVOT}",
    "r45_operation_hours": f"""WITH {SPENT},
counts AS (
  SELECT CAST(r.at AS DATE) AS day, g.agent, CAST(ceil(sum(r.hours)) AS BIGINT) AS n
  FROM rows_kept r JOIN agents g ON contains(r.address, g.key) GROUP BY ALL)
SELECT strftime(s.day, '%Y-%m-%d') AS date, s.agent, coalesce(c.n, 0) AS hourly_count
FROM spine s LEFT JOIN counts c ON c.day = s.day AND c.agent = s.agent""",
    "r45_operation_pivot": f"WITH {SPENT} {PIVOT}",
}

# Other ways to the same rows.
ORACLE |= {
    "r01_threshold_polled": ORACLE["r01_threshold_vs_today"],
    "r01_threshold_polled_shifted": ORACLE["r01_threshold_lagged"],
    "r11_latest_by_key_polled": ORACLE["r11_latest_by_key_pivot"],
    "r27_latest_balance_history": ORACLE["r27_latest_balance"],
}
