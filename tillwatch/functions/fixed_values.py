"""Words, bounds, patterns and labels that results must carry unchanged."""

from __future__ import annotations

from datetime import timedelta

# Duration classes, upper bound included, and the label of each.
DURATION_CLASSES = (
    (timedelta(minutes=1), "1 min or less"),
    (timedelta(minutes=2), "2 min or less"),
    (timedelta(minutes=5), "5 min or less"),
    (timedelta(minutes=10), "10 min or less"),
    (timedelta(hours=1), "1 hr or less"),
)
LONGEST_DURATION = "greater than 1 hour"
LONGEST_DURATION_RECHARGE = "greater then 1 hour"

# Four-week baseline series names.
BASELINE_SERIES = "last 4week not success avg"
TODAY_SERIES = "today not success"

# Markers in provider requests and responses (ILIKE patterns).
CREDIT_MARKER = "%{%NPSB transfer credit%}%"
HEX_REQUEST = "%hex%"
CARD_REQUEST = "%VisaFundTransferDto%"
SENSITIVE_MARKER = '%"sensitiveData"%'
PROFILE_MISSING = "User profile not found"
COUNTABLE_ATTEMPTS = (
    "%{%NPSB transfer credit%}%",
    "%User profile not found%",
    "%Failed due to Amount falls within fail rate%",
    "%timeout%",
    "%Something went wrong%",
)

# Keys and patterns that pull one field out of a text.
MESSAGE_KEY = '"message":'
ERROR_KEY = '"error":'
RESPONSE_MESSAGE_KEY = '"responseMessage":'
RECEIVER_WALLET_KEY = '"receiver_wallet_no":'
CODE_AND_MESSAGE = r"<ResponseCode>(.*?)</ResponseCode>.*?<ResponseMessage>(.*?)</ResponseMessage>"
REQUEST_TIME_FIELD = r"requestDateTime=([0-9]+)"
FIELD_32 = r'<field id="32" value="([^"]+)"'
FIELD_39 = r'<field id="39" value="([^"]+)"'
BALANCE_BEFORE = "Your new balance is "
BALANCE_AFTER = " TAKA"
NOT_JSON = "Invalid or non-JSON response"
NO_BANK_LOG = "No data in bank_txn_log"
NULL_RESPONSE = "response: NULL"
TIMEOUT_LABEL = "RC_85(TIMEOUT)"

# Free-text descriptions (LIKE patterns) and the reason each one stands for.
REASONS = (
    ("invalid transfer value%", "Invalid Transfer Value"),
    (
        "The mobile number%cannot use the same recharge service within 2.00 minutes of last "
        "successful transaction as last transfer amount is same as current requested amount.",
        "duplicate 2 minutes",
    ),
    (
        "%3006202:The mobile number%cannot use the any recharge service within 3.00 minutes of "
        "last successful transaction as last transfer amount is same as current requested amount.%",
        "duplicate 3 minutes",
    ),
)
NO_CREDIT_REASON = (
    "Your current request to transfer {amount} TAKA cannot be processed as you do not have enough credit"
)
NO_CREDIT_TODAY = (
    "%Your current request to transfer %TAKA cannot be processed as you do not have enough credit.%"
)
NO_CREDIT_MONTH = (
    "%Your current request to transfer % TAKA cannot be processed as you do not have enough credit.%"
)
QUEUED = (
    "Your request to recharge % is already in queue. Please wait for sometime.",
    "Your request to recharge {rcvr_num} is already in queue. Please wait for sometime.",
)

# Wallet-provider status and its canonical form.
WALLET_STATUS = {
    "Ready": "READY",
    "Success": "SUCCESS",
    "Failed": "FAILED",
    "Aborted": "ABORTED",
    "Cancelled": "CANCELLED",
    "Refunded": "REFUNDED",
    "TransactionInProgress": "IN_PROGRESS",
}

# Card action codes.
CARD_ACTIONS = {
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
OTHER_ACTION = "Other"

# Text lengths above which a message needs one more segment, and the price of one.
UNICODE_SEGMENTS = (70, 134, 201, 268)
PLAIN_SEGMENTS = (160, 306, 459, 612, 765)
SEGMENT_RATE = "0.28"

# Registration outcome.
REGISTERED = "SUCCESSFULLY COMPLETED REGISTRATION"
ATTEMPTED = "ATTEMPTED"

# Numeric user id inside a merchant id.
USER_ID_START, USER_ID_LENGTH, USER_ID_OFFSET = 7, 9, 124445555

# Service-level measures.
MEASURES = (
    ("Money-In", "Money credited to wallet users in 5 minutes"),
    (
        "Money-Out",
        "CBS - Money sent to CBL within 5 minutes, EFT - Money sent to EFT within 3 days, "
        "MFS - Money sent to External FIs in 1 minutes",
    ),
    ("Mobile Recharge", "Mobile recharge terminal state in 1 minute"),
    (
        "Super QR payment",
        "Successful requests are instantaneously received as such whether the attempt was "
        "successful or failed served as criteria",
    ),
)
