"""Fixed schemas of the messages and tables.

Money is ``decimal(18,2)``. Times are UTC wall-clock times held as
``timestamp_ntz``, so dates and years never depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TIME = T.TimestampNTZType()


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


MESSAGE = T.StructType(_fields(
    T.StringType(),
    "token", "traceid_lifecycle", "trans_link", "auth_code_de38",
    "acquirer_reference_data_031", "txn_ccy", "pos_time_de12", "ret_ref_no_de37",
    "txn_id", "txn_type", "mtid", "proc_code", "txn_stat_code", "authorised_by_gps",
))

TRANSACTION_INFO = T.StructType(
    _fields(T.StringType(), "key", "process_id", "transaction_id", "provider_message_id",
            "provider_transaction_id", "debit_card_id", "card_token", "spend_group",
            "message_type")
    + _fields(MONEY, "settlement_amount")
    + _fields(T.StringType(), "settlement_currency")
    + _fields(MONEY, "transaction_amount")
    + _fields(T.StringType(), "transaction_currency")
    + _fields(TIME, "transaction_date_time")
    + _fields(T.BooleanType(), "is_balance_enquiry", "is_pin_change", "is_avs_check")
    + _fields(T.StringType(), "merchant")
    + [T.StructField("message", MESSAGE)]
)

LEDGERS = ("wirecard", "client", "earmark")


def _ledger_fields(prefix: str = "") -> list[T.StructField]:
    out: list[T.StructField] = []
    for ledger in LEDGERS:
        out.append(T.StructField(f"{prefix}{ledger}_amount", MONEY))
        out.append(T.StructField(f"{prefix}{ledger}_currency", T.StringType()))
    return out


ACCOUNT_FIELDS = _fields(T.StringType(), "internal_account_id", "internal_account_currency")

# the ledger position a later message starts from: totals after the last one
POSITION = T.StructType(_ledger_fields() + ACCOUNT_FIELDS)

# what processing one message yields: an error, or deltas and totals
RESULT = T.StructType(
    _fields(T.StringType(), "error", "outcome")
    + _ledger_fields() + _ledger_fields("total_") + ACCOUNT_FIELDS
)

CARD_TRANSACTION = T.StructType(
    _fields(T.StringType(), "transaction_id", "provider_transaction_id", "provider_message_id")
    + _fields(TIME, "provider_transaction_date_time", "transaction_timestamp")
    + _fields(T.StringType(), "message_type", "debit_card_id")
    + ACCOUNT_FIELDS + _ledger_fields() + _fields(TIME, "timestamp")
)

MESSAGE_PROCESSED = T.StructType(
    _fields(T.StringType(), "key", "process_id", "transaction_id", "provider_message_id",
            "provider_transaction_id", "debit_card_id", "spend_group", "message_type")
    + _fields(TIME, "provider_transaction_time", "transaction_timestamp")
    + _ledger_fields() + _ledger_fields("total_") + ACCOUNT_FIELDS
    + [T.StructField("request", MESSAGE),
       T.StructField("ehi_response", T.StructType(_fields(T.StringType(), "responsestatus")))]
)

TRANSACTION_MATCHING = T.StructType(
    _fields(T.StringType(), "transaction_id", "card_token")
    + [T.StructField("tag_set", T.IntegerType()), T.StructField("signature", T.StringType()),
       T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
       T.StructField("timestamp", TIME)]
)

SPENDING_TOTALS = T.StructType(
    _fields(T.StringType(), "debit_card_id", "total_type")
    + _fields(MONEY, "daily_total", "annual_total") + _fields(TIME, "timestamp")
)

LINKED_ACCOUNT = T.StructType(
    _fields(T.StringType(), "debit_card_id") + ACCOUNT_FIELDS + _fields(TIME, "from_timestamp")
)

PROCESSOR_NODE = T.StructType(
    _fields(T.StringType(), "account_id", "node_id", "gps_account_id", "topic")
)

# an event on a topic, and the payload inside its value
HEADERS = T.ArrayType(T.StructType(_fields(T.StringType(), "key") + _fields(T.BinaryType(), "value")))
EVENT = T.StructType(
    _fields(T.StringType(), "key", "value", "topic") + [T.StructField("headers", HEADERS)])
ENVELOPE_FIELDS = ("key", "process_id", "event_name", "payload")

MESSAGE_TYPES = (
    "AUTHORISATION", "AUTH_REVERSAL", "PRESENTMENT", "FINANCIAL_REVERSAL",
    "CHARGEBACK", "SEC_PRESENTMENT", "CHARGEBACK_NON_CREDIT",
)

# request job -> type its processed messages carry
JOB_MESSAGE_TYPE = {
    "authorisation": "AUTHORISATION",
    "authorisation_reversal": "AUTH_REVERSAL",
    "externally_authorised": "AUTHORISATION",
    "presentment": "PRESENTMENT",
    "financial_reversal": "FINANCIAL_REVERSAL",
    "chargeback": "CHARGEBACK",
    "second_presentment": "SEC_PRESENTMENT",
    "chargeback_non_credit": "CHARGEBACK_NON_CREDIT",
}

# place of a job's messages among messages of the same moment
TYPE_RANK = {
    "authorisation": 1, "externally_authorised": 2, "authorisation_reversal": 3, "presentment": 4,
    "financial_reversal": 5, "chargeback": 6, "second_presentment": 7, "chargeback_non_credit": 8,
}

# columns that order stored rows; replay order within a transaction ends with the same ones
RECORDED = _fields(TIME, "timestamp", "transaction_timestamp") + _fields(
    T.IntegerType(), "type_rank") + _fields(T.StringType(), "provider_message_id", "process_id")


def _with_recorded(schema: T.StructType, *without: str) -> T.StructType:
    kept = [f for f in schema if f.name not in without]
    names = {f.name for f in kept}
    return T.StructType(kept + [f for f in RECORDED if f.name not in names])


STORED_HISTORY = _with_recorded(CARD_TRANSACTION)
STORED_INDEX = _with_recorded(TRANSACTION_MATCHING)
