"""Card tables derived from the order, customer and event tables.

One order is one card transaction: the order is its authorisation, its lines are
the later messages, and the line's flags pick the kind of message.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardweave.operators.matching import Unexploded

MESSAGE_COLUMNS = [
    "job", "message_type", "type_rank", "key", "process_id", "transaction_id",
    "provider_message_id", "provider_transaction_id", "debit_card_id", "card_token",
    "spend_group", "settlement_amount", "settlement_currency", "transaction_date_time",
    "response_status", "txn_stat_code", "linked_account_id", "linked_account_currency",
    "message",
]

# a day in the middle of the messages
CUT = "1995-06-17 00:00:00"

# complete replay order
MESSAGE_ORDER = [
    "transaction_date_time", "type_rank", "provider_message_id", "settlement_amount", "process_id",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _cents(column: str) -> str:
    return f"cast({column} as decimal(18,2))"


def _request(**overrides: str) -> str:
    """SQL of the nested request; everything not overridden comes from the order."""
    fields = {
        "token": "card_token",
        "traceid_lifecycle": "concat('T-', transaction_id)",
        "trans_link": "concat('L-', transaction_id)",
        "auth_code_de38": "lpad(cast(o_custkey % 1000 as string), 6, '0')",
        "acquirer_reference_data_031": "concat('AR-', o_custkey)",
        "txn_ccy": "'826'",
        "pos_time_de12": "date_format(o_orderdate, 'yyyyMMdd')",
        "ret_ref_no_de37": "concat('R-', o_custkey)",
        "txn_id": "provider_message_id",
        "txn_type": "'A'",
        "mtid": "'0100'",
        "proc_code": "'000000'",
        "txn_stat_code": "txn_stat_code",
        "authorised_by_gps": "'N'",
    }
    fields.update(overrides)
    return "named_struct(" + ", ".join(f"'{n}', cast({e} as string)" for n, e in fields.items()) + ")"


_CARD = [
    "cast(o_orderkey as string) as transaction_id",
    "concat('P-', o_orderkey) as provider_transaction_id",
    "concat('C-', o_custkey) as debit_card_id",
    "concat('TK-', o_custkey) as card_token",
    "case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'ECOM' else 'POS' end as spend_group",
    "'GBP' as settlement_currency",
    "case when o_orderpriority = '5-LOW' then null else concat('ACC-', o_custkey) end"
    " as linked_account_id",
    "case when o_orderpriority = '5-LOW' then null else 'EUR' end as linked_account_currency",
]


def _finish(df: DataFrame, request: str, *more: str) -> DataFrame:
    return df.selectExpr("*", f"{request} as message").select(*MESSAGE_COLUMNS, *more)


def authorisations(spark: SparkSession, folder: str,
                   more: dict[str, str] | None = None) -> DataFrame:
    more = more or {}
    df = table(spark, folder, "orders").selectExpr(
        "*", *_CARD, *[f"{sql} as {name}" for name, sql in more.items()],
        "'authorisation' as job", "'AUTHORISATION' as message_type", "1 as type_rank",
        "concat('A-', o_orderkey) as process_id", "concat('A-', o_orderkey) as key",
        "concat('A-', o_orderkey) as provider_message_id",
        f"-{_cents('o_totalprice')} as settlement_amount",
        "o_orderdate as transaction_date_time",
        "case when o_orderstatus = 'P' then '51' else '00' end as response_status",
        "cast(null as string) as txn_stat_code",
    )
    return _finish(df, _request(), *more)


def external_authorisations(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders").where("o_orderstatus = 'F'").selectExpr(
        "*", *_CARD, "'externally_authorised' as job", "'AUTHORISATION' as message_type", "2 as type_rank",
        "concat('X-', o_orderkey) as process_id", "concat('X-', o_orderkey) as key",
        "concat('X-', o_orderkey) as provider_message_id",
        f"-{_cents('o_totalprice')} as settlement_amount",
        "o_orderdate + interval 1 day as transaction_date_time",
        "cast(null as string) as response_status",
        "case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then 'i' else 'A' end"
        " as txn_stat_code",
    )
    return _finish(df, _request(txn_type="'J'", authorised_by_gps="'Y'"))


# (job, message type, rank, sign) by return flag and line status
_LINE_KIND = """
case when l_returnflag = 'N' then '{n}'
     when l_returnflag = 'A' and l_linestatus = 'F' then '{af}'
     when l_returnflag = 'A' then '{ao}'
     when l_linestatus = 'F' then '{rf}'
     when l_tax = 0 then '{nc}'
     else '{ro}' end"""


def line_messages(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    lines = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    df = lines.selectExpr(
        "*", *_CARD,
        _LINE_KIND.format(n="presentment", af="authorisation_reversal", ao="second_presentment",
                          rf="financial_reversal", nc="chargeback_non_credit", ro="chargeback")
        + " as job",
        _LINE_KIND.format(n="PRESENTMENT", af="AUTH_REVERSAL", ao="SEC_PRESENTMENT",
                          rf="FINANCIAL_REVERSAL", nc="CHARGEBACK_NON_CREDIT", ro="CHARGEBACK")
        + " as message_type",
        f"cast({_LINE_KIND.format(n=4, af=3, ao=7, rf=5, nc=8, ro=6)} as int) as type_rank",
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as process_id",
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as key",
        "concat_ws('-', l_orderkey, l_linenumber) as provider_message_id",
        f"""case when l_returnflag = 'N' or (l_returnflag = 'A' and l_linestatus = 'O')
                 then -{_cents('l_extendedprice')}
                 when l_returnflag = 'R' and l_linestatus = 'O' and l_tax = 0 and l_discount < 0.05
                 then cast(0 as decimal(18,2))
                 else {_cents('l_extendedprice')} end as settlement_amount""",
        "l_shipdate as transaction_date_time",
        "cast(null as string) as response_status", "cast(null as string) as txn_stat_code",
    )
    return _finish(df, _request(
        traceid_lifecycle="case when l_returnflag <> 'R' then concat('T-', transaction_id) end",
        trans_link="case when l_returnflag <> 'A' then concat('L-', transaction_id) end",
        acquirer_reference_data_031="case when l_linestatus = 'F' then concat('AR-', o_custkey) end",
        auth_code_de38="case when l_tax > 0.02 then lpad(cast(o_custkey % 1000 as string), 6, '0') end",
        txn_type="upper(substr(l_returnflag, 1, 1))", mtid="'1240'"))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every message of every job, with its transaction already known."""
    return (
        authorisations(spark, folder)
        .unionByName(external_authorisations(spark, folder))
        .unionByName(line_messages(spark, folder))
    )


def linked_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Three effective-dated accounts per card."""
    return table(spark, folder, "customer").selectExpr(
        "concat('C-', c_custkey) as debit_card_id", "c_custkey",
        "explode(sequence(0, 2)) as n",
    ).selectExpr(
        "debit_card_id", "concat('ACC-', c_custkey, '-', n) as internal_account_id",
        "case n when 0 then 'EUR' when 1 then 'GBP' else 'PLN' end as internal_account_currency",
        "timestamp_ntz '1996-01-01 00:00:00' + make_dt_interval(cast(700 * n + c_custkey % 400 as int))"
        " as from_timestamp",
    )


def card_settings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "concat('C-', c_custkey) as debit_card_id",
        "concat('ACC-', c_custkey) as linked_account_id", "'EUR' as linked_account_currency",
        "case c_mktsegment when 'FURNITURE' then 'BLOCKED' else 'ACTIVE' end as card_status",
        "case c_mktsegment when 'MACHINERY' then array('POS') else array('POS', 'ECOM') end"
        " as allowed_types",
        "case c_mktsegment when 'BUILDING' then array('5-LOW') else array('NONE') end"
        " as blocked_merchants",
        f"{_cents('c_acctbal')} * 50 + 200000 as daily_limit",
        f"{_cents('c_acctbal')} * 100 + 900000 as annual_limit",
    ).selectExpr(
        "debit_card_id", "linked_account_id", "linked_account_currency", "card_status",
        "allowed_types", "blocked_merchants", "cast(daily_limit as decimal(18,2)) as daily_limit",
        "cast(annual_limit as decimal(18,2)) as annual_limit")


def account_balances(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "concat('ACC-', c_custkey) as account_id",
        f"cast({_cents('c_acctbal')} * 60 as decimal(18,2)) as available")


def processor_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Account to node: an account belongs to the node of its customer's region."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, folder, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    ).selectExpr(
        "concat('ACC-', c_custkey) as account_id", "concat('node-', r_regionkey) as node_id",
        "concat('GPS-', r_regionkey) as gps_account_id",
        "concat('node.', lower(replace(r_name, ' ', '-')), '.commands') as topic")


# moment the spend totals of the stored cards were last updated, and "now" of one-shot jobs
AS_OF = "2000-06-15 12:00:00"


def spend_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Stored spend totals per (card, spend group); some last updated on earlier days or years."""
    return table(spark, folder, "customer").selectExpr(
        "concat('C-', c_custkey) as debit_card_id", "explode(array('POS', 'ECOM')) as total_type",
        "c_acctbal", "c_mktsegment",
    ).selectExpr(
        "debit_card_id", "total_type",
        f"abs({_cents('c_acctbal')}) as daily_total",
        f"cast(abs({_cents('c_acctbal')}) * 10 as decimal(18,2)) as annual_total",
        f"""timestamp_ntz '{AS_OF}' - case c_mktsegment when 'BUILDING' then interval 1 day
            when 'HOUSEHOLD' then interval 400 day else interval 1 hour end as timestamp""")


def event_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as topic records; the error kind carries a value that cannot be decoded."""
    return table(spark, folder, "events").selectExpr(
        "cast(event_id as string) as key",
        """case when event_type = 'error' then concat('broken:', props)
           else to_json(named_struct(
             'key', cast(event_id as string), 'process_id', concat('E-', event_id),
             'event_name', event_type, 'payload', named_struct(
               'debit_card_id', concat('U-', user_id),
               'settlement_amount', cast(cast(-value as decimal(18,2)) as string),
               'provider_message_id', cast(event_id as string)))) end as value""",
        "concat('cards.', event_type, '.request') as topic")


def spend_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Processed messages of the event stream, in the order they arrived."""
    return table(spark, folder, "events").where("event_type <> 'error'").selectExpr(
        "event_id", "concat('E-', event_id) as process_id",
        "concat('U-', user_id) as debit_card_id",
        "case when event_id % 2 = 0 then 'POS' else 'ECOM' end as spend_group",
        "concat(user_id, '-', date_format(ts, 'yyyyMMdd')) as transaction_id",
        "case when event_type = 'purchase' or event_type = 'signup' then 'AUTHORISATION'"
        " else 'PRESENTMENT' end as message_type",
        "case when event_type = 'purchase' then '00' end as response_status",
        "case when event_type = 'signup' then 'y' else 'N' end as authorised_by_gps",
        f"case when event_type = 'click' then -{_cents('value')}"
        f" when event_type = 'view' then {_cents('value')} end as client_amount",
        f"case when event_type = 'purchase' then -{_cents('value')}"
        f" when event_type = 'signup' then {_cents('value')} end as earmark_amount",
        "ts as transaction_timestamp",
        "case when event_id % 7 = 0 then ts + interval 2 days else ts end as processed_at")


RECORDED = ["timestamp", "type_rank", "process_id"]


def stored_history(spark: SparkSession, folder: str, without_job: str | None = None,
                   until: str | None = None) -> DataFrame:
    """History rows left by the messages of all jobs but ``without_job``, or those before ``until``.

    Amounts follow a fixed rule per type, with nulls where older rows had none.
    """
    rows = messages(spark, folder)
    if without_job:
        rows = rows.where(F.col("job") != without_job)
    if until:
        rows = rows.where(F.col("transaction_date_time") < F.lit(until).cast("timestamp_ntz"))
    return rows.selectExpr(
        "transaction_id", "provider_transaction_id", "provider_message_id", "message_type",
        "debit_card_id", "type_rank", "process_id", "message",
        "linked_account_id as internal_account_id",
        "linked_account_currency as internal_account_currency",
        "transaction_date_time as provider_transaction_date_time",
        "transaction_date_time as transaction_timestamp", "transaction_date_time as timestamp",
        """case message_type when 'AUTHORISATION' then settlement_amount
             when 'AUTH_REVERSAL' then -settlement_amount
             when 'FINANCIAL_REVERSAL' then null
             else cast(0 as decimal(18,2)) end as earmark_amount""",
        "'EUR' as earmark_currency",
        """case when message_type in ('AUTHORISATION', 'AUTH_REVERSAL') then cast(0 as decimal(18,2))
             when message_type = 'CHARGEBACK_NON_CREDIT' then null
             else settlement_amount end as client_amount""",
        "'EUR' as client_currency",
        """case when message_type in ('AUTHORISATION', 'AUTH_REVERSAL') then cast(0 as decimal(18,2))
             when message_type = 'CHARGEBACK_NON_CREDIT' then null
             else -settlement_amount end as wirecard_amount""",
        "'GBP' as wirecard_currency")


def with_slim_message(history: DataFrame) -> DataFrame:
    """History whose ``message`` sorts as the whole one does among rows that have all else in common.

    What the transaction, card, message id and type of a row imply is left out or told by a flag, so
    that a sort by all columns holds a quarter of the bytes.
    """
    m = F.col("message")
    return history.withColumn("message", F.struct(
        m["traceid_lifecycle"].isNotNull().alias("traceid_lifecycle"), m["trans_link"].isNotNull().alias("trans_link"),
        m["auth_code_de38"].alias("auth_code_de38"), m["acquirer_reference_data_031"].isNotNull().alias("acquirer"),
        m["pos_time_de12"].alias("pos_time_de12"), m["txn_type"].alias("txn_type"),
        m["txn_stat_code"].alias("txn_stat_code")))


def stored_index(spark: SparkSession, folder: str) -> Unexploded:
    """Index of the messages of all jobs."""
    return Unexploded(messages(spark, folder).withColumnsRenamed({
        "message": "request", "transaction_date_time": "timestamp"}), tuple(RECORDED))


def processed_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Processed messages of all jobs with deltas by a fixed rule per job."""
    return messages(spark, folder).selectExpr(
        "*", "message as request", "linked_account_id as internal_account_id",
        "linked_account_currency as internal_account_currency",
        """case when job in ('presentment', 'financial_reversal', 'chargeback',
             'second_presentment') then settlement_amount end as client_amount""",
        "'EUR' as client_currency",
        """case when job = 'second_presentment' and spend_group = 'ECOM' then null
             when job in ('presentment', 'financial_reversal', 'chargeback', 'second_presentment')
             then -settlement_amount end as wirecard_amount""",
        "settlement_currency as wirecard_currency",
        """case when job = 'authorisation' and response_status = '00' then settlement_amount
             when job = 'authorisation_reversal' then settlement_amount
             when job = 'presentment' then cast(0 as decimal(18,2)) end as earmark_amount""",
        "'EUR' as earmark_currency")


_FLAGS = {
    "merchant": "o_orderpriority",
    "is_balance_enquiry": "o_orderstatus = 'O' and o_orderpriority = '1-URGENT'",
    "is_pin_change": "o_orderstatus = 'O' and o_orderpriority = '2-HIGH'",
    "is_avs_check": "o_orderstatus = 'O' and o_orderpriority = '3-MEDIUM'",
}
_UNKNOWN = ("transaction_id", "response_status", "linked_account_id", "linked_account_currency")


def authorisation_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Authorisation messages with the flags and merchant the checks read."""
    return authorisations(spark, folder, _FLAGS).drop(*_UNKNOWN)


def event_spend_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Stored totals of the cards of the event stream."""
    return table(spark, folder, "customer").selectExpr(
        "concat('U-', c_custkey) as debit_card_id", "explode(array('POS', 'ECOM')) as total_type",
        "c_acctbal", "c_mktsegment",
    ).selectExpr(
        "debit_card_id", "total_type", f"abs({_cents('c_acctbal')}) as daily_total",
        f"cast(abs({_cents('c_acctbal')}) * 10 as decimal(18,2)) as annual_total",
        """timestamp_ntz '2024-01-01 00:00:00' - case c_mktsegment
             when 'BUILDING' then interval 1 day when 'HOUSEHOLD' then interval 400 day
             else interval 0 day end as timestamp""")


def end_to_end_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests of all jobs, without transaction ids."""
    others = external_authorisations(spark, folder).unionByName(line_messages(spark, folder))
    return authorisation_requests(spark, folder).unionByName(
        others.drop(*_UNKNOWN), allowMissingColumns=True)
