"""Input and output vectors of the request and downstream jobs."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardweave.functions.spend import spend_action
from cardweave.operators.commands import accounting_commands, earmark_commands
from cardweave.operators.matching import matching_index
from cardweave.operators.processors import process_requests
from cardweave.operators.spend import total_spend_update
from cardweave.schemas import MESSAGE


def money(value):
    return None if value is None else Decimal(str(value))


REQUEST = ("n int, job string, message_type string, process_id string, transaction_id string,"
           " provider_message_id string, settlement_amount decimal(18,2), settlement_currency string,"
           " response_status string, txn_stat_code string, linked_account_id string,"
           " linked_account_currency string")
HISTORY = ("transaction_id string, provider_message_id string, message_type string, timestamp int,"
           " wirecard_amount decimal(18,2), wirecard_currency string, client_amount decimal(18,2),"
           " client_currency string, earmark_amount decimal(18,2), earmark_currency string,"
           " internal_account_id string, internal_account_currency string")
ANY_ORDER: dict = {}


def run(spark, job, message_type, cases, rules=ANY_ORDER):
    """cases: (s, duplicate, status, linked, history or None); history: (w, c, e)."""
    requests, history = [], []
    for n, (s, duplicate, status, linked, last) in enumerate(cases):
        requests.append((n, job, message_type, f"p{n}", f"t{n}", "42", money(s), "FOO", None, status,
                         linked, "LCY" if linked else None))
        if last is not None:
            w, c, e = (money(x) for x in last)
            history.append((f"t{n}", "42" if duplicate else "41", "AUTHORISATION", 1, w, "WCY", c,
                            "CCY", e, "ECY", "BUZ", "BAR"))
    out = process_requests(
        job, spark.createDataFrame(requests, REQUEST), spark.createDataFrame(history, HISTORY),
        rules=rules)
    return {row["n"]: row for row in out.collect()}


def check(row, **expected):
    for name, value in expected.items():
        got = row[name]
        assert got == (money(value) if name.endswith("_amount") else value), (name, got, value)


def test_generic_financial(spark):
    cases = [(-19.09, False, None, None, (20.15, -20.15, None)),
             (19.09, False, None, None, (20.15, -20.15, None)),
             (19.09, False, None, None, (19.09, -19.09, None)),
             (19.09, False, None, None, (3.08, -3.08, None)),
             (19.09, True, None, None, (3.08, -3.08, None)),
             (19.09, False, None, None, None),
             (19.09, False, None, None, (None, None, None)),
             (None, False, None, None, (1, 1, 1))]
    expected = [(19.09, -19.09, 39.24, -39.24), (-19.09, 19.09, 1.06, -1.06),
                (-19.09, 19.09, 0, 0), (-19.09, 19.09, -16.01, 16.01)]
    for job, kind in (("chargeback", "CHARGEBACK"), ("second_presentment", "SEC_PRESENTMENT"),
                      ("financial_reversal", "FINANCIAL_REVERSAL")):
        rows = run(spark, job, kind, cases)
        for n, (w, c, tw, tc) in enumerate(expected):
            check(rows[n], error=None, wirecard_amount=w, client_amount=c, earmark_amount=None,
                  total_wirecard_amount=tw, total_client_amount=tc, total_earmark_amount=0,
                  wirecard_currency="FOO", client_currency="BAR", total_wirecard_currency="FOO",
                  total_client_currency="BAR", total_earmark_currency="BAR",
                  internal_account_id="BUZ", internal_account_currency="BAR")
        check(rows[4], outcome="duplicate", wirecard_amount=None, client_amount=None,
              earmark_amount=None, total_wirecard_amount=3.08, total_client_amount=-3.08,
              total_earmark_amount=0, total_wirecard_currency="WCY", total_client_currency="CCY",
              total_earmark_currency="ECY", internal_account_id="BUZ")
        check(rows[5], error="empty_history")
        check(rows[6], total_wirecard_amount=-19.09, total_client_amount=19.09)
        check(rows[7], error="missing_settlement_amount")


def test_presentment(spark):
    rows = run(spark, "presentment", "PRESENTMENT", [
        (-19.09, False, None, "42", None), (-19.09, False, None, None, (0, 0, -20.15)),
        (-19.09, False, None, None, (20.15, -20.15, 0)),
        (19.09, False, None, None, (20.15, -20.15, 0)),
        (19.09, True, None, None, (20.15, -20.15, 0)), (-19.09, False, None, None, None),
        (-19.09, False, None, None, (None, 1, 0)), (-1, False, None, None, (0, 0, 5))])
    check(rows[0], outcome="offline", earmark_amount=0, total_earmark_amount=0, client_amount=-19.09,
          wirecard_amount=19.09, total_client_amount=-19.09, total_wirecard_amount=19.09,
          internal_account_id="42", client_currency="LCY", wirecard_currency="FOO")
    check(rows[1], outcome="online", earmark_amount=20.15, total_earmark_amount=0,
          total_client_amount=-19.09, total_wirecard_amount=19.09, internal_account_id="BUZ")
    check(rows[2], earmark_amount=0, total_client_amount=-39.24, total_wirecard_amount=39.24)
    check(rows[3], client_amount=19.09, wirecard_amount=-19.09, total_client_amount=-1.06,
          total_wirecard_amount=1.06)
    check(rows[4], outcome="duplicate", total_client_amount=-20.15, total_wirecard_amount=20.15,
          total_earmark_amount=0)
    check(rows[5], error="no_linked_account")
    check(rows[6], error="missing_last_ledger")
    check(rows[7], total_earmark_amount=10)  # a positive earmark doubles


def test_authorisation_reversal(spark):
    rows = run(spark, "authorisation_reversal", "AUTH_REVERSAL", [
        (19.09, True, None, None, (0, 0, -20.15)), (19.09, False, None, None, (0, 0, -20.15)),
        (20.16, False, None, None, (0, 0, -20.15)), (1, False, None, None, (0, 0, None)),
        (1, False, None, None, None)])
    check(rows[0], outcome="duplicate", earmark_amount=None, total_earmark_amount=-20.15)
    check(rows[1], earmark_amount=19.09, total_earmark_amount=-1.06, total_client_amount=0,
          total_wirecard_amount=0, total_client_currency="CCY", total_wirecard_currency="FOO")
    check(rows[2], error="reversal_exceeds_earmark")
    check(rows[3], error="missing_last_earmark")
    check(rows[4], error="empty_history")


def test_externally_authorised(spark):
    rows = run(spark, "externally_authorised", "AUTHORISATION", [
        (-19.09, False, "A", None, (0, 0, -20.15)), (-19.09, False, "I", None, (0, 0, -20.15)),
        (-19.09, False, "I", None, (0, 0, 0)), (-19.09, False, "I", None, None),
        (-19.09, False, "i", None, (0, 0, -19.09)), (-19.09, False, None, None, (0, 0, -19.09))])
    check(rows[0], error="not_declined_externally")
    check(rows[1], error="settlement_differs_from_earmark")
    for n in (2, 3):
        check(rows[n], outcome="no_change", client_amount=None, total_client_amount=None,
              total_earmark_amount=None)
    check(rows[4], earmark_amount=19.09, total_earmark_amount=0, total_client_amount=0,
          total_wirecard_amount=0)
    check(rows[5], error="not_declined_externally")


def test_non_financial(spark):
    rows = run(spark, "chargeback_non_credit", "CHARGEBACK_NON_CREDIT", [
        (0, False, None, None, (3.08, -3.08, None)), (19.09, False, None, None, None),
        (19.09, False, None, None, (3.08, -3.08, None)), (0, False, None, None, None)])
    check(rows[0], total_wirecard_amount=3.08, total_client_amount=-3.08, total_earmark_amount=0,
          total_wirecard_currency="FOO", total_client_currency="BAR", total_earmark_currency="BAR",
          wirecard_amount=None, client_amount=None, internal_account_id=None)
    check(rows[1], error="non_zero_settlement")
    check(rows[2], error="non_zero_settlement")
    check(rows[3], error="empty_history")


def test_order_rules(spark):
    history = [(1, False, None, None, (1, -1, -5))]
    rows = run(spark, "chargeback", "CHARGEBACK", history, rules={"CHARGEBACK": ("PRESENTMENT",)})
    check(rows[0], error="invalid_order")
    rows = run(spark, "chargeback", "CHARGEBACK", history, rules={"CHARGEBACK": ("AUTHORISATION",)})
    check(rows[0], error=None)


PROCESSED = ("process_id string, key string, transaction_id string, message_type string,"
             " client_amount decimal(18,2), client_currency string, wirecard_amount decimal(18,2),"
             " earmark_amount decimal(18,2), earmark_currency string, internal_account_id string,"
             " internal_account_currency string")


def commands_input(spark, rows):
    data = [(f"p{n}", f"k{n}", "t", "PRESENTMENT", money(c), "bar", money(w), money(e), "bar", acct,
             "bar") for n, (c, w, e, acct) in enumerate(rows)]
    frame = spark.createDataFrame(data, PROCESSED).withColumn(
        "request", F.lit(None).cast(MESSAGE.simpleString()))
    nodes = spark.createDataFrame(
        [("42", "n1", "foo", "node.topic")],
        "account_id string, node_id string, gps_account_id string, topic string")
    return frame, nodes


def test_accounting_commands(spark):
    frame, nodes = commands_input(spark, [
        (0, 0, 19.09, "42"), (-19.09, 19.09, None, "42"), (19.09, -19.09, None, "42"),
        (1, 1, None, "42"), (-1, 1, None, "unknown"), (-1, 1, None, " ")])
    split = accounting_commands(frame, nodes, "reply")
    rows = {r["process_id"]: r for r in split.commands.collect()}
    assert set(rows) == {"p1", "p2", "p5"}
    info, accounts = rows["p1"]["command"]["transaction_info"], rows["p1"]["command"]["accounting_info"]
    assert (accounts["debit_account"]["account_id"], accounts["debit_balance_update"]) == ("42", "ALL")
    assert (accounts["credit_account"]["account_id"], accounts["credit_balance_update"]) == ("foo", "ALL")
    assert (info["amount"], info["currency"], info["transaction_type"], info["direction"]) == (
        Decimal("19.09"), "bar", "DEBIT", "INTERNAL")
    assert info["id"] == "p1" and info["data"] is None
    accounts = rows["p2"]["command"]["accounting_info"]
    assert accounts["debit_account"]["account_id"] == "foo"
    assert rows["p2"]["command"]["transaction_info"]["transaction_type"] == "CREDIT"
    assert bytes(rows["p1"]["headers"][-1]["value"]) == b"reply"
    tags = [t["key"] for t in rows["p1"]["command"]["accounting_tags"]]
    assert tags == ["transaction_id", "process_id", "message_type"]
    assert [r["process_id"] for r in split.completed.collect()] == ["p0"]
    errors = {r["process_id"]: r["error"] for r in split.errors.collect()}
    assert errors == {"p3": "inconsistent_ledger_signs", "p4": "no_processor_node"}


def test_earmark_commands(spark):
    frame, nodes = commands_input(spark, [
        (19.09, None, 0, "42"), (None, None, -19.09, "42"), (None, None, 19.09, "42")])
    split = earmark_commands(frame, nodes, "reply")
    rows = {r["process_id"]: r["command"] for r in split.commands.collect()}
    put, release = rows["p1"]["accounting_info"], rows["p2"]["accounting_info"]
    assert (put["debit_account"]["account_id"], put["debit_balance_update"]) == ("42", "AVAILABLE")
    assert (put["credit_account"]["account_id"], put["credit_balance_update"]) == ("foo", "NONE")
    assert rows["p1"]["transaction_info"]["transaction_type"] == "DEBIT"
    assert (release["debit_account"]["account_id"], release["debit_balance_update"]) == ("foo", "NONE")
    assert (release["credit_account"]["account_id"], release["credit_balance_update"]) == (
        "42", "AVAILABLE")
    assert rows["p2"]["transaction_info"]["amount"] == Decimal("19.09")
    assert '"process_id":"p2"' in rows["p2"]["transaction_info"]["data"]
    assert rows["p1"]["transaction_info"]["id"] != rows["p2"]["transaction_info"]["id"]
    assert [r["process_id"] for r in split.completed.collect()] == ["p0"]


# message date, client, earmark, prior date, authorisation earmark, revert, daily, annual
SPEND = [
    ("2015-09-19", None, -9, "2015-09-19", None, False, 28, 2024),
    ("2015-09-19", None, -9, "2015-09-18", None, False, 9, 2024),
    ("2015-09-19", None, -9, "2014-09-18", None, False, 9, 9),
    ("2015-09-19", None, -9, None, None, False, 9, 9),
    ("2015-09-18", -9, None, "2015-09-19", None, False, 19, 2024),
    ("2014-09-19", -9, None, "2015-09-19", None, False, 19, 2015),
    ("2014-09-19", -9, None, "2015-09-18", None, False, 0, 2015),
    ("2014-09-19", -9, None, "2014-09-19", None, False, 0, 0),
    ("2015-09-19", -9, None, "2015-09-19", 9, False, 19, 2015),
    ("2015-09-19", -9, None, "2015-09-19", 19, False, 9, 2005),
    ("2015-09-19", -9, None, "2015-09-19", -3, False, 25, 2021),
    ("2015-09-19", -9, 19, "2015-09-19", -19, False, 19, 2015),
    ("2015-09-19", None, 9, "2015-09-19", None, True, 10, 2006),
    ("2015-09-18", None, 9, "2015-09-19", None, True, 19, 2006),
    # an online settlement above the block takes the block off twice
    ("2015-09-19", -25, 19, "2015-09-19", -19, False, 6, 2002),
]


def test_spend_totals_vectors(spark):
    rows, prior, history = [], [], []
    for n, (day, client, earmark, last, auth, revert, _, _) in enumerate(SPEND):
        kind = "PRESENTMENT" if client is not None else "AUTHORISATION"
        rows.append((f"c{n}", "POS", f"t{n}", kind, None if revert or client is not None else "00",
                     "Y" if revert else "N", money(client), money(earmark), f"{day} 19:09:42"))
        if last:
            prior.append((f"c{n}", "POS", money(19), money(2015), f"{last} 01:00:00"))
        if auth is not None:
            history.append((f"t{n}", "AUTHORISATION", "m", money(auth), 1))
    processed = spark.createDataFrame(
        rows, "debit_card_id string, spend_group string, transaction_id string, message_type string,"
        " response_status string, authorised_by_gps string, client_amount decimal(18,2),"
        " earmark_amount decimal(18,2), at string").withColumns({
            "transaction_timestamp": F.col("at").cast("timestamp_ntz"),
            "processed_at": F.lit("2015-09-19 21:15:20").cast("timestamp_ntz")})
    totals = spark.createDataFrame(
        prior, "debit_card_id string, total_type string, daily_total decimal(18,2),"
        " annual_total decimal(18,2), at string").withColumn(
            "timestamp", F.col("at").cast("timestamp_ntz")).drop("at")
    past = spark.createDataFrame(
        history, "transaction_id string, message_type string, provider_message_id string,"
        " earmark_amount decimal(18,2), timestamp int")
    out = {r["debit_card_id"]: r for r in total_spend_update(processed, totals, past).collect()}
    for n, (*_, daily, annual) in enumerate(SPEND):
        row = out[f"c{n}"]
        assert (row["daily_total"], row["annual_total"]) == (money(daily), money(annual)), n


@pytest.mark.parametrize("kind,status,client,gps,action", [
    ("AUTHORISATION", "00", None, None, "recalculate"), ("AUTHORISATION", "51", None, None, "none"),
    ("PRESENTMENT", None, -19.09, None, "recalculate"), ("PRESENTMENT", None, 19.09, None, "none"),
    ("AUTHORISATION", None, None, "y", "revert"), ("AUTHORISATION", "00", None, "Y", "recalculate"),
])
def test_spend_dispatch(spark, kind, status, client, gps, action):
    row = spark.createDataFrame(
        [(kind, status, money(client), gps)],
        "kind string, status string, client decimal(18,2), gps string").select(
        spend_action(F.col("kind"), F.col("status"), F.col("client"), F.col("gps")).alias("a")).first()
    assert row["a"] == action


def test_matching_tags(spark):
    request = {"token": "tk", "trans_link": "tl", "traceid_lifecycle": "ti", "auth_code_de38": "ac",
               "acquirer_reference_data_031": "ar", "txn_ccy": "975", "pos_time_de12": "pt",
               "ret_ref_no_de37": "rr"}
    schema = f"transaction_id string, request struct<{', '.join(f'{f.name}:string' for f in MESSAGE)}>"
    full = tuple(request.get(f.name) for f in MESSAGE)
    frame = spark.createDataFrame([("foo", full), (None, full), ("x", None)], schema)
    rows = matching_index(frame.withColumn("timestamp", F.lit(1))).collect()
    sets = {r["tag_set"]: set(r["tags"]) for r in rows if r["error"] is None}
    assert sets == {
        1: {"traceid_lifecycle"}, 2: {"trans_link"},
        3: {"traceid_lifecycle", "trans_link", "auth_code_de38"}, 4: {"trans_link", "auth_code_de38"},
        5: {"traceid_lifecycle", "auth_code_de38"}, 6: {"traceid_lifecycle", "trans_link"},
        7: {"acquirer_reference_data_031", "txn_ccy", "auth_code_de38", "pos_time_de12",
            "ret_ref_no_de37"},
        8: {"acquirer_reference_data_031", "auth_code_de38", "trans_link"}}
    assert all(r["transaction_id"] == "foo" for r in rows if r["error"] is None)
    assert sum(r["error"] == "not_indexable" for r in rows) == 2
