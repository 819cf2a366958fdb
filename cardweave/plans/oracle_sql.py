"""SQL of the same results, for an independent engine over the same tables.

Written from the rules and not from the Spark code: life cycles and spend totals
are recursive queries that carry one state from message to message.
"""

from __future__ import annotations

M = "CAST({} AS DECIMAL(18,2))"
ZERO = "CAST(0 AS DECIMAL(18,2))"


def _with(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


# --- derived tables ------------------------------------------------------------------

_CARD = """
  CAST(o_orderkey AS VARCHAR) AS transaction_id, 'P-' || o_orderkey AS provider_transaction_id,
  'C-' || o_custkey AS debit_card_id, 'TK-' || o_custkey AS card_token,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'ECOM' ELSE 'POS' END AS spend_group,
  'GBP' AS settlement_currency,
  CASE WHEN o_orderpriority <> '5-LOW' THEN 'ACC-' || o_custkey END AS linked_account_id,
  CASE WHEN o_orderpriority <> '5-LOW' THEN 'EUR' END AS linked_account_currency,
  '826' AS txn_ccy, strftime(o_orderdate, '%Y%m%d') AS pos_time_de12,
  'R-' || o_custkey AS ret_ref_no_de37"""

_ORDER_TAGS = """
  'T-' || o_orderkey AS traceid_lifecycle, 'L-' || o_orderkey AS trans_link,
  lpad(CAST(o_custkey % 1000 AS VARCHAR), 6, '0') AS auth_code_de38,
  'AR-' || o_custkey AS acquirer_reference_data_031"""

_LINE_TAGS = """
  CASE WHEN l_returnflag <> 'R' THEN 'T-' || o_orderkey END AS traceid_lifecycle,
  CASE WHEN l_returnflag <> 'A' THEN 'L-' || o_orderkey END AS trans_link,
  CASE WHEN l_tax > 0.02 THEN lpad(CAST(o_custkey % 1000 AS VARCHAR), 6, '0') END AS auth_code_de38,
  CASE WHEN l_linestatus = 'F' THEN 'AR-' || o_custkey END AS acquirer_reference_data_031"""

MESSAGES = f"""
kinds(job, message_type, type_rank) AS (VALUES
  ('presentment', 'PRESENTMENT', 4), ('authorisation_reversal', 'AUTH_REVERSAL', 3),
  ('second_presentment', 'SEC_PRESENTMENT', 7), ('financial_reversal', 'FINANCIAL_REVERSAL', 5),
  ('chargeback', 'CHARGEBACK', 6), ('chargeback_non_credit', 'CHARGEBACK_NON_CREDIT', 8)),
auths AS (
  SELECT 'authorisation' AS job, 'AUTHORISATION' AS message_type, 1 AS type_rank,
    'A-' || o_orderkey AS process_id, 'A-' || o_orderkey AS provider_message_id,
    -{M.format('o_totalprice')} AS settlement_amount, o_orderdate AS transaction_date_time,
    CASE WHEN o_orderstatus = 'P' THEN '51' ELSE '00' END AS response_status,
    CAST(NULL AS VARCHAR) AS txn_stat_code, 'A' AS txn_type, '0100' AS mtid,
    {_ORDER_TAGS}, {_CARD} FROM orders),
exts AS (
  SELECT 'externally_authorised' AS job, 'AUTHORISATION' AS message_type, 2 AS type_rank,
    'X-' || o_orderkey AS process_id, 'X-' || o_orderkey AS provider_message_id,
    -{M.format('o_totalprice')} AS settlement_amount,
    o_orderdate + INTERVAL 1 DAY AS transaction_date_time, CAST(NULL AS VARCHAR) AS response_status,
    CASE WHEN o_orderpriority < '4' THEN 'i' ELSE 'A' END AS txn_stat_code,
    'J' AS txn_type, '0100' AS mtid,
    {_ORDER_TAGS}, {_CARD} FROM orders WHERE o_orderstatus = 'F'),
priced AS (
  SELECT *, CASE l_returnflag || l_linestatus
      WHEN 'AF' THEN 'authorisation_reversal' WHEN 'AO' THEN 'second_presentment'
      WHEN 'RF' THEN 'financial_reversal'
      WHEN 'RO' THEN CASE WHEN l_tax = 0 THEN 'chargeback_non_credit' ELSE 'chargeback' END
      ELSE 'presentment' END AS job, {M.format('l_extendedprice')} AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
lines AS (
  SELECT job, message_type, type_rank,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS process_id,
    concat_ws('-', l_orderkey, l_linenumber) AS provider_message_id,
    CASE WHEN job IN ('presentment', 'second_presentment') THEN -price
         WHEN job = 'chargeback_non_credit' AND l_discount < 0.05 THEN {ZERO}
         ELSE price END AS settlement_amount,
    l_shipdate AS transaction_date_time, CAST(NULL AS VARCHAR) AS response_status,
    CAST(NULL AS VARCHAR) AS txn_stat_code, l_returnflag AS txn_type, '1240' AS mtid,
    {_LINE_TAGS}, {_CARD}
  FROM priced JOIN kinds USING (job)),
messages AS (
  SELECT * FROM auths UNION ALL BY NAME SELECT * FROM exts UNION ALL BY NAME SELECT * FROM lines)"""

LINKED = """
linked AS (
  SELECT 'C-' || c_custkey AS debit_card_id, 'ACC-' || c_custkey || '-' || n AS account_id,
    CASE n WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' ELSE 'PLN' END AS account_currency,
    TIMESTAMP '1996-01-01' + to_days(CAST(700 * n + c_custkey % 400 AS INTEGER)) AS from_timestamp
  FROM customer, (VALUES (0), (1), (2)) t(n))"""

SETTINGS = f"""
settings AS (
  SELECT 'C-' || c_custkey AS debit_card_id, 'ACC-' || c_custkey AS account_id,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN 'BLOCKED' ELSE 'ACTIVE' END AS card_status,
    c_mktsegment, {M.format(M.format('c_acctbal') + ' * 50 + 200000')} AS daily_limit,
    {M.format(M.format('c_acctbal') + ' * 100 + 900000')} AS annual_limit,
    {M.format(M.format('c_acctbal') + ' * 60')} AS available
  FROM customer),
snapshot AS (
  SELECT 'C-' || c_custkey AS debit_card_id, g AS spend_group,
    abs({M.format('c_acctbal')}) AS daily_total,
    {M.format('abs(' + M.format('c_acctbal') + ') * 10')} AS annual_total,
    TIMESTAMP '2000-06-15 12:00:00' - CASE c_mktsegment WHEN 'BUILDING' THEN INTERVAL 1 DAY
      WHEN 'HOUSEHOLD' THEN INTERVAL 400 DAY ELSE INTERVAL 1 HOUR END AS stored_at
  FROM customer, (VALUES ('POS'), ('ECOM')) t(g))"""

EVENTS = f"""
spend AS (
  SELECT event_id, 'E-' || event_id AS process_id, 'U-' || user_id AS debit_card_id,
    CASE WHEN event_id % 2 = 0 THEN 'POS' ELSE 'ECOM' END AS spend_group,
    user_id || '-' || strftime(ts, '%Y%m%d') AS transaction_id,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'AUTHORISATION' ELSE 'PRESENTMENT' END
      AS message_type, event_type,
    CASE event_type WHEN 'click' THEN -{M.format('value')} WHEN 'view' THEN {M.format('value')} END
      AS client,
    CASE event_type WHEN 'purchase' THEN -{M.format('value')} WHEN 'signup'
      THEN {M.format('value')} END AS earmark,
    ts, CASE WHEN event_id % 7 = 0 THEN ts + INTERVAL 2 DAY ELSE ts END AS processed_at,
    CASE event_type WHEN 'purchase' THEN 'recalculate' WHEN 'click' THEN
      CASE WHEN -{M.format('value')} < 0 THEN 'recalculate' ELSE 'none' END
      WHEN 'signup' THEN 'revert' ELSE 'none' END AS action
  FROM events WHERE event_type <> 'error'),
stored AS (
  SELECT 'U-' || c_custkey AS debit_card_id, g AS spend_group,
    abs({M.format('c_acctbal')}) AS daily_total,
    {M.format('abs(' + M.format('c_acctbal') + ') * 10')} AS annual_total,
    TIMESTAMP '2024-01-01' - CASE c_mktsegment WHEN 'BUILDING' THEN INTERVAL 1 DAY
      WHEN 'HOUSEHOLD' THEN INTERVAL 400 DAY ELSE INTERVAL 0 DAY END AS stored_at
  FROM customer, (VALUES ('POS'), ('ECOM')) t(g))"""

NODES = """
nodes AS (
  SELECT 'ACC-' || c_custkey AS account_id, 'node-' || r_regionkey AS node_id,
    'GPS-' || r_regionkey AS gps_account_id,
    'node.' || lower(replace(r_name, ' ', '-')) || '.commands' AS topic
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
slots AS (
  SELECT row_number() OVER (ORDER BY node_id, topic) - 1 AS slot, count(*) OVER () AS n, *
  FROM (SELECT DISTINCT node_id, gps_account_id, topic FROM nodes)),
placed AS (
  SELECT p.*, coalesce(o.node_id, s.node_id) AS node_id,
    coalesce(o.gps_account_id, s.gps_account_id) AS gps, coalesce(o.topic, s.topic) AS topic
  FROM processed p LEFT JOIN nodes o ON o.account_id = p.linked_account_id
  LEFT JOIN slots s ON p.linked_account_id IS NULL
    AND s.slot = CAST('0x' || substr(md5(p.process_id), 1, 8) AS BIGINT) % s.n)"""

_MOVING = "job IN ('presentment', 'financial_reversal', 'chargeback', 'second_presentment')"

PROCESSED = f"""
processed AS (
  SELECT *, CASE WHEN {_MOVING} THEN settlement_amount END AS client,
    CASE WHEN job = 'second_presentment' AND spend_group = 'ECOM' THEN NULL
         WHEN {_MOVING} THEN -settlement_amount END AS wirecard,
    CASE WHEN job = 'authorisation' AND response_status = '00' THEN settlement_amount
         WHEN job = 'authorisation_reversal' THEN settlement_amount
         WHEN job = 'presentment' THEN {ZERO} END AS earmark
  FROM messages)"""


def history(without_job: str = "", until: str = "9999-01-01") -> str:
    return f"""
hist AS (
  SELECT transaction_id, provider_message_id, message_type, type_rank, process_id,
    transaction_date_time AS ts, linked_account_id AS acct, linked_account_currency AS acctc,
    CASE message_type WHEN 'AUTHORISATION' THEN settlement_amount
      WHEN 'AUTH_REVERSAL' THEN -settlement_amount WHEN 'FINANCIAL_REVERSAL' THEN NULL
      ELSE {ZERO} END AS e,
    CASE WHEN message_type IN ('AUTHORISATION', 'AUTH_REVERSAL') THEN {ZERO}
      WHEN message_type <> 'CHARGEBACK_NON_CREDIT' THEN settlement_amount END AS c,
    CASE WHEN message_type IN ('AUTHORISATION', 'AUTH_REVERSAL') THEN {ZERO}
      WHEN message_type <> 'CHARGEBACK_NON_CREDIT' THEN -settlement_amount END AS w,
    'GBP' AS wc, 'EUR' AS cc, 'EUR' AS ec
  FROM messages WHERE job <> '{without_job}' AND transaction_date_time < TIMESTAMP '{until}'),
newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
    ORDER BY ts DESC, type_rank DESC, process_id DESC) AS pos FROM hist) WHERE pos = 1),
kinds_seen AS (
  SELECT transaction_id, list(DISTINCT message_type) AS types FROM hist GROUP BY 1)"""


# tag sets in stored order with their priority (0 best)
_SETS = {
    1: (6, "traceid_lifecycle"), 2: (7, "trans_link"),
    3: (1, "traceid_lifecycle trans_link auth_code_de38"), 4: (3, "trans_link auth_code_de38"),
    5: (4, "traceid_lifecycle auth_code_de38"), 6: (5, "traceid_lifecycle trans_link"),
    7: (0, "acquirer_reference_data_031 txn_ccy auth_code_de38 pos_time_de12 ret_ref_no_de37"),
    8: (2, "acquirer_reference_data_031 auth_code_de38 trans_link"),
}


def tag_rows(name: str, source: str) -> str:
    parts = []
    for number, (priority, names) in _SETS.items():
        fields = names.split()
        tags = " || ';' || ".join(f"'{f}=' || {f}" for f in fields)
        sized = " || ".join(f"length({f}) || ':' || {f}" for f in fields)
        full = " AND ".join(f"{f} IS NOT NULL" for f in fields)
        parts.append(
            f"SELECT process_id, transaction_id, card_token, transaction_date_time AS ts, type_rank,"
            f" provider_message_id AS message_id,"
            f" {number} AS tag_set, {priority} AS priority,"
            f" {sized} AS signature, {tags} AS tags"
            f" FROM {source} WHERE {full}")
    return f"{name} AS ({' UNION ALL '.join(parts)})"


def best_match(index: str, wanted: str, earlier: bool = False) -> str:
    """CTEs ending in best(process_id, matched_id)."""
    before = ("AND (i.ts, i.type_rank, i.message_id, i.process_id)"
              " < (w.ts, w.type_rank, w.message_id, w.process_id)" if earlier else "")
    then = "i.message_id DESC, " if earlier else ""
    return f"""
hits_{wanted} AS (
  SELECT w.process_id, w.priority, i.transaction_id,
    row_number() OVER (PARTITION BY w.process_id ORDER BY w.priority, i.ts DESC, i.type_rank DESC,
      {then}i.process_id DESC, i.transaction_id DESC) AS pos
  FROM {wanted} w JOIN {index} i ON i.card_token = w.card_token AND i.tag_set = w.tag_set
    AND i.signature = w.signature {before}),
best_{wanted} AS (
  SELECT process_id, transaction_id AS matched_id FROM hits_{wanted} WHERE pos = 1)"""


# --- rules of the request jobs ---------------------------------------------------------

_FIN = "job IN ('chargeback', 'second_presentment', 'financial_reversal')"
_ORDERED = """(CASE message_type WHEN 'AUTH_REVERSAL' THEN list_contains(types, 'AUTHORISATION')
  WHEN 'FINANCIAL_REVERSAL' THEN list_contains(types, 'PRESENTMENT')
  WHEN 'CHARGEBACK' THEN list_contains(types, 'PRESENTMENT')
  WHEN 'SEC_PRESENTMENT' THEN list_contains(types, 'CHARGEBACK') ELSE true END)"""

BRANCH = f"""CASE
  WHEN {_FIN} THEN CASE WHEN NOT has THEN 'E:empty_history' WHEN dup THEN 'duplicate'
    WHEN NOT {_ORDERED} THEN 'E:invalid_order' ELSE 'processed' END
  WHEN job = 'authorisation_reversal' THEN CASE WHEN NOT has THEN 'E:empty_history'
    WHEN dup THEN 'duplicate' WHEN NOT {_ORDERED} THEN 'E:invalid_order'
    WHEN e IS NULL THEN 'E:missing_last_earmark' WHEN s > abs(e) THEN 'E:reversal_exceeds_earmark'
    ELSE 'processed' END
  WHEN job = 'externally_authorised' THEN CASE
    WHEN lower(coalesce(stat, '')) <> 'i' THEN 'E:not_declined_externally'
    WHEN NOT has THEN 'no_change' WHEN e IS NULL THEN 'E:missing_last_earmark'
    WHEN e >= 0 THEN 'no_change' WHEN s <> e THEN 'E:settlement_differs_from_earmark'
    ELSE 'processed' END
  WHEN job = 'presentment' THEN CASE WHEN has AND dup THEN 'duplicate'
    WHEN has AND (c IS NULL OR w IS NULL) THEN 'E:missing_last_ledger' WHEN has THEN 'online'
    WHEN linked IS NULL THEN 'E:no_linked_account' ELSE 'offline' END
  WHEN job = 'chargeback_non_credit' THEN CASE WHEN s <> 0 THEN 'E:non_zero_settlement'
    WHEN NOT has THEN 'E:empty_history' ELSE 'processed' END
  ELSE CASE WHEN has AND dup THEN 'duplicate' WHEN status = '00' THEN 'accepted' ELSE 'declined' END END"""

_UNDO = "b = 'processed' AND job IN ('authorisation_reversal', 'externally_authorised')"
_SETTLE = "b IN ('online', 'offline')"
_REPLY = "b IN ('accepted', 'declined')"
_AUTHC = "coalesce(acctc, linkedc)"
_LASTC = f"CASE WHEN b = 'offline' THEN linkedc WHEN {_REPLY} THEN {_AUTHC} ELSE acctc END"

FIELDS = {
    "wirecard_amount": f"CASE WHEN {_SETTLE} OR (b = 'processed' AND {_FIN}) THEN -s END",
    "wirecard_currency": f"CASE WHEN {_SETTLE} OR (b = 'processed' AND {_FIN}) THEN sc END",
    "client_amount": f"CASE WHEN {_SETTLE} OR (b = 'processed' AND {_FIN}) THEN s END",
    "client_currency": f"CASE WHEN {_SETTLE} OR (b = 'processed' AND {_FIN}) THEN {_LASTC} END",
    "earmark_amount": f"""CASE WHEN b = 'accepted' THEN s WHEN b = 'offline' THEN {ZERO}
        WHEN b = 'online' THEN abs(coalesce(e, 0)) WHEN {_UNDO} THEN abs(s) END""",
    "earmark_currency": f"CASE WHEN b = 'accepted' OR {_SETTLE} OR {_UNDO} THEN {_LASTC} END",
    "total_wirecard_amount": f"""CASE WHEN b = 'duplicate' OR {_UNDO} THEN w
        WHEN b = 'online' THEN w - s WHEN b = 'offline' THEN -s
        WHEN b = 'processed' AND {_FIN} THEN coalesce(w, 0) - s
        WHEN b = 'processed' OR {_REPLY} THEN coalesce(w, 0) END""",
    "total_wirecard_currency": f"""CASE WHEN b = 'duplicate' THEN wc WHEN {_REPLY} THEN coalesce(wc, sc)
        WHEN b <> 'no_change' AND b NOT LIKE 'E:%' THEN sc END""",
    "total_client_amount": f"""CASE WHEN b = 'duplicate' OR {_UNDO} THEN c
        WHEN b = 'online' THEN c + s WHEN b = 'offline' THEN s
        WHEN b = 'processed' AND {_FIN} THEN coalesce(c, 0) + s
        WHEN b = 'processed' OR {_REPLY} THEN coalesce(c, 0) END""",
    "total_client_currency": f"""CASE WHEN b = 'duplicate' OR {_UNDO} THEN cc
        WHEN {_REPLY} THEN coalesce(cc, {_AUTHC})
        WHEN b <> 'no_change' AND b NOT LIKE 'E:%' THEN {_LASTC} END""",
    "total_earmark_amount": f"""CASE WHEN b = 'accepted' THEN coalesce(e, 0) + s
        WHEN {_UNDO} THEN e + abs(s) WHEN b = 'offline' THEN {ZERO}
        WHEN b = 'online' THEN coalesce(e, 0) + abs(coalesce(e, 0))
        WHEN b IN ('duplicate', 'processed', 'declined') THEN coalesce(e, 0) END""",
    "total_earmark_currency": f"""CASE WHEN b = 'duplicate' THEN ec
        WHEN b <> 'no_change' AND b NOT LIKE 'E:%' THEN {_LASTC} END""",
    "internal_account_id": f"""CASE WHEN b = 'offline' THEN linked WHEN {_REPLY} THEN coalesce(acct, linked)
        WHEN b <> 'no_change' AND b NOT LIKE 'E:%' AND job <> 'chargeback_non_credit' THEN acct END""",
    "internal_account_currency": f"""CASE WHEN b <> 'no_change' AND b NOT LIKE 'E:%'
        AND job <> 'chargeback_non_credit' THEN {_LASTC} END""",
}


def _typed(name: str) -> str:
    kind = "DECIMAL(18,2)" if name.endswith("_amount") else "VARCHAR"
    return f"CAST({FIELDS[name]} AS {kind}) AS {name}"


RESULT = f"""process_id, transaction_id, message_type,
  CASE WHEN b LIKE 'E:%' THEN substr(b, 3) END AS error,
  CASE WHEN b NOT LIKE 'E:%' THEN b END AS outcome,
  {", ".join(_typed(n) for n in FIELDS)}"""

REQUEST = """process_id, transaction_id, message_type, job, settlement_amount AS s,
  settlement_currency AS sc, response_status AS status, txn_stat_code AS stat, provider_message_id"""


def one_shot(source: str, check_duplicates: bool, extra: str = "") -> str:
    """SELECT of the results of requests in ``source`` against hist."""
    dup = ("EXISTS (SELECT 1 FROM hist h WHERE h.transaction_id = r.transaction_id"
           " AND h.provider_message_id = r.provider_message_id)" if check_duplicates else "false")
    return f"""
SELECT {RESULT}{extra} FROM (SELECT *, {BRANCH} AS b FROM (
  SELECT r.*, n.transaction_id IS NOT NULL AS has, {dup} AS dup, n.w, n.c, n.e, n.wc, n.cc, n.ec,
    n.acct, n.acctc, coalesce(k.types, []) AS types
  FROM {source} r LEFT JOIN newest n ON n.transaction_id = r.transaction_id
  LEFT JOIN kinds_seen k ON k.transaction_id = r.transaction_id))"""


def job(name: str, check_duplicates: bool = True) -> str:
    return _with(MESSAGES, history(name), f"""
requests AS (
  SELECT {REQUEST}, linked_account_id AS linked, linked_account_currency AS linkedc
  FROM messages WHERE job = '{name}')""") + one_shot("requests", check_duplicates)


def replay_ctes(source: str, by_amount: str = " settlement_amount,") -> str:
    """Recursive CTE ``st`` with one row per message of ``source``."""
    state = ("transaction_id, rn, process_id, message_type, has, w, c, e, wc, cc, ec, acct, acctc,"
             " seen, types, b, " + ", ".join(FIELDS))
    ok = "b NOT LIKE 'E:%'"
    nulls = ", ".join(
        f"CAST(NULL AS {'DECIMAL(18,2)' if n.endswith('_amount') else 'VARCHAR'})" for n in FIELDS)
    carried = {
        "w": "total_wirecard_amount", "c": "total_client_amount", "e": "total_earmark_amount",
        "wc": "total_wirecard_currency", "cc": "total_client_currency",
        "ec": "total_earmark_currency", "acct": "internal_account_id",
        "acctc": "internal_account_currency"}
    moved = ", ".join(f"CASE WHEN {ok} THEN {new} ELSE {old} END" for old, new in carried.items())
    return f"""
ordered AS (
  SELECT {REQUEST}, linked_account_id AS linked, linked_account_currency AS linkedc,
    row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_date_time, type_rank,
      provider_message_id,{by_amount} process_id) AS rn
  FROM {source}),
st({state}) AS (
  SELECT DISTINCT transaction_id, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
    false, CAST(NULL AS DECIMAL(18,2)), CAST(NULL AS DECIMAL(18,2)), CAST(NULL AS DECIMAL(18,2)),
    CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
    CAST(NULL AS VARCHAR), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), CAST(NULL AS VARCHAR), {nulls}
  FROM ordered
  UNION ALL
  SELECT transaction_id, rn, process_id, message_type, has OR {ok}, {moved},
    CASE WHEN {ok} THEN list_append(seen, provider_message_id) ELSE seen END,
    CASE WHEN {ok} THEN list_append(types, message_type) ELSE types END, b, {", ".join(FIELDS)}
  FROM (SELECT *, {", ".join(_typed(n) for n in FIELDS)} FROM (SELECT *, {BRANCH} AS b FROM (
    SELECT o.*, st.has, st.w, st.c, st.e, st.wc, st.cc, st.ec, st.acct, st.acctc, st.seen, st.types,
      list_contains(st.seen, o.provider_message_id) AS dup
    FROM st JOIN ordered o ON o.transaction_id = st.transaction_id AND o.rn = st.rn + 1))))"""


REPLAYED = f"""process_id, transaction_id, message_type,
  CASE WHEN b LIKE 'E:%' THEN substr(b, 3) END AS error,
  CASE WHEN b NOT LIKE 'E:%' THEN b END AS outcome, {", ".join(FIELDS)}"""


# --- authorisation ---------------------------------------------------------------------

_AUTH_REQUESTS = """
flagged AS (
  SELECT a.*, o_orderpriority AS merchant,
    o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AS enquiry,
    o_orderstatus = 'O' AND o_orderpriority IN ('2-HIGH', '3-MEDIUM') AS silent
  FROM auths a JOIN orders ON a.transaction_id = CAST(o_orderkey AS VARCHAR))"""

CHECKED = """
enriched AS (
  SELECT f.*, b.matched_id, coalesce(b.matched_id, f.process_id) AS tx, f.enquiry OR f.silent AS gated,
    s.card_status, s.c_mktsegment, s.daily_limit, s.annual_limit, s.account_id AS own_account,
    CASE WHEN NOT silent THEN s.available END AS available,
    t.daily_total, t.annual_total, t.stored_at
  FROM flagged f
  LEFT JOIN best_wanted b ON b.process_id = f.process_id AND NOT (f.enquiry OR f.silent)
  LEFT JOIN settings s ON s.debit_card_id = f.debit_card_id
  LEFT JOIN snapshot t ON t.debit_card_id = f.debit_card_id AND t.spend_group = f.spend_group
    AND NOT (f.enquiry OR f.silent)),
checked AS (
  SELECT *, card_status = 'ACTIVE' AS v1,
    CASE WHEN NOT gated THEN c_mktsegment <> 'MACHINERY' OR spend_group = 'POS' END AS v2,
    CASE WHEN NOT gated THEN NOT (c_mktsegment = 'BUILDING' AND merchant = '5-LOW') END AS v3,
    CASE WHEN NOT gated THEN
      CASE WHEN CAST(stored_at AS DATE) = CAST(transaction_date_time AS DATE) THEN daily_total
        ELSE 0 END + abs(settlement_amount) <= daily_limit AND
      CASE WHEN year(stored_at) = year(transaction_date_time) THEN annual_total ELSE 0 END
        + abs(settlement_amount) <= annual_limit END AS v4,
    CASE WHEN NOT gated THEN settlement_amount >= 0 OR abs(settlement_amount) <= available END AS v5
  FROM enriched),
answered AS (
  SELECT * EXCLUDE (response_status), CASE WHEN NOT v1 THEN '62' WHEN NOT v2 THEN '57'
    WHEN NOT v3 THEN '57' WHEN NOT v4 THEN '61' WHEN NOT v5 THEN '51' ELSE '00' END
    AS response_status FROM checked)"""


def _auth_match() -> list[str]:
    return [MESSAGES, SETTINGS, _AUTH_REQUESTS, tag_rows("idx", "messages"), "open_auths AS (SELECT * FROM flagged WHERE NOT enquiry"
            " AND NOT silent)", tag_rows("wanted", "open_auths"), best_match("idx", "wanted")]


# --- spend -----------------------------------------------------------------------------

_FIRST_AUTH = """
newest_auth AS (
  SELECT transaction_id, process_id, earmark FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY processed_at DESC,
      event_id DESC) AS pos FROM spend WHERE message_type = 'AUTHORISATION') WHERE pos = 1)"""

_TODAY = "CAST(ts AS DATE) = CAST(processed_at AS DATE)"
_THIS_YEAR = "year(ts) = year(processed_at)"
_X = "coalesce(client, 0) + coalesce(earmark, 0)"


def _next_total(total: str, same: str) -> str:
    return f"""CASE WHEN action = 'recalculate' AND {_X} < 0 AND {same}
      THEN {total} + abs({_X}) - coalesce(abs(auth), 0)
      WHEN action = 'revert' AND earmark > 0 AND {same} THEN {total} - earmark ELSE {total} END"""


SPEND_TOTALS = _with(EVENTS, """
with_auth AS (
  SELECT s.*, CASE WHEN message_type = 'PRESENTMENT' THEN last_value(
      CASE WHEN message_type = 'AUTHORISATION' THEN earmark END IGNORE NULLS) OVER (
      PARTITION BY transaction_id ORDER BY processed_at, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS auth FROM spend s)""", """
steps AS (
  SELECT *, row_number() OVER (PARTITION BY debit_card_id, spend_group
    ORDER BY processed_at, event_id) AS rn FROM with_auth WHERE action <> 'none')""", f"""
run(debit_card_id, spend_group, rn, event_id, action, daily, annual, moment) AS (
  SELECT DISTINCT k.debit_card_id, k.spend_group, CAST(0 AS BIGINT), CAST(NULL AS BIGINT),
    CAST(NULL AS VARCHAR), CAST(p.daily_total AS DECIMAL(18,2)),
    CAST(p.annual_total AS DECIMAL(18,2)), p.stored_at
  FROM steps k LEFT JOIN stored p USING (debit_card_id, spend_group)
  UNION ALL
  SELECT debit_card_id, spend_group, rn, event_id, action,
    CAST({_next_total('d0', _TODAY)} AS DECIMAL(18,2)),
    CAST({_next_total('a0', _THIS_YEAR)} AS DECIMAL(18,2)), processed_at
  FROM (SELECT s.*,
      CASE WHEN CAST(r.moment AS DATE) = CAST(s.processed_at AS DATE) THEN r.daily ELSE {ZERO} END AS d0,
      CASE WHEN year(r.moment) = year(s.processed_at) THEN r.annual ELSE {ZERO} END AS a0
    FROM run r JOIN steps s ON s.debit_card_id = r.debit_card_id AND s.spend_group = r.spend_group
      AND s.rn = r.rn + 1))""", recursive=True) + """
SELECT event_id, debit_card_id, spend_group, action, daily AS daily_total, annual AS annual_total,
  moment AS processed_at FROM run WHERE rn > 0"""


# --- commands --------------------------------------------------------------------------

_TAGS = """'transaction_id=' || transaction_id || ';process_id=' || process_id || ';message_type='
  || message_type || ';auth_code_de38=' || coalesce(auth_code_de38, '') || ';ret_ref_no_de37='
  || ret_ref_no_de37 || ';trans_link=' || coalesce(trans_link, '') || ';txn_id='
  || provider_message_id || ';txn_type=' || txn_type || ';message_type_id=' || mtid
  || ';processing_code=000000'"""


def _command(debit: str, amount: str, client_update: str, scheme_update: str, command_id: str,
             reply: str, more: str, where: str) -> str:
    def pick(a: str, b: str) -> str:
        return f"CASE WHEN {debit} THEN {a} ELSE {b} END"

    return _with(MESSAGES, PROCESSED, NODES) + f"""
SELECT process_id, 'ACCOUNTING_COMMAND_RECEIVED' AS command_name, {command_id} AS command_key, topic,
  'CARDS_GPS' AS entry_origin, {pick('linked_account_id', 'gps')} AS debit_account,
  {pick(f"'{client_update}'", f"'{scheme_update}'")} AS debit_balance_update,
  {pick('gps', 'linked_account_id')} AS credit_account,
  {pick(f"'{scheme_update}'", f"'{client_update}'")} AS credit_balance_update,
  abs({amount}) AS amount, 'EUR' AS currency, {command_id} AS id, 'INTERNAL' AS direction,
  {pick("'DEBIT'", "'CREDIT'")} AS transaction_type, {_TAGS} AS tags,
  'reply-to' AS header_key, '{reply}' AS header_value{more}
FROM placed WHERE {where} AND topic IS NOT NULL"""


_NEEDS_ACCOUNTING = "(coalesce(client <> 0, false) OR coalesce(wirecard <> 0, false))"
_MIRRORED = "coalesce((client < 0 AND wirecard > 0) OR (client > 0 AND wirecard < 0), false)"

# --- end to end ------------------------------------------------------------------------

_MSG = """job, message_type, type_rank, process_id, provider_message_id, settlement_amount,
  settlement_currency, transaction_date_time, txn_stat_code, card_token, debit_card_id, spend_group,
  traceid_lifecycle, trans_link, auth_code_de38, acquirer_reference_data_031, txn_ccy,
  pos_time_de12, ret_ref_no_de37, provider_transaction_id"""


def _key(number: int) -> str:
    fields = _SETS[number][1].split()
    sized = " || ".join(f"length({f}) || ':' || {f}" for f in fields)
    full = " AND ".join(f"{f} IS NOT NULL" for f in fields)
    return f"CASE WHEN {full} THEN '{number}/' || {sized} END"


_KEYS = ", ".join(_key(n) for n in sorted(_SETS, key=lambda n: _SETS[n][0]))
_LEDGER = ("STRUCT(w DECIMAL(18,2), c DECIMAL(18,2), e DECIMAL(18,2), wc VARCHAR, cc VARCHAR, ec VARCHAR,"
           " acct VARCHAR, acctc VARCHAR, seen VARCHAR[], types VARCHAR[])")
_OK = "b NOT LIKE 'E:%'"
_NULLS = ", ".join(f"CAST(NULL AS {'DECIMAL(18,2)' if n.endswith('_amount') else 'VARCHAR'})" for n in FIELDS)

# one card at a time, message by message: what was stored under each key and for each transaction
FLOW = _with(
    *[MESSAGES, SETTINGS, LINKED, _AUTH_REQUESTS],
    "best_wanted AS (SELECT process_id, transaction_id AS matched_id FROM messages WHERE false)",
    CHECKED, f"""
prepared AS (
  SELECT {_MSG}, response_status, own_account AS linked_account_id, 'EUR' AS linked_account_currency,
    NOT gated AS asks FROM answered
  UNION ALL BY NAME
  SELECT {_MSG.replace('debit_card_id', 'm.debit_card_id')}, CAST(NULL AS VARCHAR) AS response_status,
    l.account_id AS linked_account_id, l.account_currency AS linked_account_currency, true AS asks
  FROM (SELECT * FROM messages WHERE job IN ('presentment', 'externally_authorised',
    'authorisation_reversal')) m
  ASOF LEFT JOIN linked l ON l.debit_card_id = m.debit_card_id
    AND m.transaction_date_time >= l.from_timestamp
  UNION ALL BY NAME
  SELECT {_MSG}, CAST(NULL AS VARCHAR) AS response_status, CAST(NULL AS VARCHAR) AS linked_account_id,
    CAST(NULL AS VARCHAR) AS linked_account_currency, true AS asks
  FROM messages WHERE job IN ('financial_reversal', 'chargeback', 'chargeback_non_credit',
    'second_presentment'))""", f"""
queue AS (
  SELECT *, list_filter([{_KEYS}], lambda k: k IS NOT NULL) AS keys,
    settlement_amount AS s, settlement_currency AS sc, response_status AS status, txn_stat_code AS stat,
    linked_account_id AS linked, linked_account_currency AS linkedc,
    row_number() OVER (PARTITION BY card_token ORDER BY transaction_date_time, type_rank,
      provider_message_id, process_id) AS rn
  FROM prepared)""", f"""
st(card_token, rn, process_id, transaction_id, known, ledgers, b, {", ".join(FIELDS)}) AS (
  SELECT DISTINCT card_token, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
    CAST(MAP {{}} AS MAP(VARCHAR, VARCHAR)), CAST(MAP {{}} AS MAP(VARCHAR, {_LEDGER})),
    CAST(NULL AS VARCHAR), {_NULLS} FROM queue
  UNION ALL
  SELECT card_token, rn, process_id, tx,
    CASE WHEN {_OK} AND len(keys) > 0 THEN map_concat(known,
      map_from_entries(list_transform(keys, lambda k: {{'k': k, 'v': tx}}))) ELSE known END,
    CASE WHEN {_OK} THEN map_concat(ledgers, CAST(MAP {{tx: {{'w': total_wirecard_amount,
      'c': total_client_amount, 'e': total_earmark_amount, 'wc': total_wirecard_currency,
      'cc': total_client_currency, 'ec': total_earmark_currency, 'acct': internal_account_id,
      'acctc': internal_account_currency, 'seen': list_append(seen, provider_message_id),
      'types': list_append(types, message_type)}}}} AS MAP(VARCHAR, {_LEDGER}))) ELSE ledgers END,
    b, {", ".join(FIELDS)}
  FROM (SELECT *, {", ".join(_typed(n) for n in FIELDS)} FROM (
    SELECT *, CASE WHEN tx IS NULL THEN 'E:no_matching_transaction' ELSE {BRANCH} END AS b FROM (
    SELECT *, z IS NOT NULL AS has, z.w AS w, z.c AS c, z.e AS e, z.wc AS wc, z.cc AS cc, z.ec AS ec,
      z.acct AS acct, z.acctc AS acctc, coalesce(z.seen, []) AS seen, coalesce(z.types, []) AS types,
      coalesce(list_contains(z.seen, provider_message_id), false) AS dup FROM (
    SELECT *, ledgers[tx] AS z FROM (
    SELECT *, coalesce(matched, CASE WHEN job IN ('authorisation', 'presentment') THEN process_id END) AS tx
    FROM (
    SELECT q.*, st.known, st.ledgers, CASE WHEN asks THEN list_filter(list_transform(q.keys,
      lambda k: st.known[k]), lambda t: t IS NOT NULL)[1] END AS matched
    FROM st JOIN queue q ON q.card_token = st.card_token AND q.rn = st.rn + 1)))))))""", f"""
done AS (
  SELECT {", ".join('q.' + c.strip() for c in _MSG.split(','))}, q.response_status, q.linked_account_id,
    st.transaction_id, st.b, {", ".join('st.' + n for n in FIELDS)}
  FROM st JOIN queue q ON q.card_token = st.card_token AND q.rn = st.rn)""", recursive=True)

END_TO_END = FLOW + f"""
SELECT process_id, CASE WHEN {_OK} THEN transaction_id END AS transaction_id,
  CASE WHEN {_OK} THEN message_type END AS message_type,
  CASE WHEN NOT {_OK} THEN substr(b, 3) END AS error,
  CASE WHEN {_OK} THEN b END AS outcome, {", ".join(FIELDS)}
FROM done"""


FLOW_HISTORY = FLOW + """
SELECT process_id, transaction_id, provider_message_id, provider_transaction_id, message_type, debit_card_id,
  internal_account_id, internal_account_currency, total_wirecard_amount AS wirecard_amount,
  total_wirecard_currency AS wirecard_currency, total_client_amount AS client_amount,
  total_client_currency AS client_currency, total_earmark_amount AS earmark_amount,
  total_earmark_currency AS earmark_currency
FROM done WHERE b NOT LIKE 'E:%'"""

FLOW_INDEX = FLOW + ", " + tag_rows("rows", "(SELECT * FROM done WHERE b NOT LIKE 'E:%')") + """
SELECT process_id, transaction_id, card_token, tag_set, signature, CAST(NULL AS VARCHAR) AS error FROM rows"""

_MOVED = "(coalesce(client_amount, 0) + coalesce(earmark_amount, 0))"

FLOW_SPEND = FLOW + f""", fine AS (
  SELECT *, CASE WHEN message_type = 'PRESENTMENT' THEN last_value(CASE WHEN message_type = 'AUTHORISATION'
      THEN {{'e': total_earmark_amount}} END IGNORE NULLS) OVER (PARTITION BY transaction_id
      ORDER BY transaction_date_time, type_rank, provider_message_id, process_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS auth
  FROM done WHERE b NOT LIKE 'E:%'),
acted AS (
  SELECT *, CASE WHEN message_type = 'AUTHORISATION' AND coalesce(response_status = '00', false)
      OR message_type = 'PRESENTMENT' AND coalesce(client_amount, 0) < 0 THEN 'recalculate'
    WHEN job = 'externally_authorised' THEN 'revert' ELSE 'none' END AS action
  FROM fine WHERE job IN ('authorisation', 'externally_authorised', 'presentment')),
judged AS (
  SELECT *, action = 'recalculate' AND {_MOVED} < 0 AND auth IS NOT NULL AND auth.e IS NULL AS bad,
    CASE WHEN action = 'recalculate' AND {_MOVED} < 0 THEN abs({_MOVED}) - coalesce(abs(auth.e), 0)
      WHEN action = 'revert' AND earmark_amount > 0 THEN -earmark_amount ELSE 0 END AS change
  FROM acted WHERE action <> 'none'),
first_saved AS (
  SELECT debit_card_id, spend_group, min(transaction_date_time) AS f FROM judged WHERE NOT bad GROUP BY ALL),
summed AS (
  SELECT *, sum(change) OVER (PARTITION BY debit_card_id, spend_group, CAST(transaction_date_time AS DATE)
      ORDER BY transaction_date_time, type_rank, process_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS day_sum,
    sum(change) OVER (PARTITION BY debit_card_id, spend_group, year(transaction_date_time)
      ORDER BY transaction_date_time, type_rank, process_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS year_sum
  FROM judged WHERE NOT bad)
SELECT process_id, action, CAST(NULL AS VARCHAR) AS error,
  CAST(day_sum + CASE WHEN CAST(stored_at AS DATE) = CAST(f AS DATE)
    AND CAST(transaction_date_time AS DATE) = CAST(f AS DATE) THEN t.daily_total ELSE 0 END
    AS DECIMAL(18,2)) AS daily_total,
  CAST(year_sum + CASE WHEN year(stored_at) = year(f) AND year(transaction_date_time) = year(f)
    THEN t.annual_total ELSE 0 END AS DECIMAL(18,2)) AS annual_total
FROM summed JOIN first_saved USING (debit_card_id, spend_group)
LEFT JOIN snapshot t USING (debit_card_id, spend_group)
UNION ALL
SELECT process_id, NULL, 'missing_authorisation_earmark', NULL, NULL FROM judged WHERE bad"""


def _flow_command(kind: str, amount: str, currency: str, jobs: str, needed: str, wrong: str, sign: str) -> str:
    def pick(a: str, b: str) -> str:
        return f"CASE WHEN why IS NULL THEN CASE WHEN {amount} < 0 THEN {a} ELSE {b} END END"

    return f"""
SELECT '{kind}' AS kind, process_id, CASE WHEN why IS NULL THEN topic END AS topic,
  {pick("'DEBIT'", "'CREDIT'")} AS direction, CASE WHEN why IS NULL THEN abs({amount}) END AS amount,
  CASE WHEN why IS NULL THEN {currency} END AS currency,
  {pick('internal_account_id', 'gps')} AS debit_account,
  {pick('gps', 'internal_account_id')} AS credit_account, why AS error
FROM (SELECT *, CASE WHEN NOT ({sign}) THEN '{wrong}' WHEN topic IS NULL THEN 'no_processor_node' END AS why
  FROM (SELECT d.*, coalesce(o.gps_account_id, s.gps_account_id) AS gps, coalesce(o.topic, s.topic) AS topic
    FROM done d LEFT JOIN nodes o ON o.account_id = d.internal_account_id
    LEFT JOIN slots s ON coalesce(trim(d.internal_account_id), '') = ''
      AND s.slot = CAST('0x' || substr(md5(d.process_id), 1, 8) AS BIGINT) % s.n
    WHERE b NOT LIKE 'E:%' AND job IN ({jobs}) AND {needed}))"""


FLOW_COMMANDS = FLOW + ", " + NODES.split("placed AS")[0].rstrip().rstrip(",") + _flow_command(
    "accounting", "client_amount", "client_currency",
    "'presentment', 'financial_reversal', 'chargeback', 'second_presentment'",
    "(coalesce(client_amount <> 0, false) OR coalesce(wirecard_amount <> 0, false))",
    "inconsistent_ledger_signs",
    "coalesce(client_amount < 0 AND wirecard_amount > 0 OR client_amount > 0 AND wirecard_amount < 0, false)",
) + " UNION ALL " + _flow_command(
    "earmark", "earmark_amount", "earmark_currency",
    "'authorisation', 'externally_authorised', 'authorisation_reversal', 'presentment'",
    "coalesce(earmark_amount <> 0, false)", "no_earmark_direction", "true")


ORACLES: dict[str, str] = {
    "flow_history": FLOW_HISTORY,
    "flow_index": FLOW_INDEX,
    "flow_spend": FLOW_SPEND,
    "flow_commands": FLOW_COMMANDS,
    "decode_envelope": f"""
SELECT CAST(event_id AS VARCHAR) AS key, 'cards.' || event_type || '.request' AS topic,
  CASE WHEN ok THEN 'E-' || event_id END AS process_id,
  CASE WHEN ok THEN event_type END AS event_name,
  CASE WHEN ok THEN 'U-' || user_id END AS debit_card_id,
  CASE WHEN ok THEN {M.format('-value')} END AS settlement_amount,
  CASE WHEN ok THEN CAST(event_id AS VARCHAR) END AS provider_message_id,
  CASE WHEN NOT ok THEN 'undecodable_event' END AS error
FROM (SELECT *, event_type <> 'error' AS ok FROM events)""",
    "error_sink": """
SELECT CAST(event_id AS VARCHAR) AS key, '[processId: null][eventData: broken:' || props
  || '][exceptionMessage: undecodable_event][exceptionStackTrace: null' AS message
FROM events WHERE event_type = 'error'""",
    "matching_index": _with(MESSAGES, tag_rows("idx", "messages")) + """
SELECT process_id, transaction_id, card_token, tag_set, signature, tags,
  CAST(NULL AS VARCHAR) AS error FROM idx""",
    "match_required": _with(
        MESSAGES, tag_rows("idx", "messages"),
        "asked AS (SELECT * FROM messages WHERE job NOT IN ('authorisation', 'presentment'))",
        tag_rows("wanted", "asked"), best_match("idx", "wanted")) + """
SELECT process_id, matched_id AS transaction_id,
  CASE WHEN matched_id IS NULL THEN 'no_matching_transaction' END AS error
FROM asked LEFT JOIN best_wanted USING (process_id)""",
    "match_optional": _with(
        MESSAGES, tag_rows("idx", "messages"),
        "asked AS (SELECT * FROM messages WHERE job = 'presentment')",
        tag_rows("wanted", "asked"), best_match("idx", "wanted")) + """
SELECT process_id, matched_id, coalesce(matched_id, process_id) AS transaction_id
FROM asked LEFT JOIN best_wanted USING (process_id)""",
    "history_lookup": _with(MESSAGES, history()) + """
SELECT transaction_id, row_number() OVER (PARTITION BY transaction_id
    ORDER BY ts DESC, type_rank DESC, process_id DESC) AS position, process_id, message_type,
  e AS earmark_amount, c AS client_amount, w AS wirecard_amount
FROM hist WHERE transaction_id IN (SELECT transaction_id FROM messages)""",
    "latest_transaction": _with(MESSAGES, history()) + """
SELECT x.process_id, x.transaction_id, n.process_id AS latest_process_id,
  n.message_type AS latest_message_type, n.e AS latest_earmark_amount,
  n.c AS latest_client_amount, n.w AS latest_wirecard_amount
FROM messages x LEFT JOIN newest n USING (transaction_id)""",
    "first_authorisation": _with(MESSAGES, history()) + """
SELECT transaction_id, process_id, e AS earmark_amount FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
    ORDER BY ts DESC, type_rank DESC, process_id DESC) AS pos
  FROM hist WHERE message_type = 'AUTHORISATION') WHERE pos = 1""",
    "linked_account_asof": _with(MESSAGES, LINKED) + """
SELECT m.process_id, m.debit_card_id, m.transaction_date_time, l.account_id AS linked_account_id,
  l.account_currency AS linked_account_currency, l.from_timestamp
FROM messages m ASOF LEFT JOIN linked l
  ON l.debit_card_id = m.debit_card_id AND m.transaction_date_time >= l.from_timestamp""",
    "duplicate_check": _with(MESSAGES, history(until="1995-06-17")) + """
SELECT process_id, transaction_id, provider_message_id, EXISTS (
    SELECT 1 FROM hist h WHERE h.transaction_id = l.transaction_id
      AND h.provider_message_id = l.provider_message_id) AS is_duplicate
FROM messages l""",
    "order_validation": _with(MESSAGES, history()) + f"""
SELECT process_id, transaction_id, message_type, {_ORDERED} AS order_ok
FROM lines JOIN kinds_seen USING (transaction_id)""",
    "node_lookup": _with(MESSAGES, PROCESSED, NODES) + """
SELECT process_id, linked_account_id AS internal_account_id, node_id, gps AS gps_account_id, topic
FROM placed""",
    "auth_enrichment": _with(*_auth_match(), CHECKED) + """
SELECT process_id, matched_id, tx AS transaction_id, gated, NOT silent AS reads_balance,
  card_status, available, daily_total, annual_total FROM enriched""",
    "spend_enrichment": _with(EVENTS, _FIRST_AUTH) + """
SELECT s.event_id, s.message_type, p.daily_total, p.annual_total, p.stored_at,
  a.process_id AS authorisation_id, a.earmark AS authorisation_earmark
FROM spend s LEFT JOIN stored p USING (debit_card_id, spend_group)
LEFT JOIN newest_auth a ON a.transaction_id = s.transaction_id AND s.message_type = 'PRESENTMENT'""",
    "running_ledger_totals": _with(MESSAGES) + f"""
SELECT process_id, transaction_id, CAST(sum(d) OVER w AS DECIMAL(18,2)) AS total_client_amount,
  CAST(sum(-d) OVER w AS DECIMAL(18,2)) AS total_wirecard_amount
FROM (SELECT *, CASE WHEN {_MOVING} THEN settlement_amount ELSE 0 END AS d FROM messages)
WINDOW w AS (PARTITION BY transaction_id ORDER BY transaction_date_time, type_rank,
  provider_message_id, settlement_amount, process_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "lifecycle_replay": _with(MESSAGES, replay_ctes("messages"), recursive=True)
    + f"SELECT {REPLAYED} FROM st WHERE rn > 0",
    "spend_totals": SPEND_TOTALS,
    "total_spend_update": _with(EVENTS, _FIRST_AUTH) + f"""
SELECT event_id, debit_card_id, spend_group, action, CAST(NULL AS VARCHAR) AS error,
  CASE WHEN action <> 'none' THEN CAST({_next_total('d0', _TODAY)} AS DECIMAL(18,2)) END
    AS daily_total,
  CASE WHEN action <> 'none' THEN CAST({_next_total('a0', _THIS_YEAR)} AS DECIMAL(18,2)) END
    AS annual_total
FROM (SELECT s.*, a.earmark AS auth,
    CASE WHEN CAST(p.stored_at AS DATE) = CAST(processed_at AS DATE) THEN p.daily_total
      ELSE 0 END AS d0,
    CASE WHEN year(p.stored_at) = year(processed_at) THEN p.annual_total ELSE 0 END AS a0
  FROM spend s LEFT JOIN stored p USING (debit_card_id, spend_group)
  LEFT JOIN newest_auth a ON a.transaction_id = s.transaction_id
    AND s.message_type = 'PRESENTMENT')""",
    "authorisation": _with(
        *_auth_match(), CHECKED, history("authorisation"), """
requests AS (
  SELECT process_id, tx AS transaction_id, message_type, job, settlement_amount AS s,
    settlement_currency AS sc, response_status AS status, txn_stat_code AS stat,
    provider_message_id, own_account AS linked, 'EUR' AS linkedc, v1, v2, v3, v4, v5
  FROM answered)""") + one_shot("requests", True, """,
  status AS response_status, v1 AS status_valid, v2 AS transaction_type_valid,
  v3 AS merchant_valid, v4 AS velocity_valid, v5 AS balance_valid"""),
    "authorisation_reversal": job("authorisation_reversal"),
    "externally_authorised": job("externally_authorised", False),
    "presentment": _with(
        MESSAGES, LINKED, history("presentment"),
        tag_rows("idx", "messages"),
        "asked AS (SELECT * FROM messages WHERE job = 'presentment')",
        tag_rows("wanted", "asked"), best_match("idx", "wanted"), f"""
requests AS (
  SELECT {REQUEST.replace('transaction_id', 'coalesce(matched_id, process_id) AS transaction_id')},
    account_id AS linked, account_currency AS linkedc
  FROM (SELECT a.*, b.matched_id, l.account_id, l.account_currency FROM asked a
    LEFT JOIN best_wanted b USING (process_id)
    ASOF LEFT JOIN linked l ON l.debit_card_id = a.debit_card_id
      AND a.transaction_date_time >= l.from_timestamp))""") + one_shot("requests", True),
    "financial_reversal": job("financial_reversal"),
    "chargeback": job("chargeback"),
    "second_presentment": job("second_presentment"),
    "chargeback_non_credit": job("chargeback_non_credit", False),
    "accounting_commands": _command(
        "client < 0", "client", "ALL", "ALL", "process_id", "cards.accounting.completed", "",
        f"{_NEEDS_ACCOUNTING} AND {_MIRRORED}"),
    "accounting_completed": _with(MESSAGES, PROCESSED) + f"""
SELECT process_id, transaction_id, job FROM processed WHERE NOT {_NEEDS_ACCOUNTING}""",
    "accounting_errors": _with(MESSAGES, PROCESSED) + f"""
SELECT process_id, 'inconsistent_ledger_signs' AS error, client AS client_amount,
  wirecard AS wirecard_amount FROM processed WHERE {_NEEDS_ACCOUNTING} AND NOT {_MIRRORED}""",
    "earmark_commands": _command(
        "earmark < 0", "earmark", "AVAILABLE", "NONE", "sha256(process_id || '|earmark')",
        "cards.earmarking.completed", ", provider_message_id AS data_message_id",
        "coalesce(earmark <> 0, false)"),
    "earmarking_completed": _with(MESSAGES, PROCESSED) + """
SELECT process_id, transaction_id, job FROM processed WHERE NOT coalesce(earmark <> 0, false)""",
    "end_to_end": END_TO_END,
}
