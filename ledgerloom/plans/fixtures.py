"""SQL twins of the transaction views, for the oracles."""

from __future__ import annotations

TRANSFERS = """
acct AS (
  SELECT c_custkey AS account, n_name AS location,
         CASE r_name WHEN 'EUROPE' THEN 'Euro' WHEN 'AMERICA' THEN 'UK pounds' ELSE r_name END AS currency
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
flagged AS (
  SELECT *, (o_custkey * 7 + o_orderkey * 13) % (SELECT count(*) FROM customer) AS receiver,
         CASE WHEN ((o_orderkey % 2147483648 * 1103515245 + 12345) % 2147483648) % 50 = 0 THEN 1 ELSE 0 END AS flag
  FROM orders),
t AS (
  SELECT o_orderkey AS id, o_orderdate AS date_time, o_custkey AS sender_account, receiver AS receiver_account,
         o_totalprice AS amount, s.currency AS payment_currency, r.currency AS received_currency,
         o_orderpriority AS payment_type, flag AS is_laundering,
         CASE WHEN flag = 1 THEN 'L_' ELSE 'N_' END || o_orderstatus AS laundering_type,
         o_orderstatus AS sender_bank_location, o_orderpriority AS receiver_bank_location
  FROM flagged LEFT JOIN acct s ON s.account = o_custkey LEFT JOIN acct r ON r.account = receiver)
"""

MOVEMENTS = TRANSFERS + """,
m AS (
  SELECT id AS txn_id, date_time, receiver_account AS account, 'CREDIT' AS direction, amount AS delta_amount,
         CASE WHEN amount > 0 THEN received_currency ELSE payment_currency END AS currency
  FROM t WHERE date_time IS NOT NULL
  UNION ALL
  SELECT id, date_time, sender_account, 'DEBIT', -amount,
         CASE WHEN -amount > 0 THEN received_currency ELSE payment_currency END
  FROM t WHERE date_time IS NOT NULL)
"""

STATEMENTS = MOVEMENTS + """,
st AS (
  SELECT *, sum(delta_amount) OVER w AS running_balance, row_number() OVER w AS seq FROM m
  WINDOW w AS (PARTITION BY account ORDER BY date_time, txn_id, direction
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""

PAIRS = """
e AS (
  SELECT event_id AS id, ts, user_id AS a, event_type AS b, value AS amount,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS flag
  FROM events)
"""


def with_transfers(body: str) -> str:
    return f"WITH {TRANSFERS} {body}"


def with_movements(body: str) -> str:
    return f"WITH {MOVEMENTS} {body}"


def with_statements(body: str) -> str:
    return f"WITH {STATEMENTS} {body}"


def with_pairs(body: str) -> str:
    return f"WITH {PAIRS} {body}"
