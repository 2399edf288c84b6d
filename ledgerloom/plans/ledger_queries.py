"""Ledger and graph-model queries over the transaction view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import graph_model as graph
from ledgerloom.operators import ledger
from ledgerloom.operators.timeseries import rounded
from ledgerloom.plans.fixtures import with_movements, with_statements, with_transfers
from ledgerloom.plans.registry import query
from ledgerloom.runtime import fresh_path, stage
from ledgerloom.sinks import ledger_store
from ledgerloom.sources.tables import Tables


def transfers(spark: SparkSession, folder: str, currencies: bool = True) -> DataFrame:
    return ledger.transfers(Tables(spark, folder).raw_transfers(currencies))


def statements(spark: SparkSession, folder: str, currencies: bool = False) -> DataFrame:
    return ledger.statements(ledger.movements(transfers(spark, folder, currencies)))


TRANSFER_COLUMNS = (
    "id, date_time, sender_account, receiver_account, amount, payment_currency, "
    "received_currency, payment_type, is_laundering, laundering_type"
)


@query("transfers", with_transfers(f"SELECT {TRANSFER_COLUMNS} FROM t"))
def _transfers(spark, folder):
    return ledger.transfers(Tables(spark, folder).raw_transfers(text_time=True))


@query(
    "assemble_timestamp",
    """SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate + to_seconds(o_orderkey % 86400) END AS date_time
       FROM orders""",
)
def _assemble_timestamp(spark, folder):
    second = F.pmod("o_orderkey", F.lit(86400))
    clock = F.format_string("%02d:%02d:%02d", F.floor(second / 3600), F.floor(F.pmod(second, F.lit(3600)) / 60), F.pmod(second, F.lit(60)))
    broken = F.pmod("o_orderkey", F.lit(11)) == 0
    return Tables(spark, folder).orders.select(
        F.col("o_orderkey").alias("id"),
        ledger.assemble_timestamp(
            F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(broken, "noon").otherwise(clock)
        ).alias("date_time"),
    )


@query(
    "account_location_counts",
    with_transfers(
        """SELECT account, location, count(*) AS "count" FROM (
             SELECT sender_account AS account, sender_bank_location AS location FROM t
             UNION ALL SELECT receiver_account, receiver_bank_location FROM t)
           WHERE account IS NOT NULL AND location IS NOT NULL GROUP BY account, location"""
    ),
)
def _account_location_counts(spark, folder):
    return ledger.account_locations(Tables(spark, folder).raw_transfers(currencies=False))


@query(
    "account_location_mode",
    with_transfers(
        """SELECT account, location FROM (
             SELECT account, location, row_number() OVER (PARTITION BY account ORDER BY count(*) DESC, location) AS rn
             FROM (SELECT sender_account AS account, sender_bank_location AS location FROM t
                   UNION ALL SELECT receiver_account, receiver_bank_location FROM t)
             WHERE account IS NOT NULL AND location IS NOT NULL GROUP BY account, location) WHERE rn = 1"""
    ),
)
def _account_location_mode(spark, folder):
    return ledger.accounts(Tables(spark, folder).raw_transfers(currencies=False))


@query("movements", with_movements("SELECT account, date_time, txn_id, direction, delta_amount FROM m"))
def _movements(spark, folder):
    moves = ledger.movements(transfers(spark, folder, currencies=False))
    return moves.select("account", "date_time", "txn_id", "direction", "delta_amount")


@query(
    "running_balance",
    with_statements(
        """SELECT account, date_time, txn_id, direction, delta_amount,
                  round(running_balance, 2) AS running_balance FROM st"""
    ),
)
def _running_balance(spark, folder):
    return rounded(statements(spark, folder).drop("seq"), 2, "running_balance")


@query("incremental_ledger", with_statements("SELECT account, txn_id, direction, round(running_balance, 2) AS running_balance, seq FROM st"))
def _incremental_ledger(spark, folder):
    """Stored without two of every eight quarters, which come in late, the later one first."""
    moves = ledger.movements(transfers(spark, folder, currencies=False))
    quarter = F.pmod(F.year("date_time") * 4 + F.quarter("date_time"), F.lit(8))
    path = fresh_path(spark, "ledger")
    ledger_store.create(moves.filter(~quarter.isin(2, 5)), path, "quarter")
    for late in (5, 2):
        ledger_store.add(moves.filter(quarter == late), path, "quarter")
    return rounded(ledger_store.statements(spark, path), 2, "running_balance").select("account", "txn_id", "direction", "running_balance", "seq")


@query("movement_seq", with_statements("SELECT account, txn_id, direction, seq FROM st"))
def _movement_seq(spark, folder):
    return statements(spark, folder).select("account", "txn_id", "direction", "seq")


@query("movement_currency", with_movements("SELECT account, txn_id, direction, currency FROM m"))
def _movement_currency(spark, folder):
    moved = ledger.movements(ledger.transfers(Tables(spark, folder).raw_transfers()))
    return moved.select("account", "txn_id", "direction", "currency")


def _side_sql(side: str, sign: str) -> str:
    return with_statements(
        f"""SELECT txn_id AS id, account AS {side}, delta_amount AS {side}_delta,
                   round(running_balance - delta_amount, 2) AS {side}_balance_before,
                   round(running_balance, 2) AS {side}_balance_after, seq AS {side}_seq, currency AS {side}_currency
            FROM st WHERE delta_amount {sign} 0"""
    )


@query("sender_ledger", _side_sql("src", "<"))
def _sender_ledger(spark, folder):
    side = ledger.side_ledger(statements(spark, folder, currencies=True), "src")
    return rounded(side, 2, "src_balance_before", "src_balance_after")


@query("receiver_ledger", _side_sql("dst", ">"))
def _receiver_ledger(spark, folder):
    side = ledger.side_ledger(statements(spark, folder, currencies=True), "dst")
    return rounded(side, 2, "dst_balance_before", "dst_balance_after")


@query(
    "edges_enriched",
    with_statements(
        """SELECT t.id, t.date_time AS "timestamp", t.sender_account AS src, t.receiver_account AS dst, t.amount,
             t.payment_currency, t.received_currency, t.payment_type, t.is_laundering, t.laundering_type,
             CASE WHEN ((t.id % 2147483648 * 1103515245 + 12345) % 2147483648) / 2147483648.0 < 0.2 THEN 1 ELSE 0 END AS masked,
             s.delta_amount AS src_delta, round(s.running_balance - s.delta_amount, 2) AS src_balance_before,
             round(s.running_balance, 2) AS src_balance_after, s.seq AS src_seq, s.currency AS src_currency,
             r.delta_amount AS dst_delta, round(r.running_balance - r.delta_amount, 2) AS dst_balance_before,
             round(r.running_balance, 2) AS dst_balance_after, r.seq AS dst_seq, r.currency AS dst_currency
           FROM t LEFT JOIN st s ON s.txn_id = t.id AND s.account = t.sender_account AND s.delta_amount < 0
                  LEFT JOIN st r ON r.txn_id = t.id AND r.account = t.receiver_account AND r.delta_amount > 0"""
    ),
)
def _edges_enriched(spark, folder):
    sent = transfers(spark, folder)
    enriched = graph.enrich_edges(graph.edges(sent), statements(spark, folder))
    return rounded(
        enriched, 2, "src_balance_before", "src_balance_after", "dst_balance_before", "dst_balance_after"
    )


@query("nodes", "SELECT c_custkey AS account_number, n_name AS location FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _nodes(spark, folder):
    return graph.nodes(Tables(spark, folder).accounts())


NODES_BASE = """
nb AS (
  SELECT a.account AS account_number, a.location, l.running_balance AS current_balance,
         f.last_seen, f.first_seen
  FROM acct a
  LEFT JOIN (SELECT account, running_balance, row_number() OVER (
               PARTITION BY account ORDER BY date_time DESC, txn_id DESC, direction DESC) AS rn FROM st) l
    ON l.account = a.account AND l.rn = 1
  LEFT JOIN (SELECT account, max(date_time) AS last_seen, min(date_time) AS first_seen FROM st GROUP BY account) f
    ON f.account = a.account)
"""
CLOSES = """
mc AS (
  SELECT account AS account_number, currency, year, month, running_balance AS balance_close,
         'mclose_' || lpad(CAST(year AS VARCHAR), 4, '0') || '_' || lpad(CAST(month AS VARCHAR), 2, '0') || '_' || currency AS prop_name
  FROM (SELECT *, row_number() OVER (PARTITION BY account, currency, year, month
                                     ORDER BY date_time DESC, txn_id DESC, direction DESC) AS rn
        FROM (SELECT account, coalesce(currency, 'NA') AS currency, CAST(year(date_time) AS INTEGER) AS year,
                     CAST(month(date_time) AS INTEGER) AS month, date_time, txn_id, direction, running_balance FROM st))
  WHERE rn = 1)
"""


@query(
    "nodes_base",
    with_statements(
        f""", {NODES_BASE} SELECT account_number, location, round(current_balance, 2) AS current_balance,
            last_seen, first_seen FROM nb"""
    ),
)
def _nodes_base(spark, folder):
    nodes = graph.nodes(Tables(spark, folder).accounts())
    return rounded(graph.base_nodes(nodes, statements(spark, folder)), 2, "current_balance")


@query(
    "monthly_close",
    with_statements(
        f""", {CLOSES} SELECT account_number, currency, year, month, round(balance_close, 2) AS balance_close, prop_name FROM mc"""
    ),
)
def _monthly_close(spark, folder):
    return rounded(graph.monthly_close(statements(spark, folder, currencies=True)), 2, "balance_close")


@query(
    "monthly_close_map",
    with_statements(f""", {CLOSES} SELECT account_number, prop_name, round(balance_close, 2) AS balance_close FROM mc"""),
)
def _monthly_close_map(spark, folder):
    packed = graph.monthly_close_map(graph.monthly_close(statements(spark, folder, currencies=True)))
    opened = packed.select("account_number", F.explode("mclose_map").alias("prop_name", "balance_close"))
    return rounded(opened, 2, "balance_close")


@query(
    "monthly_close_wide",
    with_statements(
        f""", {CLOSES} SELECT account_number,
            round(max(CASE WHEN prop_name = 'mclose_1995_01_Euro' THEN balance_close END), 2) AS mclose_1995_01_euro,
            round(max(CASE WHEN prop_name = 'mclose_1996_06_ASIA' THEN balance_close END), 2) AS mclose_1996_06_asia,
            count(*) AS n_closes FROM mc GROUP BY account_number"""
    ),
)
def _monthly_close_wide(spark, folder):
    # written once: the names and the wide form both read it
    long = stage(graph.monthly_close(statements(spark, folder, currencies=True)), "closes")
    # one name for each month and currency of the data
    closes = sorted(row[0] for row in long.select("prop_name").distinct().collect())
    wide = graph.monthly_close_wide(long, closes)
    pick = lambda name: F.col(f"`{name}`") if name in closes else F.lit(None).cast("double")
    filled = F.size(F.array_compact(F.array(*[F.col(f"`{name}`") for name in closes])))
    shown = wide.select(
        "account_number",
        pick("mclose_1995_01_Euro").alias("mclose_1995_01_euro"),
        pick("mclose_1996_06_ASIA").alias("mclose_1996_06_asia"),
        filled.cast("long").alias("n_closes"),
    )
    return rounded(shown, 2, "mclose_1995_01_euro", "mclose_1996_06_asia")


@query(
    "nodes_enriched",
    with_statements(
        f""", {NODES_BASE}, {CLOSES}
            SELECT nb.account_number, location, round(current_balance, 2) AS current_balance, last_seen, first_seen,
                   n_closes, first_close, round(sum_closes, 2) AS sum_closes
            FROM nb LEFT JOIN (SELECT account_number, count(*) AS n_closes, min(prop_name) AS first_close,
                                      sum(balance_close) AS sum_closes FROM mc GROUP BY account_number) c
            ON c.account_number = nb.account_number"""
    ),
)
def _nodes_enriched(spark, folder):
    rows = statements(spark, folder, currencies=True)
    full = graph.enriched_nodes(graph.nodes(Tables(spark, folder).accounts()), rows)
    closes = F.map_values("mclose_map")
    shown = full.select(
        *[name for name in full.columns if name != "mclose_map"],
        F.size("mclose_map").cast("long").alias("n_closes"),
        F.array_min(F.map_keys("mclose_map")).alias("first_close"),
        F.aggregate(closes, F.lit(0.0), lambda total, close: total + close).alias("sum_closes"),
    )
    return rounded(shown, 2, "current_balance", "sum_closes")


@query(
    "account_totals",
    with_movements(
        """SELECT account, count(*) AS num_tx,
             round(sum(CASE WHEN delta_amount > 0 THEN delta_amount ELSE 0 END), 2) AS total_in,
             round(sum(CASE WHEN delta_amount < 0 THEN delta_amount ELSE 0 END), 2) AS total_out
           FROM m GROUP BY account"""
    ),
)
def _account_totals(spark, folder):
    moves = ledger.movements(transfers(spark, folder, currencies=False))
    return rounded(ledger.account_totals(moves), 2, "total_in", "total_out")


@query(
    "masked_edges",
    with_transfers(
        """SELECT id, CASE WHEN ((id % 2147483648 * 1103515245 + 12345) % 2147483648) / 2147483648.0 < 0.2
                           THEN 1 ELSE 0 END AS masked FROM t"""
    ),
)
def _masked_edges(spark, folder):
    return graph.edges(transfers(spark, folder, currencies=False)).select("id", "masked")


@query(
    "graph_triplets",
    with_transfers(
        """SELECT t.id, sender_account AS src, receiver_account AS dst, amount,
                  s.location AS src_location, d.location AS dst_location
           FROM t JOIN acct s ON s.account = sender_account JOIN acct d ON d.account = receiver_account"""
    ),
)
def _graph_triplets(spark, folder):
    edges = graph.edges(transfers(spark, folder, currencies=False)).select("id", "src", "dst", "amount")
    return graph.triplets(edges, graph.nodes(Tables(spark, folder).accounts()))
