"""The batch flow: raw CSV, ledger tables, graph tables. Each stage reads what the
one before it stored, so a stage can be run again by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators import graph_model as graph
from ledgerloom.operators import ledger
from ledgerloom.operators.profile import key_violations
from ledgerloom.sinks import buckets
from ledgerloom.sinks.files import with_surrogate_key
from ledgerloom.sources.files import load_csv

# The key of each stored table. The direction sets the two sides of
# a self-transfer apart.
TABLE_KEYS = {
    "accounts": ["account"],
    "transferences": ["id"],
    "statements": ["account", "date_time", "txn_id", "direction"],
}
NODE_BUCKETS = 8
EDGE_BUCKETS = 16


def ingest(spark: SparkSession, csv: str, out: str, schema=None) -> None:
    """CSV to the table `raw`, with a sequential id if the file has none."""
    raw = load_csv(spark, csv, schema)
    if "id" not in raw.columns:
        raw = with_surrogate_key(raw, raw.columns)
    raw.write.mode("overwrite").parquet(f"{out}/raw")


def build_ledger(spark: SparkSession, out: str) -> None:
    """Tables `accounts`, `transferences` and `statements` from `raw`."""
    raw = spark.read.parquet(f"{out}/raw")
    ledger.accounts(raw).write.mode("overwrite").parquet(f"{out}/accounts")
    ledger.transfers(raw).write.mode("overwrite").parquet(f"{out}/transferences")
    stored = spark.read.parquet(f"{out}/transferences")
    ledger.statements(ledger.movements(stored)).write.mode("overwrite").parquet(f"{out}/statements")


def check_keys(spark: SparkSession, out: str) -> dict[str, dict[str, int]]:
    """Violations of the key of each ledger table."""
    found = {}
    for table, keys in TABLE_KEYS.items():
        found[table] = key_violations(spark.read.parquet(f"{out}/{table}"), keys).first().asDict()
    return found


def graph_frames(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """Enriched nodes and edges of the stored ledger."""
    accounts = spark.read.parquet(f"{out}/accounts")
    sent = spark.read.parquet(f"{out}/transferences")
    statements = spark.read.parquet(f"{out}/statements")
    nodes = graph.enriched_nodes(graph.nodes(accounts), statements)
    return nodes, graph.enrich_edges(graph.edges(sent), statements)


def build_graph(
    spark: SparkSession, out: str, node_buckets: int = NODE_BUCKETS, edge_buckets: int = EDGE_BUCKETS
) -> None:
    """Tables `nodes` and `edges`, written in buckets; finished buckets are skipped when run again."""
    nodes, edges = graph_frames(spark, out)
    for name, df, key, count, sort in (
        ("nodes", nodes, "account_number", node_buckets, ["account_number"]),
        ("edges", edges, "src", edge_buckets, ["src", "id"]),
    ):
        buckets.export_buckets(
            buckets.with_bucket(df, key, count), f"{out}/{name}", f"{out}/{name}_manifest", sort
        )
