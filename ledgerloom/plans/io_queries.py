"""Round trips through files: CSV, Parquet layouts, merges, buckets, logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.temporal import time_columns, utc
from ledgerloom.functions.text import normalize_columns
from ledgerloom.operators import logs
from ledgerloom.operators.graph_model import EDGE_PROPERTIES
from ledgerloom.operators.graph_model import edges as build_edges
from ledgerloom.operators.sampling import bernoulli_sample
from ledgerloom.operators.timeseries import rounded
from ledgerloom.plans.fixtures import with_pairs, with_transfers
from ledgerloom.plans.ledger_queries import transfers
from ledgerloom.plans.registry import query
from ledgerloom.runtime import fresh_path
from ledgerloom.sinks import buckets, files, merge
from ledgerloom.sources.files import load_csv, load_transfers, stored_bytes
from ledgerloom.sources.tables import Tables


@query("csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _csv_roundtrip(spark, folder):
    customer = Tables(spark, folder).customer
    path = fresh_path(spark, "csv")
    files.write_csv(customer, path)
    return load_csv(spark, path, customer.schema)


@query(
    "normalized_columns",
    """SELECT o_orderkey AS order_key, o_totalprice AS total_price_usd, o_totalprice AS total_price_usd_2, o_orderstatus AS status
       FROM orders""",
)
def _normalized_columns(spark, folder):
    messy = Tables(spark, folder).orders.select(
        F.col("o_orderkey").alias(" Order Key"),
        F.col("o_totalprice").alias("Total-Price (USD)"),
        F.col("o_totalprice").alias("total__price usd"),
        F.col("o_orderstatus").alias("_STATUS_"),
    )
    return normalize_columns(messy)


def _stored_transfers(spark, folder) -> str:
    """Transfers with calendar columns, stored in year and month folders."""
    path = fresh_path(spark, "transfers")
    dated = time_columns(transfers(spark, folder, currencies=False), "date_time")
    files.write_partitioned(dated, path, ["event_year", "event_month"])
    return path


@query(
    "partitioned_roundtrip",
    with_transfers(
        """SELECT CAST(year(date_time) AS INTEGER) AS event_year, CAST(month(date_time) AS INTEGER) AS event_month,
                  count(*) AS n, round(sum(amount), 2) AS total FROM t GROUP BY 1, 2"""
    ),
)
def _partitioned_roundtrip(spark, folder):
    stored = spark.read.parquet(_stored_transfers(spark, folder))
    months = stored.groupBy("event_year", "event_month").agg(F.count("*").alias("n"), F.sum("amount").alias("total"))
    return rounded(months, 2, "total")


@query(
    "filtered_scan",
    with_transfers(
        """SELECT id, amount, is_laundering FROM t WHERE is_laundering = 1
           AND CAST(date_time AS DATE) BETWEEN DATE '1995-02-10' AND DATE '1998-07-05'"""
    ),
)
def _filtered_scan(spark, folder):
    path = _stored_transfers(spark, folder)
    return load_transfers(spark, path, "1995-02-10", "1998-07-05", ["id", "amount", "is_laundering"], True)


_DAYS = with_pairs(
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, count(*) AS n, round(sum(amount), 4) AS total,
              min(a) AS first_a FROM e GROUP BY 1"""
)


def _by_day(stored):
    days = stored.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count("*").alias("n"), F.sum("amount").alias("total"), F.min("a").alias("first_a")
    )
    return rounded(days, 4, "total")


@query("layout_roundtrip", _DAYS)
def _layout_roundtrip(spark, folder):
    path = fresh_path(spark, "layout")
    pairs = time_columns(Tables(spark, folder).event_pairs(), "ts")
    files.write_layout(pairs, path, "event_date", ["a", "b", "ts"])
    return _by_day(spark.read.parquet(path))


@query(
    "incremental_day_overwrite",
    with_pairs(
        """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, count(*) AS n,
             round(sum(CASE WHEN CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM e) THEN 2 * amount ELSE amount END), 4) AS total,
             min(a) AS first_a FROM e GROUP BY 1"""
    ),
)
def _incremental_day_overwrite(spark, folder):
    path = fresh_path(spark, "daily")
    pairs = time_columns(Tables(spark, folder).event_pairs(), "ts")
    files.write_layout(pairs, path, "event_date", ["a", "b", "ts"])
    last = pairs.agg(F.max("event_date")).scalar()
    corrected = pairs.filter(F.col("event_date") == last).withColumn("amount", 2 * F.col("amount"))
    files.overwrite_partitions(corrected, path, ["event_date"])
    return _by_day(spark.read.parquet(path))


@query(
    "node_merge",
    with_transfers(
        """, i AS (SELECT *, row_number() OVER (PARTITION BY account_number ORDER BY date_time DESC, id DESC) AS rn
             FROM (SELECT receiver_account + 500 AS account_number, amount AS balance, payment_type AS channel, date_time, id FROM t))
        SELECT coalesce(c.account, i.account_number) AS account_number, c.location,
               CASE WHEN i.account_number IS NOT NULL THEN i.balance ELSE c.balance END AS balance, i.channel
        FROM (SELECT c_custkey AS account, n_name AS location, c_acctbal AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey) c
        FULL JOIN (SELECT * FROM i WHERE rn = 1) i ON c.account = i.account_number"""
    ),
)
def _node_merge(spark, folder):
    tables = Tables(spark, folder)
    existing = tables.customer.join(tables.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("account_number"), F.col("n_name").alias("location"), F.col("c_acctbal").alias("balance")
    )
    incoming = transfers(spark, folder, currencies=False).select(
        (F.col("receiver_account") + 500).alias("account_number"),
        F.col("amount").alias("balance"),
        F.col("payment_type").alias("channel"),
        "date_time",
        "id",
    )
    path = fresh_path(spark, "nodes")
    merge.create_snapshot(existing, path, "account_number", 16)
    merge.upsert_snapshot(incoming, path, "account_number", ["date_time", "id"], 16)
    return merge.read_snapshot(spark, path)


@query(
    "edge_match_merge",
    with_transfers(
        """SELECT id, date_time AS "timestamp", sender_account AS src, receiver_account AS dst, amount, payment_type,
             is_laundering, laundering_type,
             CASE WHEN ((id % 2147483648 * 1103515245 + 12345) % 2147483648) / 2147483648.0 < 0.2 THEN 1 ELSE 0 END AS masked
           FROM t WHERE sender_account IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
             AND receiver_account IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"""
    ),
)
def _edge_match_merge(spark, folder):
    nodes = Tables(spark, folder).customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("account_number"))
    edges = build_edges(transfers(spark, folder, currencies=False))
    replayed = edges.withColumn("version", F.lit(2)).unionByName(
        edges.withColumns({"version": F.lit(1), "amount": F.lit(0.0)})
    )
    return merge.match_edges(replayed, nodes, ["version"], EDGE_PROPERTIES)


@query("bucket_sizes", 'SELECT CAST(o_orderkey % 16 AS INTEGER) AS bucket, count(*) AS "rows" FROM orders GROUP BY 1')
def _bucket_sizes(spark, folder):
    bucket = F.pmod("o_orderkey", F.lit(16)).cast("int")
    return buckets.bucket_sizes(buckets.with_bucket(Tables(spark, folder).orders, "o_orderkey", 16, bucket))


@query("pending_buckets", 'SELECT CAST(o_orderkey % 16 AS INTEGER) AS bucket, count(*) AS "rows" FROM orders WHERE o_orderkey % 16 >= 10 GROUP BY 1')
def _pending_buckets(spark, folder):
    """An export that stopped after ten buckets, and what it still has to do."""
    bucket = F.pmod("o_orderkey", F.lit(16)).cast("int")
    orders = buckets.with_bucket(Tables(spark, folder).orders, "o_orderkey", 16, bucket)
    path, done = fresh_path(spark, "export"), fresh_path(spark, "manifest")
    buckets.export_buckets(orders.filter("bucket < 10"), path, done)
    return buckets.pending_buckets(buckets.bucket_sizes(orders), buckets.read_manifest(spark, done))


@query(
    "bucketed_export",
    'SELECT CAST(o_orderkey % 16 AS INTEGER) AS bucket, count(*) AS "rows", min(o_orderkey) AS first_key FROM orders GROUP BY 1',
)
def _bucketed_export(spark, folder):
    """The same export resumed to its end and read back."""
    bucket = F.pmod("o_orderkey", F.lit(16)).cast("int")
    orders = buckets.with_bucket(Tables(spark, folder).orders, "o_orderkey", 16, bucket)
    path, done = fresh_path(spark, "export"), fresh_path(spark, "manifest")
    buckets.export_buckets(orders.filter("bucket < 10"), path, done)
    buckets.export_buckets(orders, path, done)
    return spark.read.parquet(path).groupBy("bucket").agg(F.count("*").alias("rows"), F.min("o_orderkey").alias("first_key"))


@query(
    "surrogate_key",
    "SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders",
)
def _surrogate_key(spark, folder):
    return files.with_surrogate_key(Tables(spark, folder).orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])


@query("size_probe")
def _size_probe(spark, folder):
    """Bytes per row on disk, from a stored one percent sample."""
    path = fresh_path(spark, "size-probe")
    bernoulli_sample(Tables(spark, folder).lineitem, 0.01).write.parquet(path)
    sample = spark.read.parquet(path)
    rows = sample.agg(F.count("*")).scalar()
    return stored_bytes(sample).select(
        "n_files", "total_bytes", rows.alias("sample_rows"), F.try_divide("total_bytes", rows).alias("bytes_per_row")
    )


def _engine_log_lines(spark, folder):
    """Every event as a log record in one of two layouts; views have no time."""
    e = Tables(spark, folder).events
    wrap = F.col("event_type").isin("view", "error")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    first = F.struct(
        F.when(F.col("event_type") != "view", stamp).alias("timestamp"),
        F.upper("event_type").alias("level"),
        F.concat(F.lit("app."), F.col("event_type")).alias("logger"),
        F.col("user_id").cast("string").alias("thread"),
        F.col("props").alias("message"),
    )
    second = F.struct(
        (F.col("event_id") * 1000 + 7).alias("timeMillis"),
        F.upper("event_type").alias("levelStr"),
        F.concat(F.lit("app."), F.col("event_type")).alias("loggerName"),
        F.col("user_id").cast("string").alias("threadName"),
        F.col("props").alias("formattedMessage"),
    )
    return e.select(F.when(wrap, F.to_json(first)).otherwise(F.to_json(second)).alias("value"))


@query(
    "json_log_normalize",
    """SELECT CASE WHEN event_type = 'error' THEN date_trunc('second', ts)
                   ELSE TIMESTAMP '1970-01-01' + to_milliseconds(event_id * 1000 + 7) END AS ts,
              upper(event_type) AS level, 'app.' || event_type AS logger, CAST(user_id AS VARCHAR) AS thread,
              'driver' AS node, 'ledger-export' AS app, props AS message, props AS kv_message
       FROM events WHERE event_type <> 'view'""",
)
def _json_log_normalize(spark, folder):
    path = fresh_path(spark, "engine-logs")
    _engine_log_lines(spark, folder).write.text(path)
    flat = logs.normalize_engine_logs(logs.read_engine_logs(spark, path), "ledger-export", "driver")
    kept = F.coalesce(F.get_json_object("kv", "$.message"), F.get_json_object("kv", "$.formattedMessage"))
    return flat.withColumn("kv_message", kept).withColumn("ts", utc("ts")).drop("kv")


@query(
    "jsonl_corrupt_capture",
    """SELECT CASE WHEN event_type IN ('error', 'click') THEN NULL ELSE date_trunc('second', ts) END AS ts,
              CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
              CASE WHEN event_type = 'error' THEN 'etl.parser' ELSE event_type END AS logger,
              CASE WHEN event_type = 'error' THEN '{"broken": ' || event_id ELSE 'user ' || user_id END AS message,
              CASE WHEN event_type = 'error' THEN '{"broken": ' || event_id END AS raw
       FROM events WHERE event_type <> 'view'""",
)
def _jsonl_corrupt_capture(spark, folder):
    """Every event as a log line: errors are broken JSON, views are blank, clicks have an unreadable time."""
    kind = F.col("event_type")
    good = F.to_json(
        F.struct(
            F.when(kind == "click", "yesterday")
            .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+0000'"))
            .alias("ts"),
            F.lit("INFO").alias("level"),
            kind.alias("logger"),
            F.concat(F.lit("user "), F.col("user_id")).alias("message"),
        )
    )
    broken = F.concat(F.lit('{"broken": '), F.col("event_id"))
    line = F.when(kind == "view", "   ").when(kind == "error", broken).otherwise(good)
    path = fresh_path(spark, "app-logs")
    Tables(spark, folder).events.select(line.alias("value")).write.text(path)
    records = logs.read_app_logs(spark, path, "ledger-export", "driver")
    return records.select(
        utc("ts").alias("ts"), "level", "logger", "message", F.get_json_object("kv", "$.raw").alias("raw")
    )
