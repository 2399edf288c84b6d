"""The whole batch flow from a CSV file to graph tables."""

from pyspark.sql import functions as F

from ledgerloom.functions.temporal import assemble_timestamp
from ledgerloom.operators import logs
from ledgerloom.plans import etl
from ledgerloom.sinks.files import write_csv
from ledgerloom.sources.tables import Tables


def test_csv_to_graph(spark, folder, tmp_path):
    out, source = str(tmp_path / "out"), str(tmp_path / "csv")
    raw = Tables(spark, folder).raw_transfers(text_time=True).drop("id")
    write_csv(raw.withColumnRenamed("sender_account", "Sender Account"), source)
    etl.ingest(spark, source, out)
    etl.build_ledger(spark, out)
    orders = raw.count()
    tables = {name: spark.read.parquet(f"{out}/{name}") for name in ("raw", "accounts", "transferences", "statements")}
    assert tables["transferences"].count() == orders and tables["statements"].count() == 2 * orders
    assert tables["raw"].agg(F.min("id"), F.max("id"), F.count_distinct("id")).first() == (1, orders, orders)
    assert all(set(found.values()) == {0} for found in etl.check_keys(spark, out).values())

    etl.build_graph(spark, out, node_buckets=3, edge_buckets=4)
    etl.build_graph(spark, out, node_buckets=3, edge_buckets=4)  # nothing left to do
    nodes, edges = spark.read.parquet(f"{out}/nodes"), spark.read.parquet(f"{out}/edges")
    assert edges.count() == orders and nodes.count() == tables["accounts"].count()
    assert nodes.filter("current_balance is null or mclose_map is null").count() == 0
    assert edges.filter("abs(src_balance_before + src_delta - src_balance_after) > 1e-6").count() == 0
    assert edges.filter("src_delta <> -amount or dst_delta <> amount").count() == 0
    assert edges.select("bucket").distinct().count() == 4


def test_inferred_dates_and_times(spark):
    df = spark.sql(
        """SELECT date'2023-01-05' AS d, timestamp'2030-07-07 10:11:12' AS t UNION ALL
           SELECT date'2023-01-05', NULL"""
    )
    inferred = [r[0] for r in df.select(assemble_timestamp("d", "t")).collect()]
    assert [str(v) for v in inferred] == ["2023-01-05 10:11:12", "None"]
    texts = spark.createDataFrame(
        [("2023-01-05", "10:11:12"), ("2023-01-05x", "10:11:12"), ("2023-13-05", "10:11:12"), ("2023-01-05", "25:00:00")],
        "d string, t string",
    )
    got = [r[0] for r in texts.select(assemble_timestamp("d", "t")).collect()]
    assert str(got[0]) == "2023-01-05 10:11:12" and got[1:] == [None, None, None]


def test_log_append_counts_what_it_writes(spark, tmp_path):
    lines = spark.createDataFrame([('{"level": "INFO"}',), ("",), ("broken",)], "value string")
    records = logs.parse_app_lines(lines, "app", "n1")
    path = str(tmp_path / "log")
    assert logs.append_records(records, path) == 2
    assert logs.append_records(records, path) == 2
    assert logs.append_records(records.limit(1), path, batch="a1") == 1
    assert logs.append_records(records, path, batch="a1") == 2
    assert spark.read.parquet(path).count() == 6
