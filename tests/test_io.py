"""Sources, sinks, merges, exports, logs and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import logs
from ledgerloom.operators.timeseries import pair_windows
from ledgerloom.sinks import buckets, files, merge
from ledgerloom.sources import jdbc
from ledgerloom.sources.files import load_csv, load_transfers, stored_bytes
from ledgerloom.sources.tables import Tables
from ledgerloom.streaming.pair_windows import stream_pair_windows, write_windows


def test_csv_quotes_empty_and_names(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", twice'), (2, None)], "`Row Id` int, `Some Text` string")
    files.write_csv(df, str(tmp_path / "c"))
    back = load_csv(spark, str(tmp_path / "c"), partitions=3)
    assert back.columns == ["row_id", "some_text"] and back.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, back.collect())) == [(1, 'say "hi", twice'), (2, None)]


def test_date_range_prunes_folders(spark, folder):
    from ledgerloom.plans.io_queries import _stored_transfers

    path = _stored_transfers(spark, folder)
    part = load_transfers(spark, path, "1995-02-10", "1995-03-05", ["id", "event_date"])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_year" in plan and "PushedFilters: [IsNotNull(event_date)" in plan
    days = part.agg(F.min("event_date").cast("string"), F.max("event_date").cast("string")).first()
    assert days[0] >= "1995-02-10" and days[1] <= "1995-03-05"
    assert load_transfers(spark, path).count() == Tables(spark, folder).orders.count()


def test_layout_respects_file_limit_and_order(spark, tmp_path):
    df = spark.range(100).select(F.lit("d").alias("day"), (100 - F.col("id")).alias("a"))
    files.write_layout(df, str(tmp_path / "l"), "day", ["a"], max_records=30)
    stored = spark.read.parquet(str(tmp_path / "l"))
    assert stored_bytes(stored).first()["n_files"] >= 4
    per_file = stored.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_file <= 30 and stored.count() == 100


def test_surrogate_key_fills_gaps_only(spark):
    df = spark.createDataFrame([(5, "b"), (None, "c"), (None, "a"), (7, "d")], "id long, name string")
    filled = files.with_surrogate_key(df, ["name"], existing="id")
    assert {r["name"]: r["id"] for r in filled.collect()} == {"b": 5, "d": 7, "a": 8, "c": 9}


def test_merge_sets_listed_properties(spark):
    old = spark.createDataFrame([(1, "ES", 10.0), (2, "UK", 20.0)], "account_number long, location string, balance double")
    new = spark.createDataFrame(
        [(2, 21.0, "x", 1), (2, None, "y", 2), (3, 30.0, None, 1)],
        "account_number long, balance double, tag string, version int",
    )
    merged = merge.merge_nodes(old, new, "account_number", ["version"]).drop("version")
    assert sorted(map(tuple, merged.collect())) == [
        (1, "ES", 10.0, None), (2, "UK", None, "y"), (3, None, 30.0, None),
    ]


def test_edges_need_both_end_points(spark):
    edges = spark.createDataFrame(
        [(1, 1, 2, 5.0, 1), (1, 1, 2, 6.0, 2), (2, 1, 9, 1.0, 1), (3, 9, 1, 1.0, 1), (4, 2, 2, 8.0, 1)],
        "id long, src long, dst long, amount double, version int",
    )
    nodes = spark.createDataFrame([(1,), (2,), (2,)], "account_number long")
    got = merge.match_edges(edges, nodes, ["version"], ["amount"])
    assert sorted(map(tuple, got.collect())) == [(1, 1, 2, 6.0), (4, 2, 2, 8.0)]


def test_export_resumes_and_replaces_leftovers(spark, tmp_path):
    df = buckets.with_bucket(spark.range(1000), "id", 8)
    out, done = str(tmp_path / "out"), str(tmp_path / "done")
    first = buckets.export_buckets(df.filter("bucket < 3"), out, done)
    # a run that died after writing: data without a manifest row
    df.filter("bucket = 5").limit(2).write.mode("append").partitionBy("bucket").parquet(out)
    rest = buckets.export_buckets(df, out, done)
    assert {r["bucket"] for r in first.collect()} == {0, 1, 2} and {r["bucket"] for r in rest.collect()} == {3, 4, 5, 6, 7}
    assert spark.read.parquet(out).count() == 1000 and spark.read.parquet(out).distinct().count() == 1000
    assert buckets.export_buckets(df, out, done).count() == 0
    assert buckets.read_manifest(spark, done).agg(F.sum("rows")).first()[0] == 1000


def test_hash_buckets_are_never_negative(spark):
    df = buckets.with_bucket(spark.range(-5000, 5000), "id", 7)
    assert df.agg(F.min("bucket"), F.max("bucket")).first() == (0, 6)


def test_jdbc_options():
    options = jdbc.read_options("jdbc:x", "s.t", "id", (1, 900), 6, extra={"user": "u"})
    assert options["partitionColumn"] == "id" and options["upperBound"] == "900" and options["user"] == "u"
    assert jdbc.read_options("jdbc:x", "s.t", "id", (4, 4), 2)["upperBound"] == "5"
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "s.t")
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", "s.t", "id")
    assert jdbc.projection("s.t", {"ts": "date_time", "id": "id"}) == "(SELECT date_time AS ts, id FROM s.t) t"
    assert jdbc.write_options("jdbc:x", "s.t")["reWriteBatchedInserts"] == "true"


def test_bounds(spark):
    df = spark.createDataFrame([(1,), (5,), (10,), (400,)], "k long")
    assert jdbc.key_bounds(df, "k") == (1, 400)
    with pytest.raises(ValueError):
        jdbc.key_bounds(df.limit(0), "k")


def test_engine_logs_with_missing_fields(spark, tmp_path):
    lines = [{"timeMillis": 1000, "loggerName": "a", "message": "m", "deep": {"x": 1}}, {"loggerName": "no time"}]
    (tmp_path / "spark-app1.log").write_text("\n".join(map(json.dumps, lines)))
    rows = logs.normalize_engine_logs(logs.read_engine_logs(spark, f"{tmp_path}/spark-app*.log*"), "app", "n1").collect()
    assert len(rows) == 1
    assert (rows[0]["level"], rows[0]["logger"], rows[0]["thread"], rows[0]["node"]) == (None, "a", None, "n1")
    assert json.loads(rows[0]["kv"])["deep"] == {"x": 1}


def test_app_logs_keep_broken_lines_whole(spark, tmp_path):
    broken = "{" + "x" * 9000
    good = {"ts": "2024-05-01T10:00:00+0200", "level": "INFO", "logger": "l", "message": "ñ", "extra": 5}
    late = {"ts": "May 1st", "level": "WARN", "logger": "l", "message": "m"}
    (tmp_path / "app.log").write_text("\n".join([json.dumps(good), "", "   ", broken, json.dumps(late)]))
    rows = {r["level"]: r for r in logs.read_app_logs(spark, str(tmp_path / "app.log"), "app", "n1").collect()}
    assert set(rows) == {"INFO", "ERROR", "WARN"}
    assert len(rows["ERROR"]["message"]) == 8000 and json.loads(rows["ERROR"]["kv"])["raw"] == broken
    assert rows["WARN"]["ts"] is None and json.loads(rows["INFO"]["kv"])["extra"] == 5
    assert rows["INFO"]["ts"].hour == 8 or rows["INFO"]["ts"] is not None


def test_append_adds_rows(spark, tmp_path):
    for _ in range(2):
        files.append(spark.range(3), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 6


def test_stream_gives_the_finished_batch_windows(spark, folder, tmp_path):
    pairs = Tables(spark, folder).event_pairs().withColumn("ts", F.col("ts").cast("timestamp"))
    source = str(tmp_path / "in")
    pairs.write.parquet(source)
    stream = spark.readStream.schema(pairs.schema).parquet(source)
    query = write_windows(stream_pair_windows(stream, "1 day"), str(tmp_path / "out"))
    query.awaitTermination(120)
    emitted = spark.read.parquet(str(tmp_path / "out")).select("a", "b", "win_start", "cnt", "p90_amt")
    batch = pair_windows(pairs, "1 day").select("a", "b", "win_start", "cnt", "p90_amt")
    assert emitted.count() > 0 and emitted.exceptAll(batch).count() == 0
    last = pairs.agg(F.max("ts")).first()[0]
    finished = pair_windows(pairs, "1 day").filter(F.col("win_end") <= F.lit(last) - F.expr("interval 1 hour"))
    assert finished.count() == emitted.count()


def test_an_export_that_dies_midway_goes_on_where_it_stopped(spark, tmp_path):
    out, done = str(tmp_path / "out"), str(tmp_path / "done")
    df = buckets.with_bucket(spark.range(800), "id", 8)
    trap = F.when(F.col("bucket") >= 4, F.raise_error("stopped").cast("long")).otherwise(F.col("id"))
    with pytest.raises(Exception, match="stopped"):
        buckets.export_buckets(df.withColumn("id", trap), out, done, at_once=2)
    assert {r["bucket"] for r in buckets.read_manifest(spark, done).collect()} == {0, 1, 2, 3}
    rest = buckets.export_buckets(df, out, done, ["id"], at_once=2)
    assert {r["bucket"] for r in rest.collect()} == {4, 5, 6, 7}
    assert spark.read.parquet(out).count() == 800 == buckets.read_manifest(spark, done).agg(F.sum("rows")).first()[0]
