"""Sums and ranks over value cuts must give what one window gives."""

import statistics
from types import SimpleNamespace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import distribution
from ledgerloom.operators.ordered import cuts, exact_quantiles, join_null_safe, quantile_grid, running
from ledgerloom.runtime import fresh_path


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows; there are NULL keys and NULL values."""
    rows = []
    for i in range(900):
        key = 100 if i % 3 == 0 else (None if i % 50 == 1 else i % 40)
        rows.append((key, i % 17, i, None if i % 23 == 0 else float(i % 29) - 7))
    return spark.createDataFrame(rows, "k long, at int, id long, v double")


def as_set(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_equals_a_window(skewed, keys):
    by_order = Window.partitionBy(*keys).orderBy("at", "id")
    plain = skewed.withColumns(
        {
            "total": F.sum("v").over(by_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "rank": F.row_number().over(by_order).cast("long"),
        }
    )
    ours = running(skewed, keys, ["at", "id"], {"total": "v"}, "rank")
    columns = ["k", "at", "id", F.round("total", 6).alias("total"), "rank"]
    assert as_set(plain, *columns) == as_set(ours, *columns)
    assert ours.count() == 900


def test_a_hot_key_spans_many_cuts(skewed):
    hot = skewed.withColumns(cuts(skewed, ["at", "id"])).filter("k = 100")
    assert hot.select("__cut0").distinct().count() == 17


@pytest.mark.parametrize("kind", ["outlier", "texts", "sampled"])
def test_no_cut_gathers_the_rows(spark, kind):
    """One far value, texts with the same beginning, and more distinct values than the sample holds."""
    n = 100_000 if kind == "sampled" else 20_000
    if kind == "texts":
        column = F.format_string("ab%05d", F.col("id"))
    else:
        column = F.when(F.col("id") == 7, F.lit(1e12)).otherwise(F.col("id") * 0.5)
    df = spark.range(n).select(column.alias("v"))
    sizes = [r["count"] for r in df.groupBy(*cuts(df, ["v"]).values()).count().collect()]
    assert sum(sizes) == n and max(sizes) < 0.05 * n and len(sizes) > 100


def test_the_same_doubles_for_any_partitioning(skewed):
    found = []
    for parts in (1, 4, 32):
        dealt = skewed.withColumn("v", F.col("v") / 3).repartition(parts)
        found.append(as_set(running(dealt, ["k"], ["at", "id"], {"total": "v"}), "id", "total"))
    assert found[0] == found[1] == found[2]


def test_planning_starts_no_job(spark, skewed):
    spark.sparkContext.setJobGroup("planning-only", "no job may start")
    running(skewed, ["k"], ["at", "id"], {"total": "v"}, "rank")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning-only")
    spark.sparkContext.setJobGroup("", "")


def test_cuts_of_every_kind_keep_the_order(spark):
    df = spark.range(300).select(
        (F.col("id") * 37 % 300).alias("n"),
        F.timestamp_seconds(F.col("id") * 1000).cast("timestamp_ntz").alias("t"),
        F.format_string("%03d", F.col("id")).alias("s"),
        (F.col("id") > 100).alias("b"),
    )
    for order in (["n"], ["t"], ["s"], ["b", "n"]):
        rows = running(df, [], order, rank="r").orderBy(*order).select("r").collect()
        assert [r["r"] for r in rows] == list(range(1, 301))


@pytest.mark.parametrize("keys", [["k"], []])
def test_quantiles_equal_builtin(skewed, keys):
    probs = [0.0, 0.25, 0.5, 0.77, 1.0]
    listed = ", ".join(map(str, probs))
    grid = F.array(*map(F.lit, probs))
    plain = skewed.groupBy(*keys).agg(F.expr(f"percentile(v, array({listed}))").alias("q"))
    plain = plain.select(*keys, F.inline(F.arrays_zip(grid.alias("prob"), F.col("q").alias("quantile"))))
    columns = [*keys, "prob", F.round("quantile", 9).alias("q")]
    assert as_set(plain.filter("quantile is not null"), *columns) == as_set(exact_quantiles(skewed, "v", probs, keys), *columns)


def test_median_and_discrete_quantiles_against_python(spark):
    values = [5.0, 1.0, 4.0, 1.0, 9.0, 2.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_quantiles(df, "v", [0.5]).first()["quantile"] == statistics.median(values)
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(df, "v", [0.0, 0.5, 0.51, 1.0], discrete=True).collect()}
    assert got == {0.0: 1.0, 0.5: 2.0, 0.51: 4.0, 1.0: 9.0}
    grid = {r["prob"]: r["quantile"] for r in quantile_grid(df, "v", 4).collect()}
    assert grid == {0.0: 1.0, 0.25: 1.0, 0.5: 2.0, 0.75: 5.0, 1.0: 9.0}


def test_constant_and_empty_columns_have_densities(spark):
    same = spark.createDataFrame([(2.0, 1), (2.0, 1)], "v double, k int")
    rows = distribution.histogram(same, "v", bins=4).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 0, 0, 0] and rows[0]["density"] is None
    assert distribution.class_histogram(same, "v", "k", bins=4).first()["n"] == 2
    assert exact_quantiles(same.limit(0), "v", [0.5]).collect() == []


def test_null_safe_join_keeps_null_keys(spark):
    left = spark.createDataFrame([(None, 1), (2, 2)], "k long, a int")
    right = spark.createDataFrame([(None, "n"), (2, "t")], "k long, b string")
    assert as_set(join_null_safe(left, right, ["k"]), "k", "a", "b") == [(2, 2, "t"), (None, 1, "n")]


class _Session:
    """A session that only answers what the folder choice asks for."""

    def __init__(self, configured=None, current=None, master="local[2]"):
        settings = {} if configured is None else {"spark.checkpoint.dir": configured}
        self.conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: current)


def test_intermediate_tables_go_to_the_named_folder():
    assert fresh_path(_Session(configured="hdfs://shared/ck/"), "x").startswith("hdfs://shared/ck/x-")
    assert fresh_path(_Session(current="s3a://b/ck"), "x").startswith("s3a://b/ck/x-")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        fresh_path(_Session(master="yarn"), "x")
