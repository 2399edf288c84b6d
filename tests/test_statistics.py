"""Association, densities, profiles and samples on hand-made data."""

import bisect
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import binning, text
from ledgerloom.operators import contingency as ct
from ledgerloom.operators import distribution as dist
from ledgerloom.operators import profile
from ledgerloom.operators import sampling
from ledgerloom.operators import timeseries as ts


def table(spark, counts):
    rows = [(r, c) for (r, c), n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "r string, c string")


def dense_chi2(counts, yates=False):
    rows, columns = sorted({r for r, _ in counts}, key=str), sorted({c for _, c in counts}, key=str)
    n = sum(counts.values())
    total = 0.0
    for r in rows:
        for c in columns:
            e = sum(counts.get((r, k), 0) for k in columns) * sum(counts.get((k, c), 0) for k in rows) / n
            gap = abs(counts.get((r, c), 0) - e)
            total += (gap - min(0.5, gap)) ** 2 / e if yates else gap**2 / e
    return total


TABLES = [
    {("a", "x"): 10, ("a", "y"): 5, ("b", "x"): 3, ("b", "y"): 12},
    {("a", "x"): 10, ("b", "x"): 3, ("b", "y"): 12},
    {("a", "x"): 10, ("b", "y"): 12},
    {("a", "x"): 1, ("b", "y"): 1},
    {("a", "x"): 7, (None, "y"): 4, ("b", "y"): 2, ("b", "x"): 1},
    {("a", "x"): 7, ("b", "y"): 4, ("c", "z"): 2, ("c", "x"): 1},
]


@pytest.mark.parametrize("counts", TABLES)
def test_chi2_counts_empty_cells(spark, counts):
    got = ct.chi2_cramers_v(table(spark, counts), "r", "c").first()
    assert got["chi2"] == pytest.approx(dense_chi2(counts))
    assert got["n"] == sum(counts.values()) and 0 <= got["cramers_v"]
    assert got["r"] == len({r for r, _ in counts}) and got["k"] == len({c for _, c in counts})


@pytest.mark.parametrize("counts", TABLES[:4])
def test_yates(spark, counts):
    got = ct.chi2_cramers_v(table(spark, counts), "r", "c", bias_corrected=False, yates=True).first()
    assert got["chi2"] == pytest.approx(dense_chi2(counts, yates=True))
    assert 0 <= got["cramers_v"] <= 1


def test_sparse_chi2_skips_empty_cells(spark):
    counts = TABLES[1]
    got = ct.chi2_cramers_v(table(spark, counts), "r", "c", sparse=True).first()
    n, gone = sum(counts.values()), 10 * 12 / 25
    assert got["chi2"] == pytest.approx(dense_chi2(counts) - gone) and got["n"] == n


def test_single_row_table_has_no_association(spark):
    got = ct.chi2_cramers_v(table(spark, {("a", "x"): 3, ("a", "y"): 4}), "r", "c").first()
    assert got["dof"] == 0 and got["cramers_v"] == 0


def test_p_values(spark):
    got = ct.chi2_p_values(table(spark, TABLES[0]), ["r"], "c").first()
    assert got["chi2"] == pytest.approx(dense_chi2(TABLES[0])) and 0 < got["p_value"] < 0.05


def test_kde_against_definition(spark):
    values = [1.0, 1.0, 2.0, 4.0, 8.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    rows = dist.kde(df, "v", points=5, tails=(0.0, 1.0)).orderBy("i").collect()
    mean = sum(values) / 5
    sd = math.sqrt(sum((v - mean) ** 2 for v in values) / 4)
    h = 1.06 * sd * 5 ** -0.2
    for row in rows:
        want = sum(math.exp(-0.5 * ((row["x"] - v) / h) ** 2) for v in values) / (5 * h * math.sqrt(2 * math.pi))
        assert row["density"] == pytest.approx(want)
    assert [row["x"] for row in rows] == pytest.approx([1.0, 2.75, 4.5, 6.25, 8.0])


def test_constant_sample_has_a_density(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert dist.kde(df, "v", points=2).filter("density > 0").count() == 2


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4]], "v double")
    rows = dist.histogram(df, "v", bins=2, tails=(0.0, 1.0)).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 3]
    assert sum(r["density"] * 2 for r in rows) == pytest.approx(1.0)


def test_smoothing_preserves_mass_inside(spark):
    bins = spark.range(101).select(F.col("id").alias("bin"), (F.col("id") == 50).cast("double").alias("density"))
    smoothed = dist.smooth(bins)
    assert smoothed.agg(F.sum("smoothed")).first()[0] == pytest.approx(1.0)
    assert smoothed.count() == 101


def test_ecdf_of_a_small_column(spark):
    df = spark.createDataFrame([(v,) for v in [3, 1, 3, 2, None]], "v int")
    rows = {r["value"]: r["ecdf"] for r in dist.ecdf(df, "v").collect()}
    assert rows == {1: 0.25, 2: 0.5, 3: 1.0}


def test_box_stats_distributed(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", 5.0)], "k string, v double")
    rows = {r["k"]: r for r in dist.box_stats(df, "v", "k").collect()}
    assert rows["a"]["n_outliers"] == 1 and rows["a"]["whisker_high"] == 4.0 and rows["a"]["median"] == 3.0
    assert rows["b"]["q25"] == rows["b"]["whisker_low"] == 5.0


def test_correlation_of_constant_and_gappy_columns(spark):
    df = spark.createDataFrame(
        [(1.0, 5.1, 2.0), (2.0, 5.1, None), (3.0, 5.1, 6.5), (4.0, 5.1, 8.0)], "a double, b double, c double"
    )
    r = {(x["a"], x["b"]): x["corr"] for x in dist.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert r[("a", "b")] is None and r[("b", "b")] is None and r[("a", "a")] == pytest.approx(1.0)
    xs, ys = [1, 3, 4], [2, 6.5, 8]
    mx, my = sum(xs) / 3, sum(ys) / 3
    want = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / math.sqrt(
        sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys)
    )
    assert r[("a", "c")] == r[("c", "a")] == pytest.approx(want)


def test_null_summary_kinds(spark):
    df = spark.createDataFrame(
        [(1.0, "x"), (float("nan"), " "), (float("inf"), None), (None, ""), (float("-inf"), "y")], "v double, s string"
    )
    rows = {r["column"]: r for r in profile.null_summary(df).collect()}
    assert (rows["v"]["n_missing"], rows["v"]["n_infinite"], rows["s"]["n_missing"]) == (2, 2, 3)
    assert rows["v"]["pct_missing"] == 40.0
    strict = {r["column"]: r["n_missing"] for r in profile.null_summary(df, blanks=False).collect()}
    assert strict == {"v": 2, "s": 1}
    assert profile.null_summary(df.limit(0)).filter("pct_missing <> 0").count() == 0


def test_key_violations_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, s string")
    assert profile.key_violations(df, ["k"]).first().asDict() == {
        "duplicate_keys": 1, "surplus_rows": 2, "null_key_rows": 2,
    }
    assert profile.duplicate_rows(df).first()["n_duplicates"] == 2


def test_describe_and_top_k(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "s string")
    row = profile.describe_object(df, ["s"]).first()
    assert (row["count"], row["unique"], row["top"], row["freq"]) == (4, 3, "a", 2)
    kept = profile.top_k_or_other(df, "s", 1)
    assert sorted(r[0] for r in kept.collect()) == ["OTHER", "OTHER", "OTHER", "a", "a"]


def test_names_titles_and_prefixes(spark):
    assert text.snake_names([" Total-Price (USD)", "total__price usd", "_STATUS_", "Fecha/Año"]) == [
        "total_price_usd", "total_price_usd_2", "status", "fecha_a_o",
    ]
    df = spark.createDataFrame(
        [("Braund, Mr. Owen", "A/5 21171", "C85"), ("Oliva, Dona. F", "113803", None), ("X, Mlle. Y", "PC 1", "")],
        "name string, ticket string, cabin string",
    )
    rows = df.select(
        text.title_group("name"), text.ticket_prefix("ticket"), text.first_letter("cabin")
    ).collect()
    assert [tuple(r) for r in rows] == [("Mr", "A/", "C"), (None, "NONE", "Unknown"), ("Miss", "PC", "Unknown")]


def test_currency_spellings(spark):
    df = spark.createDataFrame([(" EUR ",), ("£",), ("GBP",), ("Yen",), (None,)], "c string")
    got = [r[0] for r in df.select(text.currency_class("c")).collect()]
    assert got == ["Euro", "UK pounds", "UK pounds", "Other", "Other"]


def test_cut_is_left_closed(spark):
    df = spark.createDataFrame([(0.0,), (2.9,), (3.0,), (60.0,), (-1.0,), (None,)], "age double")
    got = [r[0] for r in df.select(binning.cut("age", binning.AGE_EDGES, binning.AGE_LABELS)).collect()]
    assert got == ["Toddler", "Toddler", "Child", "Senior", None, None]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select("id", (F.col("id") % 10 == 0).cast("int").alias("c"))
    picks = [
        {r["id"] for r in sampling.hash_sample(df.repartition(n), "id", 0.2).collect()} for n in (1, 3, 7)
    ]
    assert picks[0] == picks[1] == picks[2] and 800 < len(picks[0]) < 1200
    strata = sampling.stratified_sample(df, "id", "c", 500).groupBy("c").count().collect()
    assert {r["c"]: r["count"] for r in strata}[1] == 500
    folds = sampling.stratified_folds(df, "id", "c", 5).groupBy("c", "fold").count().collect()
    assert {(r["c"], r["count"]) for r in folds} == {(0, 900), (1, 100)}


def test_hub_decomposition_of_a_weekly_pattern(spark):
    rows = [(1, "1 day", i, float((i % 7) * 10 + i)) for i in range(70)] + [(2, "1 day", i, 3.0) for i in range(20)]
    series = spark.createDataFrame(rows, "hub_id long, granularity string, bucket long, net double")
    got = {r["hub_id"]: r for r in ts.hub_decomposition(series).collect()}
    assert got[1]["seasonal_var_ratio"] > 0.3 and got[1]["trend_var_ratio"] > 0.3
    assert got[1]["resid_var_ratio"] < 0.05 and got[1]["pacf_max_abs"] > 0.3
    assert math.isnan(got[2]["pacf_energy"] or math.nan)


def test_hub_decomposition_reads_series_across_batches(spark):
    rows = [(hub, step, i, float((i * 7 + (hub or 5)) % 11)) for hub in (None, 0, 1) for step, n in (("1 day", 33), ("1 hour", 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "hub_id long, granularity string, bucket int, net double").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        measured = ts.hub_decomposition(df)
        got = {(r["hub_id"], r["granularity"]): r for r in measured.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # one call a series costs milliseconds each
    assert "FlatMapGroups" not in measured._jdf.queryExecution().optimizedPlan().toString()
    assert len(got) == 6
    for (hub, step), r in got.items():
        x = np.array([v for h, s, _, v in rows if (h, s) == (hub, step)])
        partial = ts._partial_autocorrelation(x, 10)
        shares = ts._variance_shares(x, 7) if step == "1 day" else (None,) * 3
        assert tuple(r)[2:] == (len(x), (partial**2).sum(), np.abs(partial).max(), *shares)


def test_series_sums_agree_across_granularities(spark, folder):
    from ledgerloom.plans.timeseries_queries import _series

    totals = _series(spark, folder).groupBy("granularity").agg(F.round(F.sum("net"), 3).alias("t")).collect()
    assert len(totals) == 9 and len({r["t"] for r in totals}) == 1


def test_binned_densities_equal_the_kernel_sums(spark):
    """Heavy tails, ties, one far outlier and a class without spread."""
    chance = random.Random(2)
    rows = [("a", math.exp(chance.gauss(3, 1.5))) for _ in range(700)] + [("a", 1e9), ("a", None)]
    rows += [("b", float(chance.randrange(20))) for _ in range(300)] + [("c", 7.0)] * 3
    df = spark.createDataFrame(rows, "k string, v double")
    got = {(r["k"], r["i"]): (r["x"], r["density"]) for r in dist.kde(df, "v", ["k"], points=40, tails=(0.01, 0.99)).collect()}
    assert len(got) == 120
    for k in "abc":
        values = [v for key, v in rows if key == k and v is not None]
        sd = statistics.stdev(values)
        h = 1.06 * sd * len(values) ** -0.2 if sd else 1.0
        for i in range(40):
            x, density = got[k, i]
            want = sum(math.exp(-0.5 * ((x - v) / h) ** 2) for v in values) / (len(values) * h * math.sqrt(2 * math.pi))
            assert density == pytest.approx(want, rel=1e-9, abs=1e-13 / h)


def test_binned_joint_density_equals_the_kernel_sums(spark):
    chance = random.Random(3)
    rows = [("a", chance.gauss(0, 3), math.exp(chance.gauss(0, 1))) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    xs, ys = [r[1] for r in rows], [r[2] for r in rows]
    hx, hy = (statistics.stdev(v) * len(rows) ** (-1 / 6) for v in (xs, ys))
    for r in dist.kde_2d(df, "x", "y", ["k"], points=6).collect():
        px = min(xs) + (max(xs) - min(xs)) * r["i"] / 5
        py = min(ys) + (max(ys) - min(ys)) * r["j"] / 5
        want = sum(math.exp(-0.5 * (((px - x) / hx) ** 2 + ((py - y) / hy) ** 2)) for x, y in zip(xs, ys))
        assert r["density"] == pytest.approx(want / (len(rows) * hx * hy * 2 * math.pi), rel=1e-8, abs=1e-13)


@pytest.mark.parametrize("error", [0.05, 0.005])
def test_sketched_quantiles_keep_their_rank_error(spark, error):
    chance = random.Random(6)
    rows = [(i % 9, math.exp(chance.gauss(0, 3))) for i in range(30_000)] + [(3, 5.0)] * 9_000 + [(4, None)] * 10
    df = spark.createDataFrame(rows, "day int, v double").repartition(7)
    sketches = profile.quantile_sketches(df, "v", ["day"], error)
    assert sketches.count() == 9
    values = sorted(v for _, v in rows if v is not None)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    for keys, own in (([], values), (["day"], None)):
        for r in profile.sketched_quantiles(sketches, probs, keys).collect():
            mine = own or sorted(v for d, v in rows if d == r["day"] and v is not None)
            below, upto = bisect.bisect_left(mine, r["quantile"]), bisect.bisect_right(mine, r["quantile"])
            assert r["n"] == len(mine)
            assert below / len(mine) - error <= r["prob"] <= upto / len(mine) + error


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "day int, v double")
    assert profile.sketched_quantiles(profile.quantile_sketches(df, "v", ["day"]), [0.5]).collect() == []


def test_distinct_counts_by_bits_and_by_values(spark):
    rows = [(i % 7 - 3, (i * 7919) ** 4 % (1 << 60), i // 2 + 40_000, None if i % 3 else i, f"t{i % 5}", None) for i in range(90_000)]
    df = spark.createDataFrame(rows, "few int, sparse long, dense long, holes int, text string, empty long").repartition(5)
    want = {c: len({r[i] for r in rows if r[i] is not None}) for i, c in enumerate(df.columns)}
    counted = profile.distinct_counts(df, df.columns)
    assert {r["column"]: r["n_distinct"] for r in counted.collect()} == want
    plan = counted._jdf.queryExecution().toString()
    assert "bitmap_construct_agg" in plan
    assert {r["column"]: r["n_distinct"] for r in profile.distinct_counts(df.limit(0), ["few", "text"]).collect()} in ({}, {"few": 0, "text": 0})
