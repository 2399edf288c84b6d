"""Density, histogram, quantile and correlation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import distribution as dist
from ledgerloom.operators.timeseries import rounded
from ledgerloom.plans.fixtures import with_transfers
from ledgerloom.plans.ledger_queries import transfers
from ledgerloom.plans.registry import query
from ledgerloom.sources.tables import Tables


def _amounts(spark, folder):
    sent = transfers(spark, folder, currencies=False)
    amount = F.col("amount")
    return sent.select("id", "is_laundering", "amount", F.log10(F.when(amount > 0, amount)).alias("log_amount"))


def _kde_sql(value: str, key: str, points: int, digits: int) -> str:
    return with_transfers(
        f""", d AS (SELECT {key} AS k, {value} AS v FROM t WHERE amount > 0),
        s AS (SELECT k, count(*) AS n, 1.06 * stddev_samp(v) * pow(count(*), -0.2) AS h,
                     quantile_disc(v, 0.001) AS lo, quantile_disc(v, 0.999) AS hi FROM d GROUP BY k),
        g AS (SELECT s.*, i, lo + (hi - lo) * i / {points - 1} AS x FROM s, range({points}) r(i))
        SELECT g.k AS is_laundering, CAST(g.i AS INTEGER) AS i, round(any_value(x), 6) AS x,
               round(sum(exp(-0.5 * pow((x - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), {digits}) AS density
        FROM g JOIN d ON d.k = g.k GROUP BY g.k, g.i"""
    )


@query("kde_amount", _kde_sql("amount", "1", 256, 14).replace("g.k AS is_laundering, ", ""))
def _kde_amount(spark, folder):
    curve = dist.kde(_amounts(spark, folder), "amount")
    return rounded(rounded(curve, 6, "x"), 14, "density")


@query("class_kde", _kde_sql("log10(amount)", "is_laundering", 64, 8))
def _class_kde(spark, folder):
    curve = dist.kde(_amounts(spark, folder), "log_amount", ["is_laundering"], points=64)
    return rounded(rounded(curve, 6, "x"), 8, "density")


@query(
    "kde_2d",
    """WITH d AS (SELECT l_returnflag AS k, l_quantity AS x, l_discount AS y, count(*) AS w FROM lineitem GROUP BY 1, 2, 3),
       s AS (SELECT l_returnflag AS k, count(*) AS n, stddev_samp(l_quantity) * pow(count(*), -1.0 / 6) AS hx,
                    stddev_samp(l_discount) * pow(count(*), -1.0 / 6) AS hy, min(l_quantity) AS x0, max(l_quantity) AS x1,
                    min(l_discount) AS y0, max(l_discount) AS y1 FROM lineitem GROUP BY 1),
       g AS (SELECT s.*, a.i, b.j, x0 + (x1 - x0) * a.i / 15 AS gx, y0 + (y1 - y0) * b.j / 15 AS gy
             FROM s, range(16) a(i), range(16) b(j))
       SELECT g.k AS l_returnflag, g.i, g.j,
              round(sum(w * exp(-0.5 * (pow((gx - x) / hx, 2) + pow((gy - y) / hy, 2))))
                    / (any_value(n) * any_value(hx) * any_value(hy) * 2 * pi()), 8) AS density
       FROM g JOIN d ON d.k = g.k GROUP BY g.k, g.i, g.j""",
)
def _kde_2d(spark, folder):
    return rounded(dist.kde_2d(Tables(spark, folder).lineitem, "l_quantity", "l_discount", ["l_returnflag"]), 8, "density")


_BINS = """, e AS (SELECT quantile_disc(amount, 0.001) AS lo, quantile_disc(amount, 0.999) AS hi FROM t),
  c AS (SELECT least(CAST(floor((amount - lo) / ((hi - lo) / 200)) AS BIGINT), 199) AS bin, count(*) AS n
        FROM t, e WHERE amount BETWEEN lo AND hi GROUP BY 1),
  h AS (SELECT r.bin, lo + (hi - lo) / 200 * (r.bin + 0.5) AS center, coalesce(n, 0) AS n,
               coalesce(n, 0) / ((SELECT sum(n) FROM c) * ((hi - lo) / 200)) AS density
        FROM range(200) r(bin) CROSS JOIN e LEFT JOIN c ON c.bin = r.bin)"""


@query("histogram_density", with_transfers(f"{_BINS} SELECT bin, round(center, 4) AS center, n, round(density, 14) AS density FROM h"))
def _histogram_density(spark, folder):
    bins = dist.histogram(_amounts(spark, folder), "amount")
    return rounded(rounded(bins, 4, "center"), 14, "density")


@query(
    "hist_smoothed",
    with_transfers(
        f"""{_BINS}, k AS (SELECT o, exp(-(o * o) / (2 * 2.5 * 2.5)) AS g FROM range(-15, 16) r(o))
        SELECT h.bin, round(any_value(h.density), 14) AS density,
               round(sum(s.density * g / (SELECT sum(g) FROM k)), 14) AS smoothed
        FROM h, k, h s WHERE s.bin = h.bin - k.o GROUP BY h.bin"""
    ),
)
def _hist_smoothed(spark, folder):
    smoothed = dist.smooth(dist.histogram(_amounts(spark, folder), "amount"))
    return rounded(smoothed.select("bin", "density", "smoothed"), 14, "density", "smoothed")


@query(
    "class_histogram",
    with_transfers(
        """, d AS (SELECT is_laundering, log10(amount) AS v FROM t WHERE amount > 0),
        e AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n FROM d)
        SELECT is_laundering, least(CAST(floor((v - lo) / ((hi - lo) / 40)) AS BIGINT), 39) AS bin, count(*) AS n,
               round(count(*) / (any_value(e.n) * any_value((hi - lo) / 40)), 8) AS density FROM d, e GROUP BY 1, 2"""
    ),
)
def _class_histogram(spark, folder):
    return rounded(dist.class_histogram(_amounts(spark, folder), "log_amount", "is_laundering"), 8, "density")


@query(
    "ecdf",
    with_transfers(
        """SELECT amount AS value, count(*) AS n,
                  round(sum(count(*)) OVER (ORDER BY amount) / CAST(sum(count(*)) OVER () AS DOUBLE), 9) AS ecdf FROM t GROUP BY amount"""
    ),
)
def _ecdf(spark, folder):
    return rounded(dist.ecdf(_amounts(spark, folder), "amount"), 9, "ecdf")


@query(
    "ecdf_grid",
    with_transfers(
        """, o AS (SELECT amount, row_number() OVER (ORDER BY amount) AS rn, count(*) OVER () AS n FROM t),
        p AS (SELECT CAST(i AS DOUBLE) / 1000 AS prob FROM range(1001) r(i))
        SELECT prob, amount AS quantile FROM p JOIN o ON rn = greatest(1, CAST(ceil(prob * n) AS BIGINT))"""
    ),
)
def _ecdf_grid(spark, folder):
    return dist.ecdf_grid(_amounts(spark, folder), "amount")


@query(
    "log_amount_summary",
    with_transfers(
        """SELECT is_laundering, count(*) AS n, round(avg(amount), 4) AS mean_amount, round(avg(lg), 6) AS mean_log_amount,
             round(quantile_cont(amount, 0.25), 4) AS q25, round(quantile_cont(amount, 0.5), 4) AS median_amount,
             round(quantile_cont(amount, 0.75), 4) AS q75, round(quantile_cont(lg, 0.25), 6) AS log_q25,
             round(quantile_cont(lg, 0.5), 6) AS log_q50, round(quantile_cont(lg, 0.75), 6) AS log_q75
           FROM (SELECT *, CASE WHEN amount > 0 THEN log10(amount) END AS lg FROM t) GROUP BY is_laundering"""
    ),
)
def _log_amount_summary(spark, folder):
    summary = dist.class_summary(transfers(spark, folder, currencies=False), "amount", "is_laundering")
    four = rounded(summary, 4, "mean_amount", "q25", "median_amount", "q75")
    return rounded(four, 6, "mean_log_amount", "log_q25", "log_q50", "log_q75")


@query(
    "box_stats",
    with_transfers(
        """, d AS (SELECT is_laundering, log10(amount) AS v FROM t WHERE amount > 0),
        q AS (SELECT is_laundering AS k, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q75
              FROM d GROUP BY 1)
        SELECT is_laundering, count(*) AS n, round(any_value(q25), 6) AS q25, round(any_value(median), 6) AS median,
               round(any_value(q75), 6) AS q75,
               round(min(v) FILTER (v >= q25 - 1.5 * (q75 - q25)), 6) AS whisker_low,
               round(max(v) FILTER (v <= q75 + 1.5 * (q75 - q25)), 6) AS whisker_high,
               count(*) FILTER (v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)) AS n_outliers
        FROM d JOIN q ON k = is_laundering GROUP BY is_laundering"""
    ),
)
def _box_stats(spark, folder):
    boxes = dist.box_stats(_amounts(spark, folder), "log_amount", "is_laundering")
    return rounded(boxes, 6, "q25", "median", "q75", "whisker_low", "whisker_high")


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query(
    "corr_matrix",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in _CORR for b in _CORR),
)
def _corr_matrix(spark, folder):
    return rounded(dist.corr_matrix(Tables(spark, folder).lineitem, _CORR), 6, "corr")
