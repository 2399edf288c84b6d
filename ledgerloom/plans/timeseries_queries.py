"""Windowed and hub-series queries over the event pairs and the transfers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.temporal import time_columns
from ledgerloom.operators import timeseries as ts
from ledgerloom.operators.timeseries import rounded
from ledgerloom.plans.fixtures import with_pairs, with_transfers
from ledgerloom.plans.ledger_queries import transfers
from ledgerloom.plans.registry import query
from ledgerloom.sources.tables import Tables


def _pair_window(name: str, width: str, interval: str) -> None:
    sql = with_pairs(
        f"""SELECT a, b, count(*) AS cnt, round(sum(amount), 4) AS sum_amt, max(amount) AS max_amt,
                   round(avg(amount), 6) AS mean_amt, quantile_disc(amount, 0.9) AS p90_amt, max(flag) AS has_fraud,
                   win_start, win_start + INTERVAL '{interval}' AS win_end,
                   CAST(CAST(win_start AS DATE) AS VARCHAR) AS event_date
            FROM (SELECT *, time_bucket(INTERVAL '{interval}', ts, TIMESTAMP '1970-01-01') AS win_start FROM e)
            GROUP BY a, b, win_start"""
    )

    @query(name, sql)
    def run(spark, folder):
        windows = ts.pair_windows(Tables(spark, folder).event_pairs(), width)
        shown = windows.withColumn("event_date", F.col("event_date").cast("string"))
        return rounded(rounded(shown, 4, "sum_amt"), 6, "mean_amt")


for _name, _width, _interval in (
    ("pair_window_1h", "1 hour", "1 hour"),
    ("pair_window_6h", "6 hours", "6 hours"),
    ("pair_window_1d", "1 day", "1 day"),
    ("pair_window_7d", "7 days", "7 days"),
):
    _pair_window(_name, _width, _interval)


@query(
    "time_columns",
    """SELECT event_id AS id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour,
              CAST(date_trunc('week', ts) AS TIMESTAMP) AS event_week, CAST(month(ts) AS INTEGER) AS event_month,
              CAST(year(ts) AS INTEGER) AS event_year FROM events""",
)
def _time_columns(spark, folder):
    pairs = Tables(spark, folder).event_pairs()
    return time_columns(pairs, "ts").select(
        "id", F.col("event_date").cast("string").alias("event_date"), "event_hour", "event_week", "event_month", "event_year"
    )


@query(
    "daily_counts",
    with_transfers(
        """SELECT CAST(CAST(date_time AS DATE) AS VARCHAR) AS day, count(*) AS event_count FROM t GROUP BY 1"""
    ),
)
def _daily_counts(spark, folder):
    daily = ts.daily_counts(transfers(spark, folder, currencies=False), "date_time")
    return daily.withColumn("day", F.col("day").cast("string"))


STEPS = ", ".join(f"('{name}', {minutes})" for name, minutes in ts.GRANULARITIES.items())
SERIES = f"""
g(granularity, width) AS (VALUES {STEPS}),
s AS (
  SELECT a AS hub_id, granularity, TIMESTAMP '1970-01-01' + to_minutes(width * (minute // width)) AS bucket,
         sum(amount) AS net, sum(flag) AS flagged, count(*) AS n
  FROM (SELECT *, CAST(floor(epoch(ts) / 60) AS BIGINT) AS minute FROM e), g GROUP BY ALL)
"""


def _series(spark, folder):
    return ts.hub_series(
        Tables(spark, folder).event_pairs(),
        "a",
        "ts",
        {"net": F.col("amount"), "flagged": F.col("flag"), "n": F.lit(1)},
    )


@query(
    "hub_series",
    with_pairs(f", {SERIES} SELECT hub_id, granularity, bucket, round(net, 4) AS net, CAST(flagged AS BIGINT) AS flagged, n FROM s"),
)
def _hub_series(spark, folder):
    return rounded(_series(spark, folder), 4, "net")


@query(
    "hub_window_metrics",
    with_pairs(
        f""", {SERIES},
        r AS (SELECT *, CASE WHEN count(*) OVER w = 7 THEN avg(net) OVER w END AS rm,
                        CASE WHEN count(*) OVER w = 7 THEN stddev_samp(net) OVER w END AS rs
              FROM s WINDOW w AS (PARTITION BY hub_id, granularity ORDER BY bucket ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
        q AS (SELECT hub_id, granularity, quantile_cont(net, 0.25) AS q1, quantile_cont(net, 0.75) AS q3, avg(net) AS mu,
                     var_pop(net) AS v2 FROM s GROUP BY 1, 2)
        SELECT hub_id, granularity, count(*) AS n_points, round(avg(net), 6) AS mean, round(stddev_samp(net), 6) AS std,
               round(stddev_samp(net) / nullif(avg(net), 0), 6) AS variance_ratio, round(quantile_cont(net, 0.5), 6) AS median,
               round(any_value(q3 - q1), 6) AS iqr,
               round(avg(pow(net - mu, 3)) / pow(nullif(any_value(v2), 0), 1.5), 4) AS skew,
               round(avg(pow(net - mu, 4)) / pow(nullif(any_value(v2), 0), 2) - 3, 4) AS kurtosis,
               round(avg(CASE WHEN net < q1 - 1.5 * (q3 - q1) OR net > q3 + 1.5 * (q3 - q1) THEN 1.0 ELSE 0.0 END), 6) AS outlier_frac_1_5iqr,
               round(stddev_samp(rm), 6) AS roll_mean_std, round(stddev_samp(rs), 6) AS roll_std_std
        FROM r JOIN q USING (hub_id, granularity) GROUP BY hub_id, granularity"""
    ),
)
def _hub_window_metrics(spark, folder):
    metrics = ts.hub_metrics(_series(spark, folder))
    six = ["mean", "std", "variance_ratio", "median", "iqr", "outlier_frac_1_5iqr", "roll_mean_std", "roll_std_std"]
    return rounded(rounded(metrics, 6, *six), 4, "skew", "kurtosis")


_LAGS = 10
_LAGGED = ", ".join(f"sum(d * coalesce(lag_{k}, 0)) AS p{k}" for k in range(1, _LAGS + 1))
_LAG_COLUMNS = ", ".join(f"lag(d, {k}) OVER w AS lag_{k}" for k in range(1, _LAGS + 1))
_RATIOS = [f"(p{k} / nullif(CASE WHEN ss > 1e-12 THEN ss END, 0))" for k in range(1, _LAGS + 1)]


@query(
    "hub_acf",
    with_pairs(
        f""", {SERIES},
        d AS (SELECT *, flagged / CAST(n AS DOUBLE) AS share, net - avg(net) OVER (PARTITION BY hub_id, granularity) AS d FROM s),
        l AS (SELECT *, {_LAG_COLUMNS} FROM d WINDOW w AS (PARTITION BY hub_id, granularity ORDER BY bucket)),
        a AS (SELECT hub_id, granularity, count(*) AS n_points, sum(d * d) AS ss, {_LAGGED},
                     CASE WHEN stddev_pop(net) > 1e-9 AND stddev_pop(share) > 1e-9
                          THEN covar_pop(net, share) / (stddev_pop(net) * stddev_pop(share)) END AS c
              FROM l GROUP BY 1, 2)
        SELECT hub_id, granularity, n_points, round({' + '.join(f'{r} * {r}' for r in _RATIOS)}, 6) AS acf_energy,
               round(greatest({', '.join(f'abs({r})' for r in _RATIOS)}), 6) AS acf_max_abs,
               round(abs({_RATIOS[0]}), 6) AS abs_autocorr_lag1, round(c, 6) AS corr_net_share
        FROM a"""
    ),
)
def _hub_acf(spark, folder):
    series = _series(spark, folder).withColumn("flag_share", F.col("flagged") / F.col("n"))
    acf = ts.hub_autocorrelation(series, lags=_LAGS)
    return rounded(acf, 6, "acf_energy", "acf_max_abs", "abs_autocorr_lag1", "corr_net_share")


@query("hub_pacf_decomp")
def _hub_pacf_decomp(spark, folder):
    return ts.hub_decomposition(_series(spark, folder))


def _rates_sql(side: str) -> str:
    return with_transfers(
        f"""SELECT {side}_account, count(*) AS total_tx, count(*) FILTER (is_laundering = 1) AS fraud_tx,
                   count(*) FILTER (is_laundering = 0) AS nonfraud_tx,
                   round(count(*) FILTER (is_laundering = 1) / CAST(count(*) AS DOUBLE), 6) AS fraud_rate
            FROM t GROUP BY {side}_account"""
    )


@query("sender_fraud_rate", _rates_sql("sender"))
def _sender_fraud_rate(spark, folder):
    rates = ts.flag_rates(transfers(spark, folder, currencies=False), "sender_account", "is_laundering")
    return rounded(rates, 6, "fraud_rate").orderBy(F.desc("fraud_rate"), "sender_account")


@query("receiver_fraud_rate", _rates_sql("receiver"))
def _receiver_fraud_rate(spark, folder):
    rates = ts.flag_rates(transfers(spark, folder, currencies=False), "receiver_account", "is_laundering")
    return rounded(rates, 6, "fraud_rate").orderBy(F.desc("fraud_tx"), "receiver_account")


def _role_sql(side: str) -> str:
    base = f"""SELECT {side}_account AS account, count(*) AS total_tx, count(*) FILTER (is_laundering = 1) AS fraud_tx
               FROM t GROUP BY {side}_account"""
    return f"""
        SELECT 'top_{side}' AS role, * FROM (SELECT * FROM ({base}) ORDER BY fraud_tx DESC, total_tx DESC, account LIMIT 1)
        UNION ALL
        SELECT 'cleanest_{side}' AS role, * FROM (SELECT * FROM ({base})
          ORDER BY fraud_tx / CAST(total_tx AS DOUBLE), total_tx DESC, account LIMIT 1)"""


@query("hub_roles", with_transfers(f"{_role_sql('sender')} UNION ALL {_role_sql('receiver')}"))
def _hub_roles(spark, folder):
    return ts.hub_roles(
        transfers(spark, folder, currencies=False), "sender_account", "receiver_account", "is_laundering"
    )
