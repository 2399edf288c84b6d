"""Profiles, data checks, scans and categorical statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import binning, text
from ledgerloom.operators import contingency as ct
from ledgerloom.operators import profile
from ledgerloom.operators.sampling import hash_sample, stratified_sample
from ledgerloom.operators.timeseries import rounded
from ledgerloom.plans.fixtures import with_transfers
from ledgerloom.plans.ledger_queries import transfers
from ledgerloom.plans.registry import query
from ledgerloom.runtime import stage
from ledgerloom.sources.tables import Tables

CATEGORIES = ["payment_currency", "received_currency", "payment_type", "is_laundering", "laundering_type"]


def _long_sql(columns: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", CAST({name} AS VARCHAR) AS value FROM {table}" for name in columns
    )


_COUNTS_SQL = with_transfers(
    f"""SELECT "column", value, count(*) AS "count" FROM ({_long_sql(["sender_account", "receiver_account", *CATEGORIES], "t")})
        GROUP BY "column", value"""
)


@query("value_counts", _COUNTS_SQL)
def _value_counts(spark, folder):
    return profile.value_counts(transfers(spark, folder), ["sender_account", "receiver_account", *CATEGORIES])


@query(
    "value_counts_by_key",
    with_transfers(f"""SELECT "column", value, count(*) AS "count" FROM ({_long_sql(CATEGORIES, "t")}) GROUP BY "column", value"""),
)
def _value_counts_by_key(spark, folder):
    return profile.value_counts(transfers(spark, folder), CATEGORIES, by_key=True)


@query(
    "location_counts",
    """SELECT n_name AS location, count(*) AS "count" FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def _location_counts(spark, folder):
    return Tables(spark, folder).accounts().groupBy("location").count().orderBy(F.desc("count"), "location")


@query(
    "distinct_counts",
    with_transfers(
        f"""SELECT "column", count(DISTINCT value) AS n_distinct
            FROM ({_long_sql(["id", "sender_account", "receiver_account", *CATEGORIES], "t")}) GROUP BY "column" """
    ),
)
def _distinct_counts(spark, folder):
    return profile.distinct_counts(transfers(spark, folder), ["id", "sender_account", "receiver_account", *CATEGORIES])


@query(
    "range_profile",
    with_transfers(
        """SELECT min(date_time) AS min_date, max(date_time) AS max_date,
                  CAST(date_diff('day', min(date_time), max(date_time)) AS INTEGER) AS day_span,
                  min(amount) AS min_amount, max(amount) AS max_amount FROM t"""
    ),
)
def _range_profile(spark, folder):
    return profile.range_profile(transfers(spark, folder, currencies=False), "date_time", "amount")


@query(
    "validity_checks",
    with_transfers(
        """SELECT count(*) AS n, count(*) FILTER (amount <= 0) AS nonpositive_amounts,
                  count(*) FILTER (sender_account = receiver_account) AS self_transfers,
                  min(date_time) AS min_date, max(date_time) AS max_date FROM t"""
    ),
)
def _validity_checks(spark, folder):
    sent = transfers(spark, folder, currencies=False)
    return profile.validity_checks(sent, "amount", "date_time", "sender_account", "receiver_account")


_HOLED = """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN ' ' ELSE event_type END AS event_type,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN CAST('NaN' AS DOUBLE)
       WHEN event_id % 17 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE value END AS value, ts, user_id, props FROM events"""


def _holed(spark, folder):
    """Events with NULL, blank, NaN and infinite cells punched in."""
    every = lambda n: F.pmod("event_id", F.lit(n)) == 0
    return Tables(spark, folder).events.select(
        "event_id",
        F.when(every(7), None).when(every(5), " ").otherwise(F.col("event_type")).alias("event_type"),
        F.when(every(11), None)
        .when(every(13), float("nan"))
        .when(every(17), float("inf"))
        .otherwise(F.col("value"))
        .alias("value"),
        "ts",
        "user_id",
        "props",
    )


@query(
    "null_summary",
    f"""WITH h AS ({_HOLED})
        SELECT *, round(100.0 * n_missing / n_rows, 6) AS pct_missing FROM (
          SELECT 'event_id' AS "column", 'bigint' AS dtype, count(*) FILTER (event_id IS NULL) AS n_missing,
                 CAST(0 AS BIGINT) AS n_infinite, count(*) AS n_rows FROM h
          UNION ALL SELECT 'event_type', 'string', count(*) FILTER (event_type IS NULL OR trim(event_type) = ''), 0, count(*) FROM h
          UNION ALL SELECT 'value', 'double', count(*) FILTER (value IS NULL OR isnan(value)),
                           count(*) FILTER (isinf(value)), count(*) FROM h
          UNION ALL SELECT 'ts', 'timestamp_ntz', count(*) FILTER (ts IS NULL), 0, count(*) FROM h
          UNION ALL SELECT 'user_id', 'bigint', count(*) FILTER (user_id IS NULL), 0, count(*) FROM h
          UNION ALL SELECT 'props', 'string', count(*) FILTER (props IS NULL OR trim(props) = ''), 0, count(*) FROM h)""",
)
def _null_summary(spark, folder):
    return rounded(profile.null_summary(_holed(spark, folder)), 6, "pct_missing")


@query(
    "duplicate_rows",
    """SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(c - 1) AS BIGINT) AS n_duplicates FROM (
         SELECT *, count(*) AS c FROM lineitem GROUP BY ALL)""",
)
def _duplicate_rows(spark, folder):
    return profile.duplicate_rows(Tables(spark, folder).lineitem)


@query(
    "key_violations",
    """SELECT count(*) FILTER (c > 1) AS duplicate_keys, CAST(sum(c - 1) AS BIGINT) AS surplus_rows,
              CAST(0 AS BIGINT) AS null_key_rows
       FROM (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY 1, 2)""",
)
def _key_violations(spark, folder):
    return profile.key_violations(Tables(spark, folder).lineitem, ["l_orderkey", "l_linenumber"])


@query("active_accounts", with_transfers("SELECT sender_account AS account FROM t UNION SELECT receiver_account FROM t"))
def _active_accounts(spark, folder):
    return profile.active_accounts(transfers(spark, folder, currencies=False), "sender_account", "receiver_account")


@query(
    "missing_accounts",
    with_transfers(
        """SELECT DISTINCT account FROM (SELECT sender_account AS account FROM t UNION SELECT receiver_account FROM t) u
           WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = u.account AND c_acctbal > 0)"""
    ),
)
def _missing_accounts(spark, folder):
    known = Tables(spark, folder).customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("account"))
    return profile.missing_accounts(
        transfers(spark, folder, currencies=False), "sender_account", "receiver_account", known
    )


_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
            CAST(min({c}) AS DOUBLE) AS min, CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS q25, CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS q50,
            CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in _NUMERIC
    ),
)
def _describe_numeric(spark, folder):
    return rounded(profile.describe_numeric(Tables(spark, folder).lineitem), 6, "mean", "stddev")


@query(
    "describe_object",
    f"""WITH c AS (SELECT "column", value, count(*) AS n FROM ({_long_sql(["o_orderstatus", "o_orderpriority"], "orders")})
                   WHERE value IS NOT NULL GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rn FROM c)
        SELECT "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", max(value) FILTER (rn = 1) AS top, max(n) AS freq
        FROM r GROUP BY "column" """,
)
def _describe_object(spark, folder):
    return profile.describe_object(Tables(spark, folder).orders, ["o_orderstatus", "o_orderpriority"])


_PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


@query(
    "amount_quantiles",
    with_transfers(
        " UNION ALL ".join(
            f"""SELECT CAST({p} AS DOUBLE) AS prob, quantile_disc(amount, {p}) AS amount,
                round(log10(quantile_disc(amount, {p})), 6) AS log_amount FROM t WHERE amount > 0"""
            for p in _PROBS
        )
    ),
)
def _amount_quantiles(spark, folder):
    sent = transfers(spark, folder, currencies=False)
    return rounded(profile.amount_quantiles(sent, "amount", _PROBS), 6, "log_amount")


_SKETCH_ERROR = 0.01


@query(
    "amount_quantile_sketch",
    # the sketch may choose any value whose rank is near enough, so the rank is stated and not the value
    with_transfers(" UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS prob, count(*) AS n, TRUE AS within_error FROM t" for p in _PROBS)),
)
def _amount_quantile_sketch(spark, folder):
    """Daily sketches, stored and merged; each quantile's rank is then counted over all rows."""
    sent = transfers(spark, folder, currencies=False).withColumn("day", F.to_date("date_time"))
    daily = stage(profile.quantile_sketches(sent, "amount", ["day"], _SKETCH_ERROR), "amount-sketches")
    quantiles = stage(profile.sketched_quantiles(daily, _PROBS), "amount-quantiles")
    gaps = profile.rank_gaps(sent, "amount", quantiles)
    return gaps.select("prob", "n", (F.col("gap") <= _SKETCH_ERROR).alias("within_error"))


@query(
    "size_profile",
    """SELECT count(*) AS rows, round(avg(length(o_orderstatus)) + avg(length(o_orderpriority)) + 8 + 8 + 8 + 12 + 16, 6) AS bytes_per_row,
              CAST(128 AS INTEGER) AS target_bucket_mb,
              CAST(greatest(1, ceil((avg(length(o_orderstatus)) + avg(length(o_orderpriority)) + 52) * count(*) / 134217728)) AS BIGINT) AS recommended_buckets
       FROM orders""",
)
def _size_profile(spark, folder):
    sized = profile.size_profile(Tables(spark, folder).orders)
    return rounded(sized, 6, "bytes_per_row").drop("total_gb")


@query("key_bounds", "SELECT min(o_custkey) AS lo, max(o_custkey) AS hi FROM orders")
def _key_bounds(spark, folder):
    return profile.key_bounds(Tables(spark, folder).orders, "o_custkey")


_SCANNED = ["region", "nation", "customer", "orders", "lineitem", "events"]


@query("scan_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _SCANNED))
def _scan_counts(spark, folder):
    tables = Tables(spark, folder)
    counts = [getattr(tables, t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n")) for t in _SCANNED]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


_GAPS = """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type,
                  CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value FROM events"""


@query(
    "impute_mode_mean",
    f"""WITH h AS ({_GAPS})
        SELECT event_id, coalesce(event_type, (SELECT event_type FROM h WHERE event_type IS NOT NULL GROUP BY 1
                                               ORDER BY count(*) DESC, event_type LIMIT 1)) AS event_type,
               round(coalesce(value, (SELECT avg(value) FROM h)), 6) AS value FROM h""",
)
def _impute_mode_mean(spark, folder):
    every = lambda n: F.pmod("event_id", F.lit(n)) == 0
    gaps = Tables(spark, folder).events.select(
        "event_id",
        F.when(~every(7), F.col("event_type")).alias("event_type"),
        F.when(~every(11), F.col("value")).alias("value"),
    )
    return rounded(profile.mode_and_mean_fill(gaps, ["event_type"], ["value"]), 6, "value")


@query(
    "dict_map",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'trade' WHEN 'MACHINERY' THEN 'trade'
                                           WHEN 'HOUSEHOLD' THEN 'home' END AS sector FROM customer""",
)
def _dict_map(spark, folder):
    sectors = {"BUILDING": "trade", "MACHINERY": "trade", "HOUSEHOLD": "home"}
    return Tables(spark, folder).customer.select(
        "c_custkey", text.lookup(F.col("c_mktsegment"), sectors).alias("sector")
    )


@query(
    "family_features",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(l_linenumber + CAST(l_quantity AS INTEGER) + 1 AS INTEGER) AS family,
              CASE WHEN l_linenumber + CAST(l_quantity AS INTEGER) + 1 = 1 THEN 1 ELSE 0 END AS is_alone,
              round(l_extendedprice / (l_linenumber + CAST(l_quantity AS INTEGER) + 1), 9) AS fare_per_person FROM lineitem""",
)
def _family_features(spark, folder):
    from ledgerloom.operators.features import family_features

    lines = Tables(spark, folder).lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_quantity").cast("int").alias("quantity")
    )
    made = family_features(lines, "l_linenumber", "quantity", "l_extendedprice")
    return rounded(made, 9, "fare_per_person").drop("quantity")


@query(
    "currency_collapse",
    with_transfers(
        """SELECT id, CASE WHEN payment_currency IN ('Euro', 'UK pounds') THEN payment_currency ELSE 'Other' END AS payment_currency_3,
                  CASE WHEN received_currency IN ('Euro', 'UK pounds') THEN received_currency ELSE 'Other' END AS received_currency_3 FROM t"""
    ),
)
def _currency_collapse(spark, folder):
    return _collapsed(spark, folder).select("id", "payment_currency_3", "received_currency_3")


def _collapsed(spark, folder):
    return transfers(spark, folder).withColumns(
        {
            "payment_currency_3": text.currency_class("payment_currency"),
            "received_currency_3": text.currency_class("received_currency"),
        }
    )


@query(
    "first_letter",
    """SELECT deck, count(*) AS n FROM (SELECT coalesce(nullif(left(p_brand || p_type, 1), ''), 'Unknown') AS deck FROM part
       UNION ALL SELECT coalesce(nullif(left(p_name, 1), ''), 'Unknown') FROM part) GROUP BY deck""",
)
def _first_letter(spark, folder):
    parts = Tables(spark, folder).part.select(F.inline(F.array(
        F.struct(F.concat("p_brand", "p_type").alias("cabin")), F.struct(F.col("p_name").alias("cabin"))
    )))
    return parts.groupBy(text.first_letter("cabin").alias("deck")).agg(F.count("*").alias("n"))


@query(
    "ticket_prefix",
    """SELECT o_orderkey, coalesce(nullif(regexp_extract(o_orderpriority, '([A-Za-z./]+)', 1), ''), 'NONE') AS prefix FROM orders""",
)
def _ticket_prefix(spark, folder):
    return Tables(spark, folder).orders.select("o_orderkey", text.ticket_prefix("o_orderpriority").alias("prefix"))


_TITLES = "|".join(text.TITLE_GROUPS)
_TITLE_CASE = " ".join(f"WHEN '{title}' THEN '{group}'" for title, group in text.TITLE_GROUPS.items())


@query(
    "title_group",
    f"""SELECT doc_id, CASE regexp_extract(text, '\\b({_TITLES})\\.', 1) {_TITLE_CASE} END AS title FROM documents""",
)
def _title_group(spark, folder):
    return Tables(spark, folder).documents.select("doc_id", text.title_group("text").alias("title"))


def _cut_case(column: str, edges, labels) -> str:
    arms = []
    for low, high, label in zip(edges, edges[1:], labels):
        upper = "" if high == float("inf") else f" AND {column} < {high}"
        arms.append(f"WHEN {column} >= {low}{upper} THEN '{label}'")
    return f"CASE {' '.join(arms)} END"


@query(
    "age_bins",
    f"""SELECT l_orderkey, l_linenumber, l_quantity, {_cut_case('l_quantity', binning.AGE_EDGES, binning.AGE_LABELS)} AS age_group,
               {_cut_case('l_quantity', binning.FARE_EDGES, binning.FARE_LABELS)} AS fare_group FROM lineitem""",
)
def _age_bins(spark, folder):
    return Tables(spark, folder).lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        binning.cut("l_quantity", binning.AGE_EDGES, binning.AGE_LABELS).alias("age_group"),
        binning.cut("l_quantity", binning.FARE_EDGES, binning.FARE_LABELS).alias("fare_group"),
    )


_DUMMIES = ", ".join(
    f"CAST(sum(CASE WHEN g = '{label}' THEN 1 ELSE 0 END) AS BIGINT) AS agegroup_{text.snake_name(label)}"
    for label in binning.AGE_LABELS
)


@query(
    "bin_dummies",
    f"""SELECT l_returnflag, {_DUMMIES} FROM (
          SELECT l_returnflag, {_cut_case('l_quantity', binning.AGE_EDGES, binning.AGE_LABELS)} AS g FROM lineitem) GROUP BY l_returnflag""",
)
def _bin_dummies(spark, folder):
    group = binning.cut("l_quantity", binning.AGE_EDGES, binning.AGE_LABELS)
    made = binning.dummies(group, binning.AGE_LABELS, "agegroup")
    return Tables(spark, folder).lineitem.withColumns(made).groupBy("l_returnflag").agg(
        *[F.sum(name).alias(name) for name in made]
    )


# ---- categorical association -------------------------------------------------

_CELLS = """cells AS (SELECT payment_type, is_laundering, count(*) AS obs FROM t GROUP BY 1, 2)"""


@query("contingency", with_transfers("SELECT payment_type, is_laundering, count(*) AS obs FROM t GROUP BY 1, 2"))
def _contingency(spark, folder):
    return ct.contingency(transfers(spark, folder, currencies=False), "payment_type", "is_laundering")


@query(
    "contingency_rownorm",
    with_transfers(
        f""", {_CELLS} SELECT *, round(obs / CAST(sum(obs) OVER (PARTITION BY payment_type) AS DOUBLE), 6) AS share FROM cells"""
    ),
)
def _contingency_rownorm(spark, folder):
    table = ct.row_normalised(transfers(spark, folder, currencies=False), "payment_type", "is_laundering")
    return rounded(table, 6, "share")


@query(
    "chi2_contrib",
    with_transfers(
        f""", {_CELLS}, m AS (SELECT *, CAST(sum(obs) OVER (PARTITION BY payment_type) AS BIGINT) AS row_total,
               CAST(sum(obs) OVER (PARTITION BY is_laundering) AS BIGINT) AS col_total, sum(obs) OVER () AS n FROM cells)
        SELECT payment_type, is_laundering, obs, row_total, col_total, round(row_total * CAST(col_total AS DOUBLE) / n, 6) AS expected,
               round(pow(obs - row_total * CAST(col_total AS DOUBLE) / n, 2) / (row_total * CAST(col_total AS DOUBLE) / n), 6) AS chi2_term FROM m"""
    ),
)
def _chi2_contrib(spark, folder):
    terms = ct.chi2_terms(transfers(spark, folder, currencies=False), "payment_type", "is_laundering")
    return rounded(terms, 6, "expected", "chi2_term")


def _chi2_sql(row: str, column: str, cramers: str, source: str = "t") -> str:
    """Dense-grid chi-square straight from the definition."""
    return with_transfers(
        f""", src AS ({source}), c AS (SELECT {row} AS a, {column} AS b, count(*) AS obs FROM src GROUP BY 1, 2),
        grid AS (SELECT x.a, y.b, x.rt, y.ct, coalesce(c.obs, 0) AS obs, (SELECT sum(obs) FROM c) AS n
          FROM (SELECT a, sum(obs) AS rt FROM c GROUP BY a) x CROSS JOIN (SELECT b, sum(obs) AS ct FROM c GROUP BY b) y
          LEFT JOIN c ON c.a = x.a AND c.b = y.b),
        s AS (SELECT CAST(max(n) AS BIGINT) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS k,
               sum(pow(obs - rt * CAST(ct AS DOUBLE) / n, 2) / (rt * CAST(ct AS DOUBLE) / n)) AS chi2,
               sum(pow(abs(obs - rt * CAST(ct AS DOUBLE) / n) - least(0.5, abs(obs - rt * CAST(ct AS DOUBLE) / n)), 2)
                   / (rt * CAST(ct AS DOUBLE) / n)) AS yates FROM grid)
        {cramers}"""
    )


_CORRECTED = """SELECT n, r, k, (r - 1) * (k - 1) AS dof, round(chi2, 6) AS chi2,
  round(sqrt(greatest(0, chi2 / n - (r - 1) * (k - 1) / CAST(n - 1 AS DOUBLE)) /
    greatest(1e-12, least(k - (k - 1) * (k - 1) / CAST(n - 1 AS DOUBLE) - 1, r - (r - 1) * (r - 1) / CAST(n - 1 AS DOUBLE) - 1))), 6) AS cramers_v FROM s"""
_COLLAPSED = """SELECT *, CASE WHEN payment_currency IN ('Euro', 'UK pounds') THEN payment_currency ELSE 'Other' END AS payment_currency_3,
  CASE WHEN received_currency IN ('Euro', 'UK pounds') THEN received_currency ELSE 'Other' END AS received_currency_3 FROM t"""


def _chi2(name: str, row: str, source: str) -> None:
    @query(name, _chi2_sql(row, "is_laundering", _CORRECTED, source))
    def run(spark, folder):
        rows = _collapsed(spark, folder) if row.endswith("_3") else transfers(spark, folder, currencies=False)
        return rounded(ct.chi2_cramers_v(rows, row, "is_laundering"), 6, "chi2", "cramers_v")


_chi2("chi2_cramers_v", "payment_type", "SELECT * FROM t")
_chi2("chi2_payment_currency", "payment_currency_3", _COLLAPSED)
_chi2("chi2_received_currency", "received_currency_3", _COLLAPSED)


@query(
    "chi2_yates",
    _chi2_sql(
        "l_linestatus",
        "flagged",
        """SELECT n, r, k, (r - 1) * (k - 1) AS dof, round(yates, 6) AS chi2, round(sqrt(yates / (n * (least(r, k) - 1))), 6) AS cramers_v FROM s""",
        "SELECT l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flagged FROM lineitem",
    ),
)
def _chi2_yates(spark, folder):
    lines = Tables(spark, folder).lineitem.select("l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("flagged"))
    result = ct.chi2_cramers_v(lines, "l_linestatus", "flagged", bias_corrected=False, yates=True)
    return rounded(result, 6, "chi2", "cramers_v")


@query("chi2_p_values")
def _chi2_p_values(spark, folder):
    lines = Tables(spark, folder).lineitem.select("l_linestatus", "l_linenumber", "l_returnflag")
    return ct.chi2_p_values(lines, ["l_linestatus", "l_linenumber"], "l_returnflag")


# ---- top-k, rates, samples ---------------------------------------------------


def _top_sql(side: str) -> str:
    return with_transfers(
        f"""SELECT {side}_account, count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, {side}_account LIMIT 50"""
    )


def _top(side: str):
    def run(spark, folder):
        counts = transfers(spark, folder, currencies=False).groupBy(f"{side}_account").agg(F.count("*").alias("n"))
        return counts.orderBy(F.desc("n"), f"{side}_account").limit(50)

    return run


query("top_senders", _top_sql("sender"))(_top("sender"))
query("top_receivers", _top_sql("receiver"))(_top("receiver"))


@query(
    "topk_other",
    """WITH k AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 10)
       SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM k) THEN p_brand ELSE 'OTHER' END AS p_brand FROM part""",
)
def _topk_other(spark, folder):
    return profile.top_k_or_other(Tables(spark, folder).part.select("p_partkey", "p_brand"), "p_brand")


@query(
    "rate_by_category",
    with_transfers("SELECT payment_type, round(avg(is_laundering), 6) AS rate, count(*) AS n FROM t GROUP BY 1"),
)
def _rate_by_category(spark, folder):
    sent = transfers(spark, folder, currencies=False)
    return rounded(profile.rate_by_category(sent, "payment_type", "is_laundering"), 6, "rate")


@query(
    "rate_pivot",
    """SELECT l_linenumber, round(avg(f) FILTER (l_linestatus = 'F'), 6) AS f, round(avg(f) FILTER (l_linestatus = 'O'), 6) AS o
       FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS f FROM lineitem) GROUP BY l_linenumber""",
)
def _rate_pivot(spark, folder):
    lines = Tables(spark, folder).lineitem.withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    wide = profile.rate_pivot(lines, "l_linenumber", "l_linestatus", ["F", "O"], "returned")
    return rounded(wide.toDF("l_linenumber", "f", "o"), 6, "f", "o")


_UNIFORM = "((id % 2147483648 * 1103515245 + 12345) % 2147483648) / 2147483648.0"


@query("hash_sample", with_transfers(f"SELECT id, amount FROM t WHERE {_UNIFORM} < 0.05"))
def _hash_sample(spark, folder):
    return hash_sample(transfers(spark, folder, currencies=False), "id", 0.05).select("id", "amount")


@query(
    "stratified_sample",
    with_transfers(
        f"""SELECT id, is_laundering, amount FROM (SELECT *, count(*) OVER (PARTITION BY is_laundering) AS n FROM t)
            WHERE {_UNIFORM} < least(1.0, CAST(5000 AS DOUBLE) / n)"""
    ),
)
def _stratified_sample(spark, folder):
    sent = transfers(spark, folder, currencies=False).select("id", "is_laundering", "amount")
    return stratified_sample(sent, "id", "is_laundering", 5000)
