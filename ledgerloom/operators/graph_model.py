"""Account nodes and transfer edges with ledger state attached."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.hashing import bernoulli

# Fixed value: share of edges that are masked.
MASK_SHARE = 0.2

# Edge properties that are exported, besides the key and end points.
EDGE_PROPERTIES = [
    "timestamp", "amount", "payment_currency", "received_currency",
    "payment_type", "is_laundering", "laundering_type", "masked",
    "src_delta", "src_balance_before", "src_balance_after", "src_seq", "src_currency",
    "dst_delta", "dst_balance_before", "dst_balance_after", "dst_seq", "dst_currency",
]


def nodes(accounts: DataFrame) -> DataFrame:
    """One row per account; of several locations the smallest name is kept."""
    return accounts.groupBy(F.col("account").cast("long").alias("account_number")).agg(
        F.min("location").alias("location")
    )


def edges(transfers: DataFrame) -> DataFrame:
    carried = ["amount", "payment_currency", "received_currency", "payment_type", "is_laundering", "laundering_type"]
    return transfers.select(
        "id",
        F.col("date_time").alias("timestamp"),
        F.col("sender_account").alias("src"),
        F.col("receiver_account").alias("dst"),
        *[name for name in carried if name in transfers.columns],
        bernoulli("id", MASK_SHARE).cast("int").alias("masked"),
    )


def enrich_edges(edges: DataFrame, statements: DataFrame) -> DataFrame:
    """Edges with delta, balance before and after, sequence and currency of both sides.

    Both sides of a transfer are folded into one row per transaction before the
    join, so the edges are shuffled once and every aggregate is numeric. A side
    counts only when its account is the edge's own end point.
    """
    delta = F.col("delta_amount")
    parts = {"account": F.col("account"), "delta": delta, "balance_after": F.col("running_balance"), "seq": F.col("seq")}
    folded = statements.groupBy(F.col("txn_id").alias("id")).agg(
        *[F.max(F.when(delta < 0, part)).alias(f"__src_{name}") for name, part in parts.items()],
        *[F.max(F.when(delta > 0, part)).alias(f"__dst_{name}") for name, part in parts.items()],
    )
    joined = edges.join(folded, "id", "left")
    columns = []
    for side, currency in (("src", "payment_currency"), ("dst", "received_currency")):
        known = F.col(f"__{side}_account") == F.col(side)
        pick = lambda value: F.when(known, value)
        after, moved = F.col(f"__{side}_balance_after"), F.col(f"__{side}_delta")
        columns += [
            pick(moved).alias(f"{side}_delta"),
            pick(after - moved).alias(f"{side}_balance_before"),
            pick(after).alias(f"{side}_balance_after"),
            pick(F.col(f"__{side}_seq")).alias(f"{side}_seq"),
        ]
        if currency in edges.columns:
            columns.append(pick(F.col(currency)).alias(f"{side}_currency"))
    return joined.select(*edges.columns, *columns)


def node_state(statements: DataFrame) -> DataFrame:
    """Balance after the last movement, and when an account was first and last seen."""
    return statements.groupBy("account").agg(
        F.max_by("running_balance", "seq").alias("current_balance"),
        F.max("date_time").alias("last_seen"),
        F.min("date_time").alias("first_seen"),
    )


def base_nodes(nodes: DataFrame, statements: DataFrame) -> DataFrame:
    state = node_state(statements).withColumnRenamed("account", "account_number")
    return nodes.join(state, "account_number", "left")


def _month_groups(statements: DataFrame):
    """Statements grouped by account, currency and month; a missing currency is spelled
    NA, because a map key cannot be NULL.
    """
    return statements.groupBy(
        F.col("account").alias("account_number"),
        F.coalesce("currency", F.lit("NA")).alias("currency"),
        F.year("date_time").alias("year"),
        F.month("date_time").alias("month"),
    )


def _close_name() -> Column:
    return F.format_string("mclose_%04d_%02d_%s", "year", "month", "currency")


def _close_map(name: Column, balance: Column) -> Column:
    """At most one entry per month and currency."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(name.alias("name"), balance.alias("balance")))))


def monthly_close(statements: DataFrame) -> DataFrame:
    """Balance after the last movement of each (account, currency, month), long form."""
    last = F.max_by("running_balance", "seq")
    return _month_groups(statements).agg(last.alias("balance_close")).withColumn("prop_name", _close_name())


def monthly_close_map(closes: DataFrame) -> DataFrame:
    """(account_number, mclose_map)."""
    packed = _close_map(F.col("prop_name"), F.col("balance_close"))
    return closes.groupBy("account_number").agg(packed.alias("mclose_map"))


def monthly_close_wide(closes: DataFrame, names: list[str]) -> DataFrame:
    """One column for each listed month and currency; the map form has them all.

    An account's closes are gathered in the order of the columns, and only a row that is
    read is widened: a pivot would hold all columns of every account that a task meets.
    """
    lookup = closes.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, names)).cast("array<string>")).alias("__at", "__name"))
    placed = closes.join(lookup, F.col("prop_name") == F.col("__name"), "left")
    close = F.when(F.col("__at").isNotNull(), F.struct(F.col("__at").alias("at"), F.col("balance_close").alias("close")))
    gathered = placed.groupBy("account_number").agg(F.array_sort(F.collect_list(close)).alias("__all"))
    before = lambda column, i: F.coalesce(F.get(column, i - 1)["at"], F.lit(-1))
    # of several closes under one name one counts
    firsts = F.filter("__all", lambda one, i: one["at"] != before("__all", i))
    kind = closes.schema["balance_close"].dataType
    gap = lambda one, i: F.array_repeat(F.lit(None).cast(kind), one["at"] - before("__own", i) - 1)
    filled = F.flatten(F.transform("__own", lambda one, i: F.concat(gap(one, i), F.array(one["close"]))))
    row = gathered.select("account_number", firsts.alias("__own")).select("account_number", filled.alias("__row"))
    return row.select("account_number", *[F.get("__row", F.lit(i)).alias(name) for i, name in enumerate(names)])


def enriched_nodes(nodes: DataFrame, statements: DataFrame) -> DataFrame:
    """Nodes with current balance, first and last movement, and the map of monthly closes.

    The months of an account are summed up first and its state follows from them,
    so the ledger is read once.
    """
    months = _month_groups(statements).agg(
        F.max_by("running_balance", "seq").alias("balance"),
        F.max("seq").alias("last"),
        F.min("date_time").alias("first"),
        F.max("date_time").alias("last_seen"),
    )
    state = months.groupBy("account_number").agg(
        F.max_by("balance", "last").alias("current_balance"),
        F.max("last_seen").alias("last_seen"),
        F.min("first").alias("first_seen"),
        _close_map(_close_name(), F.col("balance")).alias("mclose_map"),
    )
    return nodes.join(state, "account_number", "left")


def triplets(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each edge next to the properties of both its end nodes."""
    ends = [column for column in nodes.columns if column != "account_number"]

    def end(side: str) -> DataFrame:
        return nodes.select(
            F.col("account_number").alias(side), *[F.col(name).alias(f"{side}_{name}") for name in ends]
        )

    return edges.join(end("src"), "src").join(end("dst"), "dst")
