"""A ledger stored by periods, into which late movements are put without writing it anew.

`moves` holds each movement with its balance and number within its account and
period; `carry` holds, for each account and period, what the period adds and what
came before. A statement is the sum of both. Late movements rewrite the periods
they fall into, and the carry rows of their own accounts from there on; those
are one row an account and period, however many movements it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.ledger import LEDGER_ORDER
from ledgerloom.operators.ordered import running
from ledgerloom.runtime import stage, unstage
from ledgerloom.sinks.files import overwrite_partitions, write_partitioned

KEY = ["txn_id", "direction"]


def _by_period(moves: DataFrame, period: str) -> DataFrame:
    return moves.withColumn("period", F.to_date(F.date_trunc(period, "date_time")))


def _numbered(rows: DataFrame) -> DataFrame:
    return running(rows, ["account", "period"], LEDGER_ORDER, sums={"local_balance": "delta_amount"}, rank="local_seq")


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("account", "period").agg(F.sum("delta_amount").alias("total"), F.count("*").alias("n"))


def _carried(totals: DataFrame) -> DataFrame:
    """account, period, total, n, opening_balance, opening_n."""
    closed = running(totals, ["account"], ["period"], sums={"closing": "total", "closing_n": "n"})
    return closed.select(
        "account", "period", "total", "n",
        (F.col("closing") - F.col("total")).alias("opening_balance"), (F.col("closing_n") - F.col("n")).alias("opening_n"),
    )


def _paths(path: str) -> tuple[str, str]:
    return f"{path}/moves", f"{path}/carry"


def _periods(rows: DataFrame) -> list:
    """The periods that occur; a batch has few of them."""
    return [r["period"] for r in rows.select("period").distinct().collect()]


def create(moves: DataFrame, path: str, period: str = "day") -> None:
    """Store the movements of `operators.ledger.movements`."""
    rows = stage(_by_period(moves, period), "ledger-moves")
    moves_path, carry_path = _paths(path)
    write_partitioned(_numbered(rows), moves_path, ["period"])
    write_partitioned(_carried(_totals(rows)), carry_path, ["period"])
    unstage(rows)


def add(late: DataFrame, path: str, period: str = "day") -> None:
    """Put late movements in. One that is there already, by transfer and direction within its period, is replaced.

    Tables are read before they are overwritten, so what is written is staged
    first; a failed write can be repeated with the same batch.
    """
    spark = late.sparkSession
    moves_path, carry_path = _paths(path)
    late = stage(_by_period(late, period), "ledger-late")
    touched = _periods(late)
    stored = spark.read.parquet(moves_path).filter(F.col("period").isin(touched))
    kept = stored.select(*late.columns).join(late, [*KEY, "period"], "left_anti").select(*late.columns)
    rows = stage(_numbered(kept.unionByName(late)), "ledger-rows")

    # only accounts of the batch carry anything else forward, and only from their first late period on
    since = late.groupBy("account").agg(F.min("period").alias("since"))
    carry = spark.read.parquet(carry_path)
    mine = carry.join(since, "account", "left_semi")
    fresh = _totals(rows).join(since, "account", "left_semi")
    totals = mine.filter(~F.col("period").isin(touched)).select("account", "period", "total", "n").unionByName(fresh)
    moved = _carried(totals).join(since, "account").filter(F.col("period") >= F.col("since")).drop("since")
    moved = stage(moved, "ledger-moved")
    others = carry.filter(F.col("period").isin(_periods(moved))).join(moved, ["account", "period"], "left_anti")
    changed = stage(others.select(*moved.columns).unionByName(moved), "ledger-carry")

    overwrite_partitions(rows, moves_path, ["period"])
    overwrite_partitions(changed, carry_path, ["period"])
    unstage(late, rows, moved, changed)


def statements(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """The movements with running_balance and seq; of the periods from `first` to `last`, if given."""
    moves_path, carry_path = _paths(path)
    inside = F.lit(True)
    if first is not None:
        inside = inside & (F.col("period") >= F.lit(first))
    if last is not None:
        inside = inside & (F.col("period") <= F.lit(last))
    moves = spark.read.parquet(moves_path).filter(inside)
    carry = spark.read.parquet(carry_path).filter(inside).select(
        F.col("account").alias("c_account"), F.col("period").alias("c_period"), "opening_balance", "opening_n"
    )
    joined = moves.join(carry, F.col("account").eqNullSafe(F.col("c_account")) & (F.col("period") == F.col("c_period")))
    own = [c for c in moves.columns if c not in ("period", "local_balance", "local_seq")]
    return joined.select(
        *own,
        (F.col("opening_balance") + F.col("local_balance")).alias("running_balance"),
        (F.col("opening_n") + F.col("local_seq")).alias("seq"),
    )
