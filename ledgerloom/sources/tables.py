"""Parquet tables of one data folder, and transaction views over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.hashing import scramble


class Tables:
    """Lazy access to `<folder>/<name>.parquet`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def accounts(self) -> DataFrame:
        """(account, location), one row per account."""
        return self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("account"), F.col("n_name").alias("location")
        )

    def account_currency(self) -> DataFrame:
        """(account, currency) from the region an account sits in."""
        region = F.col("r_name")
        currency = F.when(region == "EUROPE", "Euro").when(region == "AMERICA", "UK pounds").otherwise(region)
        return (
            self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias("account"), currency.alias("currency"))
        )

    def raw_transfers(self, currencies: bool = True, text_time: bool = False) -> DataFrame:
        """Transactions with bank locations that vary.

        `text_time` splits the time into a date text and a time text, as a raw file
        has them. `currencies=False` leaves out the two currency joins where they
        are not read.
        """
        if text_time:
            time = [
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                F.date_format("o_orderdate", "HH:mm:ss").alias("time"),
            ]
        else:
            time = [F.col("o_orderdate").alias("date_time")]
        accounts = self.customer.agg(F.count("*")).scalar()
        receiver = F.pmod(F.col("o_custkey") * 7 + F.col("o_orderkey") * 13, accounts)
        flagged = F.pmod(scramble("o_orderkey"), F.lit(50)) == 0
        raw = self.orders.select(
            F.col("o_orderkey").alias("id"),
            *time,
            F.col("o_custkey").alias("sender_account"),
            receiver.alias("receiver_account"),
            F.col("o_totalprice").alias("amount"),
            F.col("o_orderstatus").alias("sender_bank_location"),
            F.col("o_orderpriority").alias("receiver_bank_location"),
            F.col("o_orderpriority").alias("payment_type"),
            flagged.cast("int").alias("is_laundering"),
            F.concat(F.when(flagged, "L_").otherwise("N_"), F.col("o_orderstatus")).alias("laundering_type"),
        )
        if not currencies:
            return raw
        held = self.account_currency()
        sender = held.select(
            F.col("account").alias("sender_account"), F.col("currency").alias("payment_currency")
        )
        receiving = held.select(
            F.col("account").alias("receiver_account"), F.col("currency").alias("received_currency")
        )
        return raw.join(sender, "sender_account", "left").join(receiving, "receiver_account", "left")

    def event_pairs(self) -> DataFrame:
        """Event stream as directed pairs (a, b) with an amount and a flag."""
        return self.events.select(
            F.col("event_id").alias("id"),
            "ts",
            F.col("user_id").alias("a"),
            F.col("event_type").alias("b"),
            F.col("value").alias("amount"),
            (F.col("event_type") == "error").cast("int").alias("flag"),
        )
