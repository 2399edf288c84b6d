"""Samples that do not change with the partitioning of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.hashing import bernoulli, scramble, uniform
from ledgerloom.operators.ordered import by_key, running


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's own sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, id_column: str, fraction: float) -> DataFrame:
    return df.filter(bernoulli(id_column, fraction))


def stratified_sample(df: DataFrame, id_column: str, stratum: str, target: int) -> DataFrame:
    """About `target` rows of every stratum; smaller strata are kept whole."""
    fractions = df.groupBy(stratum).agg((F.lit(float(target)) / F.count("*")).alias("__fraction"))
    kept = uniform(id_column) < F.least(F.lit(1.0), by_key(fractions, stratum, "__fraction"))
    return df.filter(kept)


def seed_sample(df: DataFrame, id_column: str, k: int) -> DataFrame:
    """k pseudo-random ids: the first ones in scrambled order."""
    return df.select(id_column).orderBy(scramble(id_column), id_column).limit(k)


def stratified_folds(df: DataFrame, id_column: str, stratum: str, folds: int) -> DataFrame:
    """Balanced folds: inside each stratum the scrambled rank modulo `folds`."""
    mixed = df.withColumn("__mix", scramble(id_column))
    ranked = running(mixed, [stratum], ["__mix", id_column], rank="__rank")
    return ranked.select(*df.columns, F.pmod(F.col("__rank") - 1, F.lit(folds)).cast("int").alias("fold"))
