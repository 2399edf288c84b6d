"""Table profiles and data checks, each as one pass over the data."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.ordered import exact_quantiles

# Assumed bytes per value of each fixed-width type, bytes of
# overhead per row, and bytes for a type that is not listed.
FIXED_WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.LongType: 8,
    T.FloatType: 4,
    T.DoubleType: 8,
    T.DateType: 4,
    T.TimestampType: 12,
    T.TimestampNTZType: 12,
}
ROW_OVERHEAD = 16
OTHER_WIDTH = 8


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, value) with every value as text."""
    cells = [F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value")) for name in columns]
    return df.select(F.inline(F.array(*cells)))


def value_counts(df: DataFrame, columns: Sequence[str], by_key: bool = False) -> DataFrame:
    """Frequency of each value of each listed column, most frequent (or smallest key) first."""
    counts = long_form(df, columns).groupBy("column", "value").count()
    order = ["value"] if by_key else [F.desc("count"), F.col("value")]
    return counts.orderBy("column", *order)


# A bitmap of 4 KB stands for 32,768 neighbouring integers. It is the smaller form
# when an integer of 16 bytes or more occurs for each 64 of them.
_DENSE = 64


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column.

    Integer columns whose values lie close together are counted as bits: a task
    sends on one bitmap for each 32,768 neighbouring integers it has seen, and
    no values. For the other columns repeats are dropped before the shuffle.
    One aggregate over the integer columns decides.
    """
    whole = (T.ShortType, T.IntegerType, T.LongType)
    candidates = [c for c in columns if isinstance(df.schema[c].dataType, whole)]
    low: dict[str, int] = {}
    if candidates:
        stats = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), F.approx_count_distinct(c).alias("n")).alias(c) for c in candidates]).first()
        low = {c: stats[c]["lo"] for c in candidates if stats[c]["lo"] is not None and stats[c]["hi"] - stats[c]["lo"] <= _DENSE * stats[c]["n"]}
    parts = []
    if low:
        cells = [F.struct(F.lit(c).alias("column"), (F.col(c).cast("long") - F.lit(least) + 1).alias("value")) for c, least in low.items()]
        bits = df.select(F.inline(F.array(*cells))).filter("value is not null").groupBy("column", F.bitmap_bucket_number("value").alias("part"))
        counted = bits.agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("value"))).alias("n"))
        parts.append(counted.groupBy("column").agg(F.sum("n").alias("n_distinct")))
    rest = [c for c in columns if c not in low]
    if rest:
        values = long_form(df, rest).groupBy("column", "value").agg(F.count("value").alias("n"))
        parts.append(values.groupBy("column").agg(F.count_if(F.col("n") > 0).alias("n_distinct")))
    return reduce(DataFrame.unionByName, parts)


def range_profile(df: DataFrame, ts: str, amount: str) -> DataFrame:
    return df.agg(
        F.min(ts).alias("min_date"),
        F.max(ts).alias("max_date"),
        F.datediff(F.max(ts), F.min(ts)).alias("day_span"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
    )


def validity_checks(df: DataFrame, amount: str, ts: str, sender: str, receiver: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("n"),
        F.count_if(F.col(amount) <= 0).alias("nonpositive_amounts"),
        F.count_if(F.col(sender) == F.col(receiver)).alias("self_transfers"),
        F.min(ts).alias("min_date"),
        F.max(ts).alias("max_date"),
    )


def _missing(field: T.StructField, blanks: bool) -> Column:
    column = F.col(field.name)
    gone = column.isNull()
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        gone = gone | F.isnan(column)
    if blanks and isinstance(field.dataType, T.StringType):
        gone = gone | (F.trim(column) == "")
    return gone


def null_summary(df: DataFrame, blanks: bool = True) -> DataFrame:
    """Per column: type, missing (NULL, NaN, blank text), infinite, and share missing."""
    infinite = lambda f: (
        F.count_if(F.abs(F.col(f.name)) == float("inf"))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.lit(0).cast("long")
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.count_if(_missing(f, blanks)).alias("n_missing"),
                infinite(f).alias("n_infinite"),
                F.count("*").alias("n_rows"),
            )
            for f in df.schema.fields
        ]
    )
    return df.agg(cells.alias("cells")).select(F.inline("cells")).withColumn(
        "pct_missing", F.coalesce(F.try_divide(100.0 * F.col("n_missing"), F.col("n_rows")), F.lit(0.0))
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each fully identical group."""
    return df.groupBy(*df.columns).count().agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n_duplicates"),
    )


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat, surplus rows, and rows with a NULL in the key."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    counts = df.groupBy(*keys).count()
    repeated = ~has_null & (F.col("count") > 1)
    return counts.agg(
        F.count_if(repeated).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("count") - 1)), F.lit(0)).alias("surplus_rows"),
        F.coalesce(F.sum(F.when(has_null, F.col("count"))), F.lit(0)).alias("null_key_rows"),
    )


def active_accounts(df: DataFrame, sender: str, receiver: str) -> DataFrame:
    ends = F.explode(F.array(sender, receiver))
    return df.select(ends.alias("account")).distinct()


def missing_accounts(df: DataFrame, sender: str, receiver: str, accounts: DataFrame) -> DataFrame:
    """Accounts used in transfers that the accounts table does not list."""
    return active_accounts(df, sender, receiver).join(accounts, "account", "left_anti")


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, stddev, min, exact quartiles and max per numeric column (all by default), in long form."""
    names = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.count(name).alias("count"),
            F.avg(name).alias("mean"),
            F.stddev(name).alias("stddev"),
            F.min(name).cast("double").alias("min"),
            F.max(name).cast("double").alias("max"),
        )
        for name in names
    ]
    rows = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    values = [F.struct(F.lit(name).alias("column"), F.col(name).cast("double").alias("value")) for name in names]
    found = exact_quantiles(df.select(F.inline(F.array(*values))), "value", [0.25, 0.5, 0.75], ["column"], discrete=True)
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("quantile")))
    quartiles = found.groupBy("column").agg(at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75"))
    return rows.join(quartiles, "column", "left").select(
        "column", "count", "mean", "stddev", "min", "q25", "q50", "q75", "max"
    )


def describe_object(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, most frequent value and its frequency per text column."""
    counts = long_form(df, columns).groupBy("column", "value").agg(F.count("value").alias("n"))
    return counts.filter("value is not null").groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def amount_quantiles(df: DataFrame, column: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of a column and of the base-10 logarithm of its positive values."""
    value = F.col(column).cast("double")
    logs = df.select(F.log10(F.when(value > 0, value)).alias("log_amount"))
    raw = exact_quantiles(df, column, probs, discrete=True).withColumnRenamed("quantile", "amount")
    return raw.join(
        exact_quantiles(logs, "log_amount", probs, discrete=True).withColumnRenamed("quantile", "log_amount"), "prob", "left"
    )


def _sketch_size(error: float) -> int:
    """Size of a KLL sketch whose ranks are off by no more than `error` with 99 % confidence, by its published fit."""
    return min(65535, max(8, math.ceil((2.296 / error) ** (1 / 0.9021))))


def quantile_sketches(df: DataFrame, value: str, keys: Sequence[str], error: float = 0.01) -> DataFrame:
    """keys, sketch: one KLL sketch of the non-null values per key, to be stored and merged on demand.

    A sketch has a bounded size, so a key with any number of rows sends on one
    small row a task, and later rows of other keys never touch it.
    """
    data = df.select(*keys, F.col(value).cast("double").alias("__v")).filter("__v is not null")
    return data.groupBy(*keys).agg(F.kll_sketch_agg_double("__v", _sketch_size(error)).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """keys, prob, quantile, n from the merged sketches of each key: values that occur, near the asked rank."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    merged = merged.withColumn("n", F.kll_sketch_get_n_double("sketch")).filter("n > 0")
    # the rank has to be a constant of the plan
    found = [F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile")) for p in probs]
    return merged.select(*keys, F.inline(F.array(*found)), "n")


def rank_gaps(df: DataFrame, value: str, quantiles: DataFrame) -> DataFrame:
    """prob, n, gap: how far each quantile's range of ranks is from the asked one, 0 if it covers it."""
    asked = quantiles.agg(F.collect_list(F.struct("prob", "quantile"))).scalar()  # one entry a probability
    data = df.select(F.col(value).cast("double").alias("v")).filter("v is not null").withColumn("q", F.explode(asked))
    ranks = data.groupBy("q.prob").agg(
        F.count("*").alias("n"), F.count_if(F.col("v") < F.col("q.quantile")).alias("below"), F.count_if(F.col("v") <= F.col("q.quantile")).alias("upto")
    )
    n = F.col("n")
    return ranks.select("prob", "n", F.greatest(F.lit(0.0), F.col("below") / n - F.col("prob"), F.col("prob") - F.col("upto") / n).alias("gap"))


def size_profile(df: DataFrame, target_bucket_mb: int = 128) -> DataFrame:
    """Uncompressed bytes per row from mean text lengths and fixed widths, and bucket advice."""
    width = F.lit(float(ROW_OVERHEAD))
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.avg(F.length(field.name)), F.lit(0.0))
        else:
            width = width + F.lit(float(FIXED_WIDTHS.get(type(field.dataType), OTHER_WIDTH)))
    sized = df.agg(F.count("*").alias("rows"), width.alias("bytes_per_row"))
    total = F.col("rows") * F.col("bytes_per_row")
    return sized.select(
        "rows",
        "bytes_per_row",
        (total / 1024**3).alias("total_gb"),
        F.lit(target_bucket_mb).alias("target_bucket_mb"),
        F.greatest(F.lit(1).cast("long"), F.ceil(total / (target_bucket_mb * 1024 * 1024))).alias("recommended_buckets"),
    )


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest key, as needed to split a range-partitioned read."""
    return df.agg(F.min(key).cast("long").alias("lo"), F.max(key).cast("long").alias("hi"))


def mode_and_mean_fill(df: DataFrame, modes: Sequence[str], means: Sequence[str]) -> DataFrame:
    """NULLs of `modes` become the most frequent value, NULLs of `means` the average."""
    fills = {}
    for name in modes:
        counts = df.filter(F.col(name).isNotNull()).groupBy(name).count()
        best = F.min_by(name, F.struct(-F.col("count"), F.col(name)))
        fills[name] = F.coalesce(F.col(name), counts.agg(best).scalar())
    for name in means:
        fills[name] = F.coalesce(F.col(name), df.agg(F.avg(name)).scalar())
    return df.withColumns(fills)


def top_k_or_other(df: DataFrame, column: str, k: int = 10, other: str = "OTHER") -> DataFrame:
    """Keep the k most frequent values of a column and replace the rest.

    The kept values are one array of at most k entries, looked up in place.
    """
    ranked = df.filter(F.col(column).isNotNull()).groupBy(column).count().orderBy(F.desc("count"), column).limit(k)
    kept = ranked.agg(F.collect_list(column)).scalar()
    return df.withColumn(column, F.when(F.array_contains(kept, F.col(column)), F.col(column)).otherwise(other))


def rate_by_category(df: DataFrame, category: str, flag: str) -> DataFrame:
    return df.groupBy(category).agg(F.avg(flag).alias("rate"), F.count("*").alias("n")).orderBy("rate", category)


def rate_pivot(df: DataFrame, row: str, column: str, values: Sequence, flag: str) -> DataFrame:
    """Mean of `flag` per (row, column), one output column per listed value."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.avg(flag))
