"""Feature preparation as column expressions over one-pass statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.binning import dummies
from ledgerloom.operators.ordered import exact_quantiles, join_null_safe, running


def family_features(df: DataFrame, siblings: str, parents: str, fare: str) -> DataFrame:
    family = F.col(siblings) + F.col(parents) + 1
    return df.withColumns(
        {
            "family": family,
            "is_alone": (family == 1).cast("int"),
            "fare_per_person": F.try_divide(F.col(fare), family),
        }
    )


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population standard deviation; a constant column becomes 0."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
        ).alias("s")
    ).scalar()
    scaled = {
        c: (F.col(c) - stats[f"m_{c}"]) / F.when(stats[f"s_{c}"] > 0, stats[f"s_{c}"]).otherwise(1.0) for c in columns
    }
    return df.withColumns(scaled)


def robust_scale(df: DataFrame, column: str, lower: float = 0.25, upper: float = 0.75) -> DataFrame:
    """(x - median) / (upper quantile - lower quantile), quantiles exact."""
    rows = exact_quantiles(df, column, [lower, 0.5, upper])
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("quantile")))
    stats = rows.agg(F.struct(at(lower).alias("lo"), at(0.5).alias("mid"), at(upper).alias("hi")).alias("s")).scalar()
    spread = stats["hi"] - stats["lo"]
    return df.withColumn(column, (F.col(column) - stats["mid"]) / F.when(spread > 0, spread).otherwise(1.0))


def categories(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column and their rows, as a table of any length."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def one_hot(df: DataFrame, column: str, values: Sequence, drop_first: bool = True) -> DataFrame:
    """0/1 columns for the listed categories; other values give all zeros.

    Categories whose names come out alike get the suffix _2, _3, ...
    """
    return df.withColumns(dummies(F.col(column), values, column, int(drop_first)))


def target_encode(df: DataFrame, column: str, label: str, smoothing: float = 1.0, output: str | None = None) -> DataFrame:
    """Blend of category mean and overall mean with weight n / (n + smoothing)."""
    means = df.groupBy(column).agg(F.count("*").alias("__n"), F.avg(label).alias("__mean"))
    overall = df.agg(F.avg(label)).scalar()
    weight = F.col("__n") / (F.col("__n") + F.lit(float(smoothing)))
    encoded = weight * F.col("__mean") + (1 - weight) * overall
    table = means.select(column, encoded.alias(output or f"{column}_te"))
    return join_null_safe(df, table, [column])


def ordinal_encode(df: DataFrame, column: str, unknown: int = -1) -> DataFrame:
    """Rank of the category in sorted order from 0; NULL becomes `unknown`."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    coded = running(values, [], [column], rank="__rank")
    table = coded.select(column, (F.col("__rank") - 1).alias(f"{column}_ord"))
    return df.join(table, column, "left").withColumn(f"{column}_ord", F.coalesce(f"{column}_ord", F.lit(unknown).cast("long")))


def uniform_bins(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bin number over the data range; the last bin is closed."""
    ends = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("s")).scalar()
    width = (ends["hi"] - ends["lo"]) / bins
    number = F.when(width > 0, F.floor((F.col(column) - ends["lo"]) / width)).otherwise(F.lit(0).cast("long"))
    return df.withColumn(f"{column}_bin", F.least(number, F.lit(bins - 1).cast("long")))


def quantile_bins(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Bin number between exact quantiles; bins are left-closed and the last one is closed."""
    rows = exact_quantiles(df, column, [i / bins for i in range(bins + 1)])
    # edges that coincide, or lie on either end, would make bins without width
    ends = F.array(F.min("quantile"), F.max("quantile"))
    edges = rows.agg(F.sort_array(F.array_except(F.collect_set("quantile"), ends))).scalar()
    edge = lambda i: F.try_element_at(F.col("__edges"), F.lit(i))
    passed = sum((F.coalesce((F.col(column) >= edge(i)).cast("int"), F.lit(0)) for i in range(1, bins)), F.lit(0))
    number = F.when(F.col(column).isNotNull(), passed)
    return df.withColumn("__edges", edges).withColumn(f"{column}_bin", number).drop("__edges")


def binarize(df: DataFrame, column: str, threshold: float = 0.0) -> DataFrame:
    return df.withColumn(f"{column}_bin", (F.col(column) > threshold).cast("int"))


def class_priors(df: DataFrame, label: str, alpha: float = 1.0) -> DataFrame:
    """Laplace-smoothed class priors (n_c + alpha) / (n + alpha K)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k")).alias("s")).scalar()
    return counts.withColumn("prior", (F.col("n") + alpha) / (totals["n"] + alpha * totals["k"]))
