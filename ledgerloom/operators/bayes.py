"""Closed-form naive Bayes: class statistics in one aggregate, scoring in place.

The class statistics are one small array (an entry per class) that every row is
scored against with higher-order functions, so scoring needs no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.runtime import stage


def _best(classes: Column, score) -> Column:
    """Label of the highest score; a tie goes to the smaller label."""
    scored = F.transform(classes, lambda c: F.struct(score(c).alias("score"), c["label"].alias("label")))
    top = F.array_max(F.transform(scored, lambda s: s["score"]))
    return F.array_min(F.transform(F.filter(scored, lambda s: s["score"] == top), lambda s: s["label"]))


def gaussian_params(df: DataFrame, features: Sequence[str], label: str, smoothing: float = 1e-9) -> DataFrame:
    """Prior, mean and smoothed variance per class, from one aggregate over the rows.

    The smoothing adds a share of the largest overall feature variance, which
    follows from the class means and variances.
    """
    stats = df.groupBy(F.col(label).alias("label")).agg(
        F.count("*").alias("n"),
        *[F.avg(f).alias(f"m_{f}") for f in features],
        *[F.var_pop(f).alias(f"v_{f}") for f in features],
    )
    n = F.sum("n")
    overall = []
    for f in features:
        mean, variance = F.col(f"m_{f}"), F.col(f"v_{f}")
        centre = F.sum(F.col("n") * mean) / n
        overall.append(F.sum(F.col("n") * (variance + mean * mean)) / n - centre * centre)
    packed = stats.agg(
        F.collect_list(F.struct(*stats.columns)).alias("__classes"),
        n.alias("__total"),
        (F.greatest(F.lit(0.0), *overall) * smoothing).alias("__widen"),
    )
    opened = packed.select("__total", "__widen", F.inline("__classes"))
    smoothed = {f"v_{f}": F.col(f"v_{f}") + F.col("__widen") for f in features}
    return opened.withColumns({**smoothed, "prior": F.col("n") / F.col("__total")}).drop("__total", "__widen")


def gaussian_predict(
    df: DataFrame, params: DataFrame, features: Sequence[str], priors: dict | None = None
) -> DataFrame:
    """Adds `prediction`. Given `priors` (label to share) replace the empirical ones."""
    if priors:
        params = params.withColumn("prior", F.create_map(*[F.lit(x) for kv in priors.items() for x in kv])[F.col("label")])
    classes = params.agg(F.collect_list(F.struct(*params.columns))).scalar()

    def score(c: Column) -> Column:
        total = F.ln(c["prior"])
        for f in features:
            gap, spread = F.col(f) - c[f"m_{f}"], c[f"v_{f}"]
            # a feature without any spread tells nothing about the class
            term = 0.5 * F.ln(2 * math.pi * spread) + gap * gap / (2 * spread)
            total = total - F.when(spread > 0, term).otherwise(0.0)
        return total

    scored = df.withColumn("__classes", classes)
    return scored.withColumn("prediction", _best(F.col("__classes"), score)).select(*df.columns, "prediction")


def categorical_predict(
    train: DataFrame,
    df: DataFrame,
    features: Sequence[str],
    label: str,
    alpha: float = 1.0,
    least_kinds: int = 0,
    priors: dict | None = None,
) -> DataFrame:
    """Adds `prediction` from additively smoothed category frequencies of `train`.

    A feature has as many categories as were seen, but no fewer than `least_kinds`.
    Given `priors` (label to share) replace the empirical ones.

    A category never seen with a class counts as zero there. All counts come from
    one pass and are stored, as the classes and every feature's table read them; such
    a table has one row per category.
    """
    text = [F.struct(F.lit(i).alias("f"), F.col(name).cast("string").alias("v")) for i, name in enumerate(features)]
    counts = (
        train.select(F.col(label).alias("label"), F.inline(F.array(*text)))
        .groupBy("f", "v", "label")
        .agg(F.count("*").alias("n"))
    )
    cells = stage(counts, "category-counts")
    # every row has exactly one value of the first feature, so its cells add up to the classes
    classes = cells.filter("f = 0").groupBy("label").agg(F.sum("n").alias("n"))
    model = classes.agg(
        F.struct(F.collect_list(F.struct("label", "n")).alias("classes"), F.sum("n").alias("total")).alias("s")
    ).scalar()
    tables = cells.groupBy("f", "v").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("seen"))
    kinds = tables.groupBy("f").count()
    scored = df.withColumn("__model", model).withColumn(
        "__kinds", kinds.agg(F.map_from_entries(F.collect_list(F.struct("f", "count")))).scalar()
    )
    for i, name in enumerate(features):
        table = tables.filter(F.col("f") == i).select(F.col("v").alias(f"__v{i}"), F.col("seen").alias(f"__c{i}"))
        scored = scored.join(table, F.col(name).cast("string").eqNullSafe(F.col(f"__v{i}")), "left")

    given = F.create_map(*[F.lit(x) for kv in priors.items() for x in kv]) if priors else None

    def score(c: Column) -> Column:
        result = F.ln(given[c["label"]] if priors else c["n"] / F.col("__model.total"))
        for i in range(len(features)):
            seen = F.coalesce(F.try_element_at(F.col(f"__c{i}"), c["label"]), F.lit(0))
            result = result + F.ln((seen + alpha) / (c["n"] + alpha * F.greatest(F.col("__kinds")[i], F.lit(least_kinds))))
        return result

    return scored.withColumn("prediction", _best(F.col("__model.classes"), score)).select(*df.columns, "prediction")


def bernoulli_predict(
    train: DataFrame, df: DataFrame, features: Sequence[str], label: str, thresholds: dict | float = 0.0, alpha: float = 1.0
) -> DataFrame:
    """Bernoulli naive Bayes on `feature > threshold`: a categorical one with two categories."""
    cut = thresholds if isinstance(thresholds, dict) else dict.fromkeys(features, thresholds)
    above = {f"__b_{f}": (F.col(f) > cut[f]).cast("int") for f in features}
    scored = categorical_predict(
        train.withColumns(above), df.withColumns(above), list(above), label, alpha, least_kinds=2
    )
    return scored.select(*df.columns, "prediction")


def accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return df.agg(
        F.count("*").alias("n"), F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy")
    )
