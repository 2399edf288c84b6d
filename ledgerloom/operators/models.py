"""Classifier pipelines, hyper-parameter search and cross-validation on spark.ml."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    Binarizer,
    Bucketizer,
    FeatureHasher,
    OneHotEncoder,
    RobustScaler,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ordered import by_key

# Fixed value: seed of folds, searches and randomised learners.
SEED = 107
PART_ROWS = 1 << 18  # most rows in a partition that learners read; if one has more, all get half as many


def preprocessing(
    numeric: Sequence[str] = (),
    standard: Sequence[str] = (),
    robust: Sequence[str] = (),
    hashed: Sequence[str] = (),
    onehot: Sequence[str] = (),
    hash_features: int = 8,
    quantile_range: tuple[float, float] = (0.25, 0.75),
) -> list:
    """Stages that turn the listed columns into one `features` vector; others are dropped.

    One-hot columns drop their last (rarest) category, and unseen ones become zeros.
    """
    stages, parts = [], list(numeric)
    if standard:
        stages += [
            VectorAssembler(inputCols=list(standard), outputCol="__std_in"),
            StandardScaler(inputCol="__std_in", outputCol="__std", withMean=True),
        ]
        parts.append("__std")
    if robust:
        stages += [
            VectorAssembler(inputCols=list(robust), outputCol="__rob_in"),
            RobustScaler(
                inputCol="__rob_in", outputCol="__rob", lower=quantile_range[0], upper=quantile_range[1], withCentering=True
            ),
        ]
        parts.append("__rob")
    if hashed:
        stages.append(
            FeatureHasher(
                inputCols=list(hashed), categoricalCols=list(hashed), outputCol="__hash", numFeatures=hash_features
            )
        )
        parts.append("__hash")
    if onehot:
        indexed = [f"__ix_{name}" for name in onehot]
        encoded = [f"__oh_{name}" for name in onehot]
        stages += [
            StringIndexer(inputCols=list(onehot), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        ]
        parts += encoded
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def learner(kind: str, **params) -> list:
    """Final stages of a classifier that reads `features` and `label`."""
    if kind in ("logistic", "sgd_log"):
        return [LogisticRegression(**params)]
    if kind == "linear_svc":
        return [LinearSVC(**params)]
    if kind == "ridge":
        # least squares on a target of -1 / +1; the sign of the fit is the class
        return [
            SQLTransformer(statement="SELECT *, 2.0 * label - 1.0 AS __signed FROM __THIS__"),
            LinearRegression(labelCol="__signed", predictionCol="__margin", elasticNetParam=0.0, **params),
            SQLTransformer(statement="SELECT *, CAST(__margin > 0 AS DOUBLE) AS prediction FROM __THIS__"),
        ]
    if kind == "tree":
        return [DecisionTreeClassifier(seed=SEED, **params)]
    if kind == "forest":
        return [RandomForestClassifier(seed=SEED, **params)]
    if kind == "gbt":
        return [GBTClassifier(seed=SEED, **params)]
    if kind == "gaussian_nb":
        return [NaiveBayes(modelType="gaussian", **params)]
    if kind == "bernoulli_nb":
        threshold = params.pop("threshold", 0.0)
        return [
            Binarizer(inputCol="features", outputCol="__binary", threshold=threshold),
            NaiveBayes(modelType="bernoulli", featuresCol="__binary", **params),
        ]
    raise ValueError(f"unknown classifier {kind}")


def classifier(prepare: list, kind: str, **params) -> Pipeline:
    return Pipeline(stages=[*prepare, *learner(kind, **params)])


def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Adds `weight`: rows / (classes x rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("__n"))
    totals = counts.agg(F.struct(F.sum("__n").alias("n"), F.count("*").alias("k")).alias("s")).scalar()
    table = counts.select(label, (totals["n"] / (totals["k"] * F.col("__n"))).alias("weight"))
    return df.withColumn("weight", by_key(table, label, "weight")).filter("weight is not null")


def _evaluator() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName="accuracy")


def draw_params(space: Mapping, draws: int, seed: int = SEED) -> list[dict]:
    """`draws` random settings. A dimension is a list of choices, or one of
    ("int", low, high), ("uniform", low, high), ("loguniform", low, high).
    """
    source = random.Random(seed)

    def one(dimension):
        if isinstance(dimension, list):
            return source.choice(dimension)
        kind, low, high = dimension
        if kind == "int":
            return source.randrange(low, high)
        if kind == "uniform":
            return source.uniform(low, high)
        if kind == "loguniform":
            return math.exp(source.uniform(math.log(low), math.log(high)))
        raise ValueError(f"unknown distribution {kind}")

    return [{param: one(dimension) for param, dimension in space.items()} for _ in range(draws)]


def random_search(
    pipeline: Pipeline, df: DataFrame, space: Mapping, draws: int, folds: int, parallelism: int = 4
):
    """Cross-validated search over random settings; `df` carries a `fold` column."""
    search = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=draw_params(space, draws),
        evaluator=_evaluator(),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    return search.fit(df)


def cv_scores(pipeline: Pipeline, df: DataFrame, folds: int) -> tuple[float, float]:
    """Mean and standard deviation of the accuracy over the folds."""
    return shared_cv_scores([], {"": pipeline.getStages()}, df, folds)[""]


def bounded(df: DataFrame) -> DataFrame:
    """Rows in partitions of at most PART_ROWS; if they had to be dealt out for it, they are kept on disk.

    spark.ml holds the rows of a partition as objects in one block, which a single task
    unrolls, spills and reads back. So its size must not depend on how many files a scan packs
    together.
    """
    sizes = df.groupBy(F.spark_partition_id().alias("part")).count()
    rows, widest = sizes.agg(F.sum("count"), F.max("count")).first()
    if rows is None or widest <= PART_ROWS:
        return df
    return df.repartition(math.ceil(2 * rows / PART_ROWS)).persist(StorageLevel.DISK_ONLY)


def shared_cv_scores(
    prepare: list, learners: Mapping[str, list], df: DataFrame, folds: int, parallelism: int = 4
) -> dict[str, tuple[float, float]]:
    """Mean and standard deviation of every learner's accuracy over the folds; `df` carries a `fold` column.

    `prepare` is fitted once a fold, on its training rows, and all learners read the vectors
    it gave, which are kept on disk while they are fitted: memory is left to the blocks that
    a learner makes of them. At most `parallelism` learners are fitted side by side, fewer as
    the partitions of one alone keep the cores busy. A fold is scored in one pass; nothing is
    fitted on all rows.
    """
    ends = df.agg(F.min("fold"), F.max("fold")).first()
    if ends[0] is None or ends[0] < 0 or ends[1] >= folds:
        raise ValueError(f"folds from {ends[0]} to {ends[1]}, not from 0 to {folds - 1}")
    rows = bounded(df)
    slots = parallelism * df.sparkSession.sparkContext.defaultParallelism
    abreast = max(1, min(parallelism, slots // rows.rdd.getNumPartitions()))
    accuracies = {name: [] for name in learners}
    try:
        for fold in range(folds):
            trained = F.col("fold") != fold
            vectors = Pipeline(stages=prepare).fit(rows.filter(trained)).transform(rows)
            if prepare:
                vectors = vectors.select("fold", "label", "features")
            if prepare or rows is df:
                vectors = vectors.persist(StorageLevel.DISK_ONLY)
            try:
                train, held = vectors.filter(trained), vectors.filter(~trained)

                def score(stages: list) -> float:
                    found = in_sample_accuracy(Pipeline(stages=stages).fit(train), held).first()["accuracy"]
                    return math.nan if found is None else found

                with ThreadPool(abreast) as pool:
                    tasks = [inheritable_thread_target(df.sparkSession)(partial(score, stages)) for stages in learners.values()]
                    for name, accuracy in zip(learners, pool.map(lambda task: task(), tasks)):
                        accuracies[name].append(accuracy)
            finally:
                if prepare or rows is df:
                    vectors.unpersist()
    finally:
        if rows is not df:
            rows.unpersist()
    return {name: (float(np.mean(a)), float(np.std(a))) for name, a in accuracies.items()}


def in_sample_accuracy(model, df: DataFrame) -> DataFrame:
    scored = model.transform(df)
    return scored.agg(
        F.count("*").alias("n"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
    )


def held_out_score(pipeline: Pipeline, df: DataFrame, held_out: Column) -> DataFrame:
    """Fitted on the rest, scored on the held-out rows: their number, labels, accuracy and largest class share."""
    rows = df.withColumn("__held", held_out)
    scored = pipeline.fit(rows.filter("not __held").drop("__held")).transform(rows.filter("__held").drop("__held"))
    share = F.avg("label")
    return scored.agg(
        F.count("*").alias("n_held_out"),
        F.sum("label").cast("long").alias("n_positive"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
        F.greatest(share, 1 - share).alias("majority_share"),
    )


def batch_score(model, df: DataFrame, id_column: str, output: str) -> DataFrame:
    return model.transform(df).select(id_column, F.col("prediction").cast("int").alias(output))


def forest_impute(df: DataFrame, column: str, features: Sequence[str], trees: int = 20) -> DataFrame:
    """Fill NULLs of a numeric column with a random-forest prediction from `features`."""
    gather = VectorAssembler(inputCols=list(features), outputCol="__f", handleInvalid="keep")
    learn = RandomForestRegressor(
        featuresCol="__f", labelCol=column, predictionCol="__p", numTrees=trees, seed=SEED
    )
    known, unknown = df.filter(F.col(column).isNotNull()), df.filter(F.col(column).isNull())
    model = Pipeline(stages=[gather, learn]).fit(known)
    filled = model.transform(unknown).withColumn(column, F.col("__p")).select(*df.columns)
    return known.unionByName(filled)


def hashed_features(df: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    hasher = FeatureHasher(
        inputCols=list(columns), categoricalCols=list(columns), outputCol="hashed", numFeatures=buckets
    )
    return hasher.transform(df)


def kmeans_bins(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Bins between the midpoints of one-dimensional k-means centres."""
    points = VectorAssembler(inputCols=[column], outputCol="__x").transform(df)
    centres = sorted(c[0] for c in KMeans(k=bins, featuresCol="__x", seed=SEED).fit(points).clusterCenters())
    middles = sorted({(a + b) / 2 for a, b in zip(centres, centres[1:])})
    splits = [-math.inf, *middles, math.inf]
    return Bucketizer(splits=splits, inputCol=column, outputCol=f"{column}_bin").transform(df)
