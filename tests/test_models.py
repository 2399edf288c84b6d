"""Nearest neighbours, naive Bayes, features and the spark.ml pipelines."""

import math
import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from pyspark.ml import Estimator
from pyspark.ml.feature import SQLTransformer, VectorAssembler

from ledgerloom.operators import bayes, features, models, neighbors
from ledgerloom.operators.neighbors import knn, knn_classify
from ledgerloom.plans import model_queries


@pytest.fixture(scope="module")
def points(spark):
    """Three clusters, and one point copied so often that it holds a third of the rows."""
    source = random.Random(3)
    rows = []
    for i in range(240):
        centre = [(0, 0, 0), (8, 0, 1), (0, 9, 5)][i % 3]
        vector = [2.0, 2.0, 2.0] if i % 3 == 1 else [c + source.gauss(0, 1) for c in centre]
        rows.append((i, [float(v) for v in vector], i % 3))
    return rows, spark.createDataFrame(rows, "id long, x array<double>, label int")


@pytest.mark.parametrize("p, self_too", [(2, True), (1, True), (2, False)])
def test_knn_against_brute_force(points, p, self_too):
    rows, df = points
    got = knn(df, df, 4, "id", "x", "label", p=p, exclude_self=not self_too, pivots=6, block_rows=25)
    found = {}
    for r in got.collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["neighbor_id"]
    for i, x, _ in rows:
        distances = sorted(
            (float((np.abs(np.array(x) - np.array(y)) ** p).sum()) ** (1 / p), j)
            for j, y, _ in rows
            if self_too or i != j
        )
        assert [found[i][k] for k in (1, 2, 3, 4)] == [j for _, j in distances[:4]]


def test_knn_with_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 1)], "id long, x array<double>, label int")
    assert knn(df, df, 5, "id", "x", "label", exclude_self=True).count() == 2


@pytest.mark.parametrize("p, k, exclude", [(2, 15, True), (2, 5, False), (1, 4, True)])
def test_knn_across_tiles(p, k, exclude):
    """Copies fill more than a tile, and rows next to each other differ in their last digits only."""
    source = np.random.default_rng(3)
    rows = source.normal(size=(2 * neighbors.TILE_ROWS + 300, 6))
    rows[1000:3400] = rows[0]
    rows[3400:3500] = rows[0] + np.arange(100)[:, None] * 1e-15
    ids = np.arange(len(rows)) * 3
    asks, own = rows[::3], ids[::3]
    at, of, distance = neighbors._nearest(own, asks, ids, rows, k, p, exclude)
    whole = neighbors._distances(asks, rows, p)
    if exclude:
        whole[own[:, None] == ids[None, :]] = np.inf
    best = np.argsort(whole, axis=1, kind="stable")[:, :k]
    assert (at == np.repeat(np.arange(len(asks)), k)).all() and (of == best.ravel()).all()
    assert (distance == np.take_along_axis(whole, best, axis=1).ravel()).all()


def test_votes(spark):
    near = spark.createDataFrame(
        [(1, 5, 0, 0.0), (1, 6, 1, 0.1), (1, 7, 1, 0.1), (2, 5, 0, 1.0), (2, 6, 1, 1.0)],
        "query_id long, neighbor_id long, label int, distance double",
    )
    uniform = {r["query_id"]: r["prediction"] for r in knn_classify(near).collect()}
    weighted = {r["query_id"]: r["prediction"] for r in knn_classify(near, "distance").collect()}
    assert uniform == {1: 1, 2: 0} and weighted == {1: 0, 2: 0}


def test_categorical_bayes_with_unseen_values(spark):
    train = spark.createDataFrame(
        [("a", "x", 0), ("a", "y", 0), ("b", "x", 1), ("b", None, 1), ("b", "x", 1)], "f string, g string, label int"
    )
    asked = spark.createDataFrame([("a", "x"), ("b", None), ("new", "y"), (None, "x")], "f string, g string")
    got = [r["prediction"] for r in bayes.categorical_predict(train, asked, ["f", "g"], "label").collect()]

    def best(f, g):
        score = {}
        for c, n in ((0, 2), (1, 3)):
            of = lambda i, v: sum(1 for r in train_rows if r[2] == c and r[i] == v)
            score[c] = math.log(n / 5) + math.log((of(0, f) + 1) / (n + 2)) + math.log((of(1, g) + 1) / (n + 3))
        return max(score, key=lambda c: (score[c], -c))

    train_rows = [tuple(r) for r in train.collect()]
    assert got == [best(*tuple(r)) for r in asked.collect()]


def test_gaussian_bayes_with_given_priors(spark):
    df = spark.createDataFrame([(0.0, 0), (1.0, 0), (2.0, 1), (3.0, 1)], "x double, label int")
    params = bayes.gaussian_params(df, ["x"], "label")
    plain = bayes.gaussian_predict(df, params, ["x"])
    assert [r["prediction"] for r in plain.collect()] == [0, 0, 1, 1]
    tilted = bayes.gaussian_predict(df, params, ["x"], priors={0: 1e-9, 1: 1.0})
    assert [r["prediction"] for r in tilted.filter("x = 1.0").collect()] == [1]
    spread = {r["label"]: r["v_x"] for r in params.collect()}
    assert spread[0] == pytest.approx(0.25 + 1.25e-9, abs=1e-12)


def test_scalers_on_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in features.standard_scale(df, ["a", "b"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    assert [r["b"] for r in features.robust_scale(df, "b").collect()] == [0.0, 0.0]
    many = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert features.robust_scale(many, "v").agg(F.min("v"), F.max("v")).first() == (-1.0, 1.0)


def test_one_hot_takes_its_categories_from_the_caller(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert {tuple(r) for r in features.categories(df, "c").collect()} == {("a", 1), ("b", 1)}
    coded = features.one_hot(df, "c", ["a", "b"])
    assert coded.columns == ["c", "c_b"] and [r["c_b"] for r in coded.collect()] == [0, 1, 0]
    alike = features.one_hot(spark.createDataFrame([("a b",), ("a-b",)], "c string"), "c", ["a b", "a-b"], drop_first=False)
    assert [tuple(r)[1:] for r in alike.collect()] == [(1, 0), (0, 1)]


def test_quantile_bins_drop_empty_bins(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 1.0, 1.0, 1.0, 2.0, 3.0, None]], "v double")
    assert [r["v_bin"] for r in features.quantile_bins(df, "v", 4).collect()] == [0, 0, 0, 0, 1, 1, None]


def test_least_kinds_and_priors(spark):
    train = spark.createDataFrame([("a", 0), ("a", 0), ("a", 1)], "f string, label int")
    flipped = bayes.categorical_predict(train, train, ["f"], "label", least_kinds=3, priors={0: 0.1, 1: 0.9})
    assert {r["prediction"] for r in flipped.collect()} == {1}


def test_ordinal_unknown(spark):
    coded = features.ordinal_encode(spark.createDataFrame([("b",), ("a",), (None,)], "c string"), "c")
    assert {r["c"]: r["c_ord"] for r in coded.collect()} == {"a": 0, "b": 1, None: -1}


def test_drawn_params_stay_in_range():
    space = {"a": ("int", 4, 65), "b": ["x", "y"], "c": ("loguniform", 1e-3, 1.0), "d": ("uniform", 0.5, 1.0)}
    for drawn in models.draw_params(space, 200):
        assert 4 <= drawn["a"] < 65 and drawn["b"] in "xy" and 1e-3 <= drawn["c"] <= 1 and 0.5 <= drawn["d"] <= 1
    assert models.draw_params(space, 3) == models.draw_params(space, 3)


def test_pipeline_learns_and_handles_unseen_categories(spark):
    rows = [(float(i % 20), "ab"[i % 2], float(i % 20 > 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "v double, c string, label double")
    prepare = models.preprocessing(standard=["v"], robust=["v"], hashed=["c"], onehot=["c"], hash_features=4)
    for kind, params in (("tree", {}), ("ridge", {"regParam": 0.1}), ("logistic", {}), ("gaussian_nb", {})):
        model = models.classifier(prepare, kind, **params).fit(df)
        assert models.in_sample_accuracy(model, df).first()["accuracy"] > 0.9, kind
    assert model.transform(spark.createDataFrame([(3.0, "z", 0.0)], df.schema)).count() == 1
    weighted = models.balanced_weights(df.filter("v < 15"))
    assert weighted.groupBy("label").agg(F.round(F.sum("weight"), 6).alias("w")).select("w").distinct().count() == 1


def test_forest_fills_only_gaps(spark):
    df = spark.range(60).select("id", F.col("id").cast("double").alias("x"), F.when(F.col("id") % 4 > 0, F.col("id") * 2.0).alias("y"))
    filled = models.forest_impute(df, "y", ["x"], trees=5)
    assert filled.count() == 60 and filled.filter("y is null").count() == 0
    assert filled.filter("id % 4 > 0 and y <> id * 2").count() == 0


def test_neighbours_of_an_empty_training_set(spark):
    train = spark.createDataFrame([], "id long, x array<double>, label int")
    asked = spark.createDataFrame([(1, [1.0, 2.0], 0)], "id long, x array<double>, label int")
    assert knn(train, asked, 3, "id", "x", "label").collect() == []


class _Counted(Estimator):
    """Passes rows on, and keeps how many it was fitted on."""

    def __init__(self):
        super().__init__()
        self.fits = []

    def copy(self, extra=None):
        return self

    def _fit(self, dataset):
        self.fits.append(dataset.count())
        return SQLTransformer(statement="SELECT * FROM __THIS__")


def test_learners_share_what_a_fold_prepared(spark):
    source = random.Random(5)
    rows = [(i % 3, source.gauss(i % 2, 0.7), source.gauss(0, 1), float(i % 2)) for i in range(150)]
    df = spark.createDataFrame(rows, "fold int, a double, b double, label double")
    gather = lambda: VectorAssembler(inputCols=["a", "b"], outputCol="features")
    learners = {"tree": models.learner("tree", maxDepth=2), "logistic": models.learner("logistic", regParam=0.01)}
    counted = _Counted()
    found = models.shared_cv_scores([counted, gather()], learners, df, 3)
    assert counted.fits == [100, 100, 100]  # once a fold, on its training rows, never on all
    for name, stages in learners.items():
        searched = models.random_search(models.Pipeline(stages=[gather(), *stages]), df, {}, 1, 3)
        assert found[name] == pytest.approx((searched.avgMetrics[0], searched.stdMetrics[0]))
        assert models.cv_scores(models.Pipeline(stages=[gather(), *stages]), df, 3) == pytest.approx(found[name])
    with pytest.raises(ValueError):
        models.shared_cv_scores([gather()], learners, df, 2)


class _Watched(Estimator):
    """Keeps the widest partition it was fitted on, the kept bytes in memory and the fits side by side; predicts 0."""

    def __init__(self, known: set):
        super().__init__()
        self.known, self.lock, self.now, self.widths, self.abreast, self.kept = known, threading.Lock(), 0, [], [], []

    def copy(self, extra=None):
        return self

    def _fit(self, dataset):
        with self.lock:
            self.now += 1
            self.abreast.append(self.now)
        counts = dataset.groupBy(F.spark_partition_id()).count()
        self.widths.append(counts.agg(F.max("count")).first()[0])
        self.kept.append(sum(size for key, size in _kept(dataset.sparkSession).items() if key not in self.known))
        with self.lock:
            self.now -= 1
        return SQLTransformer(statement="SELECT *, CAST(0 AS DOUBLE) AS prediction FROM __THIS__")


def _kept(spark) -> dict[int, int]:
    return {info.id(): info.memSize() for info in spark.sparkContext._jsc.sc().getRDDStorageInfo()}


@pytest.mark.parametrize("shared", [True, False])
def test_learners_get_bounded_partitions_and_the_memory(spark, monkeypatch, shared):
    monkeypatch.setattr(models, "PART_ROWS", 100, raising=False)
    # equal rows in one partition
    df = spark.createDataFrame([(i % 3, 1.0, float(i % 2)) for i in range(1200)], "fold int, a double, label double").coalesce(1)
    known = set(_kept(spark))
    watched = _Watched(known)
    gather = VectorAssembler(inputCols=["a"], outputCol="features")
    if shared:
        found = models.shared_cv_scores([gather], {str(i): [watched] for i in range(4)}, df, 3)
        assert set(found.values()) == {(0.5, 0.0)} and len(watched.widths) == 12
    else:
        assert models.cv_scores(models.Pipeline(stages=[gather, watched]), df, 3) == (0.5, 0.0)
    assert max(watched.widths) <= 100
    assert max(watched.abreast) == 1  # partitions enough for every core
    assert set(watched.kept) == {0}
    assert set(_kept(spark)) <= known  # nothing stays
    assert models.bounded(df.limit(100)).rdd.getNumPartitions() == 1  # small tables stay as they are


@pytest.mark.parametrize("name", ["_bernoulli_nb_exact", "_clf_categorical_nb"])
def test_bayes_aggregates_the_lines_once(spark, folder, name):
    scored = getattr(model_queries, name)(spark, folder)
    assert "l_orderkey" not in scored._jdf.queryExecution().optimizedPlan().toString()
