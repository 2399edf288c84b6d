"""Feature preparation and classifiers over orders with their line items."""

from __future__ import annotations

from functools import partial

from pyspark.ml.feature import FeatureHasher
from pyspark.sql import functions as F

from ledgerloom.operators import bayes, features, fold_search, models
from ledgerloom.operators.neighbors import knn, knn_classify
from ledgerloom.operators.sampling import stratified_folds
from ledgerloom.operators.timeseries import rounded
from ledgerloom.plans.fixtures import with_transfers
from ledgerloom.plans.ledger_queries import transfers
from ledgerloom.plans.registry import query
from ledgerloom.runtime import fresh_path, spread, stage
from ledgerloom.sinks.files import write_csv
from ledgerloom.sources.files import load_csv
from ledgerloom.sources.tables import Tables

NUMERIC = ["n_lines", "quantity", "discount", "tax"]
CATEGORICAL = ["status", "priority", "segment"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def frame(spark, folder):
    """One row per order: line totals (0 without lines), categories, and whether it is a large order."""
    tables = Tables(spark, folder)
    lines = tables.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.count("*").cast("double").alias("n_lines"),
        F.sum("l_quantity").alias("quantity"),
        F.avg("l_discount").alias("discount"),
        F.avg("l_tax").alias("tax"),
        F.sum("l_extendedprice").alias("worth"),
    )
    orders = tables.orders.join(tables.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("c_mktsegment").alias("segment"),
    )
    filled = {name: F.coalesce(name, F.lit(0.0)) for name in NUMERIC}
    label = (F.coalesce("worth", F.lit(0.0)) > 150000).cast("int")
    rows = orders.join(lines, "id", "left").withColumns({**filled, "label": label})
    return rows.select("id", *NUMERIC, "label", "price", "status", "priority", "segment")


FRAME = """f AS (
  SELECT o_orderkey AS id, coalesce(n_lines, 0) AS n_lines, coalesce(quantity, 0) AS quantity, coalesce(discount, 0) AS discount,
         coalesce(tax, 0) AS tax, coalesce(label, 0) AS label, o_totalprice AS price, o_orderstatus AS status,
         o_orderpriority AS priority, c_mktsegment AS segment
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN (
    SELECT l_orderkey AS id, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS quantity, avg(l_discount) AS discount,
           avg(l_tax) AS tax, CASE WHEN sum(l_extendedprice) > 150000 THEN 1 ELSE 0 END AS label
    FROM lineitem GROUP BY 1) l ON o_orderkey = l.id)"""


# ---- features ----------------------------------------------------------------


@query(
    "standard_scale",
    """SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS l_quantity,
              round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER (), 6) AS l_extendedprice FROM lineitem""",
)
def _standard_scale(spark, folder):
    lines = Tables(spark, folder).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return rounded(features.standard_scale(lines, ["l_quantity", "l_extendedprice"]), 6, "l_quantity", "l_extendedprice")


@query(
    "robust_scale",
    """SELECT o_orderkey, round((o_totalprice - (SELECT quantile_cont(o_totalprice, 0.5) FROM orders)) /
         (SELECT quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25) FROM orders), 6) AS o_totalprice FROM orders""",
)
def _robust_scale(spark, folder):
    orders = Tables(spark, folder).orders.select("o_orderkey", "o_totalprice")
    return rounded(features.robust_scale(orders, "o_totalprice"), 6, "o_totalprice")


@query(
    "one_hot",
    """SELECT c_custkey, c_mktsegment, """
    + ", ".join(
        f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS c_mktsegment_{s.lower()}"
        for s in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    )
    + " FROM customer",
)
def _one_hot(spark, folder):
    return features.one_hot(Tables(spark, folder).customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", SEGMENTS)


@query(
    "target_encode",
    f"""WITH {FRAME}, m AS (SELECT priority, count(*) AS n, avg(label) AS mean FROM f GROUP BY 1)
        SELECT f.id, f.priority, label, round(n / (n + 1.0) * mean + (1 - n / (n + 1.0)) * (SELECT avg(label) FROM f), 6) AS priority_te
        FROM f JOIN m ON m.priority = f.priority""",
)
def _target_encode(spark, folder):
    encoded = features.target_encode(frame(spark, folder).select("id", "priority", "label"), "priority", "label")
    return rounded(encoded, 6, "priority_te")


@query(
    "ordinal_encode",
    """SELECT p_partkey, p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand_ord FROM part""",
)
def _ordinal_encode(spark, folder):
    return features.ordinal_encode(Tables(spark, folder).part.select("p_partkey", "p_brand"), "p_brand")


@query(
    "uniform_bins",
    """SELECT o_orderkey, least(5, CAST(floor((o_totalprice - lo) / ((hi - lo) / 6)) AS BIGINT)) AS o_totalprice_bin
       FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)""",
)
def _uniform_bins(spark, folder):
    orders = Tables(spark, folder).orders.select("o_orderkey", "o_totalprice")
    return features.uniform_bins(orders, "o_totalprice", 6).drop("o_totalprice")


@query("binarize", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS c_acctbal_bin FROM customer")
def _binarize(spark, folder):
    return features.binarize(Tables(spark, folder).customer.select("c_custkey", "c_acctbal"), "c_acctbal").drop("c_acctbal")


@query(
    "class_priors",
    f"WITH {FRAME} SELECT label, count(*) AS n, round((count(*) + 1.0) / ((SELECT count(*) FROM f) + 2.0), 9) AS prior FROM f GROUP BY label",
)
def _class_priors(spark, folder):
    return rounded(features.class_priors(frame(spark, folder), "label"), 9, "prior")


@query(
    "stratified_folds",
    with_transfers(
        """SELECT id, is_laundering, CAST((row_number() OVER (PARTITION BY is_laundering
             ORDER BY (id % 2147483648 * 1103515245 + 12345) % 2147483648, id) - 1) % 5 AS INTEGER) AS fold FROM t"""
    ),
)
def _stratified_folds(spark, folder):
    sent = transfers(spark, folder, currencies=False).select("id", "is_laundering")
    return stratified_folds(sent, "id", "is_laundering", 5)


@query("feature_hash")
def _feature_hash(spark, folder):
    hashed = models.hashed_features(frame(spark, folder).select("id", *CATEGORICAL), CATEGORICAL, 16)
    return hashed.select("id", F.col("hashed").cast("string").alias("hashed"))


@query(
    "quantile_bins",
    "SELECT o_orderkey, "
    + " + ".join(
        f"CASE WHEN o_totalprice >= (SELECT quantile_cont(o_totalprice, {i / 6!r}) FROM orders) THEN 1 ELSE 0 END"
        for i in range(1, 6)
    )
    + " AS o_totalprice_bin FROM orders",
)
def _quantile_bins(spark, folder):
    orders = Tables(spark, folder).orders.select("o_orderkey", "o_totalprice")
    return features.quantile_bins(orders, "o_totalprice", 6).drop("o_totalprice")


@query("kmeans_bins")
def _kmeans_bins(spark, folder):
    return models.kmeans_bins(Tables(spark, folder).orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 5)


@query("rf_impute")
def _rf_impute(spark, folder):
    rows = frame(spark, folder).select("id", *NUMERIC, "price")
    holed = rows.withColumn("price", F.when(F.pmod("id", F.lit(5)) != 0, F.col("price")))
    return models.forest_impute(spread(holed, "id"), "price", NUMERIC)


# ---- exact classifiers -------------------------------------------------------


_GAUSSIAN = ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) AS v_{f}" for f in NUMERIC)
_WIDEST = "greatest(" + ", ".join(f"var_pop({f})" for f in NUMERIC) + ")"
_SCORE = " ".join(
    f"- 0.5 * ln(2 * pi() * (v_{f} + e)) - pow(f.{f} - m_{f}, 2) / (2 * (v_{f} + e))" for f in NUMERIC
)
GAUSSIAN = f"""{FRAME},
  w AS (SELECT {_WIDEST} * 1e-9 AS e, count(*) AS total FROM f),
  c AS (SELECT label AS cl, count(*) AS n, {_GAUSSIAN} FROM f GROUP BY label),
  s AS (SELECT f.id, f.label, cl, ln(n / CAST(total AS DOUBLE)) {_SCORE} AS score FROM f, c, w),
  g AS (SELECT id, label, cl AS prediction FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, cl) AS rn FROM s) WHERE rn = 1)"""


def _gaussian(spark, folder):
    rows = frame(spark, folder).select("id", *NUMERIC, "label")
    return bayes.gaussian_predict(rows, bayes.gaussian_params(rows, NUMERIC, "label"), NUMERIC)


@query("clf_gaussian_nb", f"WITH {GAUSSIAN} SELECT id, label, prediction FROM g")
def _clf_gaussian_nb(spark, folder):
    return _gaussian(spark, folder).select("id", "label", "prediction")


@query(
    "accuracy",
    f"WITH {GAUSSIAN} SELECT count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM g",
)
def _accuracy(spark, folder):
    return rounded(bayes.accuracy(_gaussian(spark, folder), "label"), 6, "accuracy")


def _categorical_sql() -> str:
    names = [*CATEGORICAL, "lines"]
    tables = ", ".join(
        f"""k_{n} AS (SELECT v, cl, coalesce(n, 0) AS n, (SELECT count(DISTINCT {n}) FROM d) AS kinds
             FROM (SELECT DISTINCT {n} AS v FROM d) a CROSS JOIN (SELECT cl FROM c) b
             LEFT JOIN (SELECT {n} AS v, label AS cl, count(*) AS n FROM d GROUP BY 1, 2) x USING (v, cl))"""
        for n in names
    )
    joins = " ".join(f"JOIN k_{n} ON k_{n}.v = d.{n} AND k_{n}.cl = c.cl" for n in names)
    score = " + ".join(f"ln((k_{n}.n + 1.0) / (c.n + 1.0 * k_{n}.kinds))" for n in names)
    return f"""WITH {FRAME}, d AS (SELECT *, CAST(CAST(n_lines AS INTEGER) AS VARCHAR) AS lines FROM f),
      c AS (SELECT label AS cl, count(*) AS n FROM d GROUP BY 1), {tables},
      s AS (SELECT d.id, d.label, c.cl, ln(c.n / CAST((SELECT count(*) FROM d) AS DOUBLE)) + {score} AS score FROM d, c {joins})
      SELECT id, label, cl AS prediction FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, cl) AS rn FROM s) WHERE rn = 1"""


@query("clf_categorical_nb", _categorical_sql().replace("FROM d, c JOIN", "FROM d CROSS JOIN c JOIN"))
def _clf_categorical_nb(spark, folder):
    coded = frame(spark, folder).select(
        "id", *CATEGORICAL, F.col("n_lines").cast("int").cast("string").alias("lines"), "label"
    )
    # written once: both counting and scoring read it
    rows = stage(coded, "frame")
    predicted = bayes.categorical_predict(rows, rows, [*CATEGORICAL, "lines"], "label")
    return predicted.select("id", "label", "prediction")


_OVER = ", ".join(f"CAST({f} > (SELECT avg({f}) FROM f) AS INTEGER) AS b_{f}" for f in NUMERIC)
_ONES = ", ".join(f"sum(b_{f}) AS s_{f}" for f in NUMERIC)
_BITS = " + ".join(
    f"ln(CASE WHEN b_{f} = 1 THEN (s_{f} + 1.0) / (n + 2.0) ELSE (n - s_{f} + 1.0) / (n + 2.0) END)" for f in NUMERIC
)


@query(
    "bernoulli_nb_exact",
    f"""WITH {FRAME}, d AS (SELECT id, label, {_OVER} FROM f), c AS (SELECT label AS cl, count(*) AS n, {_ONES} FROM d GROUP BY label),
      s AS (SELECT id, label, cl, ln(n / CAST((SELECT count(*) FROM d) AS DOUBLE)) + {_BITS} AS score FROM d CROSS JOIN c)
      SELECT id, label, cl AS prediction FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, cl) AS rn FROM s) WHERE rn = 1""",
)
def _bernoulli_nb_exact(spark, folder):
    # written once: means, counts and scores all read it
    rows = stage(frame(spark, folder).select("id", *NUMERIC, "label"), "frame")
    means = {f: rows.agg(F.avg(f)).scalar() for f in NUMERIC}
    return bayes.bernoulli_predict(rows, rows, NUMERIC, "label", means).select("id", "label", "prediction")


_KNN = """WITH n AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, b.label,
    {distance} AS distance, row_number() OVER (PARTITION BY a.vec_id ORDER BY {distance}, b.vec_id) AS rank
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)"""
_L2 = "list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


def _neighbors(spark, folder, k: int):
    vectors = Tables(spark, folder).embeddings
    return knn(vectors, vectors, k, "vec_id", "embedding", "label", exclude_self=True)


@query("knn_neighbors", _KNN.format(distance=_L2) + " SELECT query_id, neighbor_id, label, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM n WHERE rank <= 5")
def _knn_neighbors(spark, folder):
    return rounded(_neighbors(spark, folder, 5), 6, "distance")


@query(
    "clf_knn",
    _KNN.format(distance=_L2)
    + """, v AS (SELECT query_id, label, count(*) AS votes FROM n WHERE rank <= 15 GROUP BY 1, 2)
       SELECT query_id, label AS prediction FROM (
         SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, label) AS rn FROM v) WHERE rn = 1""",
)
def _clf_knn(spark, folder):
    return knn_classify(_neighbors(spark, folder, 15))


# ---- spark.ml classifiers ----------------------------------------------------


def _training(spark, folder):
    rows = frame(spark, folder).withColumn("label", F.col("label").cast("double"))
    return stage(spread(rows, "id"), "training")


def _scaled() -> list:
    return models.preprocessing(standard=NUMERIC, hashed=["priority", "segment"], onehot=["status"])


def _plain() -> list:
    return models.preprocessing(numeric=NUMERIC, hashed=["priority", "segment"], onehot=["status"])


# how the rows are prepared, the learner and its parameters
LEARNERS = {
    "clf_logreg": (_scaled, "logistic", {"maxIter": 50, "regParam": 0.01, "elasticNetParam": 0.5}),
    "clf_ridge": (_scaled, "ridge", {"regParam": 1.0}),
    "clf_linear_svc": (_scaled, "linear_svc", {"maxIter": 30, "regParam": 0.01}),
    "clf_tree": (_plain, "tree", {"maxDepth": 6, "minInstancesPerNode": 2}),
    "clf_forest": (_plain, "forest", {"numTrees": 20, "maxDepth": 6, "minInstancesPerNode": 5}),
    "clf_gbt": (_plain, "gbt", {"maxIter": 10, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8}),
    "clf_bernoulli_nb": (_scaled, "bernoulli_nb", {"threshold": 0.0, "smoothing": 1.0}),
}


def _pipeline(name: str):
    prepare, kind, params = LEARNERS[name]
    return models.classifier(prepare(), kind, **params)


CLASSIFIERS = {name: partial(_pipeline, name) for name in LEARNERS}


# A learner that has learned something beats the larger class on rows it has not seen.
_HELD_OUT = f"""WITH {FRAME} SELECT '%s' AS model, count(*) AS n_held_out, CAST(sum(label) AS BIGINT) AS n_positive, TRUE AS above_majority
                FROM f WHERE id %% 5 = 0"""


def _classifier(name: str) -> None:
    @query(name, _HELD_OUT % name)
    def run(spark, folder):
        score = models.held_out_score(CLASSIFIERS[name](), _training(spark, folder), F.pmod("id", F.lit(5)) == 0)
        above = (F.col("accuracy") > F.col("majority_share")).alias("above_majority")
        return score.select(F.lit(name).alias("model"), "n_held_out", "n_positive", above)


for _name in CLASSIFIERS:
    _classifier(_name)


def _folded(spark, folder, folds: int):
    return stage(spread(stratified_folds(_training(spark, folder), "id", "label", folds), "id"), "folds")


@query("random_search")
def _random_search(spark, folder, draws: int = 4, folds: int = 3):
    """A short search; draws and folds are the caller's."""
    prepare = _plain()
    hasher = next(stage for stage in prepare if isinstance(stage, FeatureHasher))
    pipeline = models.classifier(prepare, "tree")
    tree = pipeline.getStages()[-1]
    space = {
        hasher.numFeatures: ("int", 4, 65),
        tree.impurity: ["gini", "entropy"],
        tree.maxDepth: ("int", 1, 9),
        tree.minInstancesPerNode: ("int", 1, 21),
    }
    fitted = models.random_search(pipeline, _folded(spark, folder, folds), space, draws=draws, folds=folds)
    rows = [
        (i, str({param.name: value for param, value in chosen.items()}), float(mean), float(spread))
        for i, (chosen, mean, spread) in enumerate(
            zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics, fitted.stdMetrics)
        )
    ]
    return spark.createDataFrame(rows, "draw int, params string, mean_accuracy double, std_accuracy double")


# ---- searches from the sums of folds -----------------------------------------

DRAWS, FOLDS = 100, 5
# the smallest share of the largest variance keeps a feature without spread in a class usable
SMOOTHINGS = [d["s"] for d in models.draw_params({"s": ("loguniform", 1e-9, 1.0)}, DRAWS)]
ALPHAS = [d["a"] for d in models.draw_params({"a": ("loguniform", 1e-3, 100.0)}, DRAWS)]
CUTS = [(d["t"], d["a"]) for d in models.draw_params({"t": ("uniform", 0.2, 1.8), "a": ("loguniform", 1e-3, 100.0)}, DRAWS)]
PENALTIES = [d["p"] for d in models.draw_params({"p": ("loguniform", 1e-3, 1e5)}, DRAWS)]


def _searched(spark, folder, *names: str):
    rows = _folded(spark, folder, FOLDS)
    kinds = fold_search.categories(rows, CATEGORICAL)
    means = rows.agg(*[F.avg(f) for f in NUMERIC]).first()
    learners = {
        "gaussian_nb": fold_search.Gaussian(SMOOTHINGS),
        "bernoulli_nb": fold_search.Bernoulli(CUTS, list(means)),
        "categorical_nb": fold_search.Categorical(ALPHAS, [len(k) for k in kinds]),
        "ridge": fold_search.Ridge(PENALTIES),
    }
    found = fold_search.search(rows, {n: learners[n] for n in names}, NUMERIC, CATEGORICAL, kinds)
    return found.groupBy("model", "draw").agg(
        F.sum("n").alias("n"), F.sum("correct").alias("correct"), F.round(F.avg(F.col("correct") / F.col("n")), 9).alias("mean_accuracy")
    )


_FOLDED = f"""{FRAME}, d AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY (id % 2147483648 * 1103515245 + 12345) % 2147483648, id) - 1) % {FOLDS} AS fold FROM f),
  k AS (SELECT unnest(range({FOLDS})) AS held)"""


def _values(rows: list) -> str:
    return ", ".join(f"({i}, {', '.join(f'CAST({v!r} AS DOUBLE)' for v in (row if isinstance(row, tuple) else (row,)))})" for i, row in enumerate(rows))


def _search_sql(model: str, tables: str, score: str, source: str) -> str:
    """`score` is the log score of class cl for row d of the held fold under draw p."""
    return f"""WITH {_FOLDED}, {tables},
      s AS (SELECT p.draw, d.fold, d.id, d.label, c.cl, {score} AS score FROM d JOIN c ON c.held = d.fold CROSS JOIN p {source}),
      r AS (SELECT draw, fold, id, any_value(label) AS label,
                   CAST(max(score) FILTER (cl = 1) > max(score) FILTER (cl = 0) AS INTEGER) AS prediction FROM s GROUP BY 1, 2, 3),
      a AS (SELECT draw, fold, count(*) AS n, count(*) FILTER (label = prediction) AS correct FROM r GROUP BY 1, 2)
      SELECT '{model}' AS model, CAST(draw AS INTEGER) AS draw, CAST(sum(n) AS BIGINT) AS n, CAST(sum(correct) AS BIGINT) AS correct,
             round(avg(correct / n), 9) AS mean_accuracy FROM a GROUP BY draw"""


_PRIOR = "ln(c.n / CAST(sum(c.n) OVER (PARTITION BY p.draw, d.id) AS DOUBLE))"
_MOMENTS = ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) AS v_{f}" for f in NUMERIC)
_WIDEST = "greatest(" + ", ".join(f"var_pop({f})" for f in NUMERIC) + ")"
_BELL = "".join(f" - 0.5 * (ln(2 * pi() * (v_{f} + p.s * widest)) + pow({f} - m_{f}, 2) / (v_{f} + p.s * widest))" for f in NUMERIC)


@query(
    "search_gaussian_nb",
    _search_sql(
        "gaussian_nb",
        f"""c AS (SELECT held, label AS cl, count(*) AS n, {_MOMENTS} FROM d JOIN k ON fold <> held GROUP BY 1, 2),
        w AS (SELECT held AS w_held, {_WIDEST} AS widest FROM d JOIN k ON fold <> held GROUP BY 1),
        p AS (SELECT * FROM (VALUES {_values(SMOOTHINGS)}) v(draw, s))""",
        f"{_PRIOR}{_BELL}",
        "JOIN w ON w_held = d.fold",
    ),
)
def _search_gaussian_nb(spark, folder):
    return _searched(spark, folder, "gaussian_nb")


_OVER_CUT = ", ".join(f"avg({f}) AS mu_{f}" for f in NUMERIC)
_ONES_CUT = ", ".join(f"count(*) FILTER ({f} > t * mu_{f}) AS o_{f}" for f in NUMERIC)
_COIN = "".join(
    f" + ln(CASE WHEN {f} > t * mu_{f} THEN (o_{f} + a) / (c.n + 2 * a) ELSE 1 - (o_{f} + a) / (c.n + 2 * a) END)" for f in NUMERIC
)


@query(
    "search_bernoulli_nb",
    _search_sql(
        "bernoulli_nb",
        f"""mu AS (SELECT {_OVER_CUT} FROM d), v AS (SELECT * FROM (VALUES {_values(CUTS)}) v(draw, t, a)),
        p AS (SELECT * FROM v CROSS JOIN mu),
        c AS (SELECT held, label AS cl, draw AS c_draw, count(*) AS n, {_ONES_CUT} FROM d JOIN k ON fold <> held CROSS JOIN p GROUP BY 1, 2, 3)""",
        f"{_PRIOR}{_COIN}",
        "WHERE c.c_draw = p.draw",
    ),
)
def _search_bernoulli_nb(spark, folder):
    return _searched(spark, folder, "bernoulli_nb")


_KINDS = ", ".join(f"(SELECT count(DISTINCT {f}) FROM d) AS k_{f}" for f in CATEGORICAL)
_SEEN = ", ".join(
    f"t_{f} AS (SELECT held AS h_{f}, label AS l_{f}, {f} AS v_{f}, count(*) AS s_{f} FROM d JOIN k ON fold <> held GROUP BY 1, 2, 3)" for f in CATEGORICAL
)
_TABLE = "".join(f" + ln((coalesce(s_{f}, 0) + p.a) / (c.n + p.a * k_{f}))" for f in CATEGORICAL)


@query(
    "search_categorical_nb",
    _search_sql(
        "categorical_nb",
        f"""{_SEEN}, g AS (SELECT {_KINDS}), p AS (SELECT * FROM (VALUES {_values(ALPHAS)}) v(draw, a) CROSS JOIN g),
        c AS (SELECT held, label AS cl, count(*) AS n FROM d JOIN k ON fold <> held GROUP BY 1, 2)""",
        f"{_PRIOR}{_TABLE}",
        " ".join(f"LEFT JOIN t_{f} ON h_{f} = d.fold AND l_{f} = c.cl AND v_{f} = d.{f}" for f in CATEGORICAL),
    ),
)
def _search_categorical_nb(spark, folder):
    return _searched(spark, folder, "categorical_nb")


@query("search_ridge")
def _search_ridge(spark, folder):
    """The equations of each draw are solved by elimination, for which SQL has no form."""
    return _searched(spark, folder, "ridge")


@query("cv_scores")
def _cv_scores(spark, folder):
    """Held-out accuracy of every registered classifier over five folds."""
    rows = models.bounded(_folded(spark, folder, 5))
    found = {}
    try:
        for prepare in (_scaled, _plain):
            learners = {name: models.learner(kind, **params) for name, (how, kind, params) in LEARNERS.items() if how is prepare}
            found |= models.shared_cv_scores(prepare(), learners, rows, 5)
    finally:
        rows.unpersist()
    scores = [(name, *found[name]) for name in LEARNERS]
    return spark.createDataFrame(scores, "model string, mean_accuracy double, std_accuracy double")


@query("batch_score")
def _batch_score(spark, folder):
    """Scores every order with a tree and stores them as a CSV submission."""
    rows = _training(spark, folder)
    scored = models.batch_score(CLASSIFIERS["clf_tree"]().fit(rows), rows.drop("label"), "id", "large_order")
    path = fresh_path(spark, "submission")
    write_csv(scored, path)
    return load_csv(spark, path, scored.schema)
