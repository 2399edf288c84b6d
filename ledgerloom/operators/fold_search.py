"""Cross-validated searches in two passes, whatever the number of draws.

Learners whose fit is a function of sums need no training job for a draw: one
pass adds up each fold's sums, the sums of the other folds are a total less the
fold's own, and every draw is solved from them on the driver. A second pass
scores each row with all draws of its fold. Both passes work on Arrow batches;
what leaves a batch are sums and counts of correct rows, never rows.

A learner has `terms(x, codes, y)`, the sums of a batch as one vector;
`solve(sums)`, the models of all draws; and `predict(model, x, codes)`, classes
(draws, rows). Classes are 0 and 1; a tie goes to 0.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLASSES = (0, 1)
LARGEST_TABLE = 100_000  # sums of a fold that the driver may hold


def _log(values: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(values)


class Gaussian:
    """Draws are shares of the largest feature variance, added to every variance."""

    def __init__(self, draws: Sequence[float]):
        self.draws = np.array(draws, float)

    def terms(self, x, codes, y):
        return np.concatenate([np.r_[(y == c).sum(), x[y == c].sum(0), (x[y == c] ** 2).sum(0)] for c in CLASSES])

    def solve(self, sums):
        rows = sums.reshape(len(CLASSES), -1)
        n, f = rows[:, :1], (rows.shape[1] - 1) // 2
        mean = rows[:, 1 : f + 1] / n
        variance = rows[:, f + 1 :] / n - mean**2
        whole = rows.sum(0)
        widest = (whole[f + 1 :] / whole[0] - (whole[1 : f + 1] / whole[0]) ** 2).max()
        return _log(n[:, 0] / n.sum()), mean, variance[None] + self.draws[:, None, None] * widest

    def predict(self, model, x, codes):
        prior, mean, variance = model
        gaps = (x[None] - mean[:, None]) ** 2  # class, row, feature
        scores = [prior[c] - 0.5 * (np.log(2 * np.pi * variance[:, None, c]) + gaps[None, c] / variance[:, None, c]).sum(2) for c in CLASSES]
        return (scores[1] > scores[0]).astype(np.int8)


class Bernoulli:
    """Draws are (threshold, smoothing); a feature counts as present above threshold times its scale."""

    def __init__(self, draws: Sequence[tuple[float, float]], scale: Sequence[float]):
        self.cuts = np.array([t for t, _ in draws])[:, None] * np.array(scale, float)
        self.smoothing = np.array([a for _, a in draws])

    def terms(self, x, codes, y):
        over = lambda rows: np.array([(rows > cut).sum(0) for cut in self.cuts])
        return np.concatenate([np.r_[(y == c).sum(), over(x[y == c]).ravel()] for c in CLASSES])

    def solve(self, sums):
        rows = sums.reshape(len(CLASSES), -1)
        n = rows[:, 0]
        ones = rows[:, 1:].reshape(len(CLASSES), *self.cuts.shape)
        share = (ones + self.smoothing[:, None]) / (n[:, None, None] + 2 * self.smoothing[:, None])
        return _log(n / n.sum()), _log(share), _log(1 - share)

    def predict(self, model, x, codes):
        prior, yes, no = model
        out = []
        for d, cut in enumerate(self.cuts):
            over = x > cut
            scores = [prior[c] + np.where(over, yes[c, d], no[c, d]).sum(1) for c in CLASSES]
            out.append(scores[1] > scores[0])
        return np.array(out, np.int8)


class Categorical:
    """Draws are smoothings; `sizes` has the number of categories of each feature."""

    def __init__(self, draws: Sequence[float], sizes: Sequence[int]):
        self.draws, self.sizes = np.array(draws, float), list(sizes)
        self.starts = np.r_[0, np.cumsum(self.sizes)[:-1]].astype(int)

    def terms(self, x, codes, y):
        flat = codes + self.starts
        count = lambda rows: np.bincount(rows.ravel(), minlength=sum(self.sizes))
        return np.concatenate([np.r_[(y == c).sum(), count(flat[y == c])] for c in CLASSES])

    def solve(self, sums):
        rows = sums.reshape(len(CLASSES), -1)
        n, seen = rows[:, 0], rows[:, 1:]
        kinds = np.repeat(self.sizes, self.sizes)
        alpha = self.draws[:, None, None]
        return _log(n / n.sum()), _log((seen[None] + alpha) / (n[None, :, None] + alpha * kinds))

    def predict(self, model, x, codes):
        prior, table = model  # draw, class, category
        flat = codes + self.starts
        scores = prior[None, :, None] + table[:, :, flat].sum(3)
        return (scores[:, 1] > scores[:, 0]).astype(np.int8)


class Ridge:
    """Least squares on -1 and +1 with standardised features; draws are penalties."""

    def __init__(self, draws: Sequence[float]):
        self.draws = list(draws)

    def terms(self, x, codes, y):
        rows = np.column_stack([np.ones(len(x)), x, 2.0 * y - 1])
        return (rows.T @ rows).ravel()

    def solve(self, sums):
        side = int(round(len(sums) ** 0.5))
        gram = sums.reshape(side, side)
        n, mean = gram[0, 0], gram[0, 1:] / gram[0, 0]
        centred = gram[1:, 1:] - n * np.outer(mean, mean)
        spread = np.sqrt(np.diag(centred)[:-1] / n)
        spread = np.where(spread > 0, spread, 1.0)
        square = centred[:-1, :-1] / np.outer(spread, spread)
        weights = [np.linalg.solve(square + a * np.eye(len(spread)), centred[:-1, -1] / spread) / spread for a in self.draws]
        return [(w, mean[-1] - w @ mean[:-1]) for w in weights]

    def predict(self, model, x, codes):
        return np.array([x @ w + b > 0 for w, b in model], np.int8)


def categories(df: DataFrame, columns: Sequence[str]) -> list[list[str]]:
    """The sorted values of each column, which have to be few."""
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("v")) for i, c in enumerate(columns)])
    found = df.select(F.inline(cells)).distinct().limit(LARGEST_TABLE + 1).collect()
    if len(found) > LARGEST_TABLE:
        raise ValueError("too many categories for a table on the driver; hash them first")
    return [sorted(r["v"] for r in found if r["i"] == i) for i in range(len(columns))]


def search(
    df: DataFrame,
    learners: dict[str, object],
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    kinds: Sequence[Sequence[str]] = (),
    label: str = "label",
    fold: str = "fold",
) -> DataFrame:
    """model, draw, fold, n, correct: the rows of each held-out fold and how many of them each draw gets right."""
    spark = df.sparkSession
    codes_of = [{v: i for i, v in enumerate(values)} for values in kinds]
    data = df.select(
        F.col(fold).cast("int").alias("fold"), F.col(label).cast("int").alias("label"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(numeric)],
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"c{i}") for i, c in enumerate(categorical)],
    )

    def parts(batch):
        """fold, x, codes, y of the rows of each fold in a batch."""
        folds, y = batch.column("fold").to_numpy(), batch.column("label").to_numpy()
        x = np.array([batch.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(len(numeric))]).reshape(len(numeric), -1).T
        codes = np.array([[own[v] for v in batch.column(f"c{i}").to_pylist()] for i, own in enumerate(codes_of)], np.int64).reshape(len(codes_of), -1).T
        for k in np.unique(folds):
            own = folds == k
            yield int(k), x[own], codes[own] if len(codes) else np.zeros((int(own.sum()), 0), np.int64), y[own]

    def add_up(batches):
        sums: dict = {}
        for batch in batches:
            for k, x, codes, y in parts(batch):
                for name, learner in learners.items():
                    sums[name, k] = sums.get((name, k), 0) + learner.terms(x, codes, y).astype(float)
        for (name, k), values in sums.items():
            n = len(values)
            yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array([k] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(values)], names=["model", "fold", "at", "value"])

    added = data.mapInArrow(add_up, "model string, fold int, at int, value double").groupBy("model", "fold", "at").agg(F.sum("value").alias("value"))
    own: dict = {}
    for r in added.collect():  # folds times the length of the learners' sums
        own.setdefault((r["model"], r["fold"]), {})[r["at"]] = r["value"]
    vectors = {key: np.array([values[i] for i in range(len(values))]) for key, values in own.items()}
    totals = {name: sum(v for (model, _), v in vectors.items() if model == name) for name in learners}
    solved = spark.sparkContext.broadcast({(name, k): learners[name].solve(totals[name] - v) for (name, k), v in vectors.items()})

    def score(batches):
        hits: dict = {}
        for batch in batches:
            for k, x, codes, y in parts(batch):
                for name, learner in learners.items():
                    right = (learner.predict(solved.value[name, k], x, codes) == y).sum(1)
                    n, correct = hits.get((name, k), (0, 0))
                    hits[name, k] = n + len(y), correct + right
        for (name, k), (n, right) in hits.items():
            d = len(right)
            columns = [pa.array([name] * d), pa.array(range(d), pa.int32()), pa.array([k] * d, pa.int32()), pa.array([n] * d, pa.int64()), pa.array(right, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["model", "draw", "fold", "n", "correct"])

    scored = data.mapInArrow(score, "model string, draw int, fold int, n long, correct long")
    return scored.groupBy("model", "draw", "fold").agg(F.sum("n").alias("n"), F.sum("correct").alias("correct"))
