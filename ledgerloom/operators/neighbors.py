"""Exact k-nearest neighbours as a partitioned join.

Training rows are assigned to the nearest of a few pivots. The size and radius of
each pivot's cell bound how far the k-th neighbour of a query can be, so a query
only visits cells that can hold one of its neighbours. Cells with many rows are
split into blocks; each task compares one block of rows with one block of queries
and keeps k rows per query, and the per-block winners are merged.

A block is compared in tiles. For p = 2 the product form of the distance, with a
bound on its rounding error, rules out rows behind the k best so far; what it leaves
is measured by differences, so near-equal rows keep their digits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.hashing import scramble


def _distances(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    if p == 1:
        return np.stack([np.abs(a - row).sum(axis=1) for row in b], axis=1)
    # differences, not the dot-product form: near-equal rows keep their digits
    return np.stack([np.sqrt(((a - row) ** 2).sum(axis=1)) for row in b], axis=1)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


# Queries and rows of a tile, and pairs that are measured at once.
TILE_QUERIES, TILE_ROWS, TILE_PAIRS = 1024, 2048, 1 << 16


def _leave_out(d: np.ndarray, own: np.ndarray, ids: np.ndarray) -> None:
    """Infinite distance where a query meets its own id; numbers come sorted."""
    if ids.dtype.kind not in "iu":
        d[own[:, None] == ids[None, :]] = np.inf
        return
    low, high = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
    for query in np.flatnonzero(high > low):
        d[query, low[query] : high[query]] = np.inf


def _nearest(own: np.ndarray, asks: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, p: int, exclude_self: bool):
    """(query, row, distance) positions of each query's k nearest rows; equal distances go to the earlier row."""
    with np.errstate(over="ignore", invalid="ignore"):
        ask_norms, row_norms = (asks * asks).sum(axis=1), (rows * rows).sum(axis=1)
    # twice the squared norms bound every term of the product form; far from overflow
    largest = max(ask_norms.max(), row_norms.max())
    product = p == 2 and bool(largest < 1e300)
    slack = 8 * (asks.shape[1] + 8) * np.finfo(float).eps * largest if product else 0.0
    found = []
    for start in range(0, len(asks), TILE_QUERIES):
        a, mine = asks[start : start + TILE_QUERIES], own[start : start + TILE_QUERIES]
        at, of, far = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        limit = np.full(len(a), np.inf)  # the k-th best distance so far
        for first in range(0, len(rows), TILE_ROWS):
            b = rows[first : first + TILE_ROWS]
            if product:
                d = a @ (-2.0 * b).T
                d += ask_norms[start : start + TILE_QUERIES, None]
                d += row_norms[None, first : first + TILE_ROWS]
            else:
                d = _distances(a, b, p)
            if exclude_self:
                _leave_out(d, mine, ids[first : first + TILE_ROWS])
            bound = limit * limit * (1 + 1e-9) + slack if product else limit
            if len(b) > k and np.isinf(bound).any():
                kth = np.partition(d, k - 1, axis=1)[:, k - 1] + 2 * slack
                bound = np.fmin(bound, kth)
            near = np.flatnonzero(d <= np.minimum(bound, np.finfo(float).max)[:, None])
            if not len(near):
                continue
            i, j = np.divmod(near, len(b))
            if product:
                parts = range(0, len(i), TILE_PAIRS)
                exact = [np.sqrt(((a[i[n : n + TILE_PAIRS]] - b[j[n : n + TILE_PAIRS]]) ** 2).sum(axis=1)) for n in parts]
                measured = np.concatenate(exact)
            else:
                measured = d[i, j]
            at, of, far = np.concatenate([at, i]), np.concatenate([of, j + first]), np.concatenate([far, measured])
            order = np.lexsort((of, far, at))
            at, of, far = at[order], of[order], far[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            limit[at[place == k - 1]] = far[place == k - 1]
            at, of, far = at[place < k], of[place < k], far[place < k]
        found.append((at + start, of, far))
    return [np.concatenate(column) for column in zip(*found)]


def knn(
    train: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str,
    vector: str,
    label: str,
    p: int = 2,
    exclude_self: bool = False,
    pivots: int = 32,
    block_rows: int = 32768,
) -> DataFrame:
    """The k nearest training rows of every query: (query_id, neighbor_id, label, distance, rank).

    Ties are broken by the neighbour id. `pivots` and `block_rows` change the
    cost, never the result.
    """
    base = train.select(F.col(id_column).alias("id"), F.col(vector).alias("x"), F.col(label).alias("label"))
    asked = queries.select(F.col(id_column).alias("query_id"), F.col(vector).alias("x"))
    # at most `pivots` vectors reach the driver
    chosen = [row[0] for row in base.orderBy(scramble("id"), "id").limit(pivots).select("x").collect()]
    if not chosen:
        kinds = ("query_id", base.schema["id"]), ("neighbor_id", base.schema["id"]), ("label", base.schema["label"])
        names = ", ".join(f"{name} {field.dataType.simpleString()}" for name, field in kinds)
        return base.sparkSession.createDataFrame([], f"{names}, distance double, rank int")
    centres = np.array(chosen, dtype=float)

    @F.pandas_udf("cell int, gap double")
    def nearest(x: pd.Series) -> pd.DataFrame:
        d = _distances(_matrix(x), centres, p)
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "gap": d[np.arange(len(d)), cell]})

    placed = base.withColumn("at", nearest("x")).select("id", "x", "label", "at.cell", "at.gap")
    stats = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()
    sizes, radii = np.zeros(len(centres)), np.full(len(centres), -1.0)
    for row in stats:
        sizes[row["cell"]], radii[row["cell"]] = row["n"], row["radius"]
    needed = k + (1 if exclude_self else 0)

    @F.pandas_udf("array<int>")
    def reachable(x: pd.Series) -> pd.Series:
        d = _distances(_matrix(x), centres, p)
        far = np.where(sizes > 0, d + radii, np.inf)
        order = far.argsort(axis=1)
        enough = (sizes[order].cumsum(axis=1) >= needed).argmax(axis=1)
        rows = np.arange(len(d))
        limit = far[rows, order[rows, enough]]
        if sizes.sum() < needed:
            limit = np.full(len(d), np.inf)
        near = np.where(sizes > 0, d - radii, np.inf)
        open_ = (near <= (limit * (1 + 1e-9) + 1e-9)[:, None]) & (sizes > 0)
        return pd.Series([np.flatnonzero(row).astype("int32") for row in open_])

    visits = asked.withColumn("cell", F.explode(reachable("x")))
    load = {row["cell"]: row["n"] for row in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    blocks = lambda counts: F.array(*[F.lit(max(1, -(-int(n) // block_rows))) for n in counts])
    train_blocks = blocks(sizes)[F.col("cell")]
    query_blocks = blocks([load.get(c, 0) for c in range(len(centres))])[F.col("cell")]
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = placed.withColumn("tb", F.pmod(F.hash("id"), train_blocks)).withColumn("qb", every(query_blocks))
    right = visits.withColumn("qb", F.pmod(F.hash("query_id"), query_blocks)).withColumn("tb", every(train_blocks))

    def winners(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "neighbor_id", "label", "distance"]
        if rows.empty or asks.empty:
            return pd.DataFrame(columns=columns)
        rows = rows.sort_values("id")
        ids, own = rows["id"].to_numpy(), asks["query_id"].to_numpy()
        at, of, distance = _nearest(own, _matrix(asks["x"]), ids, _matrix(rows["x"]), k, p, exclude_self)
        values = own[at], ids[of], rows["label"].to_numpy()[of], distance
        return pd.DataFrame(dict(zip(columns, values)))

    keys = ["cell", "tb", "qb"]
    label_type = base.schema["label"].dataType.simpleString()
    id_type = base.schema["id"].dataType.simpleString()
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(winners, f"query_id {id_type}, neighbor_id {id_type}, label {label_type}, distance double")
    )
    order = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def knn_classify(neighbors: DataFrame, weights: str = "uniform") -> DataFrame:
    """Majority (or inverse-distance) vote per query; a tie goes to the smaller label."""
    if weights == "distance":
        exact = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy("query_id")) == 1
        weight = F.when(exact, (F.col("distance") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), "distance"))
    elif weights == "uniform":
        weight = F.lit(1.0)
    else:
        raise ValueError("weights is uniform or distance")
    votes = neighbors.withColumn("w", weight).groupBy("query_id", "label").agg(F.sum("w").alias("votes"))
    return votes.groupBy("query_id").agg(
        F.min_by("label", F.struct(-F.col("votes"), F.col("label"))).alias("prediction")
    )
