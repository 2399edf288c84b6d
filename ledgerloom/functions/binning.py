"""Left-closed binning and its dummy columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import snake_names

# Edges and labels of the two binned columns.
AGE_EDGES = [0, 3, 12, 18, 35, 60, math.inf]
AGE_LABELS = ["Toddler", "Child", "Teenager", "Young Adult", "Adult", "Senior"]
FARE_EDGES = [0, 8, 15, 31, math.inf]
FARE_LABELS = ["Very Low", "Low", "Medium", "High"]


def cut(column: str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin [edge, next edge) holding the value; NULL outside all bins."""
    value = F.col(column)
    label = F.lit(None).cast("string")
    for low, high, name in zip(edges, edges[1:], labels):
        inside = value >= low
        if math.isfinite(high):
            inside = inside & (value < high)
        label = F.when(inside, name).otherwise(label)
    return label


def dummies(column: Column, values: Sequence, prefix: str, skip: int = 0) -> dict[str, Column]:
    """One 0/1 integer column per listed value, without the first `skip`; names that come out alike are numbered."""
    names = snake_names([str(value) for value in values])
    return {
        f"{prefix}_{name}": F.coalesce((column == F.lit(value)).cast("int"), F.lit(0))
        for name, value in list(zip(names, values))[skip:]
    }
