"""Reproducible pseudo-random columns.

`rand(seed)` depends on how rows are partitioned; these depend on the id only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The multiplier, increment and modulus of a linear congruence.
MULTIPLIER = 1103515245
INCREMENT = 12345
MODULUS = 2147483648


def scramble(key: Column | str) -> Column:
    """Pseudo-random long in [0, MODULUS). Reducing first avoids overflow."""
    column = F.col(key) if isinstance(key, str) else key
    small = F.pmod(column.cast("long"), F.lit(MODULUS).cast("long"))
    return F.pmod(small * F.lit(MULTIPLIER).cast("long") + F.lit(INCREMENT), F.lit(MODULUS).cast("long"))


def uniform(key: Column | str) -> Column:
    """Pseudo-random double in [0, 1)."""
    return scramble(key) / F.lit(float(MODULUS))


def bernoulli(key: Column | str, probability: float) -> Column:
    return uniform(key) < F.lit(float(probability))


def hash_bucket(key: str, buckets: int) -> Column:
    """Bucket number in [0, buckets) from Spark's hash of `key`; never negative."""
    return F.pmod(F.hash(F.col(key)), F.lit(buckets))
