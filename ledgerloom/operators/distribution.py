"""Densities, histograms, ECDF, box statistics, correlations and line fits."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ordered import by_key, exact_quantiles, join_null_safe, quantile_grid, running
from ledgerloom.runtime import stage


def _silverman(n: Column, sd: Column) -> Column:
    """Bandwidth 1.06 sd n^(-1/5); 1 when the sample has no spread."""
    return F.when((n > 0) & (sd > 0), 1.06 * sd * F.pow(n.cast("double"), F.lit(-0.2))).otherwise(1.0)


def _with_stats(rows: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach one row of `stats` per key, or its only row when there is no key."""
    names = [name for name in stats.columns if name not in keys]
    if keys:
        # few classes: their statistics are looked up in place instead of shuffling the rows on them
        packed = stats.select(F.struct(*keys).alias("__k"), F.struct(*names).alias("__s"))
        own = by_key(packed, "__k", "__s")
        found = rows.withColumn("__k", F.struct(*keys)).withColumn("__s", own)
        return found.select(*rows.columns, *[F.col(f"__s.{n}").alias(n) for n in names])
    packed = stats.select(F.struct(*names).alias("s")).scalar()
    return rows.withColumn("__s", packed).select(*rows.columns, *[F.col(f"__s.{n}").alias(n) for n in names])


def _ends(data: DataFrame, tails: tuple[float, float], keys: Sequence[str] = ()) -> DataFrame:
    """keys, __lo, __hi: the exact quantiles of `v` at both tails."""
    rows = exact_quantiles(data, "v", list(tails), keys, discrete=True)
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("quantile")))
    return rows.groupBy(*keys).agg(at(tails[0]).alias("__lo"), at(tails[1]).alias("__hi"))


# Bins a bandwidth and the highest power summed in them, for one and two dimensions.
FINE_1D, DEGREE_1D = 4, 10
FINE_2D, DEGREE_2D = 16, 6
# Kernels are cut off at so many bandwidths, where they are below 1e-17.
REACH = 9.0


def _hermite(degree: int) -> list[list[float]]:
    """Coefficients, lowest power first, of the Hermite polynomials He_k divided by k!."""
    rows = [[1.0], [0.0, 1.0]]
    for k in range(1, degree):
        shifted, older = [0.0, *rows[-1]], [*rows[-2], 0.0, 0.0]
        rows.append([(a - b) / (k + 1) for a, b in zip(shifted, older)])
    return rows[: degree + 1]


def _sum(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts) if parts else F.lit(0.0)


def _polynomial(coefficients: list[Column], z: Column) -> Column:
    return reduce(lambda acc, c: acc * z + c, reversed(coefficients))


def _bin(value: Column, width: Column) -> tuple[Column, Column]:
    """Number of the bin of `value`, and its distance from the middle of the bin."""
    number = F.floor(value / width)
    return number, value - (number + 0.5) * width


def kde(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    points: int = 256,
    tails: tuple[float, float] = (0.001, 0.999),
) -> DataFrame:
    """Gaussian kernel density on an even grid between two quantiles, per key.

    Rows are summed into bins of a quarter of the bandwidth, as the powers 0 to
    10 of their distance t from the bin's middle in bandwidths. From there the
    kernel of all rows of a bin at a distance z is exp(-z^2 / 2) times the sum of
    He_k(z) / k! times the k-th power sum. With |t| <= 1/8 what the higher powers
    would add is below 1.1 * 8^-11 / sqrt(11!) = 2e-14 of a kernel's height for
    each row. The work is one pass over the rows, and bins times grid points
    within reach.
    """
    data = df.select(*keys, F.col(value).cast("double").alias("v")).filter("v is not null")
    stats = data.groupBy(*keys).agg(
        F.count("*").alias("__n"),
        F.stddev("v").alias("__sd"),
    )
    stats = _with_stats(stats, _ends(data, tails, keys), keys).select(
        *keys, "__n", _silverman(F.col("__n"), F.col("__sd")).alias("__h"), "__lo", "__hi"
    )
    h, low, high = F.col("__h"), F.col("__lo"), F.col("__hi")
    number, offset = _bin(F.col("v"), h / FINE_1D)
    near = (F.col("v") >= low - (REACH + 1) * h) & (F.col("v") <= high + (REACH + 1) * h)
    binned = _with_stats(data, stats, keys).filter(near).select(*keys, number.alias("__bin"), (offset / h).alias("__t"))
    powers = [F.sum(F.lit(1.0) if k == 0 else _sum_power("__t", k)).alias(f"__m{k}") for k in range(DEGREE_1D + 1)]
    sums = binned.groupBy(*keys, "__bin").agg(*powers)
    hermite = _hermite(DEGREE_1D)
    own = [_sum([F.col(f"__m{k}") * row[j] for k, row in enumerate(hermite) if j < len(row) and row[j]]) for j in range(DEGREE_1D + 1)]
    step = (high - low) / (points - 1)
    middle = (F.col("__bin") + 0.5) * h / FINE_1D
    first = F.greatest(F.lit(0).cast("long"), F.coalesce(F.ceil(F.try_divide(middle - REACH * h - low, step)), F.lit(0)))
    last = F.least(F.lit(points - 1).cast("long"), F.coalesce(F.floor(F.try_divide(middle + REACH * h - low, step)), F.lit(points - 1)))
    placed = _with_stats(sums, stats, keys).select(
        *keys, ((low - middle) / h).alias("__z0"), (step / h).alias("__dz"), first.alias("__a"), last.alias("__b"),
        *[c.alias(f"__c{j}") for j, c in enumerate(own)],
    ).filter("__a <= __b")
    z = F.col("__z0") + F.col("__dz") * F.col("i")
    met = placed.withColumn("i", F.explode(F.sequence(F.col("__a").cast("int"), F.col("__b").cast("int")))).withColumn("__z", z)
    kernel = F.exp(-0.5 * F.col("__z") * F.col("__z")) * _polynomial([F.col(f"__c{j}") for j in range(DEGREE_1D + 1)], F.col("__z"))
    mass = met.groupBy(*keys, "i").agg(F.sum(kernel).alias("__mass"))
    grid = stats.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    found = join_null_safe(grid, mass, [*keys, "i"], "left")
    return found.select(
        *keys,
        "i",
        (low + step * F.col("i")).alias("x"),
        (F.coalesce("__mass", F.lit(0.0)) / (F.col("__n") * h * math.sqrt(2 * math.pi))).alias("density"),
    )


def _sum_power(name: str, power: int) -> Column:
    return reduce(lambda a, b: a * b, [F.col(name)] * power) if power else F.lit(1.0)


def kde_2d(
    df: DataFrame, x: str, y: str, keys: Sequence[str], points: int = 16
) -> DataFrame:
    """Joint Gaussian kernel density per key on a points x points grid over the data range.

    As in `kde`, by power sums of both distances up to degree 6 in square bins of
    a sixteenth of the bandwidths; each row's kernel is exact to 1e-11 of its height.
    """
    data = df.select(*keys, F.col(x).cast("double").alias("vx"), F.col(y).cast("double").alias("vy"))
    data = data.filter("vx is not null and vy is not null")
    # Scott's factor for two dimensions
    h = lambda name: F.when(F.stddev(name) > 0, F.stddev(name) * F.pow(F.count("*").cast("double"), F.lit(-1 / 6))).otherwise(1.0)
    stats = data.groupBy(*keys).agg(
        F.count("*").alias("__n"), h("vx").alias("__hx"), h("vy").alias("__hy"),
        F.min("vx").alias("__x0"), F.max("vx").alias("__x1"), F.min("vy").alias("__y0"), F.max("vy").alias("__y1"),
    )
    known = _with_stats(data, stats, keys)
    bx, ox = _bin(F.col("vx"), F.col("__hx") / FINE_2D)
    by, oy = _bin(F.col("vy"), F.col("__hy") / FINE_2D)
    binned = known.select(*keys, bx.alias("__bx"), by.alias("__by"), (ox / F.col("__hx")).alias("__tx"), (oy / F.col("__hy")).alias("__ty"))
    degrees = [(k, m) for k in range(DEGREE_2D + 1) for m in range(DEGREE_2D + 1 - k)]
    sums = binned.groupBy(*keys, "__bx", "__by").agg(
        *[F.sum(_sum_power("__tx", k) * _sum_power("__ty", m)).alias(f"__m{k}_{m}") for k, m in degrees]
    )
    hermite = _hermite(DEGREE_2D)
    has = lambda k, j: j < len(hermite[k]) and hermite[k][j] != 0
    # coefficients of the powers of both distances to a grid point
    own = {
        (i, j): _sum([F.col(f"__m{k}_{m}") * (hermite[k][i] * hermite[m][j]) for k, m in degrees if has(k, i) and has(m, j)])
        for i, j in degrees
    }
    middle = lambda b, h: (F.col(b) + 0.5) * F.col(h) / FINE_2D
    scale = lambda low, high, h: (F.col(high) - F.col(low)) / (points - 1) / F.col(h)
    scaled = _with_stats(sums, stats, keys).select(
        *keys,
        ((F.col("__x0") - middle("__bx", "__hx")) / F.col("__hx")).alias("__zx"),
        ((F.col("__y0") - middle("__by", "__hy")) / F.col("__hy")).alias("__zy"),
        scale("__x0", "__x1", "__hx").alias("__dx"),
        scale("__y0", "__y1", "__hy").alias("__dy"),
        *[c.alias(f"__c{i}_{j}") for (i, j), c in own.items()],
    )
    cell = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points * points - 1).cast("long")))
    placed = scaled.withColumn("cell", cell).withColumns(
        {"i": F.floor(F.col("cell") / points), "j": F.pmod("cell", F.lit(points)).cast("long")}
    )
    placed = placed.withColumns({"__px": F.col("__zx") + F.col("__dx") * F.col("i"), "__py": F.col("__zy") + F.col("__dy") * F.col("j")})
    zx, zy = F.col("__px"), F.col("__py")
    rows = [_polynomial([F.col(f"__c{i}_{j}") for j in range(DEGREE_2D + 1 - i)], zy) for i in range(DEGREE_2D + 1)]
    mass = placed.groupBy(*keys, "i", "j").agg(F.sum(F.exp(-0.5 * (zx * zx + zy * zy)) * _polynomial(rows, zx)).alias("__mass"))
    density = F.col("__mass") / (F.col("__n") * F.col("__hx") * F.col("__hy") * (2 * math.pi))
    return _with_stats(mass, stats, keys).select(*keys, "i", "j", density.alias("density"))


def _bin_number(width: Column, bins: int) -> Column:
    number = F.floor(F.try_divide(F.col("v") - F.col("__lo"), width))
    return F.least(F.coalesce(number, F.lit(0).cast("long")), F.lit(bins - 1).cast("long"))


def histogram(
    df: DataFrame,
    value: str,
    bins: int = 200,
    tails: tuple[float, float] = (0.001, 0.999),
) -> DataFrame:
    """Counts and density in equal bins between two quantiles, empty bins included.

    The last bin is closed; values outside are dropped, as in a fixed-edge histogram.
    Without spread all values are in bin 0 and the density is NULL.
    """
    data = df.select(F.col(value).cast("double").alias("v")).filter("v is not null")
    ends = _ends(data, tails)
    width = (F.col("__hi") - F.col("__lo")) / bins
    inside = _with_stats(data, ends, ()).filter("v between __lo and __hi")
    number = _bin_number(width, bins)
    counts = inside.groupBy(number.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    filled = every.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
    placed = _with_stats(filled, ends, ())
    total = counts.agg(F.sum("n")).scalar()
    return placed.select(
        "bin",
        (F.col("__lo") + width * (F.col("bin") + 0.5)).alias("center"),
        "n",
        F.try_divide(F.col("n"), total * width).alias("density"),
    )


def smooth(bins: DataFrame, column: str = "density", sigma: float = 2.5, half_width: int = 15) -> DataFrame:
    """Gaussian smoothing of binned values; beyond the ends counts as zero."""
    weights = [math.exp(-(offset**2) / (2 * sigma**2)) for offset in range(-half_width, half_width + 1)]
    total = sum(weights)
    taps = F.array(
        *[
            F.struct(F.lit(offset).alias("offset"), F.lit(weight / total).alias("weight"))
            for offset, weight in zip(range(-half_width, half_width + 1), weights)
        ]
    )
    spread = bins.select((F.col("bin")).alias("source"), column, F.inline(taps)).select(
        (F.col("source") + F.col("offset")).alias("bin"), (F.col(column) * F.col("weight")).alias("part")
    )
    return bins.join(spread.groupBy("bin").agg(F.sum("part").alias("smoothed")), "bin")


def class_histogram(df: DataFrame, value: str, key: str, bins: int = 40) -> DataFrame:
    """Equal-width histogram of each class over the common range; all densities together integrate to 1."""
    data = df.select(key, F.col(value).cast("double").alias("v")).filter("v is not null")
    ends = data.agg(F.min("v").alias("__lo"), F.max("v").alias("__hi"), F.count("*").alias("__n"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    number = _bin_number(width, bins)
    counted = _with_stats(data, ends, ()).groupBy(key, number.alias("bin")).agg(
        F.count("*").alias("n"), F.first("__n").alias("__n"), F.first(width).alias("__w")
    )
    return counted.select(key, "bin", "n", F.try_divide(F.col("n"), F.col("__n") * F.col("__w")).alias("density"))


def ecdf(df: DataFrame, value: str) -> DataFrame:
    """Share of rows at or below each distinct value."""
    counts = df.select(F.col(value).alias("value")).filter("value is not null").groupBy("value").agg(F.count("*").alias("n"))
    counts = stage(counts, "ecdf-counts")
    upto = running(counts, [], ["value"], sums={"__upto": "n"})
    return upto.select("value", "n", (F.col("__upto") / counts.agg(F.sum("n")).scalar()).alias("ecdf"))


def ecdf_grid(df: DataFrame, value: str, steps: int = 1000) -> DataFrame:
    """Exact quantiles at 0, 1/steps, ..., 1."""
    return quantile_grid(df, value, steps)


def _pivot_quantiles(rows: DataFrame, keys: Sequence[str], names: dict[float, str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for p, name in names.items()]
    )


def box_stats(df: DataFrame, value: str, key: str) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and outlier count per class."""
    quartiles = _pivot_quantiles(
        exact_quantiles(df, value, [0.25, 0.5, 0.75], [key]),
        [key],
        {0.25: "q25", 0.5: "median", 0.75: "q75"},
    )
    rows = _with_stats(df.select(key, F.col(value).alias("v")).filter("v is not null"), quartiles, [key])
    fence = 1.5 * (F.col("q75") - F.col("q25"))
    inside = (F.col("v") >= F.col("q25") - fence) & (F.col("v") <= F.col("q75") + fence)
    return rows.groupBy(key).agg(
        F.count("*").alias("n"),
        *[F.first(name).alias(name) for name in ("q25", "median", "q75")],
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def class_summary(df: DataFrame, value: str, key: str) -> DataFrame:
    """Per class: n, mean, exact median and quartiles of a value and of its log10."""
    amount = F.col(value)
    data = df.select(key, amount.alias("v"), F.log10(F.when(amount > 0, amount)).alias("lg"))
    means = data.groupBy(key).agg(
        F.count("*").alias("n"), F.avg("v").alias("mean_amount"), F.avg("lg").alias("mean_log_amount")
    )
    quartiles = [0.25, 0.5, 0.75]
    raw = _pivot_quantiles(
        exact_quantiles(data, "v", quartiles, [key]), [key], {0.25: "q25", 0.5: "median_amount", 0.75: "q75"}
    )
    logs = _pivot_quantiles(
        exact_quantiles(data, "lg", quartiles, [key]), [key], {0.25: "log_q25", 0.5: "log_q50", 0.75: "log_q75"}
    )
    return join_null_safe(join_null_safe(means, raw, [key], "left"), logs, [key], "left")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair as rows; NULL where a column is constant.

    Every pair uses the rows where both values are present. Values are centred on
    the column means first, so that plain sums keep their precision.
    """
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("m")).scalar()
    centred = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).withColumn("__m", means)
    centred = centred.select(*[(F.col(c) - F.col("__m")[c]).alias(c) for c in columns])
    cells = []
    for i, a in enumerate(columns):
        for b in columns[i:]:
            x = F.when(F.col(b).isNotNull(), F.col(a))
            y = F.when(F.col(a).isNotNull(), F.col(b))
            n, sx, sy = F.count(x), F.sum(x), F.sum(y)
            vx, vy = F.sum(x * x) - sx * F.try_divide(sx, n), F.sum(y * y) - sy * F.try_divide(sy, n)
            # what is left of a constant column after centring is rounding noise
            noise = n * 1e-20
            r = F.when((vx > noise) & (vy > noise), (F.sum(x * y) - sx * F.try_divide(sy, n)) / F.sqrt(vx * vy))
            cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("corr")))
    half = centred.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b", "corr"))).otherwise(
        F.array(F.struct("a", "b", "corr"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "corr"))
    )
    return half.select(F.inline(both))


def line_fit(df: DataFrame, x: Column, y: Column) -> DataFrame:
    """Least-squares slope, intercept and R² of y on x."""
    points = df.select(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return points.agg(
        F.count("*").alias("n"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r2"),
    )
