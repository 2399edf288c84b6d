"""Running totals, ranks and exact quantiles that stay whole under key skew.

The order is cut by value: a timestamp by its hour, a number or text at 255
splitters of about equal depth, so that far values do not gather the others in
one cut. A window runs inside each (key, cut), and the totals of the earlier
cuts of a key, one row each, are added. So the rows of a hot key are dealt over
its cuts, whatever their number, and the same rows give the same doubles however
they are partitioned. Equal values stay together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.runtime import stage

STEP = 16  # cuts in all: its square
SAMPLE = 1 << 15  # distinct values that splitters are taken from; up to twice as many are drawn
_FEW = (T.BooleanType, T.ByteType)


def _number_of(df: DataFrame, column: str) -> Column:
    """A number that never falls while the column rises: of a text, its first seven bytes."""
    if isinstance(df.schema[column].dataType, T.StringType):
        leading = F.rpad(F.substring(F.hex(F.col(column).cast("binary")), 1, 14), 14, "0")
        return F.conv(leading, 16, 10).cast("long").cast("double")
    return F.col(column).cast("double")


def _below(sorted_values: Column, number: Column) -> Column:
    """How many of the values are below a number."""
    return F.array_position(F.sort_array(F.array_append(sorted_values, number)), number) - 1


def _depth_cut(df: DataFrame, number: Column) -> Column:
    """How many of the splitters are below a number, looked up in two steps.

    The splitters cut a sample of the distinct values evenly. The hash of a value
    decides whether it is in the sample, so the cuts, and with them the order in
    which doubles are added, do not depend on the partitioning. Sample and
    splitters are subqueries of the plan, not jobs of their own.
    """
    values = df.select(number.alias("v")).filter("v is not null")
    one_in = values.agg(F.greatest(F.lit(1).cast("long"), F.floor(F.approx_count_distinct("v") / SAMPLE))).scalar()
    sample = values.filter(F.pmod(F.xxhash64("v"), one_in) == 0).agg(F.array_sort(F.collect_set("v")).alias("v"))
    split = lambda i: F.get("v", F.floor(i * F.size("v") / (STEP * STEP)).cast("int"))
    part = lambda i: F.transform(F.sequence(F.lit(1), F.lit(STEP - 1)), lambda j: split(STEP * i + j))
    coarse = F.transform(F.sequence(F.lit(1), F.lit(STEP - 1)), lambda i: split(STEP * i))
    fine = F.transform(F.sequence(F.lit(0), F.lit(STEP - 1)), part)
    splits = sample.select(F.struct(coarse.alias("coarse"), fine.alias("fine")).alias("s")).scalar()
    first = _below(splits["coarse"], number)
    return F.when(number.isNotNull(), first * STEP + _below(F.get(splits["fine"], first.cast("int")), number))


def _cut(df: DataFrame, column: str) -> Column:
    """A value that never falls while the column rises."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("hour", column)
    if isinstance(kind, (T.NumericType, T.StringType)) and not isinstance(kind, T.ByteType):
        return _depth_cut(df, _number_of(df, column))
    return F.col(column)


def cuts(df: DataFrame, order: Sequence[str]) -> dict[str, Column]:
    """Cuts of the leading order columns; one with few values stands whole and lets the next be cut too."""
    found: dict[str, Column] = {}
    for position, column in enumerate(order):
        found[f"__cut{position}"] = _cut(df, column)
        if not isinstance(df.schema[column].dataType, _FEW):
            break
    return found


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, str] | None = None,
    rank: str | None = None,
) -> DataFrame:
    """Add running sums and/or a 1-based rank per key, in ascending `order`.

    `sums` maps a new column to the column it accumulates. `order` has to be
    unique inside a key for the result to be determined.
    """
    sums = dict(sums or {})
    parts = cuts(df, order)
    names = list(parts)
    inside = Window.partitionBy(*keys, *names).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumns(parts).withColumns(
        {"__nth": F.row_number().over(inside).cast("long")}
        | {f"__in_{name}": F.sum(source).over(so_far) for name, source in sums.items()}
    )
    # the last row of a cut has its totals, summed in the order of the rows
    totals = local.groupBy(*keys, *names).agg(
        F.max("__nth").alias("__t_rank"), *[F.max_by(f"__in_{name}", "__nth").alias(f"__t_{name}") for name in sums]
    )
    earlier = Window.partitionBy(*keys).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *keys,
        *names,
        F.sum("__t_rank").over(earlier).alias("__c_rank"),
        *[F.sum(f"__t_{name}").over(earlier).alias(f"__c_{name}") for name in sums],
    )
    own = lambda name: F.col(f"__in_{name}")
    before = lambda name: F.col(f"__c_{name}")
    shifted = {
        name: F.when(before(name).isNull(), own(name)).when(own(name).isNull(), before(name)).otherwise(before(name) + own(name))
        for name in sums
    }
    if rank:
        shifted[rank] = F.coalesce("__c_rank", F.lit(0)) + F.col("__nth")
    joined = join_null_safe(local, carry, [*keys, *names], "left")
    return joined.withColumns(shifted).select(*df.columns, *sums, *([rank] if rank else []))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on same-named keys where NULL matches NULL; the left keys are kept."""
    renamed = right.withColumnsRenamed({key: f"__r_{key}" for key in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__r_{key}"))
    return left.join(renamed, same, how).drop(*[f"__r_{key}" for key in keys])


def by_key(table: DataFrame, key: str, value: str) -> Column:
    """The value of `table` for the key of a row, NULL for NULL, looked up in place.

    The table travels as one map inside the plan, so it suits keys with few
    values: the rows themselves are not shuffled on them.
    """
    pair = F.struct(F.struct(F.col(key).alias("k")), F.col(value))
    return F.try_element_at(table.agg(F.map_from_entries(F.collect_list(pair))).scalar(), F.struct(F.col(key).alias("k")))


def counted(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, __v, __n, __upto, __all: distinct values as doubles, their rows, rows up to them, rows of the key."""
    data = df.select(*keys, F.col(value).cast("double").alias("__v")).filter("__v is not null")
    # written once: splitters, ranks and totals all read the counts
    counts = stage(data.groupBy(*keys, "__v").agg(F.count("*").alias("__n")), "value-counts")
    ranked = running(counts, keys, ["__v"], sums={"__upto": "__n"})
    if keys:
        totals = counts.groupBy(*keys).agg(F.sum("__n").alias("__all")).select(F.struct(*keys).alias("__k"), "__all")
        return ranked.withColumn("__k", F.struct(*keys)).withColumn("__all", by_key(totals, "__k", "__all")).drop("__k")
    return ranked.withColumn("__all", counts.agg(F.sum("__n")).scalar())


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (), discrete: bool = False
) -> DataFrame:
    """Quantiles per key as rows (keys, prob, quantile), interpolated or (`discrete`) a value that occurs."""
    rows = counted(df, value, keys)
    first, last, size = F.col("__upto") - F.col("__n"), F.col("__upto"), F.col("__all")
    grid = F.array(*[F.lit(float(p)) for p in probs])

    def covers(rank: Column) -> Column:
        return (rank >= first) & (rank < last)

    def spot(prob: Column) -> Column:
        return F.greatest(F.ceil(prob * size) - 1, F.lit(0)).cast("double") if discrete else prob * (size - 1)

    touched = F.filter(grid, lambda p: covers(F.floor(spot(p))) | covers(F.ceil(spot(p))))
    at = spot(F.col("prob"))
    return (
        rows.withColumn("prob", F.explode(touched))
        .groupBy(*keys, "prob", at.alias("__spot"))
        .agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        .select(
            *keys,
            "prob",
            (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * (F.col("__spot") - F.floor("__spot"))).alias("quantile"),
        )
    )


def quantile_grid(df: DataFrame, value: str, steps: int) -> DataFrame:
    """prob, quantile at 0, 1/steps, .., 1: values that occur. A row meets only the probabilities it covers."""
    rows = counted(df, value)
    low = F.floor(steps * (F.col("__upto") - F.col("__n")) / F.col("__all"))
    high = F.ceil(steps * F.col("__upto") / F.col("__all"))
    near = F.sequence(F.greatest(low - 1, F.lit(0)), F.least(high + 1, F.lit(steps)))
    probs = rows.withColumn("step", F.explode(near)).withColumn("prob", F.col("step") / F.lit(float(steps)))
    rank = F.greatest(F.ceil(F.col("prob") * F.col("__all")) - 1, F.lit(0))
    return probs.filter((rank >= F.col("__upto") - F.col("__n")) & (rank < F.col("__upto"))).select(
        "prob", F.col("__v").alias("quantile")
    )
