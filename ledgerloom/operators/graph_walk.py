"""Set-based graph expansion: one plan for all seeds, one join per hop.

A hop joins the frontier, a table of its own, with the raw edges and folds what
it meets, so edges away from the frontier are read but never shuffled for
grouping. Every layer is written once and read from there.

Breadth-first search keeps one row a node with a bit for every seed that reaches
it; a hop joins nodes with edges and ORs the bits, partly before the shuffle, so
rows are nodes and not pairs of seed and node.

Trails need to know which edges were used. Their states are (seed, node) with a
few witnesses, sets of used edges that between them decide every extension.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.hashing import scramble
from ledgerloom.operators.distribution import line_fit
from ledgerloom.runtime import stage

# Trails of up to this many hops are decided by the least and the largest witness.
WITNESS_HOPS = 3
# Longs in a row of seed bits: 1,024 seeds share a row.
WORDS = 16


def ends(edges: DataFrame, direction: str = "OUT") -> DataFrame:
    """(u, v) for every edge: one can go from u to v."""
    pairs = edges.select("src", "dst")
    if direction == "IN":
        pairs = pairs.select(F.col("dst").alias("u"), F.col("src").alias("v"))
    elif direction == "BOTH":
        there = F.struct(F.col("src").alias("u"), F.col("dst").alias("v"))
        back = F.struct(F.col("dst").alias("u"), F.col("src").alias("v"))
        both = F.when(F.col("src") == F.col("dst"), F.array(there)).otherwise(F.array(there, back))
        pairs = pairs.select(F.inline(both))
    elif direction == "OUT":
        pairs = pairs.toDF("u", "v")
    else:
        raise ValueError("direction is OUT, IN or BOTH")
    return pairs.filter("u is not null and v is not null")


def expand(frontier: DataFrame, at: str, pairs: DataFrame, to: str, times: str) -> DataFrame:
    """`frontier` with one more step from node `at` to node `to`, taken over `times` different edges."""
    met = frontier.join(pairs, F.col(at) == F.col("u")).withColumnRenamed("v", to)
    return met.groupBy(*frontier.columns, to).agg(F.count("*").alias(times))


def of_type(edges: DataFrame, column: str, kinds: list | None = None) -> DataFrame:
    """Edges restricted to the listed relation types; all of them without a list."""
    return edges if not kinds else edges.filter(F.col(column).isin(list(kinds)))


def _same(direction: str, u1, v1, u2, v2) -> Column:
    """Whether two steps use the same folded edge."""
    along = (F.col(u1) == F.col(u2)) & (F.col(v1) == F.col(v2))
    if direction == "BOTH":
        along = along | ((F.col(u1) == F.col(v2)) & (F.col(v1) == F.col(u2)))
    return along


def trail_frontiers(edges: DataFrame, seeds: DataFrame, hops: int, direction: str = "OUT") -> list[DataFrame]:
    """End points (seed_id, node) of trails of exactly 1, 2, ..., `hops` edges.

    A trail repeats no edge but may revisit nodes, the seed included. A walk is a
    trail exactly when it takes no folded edge more often than its multiplicity.
    """
    if hops > WITNESS_HOPS:
        return _witnessed_trails(edges, seeds, hops, direction)
    pairs = ends(edges, direction)
    start = seeds.select(F.col(seeds.columns[0]).alias("seed_id")).distinct()
    first = stage(expand(start, "seed_id", pairs, "a", "m1"), "trail-1")
    result = [first.select("seed_id", F.col("a").alias("node"))]
    if hops >= 2:
        second = (
            expand(first.select("seed_id", "a"), "a", pairs, "b", "m2")
            .filter(~_same(direction, "seed_id", "a", "a", "b") | (F.col("m2") >= 2))
            .groupBy("seed_id", "b")
            .agg(
                F.count("*").alias("ways"),
                F.min("a").alias("a_lo"),
                F.max("a").alias("a_hi"),
            )
        )
        second = stage(second, "trail-2")
        result.append(second.select("seed_id", F.col("b").alias("node")))
    if hops >= 3:
        third = expand(second, "b", pairs, "c", "m3")
        # A way through a can only clash with the step (b, c) if a is b or c. So of
        # three ways one always fits, and of two the smallest and largest are all.
        fits = lambda a: (
            1 + _same(direction, "b", "c", "seed_id", a).cast("int") + _same(direction, "b", "c", a, "b").cast("int")
            <= F.col("m3")
        )
        open_ = third.filter((F.col("ways") >= 3) | fits("a_lo") | fits("a_hi"))
        result.append(stage(open_.select("seed_id", F.col("c").alias("node")).distinct(), "trail-3"))
    return result


def _copies(used: Column) -> Column:
    """The members of a sorted list of used edges, numbered among equal ones from 1."""
    return F.transform(
        used,
        lambda edge, at: F.struct(edge.alias("edge"), F.size(F.filter(F.slice(used, 1, at + 1), lambda other: other == edge)).alias("nth")),
    )


def _avoids(used: Column, barred: Column) -> Column:
    """Whether a list of used edges has fewer than `nth` uses of each barred edge."""
    return F.forall(barred, lambda bar: F.size(F.filter(used, lambda edge: edge == bar["edge"])) < bar["nth"])


def witnesses(states: DataFrame, steps: int) -> DataFrame:
    """Some of the used-edge lists of each (seed_id, node) that decide whether `steps` more edges can follow.

    The least list is taken. A continuation that it forbids uses one of its
    edges too often, so for each of its edges the least list without it (without
    its second use, and so on) is taken too, for one step less, and so forth.
    Lists of p edges give at most 1 + p + ... + p^steps witnesses, however many
    ways lead to the node; every one is a minimum, combined before the shuffle.
    """
    key = ["seed_id", "node"]
    states = stage(states, "trail-states")
    first = states.groupBy(*key).agg(F.min("used").alias("used"), F.max("used").alias("last"))
    first = stage(first, "trail-witnesses")
    several = first.filter("used <> last")
    rest = states.join(several.select(*key), key, "left_semi")
    barred = F.array().cast("array<struct<edge:" + states.schema["used"].dataType.elementType.simpleString() + ",nth:int>>")
    level = several.select(*key, "used", barred.alias("barred"))
    found = first.select(*key, "used")
    for _ in range(steps):
        bars = level.select(*key, "barred", F.explode(_copies(F.col("used"))).alias("bar"))
        bars = bars.select(*key, F.array_sort(F.array_append("barred", F.col("bar"))).alias("barred")).distinct()
        level = rest.join(bars, key).filter(_avoids(F.col("used"), F.col("barred")))
        level = stage(level.groupBy(*key, "barred").agg(F.min("used").alias("used")), "trail-witnesses")
        found = found.unionByName(level.select(*key, "used"))
    return found.distinct()


def _witnessed_trails(edges: DataFrame, seeds: DataFrame, hops: int, direction: str) -> list[DataFrame]:
    """Trails of any length by witnesses. Node ids may be of any type."""
    pairs = ends(edges, direction)
    names = ("node", "v")
    if direction == "BOTH":  # an edge is the same one on the way back
        edge = F.struct(F.least(*names).alias("x"), F.greatest(*names).alias("y"))
    else:
        edge = F.struct(F.col("node").alias("x"), F.col("v").alias("y"))
    seed = F.col(seeds.columns[0])
    kind = seeds.schema[0].dataType.simpleString()
    used = F.array().cast(f"array<struct<x:{kind},y:{kind}>>")
    states = seeds.select(seed.alias("seed_id"), seed.alias("node"), used.alias("used")).distinct()
    result = []
    for hop in range(1, hops + 1):
        here = states.select("node").distinct()
        step = pairs.join(here, F.col("u") == F.col("node"), "left_semi").groupBy("u", "v").agg(F.count("*").alias("m"))
        walked = states.join(step, F.col("node") == F.col("u")).withColumn("edge", edge)
        open_ = walked.filter(F.size(F.filter("used", lambda old: old == F.col("edge"))) < F.col("m"))
        if hop == hops:
            states = stage(open_.select("seed_id", F.col("v").alias("node")).distinct(), "trail-states")
        else:
            grown = open_.select("seed_id", F.col("v").alias("node"), F.array_sort(F.array_append("used", F.col("edge"))).alias("used"))
            states = stage(witnesses(grown.distinct(), hops - hop), "trail-layer")
        result.append(states.select("seed_id", "node").distinct())
    return result


def _words(value) -> list[Column]:
    return [value(k).alias(f"w{k}") for k in range(WORDS)]


def seed_bits(seeds: DataFrame) -> DataFrame:
    """seed_id with block and slot: every distinct seed has one of the 64 * WORDS bits of a row of its block."""
    start = seeds.select(F.col(seeds.columns[0]).alias("seed_id")).filter("seed_id is not null").distinct()
    numbered = stage(start.coalesce(8).withColumn("at", F.monotonically_increasing_id()), "bfs-seeds")
    bits = 64 * WORDS
    return numbered.select("seed_id", F.floor(F.col("at") / bits).alias("block"), (F.col("at") % bits).cast("int").alias("slot"))


def bit_layers(edges: DataFrame, slots: DataFrame, hops: int, direction: str = "OUT") -> list[DataFrame]:
    """For each hop block, node and w0, w1, ...: the bits of the seeds that first reach the node by so many hops."""
    pairs = ends(edges, direction)
    bit = F.expr("shiftleft(1L, slot % 64)")
    layer = slots.select("block", F.col("seed_id").alias("node"), *_words(lambda k: F.when(F.floor(F.col("slot") / 64) == k, bit).otherwise(F.lit(0).cast("long"))))
    layers = [layer]
    for _ in range(hops):
        met = layers[-1].join(pairs, F.col("node") == F.col("u")).groupBy("block", "v").agg(*_words(lambda k: F.bit_or(f"w{k}")))
        visited = reduce(DataFrame.unionByName, layers).groupBy("block", "node").agg(*_words(lambda k: F.bit_or(f"w{k}")))
        visited = visited.select(F.col("block").alias("b"), F.col("node").alias("n"), *[F.col(f"w{k}").alias(f"old{k}") for k in range(WORDS)])
        fresh = met.join(visited, (F.col("block") == F.col("b")) & (F.col("v") == F.col("n")), "left").select(
            "block", F.col("v").alias("node"), *_words(lambda k: F.col(f"w{k}").bitwiseAND(F.bitwise_not(F.coalesce(f"old{k}", F.lit(0).cast("long")))))
        )
        some = reduce(Column.bitwiseOR, [F.col(f"w{k}") for k in range(WORDS)]) != 0
        layers.append(stage(fresh.filter(some), "bfs-layer"))
    return layers[1:]


def reached(layer: DataFrame) -> DataFrame:
    """block, slot, node: a row for every bit of a layer."""
    words = layer.select("block", "node", F.posexplode(F.array(*[F.col(f"w{k}") for k in range(WORDS)])).alias("k", "word")).filter("word <> 0")
    places = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(F.col("word"), i) == 1)
    return words.select("block", "node", "k", F.explode(places).alias("i")).select("block", (F.col("k") * 64 + F.col("i")).alias("slot"), "node")


def bfs_frontiers(edges: DataFrame, seeds: DataFrame, hops: int, direction: str = "OUT") -> DataFrame:
    """(seed_id, node, hop): nodes by shortest distance 1..hops from each seed."""
    slots = seed_bits(seeds)
    layers = [reached(layer).withColumn("hop", F.lit(hop)) for hop, layer in enumerate(bit_layers(edges, slots, hops, direction), start=1)]
    return reduce(DataFrame.unionByName, layers).join(slots, ["block", "slot"]).select("seed_id", "node", "hop")


def bfs_sizes(edges: DataFrame, seeds: DataFrame, hops: int, direction: str = "OUT") -> DataFrame:
    """(seed_id, hop, frontier_size) for every seed and hop, 0 included.

    Bits are counted where the layer is read; a task sends on one row a seed.
    """
    slots = seed_bits(seeds)
    counts = [
        reached(layer).groupBy("block", "slot").agg(F.count("*").alias("frontier_size")).withColumn("hop", F.lit(hop))
        for hop, layer in enumerate(bit_layers(edges, slots, hops, direction), start=1)
    ]
    every = slots.withColumn("hop", F.explode(F.sequence(F.lit(1), F.lit(hops))))
    found = every.join(reduce(DataFrame.unionByName, counts), ["block", "slot", "hop"], "left")
    return found.select("seed_id", "hop", F.coalesce("frontier_size", F.lit(0)).alias("frontier_size"))


def among(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges between the given nodes, such as those of a label."""
    own = nodes.select(F.col(nodes.columns[0]).alias("own")).distinct()
    return edges.join(own, F.col("src") == F.col("own"), "left_semi").join(own, F.col("dst") == F.col("own"), "left_semi")


def out_degree(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Outgoing edges per seed, parallel edges counted, 0 where there is none."""
    name = seeds.columns[0]
    own = edges.join(seeds.select(F.col(name).alias("src")), "src", "left_semi")
    counts = own.groupBy(F.col("src").alias(name)).agg(F.count("*").alias("deg_out"))
    return seeds.join(counts, name, "left").select(name, F.coalesce("deg_out", F.lit(0)).alias("deg_out"))


def frontier_sizes(frontier: DataFrame, seeds: DataFrame) -> DataFrame:
    """(seed_id, frontier_size) with 0 for a seed that reaches nothing."""
    start = seeds.select(F.col(seeds.columns[0]).alias("seed_id"))
    counts = frontier.groupBy("seed_id").agg(F.count("*").alias("frontier_size"))
    return start.join(counts, "seed_id", "left").withColumn("frontier_size", F.coalesce("frontier_size", F.lit(0)))


def neighbor_explosion(edges: DataFrame, seeds: DataFrame, hops: int = 3, direction: str = "OUT") -> DataFrame:
    """Frontier size per seed and hop next to the seed's out-degree."""
    start = seeds.select(F.col(seeds.columns[0]).alias("seed_id"))
    layers = [
        frontier.withColumn("hop", F.lit(hop))
        for hop, frontier in enumerate(trail_frontiers(edges, seeds, hops, direction), start=1)
    ]
    counts = reduce(DataFrame.unionByName, layers).groupBy("seed_id", "hop").agg(F.count("*").alias("frontier_size"))
    every = start.withColumn("hop", F.explode(F.sequence(F.lit(1), F.lit(hops))))
    degrees = out_degree(edges, start).withColumnRenamed("deg_out", "deg_out_seed")
    return (
        every.join(counts, ["seed_id", "hop"], "left")
        .join(degrees, "seed_id")
        .select(
            "seed_id",
            "hop",
            F.coalesce("frontier_size", F.lit(0)).alias("frontier_size"),
            "deg_out_seed",
            F.lit(direction).alias("direction"),
        )
    )


def frontier_summary(explosion: DataFrame) -> DataFrame:
    """Distribution of frontier sizes per hop over the seeds."""
    size = F.col("frontier_size")
    return explosion.groupBy("hop").agg(
        F.count("*").alias("count"),
        F.avg(size).alias("mean"),
        F.expr("percentile(frontier_size, array(0.25, 0.5, 0.75))").alias("q"),
        F.stddev(size).alias("std"),
        F.min(size).alias("min"),
        F.max(size).alias("max"),
    ).select(
        "hop", "count", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q75"), "max",
    )


def branching_by_degree(explosion: DataFrame) -> DataFrame:
    """Fit log N = log a + b * hop * log(out-degree) over seeds with out-degree > 0."""
    usable = explosion.filter("deg_out_seed > 0")
    fit = line_fit(usable, F.col("hop") * F.ln("deg_out_seed"), _log_size())
    return fit.select("n", F.exp("intercept").alias("a_hat"), F.col("slope").alias("b_hat"), "r2")


def branching_by_hop(explosion: DataFrame) -> DataFrame:
    """Fit log N = log alpha + hop * log m."""
    fit = line_fit(explosion, F.col("hop"), _log_size())
    return fit.select("n", F.exp("intercept").alias("alpha_hat"), F.exp("slope").alias("m_hat"), "r2")


def _log_size() -> Column:
    return F.ln(F.greatest(F.col("frontier_size").cast("double"), F.lit(1.0)))


def size_biased_branching(edges: DataFrame, seeds: DataFrame, per_seed: int = 5, direction: str = "OUT") -> DataFrame:
    """Mean out-degree of up to `per_seed` scrambled distinct neighbours of each seed."""
    start = seeds.select(F.col(seeds.columns[0]).alias("seed_id"))
    near = expand(start, "seed_id", ends(edges, direction), "node", "times")
    order = Window.partitionBy("seed_id").orderBy(scramble("node"), "node")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_seed)
    picked = stage(ranked.select("seed_id", "node"), "branching-picked")
    met = edges.join(picked.select(F.col("node").alias("src")).distinct(), "src", "left_semi")
    degrees = met.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("deg"))
    return picked.join(degrees, "node", "left").agg(
        F.count("*").alias("n_sampled"), F.avg(F.coalesce("deg", F.lit(0))).alias("m_size_biased")
    )
