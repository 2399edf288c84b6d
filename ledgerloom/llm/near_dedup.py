"""Near duplicates by SetSketch registers, banded, estimated jointly and verified.

A register holds the exponent of a truncated minimum: over a document's shingles,
the smallest of exponential variables, rounded to a power of `BASE`. Registers of
a union are the maxima of the parts' registers. Every shingle visits the
registers in an order of its own with growing values, so most shingles stop
after a few steps.

`ROWS` registers make a band; documents that agree in one of `BANDS` bands are
candidates. With collision probability of at least J for a register, a pair at
J = 0.8 is missed with probability (1 - 0.8^7)^56 = 2e-6, and less above.
Candidates whose registers make J >= 0.8 implausible are let go; the bound of the
likelihood ratio, and of the share of equal registers, is set so that a pair at
the threshold is lost with a probability of `MISSED`. The rest is confirmed on
the full shingle sets.

Documents with equal sets are one class and are tested once. Of a band's group
not all pairs are tested: first each document with the least document it meets,
then the pairs that are a group of their own. What is then left of different
components in larger groups is compared and verified within tasks, in blocks of
similar size; a task gives only the links that join two components. What is
connected needs no test, so a large group of copies costs a few tests for each
member, and no link between components is lost.

Defined cases: a null or empty text has an empty set and is linked with nothing;
fewer words than a shingle make one shingle of the whole sequence; a row with a
null doc_id is linked with nothing, has a null component and is kept; identical
repeated rows share their result; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from itertools import chain
from math import gcd, sqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import as_bytes, documents, pieces, stage, texts
from ledgerloom.llm.components import components
from ledgerloom.runtime import unstage
from ledgerloom.llm.substring_dedup import WordHashes, mixed

BASE = 1.2
ROWS, BANDS = 7, 56
REGISTERS = ROWS * BANDS
RATE = 20.0  # keeps the registers of one-shingle sets above 0
TOP = 255
BATCH_BYTES = 4 << 20
MISSED = 1e-6  # how often a pair at the threshold may look too unlike to be verified
SIGMAS = NormalDist().inv_cdf(1 - MISSED)
UNLIKELY = SIGMAS**2 / 2  # the log-likelihood ratio that a normal deviate of SIGMAS gives
BLOCK = 2048  # members of a group that one task compares with as many others
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
STRIDES = np.array([s for s in range(1, REGISTERS) if gcd(s, REGISTERS) == 1], np.int64)


def shingle_sets(batch_texts: list[bytes], known: WordHashes, size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word shingles."""
    split = [text.lower().split() for text in batch_texts]
    count = [len(w) for w in split]
    flat = known.flat(split, sum(count))
    out, at = [], 0
    for n in count:
        words = flat[at : at + n]
        at += n
        if not n:
            out.append(words)
            continue
        width = min(n, size)
        h = np.full(n - width + 1, width, np.uint64)
        for i in range(width):
            h = mixed(h + words[i : i + len(h)]) * GOLDEN
        out.append(np.unique(h))
    return out


def registers(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """A row of `m` registers (0..255) for each set."""
    n = len(sets)
    least = np.full(n * m, np.inf)
    h = np.fromiter(chain.from_iterable(s.tolist() for s in sets), np.uint64, sum(map(len, sets)))
    own = np.repeat(np.arange(n), [len(s) for s in sets])
    at = (h % np.uint64(m)).astype(np.int64)
    stride = STRIDES[((h >> np.uint64(32)) % np.uint64(len(STRIDES))).astype(np.int64)]
    x, seed = np.zeros(len(h)), h
    for step in range(m):
        seed = mixed(seed + GOLDEN)
        u = ((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        x = x - np.log(u) / (m - step)
        np.minimum.at(least, own * m + at, x)
        if step < 16 or step % 16 == 0:
            # a value above every register of its document cannot lower one any more
            live = x < least.reshape(n, m).max(1)[own]
            if not live.any():
                break
            own, at, stride, x, seed = own[live], at[live], stride[live], x[live], seed[live]
        at = (at + stride) % m
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(least / RATE) / np.log(BASE))
    return np.clip(np.nan_to_num(level, neginf=0), 0, TOP).astype(np.uint8).reshape(n, m)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def log_likelihoods(up, down, same, n_a, n_b, similarity):
    """Log-likelihood of Jaccard similarities (last axis) given the register comparisons and set sizes."""
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    more, less = p(u - v * similarity), p(v - u * similarity)
    tiny = 1e-12
    return (
        up[:, None] * np.log(more + tiny)
        + down[:, None] * np.log(less + tiny)
        + same[:, None] * np.log(np.maximum(1 - more - less, tiny))
    )


def plausible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether a similarity of `percent` or more is likely enough to be verified."""
    up, down = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - up - down
    bound = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    grid = np.linspace(0, 1, 101)
    fits = log_likelihoods(up, down, same, n_a, n_b, np.minimum(grid, bound[:, None]))
    best = fits.max(1)
    above = np.where(grid >= percent / 100 - 1e-9, fits, -np.inf).max(1)
    return (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)) & (above >= best - UNLIKELY)


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (128 bits that name the set) and registers of every row."""

    def run(batches):
        known = WordHashes()
        for batch in pieces(batches, "text", BATCH_BYTES):
            sets = shingle_sets(batch.column("text").to_pylist(), known, size)
            regs = registers(sets)
            with np.errstate(over="ignore"):
                a = [int(np.add.reduce(mixed(s + GOLDEN)).view(np.int64)) for s in sets]
                b = [int(np.add.reduce(mixed(s * GOLDEN)).view(np.int64)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(a, pa.int64()),
                    pa.array(b, pa.int64()),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "registers"],
            )

    return docs.select("doc_id", as_bytes()).mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, registers binary"
    )


def groups_of_bands(reps: DataFrame) -> DataFrame:
    """spot, band, rep, n_shingles, low, two: documents that agree in a band with another document; `spot` names the band and its registers."""
    cut = F.array(*[F.substring("registers", i * ROWS + 1, ROWS) for i in range(BANDS)])
    bands = reps.select("rep", "n_shingles", F.posexplode(cut).alias("band", "own"))
    bands = bands.select(F.xxhash64("band", "own").alias("spot"), "band", "rep", "n_shingles")
    least, two = F.min("rep").alias("low"), (F.count("*") == 2).alias("two")
    shared = bands.groupBy("spot").agg(least, F.max("rep").alias("high"), two).where("low < high")
    shared = shared.select(F.col("spot").alias("s_spot"), "low", "two")
    return bands.join(shared, F.col("spot") == F.col("s_spot")).select("spot", "band", "rep", "n_shingles", "low", "two")


def close_pairs(table: pa.Table, percent: int):
    """(x, y, likelihood order) of the rows of a block to be verified in it, the closest first.

    These are pairs of a row of the few and one of all, of different components,
    with plausible registers, that have no earlier band in common: a pair is
    looked at in one of its groups only.
    """
    few, all_, rep = (table.column(c).to_numpy() for c in ("few", "all", "rep"))
    component, band = table.column("component").to_numpy(), table.column("band").to_numpy()
    n = table.column("n_shingles").to_numpy().astype(float)
    regs = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint8).reshape(len(rep), -1)
    least_same = percent / 100 - SIGMAS * sqrt(percent / 100 * (1 - percent / 100) / regs.shape[1])
    x, found = np.flatnonzero(all_), []
    for y in np.flatnonzero(few):
        once = ~few[x] | (x < y) if all_[y] else True  # not both ways round
        close = x[once & (component[x] != component[y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))]
        equal = regs[close] == regs[y]
        same = equal.mean(1)
        fits = same >= least_same
        # registers of earlier bands; a whole band of equal ones is handled there
        earlier = equal[fits, : band[y] * ROWS].reshape(int(fits.sum()), int(band[y]), ROWS).all(2).any(1)
        close, same = close[fits][~earlier], same[fits][~earlier]
        if len(close):
            fits = plausible(regs[close], regs[[y]], n[close], n[[y]], percent)
            found += zip(same[fits].tolist(), close[fits].tolist(), [int(y)] * int(fits.sum()))
    return sorted(found, key=lambda f: (-f[0], rep[f[1]], rep[f[2]]))


def is_linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


class Tester:
    """Confirms pairs (a, b) of class representatives and remembers their components."""

    def __init__(self, docs: DataFrame, reps: DataFrame, members: DataFrame, size: int, percent: int):
        self.percent, self.links, self.labels = percent, None, None
        ids = members.select("rep").distinct()
        self.reps = stage(reps.join(ids, "rep", "left_semi"), "near-registers")
        own = docs.join(ids, docs["doc_id"] == ids["rep"], "left_semi").select("doc_id", as_bytes())

        def run(batches):
            known = WordHashes()
            for batch in pieces(batches, "text", BATCH_BYTES):
                sets = shingle_sets(batch.column("text").to_pylist(), known, size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "shingles"]
                )

        self.sets = stage(own.mapInArrow(run, "rep long, shingles binary"), "near-sets")

    def likely(self, pairs: DataFrame) -> DataFrame:
        def side(name):
            return self.reps.select(*[F.col(c).alias(f"{name}_{c}") for c in ("rep", "n_shingles", "registers")])

        percent = self.percent

        def run(batches):
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                a, b = (
                    np.frombuffer(b"".join(batch.column(f"{s}_registers").to_pylist()), np.uint8).reshape(n, -1) for s in "ab"
                )
                n_a, n_b = (batch.column(f"{s}_n_shingles").to_numpy().astype(float) for s in "ab")
                ok = pa.array(plausible(a, b, n_a, n_b, percent))
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["a", "b"])

        both = pairs.join(side("a"), F.col("a") == F.col("a_rep")).join(side("b"), F.col("b") == F.col("b_rep"))
        return both.drop("a_rep", "b_rep").mapInArrow(run, "a long, b long").distinct()

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        percent = self.percent

        def run(batches):
            for batch in pieces(batches, "b_set", BATCH_BYTES):
                ok = []
                for a, b in zip(batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist()):
                    ok.append(is_linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent))
                ok = pa.array(ok, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["u", "v"])

        def side(name):
            return self.sets.select(F.col("rep").alias(f"{name}_rep"), F.col("shingles").alias(f"{name}_set"))

        both = pairs.join(side("a"), F.col("a") == F.col("a_rep")).join(side("b"), F.col("b") == F.col("b_rep"))
        return both.drop("a_rep", "b_rep").mapInArrow(run, "u long, v long").distinct()

    def dealt(self, members: DataFrame) -> DataFrame:
        """`members` of groups with several components, dealt to blocks of a task each.

        Most members of a large group are in one component, the main one, and
        need no tests among themselves. The others, the few, meet all members.
        A document can be linked with documents of 0.8 to 1.25 times its size
        only, so a group falls apart into classes of size first. A row may stand
        for a document of the few, of all, or both.
        """
        counts = members.groupBy("spot", "component").agg(F.count("*").alias("n"))
        size = F.max(F.struct("n", "component"))
        groups = counts.groupBy("spot").agg(size.alias("main"), F.count("*").alias("parts")).where("parts > 1")
        groups = groups.select(F.col("spot").alias("g_spot"), F.col("main.component").alias("main"))
        # steps as wide as the allowed ratio of sizes; a class has two of them, so that a pair stands in
        # one class, or in two that follow each other, in the halves that touch
        half = F.floor(F.log("n_shingles") / F.lit(np.log(100 / self.percent)) * F.lit(1 - 1e-9)).cast("int")
        rows = members.join(groups, F.col("spot") == F.col("g_spot")).select(*members.columns, (F.col("component") != F.col("main")).alias("other"), half.alias("half"))
        size = F.floor(F.col("half") / 2).cast("int")
        touching = size + F.when(F.pmod("half", F.lit(2)) == 1, 1).otherwise(-1)
        rows = stage(rows.select(*members.columns, "other", size.alias("size"), touching.alias("touching")), "near-mixed")
        none = F.lit(0).cast("long")
        own = rows.groupBy("spot", F.col("size").alias("at")).agg(F.count("*").alias("all"), F.count_if("other").alias("few"))
        near = rows.where("other").groupBy("spot", F.col("touching").alias("at")).agg(none.alias("all"), F.count("*").alias("few"))
        blocks = own.unionByName(near).groupBy("spot", "at").agg(F.sum("few").alias("few"), F.sum("all").alias("all"))
        blocks = blocks.where("few > 0 and all > 0").select(
            F.col("spot").alias("b_spot"), F.col("at").alias("b_at"),
            F.ceil(F.col("few") / BLOCK).cast("int").alias("few_blocks"), F.ceil(F.col("all") / BLOCK).cast("int").alias("all_blocks"),
        )
        places = rows.withColumn("at", F.col("size")).unionByName(rows.where("other").withColumn("at", F.col("touching")))
        placed = places.join(blocks, (F.col("spot") == F.col("b_spot")) & (F.col("at") == F.col("b_at")))
        h = F.xxhash64("rep")
        own_i, own_j = F.pmod(h, "few_blocks").cast("int"), F.pmod(h, "all_blocks").cast("int")
        spots = lambda n, place: F.transform(F.sequence(F.lit(0), F.col(n) - 1), place)
        as_all = F.when(F.col("at") == F.col("size"), spots("few_blocks", lambda i: F.struct(i.alias("i"), own_j.alias("j"))))
        as_few = F.when(F.col("other"), spots("all_blocks", lambda j: F.struct(own_i.alias("i"), j.alias("j"))))
        empty = F.array().cast("array<struct<i:int,j:int>>")
        tasks = F.explode(F.array_distinct(F.concat(F.coalesce(as_all, empty), F.coalesce(as_few, empty))))
        return placed.withColumn("task", tasks).select(
            *members.columns, "at", "task.i", "task.j",
            ((F.col("at") == F.col("size")) & (F.col("task.j") == own_j)).alias("all"), (F.col("other") & (F.col("task.i") == own_i)).alias("few"),
        )

    def links_across(self, members: DataFrame) -> DataFrame:
        """Links (u, v) that join different components within the groups (spot, band, rep, component).

        First the registers are compared within tasks, and members that have a
        plausible partner stay. These meet again with their shingle sets; pairs
        are verified within the task, the closest first, unless links found
        there have joined them. A task gives fewer links than it has members,
        and of two components that a link joins, every task that sees it either
        gives the link or a path of others.
        """
        percent = self.percent
        sketches = self.reps.select(F.col("rep").alias("r_rep"), "registers")
        sets = self.sets.select(F.col("rep").alias("t_rep"), "shingles")
        block = ["spot", "at", "i", "j"]
        kept = members.columns

        def active(table: pa.Table) -> pa.Table:
            mask = np.zeros(table.num_rows, bool)
            for _, x, y in close_pairs(table, percent):
                mask[x] = mask[y] = True
            return table.select(kept).filter(pa.array(mask))

        first = self.dealt(members).join(sketches, F.col("rep") == F.col("r_rep")).drop("r_rep")
        live = first.groupBy(*block).applyInArrow(active, members.schema)
        live = stage(live.distinct(), "near-active")
        again = self.dealt(live).join(sketches, F.col("rep") == F.col("r_rep")).join(sets, F.col("rep") == F.col("t_rep")).drop("r_rep", "t_rep")

        def verify(table: pa.Table) -> pa.Table:
            rep, component = table.column("rep").to_pylist(), table.column("component").to_pylist()
            shingles = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
            above = {c: c for c in component}

            def root(c):
                while above[c] != c:
                    above[c] = c = above[above[c]]
                return c

            u, v = [], []
            for _, x, y in close_pairs(table, percent):
                a, b = root(component[x]), root(component[y])
                if a != b and is_linked(shingles[x], shingles[y], percent):
                    above[max(a, b)] = min(a, b)
                    u.append(rep[x])
                    v.append(rep[y])
            return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        return again.groupBy(*block).applyInArrow(verify, "u long, v long")

    def test(self, pairs: DataFrame) -> None:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
        pairs = stage(pairs, "near-pairs")
        self.join(self.confirmed(self.likely(pairs)))
        unstage(pairs)

    def join(self, found: DataFrame) -> None:
        """Join the components of confirmed links (u, v)."""
        known = self.links
        self.links = stage(found if known is None else known.union(found), "near-links")
        if known is not None:
            unstage(known)
        self.labels = components(self.links)

    def labelled(self, rows: DataFrame, column: str, name: str) -> DataFrame:
        own = self.labels.select(F.col("node").alias("l_node"), F.col("component").alias("l_component"))
        return rows.join(own, F.col(column) == F.col("l_node"), "left").select(
            *rows.columns, F.coalesce("l_component", column).alias(name)
        )


def linked(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    plain = texts(docs)
    sketches = stage(sketched(plain, size), "near-sketches")
    key = ["n_shingles", "set_a", "set_b"]
    usable = "doc_id is not null and n_shingles > 0"
    classes = stage(sketches.where(usable).groupBy(*key).agg(F.min("doc_id").alias("rep")), "near-classes")
    match = [sketches[c] == classes[c] for c in key]
    classed = sketches.join(classes, match, "left").select(sketches["doc_id"], sketches["n_shingles"], "registers", "rep")
    reps = classed.where("doc_id = rep").select("rep", "n_shingles", "registers")
    members = stage(groups_of_bands(reps), "near-groups")
    tester = Tester(plain, reps, members, size, percent)
    # each document with the least one it meets, then the groups of two, which need not be with that one,
    # then whatever the other groups hold of different components
    stars = members.groupBy(F.col("rep").alias("b")).agg(F.min("low").alias("a"))
    tester.test(stars)
    twos = members.where("two and low < rep").select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct()
    untested = twos.join(stars, ["a", "b"], "left_anti")
    tester.test(tester.labelled(tester.labelled(untested, "a", "ca"), "b", "cb").where("ca <> cb"))
    groups = tester.labelled(members.where("not two"), "rep", "component").select("spot", "band", "rep", "n_shingles", "component")
    tester.join(tester.links_across(stage(groups, "near-members")))
    labelled = tester.labelled(classed.select("doc_id", "n_shingles", "rep"), "rep", "component")
    component = F.when(F.col("rep").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return labelled.select("doc_id", "n_shingles", component.alias("component_id")).select(
        "*", (F.col("doc_id").isNull() | F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept")
    )


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, all columns, with one document of each group; identical rows stay once."""
    ids = linked(docs, size, percent).where("kept and doc_id is not null").select(F.col("doc_id").alias("kept_id")).distinct()
    named = docs.join(ids, docs["doc_id"] == ids["kept_id"], "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(documents(spark, sf_dir), size=2, percent=80)
