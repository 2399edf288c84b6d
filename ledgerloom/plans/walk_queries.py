"""Graph-expansion queries from pseudo-random seeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import graph_walk as walk
from ledgerloom.operators.graph_model import edges as build_edges
from ledgerloom.operators.sampling import seed_sample
from ledgerloom.operators.timeseries import rounded
from ledgerloom.plans.fixtures import with_transfers
from ledgerloom.plans.ledger_queries import transfers
from ledgerloom.plans.registry import query
from ledgerloom.sources.tables import Tables

SEEDS = 1000
HOPS = 3


def _graph(spark, folder):
    edges = build_edges(transfers(spark, folder, currencies=False)).select("id", "src", "dst")
    nodes = Tables(spark, folder).customer.select(F.col("c_custkey").alias("seed_id"))
    return edges, seed_sample(nodes, "seed_id", SEEDS)


SEED_SQL = f"""
seeds AS (SELECT c_custkey AS seed_id FROM customer
          ORDER BY (c_custkey % 2147483648 * 1103515245 + 12345) % 2147483648, c_custkey LIMIT {SEEDS}),
e AS (SELECT id, sender_account AS src, receiver_account AS dst FROM t),
b AS (SELECT id, src AS u, dst AS v FROM e UNION ALL SELECT id, dst, src FROM e WHERE src <> dst)
"""


def _trail_sql(hop: int, direction: str = "OUT") -> str:
    """Brute force over explicit edge ids."""
    table, u, v = {"OUT": ("e", "src", "dst"), "IN": ("e", "dst", "src"), "BOTH": ("b", "u", "v")}[direction]
    joins, last = "", "seeds.seed_id"
    for k in range(1, hop + 1):
        unused = "".join(f" AND e{k}.id <> e{j}.id" for j in range(1, k))
        joins += f" JOIN {table} e{k} ON e{k}.{u} = {last}{unused}"
        last = f"e{k}.{v}"
    return f"SELECT seeds.seed_id, count(DISTINCT {last}) AS frontier_size FROM seeds{joins} GROUP BY 1"


def _zero_kept(sql: str) -> str:
    return f"SELECT seeds.seed_id, coalesce(frontier_size, 0) AS frontier_size FROM seeds LEFT JOIN ({sql}) z USING (seed_id)"


def _trail(hop: int) -> None:
    @query(f"trail_frontier_h{hop}", with_transfers(f", {SEED_SQL} {_zero_kept(_trail_sql(hop))}"))
    def run(spark, folder):
        edges, seeds = _graph(spark, folder)
        return walk.frontier_sizes(walk.trail_frontiers(edges, seeds, hop)[-1], seeds)


_REACH = """
s AS (SELECT DISTINCT src, dst FROM e),
r1 AS (SELECT DISTINCT seed_id, dst AS node FROM seeds JOIN s ON src = seed_id),
r2 AS (SELECT DISTINCT seed_id, dst AS node FROM r1 JOIN s ON src = node),
r3 AS (SELECT DISTINCT seed_id, dst AS node FROM r2 JOIN s ON src = node),
d AS (SELECT seed_id, node, min(hop) AS hop FROM (
        SELECT *, 1 AS hop FROM r1 UNION ALL SELECT *, 2 FROM r2 UNION ALL SELECT *, 3 FROM r3)
      WHERE node <> seed_id GROUP BY 1, 2)
"""


def _bfs(hop: int) -> None:
    counted = f"SELECT seed_id, count(*) AS frontier_size FROM d WHERE hop = {hop} GROUP BY 1"

    @query(f"bfs_frontier_h{hop}", with_transfers(f", {SEED_SQL}, {_REACH} {_zero_kept(counted)}"))
    def run(spark, folder):
        edges, seeds = _graph(spark, folder)
        return walk.bfs_sizes(edges, seeds, hop).filter(F.col("hop") == hop).drop("hop")


for _hop in range(1, HOPS + 1):
    _trail(_hop)
    _bfs(_hop)
_trail(HOPS + 1)


def _bfs_sql(hop: int, direction: str, edges: str = "e") -> str:
    """Nodes at distance `hop`, from all nodes within 0 .. hop steps."""
    u, v = ("src", "dst") if direction == "OUT" else ("dst", "src")
    source = f"SELECT {u} AS u, {v} AS v FROM {edges}" + (" UNION SELECT src, dst FROM " + edges if direction == "BOTH" else "")
    layers = ["w AS (SELECT DISTINCT u, v FROM (" + source + "))", "l0 AS (SELECT seed_id, seed_id AS node, 0 AS hop FROM seeds)"]
    for k in range(1, hop + 1):
        layers.append(f"l{k} AS (SELECT DISTINCT seed_id, v AS node, {k} AS hop FROM l{k - 1} JOIN w ON u = node)")
    every = " UNION ALL ".join(f"SELECT * FROM l{k}" for k in range(hop + 1))
    far = f"SELECT seed_id, node FROM ({every}) GROUP BY 1, 2 HAVING min(hop) = {hop}"
    return ", ".join(layers) + " " + _zero_kept(f"SELECT seed_id, count(*) AS frontier_size FROM ({far}) GROUP BY 1")


def _bfs_along(name: str, direction: str) -> None:
    @query(name, with_transfers(f", {SEED_SQL}, {_bfs_sql(2, direction)}"))
    def run(spark, folder):
        edges, seeds = _graph(spark, folder)
        return walk.bfs_sizes(edges, seeds, 2, direction).filter("hop = 2").drop("hop")


_bfs_along("bfs_frontier_in_h2", "IN")
_bfs_along("bfs_frontier_both_h2", "BOTH")

_KINDS = ["1-URGENT", "2-HIGH"]


@query(
    "bfs_frontier_by_type_h2",
    with_transfers(
        f""", {SEED_SQL}, k AS (SELECT sender_account AS src, receiver_account AS dst FROM t
        WHERE payment_type IN ({", ".join(f"'{kind}'" for kind in _KINDS)})), {_bfs_sql(2, "OUT", "k")}"""
    ),
)
def _bfs_by_type(spark, folder):
    edges = build_edges(transfers(spark, folder, currencies=False))
    _, seeds = _graph(spark, folder)
    return walk.bfs_sizes(walk.of_type(edges, "payment_type", _KINDS), seeds, 2).filter("hop = 2").drop("hop")


@query(
    "bfs_frontier_by_label_h2",
    with_transfers(
        f""", {SEED_SQL}, k AS (SELECT src, dst FROM e WHERE src IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
        AND dst IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')), {_bfs_sql(2, "OUT", "k")}"""
    ),
)
def _bfs_by_label(spark, folder):
    edges, seeds = _graph(spark, folder)
    labelled = Tables(spark, folder).customer.filter("c_mktsegment <> 'MACHINERY'").select("c_custkey")
    return walk.bfs_sizes(walk.among(edges, labelled), seeds, 2).filter("hop = 2").drop("hop")


@query(
    "seed_sample",
    f"""SELECT c_custkey AS seed_id FROM customer
        ORDER BY (c_custkey % 2147483648 * 1103515245 + 12345) % 2147483648, c_custkey LIMIT {SEEDS}""",
)
def _seed_sample(spark, folder):
    return _graph(spark, folder)[1]


_DEGREE = "SELECT seed_id, count(id) AS deg_out FROM seeds LEFT JOIN e ON src = seed_id GROUP BY 1"


@query("out_degree", with_transfers(f", {SEED_SQL} {_DEGREE}"))
def _out_degree(spark, folder):
    edges, seeds = _graph(spark, folder)
    return walk.out_degree(edges, seeds)


def _explosion_sql(direction: str) -> str:
    sizes = " UNION ALL ".join(
        f"SELECT seed_id, {hop} AS hop, frontier_size FROM ({_zero_kept(_trail_sql(hop, direction))})"
        for hop in range(1, HOPS + 1)
    )
    return f"""x AS (SELECT z.seed_id, CAST(hop AS INTEGER) AS hop, frontier_size, deg_out AS deg_out_seed,
        '{direction}' AS direction FROM ({sizes}) z JOIN ({_DEGREE}) g ON g.seed_id = z.seed_id)"""


def _explosion(spark, folder, direction="OUT"):
    edges, seeds = _graph(spark, folder)
    return walk.neighbor_explosion(edges, seeds, HOPS, direction)


for _name, _direction in (
    ("neighbor_explosion", "OUT"),
    ("neighbor_explosion_in", "IN"),
    ("neighbor_explosion_both", "BOTH"),
):
    query(_name, with_transfers(f", {SEED_SQL}, {_explosion_sql(_direction)} SELECT * FROM x"))(
        lambda spark, folder, direction=_direction: _explosion(spark, folder, direction)
    )


@query(
    "frontier_summary",
    with_transfers(
        f""", {SEED_SQL}, {_explosion_sql('OUT')}
        SELECT hop, count(*) AS count, round(avg(frontier_size), 6) AS mean, round(stddev_samp(frontier_size), 6) AS std,
               min(frontier_size) AS min, quantile_cont(frontier_size, 0.25) AS q25, quantile_cont(frontier_size, 0.5) AS median,
               quantile_cont(frontier_size, 0.75) AS q75, max(frontier_size) AS max FROM x GROUP BY hop"""
    ),
)
def _frontier_summary(spark, folder):
    return rounded(walk.frontier_summary(_explosion(spark, folder)), 6, "mean", "std")


_LOG_N = "ln(greatest(CAST(frontier_size AS DOUBLE), 1))"


@query(
    "branching_model_a",
    with_transfers(
        f""", {SEED_SQL}, {_explosion_sql('OUT')},
        p AS (SELECT hop * ln(deg_out_seed) AS x, {_LOG_N} AS y FROM x WHERE deg_out_seed > 0)
        SELECT count(*) AS n, round(exp(regr_intercept(y, x)), 6) AS a_hat, round(regr_slope(y, x), 6) AS b_hat,
               round(regr_r2(y, x), 6) AS r2 FROM p"""
    ),
)
def _branching_model_a(spark, folder):
    return rounded(walk.branching_by_degree(_explosion(spark, folder)), 6, "a_hat", "b_hat", "r2")


@query(
    "branching_model_b",
    with_transfers(
        f""", {SEED_SQL}, {_explosion_sql('OUT')},
        p AS (SELECT CAST(hop AS DOUBLE) AS x, {_LOG_N} AS y FROM x)
        SELECT count(*) AS n, round(exp(regr_intercept(y, x)), 6) AS alpha_hat, round(exp(regr_slope(y, x)), 6) AS m_hat,
               round(regr_r2(y, x), 6) AS r2 FROM p"""
    ),
)
def _branching_model_b(spark, folder):
    return rounded(walk.branching_by_hop(_explosion(spark, folder)), 6, "alpha_hat", "m_hat", "r2")


@query(
    "size_biased_branching",
    with_transfers(
        f""", {SEED_SQL},
        near AS (SELECT DISTINCT seed_id, dst AS node FROM seeds JOIN e ON src = seed_id),
        picked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seed_id
            ORDER BY (node % 2147483648 * 1103515245 + 12345) % 2147483648, node) AS rn FROM near) WHERE rn <= 5),
        deg AS (SELECT src AS node, count(*) AS deg FROM e GROUP BY 1)
        SELECT count(*) AS n_sampled, round(avg(coalesce(deg, 0)), 6) AS m_size_biased FROM picked LEFT JOIN deg USING (node)"""
    ),
)
def _size_biased_branching(spark, folder):
    edges, seeds = _graph(spark, folder)
    return rounded(walk.size_biased_branching(edges, seeds), 6, "m_size_biased")
