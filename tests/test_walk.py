"""Graph expansion against plain Python enumeration on small awkward graphs."""

import itertools
import random

import pytest

from ledgerloom.operators import graph_walk as walk

GRAPHS = {
    "parallel and loops": [(1, 1), (1, 1), (1, 2), (2, 1), (2, 3), (2, 3), (3, 3), (3, 1), (4, 4)],
    "one loop": [(1, 1)],
    "two loops": [(1, 1), (1, 1)],
    "three loops": [(1, 1)] * 3,
    "ping pong": [(1, 2), (2, 1), (2, 1)],
    "single edge": [(1, 2)],
    "triple edge": [(1, 2)] * 3,
    "hub": [(i, 0) for i in range(1, 7)] + [(0, i) for i in range(1, 7)] + [(0, 0)],
    "triangle": [(1, 2), (2, 3), (3, 1), (1, 3)],
    "ladder": [(1, 2), (2, 1), (2, 3), (3, 2), (3, 1), (1, 3), (1, 2)],
}


def brute_trails(pairs, seed, hops, direction):
    ends, states = [], [(seed, ())]
    for _ in range(hops):
        grown = []
        for node, used in states:
            for i, (a, b) in enumerate(pairs):
                if i in used:
                    continue
                if direction in ("OUT", "BOTH") and a == node:
                    grown.append((b, (*used, i)))
                if direction in ("IN", "BOTH") and b == node and not (direction == "BOTH" and a == b):
                    grown.append((a, (*used, i)))
        states = grown
        ends.append({node for node, _ in states})
    return ends


def frames(spark, pairs):
    edges = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "id long, src long, dst long")
    nodes = sorted(set(itertools.chain(*pairs)))
    return edges, spark.createDataFrame([(n,) for n in nodes], "seed_id long"), nodes


@pytest.mark.parametrize("direction", ["OUT", "IN", "BOTH"])
@pytest.mark.parametrize("name", GRAPHS)
def test_trails(spark, name, direction):
    edges, seeds, nodes = frames(spark, GRAPHS[name])
    layers = walk.trail_frontiers(edges, seeds, 3, direction)
    got = [{tuple(r) for r in layer.collect()} for layer in layers]
    for hop in range(3):
        want = {(s, n) for s in nodes for n in brute_trails(GRAPHS[name], s, 3, direction)[hop]}
        assert got[hop] == want, (name, direction, hop + 1)


@pytest.mark.parametrize("direction, hops", [("OUT", 5), ("IN", 4), ("BOTH", 4)])
@pytest.mark.parametrize("name", ["parallel and loops", "ping pong", "three loops", "triangle", "ladder"])
def test_longer_trails(spark, name, direction, hops):
    pairs = GRAPHS[name]
    edges, seeds, nodes = frames(spark, pairs)
    layers = walk.trail_frontiers(edges, seeds, hops, direction)
    want = {s: brute_trails(pairs, s, hops, direction) for s in nodes}
    for hop, layer in enumerate(layers):
        assert {tuple(r) for r in layer.collect()} == {(s, n) for s in nodes for n in want[s][hop]}


def test_witnesses_are_few_and_decide_every_continuation(spark):
    chance = random.Random(4)
    rows = [(1, 2, sorted((chance.randrange(6), 0) for _ in range(3))) for _ in range(60)]
    states = spark.createDataFrame(rows, "seed_id long, node long, used array<struct<x:int,y:int>>")
    for steps in (1, 2):
        got = [[tuple(e) for e in r["used"]] for r in walk.witnesses(states.distinct(), steps).collect()]
        assert len(got) <= sum(3**k for k in range(steps + 1))
        for more in itertools.product(range(6), repeat=steps):
            for times in (1, 2, 3):  # as many parallel edges everywhere
                free = lambda used: all(sum(x == e for x, _ in used) + more.count(e) <= times for e in more)
                assert any(map(free, got)) == any(free(r[2]) for r in rows)


@pytest.mark.parametrize("direction", ["OUT", "IN", "BOTH"])
def test_shortest_distances(spark, direction):
    pairs = GRAPHS["hub"] + [(6, 7), (7, 8), (8, 9)]
    edges, seeds, nodes = frames(spark, pairs)
    want = set()
    for seed in nodes:
        seen, layer = {seed}, {seed}
        for hop in range(1, 5):
            reach = set()
            for a, b in pairs:
                if direction != "IN" and a in layer:
                    reach.add(b)
                if direction != "OUT" and b in layer:
                    reach.add(a)
            layer = reach - seen
            seen |= layer
            want |= {(seed, n, hop) for n in layer}
    got = {tuple(r) for r in walk.bfs_frontiers(edges, seeds, 4, direction).select("seed_id", "node", "hop").collect()}
    assert got == want


def test_bits_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(walk, "WORDS", 1)
    pairs = [(i, (i * 7 + 3) % 150) for i in range(150)] + [(i, (i + 1) % 150) for i in range(150)]
    edges, seeds, nodes = frames(spark, pairs)
    sizes = {(r["seed_id"], r["hop"]): r["frontier_size"] for r in walk.bfs_sizes(edges, seeds, 3).collect()}
    after = {n: {b for a, b in pairs if a == n} for n in nodes}
    for seed in nodes:
        seen, layer = {seed}, {seed}
        for hop in (1, 2, 3):
            layer = set().union(*(after[n] for n in layer)) - seen
            seen |= layer
            assert sizes[seed, hop] == len(layer)


def test_edges_among_nodes(spark):
    edges, _, _ = frames(spark, [(1, 2), (2, 3), (3, 1), (2, 2)])
    kept = walk.among(edges, spark.createDataFrame([(1,), (2,), (2,)], "n long")).collect()
    assert {(r["src"], r["dst"]) for r in kept} == {(1, 2), (2, 2)}


def test_explosion_keeps_zero_frontiers(spark):
    edges, seeds, _ = frames(spark, GRAPHS["single edge"])
    rows = {(r["seed_id"], r["hop"]): (r["frontier_size"], r["deg_out_seed"]) for r in walk.neighbor_explosion(edges, seeds).collect()}
    assert rows == {(1, 1): (1, 1), (1, 2): (0, 1), (1, 3): (0, 1), (2, 1): (0, 0), (2, 2): (0, 0), (2, 3): (0, 0)}


def test_one_hop_sizes_add_up_to_neighbour_pairs(spark):
    edges, seeds, _ = frames(spark, GRAPHS["parallel and loops"])
    sizes = walk.frontier_sizes(walk.trail_frontiers(edges, seeds, 1)[0], seeds)
    assert sum(r["frontier_size"] for r in sizes.collect()) == edges.select("src", "dst").distinct().count()


def test_type_filter_and_bad_direction(spark):
    edges = spark.createDataFrame([(1, 1, 2, "TX"), (2, 2, 1, "FEE")], "id long, src long, dst long, kind string")
    assert walk.of_type(edges, "kind", ["TX"]).count() == 1 and walk.of_type(edges, "kind").count() == 2
    with pytest.raises(ValueError):
        walk.ends(edges, "SIDEWAYS")


def test_text_ids_walk_like_numbers(spark):
    pairs = GRAPHS["parallel and loops"]
    edges = spark.createDataFrame([(i, f"n{a}", f"n{b}") for i, (a, b) in enumerate(pairs)], "id long, src string, dst string")
    seeds = spark.createDataFrame([("n1",), ("n4",)], "seed_id string")
    got = {tuple(r) for r in walk.trail_frontiers(edges, seeds, 4)[3].collect()}
    assert got == {(f"n{s}", f"n{n}") for s in (1, 4) for n in brute_trails(pairs, s, 4, "OUT")[3]}
    reached = {tuple(r) for r in walk.bfs_frontiers(edges, seeds, 3).collect()}
    assert reached == {("n1", "n2", 1), ("n1", "n3", 2)}
