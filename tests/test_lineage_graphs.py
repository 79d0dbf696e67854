"""Closure, strong components and condensed counts against plain Python on random graphs."""

import random

import pytest

from lodgeflow.operators import lineage as G


def brute_closure(edges):
    out = {}
    children = {}
    for u, v in edges:
        children.setdefault(u, set()).add(v)
    for s in children:
        level, depth, seen = set(children[s]), 1, {}
        while level:
            for x in level:
                seen[x] = depth
            level = {y for x in level for y in children.get(x, ())} - set(seen)
            depth += 1
        out |= {(s, d): k for d, k in seen.items()}
    return out


def links(spark, edges):
    return spark.createDataFrame(sorted(set(edges)), "u long, v long")


def graphs():
    rng = random.Random(11)
    yield [(rng.randrange(25), rng.randrange(25)) for _ in range(40)]             # cycles and self-loops
    yield [(a, a + rng.randrange(1, 4)) for a in range(40) for _ in range(2)]       # acyclic, deep
    yield [(i, (i + 1) % 37) for i in range(37)] + [(5, 100), (100, 101)]           # one long cycle with a tail
    yield [(0, i) for i in range(1, 30)] + [(i, 0) for i in range(1, 30)] + [(7, 7), (50, 50), (50, 51)]  # a star of cycles
    yield [(1, 2)]


@pytest.mark.parametrize("edges", list(graphs()))
def test_closure_components_and_counts(spark, edges):
    want = brute_closure(set(edges))
    got = {(r.src, r.dst): r.depth for r in G.transitive_closure(links(spark, edges)).collect()}
    assert got == want
    together = {}
    for r in G.strong_components(links(spark, edges)).collect():
        together.setdefault(r.component, set()).add(r.node)
    nodes = {x for e in edges for x in e}
    shared = {frozenset(y for y in nodes if y == x or (x, y) in want and (y, x) in want) for x in nodes}
    assert {frozenset(m) for m in together.values()} == {m for m in shared if len(m) > 1}
    totals = {}
    for s, _ in want:
        totals[s] = totals.get(s, 0) + 1
    named = spark.createDataFrame([(f"n{u}", f"n{v}") for u, v in edges], "parent string, child string")
    for condense in (False, True):
        rep = {r.model_name: r for r in G.impact(named, condense=condense).collect()}
        assert {n: rep[f"n{n}"].total_downstream_count for n in nodes} == {n: totals.get(n, 0) for n in nodes}
        assert {n: rep[f"n{n}"].direct_downstream_count for n in nodes} == {
            n: len({v for u, v in edges if u == n}) for n in nodes}
        if not condense:
            assert {n: rep[f"n{n}"].max_downstream_depth for n in nodes} == {
                n: max([k for (s, _), k in want.items() if s == n], default=0) for n in nodes}


def count_rounds(monkeypatch):
    seen = []
    keep = G.reliable_checkpoint
    monkeypatch.setattr(G, "reliable_checkpoint", lambda df: (seen.append(1), keep(df))[1])
    return seen


def test_a_long_cycle_ends_in_few_rounds(spark, monkeypatch):
    n = 10_000
    edges = spark.range(n).selectExpr("concat('n', id) AS parent", f"concat('n', (id + 1) % {n}) AS child")
    rounds = count_rounds(monkeypatch)
    got = G.impact(edges, condense=True).groupBy("total_downstream_count", "max_downstream_depth").count().collect()
    assert [tuple(r) for r in got] == [(n, 1, n)]
    assert len(rounds) < 45


def test_exact_depths_double(spark, monkeypatch):
    n = 300
    edges = spark.range(n).selectExpr("concat('n', id) AS parent", f"concat('n', (id + 1) % {n}) AS child")
    rounds = count_rounds(monkeypatch)
    got = G.impact(edges).groupBy("total_downstream_count", "max_downstream_depth").count().collect()
    assert [tuple(r) for r in got] == [(n, n, n)]
    assert len(rounds) < 14


def test_lists_and_condensing_exclude_each_other(spark):
    with pytest.raises(ValueError):
        G.impact(spark.createDataFrame([("a", "b")], "parent string, child string"), with_lists=True, condense=True)


def test_condensing_stores_and_moves_the_edges_once(spark, monkeypatch):
    """Customers and orders on cycles, orders with parts that have no children: the edges to
    parts are stored once, and nothing else is stored that is as long as they are."""
    forth = [(f"c{o % 40}", f"o{o}") for o in range(400)]
    parts = [(f"o{o}", f"p{o * 7 % 60 + k}") for o in range(400) for k in range(10)]
    edges = spark.createDataFrame(forth + [(b, a) for a, b in forth] + parts, "parent string, child string")
    sizes = []
    keep = G.reliable_checkpoint

    def counted(df):
        out = keep(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(G, "reliable_checkpoint", counted)
    got = {r.model_name: r.total_downstream_count for r in G.impact(edges, condense=True).collect()}
    want = {}
    for c in range(40):
        reached = {p for u, p in parts if int(u[1:]) % 40 == c}
        for name in [f"c{c}", *[f"o{o}" for o in range(c, 400, 40)]]:
            want[name] = 11 + len(reached)
    assert got == want | {p: 0 for _, p in parts}
    assert sorted(sizes)[-1] == len(forth) * 2 + len(parts) and sorted(sizes)[-2] <= len(forth) * 2


def test_condensed_counts_beyond_components(spark):
    """Cycles that lead to others, nodes between and after them, and a node with an edge to itself."""
    edges = [(1, 2), (2, 1), (2, 3), (3, 4), (4, 5), (5, 4), (4, 6), (6, 6), (6, 7), (0, 1), (0, 7), (8, 0), (8, 9)]
    want = brute_closure(set(edges))
    named = spark.createDataFrame([(f"n{u}", f"n{v}") for u, v in edges * 2], "parent string, child string")
    for nodes in (None, spark.createDataFrame([(f"n{k}",) for k in range(10)], "name string")):
        rep = {r.model_name: r for r in G.impact(named, nodes, condense=True).collect()}
        assert {n: rep[f"n{n}"].total_downstream_count for n in range(10)} == {
            n: sum(s == n for s, _ in want) for n in range(10)}
        assert rep["n8"].max_downstream_depth == 5 and rep["n7"].max_downstream_depth == 0
