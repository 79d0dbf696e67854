"""Downstream-impact analysis over a dependency edge table (G1a–G1i).

Input: ``edges(parent, child)`` — "child depends on parent" — and optionally
``nodes(name)``. Output: one row per kept node with direct and total
downstream counts, breadth-first depth and the derived categories.

Names become numbers once; everything iterative runs on pairs of longs. Every
round is written to the shared checkpoint folder, which cuts the lineage and
lets the loops survive lost executors. There is no round cap.

* ``transitive_closure`` keeps first-visit (shortest-path) depths and doubles
  the reach per round: pairs at distance exactly 2^k are joined with all known
  pairs, so a path of n steps takes log2(n) rounds, and only pairs whose end has
  children of its own are carried on.
* ``strong_components`` finds the cycles: nodes that cannot lie on one are
  trimmed from both ends, each remaining node picks one child, pointer doubling
  finds the cycles of these picks, and each is contracted to one node, with those
  of its children whose steps lead back to it — until nothing is left. A cycle of n
  nodes takes log2(n) rounds.
* ``impact(condense=True)`` reports on the graph of components: a cycle of n
  nodes is one node there instead of n² pairs. Counts stay exact; the depth counts
  a cycle as one level.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.functions.tiers import tier
from lodgeflow.session import reliable_checkpoint

# Names excluded by default (matched at the start of the name).
DEFAULT_EXCLUDE = ("^profile.*", ".*lineage$")


def keep_nodes(nodes: DataFrame, exclude_patterns: Sequence[str] = DEFAULT_EXCLUDE,
               name: str = "name") -> DataFrame:
    """Drop names matching any pattern at their start (``re.match``)."""
    return nodes.filter(~_excluded(F.col(name), exclude_patterns)).select(F.col(name).alias("name"))


def _excluded(c: Column, patterns: Sequence[str]) -> Column:
    """TRUE when ``c`` matches any pattern at its start."""
    if not patterns:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [c.rlike("^(?:" + p.removeprefix("^") + ")") for p in patterns])


def number_nodes(names: DataFrame) -> tuple[DataFrame, bool]:
    """``(name, id)`` per distinct name, stored, and whether ids are hashes of the names: then
    an edge's ends are numbered without a join. Only where two names share a 64-bit hash
    are running numbers given instead. A column ``parent`` of the names is kept: whether any of
    a name's rows has it true."""
    marks = [F.max("parent").alias("parent")] if "parent" in names.columns else []
    named = names.groupBy("name").agg(*marks) if marks else names.select("name").distinct()
    nodes = reliable_checkpoint(named.withColumn("id", F.xxhash64("name")))
    shared = nodes.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if shared.isEmpty():
        return nodes, True
    return reliable_checkpoint(nodes.withColumn("id", F.monotonically_increasing_id())), False


def kept_edges(edges: DataFrame, nodes: DataFrame, hashed: bool, every_end_kept: bool = False) -> DataFrame:
    """Distinct numbered edges ``(u, v)`` whose both ends are among ``nodes(name, id)``. No side is pre-partitioned, so AQE can split a hub that holds a third of all
    edges."""
    edges = edges.select("parent", "child")
    if not hashed:
        end = lambda name, id_: nodes.select(F.col("name").alias(name), F.col("id").alias(id_))
        edges = edges.join(end("parent", "u"), "parent").join(end("child", "v"), "child")
        return edges.select("u", "v").distinct()
    links = edges.select(F.xxhash64("parent").alias("u"), F.xxhash64("child").alias("v")).distinct()
    if not every_end_kept:
        for c in ("u", "v"):
            links = links.join(nodes.select(F.col("id").alias(c)), c, "left_semi")
    return links.select("u", "v")


def transitive_closure(links: DataFrame) -> DataFrame:
    """G1c/G1d: ``(src, dst, depth)`` for every reachable pair of the distinct edges
    ``(u, v)`` with its first-visit depth (a node on a cycle reaches itself).

    After round k all pairs up to distance 2^(k+1) are known: a farther pair has a
    middle at distance exactly 2^k from its source, and what lies beyond the middle is
    known. Each round writes its new pairs once. ``open`` tells whether the end has
    children: others cannot be a middle, so a graph whose paths have ended costs no
    further round."""
    parents = links.select(F.col("u").alias("v"), F.lit(True).alias("open")).distinct()
    return _doubled(links.join(parents, "v", "left").select(
        F.col("u").alias("src"), F.col("v").alias("dst"), F.lit(1).alias("depth"),
        F.coalesce("open", F.lit(False)).alias("open"))).drop("open")


def _doubled(first: DataFrame) -> DataFrame:
    """All pairs from those at distance 1: ``src``, ``dst``, ``depth``, ``open`` and what else is
    known of ``dst``."""
    found = [reliable_checkpoint(first)]
    of_dst = [c for c in first.columns if c not in ("src", "dst", "depth")]
    reach = 1
    while not found[-1].filter(F.col("open") & (F.col("depth") == reach)).isEmpty():
        known = reduce(DataFrame.unionByName, found)
        # the pairs at distance ``reach`` are all in the newest part
        near = found[-1].filter(F.col("open") & (F.col("depth") == reach)).select("src", F.col("dst").alias("middle"))
        beyond = known.select(F.col("src").alias("middle"), "dst", "depth", *of_dst)
        step = near.join(beyond, "middle").groupBy("src", "dst").agg(
            (F.min("depth") + reach).alias("depth"), *[F.first(c).alias(c) for c in of_dst])
        found.append(reliable_checkpoint(step.join(known.select("src", "dst"), ["src", "dst"], "left_anti")))
        reach *= 2
    return reduce(DataFrame.unionByName, found)


def _trimmed(links: DataFrame) -> DataFrame:
    """Edges left when nodes without a parent or without a child are taken away, again
    and again: what is left lies on cycles or between them. Only the nodes are compared, so
    edges are moved in rounds that take some away; ``links`` itself where there are none."""
    while True:
        sides = links.select(F.col("u").alias("id"), F.lit(True).alias("child"), F.lit(False).alias("parent")).unionByName(
            links.select(F.col("v").alias("id"), F.lit(False).alias("child"), F.lit(True).alias("parent")))
        odd = reliable_checkpoint(sides.groupBy("id").agg(F.max("child").alias("child"), F.max("parent").alias("parent"))
                                  .filter("NOT (child AND parent)"))
        if odd.isEmpty():
            return links
        links = reliable_checkpoint(links.join(odd.filter("NOT child").select(F.col("id").alias("v")), "v", "left_anti")
                                    .join(odd.filter("NOT parent").select(F.col("id").alias("u")), "u", "left_anti")
                                    .select("u", "v"))


def _picked_cycles(links: DataFrame, turn: int) -> DataFrame:
    """``(node, label)`` of nodes found to share a cycle; label: one of its nodes.

    Each node follows one child of its own (picked by bits that change with the turn);
    pointer doubling takes everyone onto a cycle of these picks. A child of a cycle whose
    own steps lead back to that cycle lies on a cycle with it as well."""
    mask = F.lit(0x5851F42D4C957F2D * turn % (1 << 63)).cast("bigint")
    picks = links.groupBy(F.col("u").alias("node")).agg(F.min(F.col("v").bitwiseXOR(mask)).alias("next"))
    jumps = reliable_checkpoint(picks.select("node", F.col("next").bitwiseXOR(mask).alias("next"))).withColumn(
        "least", F.col("next"))
    images = None
    while True:
        ahead = jumps.select(F.col("node").alias("next"), F.col("next").alias("then"), F.col("least").alias("later"))
        jumps = reliable_checkpoint(jumps.join(ahead, "next").select(
            "node", F.col("then").alias("next"), F.least("least", "later").alias("least"),
            (F.col("later") < F.col("least")).alias("changed")))
        now = jumps.agg(F.count_distinct("next").alias("images"), F.count_if("changed").alias("changes")).first()
        # where 2^k steps lead no longer shrinks: it is the cycles; no least node changes:
        # each has seen all that lies before it
        if now["changes"] == 0 and now["images"] == images:
            break
        images = now["images"]
    on_cycle = jumps.join(jumps.select(F.col("next").alias("node")).distinct(), "node", "left_semi").select(
        "node", F.col("least").alias("label"))
    basin = jumps.select("node", "next").join(on_cycle.withColumnRenamed("node", "next"), "next").select(
        F.col("node").alias("v"), "label")
    beside = (links.join(on_cycle.select(F.col("node").alias("u"), F.col("label").alias("from")), "u")
              .join(basin, "v").filter("label = from").select(F.col("v").alias("node"), "label"))
    return on_cycle.unionByName(beside).distinct()


def strong_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of the nodes that share a cycle with another node; the
    component is a node of it. Edges ``(u, v)``."""
    return _contracted(links)[0]


def _contracted(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``strong_components`` and the distinct edges between different components. ``links`` is read
    several times, so it should be stored."""
    links = links.filter("u <> v").select("u", "v")
    rest, whole = links, True
    of = None
    turn = 0
    while True:
        trimmed = _trimmed(rest)
        whole = whole and trimmed is rest
        rest = trimmed
        if rest.isEmpty():
            break
        cycles = reliable_checkpoint(_picked_cycles(rest, turn))
        rest = reliable_checkpoint(_relabelled(rest, cycles.select("node", F.col("label").alias("component")))
                                   .filter("u <> v").distinct())
        if of is None:
            of = cycles.select("node", F.col("label").alias("component"))
        else:  # components found before may be nodes of the new cycles
            label = cycles.select(F.col("node").alias("component"), "label")
            older = of.join(label, "component", "left").select(
                "node", F.coalesce("label", "component").alias("component"))
            newer = cycles.join(of.select("node"), "node", "left_anti").select("node", F.col("label").alias("component"))
            of = reliable_checkpoint(older.unionByName(newer))
        turn += 1
    if of is None:
        return links.select(F.col("u").alias("node"), F.col("v").alias("component")).limit(0), links
    # where no edge was trimmed away, those left are all there are
    return of, rest if whole else reliable_checkpoint(_relabelled(links, of).filter("u <> v").distinct())


def _relabelled(links: DataFrame, of: DataFrame) -> DataFrame:
    """Edges between components (nodes outside them stand for themselves)."""
    for end in ("u", "v"):
        own = of.select(F.col("node").alias(end), "component")
        links = links.join(own, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    return links.select("u", "v")


def _condensed_reach(links: DataFrame, direct: DataFrame) -> DataFrame:
    """``direct`` (a row per ``id`` with descendants) with ``total`` and ``depth``, by the graph
    of components. ``links``: distinct ``(u, v, open)``; ``open`` tells whether v has children.

    Edges to nodes without children, which share no cycle, stay out of the search for
    components; only their parents are renamed, and they are no one's middle."""
    of, between = _contracted(links.filter("open"))
    sizes = of.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    one = F.lit(1).cast("bigint")
    own = of.select(F.col("node").alias("u"), "component")
    ends = links.filter("NOT open").join(own, "u", "left").select(
        F.coalesce("component", "u").alias("src"), F.col("v").alias("dst")).distinct().select(
        "src", "dst", F.lit(1).alias("depth"), F.lit(False).alias("open"), one.alias("size"))
    pairs = ends
    if not between.isEmpty():
        ends = reliable_checkpoint(ends)
        parents = between.select("u").union(ends.select("src")).distinct().select(
            F.col("u").alias("v"), F.lit(True).alias("open"))
        inner = between.join(parents, "v", "left").join(sizes.withColumnRenamed("component", "v"), "v", "left").select(
            F.col("u").alias("src"), F.col("v").alias("dst"), F.lit(1).alias("depth"),
            F.coalesce("open", F.lit(False)).alias("open"), F.coalesce("size", one).alias("size"))
        pairs = _doubled(ends.unionByName(inner))
    # a component's own nodes, and a node with an edge to itself, are reached in one step
    own_nodes, alone = sizes, links.filter("u = v").select(F.col("u").alias("component"))
    if not alone.isEmpty():
        own_nodes = sizes.unionByName(alone.join(of.select(F.col("node").alias("component")), "component", "left_anti")
                                      .withColumn("size", one))
    own_nodes = own_nodes.select(F.col("component").alias("src"), "size", F.lit(1).alias("depth"))
    reach = pairs.select("src", "size", "depth").unionByName(own_nodes).groupBy("src").agg(
        F.sum("size").alias("total"), F.max("depth").alias("depth"))
    return (direct.join(of.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("src", F.coalesce("component", "id")).drop("component").join(reach, "src").drop("src"))


# The impact classification. Counts are non-negative integers;
# each table is read top-down, first matching rule wins (see functions.tiers).
CRITICALITY = ((("<=", 0, "leaf"), ("<=", 1, "low_impact"), ("<=", 3, "medium_impact"),
                ("<=", 7, "high_impact")), "critical")
IMPACT_LEVEL = (((">", 10, "CRITICAL"), (">", 7, "VERY_HIGH"), (">", 3, "HIGH"),
                 (">", 1, "MEDIUM"), (">", 0, "LOW")), "NONE")
RISK_BASE = (((">", 10, 10), (">", 7, 8), (">", 3, 6), (">", 1, 4), (">", 0, 2)), 0)
RISK_DEPTH_CAP = 3
BUSINESS = (((">", 7, "Business Critical"), (">", 5, "High Business Value"),
             (">", 3, "Moderate Business Value"), (">", 1, "Supporting Role"),
             (">", 0, "Limited Scope")), "End Consumer")
FANOUT = (((">", 3, "High Fanout"), (">", 1, "Medium Fanout"), (">", 0, "Low Fanout")),
          "No Fanout")
CHAIN = (((">", 2, "Deep Chain"), (">", 1, "Medium Chain"), (">", 0, "Shallow Chain")),
         "No Chain")
# Our own wording; ``{spread}`` expands to SPREAD with (total, depth).
SPREAD = "%d downstream models over %d levels"
DESCRIPTION = (((">", 10, "Foundation model: {spread}; change only with full regression testing"),
                (">", 7, "Wide reach: {spread}; coordinate changes with all owners"),
                (">", 3, "Moderate reach: {spread}; plan changes carefully"),
                (">", 1, "Small reach: {spread}; change scope is manageable"),
                (">", 0, "Single dependent model")),
               "Leaf model: changes affect only itself")


def _described(text: str, spread: Column) -> Column:
    if "{spread}" not in text:
        return F.lit(text)
    head, tail = text.split("{spread}")
    return F.concat(F.lit(head), spread, F.lit(tail))


def _description(total: Column, depth: Column) -> Column:
    spread = F.format_string(SPREAD, total, depth)
    rules, default = DESCRIPTION
    return tier(total, [(op, b, _described(t, spread)) for op, b, t in rules],
                _described(default, spread))


def impact(edges: DataFrame, nodes: DataFrame | None = None,
           exclude_patterns: Sequence[str] = DEFAULT_EXCLUDE, with_lists: bool = False,
           as_of=None, condense: bool = False) -> DataFrame:
    """One row per kept node with its downstream impact metrics.

    ``with_lists`` adds comma lists of direct and all downstream names,
    sorted. A list gathers a node's whole downstream set into one row, so
    use it for model-sized graphs only; the counts are always distributed.
    ``condense`` works on the graph of strong components: for graphs with long
    cycles, whose pairs grow with the square of their length. Counts are the same;
    the depth then takes a cycle as one level.
    """
    if with_lists and condense:
        raise ValueError("lists name every pair, which condensing spares")
    every_end = nodes is None
    if every_end:  # every endpoint is a node: only the name patterns can drop an edge
        ok = lambda c: F.col(c).isNotNull() & ~_excluded(F.col(c), exclude_patterns)
        inside = ok("parent") & ok("child")
        ends = lambda c, parent: edges.select(F.col(c).alias("name"), parent.alias("parent"))
        nodes = ends("parent", inside).unionByName(ends("child", F.lit(False))).filter(ok("name"))
        edges = edges.filter(inside)
    else:
        nodes = keep_nodes(nodes, exclude_patterns)
    kept, hashed = number_nodes(nodes)
    links = kept_edges(edges, kept, hashed, every_end)
    if not (condense and every_end):
        links = reliable_checkpoint(links)
    if condense:
        parents = kept.filter("parent").select("id") if every_end else links.select(F.col("u").alias("id")).distinct()
        links = reliable_checkpoint(links.join(parents.select(F.col("id").alias("v"), F.lit(True).alias("open")), "v", "left")
                                    .select("u", "v", F.coalesce("open", F.lit(False)).alias("open")))
        stats = _condensed_reach(links, links.groupBy(F.col("u").alias("id")).agg(F.count(F.lit(1)).alias("direct")))
    else:
        closure = transitive_closure(links)
        lists = []
        if with_lists:
            closure = closure.join(kept.select(F.col("id").alias("dst"), F.col("name").alias("dst_name")), "dst")
            lists = [F.array_join(F.sort_array(F.collect_list(F.when(F.col("depth") == 1, F.col("dst_name")))), ", ")
                     .alias("direct_downstream_models"),
                     F.array_join(F.sort_array(F.collect_list("dst_name")), ", ").alias("all_downstream_models")]
        # level 1 of the closure is the edge set: direct and total counts from one aggregation
        stats = closure.groupBy(F.col("src").alias("id")).agg(
            F.count(F.when(F.col("depth") == 1, F.lit(1))).alias("direct"), F.count(F.lit(1)).alias("total"),
            F.max("depth").alias("depth"), *lists)
    j = kept.join(stats, "id", "left")
    d = F.coalesce(F.col("direct"), F.lit(0)).cast("bigint")
    t = F.coalesce(F.col("total"), F.lit(0)).cast("bigint")
    depth = F.coalesce(F.col("depth"), F.lit(0)).cast("int")
    lists = ([F.coalesce(F.col("direct_downstream_models"), F.lit("")).alias("direct_downstream_models"),
              F.coalesce(F.col("all_downstream_models"), F.lit("")).alias("all_downstream_models")]
             if with_lists else [])
    ts = F.localtimestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp_ntz")
    return j.select(
        F.col("name").alias("model_name"), d.alias("direct_downstream_count"),
        t.alias("total_downstream_count"), *lists,
        tier(t, *CRITICALITY).alias("model_criticality"), depth.alias("max_downstream_depth"),
        tier(t, *IMPACT_LEVEL).alias("downstream_impact_level"),
        _description(t, depth).alias("impact_description"),
        (tier(t, *RISK_BASE) + F.least(depth, F.lit(RISK_DEPTH_CAP))).alias("change_risk_score"),
        tier(t, *BUSINESS).alias("business_impact_category"),
        tier(d, *FANOUT).alias("fanout_pattern"), tier(depth, *CHAIN).alias("chain_pattern"),
        ts.alias("analyzed_at"))


def order_impact(report: DataFrame) -> DataFrame:
    """O3: most critical first, ties by name."""
    return report.orderBy(F.col("total_downstream_count").desc(), F.col("model_name"))
