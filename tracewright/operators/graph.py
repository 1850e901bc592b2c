"""Graphs as node and edge tables: components, closure, peeling, coverage, degrees."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.storage import dropped, written

#: Edges, counted first, that one task searches by itself.
LOCAL_EDGES = 100_000


def endpoints(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    return edges.select(F.explode(F.array(src, dst)).alias("node")).distinct()


def dangling(nodes: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    return endpoints(edges, src, dst).join(nodes.select("node"), "node", "left_anti")


def strong_components(edges: DataFrame, src: str = "src", dst: str = "dst", local: int = LOCAL_EDGES) -> DataFrame:
    """(node, component) of the nodes on cycles: component is the least node that is on a common cycle, or the node itself at a loop.

    Nodes without edges into or out of them are trimmed; then every node takes the colour of the greatest node that leads to
    it, and among nodes of one colour that of the greatest one it leads to. Nodes whose two colours agree are a component: all
    that are on cycles with the node that gives the colour. They go, edges between colours go, and the rest is coloured again.
    Greatest is by hashes drawn anew each round, and colours jump (a colour's own colour is taken too), so rounds grow with the
    logarithm of the longest path, whatever its shape. Each step's table is written; at most ``local`` edges, counted first,
    are searched in one task. Null ends are no edges; repeated edges count once; an empty table gives none.
    """
    pairs = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).filter("src IS NOT NULL AND dst IS NOT NULL").distinct()
    pairs = written(pairs, "edges")
    loops = pairs.filter("src = dst").select(F.col("src").alias("node"), F.col("src").alias("c"))
    live, found, rounds = written(pairs.filter("src <> dst"), "live"), [], 0
    while n := live.count():
        if n <= local:
            found.append(written(_searched(live), "found"))
            break
        ends = live.select(F.col("src").alias("node")).intersect(live.select(F.col("dst").alias("node")))
        ends = written(ends, "ends")
        inner = written(_both_in(live, ends), "inner")
        dropped(live, ends)
        forward = _colours(inner, rounds)
        own = forward.select(F.col("node").alias("src"), F.col("colour").alias("a")), forward.select(F.col("node").alias("dst"), F.col("colour").alias("b"))
        same = written(inner.join(own[0], "src").join(own[1], "dst").filter("a.node = b.node").select("src", "dst"), "same")
        backward = _colours(same.select(F.col("dst").alias("src"), F.col("src").alias("dst")), rounds)
        agreed = forward.join(backward.select("node", F.col("colour.node").alias("back")), "node").filter("colour.node = back")
        part = written(agreed.select("node", F.col("back").alias("c")), "found")
        # a component agrees in both colours, so edges between different ones go as well
        led = backward.join(part, "node", "left_anti").select("node", F.col("colour.node").alias("to"))
        ends = led.select(F.col("node").alias("src"), F.col("to").alias("a")), led.select(F.col("node").alias("dst"), F.col("to").alias("b"))
        live = written(same.join(ends[0], "src").join(ends[1], "dst").filter("a = b").select("src", "dst"), "live")
        dropped(inner, same, forward, backward)
        found.append(part)
        rounds += 1
    out = loops
    for part in found:
        out = out.unionByName(part)
    # a loop's node may be on longer cycles too, which then name the component; a node alone is on none
    named = out.groupBy("node").agg(F.max_by("c", F.col("c") != F.col("node")).alias("c"))
    least = named.groupBy("c").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("n"))
    kept = named.join(least, "c").join(loops.select("node", F.lit(True).alias("loop")), "node", "left").filter("n > 1 OR loop")
    result = written(kept.select("node", "component"), "components")
    dropped(pairs, live, *found)
    return result


def _both_in(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    return edges.join(nodes.select(F.col("node").alias("src")), "src", "left_semi").join(nodes.select(F.col("node").alias("dst")), "dst", "left_semi").select("src", "dst")


def _colours(edges: DataFrame, seed: int, first: DataFrame | None = None) -> DataFrame:
    """(node, colour): the greatest (rank, node) of the nodes that lead to a node, itself included. Ranks are hashes; nodes of ``first`` rank above all others."""
    ranked = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    rank = F.xxhash64("node", F.lit(seed))
    if first is not None:
        ranked = ranked.join(first.select("node", F.lit(True).alias("first")), "node", "left")
        rank = F.when(F.col("first"), F.lit(2**63 - 1)).otherwise(F.least(rank, F.lit(2**63 - 2)))
    now = written(ranked.select("node", F.struct(rank.alias("rank"), "node").alias("colour")), "colours")
    while True:
        came = edges.join(now.select(F.col("node").alias("src"), "colour"), "src").groupBy(F.col("dst").alias("node")).agg(F.max("colour").alias("came"))
        stepped = now.join(came, "node", "left").select("node", F.col("colour").alias("was"), F.greatest("colour", "came").alias("colour"))
        further = now.select(F.col("node").alias("via"), F.col("colour").alias("further"))
        jumped = stepped.withColumn("via", F.col("colour.node")).join(further, "via").select("node", F.greatest("colour", "further").alias("colour"), (F.greatest("colour", "further") != F.col("was")).alias("moved"))
        after = written(jumped, "colours")
        dropped(now)
        now = after.select("node", "colour")
        if after.filter("moved").isEmpty():
            return after


def _searched(edges: DataFrame) -> DataFrame:
    """(node, c) of a graph that one task holds: depth-first search with low links."""
    kind = edges.schema["src"].dataType.simpleString()

    def work(batches):
        after: dict = {}
        for batch in batches:
            for a, b in zip(batch["src"].tolist(), batch["dst"].tolist(), strict=True):
                after.setdefault(a, []).append(b)
                after.setdefault(b, [])
        place, low, stack, held, names = {}, {}, [], set(), []
        for root in after:
            going = [] if root in place else [(root, iter(after[root]))]
            if going:
                place[root] = low[root] = len(place)
                stack.append(root)
                held.add(root)
            while going:
                node, rest = going[-1]
                for other in rest:
                    if other not in place:
                        place[other] = low[other] = len(place)
                        stack.append(other)
                        held.add(other)
                        going.append((other, iter(after[other])))
                        break
                    if other in held:
                        low[node] = min(low[node], place[other])
                else:
                    going.pop()
                    if going:
                        low[going[-1][0]] = min(low[going[-1][0]], low[node])
                    if low[node] == place[node]:
                        at = len(stack) - 1
                        while stack[at] != node:
                            at -= 1
                        own, stack[at:] = stack[at:], []
                        held.difference_update(own)
                        names += [(x, own[0]) for x in own]
        yield pd.DataFrame(names, columns=["node", "c"])

    return edges.select("src", "dst").coalesce(1).mapInPandas(work, f"node {kind}, c {kind}")


def cycle_witnesses(edges: DataFrame, components: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(component, nodes, from_node, to_node): how many nodes a component has, and its least edge, which is on a cycle."""
    rows = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    both = rows.join(components.select(F.col("node").alias("src"), F.col("component").alias("a")), "src").join(components.select(F.col("node").alias("dst"), F.col("component").alias("b")), "dst").filter("a = b")
    edge = both.groupBy(F.col("a").alias("component")).agg(F.min(F.struct("src", "dst")).alias("e"))
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("nodes"))
    return sizes.join(edge, "component").select("component", "nodes", F.col("e.src").alias("from_node"), F.col("e.dst").alias("to_node"))


def downstream(edges: DataFrame, nodes: DataFrame, src: str = "src", dst: str = "dst", local: int = LOCAL_EDGES) -> DataFrame:
    """(node): the given nodes and all that they lead to.

    Colours as in ``strong_components``, the given nodes ranking above all others, so rounds grow with the logarithm of the
    paths; at most ``local`` edges, counted first, are followed in one task.
    """
    pairs = written(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).filter("src IS NOT NULL AND dst IS NOT NULL").distinct(), "edges")
    first = written(nodes.select("node").distinct(), "first")
    if pairs.count() <= local:
        marked = pairs.join(first.select(F.col("node").alias("src"), F.lit(True).alias("first")), "src", "left")
        reached = written(_followed(marked), "downstream")
    else:
        coloured = _colours(pairs, 0, first)
        reached = written(coloured.filter(F.col("colour.rank") == 2**63 - 1).select("node"), "downstream")
        dropped(coloured)
    return reached.union(first).distinct()


def _followed(edges: DataFrame) -> DataFrame:
    """(node): what the edges' marked beginnings lead to, in a graph that one task holds."""

    def work(batches):
        after, seen = {}, set()
        for batch in batches:
            for a, b, begins in zip(batch["src"].tolist(), batch["dst"].tolist(), batch["first"].tolist(), strict=True):
                after.setdefault(a, []).append(b)
                if begins:
                    seen.add(a)
        going = list(seen)
        while going:
            new = set(after.get(going.pop(), ())) - seen
            seen |= new
            going += new
        yield pd.DataFrame({"node": pd.Series(list(seen))})

    return edges.select("src", "dst", "first").coalesce(1).mapInPandas(work, f"node {edges.schema['src'].dataType.simpleString()}")


def peel(edges: DataFrame, src: str = "src", dst: str = "dst", local: int = LOCAL_EDGES) -> DataFrame:
    """Nodes that are left when nodes without incoming edges are taken away again and again: cycles and all that follows them."""
    cyclic = strong_components(edges, src, dst, local)
    if cyclic.isEmpty():
        return cyclic.select("node")
    return downstream(edges, cyclic, src, dst, local)


def has_cycle(edges: DataFrame, src: str = "src", dst: str = "dst") -> bool:
    return not strong_components(edges, src, dst).isEmpty()


def closure(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(src, dst): all pairs of which the first leads to the second. Edges with a cycle are refused.

    Semi-naive: a round joins only the pairs that the round before found, with all known ones, on either side, so paths double in
    length. Null ends are no edges.
    """
    known = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).filter("src IS NOT NULL AND dst IS NOT NULL").distinct()
    fresh = known = written(known, "closure")
    while True:
        if not fresh.filter("src = dst").isEmpty():
            raise ValueError("the edges have a cycle through " + str(fresh.filter("src = dst").first()["src"]))
        onward = lambda a, b: a.withColumnRenamed("dst", "via").join(b.withColumnRenamed("src", "via"), "via").select("src", "dst")
        both = onward(fresh, known) if fresh is known else onward(fresh, known).union(onward(known, fresh))
        more = written(both.distinct().join(known, ["src", "dst"], "left_anti"), "fresh")
        if more.isEmpty():
            return known
        after = written(known.union(more), "closure")
        dropped(known, *([fresh] if fresh is not known else []))
        known, fresh = after, more


def graph_coverage(nodes: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """One row: nodes, edges, participants, roots (nodes that are no target, isolated ones too) and isolated nodes."""
    state = nodes.select("node").distinct()
    state = state.join(edges.select(F.col(dst).alias("node"), F.lit(True).alias("into")).distinct(), "node", "left")
    state = state.join(edges.select(F.col(src).alias("node"), F.lit(True).alias("out")).distinct(), "node", "left")
    counts = state.agg(
        F.count(F.lit(1)).alias("nodes"),
        F.count_if(F.col("into").isNotNull() | F.col("out").isNotNull()).alias("participants"),
        F.count_if(F.col("into").isNull()).alias("roots"),
        F.count_if(F.col("into").isNull() & F.col("out").isNull()).alias("isolated"),
    )
    return counts.crossJoin(edges.agg(F.count(F.lit(1)).alias("edges")))  # one row each


def attach_edges(edges: DataFrame, edge_id: str, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, edge): each edge at both its ends, once at a loop."""
    return edges.select(F.explode(F.array_distinct(F.array(src, dst))).alias("node"), F.col(edge_id).alias("edge")).distinct()


def degree(nodes: DataFrame, edges: DataFrame, edge_id: str, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, degree): distinct edges that touch a node, zero included."""
    counted = attach_edges(edges, edge_id, src, dst).groupBy("node").agg(F.count(F.lit(1)).alias("_n"))
    return nodes.select("node").join(counted, "node", "left").select("node", F.coalesce("_n", F.lit(0)).cast("long").alias("degree"))


def neighbours(edges: DataFrame, labels: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, direction, other, label) of each edge from both its ends; a node without label shows its id."""
    both = edges.select(F.col(src).alias("node"), F.lit("after").alias("direction"), F.col(dst).alias("other")).union(edges.select(F.col(dst), F.lit("before"), F.col(src)))
    return both.join(labels.select(F.col("node").alias("other"), "label"), "other", "left").select("node", "direction", "other", F.coalesce("label", F.col("other").cast("string")).alias("label"))
