"""Graph operators over edge tables (source, target): cycles, chains, paths, nearest ancestors."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch

#: Edges that one task may hold for the cycle kernel; larger cores are closed by joins.
KERNEL_EDGES = 5_000_000


def strong_components(edges: list[tuple[int, int]]) -> dict[int, int]:
    """Node -> smallest node of its strongly connected component, without recursion (two passes in finishing order)."""
    out: dict[int, list[int]] = {}
    back: dict[int, list[int]] = {}
    for a, b in edges:
        out.setdefault(a, []).append(b)
        back.setdefault(b, []).append(a)
    seen, order = set(), []
    for start in out.keys() | back.keys():
        if start in seen:
            continue
        seen.add(start)
        stack = [(start, iter(out.get(start, ())))]
        while stack:
            node, following = stack[-1]
            for nxt in following:
                if nxt not in seen:
                    seen.add(nxt)
                    stack.append((nxt, iter(out.get(nxt, ()))))
                    break
            else:
                order.append(node)
                stack.pop()
    of: dict[int, int] = {}
    for start in reversed(order):
        if start in of:
            continue
        members, todo = [], [start]
        of[start] = start
        while todo:
            node = todo.pop()
            members.append(node)
            for nxt in back.get(node, ()):
                if nxt not in of:
                    of[nxt] = start
                    todo.append(nxt)
        least = min(members)
        of.update(dict.fromkeys(members, least))
    return of


def shortest_path(edges: dict[int, list[int]], start: int, goal: int, without: tuple[int, int] | None = None) -> list[int]:
    """Nodes of a shortest path, smaller nodes first among equals; [start, goal] if there is none."""
    from collections import deque

    came, queue = {start: None}, deque([start])
    while queue:
        node = queue.popleft()
        for nxt in sorted(edges.get(node, ())):
            if (node, nxt) != without and nxt not in came:
                came[nxt] = node
                queue.append(nxt)
                if nxt == goal:
                    path = [goal]
                    while came[path[-1]] is not None:
                        path.append(came[path[-1]])
                    return path[::-1]
    return [start, goal]


def core(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """Edges left when those that start at a node without in-edges or end at one without out-edges are peeled off, and
    their number. What is on a cycle always stays."""
    now = scratch.cut(edges.select("source", "target").distinct())
    size = now.count()
    while size:
        ends, starts = now.select(F.col("target").alias("source")).distinct(), now.select(F.col("source").alias("target")).distinct()
        after = scratch.cut(now.join(ends, "source", "left_semi").join(starts, "target", "left_semi"))
        left = after.count()
        scratch.drop(now)
        if left == size:
            return after, size
        now, size = after, left
    return now, 0


def cyclic_nodes(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes that lie on a cycle, a self-loop included; component is its smallest node."""
    scratch = Scratch(spark, "cycles")
    left, size = core(edges, scratch)
    if size > KERNEL_EDGES:
        return coloured_components(spark, left)

    def run(batches):
        import pyarrow as pa

        pairs = [p for b in batches for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        of = strong_components(pairs)
        on = sorted({a for a, b in pairs if of[a] == of[b]})
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int64()), pa.array([of[a] for a in on], pa.int64())], names=["node", "component"])

    return left.select(F.col("source").cast("long"), F.col("target").cast("long")).coalesce(1).mapInArrow(run, "node long, component long")


def coloured_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """The same in joins alone, for cores too large for one task: colouring forward, searching back.

    Every node takes the smallest node that reaches it as its colour. What reaches that node back within its colour is its
    component, which is taken out, and so on with the rest, without what has come to lie on no cycle. Each round is a
    map-side-combined minimum or a semi-join over edges; nothing is ever larger than the edges.
    """
    scratch = Scratch(spark, "colours")
    found = None
    left, size = core(edges, scratch)
    while size:
        colours = scratch.cut(left.select(F.col("source").alias("node")).unionByName(left.select(F.col("target").alias("node"))).distinct().select("node", F.col("node").alias("colour")))
        changed = True
        while changed:
            come = left.join(colours, F.col("source") == F.col("node")).select(F.col("target").alias("node"), "colour")
            after = colours.unionByName(come).groupBy("node").agg(F.min("colour").alias("least"))
            after = scratch.cut(after.join(colours, "node").select("node", F.col("least").alias("colour"), (F.col("least") < F.col("colour")).alias("moved")))
            changed = not after.filter("moved").isEmpty()
            scratch.drop(colours)
            colours = after.drop("moved")
        of = lambda end: colours.select(F.col("node").alias(end), F.col("colour").alias(f"{end}_colour"))
        inner = scratch.cut(left.join(of("source"), "source").join(of("target"), "target").filter("source_colour = target_colour").select("source", "target", F.col("source_colour").alias("colour")))
        members = scratch.cut(colours.filter("node = colour"))
        front = members
        while not front.isEmpty():
            back = inner.join(front.select(F.col("node").alias("target"), "colour"), ["target", "colour"]).select(F.col("source").alias("node"), "colour").distinct()
            front = scratch.cut(back.join(members, ["node", "colour"], "left_anti"))
            members = scratch.cut(members.unionByName(front))
        # A colour's own node is on a cycle only if it has company or a loop.
        loops = inner.filter("source = target").select("colour")
        many = members.groupBy("colour").agg(F.count("*").alias("n")).filter("n > 1").select("colour").unionByName(loops).distinct()
        cyclic = scratch.cut(members.join(many, "colour", "left_semi").select(F.col("node").cast("long").alias("node"), F.col("colour").cast("long").alias("component")))
        found = cyclic if found is None else found.unionByName(cyclic)
        gone = members.select(F.col("node").alias("_node"))
        rest = left.join(gone, F.col("source") == F.col("_node"), "left_anti").join(gone, F.col("target") == F.col("_node"), "left_anti")
        left, size = core(rest, scratch)
    return spark.createDataFrame([], "node long, component long") if found is None else found


def cycle_edges(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """The rows of edges whose ends lie in one cyclic component."""
    on = Scratch(spark, "on-cycle").cut(cyclic_nodes(spark, edges))
    a, b = on.select(F.col("node").alias("source"), "component"), on.select(F.col("node").alias("target"), F.col("component").alias("_c"))
    return edges.join(a, "source").join(b, "target").filter(F.col("component") == F.col("_c")).drop("_c")


def remove_new_cycles(spark: SparkSession, edges: DataFrame, is_new: str = "is_new", chains: bool = True) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): every new edge inside a cyclic component goes. removed has chain: the nodes of a shortest way back
    from target to source without that edge."""
    bad = cycle_edges(spark, edges).filter(F.col(is_new))
    keys = bad.select("source", "target").distinct()
    kept = edges.join(keys.withColumn(is_new, F.lit(True)), ["source", "target", is_new], "left_anti")
    if not chains:
        return kept, bad
    inside = cycle_edges(spark, edges).select("source", "target", "component", is_new)

    def run(key, table):
        import pyarrow as pa

        rows = list(zip(*(table.column(c).to_pylist() for c in ("source", "target", is_new)), strict=True))
        out: dict[int, list[int]] = {}
        for a, b, _ in rows:
            out.setdefault(a, []).append(b)
        new = sorted({(a, b) for a, b, n in rows if n})
        found = [shortest_path(out, b, a, (a, b)) if a != b else [a, a] for a, b in new]
        return pa.table({"source": pa.array([a for a, _ in new], pa.int64()), "target": pa.array([b for _, b in new], pa.int64()), "chain": pa.array(found, pa.list_(pa.int64()))})

    typed = inside.select(F.col("source").cast("long"), F.col("target").cast("long"), F.col("component").cast("long"), is_new)
    return kept, typed.groupBy("component").applyInArrow(run, "source long, target long, chain array<long>")


def residual_cycles(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(component, n_nodes) of every cyclic component."""
    return cyclic_nodes(spark, edges).groupBy("component").agg(F.count("*").alias("n_nodes"))


def one_cycle(nodes_edges: list[tuple[int, int]]) -> list[int]:
    """A cycle of one cyclic component, from its smallest node on."""
    out: dict[int, list[int]] = {}
    for a, b in nodes_edges:
        out.setdefault(a, []).append(b)
    start = min(out)
    if start in out[start]:
        return [start, start]
    return [start, *min((shortest_path(out, n, start) for n in sorted(out[start])), key=len)]


def representative_cycles(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(component, cycle): one cycle of each cyclic component."""

    def run(key, table):
        import pyarrow as pa

        pairs = list(zip(table.column("source").to_pylist(), table.column("target").to_pylist(), strict=True))
        return pa.table({"component": [key[0].as_py()], "cycle": pa.array([one_cycle(pairs)], pa.list_(pa.int64()))})

    inside = cycle_edges(spark, edges).select(F.col("source").cast("long"), F.col("target").cast("long"), F.col("component").cast("long")).distinct()
    return inside.groupBy("component").applyInArrow(run, "component long, cycle array<long>")


def parents(edges: DataFrame, order: str = "id") -> DataFrame:
    """The first target of each source in the given order: (source, target)."""
    return edges.groupBy("source").agg(F.min_by("target", order).alias("target"))


def ancestors(spark: SparkSession, edges: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """(node, ancestor, depth) along first parents, each ancestor once, at its smallest depth.

    Pointer doubling: round k knows the 2^k-th parent of each node and extends all chains by it, so rounds grow with the
    logarithm of the longest chain. A chain that has come back to itself brings nothing new, which ends the rounds.
    starts: (node), default all sources.
    """
    scratch = Scratch(spark, "ancestors")
    up = parents(edges) if "id" in edges.columns else edges.select("source", "target")
    jump = scratch.cut(up.select(F.col("source").alias("_from"), F.col("target").alias("_to")))
    own = jump.select(F.col("_from").alias("node"))
    if starts is not None:
        own = own.join(starts.select("node").distinct(), "node", "left_semi")
    known, count, size = scratch.cut(own.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth"))), None, 1
    while True:
        further = known.join(jump, F.col("ancestor") == F.col("_from")).select("node", F.col("_to").alias("ancestor"), (F.col("depth") + size).alias("depth"))
        after = scratch.cut(known.unionByName(further).groupBy("node", "ancestor").agg(F.min("depth").alias("depth")))
        scratch.drop(known)
        known, before, count = after, count, after.count()
        if count == before:
            return known.filter("node <> ancestor")
        then = jump.select(F.col("_from").alias("_mid"), F.col("_to").alias("_end"))
        after = scratch.cut(jump.join(then, F.col("_to") == F.col("_mid")).select("_from", F.col("_end").alias("_to")))
        scratch.drop(jump)
        jump, size = after, size * 2


def chain(spark: SparkSession, edges: DataFrame, start: int) -> DataFrame:
    """(depth, node) from start up its first parents, start at depth 0."""
    first = spark.createDataFrame([(0, start)], "depth int, node long")
    above = ancestors(spark, edges, first)
    return first.unionByName(above.select(F.col("depth").cast("int").alias("depth"), F.col("ancestor").cast("long").alias("node")))


def find_path(spark: SparkSession, edges: DataFrame, start: int, goal: int) -> list[int] | None:
    """A shortest path over all edges from start to goal, smaller nodes first among equals; None if there is none.

    Breadth first: a round joins the frontier with the edges, and each node is reached once.
    """
    scratch = Scratch(spark, "path")
    if start == goal:
        return [start]
    front = scratch.cut(spark.createDataFrame([(start, [start])], "node long, path array<long>"))
    seen = front.select("node")
    pair = edges.select(F.col("source").cast("long").alias("_s"), F.col("target").cast("long").alias("_t")).distinct()
    for k in itertools.count(1):
        step = front.join(pair, front["node"] == pair["_s"]).select(F.col("_t").alias("node"), F.array_append("path", F.col("_t")).alias("path"))
        front = scratch.cut(step.join(seen, "node", "left_anti").groupBy("node").agg(F.min("path").alias("path")))
        found = front.filter(F.col("node") == goal).select("path").first()
        if found:
            return found["path"]
        if front.isEmpty():
            return None
        seen = seen.unionByName(front.select("node"))
        if k % 16 == 0:
            seen = scratch.cut(seen)


def pictograms(spark: SparkSession, synsets: DataFrame, pictures: DataFrame, relations: DataFrame) -> DataFrame:
    """(synset_id, arasaac_id, via) of every synset: its own picture, else the nearest on its hypernym chain, else one of
    an eq_synonym, else one of a similar synset; via is direct, hypernym, eq_synonym, similar or null."""
    own = pictures.groupBy(F.col("synset_id").alias("node")).agg(F.min("arasaac_id").alias("direct"))
    isa = relations.filter(F.col("type").isin("hypernym", "instance_hypernym"))
    up = ancestors(spark, isa).join(own.withColumnRenamed("node", "ancestor"), "ancestor").groupBy("node").agg(F.min_by("direct", "depth").alias("by_chain"))

    def one_step(kind: str) -> DataFrame:
        links = relations.filter(F.col("type") == kind).select(F.col("source").alias("_s"), "target", "id")
        return links.join(own, F.col("target") == F.col("node")).groupBy(F.col("_s").alias("node")).agg(F.min_by("direct", "id").alias(f"by_{kind}"))

    every = synsets.select(F.col("id").alias("node")).join(own, "node", "left").join(up, "node", "left").join(one_step("eq_synonym"), "node", "left").join(one_step("similar"), "node", "left")
    via = F.when(F.col("direct").isNotNull(), "direct").when(F.col("by_chain").isNotNull(), "hypernym").when(F.col("by_eq_synonym").isNotNull(), "eq_synonym").when(F.col("by_similar").isNotNull(), "similar")
    return every.select(F.col("node").alias("synset_id"), F.coalesce("direct", "by_chain", "by_eq_synonym", "by_similar").alias("arasaac_id"), via.alias("via"))
