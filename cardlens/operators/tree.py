"""Operators on component trees: closure, visibility, actions, validity, levels, linear layout.

Trees are adjacency lists (node, parent, ...), of any number of documents if ``key`` names one, and
of any depth. Work goes by doubling: in a round every node takes what its pointer's node knows and
points as far again, so a chain of n nodes needs log2(n) rounds. Each round is written to the
shared folder. Cycles are found as such, since their nodes never come to an end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.operators.rounds import saved


def closure(tree: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(key..., node, ancestor, distance) of every node and ancestor, itself included at 0.

    A parent that is no node itself is an ancestor too. In a tree with cycles each ancestor counts
    once for a node, at its least distance. The result has as many rows as all depths together.
    """
    key = key or []
    own = tree.select(*key, "node", F.col("node").alias("ancestor"), F.lit(0).alias("distance"))
    done = saved(tree.filter("parent IS NOT NULL").select(*key, "node", F.col("parent").alias("ancestor"), F.lit(1).alias("distance")))
    parts, frontier, reach = [done], done, 1
    while True:
        known = parts[0]
        for p in parts[1:]:
            known = known.unionByName(p)
        if not frontier.filter("node = ancestor").isEmpty():
            return own.unionByName(_shortest(known, key)).select(*key, "node", "ancestor", "distance")
        above = known.select(*key, F.col("node").alias("via"), "ancestor", F.col("distance").alias("more"))
        steps = frontier.filter(F.col("distance") == reach).select(*key, "node", F.col("ancestor").alias("via"))
        frontier = saved(steps.join(above, [*key, "via"]).select(*key, "node", "ancestor", (F.col("more") + reach).alias("distance")))
        if frontier.isEmpty():
            return own.unionByName(known)
        parts.append(frontier)
        reach *= 2


def _shortest(known: DataFrame, key: list[str]) -> DataFrame:
    """``known`` closed under composition, each pair once with its least distance."""
    pair = [*key, "node", "ancestor"]
    seen = None
    while True:
        known = saved(known.filter("node != ancestor").groupBy(*pair).agg(F.min("distance").alias("distance")))
        state = known.agg(F.count("*"), F.sum("distance")).first()
        if state == seen:
            return known
        seen = state
        above = known.select(*key, F.col("node").alias("via"), "ancestor", F.col("distance").alias("more"))
        longer = known.withColumnRenamed("ancestor", "via").join(above, [*key, "via"]).select(*pair, (F.col("distance") + F.col("more")).alias("distance"))
        known = known.unionByName(longer)


def walked(tree: DataFrame, values: dict[str, tuple[Column, Callable[[Column, Column], Column]]], key: list[str] | None = None) -> DataFrame:
    """(key..., node, ended, values...): what the nodes from each node up to its root add up to.

    ``values``: by name, a node's own value and how it and what is above it combine; that must be
    associative. ``ended`` is false for nodes on a cycle or below one, whose values are partial.
    Rows that repeat a node are walked one by one.
    """
    key, names = key or [], list(values)
    state = saved(tree.select(*key, "node", F.col("parent").alias("up"), *[own.alias(n) for n, (own, _) in values.items()]))
    left = None
    while True:
        pending = state.filter("up IS NOT NULL").count()
        if not pending or pending == left:  # in a tree, every round brings some nodes to their end
            return state.select(*key, "node", F.col("up").isNull().alias("ended"), *names)
        left = pending
        above = state.select(*key, F.col("node").alias("up"), F.col("up").alias("_up"), F.lit(True).alias("_is"), *[F.col(n).alias(f"_{n}") for n in names])
        joined = state.filter("up IS NOT NULL").join(above, [*key, "up"], "left")
        merged = [F.when(F.col("_is"), f(F.col(n), F.col(f"_{n}"))).otherwise(F.col(n)).alias(n) for n, (_, f) in values.items()]
        state = saved(state.filter("up IS NULL").unionByName(joined.select(*key, "node", F.col("_up").alias("up"), *merged)))


def inherited(tree: DataFrame, flag: str, key: list[str] | None = None) -> DataFrame:
    """(key..., node, flag): whether a node or any of its ancestors has ``flag``."""
    key = key or []
    up = walked(tree, {flag: (F.coalesce(F.col(flag), F.lit(False)), lambda a, b: a | b)}, key)
    return up.groupBy(*key, "node").agg(F.bool_or(flag).alias(flag))


def validity(tree: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(key..., node, reason): duplicate ids, several parents, missing parents, unreachable nodes
    (below a missing parent, on a cycle or below one)."""
    key = key or []
    many = tree.groupBy(*key, "node").agg(F.count("*").alias("n"), F.countDistinct("parent").alias("p"))
    twice = many.filter("n > 1 AND p <= 1").select(*key, "node", F.lit("duplicate").alias("reason"))
    parents = many.filter("p > 1").select(*key, "node", F.lit("several parents").alias("reason"))
    ids = tree.select(*key, F.col("node").alias("parent")).distinct()
    orphans = tree.filter("parent IS NOT NULL").join(ids, [*key, "parent"], "left_anti").select(*key, "node", F.lit("missing parent").alias("reason"))
    up = walked(tree, {"reached": (F.col("parent").isNull(), lambda a, b: a | b)}, key)
    lost = up.groupBy(*key, "node").agg(F.bool_or(F.col("reached")).alias("r")).filter("NOT r").select(*key, "node", F.lit("unreachable").alias("reason"))
    return twice.unionByName(parents).unionByName(orphans).unionByName(lost)


def on_cycles(tree: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(key..., node) that are their own ancestors.

    Where a walk up never ends it comes to a cycle within as many steps as there are nodes, and
    from then on stays on it. So the nodes that such walks reach after that many steps, a number
    doubled in each round, are those of the cycles. Nodes with several parents take the closure.
    """
    key = key or []
    links = tree.filter("parent IS NOT NULL").select(*key, "node", F.col("parent").alias("up")).distinct()
    if not links.groupBy(*key, "node").count().filter("count > 1").isEmpty():
        known = _shortest(links.select(*key, "node", F.col("up").alias("ancestor"), F.lit(1).alias("distance")), key)
        both = known.join(known.select(*key, F.col("node").alias("ancestor"), F.col("ancestor").alias("node")), [*key, "node", "ancestor"], "left_semi")
        return both.select(*key, "node").union(links.filter("node = up").select(*key, "node")).distinct()
    endless = walked(tree, {}, key).filter("NOT ended").select(*key, "node").distinct()
    rest = saved(links.join(endless, [*key, "node"], "left_semi"))
    steps, n = 1, rest.count()
    while steps < n:
        rest = saved(rest.join(rest.select(*key, F.col("node").alias("up"), F.col("up").alias("_up")), [*key, "up"]).select(*key, "node", F.col("_up").alias("up")))
        steps *= 2
    return rest.select(*key, F.col("up").alias("node")).distinct()


def fold_up(tree: DataFrame, values: dict[str, tuple[Column, Callable[[Column], Column], Callable[[Column, Column], Column]]], key: list[str] | None = None) -> DataFrame:
    """(key..., node, ended, values...): what a node and all nodes below it add up to.

    ``values``: by name, a node's own value, the aggregate that brings those of several nodes
    together (F.sum, F.max) and the same for two. In a round a node knows all that is fewer than 2^k
    steps below it and gets what the nodes exactly 2^k steps below know, so each counts once and a
    tree of depth d takes log2(d) rounds. ``ended`` is false on and below cycles. A node has one parent.
    """
    key, names = key or [], list(values)
    state = saved(tree.select(*key, "node", F.col("parent").alias("up"), *[own.alias(n) for n, (own, *_) in values.items()]))
    left = None
    while True:
        pending = state.filter("up IS NOT NULL").count()
        if not pending or pending == left:
            return state.select(*key, "node", F.col("up").isNull().alias("ended"), *names)
        left = pending
        given = state.filter("up IS NOT NULL").groupBy(*key, F.col("up").alias("node")).agg(*[agg(F.col(n)).alias(f"_{n}") for n, (_, agg, _) in values.items()])
        above = state.select(*key, F.col("node").alias("up"), F.col("up").alias("_up"))
        joined = state.join(given, [*key, "node"], "left").join(above, [*key, "up"], "left")
        merged = [F.when(F.col(f"_{n}").isNull(), F.col(n)).otherwise(two(F.col(n), F.col(f"_{n}"))).alias(n) for n, (*_, two) in values.items()]
        state = saved(joined.select(*key, "node", F.col("_up").alias("up"), *merged))


def intervals(tree: DataFrame, key: list[str] | None = None, values: dict | None = None) -> DataFrame:
    """(key..., node, first, last, values...): labels by which x is y or below it if and only if
    x.first lies from y.first to y.last, so that ancestry is a comparison inside a join.

    ``first`` is the place of a node in pre-order by ``pos``, ``last`` that of the last node below it.
    ``values`` are folded up in the same rounds (see ``fold_up``). Nodes on or below cycles are left out.
    """
    key = key or []
    one = F.lit(1).cast("long")
    sizes = fold_up(tree, {"_size": (one, F.sum, lambda a, b: a + b)} | (values or {}), key).filter("ended").drop("ended")
    rows = saved(tree.select(*key, "node", "parent", "pos").join(sizes, [*key, "node"]))
    before = Window.partitionBy(*key, "parent").orderBy("pos", "node").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("_own", F.coalesce(F.sum("_size").over(before), F.lit(0)) + 1)
    first = walked(own, {"first": (F.col("_own"), lambda a, b: a + b)}, key).filter("ended").select(*key, "node", "first")
    return rows.join(first, [*key, "node"]).select(*key, "node", "first", (F.col("first") + F.col("_size") - 1).alias("last"), *(values or {}))


def depth_first(tree: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(key..., node, depth, path): pre-order by ``path``, the positions from the root down. Nodes
    on or below a cycle are left out."""
    place = F.lpad(F.col("pos").cast("string"), 8, "0")
    up = walked(tree, {"depth": (F.lit(0), lambda a, b: a + b + 1), "path": (place, lambda a, b: F.concat(b, F.lit("/"), a))}, key)
    return up.filter("ended").drop("ended")


def linear_offsets(children: DataFrame, group: list[str], size: Column, gap: Column | float) -> DataFrame:
    """``children`` with ``offset``: where each starts when they follow one another with a gap."""
    before = Window.partitionBy(*group).orderBy("pos", "node").rowsBetween(Window.unboundedPreceding, -1)
    return children.withColumn("offset", F.coalesce(F.sum(size + gap).over(before), F.lit(0)))


def surface_depth(tree: DataFrame, surface: str, key: list[str] | None = None) -> DataFrame:
    """(key..., node, nested): how many ancestors with the flag a node has, itself included."""
    up = walked(tree, {"nested": (F.coalesce(F.col(surface).cast("long"), F.lit(0).cast("long")), lambda a, b: a + b)}, key)
    return up.filter("ended").drop("ended")
