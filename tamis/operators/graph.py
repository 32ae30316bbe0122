"""Iterations over edge tables: components, reach, chains to a root.

Each round is a join and an aggregation; lineage is cut by a reliable checkpoint, so a lost executor costs a round's tasks and
not the whole loop. Nothing but the number of changed rows comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.session import checkpoint


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """node, component (the least node) by alternating large-star and small-star steps, which end in O(log n) rounds.

    Edges with a null end are left out; a self edge makes a component of its own. Stars shrink hubs, so that a hot node has as
    many edges as its component has nodes at most, each once.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna()
    nodes = e.select(F.col("u").alias("node")).union(e.select("v")).distinct()
    pairs = checkpoint(e.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(rounds):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every greater neighbour, and the node itself, hang on to the least of the neighbourhood
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        # small star: lesser neighbours and the node hang on to the least one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        small = checkpoint(small)
        new = small.join(pairs, ["u", "v"], "left_anti").limit(1).count() + pairs.join(small, ["u", "v"], "left_anti").limit(1).count()
        pairs = small
        if not new:
            break
    return nodes.join(pairs.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").withColumn("component", F.coalesce("component", "node"))


def reach(edges: DataFrame, start: DataFrame, src: str = "src", dst: str = "dst", blocked: DataFrame | None = None, depth: int = 20, limit: int | None = None) -> DataFrame:
    """node, depth, via: breadth-first reach from ``start`` (column node), at most ``depth`` steps.

    ``via`` is the least node of the level before. Nodes in ``blocked`` (column node) are reached but not followed. With
    ``limit`` only the first so many nodes by (depth, node) are followed: a page budget, checked once per level.
    """
    e = edges.select(F.col(src).alias("node"), F.col(dst).alias("next")).dropna().distinct()
    if blocked is not None:
        e = e.join(blocked.select("node").distinct(), "node", "left_anti")
    found = checkpoint(start.select("node").dropna().distinct().select("node", F.lit(0).alias("depth"), F.lit(None).cast(e.schema["node"].dataType).alias("via")))
    front, n = found, found.count()
    for d in range(1, depth + 1):
        if limit is not None:
            if n >= limit:
                break
        step = front.select("node").join(e, "node").groupBy(F.col("next").alias("reached")).agg(F.min("node").alias("via"))
        new = step.join(found.select(F.col("node").alias("reached")), "reached", "left_anti").select(F.col("reached").alias("node"), F.lit(d).alias("depth"), "via")
        if limit is not None:
            new = new.orderBy("node").limit(limit - n)
        front = checkpoint(new)
        added = front.count()
        if not added:
            break
        n += added
        found = checkpoint(found.unionByName(front))
    return found


def roots(links: DataFrame, node: str = "node", parent: str = "parent", rounds: int = 40) -> DataFrame:
    """node, root, steps, cyclic: the end of every chain of parents, by doubling, so a chain of n takes log n rounds.

    One parent per node is followed (the least, if there are several). A node on or above a cycle has cyclic true and no root.
    """
    p = links.select(F.col(node).alias("node"), F.col(parent).alias("up")).dropna().groupBy("node").agg(F.min("up").alias("up"))
    at = checkpoint(p.select("node", "up", F.lit(1).cast("bigint").alias("steps")))
    n = at.count()
    covered = 1
    while covered <= n and rounds:
        nxt = at.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"))
        at = checkpoint(at.join(nxt, "up", "left").select("node", F.coalesce("up2", "up").alias("up"), (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps")))
        covered *= 2
        rounds -= 1
    # whoever still has a parent's entry above itself after more steps than there are nodes goes round
    live = p.select(F.col("node").alias("up"), F.lit(True).alias("cyclic"))
    out = at.join(live, "up", "left").select("node", F.when(F.col("cyclic").isNull(), F.col("up")).alias("root"), F.when(F.col("cyclic").isNull(), F.col("steps")).alias("steps"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"))
    return out


def integrity(parents: DataFrame, children: DataFrame, key: str, child_key: str, links: DataFrame | None = None) -> DataFrame:
    """check, broken: duplicate keys, children without parent, and, with links (node, parent), missing targets and cycles."""
    dup = parents.dropna(subset=[key]).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").agg(F.count("*").alias("broken")).select(F.lit("duplicate_key").alias("check"), "broken")
    orphan = children.filter(F.col(child_key).isNotNull()).join(parents.select(F.col(key).alias(child_key)).distinct(), child_key, "left_anti").agg(F.count("*").alias("broken")).select(F.lit("orphan").alias("check"), "broken")
    out = dup.unionByName(orphan)
    if links is not None:
        missing = links.dropna().join(parents.select(F.col(key).alias("parent")).distinct(), "parent", "left_anti").agg(F.count("*").alias("broken")).select(F.lit("missing_target").alias("check"), "broken")
        cycles = roots(links).filter("cyclic").agg(F.count("*").alias("broken")).select(F.lit("cycle").alias("check"), "broken")
        out = out.unionByName(missing).unionByName(cycles)
    return out
