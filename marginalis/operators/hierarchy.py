"""Parent-child links to full hierarchies by pointer doubling (problem 5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, digest


def strip(col: Column) -> Column:
    return F.coalesce(F.regexp_replace(col.cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(""))


def resolve_threads(
    rows: DataFrame,
    scope: str = "source_sha256",
    node: str = "entry_id",
    parent: str = "parent_entry_id",
    is_child: Column | None = None,
) -> DataFrame:
    """Root, depth and path of every node of a forest of unknown depth.

    ``is_child`` says which rows have a parent (null counts as no); others are
    roots of depth 0.  A child whose parent id is blank is a root as well.
    Parents are sought within the same ``scope``.  Returns scope, node (without
    blanks around it), status, root, depth and path, an array of ids from the
    node's root, or the last known ancestor, down to the node:

    - ``ok``: root is the root's id, depth the links to it;
    - ``orphan``: the chain ends at a parent that isn't there: root '', depth
      the links, the broken one included;
    - ``cycle``: on a loop or below one: root '', depth -1, path empty.

    Rows without a node id are left out.  Of several rows with one id in one
    scope the one with the smallest parent id counts, a root before a child.
    Empty tables give no rows; further columns are not looked at.

    Plan: children hold (ancestor, distance, path to it).  Each round joins
    them with the state of their ancestor, which doubles the distance, until
    all have met a root or a gap.  Only unresolved nodes take part in a round;
    each round's nodes are written to the checkpoint folder.  A node that has
    gone 2^r links and is still under way has 2^r nodes resolved or not behind
    it, so once 2^r reaches the number of unresolved nodes of any scope plus
    the distance already gone when that was counted, the rest are cycles.
    """
    child = F.coalesce(is_child if is_child is not None else F.lit(True), F.lit(False))
    base = rows.select(strip(F.col(scope)).alias("scope"), strip(F.col(node)).alias("node"), F.when(child, F.nullif(strip(F.col(parent)), F.lit(""))).alias("parent"))
    nodes = (
        base.where("node <> ''")
        .groupBy("scope", "node")
        .agg(F.min(F.coalesce("parent", F.lit(""))).alias("parent"))
        .select("scope", "node", digest("scope", "node").alias("id"), F.nullif("parent", F.lit("")).alias("parent"))
    )
    nodes = cut(nodes.withColumn("up", F.when(F.col("parent").isNotNull(), digest("scope", "parent"))))
    roots = nodes.where("up is null").select("scope", "node", F.lit("ok").alias("status"), F.col("node").alias("root"), F.lit(0).cast("long").alias("depth"), F.array("node").alias("path"))
    children = nodes.where("up is not null")
    # status: null while under way; then ok / orphan. root and path are those from the ancestor on.
    met = nodes.select(F.col("id").alias("up"), F.col("node").alias("up_node"), F.col("up").isNull().alias("up_root"))
    first = children.join(met, "up", "left").select(
        "id", "scope", "node", "up",
        F.when(F.col("up_root").isNull(), "orphan").when(F.col("up_root"), "ok").alias("status"),
        F.when(F.col("up_root"), F.col("up_node")).otherwise("").alias("root"),
        F.lit(1).cast("long").alias("depth"),
        F.when(F.col("up_root"), F.array("up_node", "node")).otherwise(F.array("node")).alias("path"),
    )
    state = cut(first)
    done, active = [state.where("status is not null")], state.where("status is null")
    gone, bound = 1, None
    while True:
        largest = active.groupBy("scope").count().agg(F.max("count")).first()[0]
        if largest is None:
            break
        bound = min(bound or largest + gone, largest + gone)
        if gone >= bound:
            break
        # an ancestor is a child itself: still under way, or resolved in any earlier round
        ahead = reduce(DataFrame.unionByName, [active, *done]).select(
            F.col("id").alias("up"), F.col("up").alias("up2"), F.col("status").alias("s2"), F.col("root").alias("r2"), F.col("depth").alias("d2"), F.col("path").alias("p2")
        )
        state = cut(
            active.drop("status", "root").join(ahead, "up").select(
                "id", "scope", "node", F.col("up2").alias("up"), F.col("s2").alias("status"), F.col("r2").alias("root"),
                (F.col("depth") + F.col("d2")).alias("depth"), F.concat("p2", "path").alias("path"),
            )
        )
        done.append(state.where("status is not null"))
        active = state.where("status is null")
        gone *= 2
    cycles = active.select(
        "scope", "node", F.lit("cycle").alias("status"), F.lit("").alias("root"), F.lit(-1).cast("long").alias("depth"), F.array().cast("array<string>").alias("path")
    )
    out = roots.unionByName(cycles)
    for part in done:
        out = out.unionByName(part.select("scope", "node", "status", "root", "depth", "path"))
    return out


def descendants(threads: DataFrame) -> DataFrame:
    """(scope, ancestor, node, distance) for every node below another.

    ``threads`` is the result of ``resolve_threads``; each path is unrolled
    into the ancestors it names, so the size is the sum of the depths.
    """
    return (
        threads.where("size(path) > 1")
        .select("scope", "node", F.size("path").alias("n"), F.posexplode(F.slice("path", 1, F.size("path") - 1)).alias("i", "ancestor"))
        .select("scope", "ancestor", "node", (F.col("n") - 1 - F.col("i")).cast("long").alias("distance"))
    )
