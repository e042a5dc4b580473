"""Closure of parent-child tables by joins that double their reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.session import stage

TREE, CYCLE, BELOW = "tree", "on a cycle", "below a cycle"


def _climb(start: DataFrame, separator: str) -> tuple[DataFrame, DataFrame]:
    """``start`` (id, up, path; ``up`` is the parent if there is one) to the nodes that meet a root (id, root,
    depth, path) and the ``up`` of the others after the steps of all rounds (id, up).

    Every round joins the frontier, the nodes that have not met their root, with what is known of the
    node they point to, and so doubles the steps they look up: a chain of n levels takes log2(n)
    rounds, and nodes that are done leave.  Who is d steps below a root has an ancestor at each
    smaller number, so when no node meets its root in a round, none will in a later one."""
    none = F.lit(None).cast(start.schema["id"].dataType)
    zero = F.lit(0).cast("long")
    found = start.filter("up IS NULL").select("id", F.col("id").alias("root"), zero.alias("depth"), "path")
    # of the others: the node ``up`` is ``steps`` steps above, the path begins below it
    frontier = start.filter("up IS NOT NULL").select("id", "up", (zero + 1).alias("steps"), "path")
    reach, total = 1, start.count()
    while reach <= total and frontier.head(1):
        settled = found.select(F.col("id").alias("up"), F.col("root"), F.col("depth").alias("more"), F.col("path").alias("above"), none.alias("next"))
        moving = frontier.select(F.col("id").alias("up"), none.alias("root"), F.col("steps").alias("more"), F.col("path").alias("above"), F.col("up").alias("next"))
        joined = stage(frontier.join(settled.unionByName(moving), "up").select(
            "id", "root", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"),
            F.concat("above", F.lit(separator), "path").alias("path")), "closure")
        met = joined.filter("root IS NOT NULL").select("id", "root", F.col("steps").alias("depth"), "path")
        frontier = joined.filter("root IS NULL").select("id", "up", "steps", "path")
        if not met.head(1):
            break
        found = found.unionByName(met)
        reach *= 2
    return found, frontier.select("id", "up")


def _cycles(rootless: DataFrame) -> DataFrame:
    """The nodes (c) on cycles among nodes without a root; ``up`` of each is the same number of steps above.

    What is pointed to gets fewer by each doubling until it is the cycles' own nodes, which only
    change places."""
    seen, number = rootless.select(F.col("up").alias("c")).distinct(), -1
    while (left := seen.count()) != number:
        rootless = stage(rootless.join(rootless.select(F.col("id").alias("up"), F.col("up").alias("next")), "up")
                         .select("id", F.col("next").alias("up")).distinct(), "closure")
        seen, number = rootless.select(F.col("up").alias("c")).distinct(), left
    return seen


def closure(nodes: DataFrame, name: str | None = None, separator: str = " > ") -> DataFrame:
    """``nodes`` (id, parent, ...; unique ids) to id, root, depth (0 at the root), state and, if ``name`` is a
    column, path: the names from the root on.

    A null parent, or one that is no id, makes a root.  Nodes that meet no root are on a cycle or
    below one; their root, depth and path are null.  Who meets a root is found by ids alone, and
    names are joined for those only (rows that are copies meet each copy of their parent): a walk around a cycle would double its path every round, and
    the path of a node in a tree is never longer than the one returned."""
    kind = nodes.schema["id"].dataType
    label = F.col(name).cast("string") if name else F.lit(None).cast("string")
    given = nodes.select(F.col("id"), F.col("parent"), label.alias("path"))
    ids = given.select(F.col("id").alias("p"))
    start = stage(given.join(ids, F.col("parent") == F.col("p"), "left").select("id", F.col("p").alias("up"), "path"), "closure")
    found, rootless = _climb(start.select("id", "up").distinct().withColumn("path", F.lit(None).cast("string")), separator)
    rootless = stage(rootless.distinct(), "closure")
    if name:
        below = start.join(found.select(F.col("id").alias("up")).distinct(), "up", "left_semi")
        found, _ = _climb(start.filter("up IS NULL").unionByName(below), separator)
    # a cycle's own nodes are the roots of what hangs below it
    lost = (start.join(rootless.select(F.col("id").alias("up")).distinct(), "up", "left_semi")
            .join(_cycles(rootless), F.col("id") == F.col("c"), "left")
            .select("id", F.when(F.col("c").isNull(), F.col("up")).alias("up"), F.lit(None).cast("string").alias("path")))
    lost, _ = _climb(stage(lost, "closure"), separator)
    lost = lost.select("id", F.lit(None).cast(kind).alias("root"), F.lit(None).cast("long").alias("depth"), "path",
                       F.when(F.col("depth") == 0, CYCLE).otherwise(BELOW).alias("state"))
    out = found.withColumn("state", F.lit(TREE)).unionByName(lost)
    return out if name else out.drop("path")
