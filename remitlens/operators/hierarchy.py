"""Walk a parent-id hierarchy from its roots by pointer doubling.

Every node row starts with a pointer to its parent at distance 1 (a row without a parent is a root at depth 0).  Each pass
joins the rows still open with the rows of the node they point at and jumps to that row's pointer, adding the distances, so
a pass doubles how far every pointer reaches: ``ceil(log2(max_depth + 2))`` self-joins settle every node within
``max_depth + 1`` levels of a root, where one join per level needs ``max_depth + 1``.  Depths of a chain are contiguous, so
when no settled node lies deeper than ``max_depth`` the nodes still open are never reached from a root: they lie in or under
a loop, or under a parent id that is no node.  Each pass is written to the shared folder, so a lost executor recomputes one
pass at most.  A hot parent only makes one key of the join large; adaptive execution splits it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.session import materialise

MAX_DEPTH = 25

ROOT, OPEN, DANGLING = "root", "open", "dangling"


class RecursionLevelLimitExceeded(ValueError):
    """A node lies deeper below its root than the depth allowed."""


def _start(df: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    nodes = df.select(F.col(id_col).alias("node_id"), F.col(parent_col).alias("parent_id"))
    rooted = F.col("parent_id").isNull()
    return nodes.select(
        "node_id",
        F.when(rooted, F.col("node_id")).otherwise(F.col("parent_id")).alias("pointer"),
        F.when(rooted, 0).otherwise(1).alias("depth"),
        F.when(rooted, F.lit(ROOT)).otherwise(F.lit(OPEN)).alias("state"),
    )


def _jump(state: DataFrame) -> DataFrame:
    """One pass: every open row jumps to the pointer of each row of the node it points at."""
    settled = state.where(F.col("state") != OPEN)
    open_rows = state.where(F.col("state") == OPEN).alias("s")
    target = state.select(
        F.col("node_id").alias("t_node"), F.col("pointer").alias("t_pointer"), F.col("depth").alias("t_depth"), F.col("state").alias("t_state")
    )
    joined = open_rows.join(target, F.col("s.pointer") == F.col("t_node"), "left")
    missing = F.col("t_node").isNull()
    jumped = joined.select(
        "node_id",
        F.when(missing, F.col("pointer")).otherwise(F.col("t_pointer")).alias("pointer"),
        F.when(missing, F.col("depth")).otherwise(F.col("depth") + F.col("t_depth")).alias("depth"),
        F.when(missing, F.lit(DANGLING)).otherwise(F.col("t_state")).alias("state"),
    )
    return settled.unionByName(jumped)


def _walk(df: DataFrame, id_col: str, parent_col: str, passes: int, until_settled: bool = False) -> DataFrame:
    state = materialise(_start(df, id_col, parent_col))
    for _ in range(passes):
        before = state.where(F.col("state") == OPEN).count() if until_settled else None
        if before == 0:
            break
        state = materialise(_jump(state))
        if until_settled and state.where(F.col("state") == OPEN).count() == before:
            break
    return state


def hierarchy(df: DataFrame, id_col: str, parent_col: str, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node_id, root_id, depth) of every row reachable from a row without a parent.

    A root is its own root at depth 0.  A node id held by several rows gives a row for every path, as a walk over the rows
    would.  Nodes in or under a loop, or under a parent id that is no node, give no row (``unreachable`` names them).
    Deeper than ``max_depth`` levels raises ``RecursionLevelLimitExceeded``, never a cut.  An empty table gives no rows.
    """
    passes = math.ceil(math.log2(max_depth + 2))
    state = _walk(df, id_col, parent_col, passes)
    rooted = state.where(F.col("state") == ROOT)
    deepest = rooted.agg(F.max("depth")).first()[0]
    if deepest is not None and deepest > max_depth:
        raise RecursionLevelLimitExceeded(
            f"RECURSION_LEVEL_LIMIT_EXCEEDED: a node lies {deepest} levels or more below its root; at most {max_depth} are allowed"
        )
    return rooted.select("node_id", F.col("pointer").alias("root_id"), "depth")


def unreachable(df: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """(node_id, reason) of every row never reached from a root: ``dangling`` under a parent id that is no node (pointer:
    that id), ``loop`` in or under a loop.  Passes go on until one settles no row, at most log2 of the rows plus one."""
    total = df.count()
    passes = math.ceil(math.log2(total + 2)) + 1
    state = _walk(df, id_col, parent_col, passes, until_settled=True)
    lost = state.where(F.col("state") != ROOT)
    return lost.select(
        "node_id",
        F.when(F.col("state") == DANGLING, F.lit("dangling")).otherwise(F.lit("loop")).alias("reason"),
        F.when(F.col("state") == DANGLING, F.col("pointer")).alias("missing_parent"),
    )
