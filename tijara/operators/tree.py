"""Trees of any depth: the closure of a parent column, and values summed over subtrees.

The closure is one recursive query: every level joins the frontier with the edges, on the parent's id. A row carries the
way it came, so a cycle ends where it would meet a node again instead of running on. Depth is bounded by ``max_depth``;
a deeper tree fails the job rather than losing rows (so do more rows than ``spark.sql.cteRecursionRowLimit``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def closure(nodes: DataFrame, key: str, parent: str, max_depth: int = 100) -> DataFrame:
    """(ancestor_id, descendant_id, depth) of every node and each node above it, itself at depth 0 included.

    NULL ids take no part, and a parent that names no node is none. Rows that repeat an id add their parents: of several
    ways between two nodes the shortest counts. In a cycle every node is above every other one.
    """
    ids = nodes.select(F.col(key).alias("node")).where("node is not null").distinct()
    edges = (nodes.select(F.col(key).alias("node"), F.col(parent).alias("above")).where("node is not null and node != above")
             .distinct().join(ids.select(F.col("node").alias("above")), "above", "left_semi"))
    found = nodes.sparkSession.sql(f"""
        WITH RECURSIVE climb (ancestor_id, descendant_id, depth, way) MAX RECURSION LEVEL {int(max_depth)} AS (
          SELECT node, node, 0, array(node) FROM {{ids}}
          UNION ALL
          SELECT e.above, c.descendant_id, c.depth + 1, array_append(c.way, e.above)
          FROM climb c JOIN {{edges}} e ON e.node = c.ancestor_id
          WHERE NOT array_contains(c.way, e.above))
        SELECT ancestor_id, descendant_id, depth FROM climb""", ids=ids, edges=edges)
    return found.groupBy("ancestor_id", "descendant_id").agg(F.min("depth").alias("depth"))


def subtree_values(tree: DataFrame, rows: DataFrame, key: str, *values: Column) -> DataFrame:
    """``values`` aggregated over the rows whose ``key`` lies in each node's subtree, per ``ancestor_id``."""
    return (rows.join(tree, F.col(key) == F.col("descendant_id"))
            .groupBy("ancestor_id").agg(*values))
