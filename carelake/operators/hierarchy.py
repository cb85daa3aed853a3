"""Bounded recursive expansion along a parent key.

A recursive CTE evaluates its recursive term against the previous level's
rows.  Here a node carries a key and the key of its parent, and each level is
an equi-join of the node table with the level before: ``max_depth`` joins,
whose output is the rows of the next level and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expand_levels(nodes: DataFrame, name: str, key: Column, parent: Column, root_filter: Column,
                  max_depth: int = 1, separator: str = " > ") -> DataFrame:
    """Rows ``(name, root_<name>, level, path)`` for levels 0..max_depth.

    Level 0 holds nodes matching ``root_filter``; level k+1 holds the nodes whose
    ``parent`` equals the ``key`` of a row of level k, itself left out.
    """
    root = "root_" + name
    src = nodes.select(F.col(name), key.alias("_key"), parent.alias("_parent"), root_filter.alias("_is_root"))
    level = src.filter("_is_root").select(
        F.col(name), F.col(name).alias(root), F.lit(0).alias("level"), F.col(name).alias("path"), "_key")
    out = level
    for _ in range(max_depth):
        above = level.select(F.col(name).alias("_above"), root, "level", "path", F.col("_key").alias("_above_key"))
        level = (src.join(above, F.col("_parent") == F.col("_above_key"))
                 .filter(F.col(name) != F.col("_above"))
                 .select(F.col(name), root, (F.col("level") + 1).alias("level"),
                         F.concat(F.col("path"), F.lit(separator), F.col(name)).alias("path"), "_key"))
        out = out.unionByName(level)
    return out.drop("_key")
