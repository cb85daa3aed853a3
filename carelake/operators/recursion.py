"""Recursion along edges to a fixpoint.

``walk`` is a recursive CTE without a depth: it follows edges from the roots until a round
reaches nothing new, however deep the graph is.

Evaluation is semi-naive.  Only the rows that the last round added (its frontier) are joined with
the edges, on the edge's parent, and what they reach is anti-joined with everything reached before.
Each round is written below ``folder`` before the next one reads it, so a plan never holds more
than one round, and a lost executor costs a round at most.  A round counts once its
``_SUCCESS`` marker is there: called again with the folder of a broken run, ``walk`` goes on after
the last whole round.

Every row carries its path from the root.  An edge that leads back into the path it extends
closes a cycle: its row is marked and not followed, so cyclic graphs end too.

Scale.  A node that many edges reach in one round is reduced to one row before the shuffle (the
smallest path wins), so a hot child costs no more than others; a hot parent is one frontier row that
meets its many edges in a join that AQE splits, and a small frontier is broadcast by its
measured size.  Rounds are as many as the longest of the shortest paths.  The driver learns of
each round only whether it is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.session import staging_path


def whole(spark: SparkSession, path: str) -> bool:
    """Whether Spark finished writing ``path``."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return marker.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(marker)


def walk(roots: DataFrame, edges: DataFrame, folder: str | None = None, every_path: bool = False,
         max_level: int | None = None) -> DataFrame:
    """Rows ``(root, node, parent, level, path, is_cycle)`` of all that the ``roots`` reach.

    ``roots`` has a column ``node``, ``edges`` have ``parent`` and ``child`` of the same type.  By
    default (UNION) each node is reached once a root, at its lowest level, with the smallest of
    the paths of that level, and rows that close a cycle come once for each (root, parent, node) and level; with
    ``every_path`` (UNION ALL) each path is a row.  Level 0 are the
    roots, whose parent is NULL; rows stop at ``max_level`` if one is given.  Repeated roots
    and edges count once.  Edges with a NULL end, and NULL roots, lead nowhere.
    """
    spark = roots.sparkSession
    folder = (folder or staging_path(spark, "walk")).rstrip("/")
    edge = edges.select(F.col("parent").alias("_from"), F.col("child").alias("_to")).where(
        "_from IS NOT NULL AND _to IS NOT NULL").distinct()
    node = F.col("node")
    rows = roots.select("node").where("node IS NOT NULL").distinct().select(
        node.alias("root"), "node", F.lit(None).cast(roots.schema["node"].dataType).alias("parent"),
        F.lit(0).alias("level"), F.array("node").alias("path"), F.lit(False).alias("is_cycle"))
    schema = rows.schema
    rounds: list[str] = []
    while True:
        path = f"{folder}/round-{len(rounds):06d}"
        if not whole(spark, path):
            rows.write.mode("overwrite").parquet(path)
        rounds.append(path)
        frontier = spark.read.schema(schema).parquet(path).where("NOT is_cycle")
        level = len(rounds)
        if frontier.isEmpty() or (max_level is not None and level > max_level):
            return spark.read.schema(schema).parquet(*rounds)
        if level == 1:
            # the edges are written once beside the rounds: later rounds only read them
            if not whole(spark, f"{folder}/edges"):
                edge.write.mode("overwrite").parquet(f"{folder}/edges")
            edge = spark.read.schema(edge.schema).parquet(f"{folder}/edges")
        step = frontier.join(edge, F.col("node") == F.col("_from")).select(
            "root", F.col("_to").alias("node"), F.col("_from").alias("parent"),
            F.concat("path", F.array("_to")).alias("path"), F.array_contains("path", F.col("_to")).alias("is_cycle"))
        back, new = step.where("is_cycle"), step.where("NOT is_cycle")
        if not every_path:
            back = back.groupBy("root", "node", "parent").agg(F.min("path").alias("path"))
            reached = spark.read.schema(schema).parquet(*rounds).where("NOT is_cycle").select("root", "node")
            new = new.groupBy("root", "node").agg(F.min("path").alias("path")).join(
                reached, ["root", "node"], "left_anti").withColumn("parent", F.element_at("path", -2))
        columns = ("root", "node", "parent", F.lit(level).alias("level"), "path")
        rows = new.select(*columns, F.lit(False).alias("is_cycle")).unionByName(
            back.select(*columns, F.lit(True).alias("is_cycle")))
