"""Levels of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import checkpointed, scratch_path
from tallyloom.sources import folders


def dag_levels(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Level of each node: the length of the longest path that leads to it.

    ``edges`` has src and dst, ``nodes`` has id. Nodes without edges get level 0. Nodes on a cycle, or behind one, get
    null.

    Each round settles one level: the nodes whose incoming edges all start at settled nodes. Settled edges are counted
    per target, pre-summed, so a node with a great many edges is no one task's work. A round writes the nodes it settles
    and those still open to the shared folder, and only the open ones are carried on. There are as many rounds as levels.
    """
    spark = edges.sparkSession
    base = scratch_path(spark, "levels")
    links = checkpointed(spark, edges.select("src", "dst").distinct(), "edges")
    kind = links.schema["src"].dataType
    stored = T.StructType(
        [T.StructField("id", kind), T.StructField("open", T.LongType()), T.StructField("level", T.IntegerType()), T.StructField("settled", T.BooleanType())]
    )
    rounds = spark.read.schema(stored).option("basePath", base)

    def write_round(rows: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
        """Nodes with their number of open edges, stored; returns those settled now and those still open."""
        path = f"{base}/level={level}"
        rows.select("id", "open", (F.col("open") == 0).alias("settled")).write.partitionBy("settled").parquet(path)
        written = rounds.parquet(path)
        return written.filter("settled").select("id"), written.filter("not settled").select("id", "open")

    incoming = links.groupBy("dst").agg(F.count(F.lit(1)).alias("open"))
    ids = nodes.select("id").union(links.select("src")).union(links.select("dst")).distinct()
    first = ids.join(incoming, ids["id"] == incoming["dst"], "left").select("id", F.coalesce("open", F.lit(0)).alias("open"))
    level = 0
    frontier, waiting = write_round(first, level)
    while not frontier.isEmpty() and not waiting.isEmpty():
        closed = links.join(frontier.withColumnRenamed("id", "src"), "src", "left_semi").groupBy("dst").agg(F.count(F.lit(1)).alias("closed"))
        left = waiting.join(closed, waiting["id"] == closed["dst"], "left").select(
            "id", (F.col("open") - F.coalesce("closed", F.lit(0))).alias("open")
        )
        frontier, still_waiting = write_round(left, level + 1)
        folders.delete(spark, f"{base}/level={level}/settled=false")
        level, waiting = level + 1, still_waiting
    settled = rounds.parquet(base).filter("settled").select("id", "level")
    return settled.union(waiting.select("id", F.lit(None).cast("int")))
