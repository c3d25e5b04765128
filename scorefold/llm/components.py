"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once into the shared folder, so that a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def component_labels(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node reachable, for every node with an edge.

    ``edges`` has two columns of one orderable type.  Large-star and small-star
    steps alternate until the edges are stars; both are joins with a minimum per
    node, so a node with very many edges is never gathered.  Self-loops and
    repeated edges are allowed; no edges give no rows.
    """
    a, b = edges.columns
    edges = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Large star: every larger neighbour of a node hangs on the node's smallest neighbour.
        large = (edges.select(F.col("u").alias("x"), F.col("v").alias("u")).join(least, "u")
                 .select(F.col("x").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        # Small star: a node and its smaller neighbours hang on the smallest of them.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(small, "u")
        edges = written(
            star.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v")))
            .where("u != v").distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(
        roots.select("node", F.col("node").alias("label")))
