"""Connected components by contraction, for graphs whose components may be very large."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.session import stage


def components(edges: DataFrame) -> DataFrame:
    """node and root (smallest node of its component) for every node in ``edges`` (a, b).

    In each round a node with a smaller neighbour hooks on to the smallest one,
    hooks are followed to their ends, and the edges are redrawn between the
    ends. Every component loses at least half of its nodes in a round. Minima
    reduce before the exchange, and a node with very many edges only meets
    single rows in joins, which may be split. Each round is written to the
    shared folder. Edges of a node with itself count as a node without others.
    """
    edges = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct() \
        .select("node", F.col("node").alias("root"))
    edges = edges.filter("a != b")
    while not edges.isEmpty():
        hooks = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        hooks = _follow(stage(hooks, "hooks"))
        labels = stage(_ends(labels, "root", hooks), "labels")
        moved = _ends(_ends(edges, "a", hooks), "b", hooks).filter("a != b")
        edges = stage(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return labels


def _ends(rows: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """``rows`` with ``column`` replaced by what it hooks on to, if anything."""
    to = hooks.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return rows.join(to, F.col(column) == F.col("_node"), "left") \
        .withColumn(column, F.coalesce("_root", column)).drop("_node", "_root")


def _follow(hooks: DataFrame) -> DataFrame:
    """Hooks to the ends of their chains: the length of chains halves twice in a step."""
    while not hooks.join(hooks.select(F.col("node").alias("_node")), F.col("root") == F.col("_node"), "left_semi").isEmpty():
        once = _ends(hooks, "root", hooks)
        hooks = stage(_ends(once, "root", once), "hooks")
    return hooks
