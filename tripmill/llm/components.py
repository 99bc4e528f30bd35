"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import cut

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; the component is its smallest node.

    Each round replaces an edge by edges of its ends to the smallest node either end has seen, so
    paths halve and hubs stay stars: the number of edges never grows. Minima are combined before
    each shuffle, and a hub's many neighbours meet its single row in a join that adaptive execution
    may split. Self-loops and repeated edges are allowed; null ends are ignored.
    """
    pairs = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).where("x <> y").distinct()
    labels = cut(_label(pairs))
    for _ in range(ROUNDS):
        # Minimum label over the neighbours, then the label of that label.
        near = (
            pairs.join(labels.select(F.col("node").alias("x"), F.col("component").alias("cx")), "x")
            .join(labels.select(F.col("node").alias("y"), F.col("component").alias("cy")), "y")
            .where("cx <> cy")
        )
        # Hook the larger root under the smaller one.
        hooks = near.select(F.greatest("cx", "cy").alias("root"), F.least("cx", "cy").alias("to"))
        hooks = cut(hooks.groupBy("root").agg(F.min("to").alias("to")))
        if hooks.isEmpty():
            return labels
        labels = cut(_follow(labels, _roots(hooks)))
    raise RuntimeError("components did not settle")


def _label(pairs: DataFrame) -> DataFrame:
    """First labels: the smallest node among a node and its neighbours, pulled to a root."""
    both = pairs.select("x", "y").union(pairs.select("y", "x"))
    first = both.groupBy("x").agg(F.min("y").alias("low"))
    hooks = cut(first.select(F.col("x").alias("root"), F.least("x", "low").alias("to")))
    return _roots(hooks).select(F.col("root").alias("node"), F.col("to").alias("component"))


def _roots(hooks: DataFrame) -> DataFrame:
    """Follow ``root -> to`` until nothing moves; every step doubles the distance covered."""
    for _ in range(ROUNDS):
        target = hooks.select(F.col("root").alias("to"), F.col("to").alias("further"))
        moved = cut(
            hooks.join(target, "to", "left").select("root", F.col("to"), F.coalesce("further", "to").alias("further"))
        )
        done = moved.where("to <> further").isEmpty()
        hooks = moved.select("root", F.col("further").alias("to"))
        if done:
            return hooks
    raise RuntimeError("chains did not settle")


def _follow(labels: DataFrame, roots: DataFrame) -> DataFrame:
    target = roots.select(F.col("root").alias("component"), "to")
    return labels.join(target, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
