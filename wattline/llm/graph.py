"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import free, join_groups, stored


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _steps(edges: DataFrame) -> DataFrame:
    """u, n, to: every node, its number of edges, and the smallest neighbour of its smallest neighbour."""
    ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    near = stored(
        ends.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("v")).select("u", "n", F.least("u", "v").alias("p")),
        "near",
    )
    children = near.groupBy("p").agg(F.count("*").alias("n"))
    parents = stored(children.join(near.select(F.col("u").alias("p"), F.col("p").alias("to")), "p"), "parents")
    steps = stored(
        join_groups(near.select("u", "p", F.col("n").alias("edges")), parents, ["p"], ["u"]).select(
            "u", F.col("edges").alias("n"), "to"
        ),
        "steps",
    )
    free(near, parents)
    return steps


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node of ``edges`` (a, b); root is the smallest node of its component.

    Each round moves all nodes one step (see ``_steps``) and keeps the edges between different ends.
    Rounds grow with the logarithm of the longest path; each leaves its result in a stored table.
    Nodes with very many edges are split like any hot key. Null ends and loops are left out; no edges
    give no rows.
    """
    edges = stored(_ordered(edges), "edges")
    labels: DataFrame | None = None
    while not edges.isEmpty():
        steps = _steps(edges)
        moved = join_groups(edges, steps.select(F.col("u").alias("a"), "n", F.col("to").alias("to_a")), ["a"], ["b"])
        moved = join_groups(
            moved.select("b", "to_a"), steps.select(F.col("u").alias("b"), "n", F.col("to").alias("to_b")), ["b"], ["to_a"]
        )
        last, edges = edges, stored(_ordered(moved.select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))), "edges")
        free(last)
        if labels is None:
            labels = stored(steps.select(F.col("u").alias("node"), F.col("to").alias("root")), "labels")
            free(steps)
            continue
        sizes = labels.groupBy("root").agg(F.count("*").alias("n"))
        roots = stored(sizes.join(steps.select(F.col("u").alias("root"), "to"), "root", "left"), "roots")
        before, labels = labels, stored(
            join_groups(labels, roots, ["root"], ["node"]).select("node", F.coalesce("to", "root").alias("root")), "labels"
        )
        free(before, roots, steps)
    if labels is None:
        kind = edges.schema["a"].dataType.simpleString()
        return edges.sparkSession.createDataFrame([], f"node {kind}, root {kind}")
    return labels
