"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgap.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(v, root) for each vertex of ``edges`` (a long, b long): ``root`` is one vertex for all of a component.

    Each round hooks a vertex to its smallest neighbour, follows that pointer once more, and contracts the edges;
    minima are partial aggregates, so a vertex with very many edges is no single task's work. Rounds go on until no
    edge is left between two different vertices.
    """
    e = scratch.keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}_e0")
    roots = e.select(F.col("a").alias("v")).union(e.select("b")).distinct().select("v", F.col("v").alias("root"))
    step = 0
    while not e.isEmpty():
        up = e.groupBy(F.col("b").alias("x")).agg(F.min("a").alias("to"))  # a < b: those without a smaller neighbour are their own parents
        further = up.select(F.col("x").alias("to"), F.col("to").alias("to2"))
        up = scratch.keep(up.join(further, "to", "left").select("x", F.coalesce("to2", "to").alias("to")), f"{name}_p{step}")
        roots = scratch.keep(roots.join(up, roots.root == up.x, "left").select("v", F.coalesce("to", "root").alias("root")), f"{name}_r{step + 1}")
        a, b = up.select(F.col("x").alias("a"), F.col("to").alias("to_a")), up.select(F.col("x").alias("b"), F.col("to").alias("to_b"))
        moved = e.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b")).where("a <> b")
        e = scratch.keep(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}_e{step + 1}")
        scratch.drop(f"{name}_e{step}", f"{name}_p{step}", f"{name}_r{step}")
        step += 1
    return roots
