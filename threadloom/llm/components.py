"""Connected components of a link table by alternating large-star and
small-star steps.  Each step is an aggregate (with map-side combine) and a
join, so a vertex with very many links is no single task's work; every round is
written to the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.store import Scratch


#: Edges of a task; tables of fewer are not spread over all shuffle partitions.
TASK_EDGES = 20_000
LEAST_TASKS = 8


def _star(edges: DataFrame, smaller: bool, scratch: Scratch, name: str, tasks: int) -> DataFrame:
    """Every vertex u hands its least neighbour (or itself, if less) m to its
    greater neighbours (``smaller`` false) or to its smaller ones and itself."""
    both = edges if smaller else edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written, so that the join below is dealt out on its own and can split a vertex with many links
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = scratch.keep(least.coalesce(tasks), name)
    joined = both.join(least, "u")
    if smaller:  # edges point from the greater to the smaller vertex
        new = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    else:
        new = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return new.where("u <> v").distinct()


def _shape(edges: DataFrame) -> tuple[int, int]:
    """The number of edges, and of vertices that keep them from being stars around
    the smaller ends: those with several smaller ends, or with both kinds of edges."""
    ends = (edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .union(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    seen = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    got = seen.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if(F.expr("up > 1 OR up = 1 AND down = 1"))).first()
    return int(got[0]), int(got[1])


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(u, v): each vertex of ``links`` (a, b) that is not the least of its
    component, with that least vertex."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, step = scratch.keep(edges, f"{name}0"), 0
    while True:
        count, open_ = _shape(edges)
        if not open_:
            return edges
        step, tasks = step + 1, max(LEAST_TASKS, count // TASK_EDGES)
        stars = _star(edges, False, scratch, f"{name}{step}large", tasks)
        stars = scratch.keep(stars.coalesce(tasks), f"{name}{step}stars")
        edges = _star(stars, True, scratch, f"{name}{step}small", tasks)
        edges = scratch.keep(edges.coalesce(tasks), f"{name}{step}")
        scratch.drop(f"{name}{step - 1}")


def extended(merged: DataFrame, more: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``components`` of the links behind ``merged`` (their components) and of
    ``more`` (a, b), a written table: only the least vertices take part again."""
    if more.isEmpty():
        return merged
    for end in ("a", "b"):
        more = more.join(merged.select(F.col("u").alias(end), F.col("v").alias(f"{end}_")), end, "left")
    tops = components(more.select(F.coalesce("a_", "a").alias("a"), F.coalesce("b_", "b").alias("b")), scratch, name)
    over = merged.join(tops.select(F.col("u").alias("v"), F.col("v").alias("top")), "v", "left")
    return scratch.keep(over.select("u", F.coalesce("top", "v").alias("v")).union(tops), f"{name}-all")
