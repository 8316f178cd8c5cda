"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``, a stored table; the root is a node of the component.

    Each round every node joins its smallest neighbour, then that one's choice,
    and the edges are rewritten between the joined nodes until none is left.
    Node numbers are hashes, so a round shrinks chains by a constant factor.
    """
    e = edges.where("u <> v").select("u", "v")
    e = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = None
    while not e.isEmpty():
        near = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p"))
        near = stored(near, "near")
        far = near.select(F.col("u").alias("p"), F.col("p").alias("q"))
        step = stored(near.join(far, "p", "left").select("u", F.coalesce("q", "p").alias("p")), "step")
        if found is None:
            found = step.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            again = step.select(F.col("u").alias("root"), "p")
            found = stored(found.join(again, "root", "left").select("node", F.coalesce("p", "root").alias("root")), "roots")
        other = step.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        e = stored(e.join(step, "u").join(other, "v").where("p <> pv").select(F.col("p").alias("u"), F.col("pv").alias("v")).distinct(), "edges")
    return found if found is not None else e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def with_links(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` as they are once ``links(u, v)`` are added to the graph; only the roots that these join are contracted."""
    of_u, of_v = (roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("u", "v"))
    joins = links.join(of_u, "u", "left").join(of_v, "v", "left")
    joins = stored(joins.select("u", "v", F.coalesce("root_u", "u").alias("root_u"), F.coalesce("root_v", "v").alias("root_v")), "joins")
    first = joins.select(F.col("u").alias("node"), F.col("root_u").alias("root")).unionAll(joins.select("v", "root_v"))
    known = roots.unionAll(first.where("node = root").join(roots, "node", "left_anti").distinct())
    top = components(joins.select(F.col("root_u").alias("u"), F.col("root_v").alias("v"))).toDF("root", "top")
    return stored(known.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
