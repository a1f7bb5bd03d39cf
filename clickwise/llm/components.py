"""Connected components of a link table by contraction: every node hooks to the smallest neighbour, chains
are shortened, links are renamed and those inside a component go. The number of nodes at least halves in a
round. All tables stay distributed; the driver sees row counts only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwise.llm.common import scratch_table


def _shorten(parents: DataFrame) -> DataFrame:
    """Follow (node, root) to the end of each chain."""
    while True:
        p = parents.alias("p")
        q = parents.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        nxt = scratch_table(p.join(q, F.col("root") == F.col("_n"), "left")
                            .select("node", F.coalesce("_r", "root").alias("root"),
                                    (F.col("_r") < F.col("root")).alias("_moved")), "chains")
        settled = nxt.where("_moved").isEmpty()
        parents = nxt.drop("_moved")
        if settled:
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b); root: the smallest node reachable. Nodes are of any
    type that can be ordered; null nodes are not allowed."""
    edges = scratch_table(links.select("a", "b").where("a <> b").distinct(), "links")
    found = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = scratch_table(both.groupBy("a").agg(F.min("b").alias("_m"))
                              .select(F.col("a").alias("node"), F.least("_m", "a").alias("root")), "hooks")
        roots = _shorten(hooks)
        if found is None:
            found = roots
        else:
            new = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            found = scratch_table(found.join(new, F.col("root") == F.col("_n"), "left")
                                  .select("node", F.coalesce("_r", "root").alias("root")), "roots")
        ra = roots.select(F.col("node").alias("a"), F.col("root").alias("_ra"))
        rb = roots.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
        edges = scratch_table(edges.join(ra, "a").join(rb, "b").where("_ra <> _rb")
                              .select(F.least("_ra", "_rb").alias("a"), F.greatest("_ra", "_rb").alias("b")).distinct(),
                              "links")
    return found if found is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
