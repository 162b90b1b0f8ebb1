"""Connected components of a graph of links, each step a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import kept


def _settled(parent: DataFrame) -> DataFrame:
    """Follow parents (u -> p) up to the roots, twice as far in each step."""
    while True:
        up = parent.select(F.col("u").alias("p"), F.col("p").alias("q"))
        ahead = kept(parent.join(up, "p", "left").select("u", F.coalesce("q", "p").alias("p"), "q"), "components-up")
        parent = ahead.select("u", "p")
        if ahead.where("q is not null").isEmpty():
            return parent


def _ends_at(links: DataFrame, roots: DataFrame) -> DataFrame:
    """The links between roots that their ends have come to."""
    for end in ("a", "b"):
        r = roots.select(F.col("u").alias(end), F.col("p").alias("q"))
        links = links.join(r, end, "left").withColumn(end, F.coalesce("q", end)).drop("q")
    return kept(links.select("a", "b").where("a <> b").distinct(), "components-links")


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The least member of the component of every linked node: u, p, without nodes that are their own.

    ``links`` has a and b; ``known`` may have the result for other links, to go on from. Every
    node hooks to its least neighbour, trees are flattened and links between the same trees drop
    out; components at least halve in number each time. A node with very many links is
    only aggregated over.
    """
    links = _ends_at(links, known) if known is not None else kept(links.where("a <> b").select("a", "b").distinct(), "components-links")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("p")).where("p < u")
        roots = _settled(kept(hooks, "components-hooks"))
        if known is None:
            known = roots
        else:
            r = roots.select(F.col("u").alias("p"), F.col("p").alias("q"))
            moved = known.join(r, "p", "left").select("u", F.coalesce("q", "p").alias("p"))
            known = kept(moved.union(roots).distinct(), "components-known")
        links = _ends_at(links, roots)
    return known if known is not None else links.select(F.col("a").alias("u"), F.col("b").alias("p"))  # none
