"""Connected components of a distributed edge list.

Alternating large and small stars: each round hangs every node's larger (or
smaller-or-equal) neighbours on its smallest one, with two shuffles and only
minima per node, until the edges form stars. No group of neighbours is ever
gathered: minima combine before the shuffle and the join splits hot nodes.
Every round is written to the shared folder, so its lineage ends there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import shared

#: Rounds are logarithmic in the longest path; far beyond it something is wrong.
MAX_ROUNDS = 60


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))           # (u, v) in either direction
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    # edges hold u > v: hang u and its smaller neighbours on the smallest of them
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component_id): each node that has an edge, and the smallest node it
    reaches. Null ends and loops are ignored; repeated edges do no harm."""
    pairs = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = shared.written(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
                         "edges")
    for _ in range(MAX_ROUNDS):
        nxt = shared.written(_small(_large(now)), "edges")
        # in stars no node that something hangs on hangs itself
        if nxt.join(nxt.select(F.col("v").alias("u")), "u", "left_semi").isEmpty():
            roots = nxt.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
            return nxt.select(F.col("u").alias("node"), F.col("v").alias("component_id")).union(roots)
        now = nxt
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
