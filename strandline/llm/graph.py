"""Connected components of a link table, as DataFrame rounds (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import cut, discard


#: Rows a task writes in a round: what is left of a graph is far smaller than the data, and so are its tasks' number.
TASK_ROWS = 100_000


def _star(pairs: DataFrame, tasks: int) -> DataFrame:
    """a, b, m: every pair with the least of a and its partners. The minima are written first, so that both sides of the
    join are dealt by it and a node with very many partners is split."""
    least = cut(pairs.groupBy("a").agg(F.min("b").alias("least")).coalesce(tasks), "stars")
    return pairs.join(least, "a").select("a", "b", F.least("a", "least").alias("m"))


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, label): label is the smallest node that node is connected with; nodes that are their own label are left out.

    Null ends are dropped, loops and repeats do no harm; no links give no rows.
    """
    a, b = F.greatest(u, v), F.least(u, v)
    edges = cut(links.filter(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v))).select(a.alias("a"), b.alias("b")).distinct(), "edges")
    state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    while True:
        tasks = 1 + state[0] // TASK_ROWS
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, tasks).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.filter("a <> b").distinct().coalesce(tasks), "edges")
        small = _star(large, tasks).select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        new = cut(small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).filter("a <> b").distinct().coalesce(tasks), "edges")
        seen, state = state, new.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        discard(edges)
        discard(large)
        edges = new
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
