"""Connected components by alternating large-star and small-star."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstats.llm.common import stored

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of ``edges`` (columns a, b), where the component is the
    smallest id reachable.

    Loops and repeated edges do no harm; rows with null are left out.  The least neighbour of
    a node is a partial aggregate and its neighbours stay rows, so a node with most
    of the edges is never one group in memory.
    """
    either = edges.where("a is not null and b is not null").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    loops = either.where("u = v").select("u").distinct()
    state = stored(either.where("u <> v"), "edges")
    for _ in range(MAX_ROUNDS):
        if _are_stars(state):
            break
        state = _small_star(_large_star(state))
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    # Now every node points to the least one of its component.
    members = state.select(F.col("u").alias("id"), F.col("v").alias("component")).distinct()
    roots = state.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    known = members.unionByName(roots)
    lone = loops.join(known, loops["u"] == known["id"], "left_anti")
    return known.unionByName(lone.select(F.col("u").alias("id"), F.col("u").alias("component")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one larger or many smaller neighbours, but not both, and no more
    than one node that it points to."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.col("v").alias("to")),
        F.struct(F.col("v").alias("node"), F.lit(None).cast("long").alias("to")),
    )).alias("end")).select("end.*")
    seen = ends.groupBy("node").agg(
        F.min("to").alias("least"), F.max("to").alias("most"), F.max(F.col("to").isNull()).alias("hub")
    )
    return seen.where("least < most or (hub and least is not null)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least of node and neighbours."""
    ways = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(
        ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least"
    )
    linked = ways.where("v > u").join(least, "u")
    # Repeats go in the small star.
    return stored(linked.select(F.col("v").alias("u"), F.col("m").alias("v")), "edges")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, to the least of them."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    both = linked.union(least.select("u", F.col("m").alias("v"))).where("u <> v")
    return stored(both.distinct(), "edges")
