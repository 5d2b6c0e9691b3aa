"""Connected components of a graph given as links, by alternating star contractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.sources.scratch import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root``: the smallest node that each node of a link reaches.

    Large stars tie every larger neighbour of a node to its smallest one, small stars the smaller neighbours;
    repeated until nothing changes, which takes a number of rounds that grows with the logarithm of the nodes.
    Every round is written to the shared folder. Smallest neighbours are stored before they are joined back, so
    that Spark can split the rows of a node with many neighbours. Links to itself, repeated links and an empty
    table are fine; links with a null end are left out. Runs jobs.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = stored(links.where(F.col(a) != F.col(b)).select(high, low).distinct())
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _tied(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct())
        small = _tied(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u != v").distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _tied(edges: DataFrame) -> DataFrame:
    """Each row with the smallest node around u, itself included."""
    smallest = stored(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return edges.join(smallest, "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
