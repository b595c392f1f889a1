"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import Rounds, stage


def components(links: DataFrame) -> DataFrame:
    """(id, comp) for every id in ``links`` (a, b); comp is one id of its component, the same for all of it.

    Each round, an id takes the smallest id among itself and its neighbours as its label, and the links between labels are
    the next round's graph, so that the graph shrinks by a share of its ids each time. Labels are written in each round and
    followed back at the end; neither links nor labels reach the driver. Ids should be hashes, whose order is random.
    """
    graphs = Rounds(links.sparkSession, "links")
    graph = graphs.write(links.select("a", "b").where("a <> b").distinct())
    rounds = []
    while True:
        both = graph.union(graph.select("b", "a"))
        labels = stage(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("comp")), "labels")
        rounds.append(labels)
        named = graph.join(labels.select(F.col("id").alias("a"), F.col("comp").alias("_a")), "a")
        named = named.join(labels.select(F.col("id").alias("b"), F.col("comp").alias("_b")), "b").where("_a <> _b")
        graph = graphs.write(named.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct())
        if graph.isEmpty():
            break
    comps = rounds[0]
    for labels in rounds[1:]:
        above = labels.select(F.col("id").alias("comp"), F.col("comp").alias("_above"))
        comps = comps.join(above, "comp", "left").select("id", F.coalesce("_above", "comp").alias("comp"))
    return comps
