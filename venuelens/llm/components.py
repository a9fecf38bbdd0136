"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelens.llm.storage import keep


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that can be reached, for every id of `links` (a, b).

    Rounds of large-star and small-star (Kiveris et al. 2014): links are replaced by links to the smallest neighbour until
    nothing changes, in about log n rounds. Minima are pre-aggregated; rows of a node never meet in one task.
    NULL ends and links to oneself give nothing; no links give no rows.
    """
    links = keep(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        links = keep(_small_star(_large_star(links)))
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).union(links.select("v", "v").distinct())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    met = links.join(low, "u")
    ends = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(met.select("u", "m"))
    return ends.where("u <> v").distinct()
