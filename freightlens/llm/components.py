"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every end of ``links`` (a, b long); root is the smallest node reachable.

    Each round hangs every node's larger neighbours, then its smaller ones, to
    the smallest node it knows, until each component is one star. Rounds grow with the
    logarithm of the longest path. The hubs' minima are combined before the
    shuffle, and the joins have the links on the side that AQE may split.
    Links with a null end and links of a node with itself are left out.
    """
    links = saved(
        links.filter("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(),
        "links",
    )
    before = None
    while True:
        both = links.unionByName(links.selectExpr("v AS u", "u AS v"))
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        large = (
            both.filter("v > u")
            .join(low, "u")
            .selectExpr("v AS u", "least(u, low) AS v")
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        joined = large.join(low, "u")
        small = (
            joined.selectExpr("explode(array(struct(u, low AS v), struct(v AS u, low AS v))) AS e")
            .select("e.*")
            .filter("u <> v")
            .distinct()
        )
        links = saved(small, "links")
        state = links.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"),
        ).first()
        if state == before:
            break
        before = state
    roots = links.select("v").distinct().selectExpr("v AS node", "v AS root")
    return links.selectExpr("u AS node", "v AS root").unionByName(roots)
