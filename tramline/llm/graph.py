"""Distributed union-find: connected components of a link table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.session import materialise


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node; a component is named by its smallest node.

    `links` has two columns of one type that can be ordered. Rounds of large-star and
    small-star steps: each node's neighbours are hung on its smallest neighbour, until
    every node hangs on its component's smallest one. A round is written and read back;
    the smallest neighbours are a table of their own, so that the joins' hot nodes can be
    split. Nothing but a row count and a checksum reaches the driver.
    """
    a, b = (F.col(c) for c in links.columns)
    now = materialise(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links"
    )
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m"), "least")
        large = materialise(both.filter("v > u").join(least, "u").selectExpr("v AS u", "m AS v").distinct(), "large")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u").filter("v <> m").selectExpr("v AS u", "m AS v")
        now = materialise(moved.unionByName(least.selectExpr("u", "m AS v")).distinct(), "links")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.selectExpr("u AS node", "v AS component").unionByName(roots)
