"""Connected components of a table of links, by alternating large and small stars.

The tables that meet in a join are written first, so that both sides come from a plain shuffle and Spark can split the
one large star of a huge component over several tasks. Every aggregation combines before it shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delinq.llm.common import written


def _stamp(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """cls, comp (its smallest class) of every class in the links (a, b); no rows without links."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = _stamp(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = written(least, "least")
        up = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))  # v > u
        large = written(up.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        after = _stamp(edges)
        if after == before:
            break
        before = after
    own = edges.select(F.col("v").alias("cls"), F.col("v").alias("comp")).distinct()
    return edges.select(F.col("u").alias("cls"), F.col("v").alias("comp")).unionByName(own)


def smallest_ids(classes: DataFrame, comp: DataFrame) -> DataFrame:
    """cls, component_id: the smallest doc_id of each class's component, from classes (cls, doc_id: its smallest)."""
    named = written(classes.join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls")), "named")
    least = written(named.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "least")
    return written(named.join(least, "comp").select("cls", "component_id"), "classes")
