"""Minority oversampling between nearest neighbours (SMOTE, Chawla et al. 2002)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delinq import schemas
from delinq.functions.numeric import uniform
from delinq.models.neighbours import nearest_neighbours
from delinq.operators.ranking import pick_exactly
from delinq.session import materialise


def oversample_minority(
    df: DataFrame,
    key: str = "borrower_id",
    label: str = schemas.TARGET,
    k: int = 5,
    seed: int = 42,
    block_rows: int = 20000,
) -> DataFrame:
    """Rows of ``df`` (key, label, features) plus synthetic minority rows up to a 1:1 balance.

    New rows are spread evenly over the minority rows; which row gets one more, which of its k
    neighbours is taken and how far the new point lies on the way to it follow from the hash of
    the key, so the result does not depend on the partitioning.
    """
    base = df.select(F.col(key).cast("string").alias(key), F.col(label).cast("int").alias(label), "features")
    counts = {r[label]: r["count"] for r in base.groupBy(label).count().collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    if min(n0, n1) < 2 or n0 == n1:
        return base
    minority, small, missing = (1, n1, n0 - n1) if n1 < n0 else (0, n0, n1 - n0)
    rare = base.filter(F.col(label) == minority).select(
        F.col(key).alias("id"), F.col(label).alias("label"), vector_to_array("features").alias("x")
    )
    each, extra = divmod(missing, small)
    picked = pick_exactly(rare, "id", "label", F.lit(extra), seed, output="one_more")
    copies = F.lit(each) + F.col("one_more").cast("int")
    marked = materialise(picked.select("id", "x", copies.alias("copies"), (copies > 0).alias("asks")), "minority")
    # Only rows with copies want neighbours; all rows may be neighbours.
    found = nearest_neighbours(marked, k, block_rows, seed, asking="asks")
    tag = lambda name: F.concat_ws("#", F.col("id"), F.col("copy"), F.lit(name))
    drawn = (
        marked.join(found, "id")
        .filter("asks")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        .withColumn("turn", F.floor(uniform(tag("neighbour"), seed) * F.size("found")).cast("int"))
        .select(
            "id",
            "copy",
            "x",
            F.element_at(F.col("found"), F.col("turn") + 1)["other"].alias("other"),
            uniform(tag("step"), seed).alias("step"),
        )
    )
    partners = marked.select(F.col("id").alias("other"), F.col("x").alias("y"))
    point: Column = F.zip_with("x", "y", lambda a, b: a + (b - a) * F.col("step"))
    synthetic = drawn.join(partners, "other").select(
        F.concat_ws("#", "id", "copy").alias(key),
        F.lit(minority).alias(label),
        array_to_vector(point).alias("features"),
    )
    return base.unionByName(synthetic)
