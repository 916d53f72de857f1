"""Surrogate keys.

Members are numbered by their place in the event order: ``from_seq`` itself is unique, grows in
order of insertion (with gaps, as a sequence does), needs no coordination and is the same after a
replay. A member inferred from the source table has no event; it gets ``-1 - natural key``.

``dense_number`` gives numbers without gaps where they are wanted.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F


def inferred_key(natural_key: Column) -> Column:
    return F.lit(-1) - natural_key


def dense_number(
    df: DataFrame, order: str, name: str, start: int = 1, buckets: int | None = None
) -> DataFrame:
    """Number rows ``start, start + 1, ..`` in the order of a numeric column of unique values.

    Rows are cut into ranges at quantiles of ``order``, so the ranges are of even size. A row's
    number is its place in its range plus the rows of the ranges before it. Only the table of
    range sizes (``buckets`` rows) is summed up in one place.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(df.approxQuantile(order, steps, 0.1 / buckets))) if steps else []
    splits = [float("-inf"), *cuts, float("inf")]
    if len(splits) > 2:
        cut = Bucketizer(splits=splits, inputCol=order, outputCol="_range")
        ranged = cut.transform(df)
    else:
        ranged = df.withColumn("_range", F.lit(0.0))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(order)
    return (
        ranged.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + F.col("_place") + F.lit(start - 1))
        .drop("_range", "_place", "_start")
    )
