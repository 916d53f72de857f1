"""Hot keys: finding them, and splitting their rows over many tasks.

A window over a key puts all rows of the key into one task. A key with more than
``ROWS_PER_TASK`` rows is hot, at any size of the whole. Its versions are cut into *slices* of their order,
as many as their number asks for, and the facts of a slice are dealt to *salts*, as many as
they ask for. So no task gets more than about that many rows of one key, whatever the key's
share, and nothing is split that one task can hold.

How many keys are hot follows the data (at most rows / ``ROWS_PER_TASK``), so their table is stored and
joined like any other: the planner broadcasts it when its size says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.workspace import written

#: Rows of one key that a task may have to hold at once.
ROWS_PER_TASK = 1_000_000
#: Quantiles taken of a hot key's order; a key gets at most as many slices.
STEPS = 1024
#: Hashes by which keys are counted at first.
HASHES = 4096
# A task's rows are versions of a slice and facts of a salt; quantiles and hashes are not exact.
_SLACK = 4


def over(df: DataFrame, key: str, name: str, rows_per_task: int) -> DataFrame:
    """Keys with more rows than a task may hold, and how many."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return counts.filter(F.col(name) > rows_per_task)


def most_of_a_hash(rows: DataFrame, key: str) -> int:
    """Rows of the fullest of ``HASHES`` hashes of a key: no key has more. A task gives out one count per hash, however many keys there are."""
    place = F.pmod(F.xxhash64(key), F.lit(HASHES))
    counts = rows.groupBy(place.alias("hash")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.agg(F.max("rows")).first()[0] or 0


def hot_keys(
    versions: DataFrame,
    key: str,
    order: str,
    facts: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame | None:
    """``key, bounds``: keys hot among ``versions`` or ``facts``, and the bounds of the slices of each; None without any."""
    hot = over(versions, key, "n_versions", rows_per_task)
    if facts is not None:
        hot = hot.join(over(facts, key, "n_facts", rows_per_task), key, "full_outer")
    hot = written(hot.select(key, F.coalesce("n_versions", F.lit(0)).alias("n")), "hot")
    if hot.isEmpty():
        return None
    steps = [i / STEPS for i in range(1, STEPS)]
    own = versions.join(hot.filter("n > 0").select(key, "n"), key)
    cuts = own.groupBy(key, "n").agg(F.percentile_approx(order, steps).alias("all"))
    slices = F.least(F.ceil(F.col("n") * _SLACK / rows_per_task), F.lit(STEPS))
    every = F.expr("transform(sequence(1L, slices - 1), i -> all[cast(i * %d div slices as int) - 1])" % STEPS)
    cuts = cuts.withColumn("slices", slices).select(key, F.array_distinct(every).alias("bounds"))
    nothing = F.array().cast("array<bigint>")
    return written(hot.join(cuts, key, "left").select(key, F.coalesce("bounds", nothing).alias("bounds")), "hot")


def slice_of(bounds: Column, at: Column) -> Column:
    """Number of the slice that position ``at`` is in; 0 where there are no bounds."""
    passed = F.size(F.filter(bounds, lambda bound: bound <= at))
    return F.when(bounds.isNull(), F.lit(0)).otherwise(passed)


def salts_of(facts: DataFrame, hot: DataFrame, key: str, at: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``key, _slice, salts``: over how many tasks the facts of each slice of a hot key are dealt."""
    placed = facts.join(hot, key).withColumn("_slice", slice_of(F.col("bounds"), F.col(at)))
    counts = placed.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(key, "_slice", F.ceil(F.col("n") * _SLACK / rows_per_task).cast("int").alias("salts"))
