"""Point-in-time resolution: the version of a key that was valid at a position.

Both sides are put into one DataFrame, which is shuffled by the key and read in order; the last
version seen is the valid one. That costs time linear in facts plus versions, whatever the number
of versions per key. Rows of hot keys (``skew``) go the same way by slices and salts of their key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.workspace import written
from .skew import ROWS_PER_TASK, hot_keys, salts_of, slice_of

BEGINNING = -(2**63)


def first_versions(versions: DataFrame, key: str, order: str) -> DataFrame:
    """The first version of each key, moved to the beginning of time.

    Added to the versions, it serves facts that came before any version of their key.
    """
    rest = [c for c in versions.columns if c not in (key, order)]
    picked = versions.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_v"))
    return picked.select(key, F.lit(BEGINNING).alias(order), "_v.*")


def _resolve_together(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    order: str,
    probes: dict[str, dict[str, str]],
    group: list[str],
) -> DataFrame:
    """One union, one shuffle by ``group``, one sort and running pass per probe."""
    wanted = sorted({source for columns in probes.values() for source in columns.values()})
    version_rows = versions.select(
        *group,
        *[F.col(order).alias(at) for at in probes],
        F.struct(*wanted).alias("_v"),
    )
    # Facts are the rows without a version; of equal positions, versions come first.
    both = facts.unionByName(version_rows, allowMissingColumns=True)
    for number, at in enumerate(probes):
        running = (
            Window.partitionBy(*group)
            .orderBy(at, F.col("_v").isNull())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        both = both.withColumn(f"_v{number}", F.last("_v", ignorenulls=True).over(running))
    resolved = [
        F.col(f"_v{number}")[source].alias(name)
        for number, columns in enumerate(probes.values())
        for name, source in columns.items()
    ]
    return both.filter("_v IS NULL").select(*facts.columns, *resolved)


def _split_versions(versions: DataFrame, hot: DataFrame, salts: DataFrame, key: str, order: str) -> DataFrame:
    """Versions of hot keys with ``_slice`` and ``_salt``.

    Each slice starts with the last version before it, so that it can be read on its own; that adds
    a row per slice. The versions of a slice are repeated for each of its salts.
    """
    rest = [c for c in versions.columns if c not in (key, order)]
    own = versions.join(hot, key).withColumn("_slice", slice_of(F.col("bounds"), F.col(order))).drop("bounds")
    last = own.groupBy(key, "_slice").agg(F.max_by(F.struct(*rest), order).alias("_v"))
    slices = hot.select(key, F.explode(F.sequence(F.lit(0), F.size("bounds"))).alias("_slice"))
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        slices.join(last, [key, "_slice"], "left")
        .withColumn("_v", F.last("_v", ignorenulls=True).over(before))
        .filter(F.col("_v").isNotNull())
        .select(key, F.lit(BEGINNING).alias(order), "_v.*", "_slice")
    )
    copies = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    return own.unionByName(carried).join(salts, [key, "_slice"]).withColumn("_salt", copies).drop("salts")


def resolve_asof(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    order: str,
    probes: dict[str, dict[str, str]],
    salt_by: list[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    may_be_hot: bool = True,
) -> DataFrame:
    """Add to each fact columns of the version of ``key`` that is valid at a position.

    ``probes`` maps a position column of the facts to ``{new column: version column}``. The
    valid version is the one with the greatest ``order`` not above the position; without one
    the new columns are null. Keys are counted first, so ``facts`` and ``versions`` are best stored tables;
    who knows that no key has more than ``rows_per_task`` rows says so with ``may_be_hot=False``, which changes nothing else.
    Facts of a hot key are dealt by a hash of ``salt_by``.
    """
    hot = hot_keys(versions, key, order, facts, rows_per_task) if may_be_hot else None
    if hot is None:
        return _resolve_together(facts, versions, key, order, probes, [key])
    only = hot.select(key)
    cold = _resolve_together(
        facts.join(only, key, "left_anti"), versions.join(only, key, "left_anti"), key, order, probes, [key]
    )
    part, columns = facts.join(only, key, "left_semi"), facts.columns
    for at, wanted in probes.items():
        salts = written(salts_of(part, hot, key, at, rows_per_task), "salts")
        spread = F.pmod(F.xxhash64(*(salt_by or facts.columns)), F.col("salts")).cast("int")
        placed = (
            part.join(hot, key)
            .withColumn("_slice", slice_of(F.col("bounds"), F.col(at)))
            .drop("bounds")
            .join(salts, [key, "_slice"])
            .withColumn("_salt", spread)
            .drop("salts")
        )
        split = _split_versions(versions, hot, salts, key, order)
        columns = [*columns, *wanted]
        part = _resolve_together(placed, split, key, order, {at: wanted}, [key, "_slice", "_salt"]).select(*columns)
    return cold.select(*columns).unionByName(part)
