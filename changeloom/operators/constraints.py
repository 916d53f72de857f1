"""Row rules: which rows are acceptable, and why the others are not."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _holds(ok: Column) -> Column:
    """A rule whose test is null does not hold."""
    return F.coalesce(ok, F.lit(False))


def _all_hold(rules: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, map(_holds, rules.values()))


def accepted(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.filter(_all_hold(rules))


def broken(rules: dict[str, Column]) -> Column:
    """Names of the rules that a row breaks."""
    return F.array_compact(F.array(*[F.when(~_holds(ok), F.lit(name)) for name, ok in rules.items()]))


def rejected(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with ``reasons``: the names of the broken rules."""
    return df.filter(~_all_hold(rules)).withColumn("reasons", broken(rules))
