"""Integrity rules, each as a DataFrame of offending rows or a count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions.clean import fold_key


def duplicate_keys(df: DataFrame, keys: Sequence[str], fold: Sequence[str] = ()) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    columns = [fold_key(F.col(k)).alias(k) if k in fold else F.col(k) for k in keys]
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def orphans(fact: DataFrame, dim: DataFrame, key: str, unknown: int | None = 0) -> DataFrame:
    """Keys of a fact that the dimension lacks, with their number of rows.

    The fact is reduced to its keys first, so no key is hot in the join.
    """
    used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    if unknown is not None:
        used = used.filter(F.col(key) != unknown)
    return used.join(dim.select(key), key, "left_anti")


def rule_report(df: DataFrame, required: Sequence[str] = (), widths: Mapping[str, int] | None = None) -> DataFrame:
    """One row per NOT NULL or length rule with the number of rows that break it, from one scan."""
    rules = {f"{c} is required": F.col(c).isNull() for c in required}
    rules.update({f"{c} has at most {w} characters": F.length(c) > w for c, w in (widths or {}).items()})
    counts = df.agg(*[F.count_if(broken).alias(f"r{i}") for i, broken in enumerate(rules.values())])
    cells = [F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("broken")) for i, rule in enumerate(rules)]
    return counts.select(F.inline(F.array(*cells)))


def allocation_gaps(original: DataFrame, allocated: DataFrame, key: str, measure: str, tolerance: float = 1e-6) -> DataFrame:
    """Keys whose allocated parts do not add up to the original amount."""
    parts = allocated.groupBy(key).agg(F.sum(measure).alias("allocated"))
    whole = original.groupBy(key).agg(F.sum(measure).alias("original"))
    return whole.join(parts, key).filter(F.abs(F.col("original") - F.col("allocated")) > tolerance)
