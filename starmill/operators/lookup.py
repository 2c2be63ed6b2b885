"""Fact-to-dimension joins that hold up when one key owns a third of the fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_limit(df: DataFrame) -> int:
    """Bytes up to which the session broadcasts a table."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate: the size of the files read, and what the plan makes of it. Runs nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_keys(df: DataFrame, on: Sequence[str], share: float = 0.01) -> list[int]:
    """Hashes of all keys that may own more than ``share`` of the rows.

    One pass with a fixed-size sketch per task; the answer has at most
    ``1 / share`` entries. It may name keys that are not hot, which costs a
    little and changes no result.
    """
    found = df.select(F.xxhash64(*on).alias("key")).freqItems(["key"], support=share).first()
    return list(found[0] or [])


def salted_join(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", share: float = 0.01) -> DataFrame:
    """Join in which every hot key of the fact is spread over as many parts as there are shuffle partitions.

    The hot rows of ``dim`` (at most ``1 / share`` keys) are repeated once per
    part. A fact row finds its part by a hash of the whole row, so a repeated
    task puts it in the same place. Exact copies of a row share a part; if they
    are very many, adaptive execution splits that part by map output, since
    only the fact side is large.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins keep each fact row in one part")
    hot = hot_keys(fact, on, share)
    if not hot:
        return fact.join(dim, list(on), how)
    parts = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.xxhash64(*on).isin(hot)
    part_of_row = F.pmod(F.xxhash64(*fact.columns), F.lit(parts)).cast("int")
    salted_fact = fact.withColumn("_salt", F.when(is_hot, part_of_row).otherwise(F.lit(0)))
    all_parts = F.sequence(F.lit(0), F.lit(parts - 1))
    salted_dim = dim.withColumn("_salt", F.explode(F.when(is_hot, all_parts).otherwise(F.array(F.lit(0)))))
    return salted_fact.join(salted_dim, [*on, "_salt"], how).drop("_salt")


def lookup(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", broadcast_bytes: int | None = None) -> DataFrame:
    """Join ``fact`` to a lookup table that is unique on ``on``.

    A ``dim`` whose estimated size is within the session's broadcast limit (or
    ``broadcast_bytes``) is left to Spark's own broadcast; a larger one is a
    shuffle join with salted hot keys.
    """
    same_type = dim.select(
        [F.col(c).cast(fact.schema[c].dataType).alias(c) if c in on else F.col(c) for c in dim.columns]
    )
    limit = broadcast_limit(fact) if broadcast_bytes is None else broadcast_bytes
    if estimated_bytes(same_type) <= limit:
        return fact.join(same_type, list(on), how)
    return salted_join(fact, same_type, on, how)


def lookup_key(
    df: DataFrame, dim: DataFrame, on: Sequence[str], key: str, unknown: int | None = 0, broadcast_bytes: int | None = None
) -> DataFrame:
    """Attach the surrogate ``key`` of ``dim``; rows without a match get ``unknown``."""
    joined = lookup(df, dim.select(*on, key), on, "left", broadcast_bytes)
    if unknown is None:
        return joined
    return joined.withColumn(key, F.coalesce(key, F.lit(unknown).cast(dim.schema[key].dataType)))


def lookup_date(df: DataFrame, calendar: DataFrame, date_col: str, key: str) -> DataFrame:
    """Attach the calendar's date key under a role name; dates outside the calendar get NULL."""
    role = calendar.select(F.col("date").alias(date_col), F.col("date_id").alias(key))
    return lookup(df, role, [date_col], "left")
