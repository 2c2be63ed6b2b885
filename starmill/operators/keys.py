"""Dense surrogate keys, given out in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.session import written

# monotonically_increasing_id() puts the partition above this many bits and the
# row's position in the partition below.
POSITION_BITS = 33


def max_key(df: DataFrame, key: str) -> int:
    return df.agg(F.max(key)).first()[0] or 0


def assign_keys(new_rows: DataFrame, natural_key: Sequence[str], key: str, start_after: int = 0) -> DataFrame:
    """Number rows ``start_after + 1, ...`` in the order of their natural key.

    Rows are range-partitioned and sorted, written once with their partition
    and position, and shifted by the number of rows in the partitions before.
    Only those counts, one per partition, pass through the driver. Writing is
    needed because range borders are sampled: two runs could differ.
    """
    spark = new_rows.sparkSession
    ranged = new_rows.repartitionByRange(*natural_key).sortWithinPartitions(*natural_key)
    place = F.monotonically_increasing_id()
    placed = written(ranged.withColumn("_place", place), "keys")
    part = F.shiftright("_place", POSITION_BITS)
    position = F.col("_place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))

    counts = placed.groupBy(part.alias("_part")).count().collect()
    offsets, before = [], start_after
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((row["_part"], before))
        before += row["count"]
    shift = F.broadcast(spark.createDataFrame(offsets, "_part bigint, _before bigint"))
    return (
        placed.withColumn("_part", part)
        .join(shift, "_part")
        .select((F.col("_before") + position + 1).alias(key), *new_rows.columns)
    )


def number_placed(placed: DataFrame, key: str, start_after: int = 0) -> tuple[DataFrame, int]:
    """Number the rows of a written table that have a ``_place``, ``start_after + 1, ...``; the others keep their ``key``.

    ``_place`` is partition and position, as by ``monotonically_increasing_id()``
    evaluated for these rows alone. Also returns the last number. Only one
    number for each partition passes through the driver.
    """
    part, position = F.shiftright("_place", POSITION_BITS), F.col("_place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    ends = placed.filter("_place IS NOT NULL").groupBy(part.alias("_part")).agg((F.max(position) + 1).alias("n")).collect()
    offsets, last = [], start_after
    for row in sorted(ends, key=lambda r: r["_part"]):
        offsets.append((row["_part"], last))
        last += row["n"]
    if not offsets:
        return placed, last
    shift = F.broadcast(placed.sparkSession.createDataFrame(offsets, "_part bigint, _before bigint"))
    numbered = placed.withColumn("_part", part).join(shift, "_part", "left")
    return numbered.withColumn(key, F.coalesce(F.col("_before") + position + 1, F.col(key))).select(*placed.columns), last
