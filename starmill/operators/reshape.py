"""Row-shaping operators: latest row per key, ordinals, unpivot, entity lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.session import written


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` values per key; NULL is the smallest value.

    A ``max`` over one struct instead of a ranking window: each task keeps one
    row per key before the shuffle, so no task gets all rows of a key. Structs
    can't be kept in a hash aggregation, so each task sorts its rows by key
    first. The remaining columns break ties, which makes the result definite.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    best = F.max(F.struct(*order_by, *rest)).alias("_best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select([F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def ordinal_within(df: DataFrame, parent: Sequence[str], order_by: Sequence[str], name: str) -> DataFrame:
    """Position 1, 2, ... of each row within its parent, for parents of any size.

    The rows are range-partitioned and sorted by parent and order, so a large
    parent lies in several neighbouring partitions, and written once with their
    partition and place in it. Where a parent begins in a partition, and what
    the earlier ones hold of it, is one row for each of its stretches; the rows
    themselves are not dealt out again.
    """
    spread = df.repartitionByRange(*parent, *order_by).sortWithinPartitions(*parent, *order_by)
    placed = written(spread.withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}), "ordinal")
    stretch = [*parent, "_part"]
    earlier = Window.partitionBy(*parent).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        placed.groupBy(*stretch)
        .agg(F.min("_place").alias("_begin"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_begin") + 1)
        .select(*[F.col(c).alias(f"_of_{c}") for c in stretch], "_shift")
    )
    begins = written(begins, "ordinal-begins")  # so that its size is known, and few are broadcast
    own = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in stretch]
    joined = placed.join(begins, reduce(and_, own))
    return joined.select(*df.columns, (F.col("_place") + F.col("_shift")).cast("int").alias(name))


def unpivot_measures(
    df: DataFrame,
    id_cols: Sequence[str],
    entities: Mapping[str, Mapping[str, str]],
    entity_col: str,
    not_null: str,
) -> DataFrame:
    """One row per entity from column groups, in a single pass.

    ``entities`` maps an entity name to ``{output measure: input column}``.
    Rows whose ``not_null`` measure is NULL are dropped.
    """
    measures = list(next(iter(entities.values())))
    cells = [
        F.struct(F.lit(name).alias(entity_col), *[F.col(columns[m]).alias(m) for m in measures])
        for name, columns in entities.items()
    ]
    return df.select(*id_cols, F.inline(F.array(*cells))).filter(F.col(not_null).isNotNull())


def entity_names(text: Column, joiner: str = ", and ", sep: str = ",", drop_empty: bool = False) -> Column:
    """The names in a free-text list as an array.

    "A, and B" gives A and B; "A and B" without the comma stays one name.
    Letter case of the joiner does not count.
    """
    single = F.regexp_replace(text, "(?i)" + joiner.replace(" ", "[ ]"), sep + " ")
    names = F.transform(F.split(single, sep, -1), lambda n: F.trim(n))
    return F.filter(names, lambda n: n != "") if drop_empty else names


def split_entities(
    df: DataFrame,
    text_col: str,
    name_col: str,
    count_col: str | None = None,
    joiner: str = ", and ",
    sep: str = ",",
    drop_empty: bool = False,
) -> DataFrame:
    """One row per name in ``text_col``; ``count_col`` tells how many names the row had.

    The count is the size of the list before it is opened, so it needs no
    window and no shuffle.
    """
    names = entity_names(F.col(text_col), joiner, sep, drop_empty)
    listed = df.withColumn("_names", names)
    keep = [F.col(c) for c in df.columns]
    if count_col:
        keep.append(F.size("_names").alias(count_col))
    return listed.select(*keep, F.explode("_names").alias(name_col))


def allocate_evenly(df: DataFrame, measures: Sequence[str], count_col: str) -> DataFrame:
    """Divide each measure by the number of rows it was split into."""
    return df.withColumns({m: F.col(m) / F.col(count_col) for m in measures})
