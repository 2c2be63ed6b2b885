"""Type-1 upsert of a snapshot: overwrite on match, insert otherwise, never retract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from starmill.functions.clean import fold_key
from starmill.operators.keys import assign_keys, max_key, number_placed
from starmill.operators.lookup import broadcast_limit, estimated_bytes
from starmill.operators.reshape import latest_per_key
from starmill.session import written


class Upsert(NamedTuple):
    """``found``: the source rows with their surrogate key (and extra columns);
    ``changed``: those of them that are written, all but those the target has
    in a newer state; ``kept``: the target rows that stay as they are;
    ``whole``: kept and changed rows from one scan, those of a folder together."""

    found: DataFrame
    changed: DataFrame
    kept: DataFrame
    last_key: int
    whole: DataFrame | None = None

    def table(self, stored_by: Sequence[str] = ()) -> DataFrame:
        """The whole new table.

        ``stored_by`` names the columns whose values get folders of their own:
        the changed rows are gathered by them, with large values split over
        several tasks. The kept rows come from such folders already and stay
        where they are. Rows of ``whole`` lie in that order already.
        """
        if self.whole is not None:
            return self.whole
        changed = self.changed.select(self.kept.columns)
        return self.kept.unionByName(changed.hint("rebalance", *stored_by) if stored_by else changed)


def _folded(df: DataFrame, natural_key: Sequence[str], fold: Sequence[str]) -> Mapping[str, Column]:
    return {f"_k_{c}": fold_key(F.col(c)) if c in fold else F.col(c) for c in natural_key}


def one_row_per_key(df: DataFrame, keys: Sequence[str], on_duplicate: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Enforce key uniqueness in the plan.

    ``error`` fails the query when a key occurs twice, ``latest`` keeps the row
    with the greatest ``order_by``. Either way the rows are reduced per task
    before the shuffle.
    """
    if on_duplicate == "latest":
        return latest_per_key(df, keys, order_by)
    if on_duplicate != "error":
        raise ValueError("on_duplicate must be 'error' or 'latest'")
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_n"))
    message = F.concat(F.lit("more than one source row for key "), F.to_json(F.struct(*keys)))
    # part of the row value, so that no rewrite of the plan can drop the check
    checked = F.when(F.col("_n") > 1, F.raise_error(message).cast(grouped.schema["_row"].dataType)).otherwise(F.col("_row"))
    opened = grouped.withColumn("_row", checked)
    return opened.select([F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def upsert_type1(
    target: DataFrame,
    source: DataFrame,
    natural_key: Sequence[str],
    key: str,
    stamp: Column,
    fold: Sequence[str] = (),
    keep_on_match: Sequence[str] = (),
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    stamp_col: str = "import_date",
    start_after: int | None = None,
    first_col: str | None = None,
    stored_by: Sequence[str] = (),
) -> Upsert:
    """Match ``source`` to ``target`` on the natural key.

    A matched row takes every attribute of the source, NULL included, and
    keeps its surrogate ``key``; a new row gets the next key; a target row
    without a source row stays as it is, old stamp included. Key columns in
    ``fold`` are compared without regard to case and trailing blanks; columns
    in ``keep_on_match`` keep the target's value. Columns of the source that
    the target lacks ride along in ``found`` and ``changed``.

    The last writer is the one with the latest ``stamp``, whenever it comes: a
    target row whose own stamp is later than the source's stays as it is. With
    ``first_col``, a column of the target with the stamp that the columns of
    ``keep_on_match`` are from, those are the first writer's in the same sense.
    So batches with different stamps give one table in any order.

    Because a match overwrites all attributes, only the keys of the target are
    joined to the source, and the target itself is anti-joined. So a source
    that Spark's size check lets it broadcast never makes it shuffle the target,
    as one full outer join would.

    ``stored_by`` names columns of both, given by the natural key, whose values
    the target has folders for. With them, a source too large for that is merged
    with the target in one pass, and new rows are numbered by these columns first.
    """
    target_keys, source_keys = _folded(target, natural_key, fold), _folded(source, natural_key, fold)
    folded = list(source_keys)

    known = target.select(
        *[c.alias(n) for n, c in target_keys.items()],
        F.col(key),
        F.col(stamp_col).alias("_stamp"),
        *[F.col(c).alias(f"_kept_{c}") for c in keep_on_match],
        *([F.col(first_col).alias("_first")] if first_col else []),
    )
    wanted = source.select(*[c.alias(n) for n, c in source_keys.items()])
    # a source that is broadcast leaves few keys of the target; one that is not would only be shuffled once more
    small = estimated_bytes(wanted) <= broadcast_limit(wanted)
    if stored_by and not small:
        if on_duplicate != "error":
            source = one_row_per_key(source.withColumns(source_keys), folded, on_duplicate, order_by).select(*source.columns)
        start = max_key(target, key) if start_after is None else start_after
        return _merge(target.withColumns(target_keys), source.withColumns(source_keys), folded, key, stamp, keep_on_match, stamp_col, start, first_col, stored_by)
    hits = known.join(wanted.distinct(), folded, "left_semi") if small else known

    src = one_row_per_key(source.withColumns(source_keys), folded, on_duplicate, order_by)
    matched = src.join(hits, folded, "left").withColumn(stamp_col, stamp)
    is_match = F.col(key).isNotNull()
    names = [key, stamp_col, *source.columns]
    matched = matched.withColumn("_stale", F.coalesce(F.col("_stamp") > F.col(stamp_col), F.lit(False)))
    renamed = F.lit(False)
    if first_col:
        names.append(first_col)
        renamed = is_match & F.coalesce(F.col("_first") > F.col(stamp_col), F.lit(True))
        matched = matched.withColumn(first_col, F.when(is_match & ~renamed, F.col("_first")).otherwise(F.col(stamp_col)))
    for c in keep_on_match:
        matched = matched.withColumn(c, F.when(is_match & ~renamed, F.col(f"_kept_{c}")).otherwise(F.col(c)))
    matched = matched.select(*names, *folded, "_stale", (renamed & F.col("_stale")).alias("_renamed"))
    seen = Observation()
    observed = matched.observe(seen, F.count_if(~is_match).alias("new"), F.count_if("_renamed").alias("renamed"))
    matched = written(observed, "matched")

    found, last = matched, start_after or 0
    if seen.get["new"]:
        last = max_key(target, key) if start_after is None else start_after
        found = matched.filter(is_match).unionByName(assign_keys(matched.filter(~is_match).drop(key), folded, key, last))
        last += seen.get["new"]
    # all that the target has in a newer state is found, but not written
    replaced = matched.filter(~F.col("_stale")).select(*folded)
    kept = target.withColumns(target_keys).join(replaced, folded, "left_anti")
    if first_col and seen.get["renamed"]:
        first = matched.filter("_renamed").select(*folded, *[F.col(c).alias(f"_first_{c}") for c in (first_col, *keep_on_match)])
        kept = kept.join(first, folded, "left")
        kept = kept.withColumns({c: F.coalesce(f"_first_{c}", c) for c in (first_col, *keep_on_match)})
    return Upsert(found.select(*names), found.filter(~F.col("_stale")).select(*names), kept.select(*target.columns), last)


def _merge(
    target: DataFrame, source: DataFrame, folded: Sequence[str], key: str, stamp: Column,
    keep_on_match: Sequence[str], stamp_col: str, start_after: int, first_col: str | None, stored_by: Sequence[str],
) -> Upsert:
    """The upsert of a source that is about as large as the target.

    The rows of both are dealt out once, by folder and key, and sorted, so that a
    source row comes right after the target row it matches. What becomes of the two
    shows from the neighbouring row; new rows are counted as they are written, and
    the files written have the rows of a folder together, for the table to be
    written from them without another shuffle.
    """
    own = [c for c in target.columns if c not in folded]
    names = [key, stamp_col, *[c for c in source.columns if c not in folded], *([first_col] if first_col else [])]
    stamped = source.withColumns({"_of_source": F.lit(True), stamp_col: stamp})
    both = target.withColumn("_of_source", F.lit(False)).unionByName(stamped, allowMissingColumns=True)
    order = [*stored_by, *folded]
    dealt = both.repartitionByRange(*order).sortWithinPartitions(*order, "_of_source")

    near = Window.partitionBy(*order).orderBy("_of_source")
    held = {key: "_key", stamp_col: "_stamp", **({first_col: "_first"} if first_col else {}), **{c: f"_kept_{c}" for c in keep_on_match}}
    seen = dealt.select(
        "*",
        F.lag("_of_source").over(near).alias("_before"),
        F.lead("_of_source").over(near).alias("_after"),
        *[F.lag(c).over(near).alias(name) for c, name in held.items()],
        *[F.lead(c).over(near).alias(f"_new_{c}") for c in keep_on_match],
    )
    of_source, has_key = F.col("_of_source"), reduce(and_, [F.col(c).isNotNull() for c in folded])
    yes = lambda condition: F.coalesce(condition, F.lit(False))
    is_match = of_source & has_key & yes(~F.col("_before"))
    is_matched = ~of_source & has_key & yes(F.col("_after"))
    stale = yes(F.when(of_source, is_match & (F.col("_stamp") > stamp)).otherwise(is_matched & (F.col(stamp_col) > stamp)))
    message = F.concat(F.lit("more than one source row for key "), F.to_json(F.struct(*folded)))
    twice = of_source & yes(F.col("_before"))
    values = {
        # part of the key, so that no rewrite of the plan can drop the check
        key: F.when(twice, F.raise_error(message).cast(target.schema[key].dataType)).when(is_match, F.col("_key")).otherwise(F.col(key)),
        "_stale": stale,
        "_place": F.when(of_source & ~is_match, F.monotonically_increasing_id()),  # counts the new rows only
    }
    renamed = F.lit(False)
    if first_col:
        # the first writer's as the target has it, unless this batch is an earlier one
        renamed = F.when(of_source, is_match & F.coalesce(F.col("_first") > stamp, F.lit(True)))
        renamed = renamed.otherwise(is_matched & F.coalesce(F.col(first_col) > stamp, F.lit(True)))
        theirs = F.when(is_match & ~renamed, F.col("_first")).when(of_source | renamed, stamp)
        values[first_col] = theirs.otherwise(F.col(first_col))
    for c in keep_on_match:
        values[c] = F.when(is_match & ~renamed, F.col(f"_kept_{c}")).when(~of_source & renamed, F.col(f"_new_{c}")).otherwise(F.col(c))
    merged = seen.filter(of_source | ~is_matched | stale).withColumns(values)
    columns = dict.fromkeys([*own, *names, "_of_source", "_stale", "_place"])
    placed = written(merged.select(*columns), "matched")

    numbered, last = number_placed(placed, key, start_after)
    found = numbered.filter("_of_source")
    whole = numbered.filter("NOT (_of_source AND _stale)").select(*own)
    return Upsert(found.select(*names), found.filter("NOT _stale").select(*names), placed.filter("NOT _of_source").select(*own), last, whole)
