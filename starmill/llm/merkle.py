"""Manifest of a dataset as a persistent Merkle tree: a change copies the path to the root and shares everything else.

Rows are leaves, the leaves of a source lie side by side in the order of their
ids, and every run of 16 neighbouring nodes has one parent. The trees of the
sources end in subroots, over which one more tree ends in the root.

The trees are built from below in aligned blocks of two levels: a block's nodes
(256 at most) are hashed by one task, and its top is a node of the next table.
Then each block gets what lies above it, a run of digests for each level, so
that the version that a tampered leaf makes is copied within its block first
and goes on along those runs to a root of its own, in the same task. A version
holds its copied ancestors alone; every other node is that of the first tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starmill.llm.common import lower_ascii, map_arrow, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Tree:
    """``fan``: nodes to a run, ``levels``: levels of a block. A document is tampered where ``every`` divides the CRC of its id."""

    fan: int = 16
    levels: int = 2
    every: int = 5

    @property
    def block(self) -> int:
        return self.fan**self.levels


def encoded(*values: Column) -> Column:
    """The values one after the other: ``-`` for null, else byte count, colon, text."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def _hash(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaves_of(docs: DataFrame, how: Tree) -> DataFrame:
    """source, doc_id, leaf, tampered: digests of each row, the second (null for most) with the text's A-Z in lower case."""
    typed = {"doc_id": F.col("doc_id").cast("long"), "n_chars": F.col("n_chars").cast("long")}
    plain = [typed.get(c, F.col(c).cast("string")) for c in FIELDS]
    changed = [lower_ascii(c) if name == "text" else c for name, c in zip(FIELDS, plain, strict=True)]
    hit = F.crc32(typed["doc_id"].cast("string").cast("binary")) % how.every == 0
    digest = lambda columns: F.unhex(F.sha2(encoded(*columns).cast("binary"), 256))
    return docs.select(plain[1].alias("source"), typed["doc_id"].alias("doc_id"), digest(plain).alias("leaf"), F.when(hit, digest(changed)).alias("tampered"))


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``df`` with ``pos``: the place of a row within its group, from 0, in the order of ``order`` (nulls first).

    Rows are dealt by ranges of group and order, so that a large group lies in
    many tasks, and written with their place in the task. Each task can go on
    with one group only that others began; what it has to add is worked out
    from one row per task. Rows that are equal in all these columns are spread
    as well: which of them is first can't be told apart.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    parts, names = _parts(df), df.columns
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys, F.col("_tie")).sortWithinPartitions(*keys)
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.LongType()), T.StructField("at", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, at = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            places = []
            for value in batch.column(group).to_pylist():
                at = at + 1 if value == last else 0
                places.append(at)
                last = value
            yield pa.record_batch([*[batch.column(c) for c in names], pa.array([part] * batch.num_rows, pa.int64()), pa.array(places, pa.int64())], names=[*names, "part", "at"])

    held = written(map_arrow(dealt.select(*names), place, schema), label)
    # rows of the first and of the last group of every task: as many rows as there are tasks
    ends = held.groupBy("part").agg(
        F.min_by(group, F.struct(F.col(group).isNotNull(), F.col(group))).alias("first"),
        F.max_by(group, F.struct(F.col(group).isNotNull(), F.col(group))).alias("last"),
        F.max_by("at", F.struct(F.col(group).isNotNull(), F.col(group), F.col("at"))).alias("at"),
    )
    shifts, before, group_before = [], 0, None
    for row in sorted(ends.collect(), key=lambda r: r["part"]):
        goes_on = before if group_before == (row["first"],) else 0
        if goes_on:
            shifts.append((row["part"], row["first"], goes_on))
        before = row["at"] + 1 + (goes_on if row["first"] == row["last"] else 0)
        group_before = (row["last"],)
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("_first", held.schema[group].dataType), T.StructField("shift", T.LongType())])
    shifted = held.join(F.broadcast(df.sparkSession.createDataFrame(shifts, schema)), "part", "left")
    more = F.when(F.col(group).eqNullSafe(F.col("_first")), F.coalesce("shift", F.lit(0))).otherwise(F.lit(0))
    return shifted.select(*names, (F.col("at") + more).alias("pos"))


# -- one block -----------------------------------------------------------------


def climb(digests: list[str], levels: int, fan: int) -> list[list[str]]:
    """The nodes of a block level by level, from the given ones to ``levels`` above them."""
    rows = [digests]
    for _ in range(levels):
        below = rows[-1]
        rows.append([_hash(*below[i : i + fan]) for i in range(0, len(below), fan)])
    return rows


def levels_of(block: int, size: int, how: Tree) -> int:
    """Levels that a block climbs: fewer than ``how.levels`` only where it is all there is of its group and not full."""
    if block or size == how.block:
        return how.levels
    levels = 0
    while size > 1:
        size, levels = -(-size // how.fan), levels + 1
    return levels


class Versions:
    """A persistent block: its own nodes, the runs above it, and versions of both that copy one path.

    ``above`` has (place, run of digests) for each level from the block's top to
    the root.
    """

    def __init__(self, digests: list[str], levels: int, above: list[tuple[int, list[str]]], fan: int):
        self.rows, self.above, self.fan = climb(digests, levels, fan), above, fan
        self.beside_above = "".join(digest for place, run in above for i, digest in enumerate(run) if i != place)

    def runs(self, at: int) -> Iterator[tuple[int, list[str]]]:
        """(place, run) on every level on the way from a node to the root."""
        for level in self.rows[:-1]:
            start = at - at % self.fan
            yield at - start, level[start : start + self.fan]
            at //= self.fan
        yield from self.above

    def proof(self, at: int) -> str:
        """Digest of everything beside the way, level by level, from left to right."""
        parts = []
        for level in self.rows[:-1]:
            start = at - at % self.fan
            parts += level[start:at]
            parts += level[at + 1 : start + self.fan]
            at //= self.fan
        return _hash(*parts, self.beside_above)

    def copied(self, at: int, digest: str) -> list[str]:
        """The ancestors that a version with another node at this place copies, from its parent to its root."""
        out = []
        for place, run in self.runs(at):
            digest = _hash(*run[:place], digest, *run[place + 1 :])
            out.append(digest)
        return out


def _blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of neighbouring equal (grp, block), whatever batch they come in."""
    key, held = None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
            if held and row[:2] != key:
                yield key, held
                held = []
            key = row[:2]
            held.append(row)
    if held:
        yield key, held


# -- tables of nodes -------------------------------------------------------------


_NODES = "grp string, pos long, digest binary"
_ABOVE = "array<struct<place:int,run:binary>>"
_SPLIT = 32


def _by_block(nodes: DataFrame) -> DataFrame:
    """Nodes dealt by ranges of blocks and in order; a header, if there is one, comes first (pos is null)."""
    keys = F.col("grp").asc_nulls_first(), F.col("block")
    return nodes.repartitionByRange(_parts(nodes), *keys).sortWithinPartitions(*keys, F.col("pos").asc_nulls_first())


def _with_block(nodes: DataFrame, how: Tree) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / how.block))


def _lift(nodes: DataFrame, how: Tree) -> DataFrame:
    """The tops of all blocks: grp, pos, digest, and ``done`` where the group has come to one node."""

    def batch(out: list[tuple]) -> pa.RecordBatch:
        kinds = pa.string(), pa.int64(), pa.binary(), pa.bool_()
        return pa.record_batch([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["grp", "pos", "digest", "done"])

    def lift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (grp, block), rows in _blocks(batches, ["grp", "block", "digest"]):
            tops = climb([r[2].hex() for r in rows], levels_of(block, len(rows), how), how.fan)[-1]
            out.append((grp, block, bytes.fromhex(tops[0]), block == 0 and len(rows) < how.block))
            if len(out) >= 4096:
                yield batch(out)
                out = []
        yield batch(out)

    blocks = _by_block(_with_block(nodes, how)).select("grp", "block", "digest")
    return map_arrow(blocks, lift, _NODES + ", done boolean")


def _grow(leaves: DataFrame, how: Tree, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Tables of nodes from the leaves up, and the last node of every group (grp, digest).

    A table holds a 256th of the rows of the one below it, so there are few.
    """
    tables, done = [leaves], []
    while True:
        above = written(_lift(tables[-1], how), f"{label}-nodes")
        done.append(above.where("done").select("grp", "digest"))
        rest = above.where("not done").select("grp", "pos", "digest")
        if rest.isEmpty():
            break
        tables.append(rest)
    tops = done[0]
    for each in done[1:]:
        tops = tops.unionByName(each)
    return tables, tops


def _under(nodes: DataFrame, headers: DataFrame, function: Callable, schema: str, how: Tree) -> DataFrame:
    """``function`` of (header row, node rows) for every block, in rows of ``schema``.

    ``headers`` (grp, block, above, and what goes through) has one row for each
    block; it is dealt with the nodes and comes before them, so there is no join.
    """
    carried = [c for c in headers.columns if c not in ("grp", "block")]
    own = [c for c in nodes.columns if c not in ("grp", "pos")]
    marked = headers.withColumns({"pos": F.lit(None).cast("long"), **{c: F.lit(None).cast(nodes.schema[c].dataType) for c in own}})
    rows = _with_block(nodes, how).withColumns({c: F.lit(None).cast(headers.schema[c].dataType) for c in carried})
    dealt = _by_block(rows.unionByName(marked)).select("grp", "block", "pos", *carried, *own)
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[i] for r in out], f.type) for i, f in enumerate(arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for _, rows in _blocks(batches, ["grp", "block", "pos", *carried, *own]):
            header, below = rows[0], rows[1:]
            if header[2] is not None:
                raise RuntimeError("a block without what lies above it")
            split = 3 + len(carried)
            out += function(header[1], header[3:split], [(r[0], r[2], *r[split:]) for r in below])
            if len(out) >= 2048:
                yield batch(out)
                out = []
        yield batch(out)

    return map_arrow(dealt, run, schema)


def _runs(above: list[dict]) -> list[tuple[int, list[str]]]:
    """Runs as they are stored, in hexadecimal."""
    return [(a["place"], [a["run"][i : i + _SPLIT].hex() for i in range(0, len(a["run"]), _SPLIT)]) for a in above]


def _stored(runs: Iterator[tuple[int, list[str]]]) -> list[dict]:
    return [{"place": place, "run": bytes.fromhex("".join(run))} for place, run in runs]


def _pass_down(tables: list[DataFrame], tops: DataFrame, how: Tree, label: str) -> DataFrame:
    """Headers (grp, block, above, roots) of the blocks of the lowest table; ``tops`` (grp, above, roots) has what lies above each group."""
    headers = tops.select("grp", F.lit(0).cast("long").alias("block"), "above", "roots")

    def spread(block: int, carried: tuple, nodes: list[tuple]) -> list[tuple]:
        above, roots = carried
        tree = Versions([n[2].hex() for n in nodes], levels_of(block, len(nodes), how), _runs(above), how.fan)
        return [(grp, pos, _stored(tree.runs(i)), roots) for i, (grp, pos, _) in enumerate(nodes)]

    for k in range(len(tables) - 1, 0, -1):
        table = tables[k]
        # groups that ended below this table have no rows in it, and their headers go on as they are
        here = table.select("grp").distinct().withColumnRenamed("grp", "of")
        present = F.col("grp").eqNullSafe(F.col("of"))
        down = _under(table, headers.join(here, present, "left_semi"), spread, f"grp string, block long, above {_ABOVE}, roots array<string>", how)
        headers = written(down.unionByName(headers.join(here, present, "left_anti")), f"{label}-headers")
    return headers


def manifest(docs: DataFrame, how: Tree | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, leaf, subroot, root, proof_sha256, tampered, version, folded_root, verified.

    ``version`` holds the nodes that the row's version copies, from the leaf's
    parent to the new root, and is empty where the leaf is the root. Where the
    document isn't tampered the same path is hashed again from its own leaf.
    ``folded_root`` is the root of the version, ``verified`` says that it is the
    root of the tree, which is so for a tampered text without A-Z, too.

    Null ids come first in their source and are never tampered; rows of one id
    are ordered by their leaves, equal rows are leaves of their own. A null
    source is a source. The fields' own columns are read as bigint or text;
    other columns are left out. No rows give no rows.
    """
    how = how or Tree()
    digests = written(leaves_of(docs, how), "leaf-digests")  # so that texts are read once
    leaves = numbered(digests, "source", ["doc_id", "leaf"], "leaves").withColumnRenamed("source", "grp")
    tables, subroots = _grow(leaves.withColumn("digest", F.col("leaf")).select("grp", "pos", "digest"), how, "leaves")

    # one more tree, over the subroots
    upper = numbered(subroots.select(F.lit("").alias("all"), F.col("grp").alias("source"), "digest"), "all", ["source"], "subroots")
    over = upper.select(F.col("all").alias("grp"), "pos", "digest")
    upper_tables, root = _grow(over, how, "subroots")
    of_all = root.select("grp", F.array().cast(_ABOVE).alias("above"), F.array(F.lower(F.hex("digest"))).alias("roots"))

    def over_sources(block: int, carried: tuple, nodes: list[tuple]) -> list[tuple]:
        above, roots = carried
        tree = Versions([n[2].hex() for n in nodes], levels_of(block, len(nodes), how), _runs(above), how.fan)
        return [(source, _stored(tree.runs(i)), [digest.hex(), *roots]) for i, (_, _, digest, source) in enumerate(nodes)]

    named = upper.select(F.col("all").alias("grp"), "pos", "digest", "source")
    headers = _pass_down(upper_tables, of_all, how, "subroots")
    above = written(_under(named, headers, over_sources, f"grp string, above {_ABOVE}, roots array<string>", how), "above-sources")

    def versions(block: int, carried: tuple, nodes: list[tuple]) -> list[tuple]:
        above, (subroot, root) = carried
        tree, out = Versions([n[3].hex() for n in nodes], levels_of(block, len(nodes), how), _runs(above), how.fan), []
        for i, (source, _, doc_id, leaf, tampered) in enumerate(nodes):
            start = (leaf if tampered is None else tampered).hex()
            copied = tree.copied(i, start)
            folded = copied[-1] if copied else start
            out.append((doc_id, source, leaf.hex(), subroot, root, tree.proof(i), tampered is not None, copied, folded, folded == root))
        return out

    schema = "doc_id long, source string, leaf string, subroot string, root string, proof_sha256 string, tampered boolean, version array<string>, folded_root string, verified boolean"
    headers = _pass_down(tables, above, how, "leaves")
    return _under(leaves.select("grp", "pos", "doc_id", "leaf", "tampered"), headers, versions, schema, how)
