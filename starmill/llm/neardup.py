"""Near-duplicate groups: MinHash with banding, checked on signatures and then on whole sets.

A document's set is its distinct five-word shingles. Documents with equal sets
are one node. A node's signature is the minima of many universal hash
functions; nodes that agree in a whole band of minima meet in a bucket.

Pairs from the buckets are compared by their signatures and then, text against
text, by their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from starmill.llm.common import fitting, map_arrow, written
from starmill.llm.graph import link_buckets


@dataclass(frozen=True)
class MinHash:
    """At a similarity of exactly 0.75 a pair misses all bands with a chance of (1 - 0.75^rows)^bands, below 1e-6."""

    shingle: int = 5
    #: Two sets are linked if 100 * shared >= percent * all.
    percent: int = 75
    bands: int = 72
    rows: int = 6
    #: Bits of the sketch from which it is told that two sets differ in too much.
    sketch: int = 4096
    #: Pairs whose signatures put their similarity lower are not looked at further: nearly five deviations below 0.75.
    least_agreement: float = 0.64
    seed: int = 20240229

    @property
    def size(self) -> int:
        return self.bands * self.rows

    def multipliers(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        a, b = rng.integers(1, 2**63, (2, self.size), dtype=np.uint64)
        return a | np.uint64(1), b


class _WordHashes(dict):
    """Hashes of the words met so far; emptied when it holds ``limit`` words."""

    limit = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxh64_intdigest(word)
        return value


_M = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes | None, length: int, hashes: _WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles; of fewer words than ``length``, one for all of them."""
    words = (text or b"").lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    length = min(length, len(words))
    n = len(words) - length + 1
    rolled = np.full(n, length, np.uint64)
    for i in range(length):
        rolled = rolled * _M + each[i : i + n]
    return np.unique(_mixed(rolled))


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 512) -> np.ndarray:
    """Minima of the upper halves of a * x + b, over the upper halves x of the hashes."""
    x = shingles >> np.uint64(32)
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(x), block):
        part = np.multiply.outer(a, x[i : i + block])
        part += b[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _sign(batches: Iterator[pa.RecordBatch], how: MinHash) -> Iterator[pa.RecordBatch]:
    a, b = how.multipliers()
    hashes = _WordHashes()
    places = np.arange(how.bands, dtype=np.uint64)
    for batch in batches:
        sizes, keys, bands, marks = [], [], [], []
        for text in batch.column("text"):
            shingles = shingle_set(text.as_py(), how.shingle, hashes)
            sizes.append(len(shingles))
            if not len(shingles):
                keys.append(None), bands.append(None), marks.append(None)
                continue
            least = signature(shingles, a, b).reshape(how.bands, how.rows)
            key = places + np.uint64(1)
            for row in range(how.rows):
                key = _mixed(key * _M + least[:, row])
            keys.append(blake2b(shingles.tobytes(), digest_size=16).digest())
            bands.append(key.view(np.int64))
            marks.append(least.astype(np.uint8).ravel().view(np.int64))  # lowest eight bits of each minimum
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(marks, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "set_key", "marks", "bands"],
        )


def sign(docs: DataFrame, how: MinHash) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets), marks (a byte of each minimum, eight to a long), bands (bucket keys)."""
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return map_arrow(thin, lambda batches: _sign(batches, how), "doc_id long, n_shingles long, set_key binary, marks array<long>, bands array<long>")


def _agreement(a: Column, b: Column, how: MinHash) -> Column:
    """Estimated similarity: minima that differ still agree in half of their bits."""
    other_bits = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return 1 - 2 * other_bits / F.lit(8 * how.size)


def _near_in_size(a: Column, b: Column, how: MinHash) -> Column:
    return 100 * F.least(a, b) >= how.percent * F.greatest(a, b)


def _agreeing(pairs: DataFrame, nodes: DataFrame, how: MinHash) -> DataFrame:
    """Pairs (a, b) whose sizes allow a link and whose signatures agree enough."""
    side = lambda x: nodes.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("marks").alias(f"marks_{x}"))
    close = pairs.join(side("a"), "a").join(side("b"), "b").where(_near_in_size(F.col("n_a"), F.col("n_b"), how))
    return close.where(_agreement(F.col("marks_a"), F.col("marks_b"), how) >= how.least_agreement).select("a", "b")


def _linked(pairs: DataFrame, docs: DataFrame, how: MinHash) -> DataFrame:
    """Those pairs (a, b) that are links by their whole sets, as (u, v)."""
    ids = fitting(written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "pair-ids"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).join(ids, "doc_id", "left_semi")
    side = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        last, shingles = b"", np.empty(0, np.uint64)
        for batch in batches:
            good = []
            for text_a, text_b in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
                text = text_a.as_py() or b""
                if text != last:
                    last, shingles = text, shingle_set(text, how.shingle, hashes)
                other = shingle_set(text_b.as_py(), how.shingle, hashes)
                shared = len(np.intersect1d(shingles, other, assume_unique=True))
                good.append(100 * shared >= how.percent * (len(shingles) + len(other) - shared) > 0)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_())).rename_columns(["u", "v"])

    return map_arrow(both.select("a", "text_a", "text_b", "b"), check, "u long, v long").distinct()


def odd_sketch(shingles: np.ndarray, bits: int) -> np.ndarray:
    """One bit for each of ``bits`` places: whether an odd number of hashes fall on it.

    Two sketches differ in as many bits as the sets have hashes that only one
    of them holds, less two for every two of those that meet in one place: in
    no more than the sets differ in.
    """
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def _common_shingles(ids: DataFrame, docs: DataFrame, how: MinHash) -> DataFrame:
    """doc_id, size, common, sketch: shingles of each of these documents, those of them that another one has too, and a sketch of them.

    An id that has several rows has no sketch.
    """
    ids = fitting(written(ids, "compared-ids"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).join(ids, "doc_id", "left_semi")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), how.shingle, hashes) for t in batch.column("text")]
            lists = [[odd_sketch(s, how.sketch) for s in sets], [s.view(np.int64) for s in sets]]
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(x, pa.list_(pa.int64())) for x in lists]], names=["doc_id", "sketch", "shingles"])

    sets = written(map_arrow(texts, spell, "doc_id long, sketch array<long>, shingles array<long>"), "shingle-sets")
    each = sets.select("doc_id", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    several = each.groupBy("shingle").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("shingle")
    common = each.join(several, "shingle").groupBy("doc_id").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("common"))
    sketches = sets.groupBy("doc_id").agg(F.when(F.count(F.lit(1)) == 1, F.first("sketch")).alias("sketch"))
    return common.join(sketches, "doc_id")


def _may_link(x: str, y: str, how: MinHash) -> Column:
    """Sizes, what the sets can share at most, signatures, and what they differ in at least allow a link.

    Two sets share no more than either has in common with any other; a link of
    sets a and b shares percent / (100 + percent) of a + b at least, and so
    differs in (100 - percent) / (100 + percent) of it at most.
    """
    size_x, size_y, most = F.col(f"{x}.size"), F.col(f"{y}.size"), F.least(F.col(f"{x}.common"), F.col(f"{y}.common"))
    enough = (100 + how.percent) * most >= how.percent * (size_x + size_y)
    alike = _agreement(F.col(f"{x}.marks"), F.col(f"{y}.marks"), how) >= how.least_agreement
    bits = F.zip_with(F.col(f"{x}.sketch"), F.col(f"{y}.sketch"), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    differ = F.coalesce(F.aggregate(bits, F.lit(0), lambda n, b: n + b), F.lit(0))  # without a sketch nothing is known
    close = (100 + how.percent) * differ <= (100 - how.percent) * (size_x + size_y)
    return _near_in_size(size_x, size_y, how) & enough & alike & close


def near_duplicates(docs: DataFrame, how: MinHash | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest id among the documents that links reach,
    ``kept`` says whether that is the row's own. Null and empty texts have no
    shingles and are linked with nothing. Rows with one id and different texts
    are judged one by one; repeated rows are linked. A null id takes part in no
    group: its component is null and it is kept. Other columns are left out.
    """
    how = how or MinHash()
    signed = written(sign(docs, how), "signatures")
    groups = signed.where("doc_id is not null and n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n"))
    groups = fitting(written(groups.where("n > 1").select("set_key", "node"), "equal-sets"))
    # every node once: the smallest of a group of equal sets, and all that stand alone
    nodes = signed.where("doc_id is not null and n_shingles > 0").join(groups, "set_key", "left").where("node is null or node = doc_id")
    members = nodes.select("doc_id", F.explode("bands").alias("bucket"))
    components = link_buckets(
        members,
        lambda pairs: _agreeing(pairs, nodes, how),
        lambda pairs: _linked(pairs, docs, how),
        lambda ids: _common_shingles(ids, docs, how).join(nodes.select("doc_id", "marks"), "doc_id"),
        lambda x, y: _may_link(x, y, how),
    )

    out = signed.select("doc_id", "n_shingles", "set_key").join(groups, "set_key", "left")
    out = out.withColumn("at", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("node", "doc_id")))
    ends = fitting(components.select(F.col("node").alias("of"), "component"))
    out = out.join(ends, F.col("at") == F.col("of"), "left").select("doc_id", "n_shingles", "set_key", F.coalesce("component", "at", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, how: MinHash | None = None) -> DataFrame:
    """One row of each group: that with the smallest id, with all its columns.

    Of repeated rows (one id, equal texts) one stays. Rows with an empty text
    or a null id stay. Where one id has different texts, all its rows go if one
    of them is a near copy of a smaller id's.
    """
    found = written(near_duplicates(docs, how), "near-duplicates")
    gone = fitting(written(found.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct(), "near-copies"))
    left = docs.join(gone, docs["doc_id"].cast("long") == F.col("gone_id"), "left_anti")
    repeated = found.where("kept and doc_id is not null and n_shingles > 0").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("again_id"))
    repeated = written(repeated, "repeated-rows")
    if repeated.isEmpty():
        return left
    again = docs["doc_id"].cast("long") == F.col("again_id")
    return left.join(fitting(repeated), again, "left_anti").unionByName(left.join(fitting(repeated), again, "left_semi").dropDuplicates(["doc_id", "text"]))
