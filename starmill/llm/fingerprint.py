"""Fingerprints by a randomised embedding of edit distance into Hamming distance.

A text is read by a walk over its characters: at step j the character c under
the walk is written out, and a shared random bit for (j, c) says whether the
walk goes on to the next character. Texts at a small edit distance fall into
step again after a difference, so what they write out differs in few places.
The fingerprint is a sample of what is written, at shared places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import fitting, map_arrow, row_key, ship, text_of, written
from starmill.llm.graph import link_buckets

_DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


@dataclass(frozen=True)
class EditEmbedding:
    """``period`` is a power of two; the bits repeat after that many steps. ``samples`` places are taken from each octave."""

    seed: int = 7041776
    classes: int = 64
    period: int = 4096
    samples: int = 64
    octaves: int = 40
    #: Banding: samples to a band, bands of a text, and the likeness from which two texts are near.
    band: int = 8
    bands: int = 80
    near: float = 0.75


@lru_cache(maxsize=4)
def _tables(how: EditEmbedding) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps spent on a character by (class, step), sampled places, and their weights: the steps that a sample stands for."""
    rng = np.random.default_rng(how.seed)
    go = rng.integers(0, 2, (how.classes, how.period), dtype=np.uint8)
    go[:, -1] = 1  # so that every walk goes on
    spent = np.zeros((how.classes, how.period), np.uint8)
    wait = np.zeros(how.classes, np.int64)
    for j in range(how.period - 1, -1, -1):
        wait = np.where(go[:, j] == 1, 1, np.minimum(wait + 1, 255))
        spent[:, j] = wait
    first = (how.samples - 1).bit_length()
    places, weights = [np.arange(1 << first)], [np.ones(1 << first)]
    for octave in range(first, how.octaves):
        # sampled by strata, so that the share of places before any step is the share of steps
        width = (1 << octave) / how.samples
        at = (1 << octave) + np.floor((np.arange(how.samples) + rng.random(how.samples)) * width)
        places.append(at.astype(np.int64))
        weights.append(np.full(how.samples, width))
    return spent.astype(np.int64).ravel(), np.concatenate(places), np.concatenate(weights)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def walk(texts: list[np.ndarray], begins: np.ndarray, how: EditEmbedding, block: int = 1 << 21) -> list[np.ndarray]:
    """Steps at which each character of each text is reached, and the step after the last; all texts go side by side."""
    spent, _, _ = _tables(how)
    mask, out = how.period - 1, [np.empty(0, np.int64)] * len(texts)
    order = np.argsort([-len(t) for t in texts], kind="stable")
    lo = 0
    while lo < len(order):
        hi, held = lo, 0
        while hi < len(order) and (hi == lo or held + len(texts[order[hi]]) + 1 <= block):
            held += len(texts[order[hi]]) + 1
            hi += 1
        picked = order[lo:hi]
        sizes = np.array([len(texts[i]) for i in picked])
        active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0] + 1), side="left")  # texts that have an i-th character, or end there
        offset = np.concatenate([[0], np.cumsum(active)])
        # the i-th characters of all texts lie side by side
        symbols = np.zeros(offset[-1], np.int64)
        for d, i in enumerate(picked):
            symbols[offset[: sizes[d]] + d] = (_mixed(texts[i]) >> np.uint64(40)).astype(np.int64) % how.classes * how.period
        steps = np.empty(offset[-1], np.int64)
        t = begins[picked].astype(np.int64)
        for i in range(sizes[0] + 1):
            k, at = active[i], offset[i]
            t = t[:k]
            steps[at : at + k] = t
            t = t + spent[symbols[at : at + k] + (t & mask)]
        for d, i in enumerate(picked):
            out[i] = steps[offset[: sizes[d] + 1] + d]
        lo = hi
    return out


def sample(codes: np.ndarray, steps: np.ndarray, how: EditEmbedding) -> np.ndarray:
    """Hexadecimal digits: four hashed bits of the character that the walk is on at each sampled place."""
    places = _tables(how)[1]
    places = places[: np.searchsorted(places, steps[-1])]
    at = np.searchsorted(steps, places, side="right") - 1
    return _DIGITS[(_mixed(codes[at] + np.uint64(1)) >> np.uint64(50)) & np.uint64(15)]


def likeness(a: np.ndarray, b: np.ndarray, how: EditEmbedding) -> float:
    """Weighted share of agreeing samples over the longer text's walk, freed of chance agreement; 0 to 1."""
    n = max(len(a), len(b))
    if not n:
        return 1.0
    weights = _tables(how)[2][:n]
    m = min(len(a), len(b))
    agreed = float(weights[:m][a[:m] == b[:m]].sum() / weights.sum())
    return max(0.0, (agreed - 1 / 16) * 16 / 15)


def _codes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")


def _chunks(batches: Iterator[pa.RecordBatch], rows: int = 2048, chars: int = 1 << 22) -> Iterator[list[tuple]]:
    """Rows (doc_id, bucket, ahead, text) in order, in lists bounded by rows and by characters."""
    held, size = [], 0
    for batch in batches:
        columns = [batch.column(c) for c in ("doc_id", "bucket", "ahead", "text")]
        for doc_id, bucket, ahead, text in zip(*columns, strict=True):
            text = text.as_py()
            held.append((doc_id.as_py(), bucket.as_py(), ahead.as_py(), text))
            size += len(text)
            if len(held) >= rows or size >= chars:
                yield held
                held, size = [], 0
    if held:
        yield held


def _fingerprints(batches: Iterator[pa.RecordBatch], how: EditEmbedding) -> Iterator[pa.RecordBatch]:
    """Every row has its next one behind it; the last of a bucket has a copy of the next bucket's first behind it."""
    carried: list[tuple] = []
    for rows in _chunks(batches):
        rows = carried + rows
        codes = [_codes(r[3]) for r in rows]
        steps = walk(codes, np.zeros(len(rows), np.int64), how)
        prints = [sample(c, s, how) for c, s in zip(codes, steps, strict=True)]
        done = [i for i in range(len(rows) - 1) if not rows[i][2]]
        if any(rows[i][1] != rows[i + 1][1] for i in done):
            raise RuntimeError("a row without the next one behind it")
        sizes = [len(codes[i]) // 3 for i in done]
        tails = [codes[i + 1][:n] for i, n in zip(done, sizes, strict=True)]
        cuts = [len(codes[i]) - n for i, n in zip(done, sizes, strict=True)]
        later = walk(tails, np.array([steps[i][c] for i, c in zip(done, cuts, strict=True)], np.int64), how)
        columns: list[list] = [[] for _ in range(7)]
        for i, tail, cut, end in zip(done, tails, cuts, later, strict=True):
            edited = np.concatenate([codes[i][:cut], tail])
            other = sample(edited, np.concatenate([steps[i][:cut], end]), how)
            digest = sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest()
            values = rows[i][0], len(codes[i]), digest, prints[i].tobytes().decode(), other.tobytes().decode(), likeness(prints[i], other, how), likeness(prints[i], prints[i + 1], how)
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _COLUMNS.split(", ")])
        carried = [] if rows[-1][2] else rows[-1:]
    if carried:
        raise RuntimeError("the last row has no next one behind it")


_COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_following(docs: DataFrame) -> DataFrame:
    """doc_id, text, bucket, ahead: ``docs`` by descending id in buckets, each ending with a copy of the row that follows it.

    Buckets are ranges of ids of about equal size, as many as there are shuffle
    partitions. One row of each bucket, that with its largest id, is also sent
    to the bucket above; that with the largest id of all to the lowest bucket.
    """
    spark = docs.sparkSession
    ship(spark)
    lowest = -(1 << 63)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    ids = docs.select(F.coalesce("doc_id", F.lit(lowest)).alias("at"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)] or [F.lit(0.5)])
    bounds = np.unique(np.array(ids.agg(F.percentile_approx("at", shares, 20 * parts)).first()[0] or [], np.int64))

    @F.pandas_udf("long")
    def bucket(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, at.to_numpy(np.int64), side="right"))

    # one row per bucket
    tops = dict(sorted((int(r[0]), int(r[1])) for r in ids.select("at", bucket("at").alias("bucket")).groupBy("bucket").agg(F.max("at")).collect()))
    above = dict(zip(tops.values(), [*list(tops)[1:], *list(tops)[:1]], strict=True))

    @F.pandas_udf("long")
    def goes_ahead(at: pd.Series) -> pd.Series:
        return at.map(lambda x: above.get(x, -1)).astype("int64")

    at = F.coalesce("doc_id", F.lit(lowest))
    dealt = docs.withColumn("own", bucket(at)).withColumn("other", goes_ahead(at))
    target = lambda b, ahead: F.struct(b.alias("bucket"), F.lit(ahead).alias("ahead"))
    targets = F.when(F.col("other") >= 0, F.array(target(F.col("own"), False), target(F.col("other"), True))).otherwise(F.array(target(F.col("own"), False)))
    dealt = dealt.select("doc_id", "text", F.inline(targets))
    return dealt.repartition("bucket").sortWithinPartitions("bucket", "ahead", F.desc_nulls_last("doc_id"), row_key(F.col("text")))


def fingerprints(docs: DataFrame, how: EditEmbedding | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last third replaced by the beginning
    of the next document's, in descending order of ids; the last one's next is
    the first. Null texts are empty and have an empty fingerprint; two empty
    fingerprints are alike (1), an empty and another are not (0). Null ids come
    last; rows with one id follow each other in the order of their texts'
    hashes. A single row is followed by itself. Other columns are left out.
    """
    how = how or EditEmbedding()
    return map_arrow(with_following(docs).select("doc_id", "bucket", "ahead", "text"), lambda batches: _fingerprints(batches, how), _COLUMNS)


@lru_cache(maxsize=4)
def _picks(how: EditEmbedding) -> np.ndarray:
    """For every number of samples and every slot of every band, the sample that the slot takes.

    Of the samples there are, each is taken with a chance in proportion to its
    weight, and a longer walk takes another one only from what it has more.
    """
    weights = _tables(how)[2]
    drawn = np.random.default_rng(how.seed + 1).exponential(size=(len(weights), how.bands * how.band)) / weights[:, None]
    least = np.minimum.accumulate(drawn, axis=0)
    at = np.where(drawn == least, np.arange(len(weights))[:, None], 0)
    return np.maximum.accumulate(at, axis=0).astype(np.int16)


def bands_of(fingerprint: bytes, how: EditEmbedding) -> np.ndarray:
    """Hashes of the bands of a fingerprint that isn't empty.

    A slot of two fingerprints agrees with a chance of the weighted share of
    agreeing samples, over all octaves and over an unfinished one as far as it
    goes. At a likeness of 0.75 that share is 0.766: 80 bands of 8 are all
    missed with a chance of 5e-5.
    """
    values = np.frombuffer(fingerprint, np.uint8)
    taken = _picks(how)[len(values) - 1].reshape(how.bands, how.band)
    slots = taken.astype(np.uint64) << np.uint64(8) | values[taken]
    hashed = _mixed(np.arange(1, how.bands + 1))
    for k in range(how.band):
        hashed = _mixed(hashed ^ slots[:, k])
        hashed ^= hashed >> np.uint64(32)
    return hashed.view(np.int64)


_PACKED = "doc_id long, samples array<long>, others array<long>, weights array<double>, weight double"


def _packed(batches: Iterator[pa.RecordBatch], how: EditEmbedding) -> Iterator[pa.RecordBatch]:
    """Fingerprints as longs of sixteen samples, filled up with zeros (``samples``) or ones (``others``), the weight of a sample of each long, and the sum of all.

    All samples of a long have one weight, since an octave holds a multiple of sixteen.
    """
    weights = _tables(how)[2]
    for batch in batches:
        columns: list[list] = [[], [], [], []]
        for text in batch.column("fingerprint"):
            digits = text.as_py()
            n = -(-len(digits) // 16)
            for column, filling in zip(columns, "0f", strict=False):
                column.append(np.frombuffer(bytes.fromhex(digits.ljust(16 * n, filling)), ">i8").astype(np.int64))
            columns[2].append(weights[: 16 * n : 16])
            columns[3].append(float(weights[: len(digits)].sum()))
        kinds = pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.float64()
        yield pa.record_batch([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["doc_id", "samples", "others", "weights", "weight"])


def _may_be_near(x: str, y: str, how: EditEmbedding) -> Column:
    """Whether the likeness of two packed fingerprints is ``how.near``, but for rounding."""

    def agreeing(a: Column, b: Column) -> Column:
        other = a.bitwiseXOR(b)
        other = other.bitwiseOR(F.shiftrightunsigned(other, 1))
        other = other.bitwiseOR(F.shiftrightunsigned(other, 2)).bitwiseAND(F.lit(0x1111111111111111))
        return F.coalesce(16 - F.bit_count(other), F.lit(0))  # beyond the end of one

    counts = F.zip_with(F.col(f"{x}.samples"), F.col(f"{y}.others"), agreeing)
    valued = F.zip_with(counts, F.col(f"{x}.weights"), lambda n, w: F.coalesce(n * w, F.lit(0.0)))
    agreed = F.aggregate(valued, F.lit(0.0), lambda total, v: total + v)
    return agreed >= (how.near * 15 / 16 + 1 / 16 - 1e-9) * F.greatest(f"{x}.weight", f"{y}.weight")


def with_groups(prints: DataFrame, how: EditEmbedding | None = None) -> DataFrame:
    """The rows of ``prints`` (doc_id, fingerprint and others) with ``group_id``: the smallest id that near fingerprints reach.

    Two fingerprints are near from a likeness of ``how.near``. Those that share
    a band are compared; equal ones are one from the start. Null ids have no
    group; empty fingerprints stand alone.
    """
    how = how or EditEmbedding()
    prints = prints.drop("group_id")
    named = prints.select(F.col("doc_id").cast("long").alias("doc_id"), "fingerprint").where("doc_id is not null and fingerprint <> ''")
    same_print = written(named.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")), "prints")

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                buckets = np.concatenate([bands_of(p.as_py().encode(), how) for p in batch.column("fingerprint")])
                yield pa.record_batch([pa.array(np.repeat(batch.column("doc_id").to_numpy(), how.bands)), pa.array(buckets)], names=["doc_id", "bucket"])

    members = map_arrow(same_print.select("doc_id", "fingerprint"), band, "doc_id long, bucket long")

    def alike(pairs: DataFrame) -> DataFrame:
        side = lambda x: same_print.select(F.col("doc_id").alias(x), F.col("fingerprint").alias(f"print_{x}"))

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sides = [[np.frombuffer(p.as_py().encode(), np.uint8) for p in batch.column(f"print_{x}")] for x in "ab"]
                good = [likeness(a, b, how) >= how.near for a, b in zip(*sides, strict=True)]
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

        return map_arrow(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "print_a", "print_b"), check, "a long, b long")

    def weigh(ids: DataFrame) -> DataFrame:
        named = same_print.select("doc_id", "fingerprint").join(ids, "doc_id", "left_semi")
        return map_arrow(named, lambda batches: _packed(batches, how), _PACKED)

    same = lambda pairs: pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
    sieve = (weigh, lambda x, y: _may_be_near(x, y, how)) if how.samples % 16 == 0 else ()
    components = link_buckets(members, alike, same, *sieve)
    ends = fitting(components.select(F.col("node").alias("doc_id"), "component"))
    # a fingerprint that is neither shared nor near another is the group of its own id
    groups = same_print.join(ends, "doc_id", "left").where("n > 1 or component is not null").select(F.col("fingerprint").alias("of"), F.coalesce("component", "doc_id").alias("group_id"))
    groups = fitting(written(groups, "print-groups"))
    own = F.col("doc_id").cast("long")
    grouped = prints.join(groups, F.col("fingerprint") == F.col("of"), "left")
    return grouped.select(*prints.columns, F.when(own.isNotNull(), F.coalesce("group_id", own)).alias("group_id"))


def near_texts(prints: DataFrame, how: EditEmbedding | None = None) -> DataFrame:
    """doc_id, group_id for every row of ``prints`` (doc_id, fingerprint) with an id, as of ``with_groups``."""
    prints = prints.select(F.col("doc_id").cast("long").alias("doc_id"), "fingerprint").where("doc_id is not null")
    return with_groups(prints, how).select("doc_id", "group_id")
