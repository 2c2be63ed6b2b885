"""Packing by binary decomposition: documents are cut into pieces of power-of-two length.

Each piece is a sequence of its own, so no sequence crosses documents and none
needs padding; sequences are numbered bucket by bucket, a bucket holding all
pieces of one length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmill.llm.common import fitting, map_arrow, written

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, part int, place long"


#: Letters whose lower case and composition are the same for everyone: ASCII and Latin-1. Apostrophes may begin a suffix and are left out.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(rf"([{_LETTERS}]*)([!-&(-/:-@\[-`{{-~]*)")


class ChunkIds(dict):
    """Ids of a run of characters without ASCII white space, as packed little-endian uint32.

    No token of the vocabulary holds white space, so such runs are encoded one
    by one; most occur many times. A run of letters with signs behind it is two
    words to this kind of tokenizer, which go straight to its merges; any other
    run goes through all of it. The first ``limit`` runs and words are kept.
    """

    limit, longest = 250_000, 64

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.bytes = self.tokenizer.pre_tokenizer[1] if self._words_by_pattern() else None
        self.words: dict[str, bytes] = {"": b""}

    def _words_by_pattern(self) -> bool:
        """Whether letters with signs behind them really are cut and encoded as assumed."""
        pre = self.tokenizer.pre_tokenizer
        cut = [w for w, _ in pre.pre_tokenize_str("ab\u00e9..,")]
        return type(pre).__name__ == "Sequence" and len(cut) == 2 and cut[1] == "..,"

    def encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if (ids := self.words.get(word)) is None:
            spelled = word if word.isascii() else self.bytes.pre_tokenize_str(word)[0][0]
            ids = np.asarray([t.id for t in self.merges.tokenize(spelled)], "<u4").tobytes()
            if len(self.words) < self.limit:
                self.words[word] = ids
        return ids

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) > self.longest:
            return self.encode(chunk)
        plain = _PLAIN.fullmatch(chunk) if self.bytes is not None else None
        ids = self._word(plain[1].lower()) + self._word(plain[2]) if plain else self.encode(chunk)
        if len(self) < self.limit:
            self[chunk] = ids
        return ids


@lru_cache(maxsize=2)
def chunk_ids(path: str) -> ChunkIds:
    """One for each tokenizer and process, which a Python worker keeps from task to task."""
    return ChunkIds(path)


def token_ids(text: str, chunks: ChunkIds, end: int) -> bytes:
    text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
    ids = b"".join(map(chunks.__getitem__, text.split(" ")))
    return ids + int(end).to_bytes(4, "little")


def cuts(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: as many of the longest as fit, then the binary digits of the rest."""
    pieces = [(i, longest) for i in range(0, n - n % longest, longest)]
    at, rest = n - n % longest, n % longest
    while rest:
        length = 1 << (rest.bit_length() - 1)
        pieces.append((at, length))
        at, rest = at + length, rest - length
    return pieces


def _pieces(batches: Iterator[pa.RecordBatch], path: str, longest: int, end: int) -> Iterator[pa.RecordBatch]:
    chunks, part = chunk_ids(path), TaskContext.get().partitionId()
    placed = dict.fromkeys((1 << i for i in range(longest.bit_length())), 0)
    for batch in batches:
        rows: list[list] = [[] for _ in range(7)]
        held = 0
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            ids = token_ids(text.as_py() or "", chunks, end)
            for start, length in cuts(len(ids) // 4, longest):
                row = doc_id, start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4, part, placed[length]
                placed[length] += 1
                for column, value in zip(rows, row, strict=True):
                    column.append(value)
            held += len(ids)
            if held >= 1 << 24:
                yield _batch(rows)
                rows, held = [[] for _ in range(7)], 0
        yield _batch(rows)


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
    return pa.record_batch([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=["doc_id", "start", "length", "ids", "doc_tokens", "part", "place"])


def pack(docs: DataFrame, tokenizer_path: str, longest: int = 2048, end: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (packed uint32), doc_tokens, sequence_id, offset.

    ``longest`` is a power of two. A document's ids are its text's and ``end``;
    null and empty texts are the one id ``end``. Rows with one id are packed
    one by one. Sequences are numbered from 0 without gaps, longest bucket
    first. Each piece has its place in its task's share of a bucket when it is
    written; the shares' first numbers come from their counts. No documents,
    no rows. Other columns are left out.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"not a power of two: {longest}")
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = written(map_arrow(thin, lambda batches: _pieces(batches, tokenizer_path, longest, end), PIECES), "pieces")
    # one row per task and length; the tasks are added up within each length, and the few lengths among each other
    shares = written(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "shares")
    before = W.unboundedPreceding, -1
    longer = shares.groupBy("length").agg(F.sum("n").alias("n")).select("length", F.coalesce(F.sum("n").over(W.orderBy(F.desc("length")).rowsBetween(*before)), F.lit(0)).alias("longer"))
    earlier = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(*before)), F.lit(0))
    first = shares.select("length", "part", earlier.alias("earlier")).join(F.broadcast(longer), "length")  # a row for each power of two up to the longest
    first = fitting(written(first.select("length", "part", (F.col("longer") + F.col("earlier")).alias("first")), "first-sequences"))
    out = pieces.join(first, ["length", "part"])
    return out.select("doc_id", "start", "length", "ids", "doc_tokens", (F.col("first") + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
