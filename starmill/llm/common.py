"""Words, keys and bounded broadcasts shared by the operators of this subpackage."""

from __future__ import annotations

import os
import string
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import starmill

from starmill.session import written

#: ASCII characters that end a word: everything but digits, letters and what lies beyond ASCII.
SEPARATORS = "".join(chr(i) for i in range(128) if not chr(i).isalnum())
_SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Tables up to this many bytes on disk may be sent to every executor.
BROADCAST_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


#: Rows to a batch of texts. Spark's own default of ten thousand is meant for narrow rows.
BATCH_SETTING, DEFAULT_BATCH, TEXT_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def ship(spark: SparkSession) -> None:
    """Prepares the session for code in Python workers.

    Sends this package to the executors, once for each application, for workers
    that don't have it installed. Unless the session has a batch size of its own,
    batches get a thousand rows, which bounds what a worker holds of long texts.
    """
    if spark.conf.get(BATCH_SETTING) == DEFAULT_BATCH:
        spark.conf.set(BATCH_SETTING, TEXT_BATCH)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(starmill.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="starmill-"), "starmill-package.zip")  # Spark serves it from the driver
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:  # type: ignore[no-untyped-def]
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: Column) -> Column:
    """Words of a text as an array; no text and no words both give an empty array."""
    inner = F.btrim(text, F.lit(SEPARATORS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _SPLIT, -1))


def row_key(text: Column) -> Column:
    """Tells rows with one id and different texts apart; equal rows share it, as they share their results."""
    return F.xxhash64(text)


def bytes_of(df: DataFrame) -> int:
    """Size on disk of a table read from files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fitting(df: DataFrame) -> DataFrame:
    """Marks a written table for broadcast where its files are small; a larger one is left to a shuffle join."""
    return F.broadcast(df) if bytes_of(df) <= BROADCAST_BYTES else df


def same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    """Join condition under which nulls are equal."""
    condition = a[columns[0]].eqNullSafe(b[columns[0]])
    for c in columns[1:]:
        condition &= a[c].eqNullSafe(b[c])
    return condition


__all__ = ["BROADCAST_BYTES", "SEPARATORS", "bytes_of", "fitting", "lower_ascii", "map_arrow", "row_key", "same", "ship", "table", "text_of", "words_of", "written"]
