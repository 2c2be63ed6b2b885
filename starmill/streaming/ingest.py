"""Polling of a drop folder through Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starmill.plans.load import load_warehouse, stage_rows
from starmill.plans.model import LoadConfig
from starmill.sources.feed import FeedSpec, csv_options, decode, typed_rows
from starmill.sources.store import Warehouse


def read_feed_stream(
    spark: SparkSession,
    folder: str,
    spec: FeedSpec,
    archive_dir: str | None = None,
    encoding: str = "cp1252",
    multi_line: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """Classified rows of every file that appears in ``folder``.

    A file is recognised by its name: one that is dropped again under the same
    name is not read again, for that use ``ingest_file``. Files are archived by
    the source itself, a file at a time after a later run has begun. Records
    that run over line ends need ``multi_line``, which reads each file in one
    task; without it, large files are split and such records are quarantined.
    """
    options = csv_options(encoding, multi_line)
    if archive_dir:
        options.update(cleanSource="archive", sourceArchiveDir=archive_dir)
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    raw = spark.readStream.schema(spec.text_schema).options(**options).csv(folder)
    return typed_rows(decode(raw, encoding), spec)


def ingest_stream(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    spec: FeedSpec,
    on_batch: Callable[[DataFrame, int], None],
    archive_dir: str | None = None,
    encoding: str = "cp1252",
    multi_line: bool = False,
    max_files: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Hand every new set of files to ``on_batch``; without ``interval`` take what is there and stop."""
    rows = read_feed_stream(spark, folder, spec, archive_dir, encoding, multi_line, max_files)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        rows.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def poll_warehouse(
    warehouse: Warehouse,
    folder: str,
    checkpoint: str,
    config: LoadConfig = LoadConfig(),
    archive_dir: str | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(UTC).replace(tzinfo=None),
    load: bool = True,
    **options,
) -> StreamingQuery:
    """Stage, and unless ``load`` is off load, every micro-batch of a drop folder.

    The staged batch is named by the stream and the micro-batch number, so a
    repeated micro-batch replaces its own staging and keeps the stamp of its
    first, and the upsert by natural key makes the repeated load have no further
    effect. Batches of other schedules may be loaded before or after it.
    """
    stream = f"stream_{crc32(checkpoint.encode()):08x}"

    def on_batch(rows: DataFrame, number: int) -> None:
        batch = stage_rows(warehouse, rows, clock(), f"{stream}_{number:012d}")
        if load:
            load_warehouse(warehouse, config, batch)

    return ingest_stream(warehouse.spark, folder, checkpoint, config.feed, on_batch, archive_dir, **options)
