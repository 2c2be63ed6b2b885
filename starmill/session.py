"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # joins whose hash tables are known to be small need no sort
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    # plans of tables are not kept, so that a view shows what another session has loaded
    "spark.sql.filesourceTableRelationCacheSize": "0",
    "spark.ui.enabled": "false",
    # recording a call site for every column expression makes wide plans slow to build
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(name: str = "starmill", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_roots:
        _own_roots[application] = tempfile.mkdtemp(prefix="starmill-")
    return _own_roots[application]


_scope: ContextVar[str | None] = ContextVar("scratch_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Intermediate tables written inside the block go to one folder that is removed at its end.

    For jobs that write their results before they return. Outside of such a
    block the tables stay, since lazy results still read them.
    """
    from starmill.sources.files import remove_folder

    folder = f"{scratch_root(spark)}/starmill/{uuid.uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        remove_folder(spark, folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    base = _scope.get() or f"{scratch_root(spark)}/starmill"
    return f"{base}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Queries inside the block remove their shuffle files when they end, and not when the driver's memory is next cleaned."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def written(df: DataFrame, label: str, path: str | None = None, by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder, in folders by the column ``by``, and read it back.

    Cuts the lineage in a way that survives lost executors, keeps column
    pruning for later passes, and pins values that a second run of the plan
    could give differently (partition ids, row positions). The shuffles behind
    it are of no more use once it is written, and their files go at once.
    """
    path = path or scratch_path(df.sparkSession, label)
    with _shuffles_dropped(df.sparkSession):
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
