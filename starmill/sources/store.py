"""The warehouse: partitioned tables of Spark's catalog, found again in their folder by another application."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.plans.model import AGGREGATES, BUCKETED_BY, CARRIED, STAGING, STORED_BY, TABLES
from starmill.sources import files

BUCKETS = 8
#: After this time a lock is that of a load that did not live to remove it.
LOCK = timedelta(hours=12)


class LoadConflict(RuntimeError):
    """Another load is at work; the batch is still staged and can be loaded after it."""


class Warehouse:
    """Databases ``stage``, ``dwh`` and ``analytics``, named with ``prefix`` before that, with tables in folders under ``root``.

    Tables are partitioned by season where they have one, and by a hash of
    their key into ``buckets`` (fixed when the warehouse is made), and written
    by dynamic partition overwrite: what a batch does not touch is not written.
    Any session of the catalog reads them by name.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", buckets: int = BUCKETS):
        self.spark, self.root, self.prefix, self.buckets = spark, root.rstrip("/"), prefix, buckets

    # -- set-up ---------------------------------------------------------------

    def create(self) -> Warehouse:
        """Make what is missing; tables that lie in the folder already are taken into the catalog as they are."""
        files.make_folder(self.spark, self.root)
        try:
            files.write_small_text(self.spark, f"{self.root}/buckets", str(self.buckets))
        except FileExistsError:
            self.buckets = int(files.read_small_text(self.spark, f"{self.root}/buckets"))
        for layer in ("stage", "dwh", "analytics"):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} LOCATION '{self.root}/{layer}'")
        for name in (*STAGING, *TABLES, *AGGREGATES):
            self._create_table(name)
        return self

    def _create_table(self, name: str) -> None:
        table, path = self.name(name), self.path(name)
        if not self.spark.catalog.tableExists(table):
            there, by = files.path_exists(self.spark, path), ", ".join(self.addresses(name))
            columns = T.StructType.fromDDL(self.columns(name)).toDDL()
            options = "OPTIONS (partitionOverwriteMode 'dynamic')"
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {options} PARTITIONED BY ({by}) LOCATION '{path}'")
            if there:
                self.spark.sql(f"MSCK REPAIR TABLE {table}")
            self._measure(name)
        held = self.spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"]
        if held.split(":", 1)[-1].strip("/") != path.split(":", 1)[-1].strip("/"):
            raise ValueError(f"{table} belongs to another warehouse, in {held}; give a prefix")

    def name(self, table: str) -> str:
        """The table's name in the catalog."""
        return f"{self.prefix}{'stage' if table in STAGING else 'dwh'}.{table}"

    def path(self, table: str) -> str:
        return f"{self.root}/{'stage' if table in STAGING else 'dwh'}/{table}"

    def addresses(self, name: str) -> list[str]:
        """The columns a table is partitioned by."""
        if name in STAGING:
            return [c.split()[0] for c in STAGING[name][1].split(", ")]
        return [*([STORED_BY[name]] if name in STORED_BY else []), *(["bucket"] if name in TABLES else [])]

    def columns(self, name: str) -> str:
        if name in STAGING:
            return ", ".join(STAGING[name])
        if name in AGGREGATES:
            return AGGREGATES[name]
        by = [f"{STORED_BY[name]} bigint"] if name in STORED_BY else []
        return ", ".join([TABLES[name], *([CARRIED[name]] if name in CARRIED else []), *by, "bucket int"])

    # -- tables ---------------------------------------------------------------

    def stored(self, name: str) -> DataFrame:
        """The table with its address and carried columns."""
        return self.spark.table(self.name(name))

    def table(self, name: str) -> DataFrame:
        return self.stored(name).select(T.StructType.fromDDL(TABLES[name]).fieldNames())

    def bucket(self, name: str, folded: Mapping[str, Column]) -> Column:
        """The bucket of a row; ``folded`` has the key columns in the form in which they are compared."""
        keys = BUCKETED_BY.get(name)
        return F.pmod(F.xxhash64(*[folded.get(k, F.col(k)) for k in keys]), F.lit(self.buckets)).cast("int") if keys else F.lit(0)

    def replace(self, name: str, rows: DataFrame) -> None:
        """Write whole partitions; those that ``rows`` has no row of stay as they are. ``rows`` may be read from the table itself."""
        rows.select(self.stored(name).columns).write.insertInto(self.name(name), overwrite=True)
        self._measure(name)

    def _measure(self, name: str) -> None:
        """Tell the planner the size of a table; of one it knows nothing about it thinks that it is endless."""
        if name not in STAGING:
            self.spark.sql(f"ANALYZE TABLE {self.name(name)} COMPUTE STATISTICS NOSCAN")

    def add_columns(self, name: str, schema: T.StructType) -> None:
        """Widen a table by the columns it lacks."""
        lacking = [T.StructField(f.name, f.dataType) for f in schema if f.name not in self.stored(name).columns]
        if lacking:
            self.spark.sql(f"ALTER TABLE {self.name(name)} ADD COLUMNS ({T.StructType(lacking).toDDL()})")

    def drop_batch(self, name: str, batch: str) -> None:
        """Drop what a staging table holds of a batch."""
        for path in self.partitions(name):
            spec = dict(p.split("=", 1) for p in path.split("/"))
            if spec["batch"] == batch:
                values = ", ".join(f"{k}='{v}'" for k, v in spec.items())
                self.spark.sql(f"ALTER TABLE {self.name(name)} DROP IF EXISTS PARTITION ({values})")
        files.remove_folder(self.spark, f"{self.path(name)}/batch={batch}")

    def partitions(self, name: str) -> list[str]:
        return [r["partition"] for r in self.spark.sql(f"SHOW PARTITIONS {self.name(name)}").collect()]

    def max_key(self, name: str, key: str) -> int:
        """The last key given out, from the table's properties; another application's tables are asked once."""
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(name)}").collect()}
        return int(found.get("starmill.max_key") or self.stored(name).agg(F.max(key)).first()[0] or 0)

    def keep_max_key(self, name: str, value: int) -> None:
        """To be called before rows with these keys are written: after a crash numbers may be missing, but none is given twice."""
        self.spark.sql(f"ALTER TABLE {self.name(name)} SET TBLPROPERTIES ('starmill.max_key' = '{value}')")

    @contextmanager
    def exclusive(self) -> Iterator[None]:
        """One load at a time."""
        path = f"{self.root}/load.lock"
        age = files.age(self.spark, path)
        if age is not None and age > LOCK:
            files.remove_folder(self.spark, path)
        try:
            files.write_small_text(self.spark, path, datetime.now().isoformat())
        except FileExistsError as error:
            raise LoadConflict(f"another load holds {path}") from error
        try:
            yield
        finally:
            files.remove_folder(self.spark, path)
