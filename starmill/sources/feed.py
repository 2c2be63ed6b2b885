"""Typed reading of wide delimited text feeds, with a quarantine for bad rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions import clean

RAW = "_raw_line"
REJECT_COLUMNS = ("reject_reason", "reject_column", "raw_line")

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "flag": T.BooleanType(),
    "yes": T.BooleanType(),
}


def quoted(name: str) -> str:
    return f"`{name}`"


@dataclass(frozen=True)
class Field:
    """One feed column: heading, kind of value, widest text that is accepted."""

    header: str
    kind: str
    width: int = 50
    required: bool = False

    @property
    def name(self) -> str:
        return self.header.lower().replace(" ", "_")

    @property
    def data_type(self) -> T.DataType:
        return _TYPES[self.kind]

    def value(self, formats: Sequence[str]) -> str:
        """SQL text of the typed value."""
        text = quoted(self.name)
        return {
            "string": clean.blank_to_null(text),
            "int": clean.to_whole(text, "int"),
            "long": clean.to_whole(text, "bigint"),
            "double": clean.to_double(text),
            "date": clean.to_date(text, formats),
            "flag": clean.to_flag(text),
            "yes": clean.yes_flag(text),
        }[self.kind]

    @property
    def can_be_unreadable(self) -> bool:
        return self.kind not in ("string", "yes")


@dataclass(frozen=True)
class FeedSpec:
    fields: tuple[Field, ...]
    date_formats: tuple[str, ...] = clean.DATE_FORMATS
    names: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "names", tuple(f.name for f in self.fields))

    @property
    def text_schema(self) -> T.StructType:
        columns = [T.StructField(n, T.StringType()) for n in self.names]
        return T.StructType([*columns, T.StructField(RAW, T.StringType())])

    @property
    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.data_type) for f in self.fields])


class Feed(NamedTuple):
    good: DataFrame
    quarantine: DataFrame


# Code page 1252 differs from Latin-1 in the bytes 80-9F only. Spark decodes
# Latin-1 by itself, so the text is read as that and those characters replaced.
def _cp1252_pairs() -> tuple[str, str]:
    latin, windows = [], []
    for byte in range(0x80, 0xA0):
        try:
            windows.append(bytes([byte]).decode("cp1252"))
            latin.append(chr(byte))
        except UnicodeDecodeError:
            continue
    return "".join(latin), "".join(windows)


def decode(df: DataFrame, encoding: str) -> DataFrame:
    if encoding.lower() not in ("cp1252", "windows-1252"):
        return df
    latin, windows = _cp1252_pairs()
    return df.selectExpr(*[f"translate({quoted(c)}, '{latin}', '{windows}') AS {quoted(c)}" for c in df.columns])


def spanning_files(spark: SparkSession, path) -> list[str]:
    """Files in which a record may run over several lines; the driver lists all files of a feed in any case.

    The first line of such a record has an odd number of quotes. A file without
    such lines has one record per line and can be split.
    """
    lines = spark.read.text(path)
    quotes = "length(value) - length(replace(value, '\"', ''))"
    found = lines.filter(f"({quotes}) % 2 = 1").select("_metadata.file_path").distinct()
    return [r.file_path for r in found.collect()]


def canonical(uri: str) -> str:
    """One form for the ways in which Spark spells a file's address."""
    return re.sub("^file:/+", "file:/", unquote(uri))


def csv_options(encoding: str, multi_line: bool) -> dict:
    windows = encoding.lower() in ("cp1252", "windows-1252")
    options = {
        "header": "true",
        "sep": ",",
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RAW,
        "encoding": "ISO-8859-1" if windows else encoding,
        # one rule for blanks: trimmed and nulled by the type expressions
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "enforceSchema": "true",
    }
    if multi_line:
        options["multiLine"] = "true"
    return options


def read_text(spark: SparkSession, path, spec: FeedSpec, encoding: str = "cp1252", multi_line: bool | None = None) -> DataFrame:
    """All columns as text plus the raw line of records with a wrong number of fields.

    ``multi_line=None`` looks into the feed: only files in which a record
    really may run over a line end are read whole, the others in splits.
    """

    def read(paths, whole_files: bool) -> DataFrame:
        return spark.read.schema(spec.text_schema).options(**csv_options(encoding, whole_files)).csv(paths)

    spanning = spanning_files(spark, path) if multi_line is None else []
    if not spanning:
        return decode(read(path, bool(multi_line)), encoding)
    whole = {canonical(f) for f in spanning}
    others = [f for f in spark.read.text(path).inputFiles() if canonical(f) not in whole]
    raw = read([unquote(f) for f in spanning], True)
    if others:
        raw = raw.union(read([unquote(f) for f in others], False))
    return decode(raw, encoding)


def classify(text: DataFrame, spec: FeedSpec) -> DataFrame:
    """Typed columns plus the first reason, if any, why a row is not accepted."""

    def reject(condition: str, reason: str, column: str | None = None) -> str:
        name = f"'{column}'" if column else "cast(NULL AS string)"
        return f"CASE WHEN {condition} THEN named_struct('reason', '{reason}', 'column', {name}) END"

    def is_blank(f: Field) -> str:
        return f"({quoted(f.name)} IS NULL OR trim({quoted(f.name)}) = '')"

    def typed(f: Field) -> str:
        return quoted(f"_typed_{f.name}")

    # each value is computed once here and only compared below
    values = text.selectExpr("*", *[f"{f.value(spec.date_formats)} AS {typed(f)}" for f in spec.fields])

    malformed = reject(f"{RAW} IS NOT NULL", "malformed")
    too_wide = [reject(f"length({quoted(f.name)}) > {f.width}", "too_wide", f.name) for f in spec.fields]
    unreadable = [
        reject(f"{typed(f)} IS NULL AND NOT {is_blank(f)}", "unreadable", f.name) for f in spec.fields if f.can_be_unreadable
    ]
    missing = [reject(is_blank(f), "missing", f.name) for f in spec.fields if f.required]
    problem = f"coalesce({', '.join([malformed, *too_wide, *unreadable, *missing])})"
    # One expression over all columns. The partition id makes it non-deterministic
    # in the optimizer's eyes: without that, its constraint rules substitute every
    # alias below in every combination, which does not end for a wide feed.
    judged = values.selectExpr("*", f"CASE WHEN spark_partition_id() >= 0 THEN {problem} END AS _problem")
    line = f"coalesce({RAW}, to_csv(struct({', '.join(map(quoted, spec.names))})))"
    return judged.selectExpr(
        *[f"{typed(f)} AS {quoted(f.name)}" for f in spec.fields],
        "_problem.reason AS reject_reason",
        "_problem.column AS reject_column",
        f"CASE WHEN _problem IS NOT NULL THEN {line} END AS raw_line",
    )


def _failing(rows: DataFrame, spec: FeedSpec) -> DataFrame:
    """Make the query fail on the first row with an unreadable value."""
    message = F.concat(F.lit("unreadable value in column "), F.col("reject_column"), F.lit(": "), F.col("raw_line"))
    reason = F.col("reject_reason")
    return rows.withColumn(
        "reject_reason", F.when(reason == "unreadable", F.raise_error(message).cast("string")).otherwise(reason)
    )


def typed_rows(text: DataFrame, spec: FeedSpec, strict: bool = False) -> DataFrame:
    rows = classify(text, spec)
    return _failing(rows, spec) if strict else rows


def split_rows(rows: DataFrame, spec: FeedSpec) -> Feed:
    good = rows.filter(F.col("reject_reason").isNull()).select(*spec.names)
    bad = rows.filter(F.col("reject_reason").isNotNull()).select(*REJECT_COLUMNS)
    return Feed(good, bad)


def read_feed(
    spark: SparkSession,
    path,
    spec: FeedSpec,
    strict: bool = False,
    encoding: str = "cp1252",
    multi_line: bool | None = None,
) -> Feed:
    """Accepted rows and quarantined rows of a feed, both lazy.

    With ``strict`` a value that cannot be read fails the query; rows of a
    wrong shape go to the quarantine in both modes.
    """
    text = read_text(spark, path, spec, encoding, multi_line)
    return split_rows(typed_rows(text, spec, strict), spec)


def stamp(df: DataFrame, at: datetime) -> DataFrame:
    """One time stamp for a whole batch, fixed when the plan is made."""
    return df.withColumn("import_date", F.lit(at).cast("timestamp"))
