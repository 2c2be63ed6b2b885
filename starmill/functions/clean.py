"""Expressions that turn feed text into typed values, and the small formulas of the marts.

All of them are built-ins, so they stay inside whole-stage code generation.

The rules for feed text are SQL text (``str`` to ``str``): a feed has dozens of
columns, and one call that takes a finished expression is far cheaper for the
driver than a dozen calls per column. A text that cannot be read as the wanted
type gives NULL; the feed reader compares with the text itself to tell "blank"
from "unreadable".
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal notation. Java's number parser also takes "1d", "0x1p3" and
# "NaN", none of which is a number in a feed. The exponent is kept short enough
# for every accepted text to be finite.
NUMBER = r"^([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]{1,2})?)$"
WHOLE = r"^([+-]?[0-9]+)(?:\.0*)?$"

# English (US) notations first; the list is a parameter wherever it is used.
DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "d-MMM-yy", "d-MMM-yyyy")


def blank_to_null(text: str) -> str:
    return f"nullif(trim({text}), '')"


def to_double(text: str) -> str:
    return f"try_cast(regexp_extract(trim({text}), r'{NUMBER}', 1) AS double)"


def to_whole(text: str, type_name: str = "int") -> str:
    """Whole number; "3.0" is read as 3 because nothing is lost, "3.5" is not read."""
    return f"try_cast(regexp_extract(trim({text}), r'{WHOLE}', 1) AS {type_name})"


_DATE_PARTS = {
    "yyyy": "[0-9]{4}",
    "yy": "[0-9]{2}",
    "MMM": "[A-Za-z]{3}",
    "MM": "[0-9]{2}",
    "M": "[0-9]{1,2}",
    "dd": "[0-9]{2}",
    "d": "[0-9]{1,2}",
}


def date_shape(fmt: str) -> str | None:
    """Regular expression that every text in a date notation matches; None for notations with other letters."""
    parts = re.findall(r"y+|M+|d+|[^yMd]+", fmt)
    known = [_DATE_PARTS.get(p) or (None if re.search(r"[A-Za-z'\[]", p) else re.escape(p)) for p in parts]
    return None if None in known else f"^{''.join(known)}$"


def to_date(text: str, formats: Sequence[str] = DATE_FORMATS) -> str:
    """Date in the first notation that fits.

    A failed parse costs an exception per row, so a notation is only tried on
    text of its shape.
    """
    tries = []
    for fmt in formats:
        shape, parsed = date_shape(fmt), f'try_to_date(trim({text}), "{fmt}")'
        tries.append(f"CASE WHEN trim({text}) RLIKE r'{shape}' THEN {parsed} END" if shape else parsed)
    return f"coalesce({', '.join(tries)})"


def to_flag(text: str) -> str:
    """"0"/"1" text to boolean through an integer."""
    return f"cast({to_whole(text)} AS boolean)"


def yes_flag(text: str) -> str:
    """"yes" in any case is true; everything else is unknown, never false."""
    return f"CASE WHEN lower(trim({text})) = 'yes' THEN true END"


def fold_key(text: Column) -> Column:
    """The form in which natural text keys are compared: case and trailing blanks do not count."""
    return F.lower(F.rtrim(text))


def ratio(part: str, whole: str) -> str:
    """SQL text of ``part / whole`` as double, NULL where ``whole`` is zero."""
    return f"cast({part} AS double) / nullif(cast({whole} AS double), 0D)"


def percent_to_fraction(value: Column) -> Column:
    return value / F.lit(100.0)


def default_when(condition: Column, value: Column, default) -> Column:
    """``value``, with NULL replaced by ``default`` only where ``condition`` holds."""
    return F.when(condition & value.isNull(), F.lit(default)).otherwise(value)


def join_text(*parts) -> Column:
    """Concatenate parts of any type; NULL parts count as empty text."""
    columns = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat_ws("", *[c.cast("string") for c in columns])


# Money is added up as a decimal so that a sum does not depend on the order in
# which tasks finish. Twelve places keep what a double of this size says; the
# sixteen before them leave room for a sum, and for a product with a row count,
# within the 38 digits of a decimal.
MONEY = "decimal(28,12)"
FRACTION = "decimal(28,18)"


def exact_sum(value: str, type_name: str = MONEY) -> str:
    return f"sum(cast({value} AS {type_name}))"
