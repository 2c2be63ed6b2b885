"""All integrity rules of the star in one report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators import checks
from starmill.plans.model import FOLDED_KEYS, NATURAL_KEYS, SURROGATE_KEYS

# Columns that must not be NULL, and the widest text per column.
REQUIRED = {
    "dim_date": ("date_id", "date", "day_of_year", "day_of_week", "day_of_week_num", "month", "month_num"),
    "dim_shark": ("shark_id", "shark_name"),
    "dim_business": ("business_id", "business_name"),
    "dim_season": ("season_id", "season_number", "season_label", "season_abbrev"),
    "dim_episode": ("episode_id", "season_id", "episode_in_season_num"),
    "fact_pitch": ("pitch_id", "business_id", "episode_id"),
    "fact_deal_shark": ("deal_shark_id", "pitch_id", "shark_id"),
}
WIDTHS = {
    "dim_date": {"day_of_week": 9, "month": 9},
    "dim_shark": {"shark_name": 250},
    "dim_business": {
        "business_name": 250,
        "industry": 100,
        "entrepreneur_names": 250,
        "entrepreneur_city": 100,
        "entrepreneur_state": 20,
    },
    "dim_season": {"season_label": 10, "season_abbrev": 5},
}
# Keys that refer to another table; 0 stands for "unknown".
REFERENCES = (
    ("dim_episode", "dim_season"),
    ("fact_pitch", "dim_business"),
    ("fact_pitch", "dim_episode"),
    ("fact_deal_shark", "fact_pitch"),
    ("fact_deal_shark", "dim_shark"),
)


def integrity_report(warehouse) -> DataFrame:
    """One row per table and rule with the number of offending rows or keys."""

    def counted(table: str, rule: str, offenders: DataFrame) -> DataFrame:
        return offenders.agg(F.count(F.lit(1)).alias("broken")).selectExpr(f"'{table}' AS table", f"'{rule}' AS rule", "broken")

    parts = []
    for name, key in SURROGATE_KEYS.items():
        table = warehouse.table(name)
        parts.append(checks.rule_report(table, REQUIRED[name], WIDTHS.get(name)).selectExpr(f"'{name}' AS table", "rule", "broken"))
        parts.append(counted(name, f"{key} is unique", checks.duplicate_keys(table, [key])))
        natural = NATURAL_KEYS[name]
        parts.append(counted(name, f"{', '.join(natural)} is unique", checks.duplicate_keys(table, natural, FOLDED_KEYS)))
    for name, other in REFERENCES:
        key = SURROGATE_KEYS[other]
        missing = checks.orphans(warehouse.table(name), warehouse.table(other), key)
        parts.append(counted(name, f"{key} is in {other}", missing))
    pitches = warehouse.table("fact_pitch")
    unknown = pitches.filter((F.col("business_id") == 0) | (F.col("episode_id") == 0))
    parts.append(counted("fact_pitch", "business and episode are known", unknown))
    return reduce(DataFrame.unionByName, parts)
