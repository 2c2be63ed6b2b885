"""Facts by episode, kept up by increments, and every coarser mart from them.

Measures add up; the investors of an episode are kept as exact bitmaps, which
add up as well, so no mart needs the facts or a distinct count again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions.clean import FRACTION, exact_sum, ratio
from starmill.plans.marts import COUNTS, FANNED, SHARED, SHARES, Star, episode_metrics
from starmill.plans.model import PUBLISHED
from starmill.session import written

_SUMMED = (*COUNTS, *FANNED, *[f"{m}_per_pitch" for m in FANNED])
_MONEY = ("total_investment", "total_investment_per_pitch")


def episode_measures(star: Star) -> DataFrame:
    """Additive measures of each episode, from the facts."""
    return episode_metrics(star, [])


def episode_sharks(star: Star) -> DataFrame:
    """The investors of each episode as bitmaps: a row for every 32,768 keys of which one is there."""
    number, place = F.bitmap_bucket_number("shark_id"), F.bitmap_bit_position("shark_id")
    # by a hash aggregation first, since one with bitmaps turns to sorting all rows
    pairs = star.deals.select("episode_id", "shark_id").distinct()
    deals = pairs.select("episode_id", number.alias("part"), place.alias("place"))
    return deals.groupBy("episode_id", "part").agg(F.bitmap_construct_agg("place").alias("bits"))


# -- SQL over tables by name -------------------------------------------------------
# ``measures`` and ``sharks`` are the tables of this module with ``season_id``.

_SUMS = ", ".join(f"sum({c}) AS {c}" for c in (*_SUMMED, *_MONEY))
_RATES = {
    "deal_rate": ("total_deals", "total_pitches"),
    "main_shark_deal_share": ("main_shark_deals", "total_deals"),
    "guest_shark_deal_share": ("guest_shark_deals", "total_deals"),
    "pitches_per_episode": ("total_pitches", "total_episodes"),
    "deals_per_episode": ("total_deals", "total_episodes"),
    "pitches_per_season": ("total_pitches", "total_seasons"),
    "deals_per_season": ("total_deals", "total_seasons"),
}
_VIEWERS = f"{exact_sum('us_viewership')} AS viewers, count(us_viewership) AS viewed"
_NUMBERED = ("total_episodes", "total_seasons", "sharks_in_deals", *_SUMMED)


def _published(names: tuple[str, ...], plain: Mapping[str, str] | None = None) -> str:
    """The published columns over a row of sums; sums over nothing count as 0."""
    cells = dict(plain or {})
    cells["avg_us_viewership"] = ratio("viewers", "viewed")
    counted = lambda c: f"coalesce({c}, 0)"
    cells |= {c: counted(c) for c in _NUMBERED}
    cells |= {c: f"cast({c} AS double)" for c in _MONEY}
    cells |= {name: ratio(counted(a), counted(b)) for name, (a, b) in _RATES.items()}
    return ", ".join(f"{cells.get(c, c)} AS {c}" for c in names)


def alltime_sql(t: Mapping[str, str]) -> str:
    return f"""
WITH known AS (SELECT m.* FROM {t["measures"]} m LEFT SEMI JOIN {t["dim_season"]} s ON s.season_id = m.season_id),
by_season AS (SELECT season_id, count(*) AS total_episodes, {_SUMS} FROM known GROUP BY season_id),
sums AS (SELECT sum(total_episodes) AS total_episodes, count(*) AS total_seasons, {_SUMS} FROM by_season),
parts AS (
  SELECT part, bitmap_count(bitmap_or_agg(bits)) AS n
  FROM {t["sharks"]} b LEFT SEMI JOIN {t["dim_season"]} s ON s.season_id = b.season_id GROUP BY part
),
viewers AS (SELECT {_VIEWERS} FROM {t["dim_episode"]})
SELECT {_published(PUBLISHED["vw_alltime_summary"])}
FROM sums, (SELECT sum(n) AS sharks_in_deals FROM parts), viewers"""


def season_sql(t: Mapping[str, str]) -> str:
    return f"""
WITH sums AS (SELECT season_id, count(*) AS total_episodes, {_SUMS} FROM {t["measures"]} GROUP BY season_id),
parts AS (SELECT season_id, part, bitmap_count(bitmap_or_agg(bits)) AS n FROM {t["sharks"]} GROUP BY season_id, part),
investors AS (SELECT season_id, sum(n) AS sharks_in_deals FROM parts GROUP BY season_id),
viewers AS (SELECT season_id, {_VIEWERS} FROM {t["dim_episode"]} GROUP BY season_id)
SELECT {_published(PUBLISHED["vw_season_summary"], {"season_start_date": "a.date", "season_end_date": "z.date"})}
FROM {t["dim_season"]} s JOIN sums USING (season_id) LEFT JOIN investors USING (season_id) LEFT JOIN viewers USING (season_id)
LEFT JOIN {t["dim_date"]} a ON a.date_id = s.season_start_date_id LEFT JOIN {t["dim_date"]} z ON z.date_id = s.season_end_date_id"""


def episode_sql(t: Mapping[str, str]) -> str:
    label = "concat('Season ', cast(season_number AS string), ', Episode ', cast(episode_in_season_num AS string))"
    return f"""
WITH sums AS (SELECT m.* EXCEPT (season_id), 1 AS total_episodes FROM {t["measures"]} m),
investors AS (SELECT episode_id, sum(bitmap_count(bits)) AS sharks_in_deals FROM {t["sharks"]} GROUP BY episode_id)
SELECT {_published(PUBLISHED["vw_episode_summary"], {"episode_label": label, "episode_air_date": "d.date"})}
FROM {t["dim_episode"]} e JOIN {t["dim_season"]} s USING (season_id) JOIN sums USING (episode_id) LEFT JOIN investors USING (episode_id)
LEFT JOIN {t["dim_date"]} d ON d.date_id = e.air_date_id"""


def shark_sql(t: Mapping[str, str]) -> str:
    return f"""
WITH per_key AS (
  SELECT shark_id, count(*) AS pitches, {exact_sum("investment_amount")} AS amount, count(investment_amount) AS amounts,
    {exact_sum("investment_equity_pct", FRACTION)} AS equity, count(investment_equity_pct) AS equities
  FROM {t["fact_deal_shark"]} GROUP BY shark_id
)
SELECT shark_name, is_main_shark, sum(pitches) AS total_deals_participated, {ratio("sum(amount)", "sum(amounts)")} AS avg_investment_amount,
  cast(sum(amount) AS double) AS total_investment_amount, {ratio("sum(equity)", "sum(equities)")} AS avg_equity_pct_per_deal
FROM per_key JOIN {t["dim_shark"]} USING (shark_id) GROUP BY shark_name, is_main_shark"""


def levels_sql(t: Mapping[str, str]) -> str:
    """All levels at once: ``mart_level`` is 0 for episodes, 1 for seasons, 3 for the whole."""
    sets = "GROUPING SETS ((season_id, episode_id), (season_id), ())"
    with_part = "GROUPING SETS ((season_id, episode_id, part), (season_id, part), (part))"
    columns = ("total_episodes", *SHARED, *SHARES)
    return f"""
WITH sums AS (
  SELECT grouping_id(season_id, episode_id) AS mart_level, season_id, episode_id, count(*) AS total_episodes, {_SUMS}
  FROM {t["measures"]} GROUP BY {sets}
),
parts AS (
  SELECT grouping_id(season_id, episode_id, part) DIV 2 AS mart_level, season_id, episode_id, bitmap_count(bitmap_or_agg(bits)) AS n
  FROM {t["sharks"]} GROUP BY {with_part}
),
investors AS (SELECT mart_level, season_id, episode_id, sum(n) AS sharks_in_deals FROM parts GROUP BY mart_level, season_id, episode_id)
SELECT s.mart_level, s.season_id, s.episode_id, {_published(columns)}
FROM sums s LEFT JOIN investors i ON i.mart_level = s.mart_level AND i.season_id <=> s.season_id AND i.episode_id <=> s.episode_id"""


VIEWS = {
    "vw_alltime_summary": alltime_sql,
    "vw_season_summary": season_sql,
    "vw_episode_summary": episode_sql,
    "vw_shark_alltime_summary": shark_sql,
    "vw_all_levels": levels_sql,
}


def from_star(star: Star, sql) -> DataFrame:  # type: ignore[no-untyped-def]
    """One of these marts over the tables of a star, its aggregates made on the spot."""
    of = star.episodes.select("episode_id", "season_id")
    tables = {
        "measures": episode_measures(star).join(of, "episode_id"),
        "sharks": episode_sharks(star).join(of, "episode_id"),
        "dim_season": star.seasons, "dim_episode": star.episodes, "dim_date": star.calendar,
        "dim_shark": star.sharks, "fact_deal_shark": star.deals,
    }
    return star.pitches.sparkSession.sql(sql({n: "{" + n + "}" for n in tables}), **tables)


# -- in the warehouse ---------------------------------------------------------------


def table_names(warehouse) -> dict[str, str]:
    names = {n: warehouse.name(n) for n in ("dim_season", "dim_episode", "dim_date", "dim_shark", "fact_deal_shark")}
    return {**names, "measures": warehouse.name("episode_measures"), "sharks": warehouse.name("episode_sharks")}


def create_views(warehouse) -> None:
    """``analytics.vw_*``: views of the catalog on table names, current in every session."""
    for name, sql in VIEWS.items():
        warehouse.spark.sql(f"CREATE OR REPLACE VIEW {warehouse.prefix}analytics.{name} AS {sql(table_names(warehouse))}")


def renewals(warehouse, star: Star, touched: DataFrame) -> list[Callable[[], None]]:
    """The steps that compute the aggregates of the episodes in ``touched`` (season_id, episode_id) anew; of the facts only their seasons are read."""
    of = written(touched.select("episode_id", "season_id").distinct(), "touched")  # read by all of the joins below
    seasons = [r[0] for r in of.select("season_id").distinct().collect()]  # as many as the batch has
    ids = of.select("episode_id")
    only = lambda df: df.filter(F.col("season_id").isin(seasons)).join(ids, "episode_id", "left_semi")
    part = Star(only(star.pitches), only(star.deals), star.sharks, star.episodes, star.seasons, star.calendar)

    def renew(name: str, fresh: DataFrame) -> None:
        stored = warehouse.stored(name)
        kept = stored.filter(F.col("season_id").isin(seasons)).join(ids, "episode_id", "left_anti")
        fresh = fresh.join(of, "episode_id").select(*stored.columns)
        warehouse.replace(name, kept.unionByName(fresh).hint("rebalance", "season_id"))

    return [partial(renew, "episode_measures", episode_measures(part)), partial(renew, "episode_sharks", episode_sharks(part))]
