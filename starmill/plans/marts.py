"""Aggregate marts over the star.

All of them are built from one metric block. The facts are first reduced to one
row per pitch and then to one row per episode, before any dimension is joined,
so a season, episode or investor with a third of all rows is no heavier for a
join than any other. The published columns keep the counting of the original
views, which see a pitch once per investor; ``*_per_pitch`` columns count it once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions.clean import FRACTION, MONEY, exact_sum, join_text, ratio
from starmill.operators.lookup import lookup, salted_join
from starmill.plans.model import PUBLISHED

# Measures that add up over rows. The first three count a pitch once, the
# others once per investor row.
COUNTS = ("total_pitches", "total_deals", "main_shark_deals", "guest_shark_deals")
FANNED = ("has_royalties", "has_advisory_shares", "has_conditions")


@dataclass(frozen=True)
class Star:
    """The tables a mart reads. ``salt``: look for pitches with very many investor rows and salt the fact-to-fact join."""

    pitches: DataFrame
    deals: DataFrame
    sharks: DataFrame
    episodes: DataFrame
    seasons: DataFrame
    calendar: DataFrame
    businesses: DataFrame | None = None
    salt: bool = False


def star_of(warehouse) -> Star:
    """The tables of a warehouse."""
    return Star(
        pitches=warehouse.stored("fact_pitch"),
        deals=warehouse.stored("fact_deal_shark"),
        sharks=warehouse.table("dim_shark"),
        episodes=warehouse.table("dim_episode"),
        seasons=warehouse.table("dim_season"),
        calendar=warehouse.table("dim_date"),
        businesses=warehouse.table("dim_business"),
        salt=True,
    )


def in_seasons(star: Star, first: int, last: int) -> Star:
    """The star with the seasons of these numbers only. Facts are stored by season, so no other is read."""
    seasons = star.seasons.filter(F.col("season_number").between(first, last))
    ids = [r[0] for r in seasons.select("season_id").collect()]  # no more than there are numbers in the range
    only = {n: getattr(star, n).filter(F.col("season_id").isin(ids)) for n in ("pitches", "deals", "episodes")}
    return replace(star, seasons=seasons, **only)


def deal_flags(star: Star) -> DataFrame:
    """Per pitch: number of investor rows, and whether a main or a guest investor is among them."""
    flags = star.sharks.select("shark_id", "is_main_shark")
    deals = lookup(star.deals.select("pitch_id", "shark_id"), flags, ["shark_id"], "left")
    return deals.groupBy("pitch_id").agg(
        F.count(F.lit(1)).alias("deal_rows"),
        F.max(F.coalesce("is_main_shark", F.lit(False))).alias("has_main_shark"),
        F.max(F.coalesce(~F.col("is_main_shark"), F.lit(False))).alias("has_guest_shark"),
    )


MARKS = {
    "has_royalties": "is_royalty_deal",
    "has_advisory_shares": "advisory_shares > 0",
    "has_conditions": "deal_has_conditions",
}


def episode_metrics(star: Star, by: Sequence[str]) -> DataFrame:
    """Additive measures per episode (and pitch-level columns ``by``)."""
    columns = ["pitch_id", "episode_id", "is_deal", "is_royalty_deal", "advisory_shares", "deal_has_conditions"]
    pitches = star.pitches.select(*columns, *by, F.col("deal_amount").cast(MONEY).alias("amount"))
    base = pitches.join(deal_flags(star), "pitch_id", "left")
    fan = "cast(coalesce(deal_rows, 1) AS decimal(9,0))"
    aggregates = [
        "count(*) AS total_pitches",
        "count_if(is_deal) AS total_deals",
        "count_if(has_main_shark) AS main_shark_deals",
        "count_if(has_guest_shark) AS guest_shark_deals",
        f"sum(amount * {fan}) AS total_investment",
        "sum(amount) AS total_investment_per_pitch",
        *[f"sum(if({mark}, coalesce(deal_rows, 1), 0)) AS {name}" for name, mark in MARKS.items()],
        *[f"count_if({mark}) AS {name}_per_pitch" for name, mark in MARKS.items()],
    ]
    return base.groupBy("episode_id", *by).agg(*map(F.expr, aggregates))


def _sharks_by_episode(star: Star, by: Sequence[str]) -> DataFrame:
    """Distinct investors per episode (and pitch-level columns ``by``); the facts are joined only for the latter."""
    if "episode_id" in star.deals.columns and not by:
        return star.deals.select("episode_id", "shark_id").distinct()
    deals = star.deals.select("pitch_id", "shark_id")
    pitches = star.pitches.select("pitch_id", "episode_id", *by)
    if star.salt:
        pairs = salted_join(deals, pitches, ["pitch_id"], "inner")
    else:
        pairs = deals.join(pitches, "pitch_id")
    return pairs.select("episode_id", *by, "shark_id").distinct()


def metric_block(
    star: Star,
    group_cols: Sequence[str],
    episodes: DataFrame | None = None,
    viewers: DataFrame | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """All measures per group.

    ``episodes`` maps ``episode_id`` to the episode-level group columns and
    limits the marts to its episodes; it may be left out when the grouping
    needs no such column. ``by`` names the group columns that are on
    the pitches. ``viewers`` holds the rows, with their group columns, whose
    ``us_viewership`` is averaged.

    Measures, distinct investors and viewers are three inputs of one final
    aggregation, so there is no join between aggregates, NULL groups are kept
    and the whole table is the grouping with no columns.
    """
    measures = [*COUNTS, "total_investment", "total_investment_per_pitch", *FANNED, *[f"{m}_per_pitch" for m in FANNED]]
    metrics, sharks = episode_metrics(star, by), _sharks_by_episode(star, by)
    if episodes is not None:
        metrics, sharks = metrics.join(episodes, "episode_id"), sharks.join(episodes, "episode_id")
        sharks = sharks.select(*group_cols, "shark_id").distinct()
    season = ["season_id"] if "season_id" in metrics.columns and "season_id" not in group_cols else []
    # one row per group and episode, since every other group column depends on the episode
    parts = [
        metrics.selectExpr(*group_cols, *season, *measures, "1L AS total_episodes"),
        sharks.selectExpr(*group_cols, "1L AS sharks_in_deals"),
    ]
    if viewers is not None:
        sums = [f"{exact_sum('us_viewership')} AS viewers", "count(us_viewership) AS viewed"]
        parts.append(viewers.groupBy(*group_cols).agg(*map(F.expr, sums)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)

    counted = ["total_episodes", *COUNTS, "sharks_in_deals", *FANNED, *[f"{m}_per_pitch" for m in FANNED]]
    aggregates = [f"coalesce(sum({c}), 0) AS {c}" for c in counted]
    aggregates += [f"cast(sum({c}) AS double) AS {c}" for c in ("total_investment", "total_investment_per_pitch")]
    if season:
        aggregates.append("count(DISTINCT season_id) AS total_seasons")
    if viewers is not None:
        aggregates.append(f"{ratio('sum(viewers)', 'sum(viewed)')} AS avg_us_viewership")
    grouped = rows.groupBy(*group_cols).agg(*map(F.expr, aggregates))
    if group_cols:
        grouped = grouped.filter("total_pitches > 0")
    return with_rates(grouped)


def with_rates(df: DataFrame) -> DataFrame:
    rates = {
        "deal_rate": ratio("total_deals", "total_pitches"),
        "main_shark_deal_share": ratio("main_shark_deals", "total_deals"),
        "guest_shark_deal_share": ratio("guest_shark_deals", "total_deals"),
        "pitches_per_episode": ratio("total_pitches", "total_episodes"),
        "deals_per_episode": ratio("total_deals", "total_episodes"),
    }
    if "total_seasons" in df.columns:
        rates["pitches_per_season"] = ratio("total_pitches", "total_seasons")
        rates["deals_per_season"] = ratio("total_deals", "total_seasons")
    return df.selectExpr("*", *[f"{formula} AS {name}" for name, formula in rates.items()])


SHARED = ("total_pitches", "total_deals", "deal_rate", "total_investment", "sharks_in_deals", *FANNED)
SHARES = ("main_shark_deal_share", "guest_shark_deal_share")
EXTRA = ("total_investment_per_pitch", *[f"{m}_per_pitch" for m in FANNED])


def mart_alltime(star: Star, extra: bool = False) -> DataFrame:
    """One row for the whole history."""
    known = star.episodes.join(star.seasons.select("season_id"), "season_id", "left_semi")
    block = metric_block(star, [], known.select("episode_id", "season_id"), star.episodes.select("us_viewership"))
    return block.select(*PUBLISHED["vw_alltime_summary"], *(EXTRA if extra else ()))


def season_dates(star: Star) -> DataFrame:
    """Seasons with their first and last day; the calendar is joined once per role."""
    seasons = star.seasons
    for role in ("start", "end"):
        days = star.calendar.select(F.col("date_id").alias(f"season_{role}_date_id"), F.col("date").alias(f"season_{role}_date"))
        seasons = lookup(seasons, days, [f"season_{role}_date_id"], "left")
    return seasons.select("season_id", "season_label", "season_number", "season_start_date", "season_end_date")


def mart_season(star: Star, extra: bool = False) -> DataFrame:
    """One row per season."""
    episodes = star.episodes.select("episode_id", "season_id")
    block = metric_block(star, ["season_id"], episodes, star.episodes.select("season_id", "us_viewership"))
    return season_dates(star).join(block, "season_id").select(*PUBLISHED["vw_season_summary"], *(EXTRA if extra else ()))


def episode_attributes(star: Star) -> DataFrame:
    """Episodes with their season and air date."""
    days = star.calendar.select(F.col("date_id").alias("air_date_id"), F.col("date").alias("episode_air_date"))
    episodes = lookup(star.episodes, days, ["air_date_id"], "left")
    seasons = star.seasons.select("season_id", "season_number", "season_label")
    return lookup(episodes, seasons, ["season_id"], "inner").select(
        "episode_id", "season_id", "season_number", "season_label", "episode_in_season_num", "us_viewership", "episode_air_date"
    )


def mart_episode(star: Star, extra: bool = False) -> DataFrame:
    """One row per episode."""
    label = join_text("Season ", F.col("season_number"), ", Episode ", F.col("episode_in_season_num"))
    block = metric_block(star, ["episode_id"])
    labelled = block.join(episode_attributes(star), "episode_id").withColumn("episode_label", label)
    return labelled.select(*PUBLISHED["vw_episode_summary"], *(EXTRA if extra else ()))


def mart_shark(star: Star) -> DataFrame:
    """One row per investor; the facts are reduced to investors before the dimension is joined."""
    per_key = star.deals.groupBy("shark_id").agg(
        F.expr("count(*) AS pitches"),  # (pitch_id, shark_id) is unique
        F.expr(f"{exact_sum('investment_amount')} AS amount"),
        F.expr("count(investment_amount) AS amounts"),
        F.expr(f"{exact_sum('investment_equity_pct', FRACTION)} AS equity"),
        F.expr("count(investment_equity_pct) AS equities"),
    )
    named = per_key.join(star.sharks.select("shark_id", "shark_name", "is_main_shark"), "shark_id")
    return named.groupBy("shark_name", "is_main_shark").agg(
        F.expr("sum(pitches) AS total_deals_participated"),
        F.expr(f"{ratio('sum(amount)', 'sum(amounts)')} AS avg_investment_amount"),
        F.expr("cast(sum(amount) AS double) AS total_investment_amount"),
        F.expr(f"{ratio('sum(equity)', 'sum(equities)')} AS avg_equity_pct_per_deal"),
    )


def grain_mart(star: Star, group_cols: Sequence[str]) -> DataFrame:
    """The metric block at any grain.

    ``group_cols`` may mix season and episode columns, ``air_year`` and
    ``air_month``, and columns of the business dimension. The average
    viewership is given where all of them belong to episodes.
    """
    air = F.col("episode_air_date")
    attributes = episode_attributes(star).withColumns({"air_year": F.year(air), "air_month": F.month(air)})
    by = [c for c in group_cols if c not in attributes.columns]
    if by:
        if star.businesses is None or not set(by) <= set(star.businesses.columns):
            raise ValueError(f"unknown group columns: {by}")
        pitches = lookup(star.pitches, star.businesses.select("business_id", *by), ["business_id"])
        star = replace(star, pitches=pitches)
    on_episode = [c for c in group_cols if c not in by]
    episodes = attributes.select("episode_id", *[c for c in on_episode if c != "episode_id"])
    viewers = None if by else attributes.select(*group_cols, "us_viewership")
    return metric_block(star, group_cols, episodes, viewers, by).select(
        *group_cols, "total_episodes", *SHARED, *SHARES, "pitches_per_episode", "deals_per_episode",
        *(() if by else ("avg_us_viewership",)), *EXTRA,
    )
