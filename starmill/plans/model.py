"""The investment-pitch star: feed layout, table schemas, and the parameters of a load."""

from __future__ import annotations

from dataclasses import dataclass

from starmill.functions.clean import DATE_FORMATS
from starmill.operators.calendar import CALENDAR_SCHEMA
from starmill.sources.feed import FeedSpec, Field

# The investors that have columns of their own in the feed.
MAIN_SHARKS = (
    "Barbara Corcoran",
    "Mark Cuban",
    "Lori Greiner",
    "Robert Herjavec",
    "Daymond John",
    "Kevin O'Leary",
)

# Headings, kinds and widths of the feed columns that come before
# the investor columns.
PITCH_FIELDS = (
    Field("Season Number", "int", required=True),
    Field("Startup Name", "string", 250, required=True),
    Field("Episode Number", "int", required=True),
    Field("Pitch Number", "long"),
    Field("Season Start", "date"),
    Field("Season End", "date"),
    Field("Original Air Date", "date"),
    Field("Industry", "string", 100),
    Field("Business Description", "string", 1000),
    Field("Company Website", "string", 1000),
    Field("Pitchers Gender", "string", 10),
    Field("Pitchers Average Age", "string", 10),
    Field("Pitchers City", "string", 50),
    Field("Pitchers State", "string", 20),
    Field("Entrepreneur Names", "string", 250),
    Field("Multiple Entrepreneurs", "flag"),
    Field("US Viewership", "double"),
    Field("Original Ask Amount", "double"),
    Field("Original Offered Equity", "double"),
    Field("Valuation Requested", "double"),
    Field("Got Deal", "flag"),
    Field("Total Deal Amount", "double"),
    Field("Total Deal Equity", "double"),
    Field("Deal Valuation", "double"),
    Field("Number of Sharks in Deal", "int"),
    Field("Investment Amount Per Shark", "double"),
    Field("Equity Per Shark", "double"),
    Field("Royalty Deal", "yes"),
    Field("Advisory Shares Equity", "double"),
    Field("Loan", "double"),
    Field("Deal Has Conditions", "yes"),
)


def heading(name: str) -> str:
    """How an investor is written in feed headings."""
    return name.replace("'", " ")


def prefix(name: str) -> str:
    return heading(name).lower().replace(" ", "_")


def pitch_feed(main_sharks=MAIN_SHARKS, date_formats=DATE_FORMATS) -> FeedSpec:
    """Feed layout for a list of main investors: an amount, an equity and a presence column for each."""
    investors = [*map(heading, main_sharks), "Guest"]
    invested = [Field(f"{n} Investment {what}", "double") for n in investors for what in ("Amount", "Equity")]
    present = [Field(f"{n} Present", "flag") for n in investors]
    return FeedSpec((*PITCH_FIELDS, *invested, Field("Guest Name", "string", 100), *present), tuple(date_formats))


def main_measures(main_sharks) -> dict[str, dict[str, str]]:
    """Investor name to the feed columns of its measures."""
    return {
        name: {
            "investment_amount": f"{prefix(name)}_investment_amount",
            "investment_equity_pct": f"{prefix(name)}_investment_equity",
        }
        for name in main_sharks
    }


# The published columns of the marts, in their order.
_MEASURES = (
    "total_pitches", "total_deals", "deal_rate", "total_investment", "sharks_in_deals", "has_royalties",
    "has_advisory_shares", "has_conditions", "main_shark_deal_share", "guest_shark_deal_share",
)
PUBLISHED = {
    "vw_alltime_summary": (
        "total_seasons", "total_episodes", *_MEASURES, "avg_us_viewership", "pitches_per_episode", "deals_per_episode",
        "pitches_per_season", "deals_per_season",
    ),
    "vw_season_summary": (
        "season_label", "season_number", "season_start_date", "season_end_date", "total_episodes", *_MEASURES,
        "avg_us_viewership", "pitches_per_episode", "deals_per_episode",
    ),
    "vw_episode_summary": (
        "episode_label", "season_number", "episode_in_season_num", "episode_air_date", *_MEASURES, "us_viewership",
    ),
    "vw_shark_alltime_summary": (
        "shark_name", "is_main_shark", "total_deals_participated", "avg_investment_amount", "total_investment_amount",
        "avg_equity_pct_per_deal",
    ),
}

# The tables and their columns. Surrogate keys are 64-bit: 32 bits
# run out at the sizes this is meant for.
TABLES = {
    "dim_date": CALENDAR_SCHEMA,
    "dim_shark": "shark_id bigint, shark_name string, is_main_shark boolean, import_date timestamp",
    "dim_business": (
        "business_id bigint, business_name string, industry string, business_description string, "
        "company_website string, entrepreneur_names string, entrepreneur_city string, "
        "entrepreneur_state string, import_date timestamp"
    ),
    "dim_season": (
        "season_id bigint, season_number int, season_label string, season_abbrev string, "
        "season_start_date_id int, season_end_date_id int, import_date timestamp"
    ),
    "dim_episode": (
        "episode_id bigint, season_id bigint, episode_in_season_num int, air_date_id int, "
        "us_viewership double, import_date timestamp"
    ),
    "fact_pitch": (
        "pitch_id bigint, business_id bigint, episode_id bigint, pitch_order_in_episode int, "
        "ask_amount double, ask_equity_pct double, valuation_requested double, is_deal boolean, "
        "number_of_sharks int, deal_amount double, deal_equity_pct double, valuation_offered double, "
        "is_royalty_deal boolean, loan double, advisory_shares double, deal_has_conditions boolean, "
        "import_date timestamp"
    ),
    "fact_deal_shark": (
        "deal_shark_id bigint, pitch_id bigint, shark_id bigint, investment_amount double, "
        "investment_equity_pct double, import_date timestamp"
    ),
}

# Facts are stored by season, so that a load rewrites the seasons it brings and
# no others. The column is an address, not a part of the table.
STORED_BY = {t: "season_id" for t in ("fact_pitch", "fact_deal_shark", "episode_measures", "episode_sharks")}
# Within that, and where there are no seasons, by a hash of these columns, so
# that a small batch rewrites the buckets of its keys and no others. Deals go by
# their pitch: those of one pitch lie together.
BUCKETED_BY = {"dim_business": ("business_name",), "fact_pitch": ("business_id", "episode_id"), "fact_deal_shark": ("pitch_id",)}
# Also kept: with the deals their episode, so that marts need not join the facts
# for it; with a business the stamp of the batch that its name is from.
CARRIED = {"fact_deal_shark": "episode_id bigint", "dim_business": "first_date timestamp"}

# Staging tables: columns, and the columns they are partitioned by.
_REJECTED = "import_date timestamp, reject_reason string, reject_column string, raw_line string"
STAGING = {
    "pitch_raw_data": (_REJECTED, "batch string, stamped string, rejected boolean"),
    "quarantine": (_REJECTED, "batch string"),
    "failed_batches": ("error string", "batch string"),
    "stamps": ("import_date timestamp", "batch string"),
}

# The facts by episode, kept up by every load: additive measures, and the
# investors as bitmaps of 32,768 keys each.
AGGREGATES = {
    "episode_measures": (
        "episode_id bigint, total_pitches bigint, total_deals bigint, main_shark_deals bigint, guest_shark_deals bigint, "
        "total_investment decimal(38,12), total_investment_per_pitch decimal(38,12), has_royalties bigint, "
        "has_advisory_shares bigint, has_conditions bigint, has_royalties_per_pitch bigint, "
        "has_advisory_shares_per_pitch bigint, has_conditions_per_pitch bigint, season_id bigint"
    ),
    "episode_sharks": "episode_id bigint, part bigint, bits binary, season_id bigint",
}

NATURAL_KEYS = {
    "dim_date": ("date",),
    "dim_shark": ("shark_name",),
    "dim_business": ("business_name",),
    "dim_season": ("season_number",),
    "dim_episode": ("season_id", "episode_in_season_num"),
    "fact_pitch": ("business_id", "episode_id"),
    "fact_deal_shark": ("pitch_id", "shark_id"),
}
FOLDED_KEYS = ("shark_name", "business_name")
SURROGATE_KEYS = {
    "dim_date": "date_id",
    "dim_shark": "shark_id",
    "dim_business": "business_id",
    "dim_season": "season_id",
    "dim_episode": "episode_id",
    "fact_pitch": "pitch_id",
    "fact_deal_shark": "deal_shark_id",
}


@dataclass(frozen=True)
class LoadConfig:
    """``on_duplicate``: what to do when a business occurs twice in an episode of one batch, or an
    investor twice in a pitch: ``error`` or ``latest``."""

    main_sharks: tuple[str, ...] = MAIN_SHARKS
    date_formats: tuple[str, ...] = DATE_FORMATS
    on_duplicate: str = "error"
    drop_empty_guests: bool = False

    @property
    def feed(self) -> FeedSpec:
        return pitch_feed(self.main_sharks, self.date_formats)
