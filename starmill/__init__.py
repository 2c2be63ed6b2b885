"""Star-schema warehouses on Spark: ingest, upsert, and marts."""

from starmill.operators.calendar import calendar, extend_calendar
from starmill.operators.keys import assign_keys
from starmill.operators.lookup import lookup, lookup_date, lookup_key, salted_join
from starmill.operators.reshape import allocate_evenly, latest_per_key, ordinal_within, split_entities, unpivot_measures
from starmill.operators.upsert import upsert_type1
from starmill.plans.load import ingest_file, load_warehouse, open_warehouse, populate_calendar
from starmill.plans.marts import grain_mart, in_seasons, mart_alltime, mart_episode, mart_season, mart_shark, star_of
from starmill.plans.model import LoadConfig, pitch_feed
from starmill.session import build_session
from starmill.sources.feed import FeedSpec, Field, read_feed
from starmill.sources.store import Warehouse
from starmill.streaming.ingest import ingest_stream, poll_warehouse

__all__ = [
    "FeedSpec",
    "Field",
    "LoadConfig",
    "Warehouse",
    "allocate_evenly",
    "assign_keys",
    "build_session",
    "calendar",
    "extend_calendar",
    "grain_mart",
    "in_seasons",
    "ingest_file",
    "ingest_stream",
    "latest_per_key",
    "load_warehouse",
    "lookup",
    "lookup_date",
    "lookup_key",
    "mart_alltime",
    "mart_episode",
    "mart_season",
    "mart_shark",
    "open_warehouse",
    "ordinal_within",
    "pitch_feed",
    "poll_warehouse",
    "populate_calendar",
    "read_feed",
    "salted_join",
    "split_entities",
    "star_of",
    "unpivot_measures",
    "upsert_type1",
]
