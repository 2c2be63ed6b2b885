"""The registered queries: every operator of the library, run over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions import clean
from starmill.operators import checks, keys, lookup, reshape
from starmill.operators.calendar import calendar, missing_days, with_date_attributes
from starmill.operators.upsert import upsert_type1
from starmill.plans import load, marts, rollup
from starmill.plans import orders_feed as feed
from starmill.plans.model import FOLDED_KEYS, NATURAL_KEYS, main_measures
from starmill.session import scratch_path, written
from starmill.sources.feed import RAW, FeedSpec, Field, classify, read_feed, read_text, split_rows, stamp, typed_rows
from starmill.sources.files import make_folder
from starmill.streaming.ingest import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# noon, so that the day is the same in every time zone a session may have
OLD, NEW = datetime(2001, 1, 1, 12), datetime(2002, 1, 1, 12)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def order_years(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    day = F.col("o_orderdate")
    return tuple(feed.read(spark, sf_dir, "orders").agg(F.min(F.year(day)), F.max(F.year(day))).first())


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar(spark, *order_years(spark, sf_dir))


def staged_with_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-only staged rows under the feed's business columns."""
    names = feed.customers(spark, sf_dir)
    rows = feed.pitch_rows(spark, sf_dir).join(names, F.col("o_custkey") == F.col("c_custkey"))
    return rows.withColumnsRenamed(
        {"c_name": "startup_name", "c_mktsegment": "industry", "n_name": "pitchers_state", "r_name": "pitchers_city"}
    )


# ---------------------------------------------------------------------------
# marts


@query
def mart_season(spark, sf_dir):
    return marts.mart_season(feed.star(spark, sf_dir))


@query
def mart_by_season_range(spark, sf_dir):
    """The season mart over a range of seasons, of which alone the facts are read."""
    return marts.mart_season(marts.in_seasons(feed.star(spark, sf_dir), 3, 5))


@query
def mart_alltime(spark, sf_dir):
    return marts.mart_alltime(feed.star(spark, sf_dir))


@query
def mart_episode(spark, sf_dir):
    return marts.mart_episode(feed.star(spark, sf_dir))


@query
def mart_entity(spark, sf_dir):
    return marts.mart_shark(feed.star(spark, sf_dir))


@query
def mart_by_any_grain(spark, sf_dir):
    """The metric block by a season column and a business column."""
    return marts.grain_mart(feed.star(spark, sf_dir), ["season_number", "industry"])


@query
def mart_by_air_month(spark, sf_dir):
    """The metric block by calendar columns of the air date."""
    return marts.grain_mart(feed.star(spark, sf_dir), ["air_year", "air_month"])


@query
def mart_season_from_episodes(spark, sf_dir):
    """The season mart from measures and investor bitmaps by episode, without a distinct count."""
    return rollup.from_star(feed.star(spark, sf_dir), rollup.season_sql)


@query
def mart_alltime_from_episodes(spark, sf_dir):
    return rollup.from_star(feed.star(spark, sf_dir), rollup.alltime_sql)


@query
def mart_levels(spark, sf_dir):
    """Episodes, seasons and the whole from one scan of the measures, by grouping sets."""
    return rollup.from_star(feed.star(spark, sf_dir), rollup.levels_sql)


@query
def mart_fanout_equiv(spark, sf_dir):
    """Per episode: totals counted per investor row and per pitch, from pre-aggregated deals."""
    columns = ["total_investment", *marts.FANNED, *marts.EXTRA]
    return marts.mart_episode(feed.star(spark, sf_dir), extra=True).select("season_number", "episode_in_season_num", *columns)


@query
def deal_value(spark, sf_dir):
    """Value of the deal fact by season and kind of investor: all line items of orders that are deals."""
    star = feed.star(spark, sf_dir)
    season = star.pitches.select("pitch_id", F.expr(f"episode_id DIV {feed.SEASON} AS season_number"))
    deals = star.deals.join(season, "pitch_id").join(star.sharks, "shark_id")
    total = F.round(F.expr(clean.exact_sum("investment_amount")), 2).cast("double")
    return deals.groupBy("season_number", "is_main_shark").agg(total.alias("deal_value"))


@query
def deal_flags(spark, sf_dir):
    return marts.deal_flags(feed.star(spark, sf_dir))


# ---------------------------------------------------------------------------
# calendar


@query
def dim_date(spark, sf_dir):
    """Calendar over the years of the orders, with the number of orders of each day."""
    orders = feed.read(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date"))
    per_day = orders.agg(F.count(F.lit(1)).alias("n_orders"))
    days = order_calendar(spark, sf_dir).join(per_day, "date", "left")
    return days.withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


@query
def calendar_anti(spark, sf_dir):
    """Days a calendar made of the order dates still lacks."""
    days = feed.read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return missing_days(with_date_attributes(days), order_calendar(spark, sf_dir))


@query
def role_playing_dates(spark, sf_dir):
    """The calendar joined twice: by order date and by last ship date."""
    orders = feed.read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    lines = feed.read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    shipped = lines.agg(F.to_date(F.max("l_shipdate")).alias("ship_date"))
    days = order_calendar(spark, sf_dir)
    both = lookup.lookup_date(orders.join(shipped, "o_orderkey", "left"), days, "order_date", "order_date_id")
    return lookup.lookup_date(both, days, "ship_date", "ship_date_id")


# ---------------------------------------------------------------------------
# reshaping


@query
def latest_per_key(spark, sf_dir):
    rows = feed.pitch_rows(spark, sf_dir).select("o_custkey", "original_air_date", "pitch_number", "original_ask_amount", "got_deal")
    return reshape.latest_per_key(rows, ["o_custkey"], ["original_air_date", "pitch_number"])


@query
def ordinal_in_parent(spark, sf_dir):
    rows = staged_with_business(spark, sf_dir).select("season_number", "episode_number", "pitch_number", "startup_name")
    parent = ["season_number", "episode_number"]
    return reshape.ordinal_within(rows, parent, ["pitch_number", "startup_name"], "pitch_order_in_episode")


@query
def ordinal_across_tasks(spark, sf_dir):
    """One parent for all rows, which so lies in every partition."""
    rows = staged_with_business(spark, sf_dir).select("season_number", "episode_number", "pitch_number", "startup_name")
    everything = rows.withColumn("series", F.lit("the only one"))
    return reshape.ordinal_within(everything, ["series"], ["pitch_number", "startup_name"], "pitch_order").drop("series")


def _guest_rows(spark, sf_dir):
    rows = feed.invested_rows(spark, sf_dir).filter(F.col("guest_investment_amount").isNotNull())
    return rows.select(
        F.col("o_orderkey").alias("pitch_id"),
        "guest_name",
        F.col("guest_investment_amount").alias("investment_amount"),
        (F.col("guest_investment_equity")).alias("investment_equity_pct"),
    )


@query
def entity_split(spark, sf_dir):
    return reshape.split_entities(_guest_rows(spark, sf_dir).select("pitch_id", "guest_name"), "guest_name", "shark_name")


@query
def even_allocation(spark, sf_dir):
    split = reshape.split_entities(_guest_rows(spark, sf_dir), "guest_name", "shark_name", "guest_count")
    even = reshape.allocate_evenly(split, ["investment_amount", "investment_equity_pct"], "guest_count")
    fraction = clean.percent_to_fraction(F.col("investment_equity_pct"))
    return even.select("pitch_id", "shark_name", "guest_count", "investment_amount", fraction.alias("investment_equity_pct"))


@query
def unpivot_amounts(spark, sf_dir):
    rows = feed.with_keys(feed.invested_rows(spark, sf_dir))
    return reshape.unpivot_measures(rows, ["pitch_id"], main_measures(feed.INVESTORS), "shark_name", "investment_amount")


# ---------------------------------------------------------------------------
# sources of the dimensions and facts


@query
def main_entities_values(spark, sf_dir):
    """The literal list of main investors with the number of their deals."""
    deals = feed.star(spark, sf_dir).deals.groupBy("shark_id").agg(F.count(F.lit(1)).alias("n_deals"))
    main = feed.shark_dim(spark).filter("is_main_shark").select("shark_id", "shark_name")
    return main.join(deals, "shark_id", "left").select("shark_name", F.coalesce("n_deals", F.lit(0)).alias("n_deals"))


@query
def entity_dim(spark, sf_dir):
    return load.shark_source(feed.invested_rows(spark, sf_dir), feed.CONFIG)


@query
def season_dim(spark, sf_dir):
    return load.season_source(feed.pitch_rows(spark, sf_dir), order_calendar(spark, sf_dir))


@query
def episode_dim(spark, sf_dir):
    seasons = feed.season_dim(feed.pitch_rows(spark, sf_dir))
    return load.episode_source(feed.pitch_rows(spark, sf_dir), seasons, order_calendar(spark, sf_dir))


@query
def key_lookup_left(spark, sf_dir):
    """Business keys by name from a dimension that lacks one segment."""
    known = feed.read(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    dim = known.select(clean.fold_key(F.col("c_name")).alias("folded"), (F.col("c_custkey") + 1).alias("business_id"))
    rows = staged_with_business(spark, sf_dir).select("pitch_number", clean.fold_key(F.col("startup_name")).alias("folded"))
    return lookup.lookup_key(rows, dim, ["folded"], "business_id")


@query
def episode_lookup(spark, sf_dir):
    """Episode keys by season and episode number; the last days of a season are unknown."""
    rows = feed.pitch_rows(spark, sf_dir).select("pitch_number", "season_number", "episode_number")
    dim = rows.select("season_number", "episode_number").distinct().filter("episode_number <= 270")
    dim = dim.withColumn("episode_id", feed.episode_key())
    return lookup.lookup_key(rows, dim, ["season_number", "episode_number"], "episode_id")


@query
def salted_lookup(spark, sf_dir):
    """Part of each line's supplier, joined with the hot suppliers spread over several tasks."""
    lines = feed.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    # every line with a low line number belongs to one supplier, which so has more than a third of them
    lines = lines.withColumn("s_suppkey", F.when(F.col("l_linenumber") <= 3, F.lit(1)).otherwise(F.col("l_suppkey")))
    dim = feed.read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    joined = lookup.salted_join(lines.drop("l_suppkey"), dim, ["s_suppkey"], "left")
    return joined.groupBy("s_suppkey", "s_name").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_orderkey").alias("sum_orderkey"))


@query
def deal_fact(spark, sf_dir):
    return feed.star(spark, sf_dir).deals.select("pitch_id", "shark_id", "investment_amount", "investment_equity_pct")


@query
def deal_defaults(spark, sf_dir):
    rows = load.deal_defaults(feed.with_keys(feed.pitch_rows(spark, sf_dir)))
    return rows.select("pitch_id", "got_deal", "is_royalty_deal", "loan", "advisory_shares", "deal_has_conditions")


# ---------------------------------------------------------------------------
# keys and upserts


@query
def surrogate_keys(spark, sf_dir):
    names = feed.read(spark, sf_dir, "customer").select("c_name", "c_mktsegment")
    return keys.assign_keys(names, ["c_name"], "business_id", start_after=1000)


# The rows come in two deliveries that overlap and together are the whole table.
EARLY, LATE = "season_number <= 5", "season_number >= 4"


def _upsert(
    name: str, key: str, rows: DataFrame, early: str, late: str, old: dict[str, Column], new: dict[str, Column], **options
) -> DataFrame:
    """Upsert of the late delivery, with changed attributes, into a table that holds the early one.

    ``rows`` has the natural key and ``k``, the number behind it; present rows
    have the key ``k + 1``.
    """
    natural = NATURAL_KEYS[name]
    rows = written(rows, "rows")
    before = rows.filter(early)
    target = stamp(before.select((F.col("k") + 1).alias(key), *natural, *[c.alias(n) for n, c in old.items()]), OLD)
    source = rows.filter(late).select(*natural, *[c.alias(n) for n, c in new.items()])
    fold = [c for c in natural if c in FOLDED_KEYS]
    result = upsert_type1(target, source, natural, key, F.lit(NEW).cast("timestamp"), fold=fold, **options)
    return result.table().withColumn("import_date", F.to_date("import_date"))


@query
def upsert_entity(spark, sf_dir):
    rows = feed.read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("k"), F.col("s_name").alias("shark_name"), "s_nationkey"
    )
    main = F.col("k") % 10 < 6
    early, late = "s_nationkey <= 15", "s_nationkey >= 10"
    return _upsert("dim_shark", "shark_id", rows, early, late, {"is_main_shark": main}, {"is_main_shark": ~main})


@query
def upsert_business(spark, sf_dir):
    """Names differ in case between source and table; a matched NULL overwrites."""
    customers = feed.customers(spark, sf_dir)
    name = F.when(F.col("c_custkey") % 4 == 0, F.upper("c_name")).otherwise(F.col("c_name"))
    rows = customers.select(F.col("c_custkey").alias("k"), name.alias("business_name"), "c_mktsegment", "n_name", "r_name")
    old = {"industry": F.col("c_mktsegment"), "entrepreneur_state": F.col("n_name"), "entrepreneur_city": F.col("r_name")}
    industry = F.when(F.col("k") % 5 != 0, F.lower("c_mktsegment"))
    new = {"industry": industry, "entrepreneur_state": F.col("n_name"), "entrepreneur_city": F.upper("n_name")}
    early, late = "r_name <> 'ASIA'", "r_name IN ('ASIA', 'EUROPE')"
    return _upsert("dim_business", "business_id", rows, early, late, old, new, keep_on_match=["business_name"])


@query
def upsert_season(spark, sf_dir):
    seasons = feed.pitch_rows(spark, sf_dir).groupBy("season_number").agg(F.min("season_start").alias("first"))
    rows = seasons.select(F.col("season_number").cast("bigint").alias("k"), "season_number", "first")
    day = F.year("first") * 10000 + 101
    old = {"season_label": clean.join_text("Season ", F.col("season_number")), "season_start_date_id": day}
    new = {"season_label": clean.join_text("S", F.col("season_number")), "season_start_date_id": day + 1}
    return _upsert("dim_season", "season_id", rows, EARLY, LATE, old, new)


@query
def upsert_episode(spark, sf_dir):
    aired = feed.pitch_rows(spark, sf_dir).groupBy("season_number", "episode_number").agg(F.max("us_viewership").alias("v"))
    rows = aired.select(
        feed.episode_key().alias("k"),
        F.col("season_number").cast("bigint").alias("season_id"),
        F.col("episode_number").alias("episode_in_season_num"),
        "season_number",
        "v",
    )
    viewers = F.col("v")
    return _upsert("dim_episode", "episode_id", rows, EARLY, LATE, {"us_viewership": viewers}, {"us_viewership": viewers + 1})


@query
def upsert_pitch(spark, sf_dir):
    rows = feed.with_keys(feed.pitch_rows(spark, sf_dir)).withColumn("k", F.col("pitch_id"))
    amount, deal = F.col("total_deal_amount"), F.col("got_deal")
    old, new = {"is_deal": deal, "deal_amount": amount}, {"is_deal": ~deal, "deal_amount": amount * 2}
    return _upsert("fact_pitch", "pitch_id", rows, EARLY, LATE, old, new)


@query
def upsert_deal(spark, sf_dir):
    # a deal has the episode of its pitch, so the facts need not be joined for the season
    deals = feed.star(spark, sf_dir).deals.withColumn("season_number", F.expr(f"episode_id DIV {feed.SEASON}"))
    rows = deals.withColumn("k", F.col("pitch_id") * 10 + F.col("shark_id"))
    amount, equity = F.col("investment_amount"), F.col("investment_equity_pct")
    old = {"investment_amount": amount, "investment_equity_pct": equity}
    new = {"investment_amount": amount * 2, "investment_equity_pct": F.lit(None).cast("double")}
    return _upsert("fact_deal_shark", "deal_shark_id", rows, EARLY, LATE, old, new)


@query
def upsert_no_retract(spark, sf_dir):
    """Rows per stamp after an upsert: untouched rows keep the old one."""
    orders = feed.with_keys(feed.pitch_rows(spark, sf_dir)).withColumn("k", F.col("pitch_id"))
    amount = F.col("total_deal_amount")
    table = _upsert("fact_pitch", "pitch_id", orders, EARLY, LATE, {"deal_amount": amount}, {"deal_amount": amount + 1})
    return table.groupBy("import_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.expr(clean.exact_sum("deal_amount")).cast("double").alias("total_amount")
    )


# ---------------------------------------------------------------------------
# expressions


def _as_text(spark, sf_dir) -> DataFrame:
    """Orders as feed text, with padding and blanks."""
    key = F.col("o_orderkey")
    date = F.col("o_orderdate")
    padded = F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))
    return feed.read(spark, sf_dir, "orders").select(
        key.cast("string").alias("order_key"),
        F.when(key % 7 == 0, F.lit("   ")).otherwise(padded).alias("priority"),
        F.when(key % 5 == 0, F.lit("")).when(key % 5 == 1, F.concat(F.lit(" "), (key % 100).cast("string"), F.lit(".0")))
        .otherwise((key % 100).cast("string")).alias("rank"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.when(key % 3 == 0, F.date_format(date, "M/d/yyyy")).when(key % 3 == 1, F.date_format(date, "d-MMM-yyyy"))
        .otherwise(F.date_format(date, "yyyy-MM-dd")).alias("ordered"),
        F.when(key % 4 == 0, F.lit(None)).when(key % 4 == 1, F.lit("0")).otherwise(F.lit("1")).alias("open"),
        F.when(key % 3 == 0, F.lit(" YES")).when(key % 3 == 1, F.lit("no")).alias("urgent"),
        F.lit(None).cast("string").alias(RAW),
    )


ORDER_FEED = FeedSpec(
    (
        Field("Order Key", "long", required=True),
        Field("Priority", "string", 20),
        Field("Rank", "int"),
        Field("Price", "double"),
        Field("Ordered", "date"),
        Field("Open", "flag"),
        Field("Urgent", "yes"),
    )
)


@query
def scalar_clean(spark, sf_dir):
    """Each cleaning expression by itself."""
    return _as_text(spark, sf_dir).selectExpr(
        clean.to_whole("order_key", "bigint") + " AS order_key",
        clean.blank_to_null("priority") + " AS priority",
        clean.to_whole("rank") + " AS rank",
        clean.to_date("ordered") + " AS ordered",
        clean.to_flag("open") + " AS open",
        clean.yes_flag("urgent") + " AS urgent",
        "length(priority) > 15 AS too_wide",
        "lower(rtrim(priority)) AS folded",
    )


@query
def stage_typed(spark, sf_dir):
    """The accepted rows of the declared feed layout."""
    return split_rows(typed_rows(_as_text(spark, sf_dir), ORDER_FEED), ORDER_FEED).good


@query
def stage_projection(spark, sf_dir):
    rows = load.business_source(feed.staged_rows(spark, sf_dir))
    return rows.select("business_name", "industry", "entrepreneur_city", "entrepreneur_state", "original_air_date", "pitch_number")


@query
def label_concat(spark, sf_dir):
    """``+`` gives NULL for a NULL part, ``concat`` skips it."""
    season, episode = F.col("season_number"), F.when(F.col("episode_number") != 8, F.col("episode_number"))
    return feed.pitch_rows(spark, sf_dir).select(
        "pitch_number",
        F.concat(F.lit("S"), season.cast("string"), F.lit("E"), episode.cast("string")).alias("code"),
        clean.join_text("Season ", season, ", Episode ", episode).alias("label"),
    )


@query
def safe_ratio(spark, sf_dir):
    """Deals per season and business segment over returned deals, some of which are zero."""
    rows = staged_with_business(spark, sf_dir).groupBy("o_custkey").agg(
        F.count_if("got_deal").alias("deals"), F.count_if("royalty_deal").alias("royalties")
    )
    return rows.select("o_custkey", F.expr(clean.ratio("deals", "royalties")).alias("deals_per_royalty"))


@query
def batch_stamp(spark, sf_dir):
    rows = stamp(feed.pitch_rows(spark, sf_dir), NEW)
    return rows.agg(F.to_date(F.max("import_date")).alias("batch_date"), F.count("import_date").alias("n_rows"))


# ---------------------------------------------------------------------------
# integrity


@query
def integrity_duplicates(spark, sf_dir):
    lines = feed.read(spark, sf_dir, "lineitem")
    return checks.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@query
def integrity_orphans(spark, sf_dir):
    """Customers without an order are no orphans; orders of one segment are made so."""
    known = feed.read(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    orders = feed.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return checks.orphans(orders, known, "c_custkey", unknown=None)


@query
def integrity_rules(spark, sf_dir):
    rows = feed.staged_rows(spark, sf_dir)
    return checks.rule_report(rows, ["startup_name", "us_viewership", "guest_name"], {"startup_name": 18, "guest_name": 20})


@query
def integrity_allocation(spark, sf_dir):
    """Pitches whose guest shares do not add up; there are none."""
    whole = _guest_rows(spark, sf_dir)
    split = reshape.split_entities(whole, "guest_name", "shark_name", "guest_count")
    parts = reshape.allocate_evenly(split, ["investment_amount"], "guest_count")
    gaps = checks.allocation_gaps(whole, parts, "pitch_id", "investment_amount")
    return gaps.agg(F.count(F.lit(1)).alias("n_gaps"))


# ---------------------------------------------------------------------------
# ingest and load


def _spoiled(spark, sf_dir) -> DataFrame:
    """Order text with unreadable, over-wide and missing values."""
    key = F.col("order_key").cast("bigint")
    return _as_text(spark, sf_dir).select(
        F.when(key % 23 == 0, F.lit(" ")).otherwise(F.col("order_key")).alias("order_key"),
        F.when(key % 19 == 0, F.lit("an endless list of priorities")).otherwise(F.col("priority")).alias("priority"),
        F.when(key % 17 == 0, F.lit("2.5")).otherwise(F.col("rank")).alias("rank"),
        F.when(key % 13 == 0, F.lit("n/a")).otherwise(F.col("price")).alias("price"),
        F.when(key % 11 == 0, F.lit("31-Feb-2001")).otherwise(F.col("ordered")).alias("ordered"),
        "open",
        "urgent",
        F.when(key % 29 == 0, F.col("order_key")).alias(RAW),
    )


@query
def quarantine_split(spark, sf_dir):
    """Rows by the reason and column of their rejection; accepted rows have neither."""
    rows = classify(_spoiled(spark, sf_dir), ORDER_FEED)
    return rows.groupBy("reject_reason", "reject_column").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("raw_line").alias("n_raw_lines"), F.sum("order_key").alias("sum_order_key")
    )


CUSTOMER_FEED = FeedSpec(
    (
        Field("Customer Key", "long", required=True),
        Field("Customer Name", "string", 250, required=True),
        Field("Segment", "string", 40),
        Field("Balance", "double"),
    )
)


@query
def ingest_csv_roundtrip(spark, sf_dir):
    """Customers written as CSV with commas, quotes and padding inside fields, and read back."""
    path = scratch_path(spark, "customers-csv")
    feed.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("Customer Key"),
        F.concat(F.lit('the "'), F.col("c_name"), F.lit('", Ltd')).alias("Customer Name"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("Segment"),
        F.col("c_acctbal").cast("string").alias("Balance"),
    ).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return read_feed(spark, path, CUSTOMER_FEED).good


@query
def quarantine_files(spark, sf_dir):
    """Customers written as lines of text, some of them short, long or over-wide, and read back from the files."""
    path = scratch_path(spark, "customer-lines")
    key, name = F.col("c_custkey"), F.col("c_name")
    wide = F.when(key % 19 == 0, F.rpad(name, 260, "x")).otherwise(name)
    fields = [key.cast("string"), wide, F.col("c_mktsegment"), F.col("c_acctbal").cast("string")]
    line = (
        F.when(key % 7 == 0, F.concat_ws(",", *fields[:3]))  # a field is missing
        .when(key % 11 == 0, F.concat_ws(",", *fields, F.lit("more")))
        .otherwise(F.concat_ws(",", *fields))
    )
    # a heading over the one column is the heading of the file
    heading = ",".join(f.header for f in CUSTOMER_FEED.fields)
    lines = feed.read(spark, sf_dir, "customer").select(line.alias(heading))
    lines.write.option("header", True).option("sep", "|").option("quote", "").csv(path)
    rows = classify(read_text(spark, path, CUSTOMER_FEED), CUSTOMER_FEED)
    return rows.groupBy("reject_reason", "reject_column").agg(F.count(F.lit(1)).alias("n_rows"), F.count("raw_line").alias("n_raw_lines"))


def _feed_files(spark, sf_dir, path: str) -> None:
    text = feed.as_feed_text(feed.staged_rows(spark, sf_dir))
    text.write.option("header", True).option("escape", '"').csv(path)


@query
def ingest_feed(spark, sf_dir):
    """The whole feed layout, written as files and read back."""
    path = scratch_path(spark, "feed-csv")
    _feed_files(spark, sf_dir, path)
    rows = typed_rows(read_text(spark, path, feed.CONFIG.feed), feed.CONFIG.feed)
    return split_rows(rows, feed.CONFIG.feed).good


@query
def stream_ingest(spark, sf_dir):
    """The same files picked up from a drop folder by a stream."""
    path, out = scratch_path(spark, "drop"), scratch_path(spark, "streamed")
    _feed_files(spark, sf_dir, path)

    def keep(rows: DataFrame, number: int) -> None:
        split_rows(rows, feed.CONFIG.feed).good.write.mode("overwrite").parquet(f"{out}/micro_batch={number}")

    make_folder(spark, out)
    # an archive folder makes the source move each file away once a later run has begun
    archive, progress = scratch_path(spark, "archive"), scratch_path(spark, "progress")
    ingest_stream(spark, path, progress, feed.CONFIG.feed, keep, archive, max_files=4).awaitTermination()
    return spark.read.schema(feed.CONFIG.feed.typed_schema).parquet(out).select(*feed.CONFIG.feed.names)


def _opened(spark, sf_dir):
    """An empty warehouse of its own, with the calendar of the orders."""
    warehouse = load.open_warehouse(spark, scratch_path(spark, "warehouse"), f"q{uuid4().hex[:12]}_")
    load.populate_calendar(warehouse, *order_years(spark, sf_dir))
    return warehouse


def _loaded(spark, sf_dir):
    """A warehouse loaded in two batches that overlap."""
    warehouse = _opened(spark, sf_dir)
    rows = written(feed.staged_rows(spark, sf_dir), "rows")
    load.stage_typed(warehouse, rows.filter(EARLY), OLD)
    load.stage_typed(warehouse, rows.filter(LATE), NEW)
    load.load_warehouse(warehouse, feed.CONFIG)
    return warehouse


@query
def two_schedules(spark, sf_dir):
    """A file's batch that is loaded before an older batch of a stream: its rows stay, since their stamp is later."""
    warehouse = _opened(spark, sf_dir)
    rows = written(feed.staged_rows(spark, sf_dir), "rows")
    load.stage_typed(warehouse, rows.filter(LATE).withColumn("industry", F.lit("newer")), NEW)
    load.load_warehouse(warehouse, feed.CONFIG)
    load.stage_typed(warehouse, rows.withColumn("industry", F.lit("older")), OLD, "stream_0001")
    load.load_warehouse(warehouse, feed.CONFIG)
    business = warehouse.table("dim_business")
    return business.groupBy("industry", F.to_date("import_date").alias("batch_date")).agg(F.count(F.lit(1)).alias("n_businesses"))


# Three deliveries: what each holds, and when it was made.
DELIVERIES = {1: (EARLY, OLD), 2: (LATE, NEW), 3: ("pitch_number % 3 = 0", datetime(2003, 1, 1, 12))}


@query
def batches_in_any_order(spark, sf_dir):
    """Three overlapping batches loaded as 3, 1, 3, 2: every row comes out as the latest batch that has it left it."""
    warehouse = _opened(spark, sf_dir)
    rows = written(feed.staged_rows(spark, sf_dir), "rows")
    for k in (3, 1, 3, 2):
        held, at = DELIVERIES[k]
        changed = {"total_deal_amount": F.col("total_deal_amount") * k, "industry": F.lit(f"of {k}"), "us_viewership": F.lit(float(k))}
        load.stage_typed(warehouse, rows.filter(held).withColumns(changed), at, f"delivery_{k}")
        load.load_warehouse(warehouse, feed.CONFIG)
    part = lambda table, what, value: warehouse.table(table).select(
        F.lit(table).alias("table_name"), F.to_date("import_date").alias("batch_date"), F.expr(what).alias("state"), F.expr(value).cast(clean.MONEY).alias("value")
    )
    cells = part("fact_pitch", "cast(is_deal AS string)", "deal_amount").unionByName(part("fact_deal_shark", "'deal'", "1"))
    cells = cells.unionByName(part("dim_business", "industry", "1")).unionByName(part("dim_episode", "'viewers'", "us_viewership"))
    return cells.groupBy("table_name", "batch_date", "state").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").cast("double").alias("total"))


@query
def warehouse_load(spark, sf_dir):
    """Staging to star and season mart, with surrogate keys, in two overlapping batches."""
    return marts.mart_season(marts.star_of(_loaded(spark, sf_dir)))


@query
def warehouse_views(spark, sf_dir):
    """The season view of the catalog after a load of all seasons but one, and then of that one: its aggregates were kept up."""
    warehouse = _opened(spark, sf_dir)
    rows = written(feed.staged_rows(spark, sf_dir), "rows")
    load.stage_typed(warehouse, rows.filter("season_number <> 3"), OLD)
    load.load_warehouse(warehouse, feed.CONFIG)
    load.stage_typed(warehouse, rows.filter("season_number = 3"), NEW)
    load.load_warehouse(warehouse, feed.CONFIG)
    return spark.sql(f"SELECT * FROM {warehouse.prefix}analytics.vw_season_summary")
