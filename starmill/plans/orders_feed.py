"""An order database seen as a pitch feed, so that the warehouse can be run on the given tables.

Every order is a pitch: its year is the season and its day the episode. A
customer's second order of one day belongs to a second episode of that day, and
so on, so that a business pitches once in an episode. Line items are the
investments, by supplier number; what an investor has in one order is summed.
Keys are taken from the data (no surrogate keys), which keeps the whole star
one lazy plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.functions.clean import MONEY
from starmill.operators.calendar import calendar
from starmill.plans.load import deal_defaults, named_deals
from starmill.plans.marts import Star
from starmill.plans.model import LoadConfig
from starmill.session import written

INVESTORS = tuple(f"Investor {i}" for i in range(6))
GUESTS = range(6, 10)
CONFIG = LoadConfig(main_sharks=INVESTORS)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Episode numbers of a day's second, third, ... round begin a thousand higher each.
ROUND, SEASON = 1_000, 100_000_000


def season_key() -> Column:
    return F.col("season_number").cast("bigint").alias("season_id")


def numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its day and the number of the customer's earlier orders (lower keys) of that day."""
    orders = read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    of_day = Window.partitionBy("o_custkey", "day").orderBy("o_orderkey")
    return orders.withColumn("earlier", F.row_number().over(of_day) - 1)


def episode_key() -> Column:
    return (F.col("season_number").cast("bigint") * SEASON + F.col("episode_number")).alias("episode_id")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customer = read(spark, sf_dir, "customer")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "c_mktsegment", "n_name", "r_name"
    )


def pitch_columns(orders: DataFrame, *others: str) -> DataFrame:
    """Staged columns that come from ``numbered_orders`` alone, with the source keys and the columns ``others``."""
    key, deal = F.col("o_orderkey"), F.col("o_orderstatus") != "O"
    year, month = F.year("day"), F.month("day")
    return orders.select(
        key,
        "o_custkey",
        (year - 1994).alias("season_number"),
        (F.dayofyear("day") + F.col("earlier") * ROUND).alias("episode_number"),
        key.alias("pitch_number"),
        F.make_date(year, F.lit(1), F.lit(1)).alias("season_start"),
        F.make_date(year, F.lit(12), F.lit(31)).alias("season_end"),
        F.col("day").alias("original_air_date"),
        F.when(month != 8, ((year * 100 + month) % 7) + F.lit(0.25)).alias("us_viewership"),
        F.col("o_totalprice").alias("original_ask_amount"),
        F.col("o_totalprice").alias("total_deal_amount"),
        deal.alias("got_deal"),
        F.when(deal & (key % 5 == 0), F.lit(True)).alias("royalty_deal"),
        F.when(deal & (key % 11 == 0), F.lit(2.5)).alias("advisory_shares_equity"),
        F.lit(None).cast("double").alias("loan"),
        F.when(deal & (key % 7 == 0), F.lit(True)).alias("deal_has_conditions"),
        *others,
    )


def pitch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitch_columns(numbered_orders(spark, sf_dir))


def line_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: amount and equity of each main investor, and of the guests together.

    The lines are dealt out by order as they are, four numbers each, and added up
    by order and investor where they arrive: a row of sums for all investors is
    ten times as wide as a line, and a task that reads lines in no order would
    send one for nearly each of them.
    """
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_quantity")
    group, guest = F.col("l_suppkey") % 10, min(GUESTS)
    # a guest is one bit of a number: a hash aggregation can't hold texts
    bit = F.when(group >= guest, F.call_function("shiftleft", F.lit(1), group.cast("int"))).otherwise(F.lit(0))
    dealt = lines.repartition("l_orderkey").select("l_orderkey", F.when(group >= guest, guest).otherwise(group).alias("investor"), bit.alias("guests"), "l_extendedprice", "l_quantity")
    total = lambda value: F.sum(F.col(value).cast(MONEY)).cast("double")
    sums = dealt.groupBy("l_orderkey", "investor").agg(
        total("l_extendedprice").alias("amount"), total("l_quantity").alias("equity"), F.bit_or("guests").alias("guests")
    )
    columns: list[Column] = []
    for i, investor in enumerate([*[f"investor_{i}" for i, _ in enumerate(INVESTORS)], "guest"]):
        for what in ("amount", "equity"):
            columns.append(F.max(F.when(F.col("investor") == i, F.col(what))).alias(f"{investor}_investment_{what}"))
    per_order = sums.groupBy("l_orderkey").agg(*columns, F.bit_or("guests").alias("guests"))
    texts = [F.when(F.col("guests").bitwiseAND(F.lit(1 << i)) != 0, F.lit(f"Guest {i}")) for i in GUESTS]
    names = F.nullif(F.concat_ws(", and ", *texts), F.lit(""))
    return per_order.withColumn("guest_name", names).drop("guests")


def invested_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pitch_rows`` with the investor columns, which are empty where there was no deal."""
    # the order's own few columns are dealt out, and what comes from them is made after the join
    orders, measures = numbered_orders(spark, sf_dir), line_measures(spark, sf_dir)
    on = (orders["o_orderkey"] == measures["l_orderkey"]) & (orders["o_orderstatus"] != "O")
    return pitch_columns(orders.join(measures, on, "left"), *[c for c in measures.columns if c != "l_orderkey"])


def staged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feed columns, typed; what the order database has no counterpart for is NULL."""
    rows = invested_rows(spark, sf_dir)
    rows = rows.join(customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.withColumnsRenamed(
        {"c_name": "startup_name", "c_mktsegment": "industry", "n_name": "pitchers_state", "r_name": "pitchers_city"}
    )
    have = set(rows.columns)
    types = [(f.name, f.dataType.simpleString()) for f in CONFIG.feed.typed_schema]
    return rows.selectExpr(*[f"cast({n if n in have else 'NULL'} AS {t}) AS {n}" for n, t in types])


def with_keys(rows: DataFrame) -> DataFrame:
    """Keys that follow from the source keys."""
    return rows.select(
        F.col("o_orderkey").alias("pitch_id"),
        F.col("o_custkey").alias("business_id"),
        episode_key(),
        *[c for c in rows.columns if c not in ("o_orderkey", "o_custkey")],
    )


def pitch_fact(keyed: DataFrame) -> DataFrame:
    return deal_defaults(keyed).select(
        "pitch_id",
        "business_id",
        "episode_id",
        season_key(),
        F.col("got_deal").alias("is_deal"),
        F.col("total_deal_amount").alias("deal_amount"),
        "is_royalty_deal",
        "loan",
        "advisory_shares",
        "deal_has_conditions",
    )


def shark_dim(spark: SparkSession) -> DataFrame:
    """The ten supplier groups: the key is the group's number."""
    rows = [(i, f"Investor {i}", True) for i, _ in enumerate(INVESTORS)] + [(i, f"Guest {i}", False) for i in GUESTS]
    return spark.createDataFrame(rows, "shark_id bigint, shark_name string, is_main_shark boolean")


def deal_fact(keyed: DataFrame) -> DataFrame:
    """One row per pitch and investor, from the staged columns through unpivot, split and allocation."""
    deals = named_deals(keyed, ["pitch_id", "episode_id", "season_number"], CONFIG)
    keys = F.broadcast(shark_dim(keyed.sparkSession).select("shark_name", "shark_id"))  # ten rows
    return deals.join(keys, "shark_name").select(
        "pitch_id", "shark_id", "investment_amount", "investment_equity_pct", "episode_id", season_key()
    )


def episode_dim(keyed: DataFrame) -> DataFrame:
    aired = keyed.groupBy("episode_id", "season_number", "episode_number")
    aired = aired.agg(F.max("original_air_date").alias("day"), F.max("us_viewership").alias("us_viewership"))
    return aired.select(
        "episode_id",
        F.col("season_number").cast("bigint").alias("season_id"),
        F.col("episode_number").alias("episode_in_season_num"),
        (F.year("day") * 10000 + F.month("day") * 100 + F.dayofmonth("day")).alias("air_date_id"),
        "us_viewership",
    )


def season_dim(keyed: DataFrame) -> DataFrame:
    numbers = keyed.select("season_number").distinct()
    number, year = F.col("season_number").cast("string"), F.col("season_number") + 1994
    return numbers.select(
        F.col("season_number").cast("bigint").alias("season_id"),
        "season_number",
        F.concat(F.lit("Season "), number).alias("season_label"),
        F.concat(F.lit("S"), number).alias("season_abbrev"),
        (year * 10000 + 101).alias("season_start_date_id"),
        (year * 10000 + 1231).alias("season_end_date_id"),
    )


def business_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).select(
        F.col("c_custkey").alias("business_id"),
        F.col("c_name").alias("business_name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("n_name").alias("entrepreneur_state"),
        F.col("r_name").alias("entrepreneur_city"),
    )


def as_feed_text(rows: DataFrame) -> DataFrame:
    """Typed feed rows as the text columns, under the headings, of a feed file."""
    values = {"flag": "cast({} AS int)", "yes": "CASE WHEN {} THEN 'yes' END"}
    return rows.selectExpr(
        *[f"cast({values.get(f.kind, '{}').format(f.name)} AS string) AS `{f.header}`" for f in CONFIG.feed.fields]
    )


_stars: dict[tuple[str, str], Star] = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The star for a data folder, written on first use and read back by all marts of the session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stars:
        _stars[key] = build_star(spark, sf_dir)
    return _stars[key]


def build_star(spark: SparkSession, sf_dir: str) -> Star:
    keyed = written(with_keys(invested_rows(spark, sf_dir)), "pitches")
    # by season, as in a warehouse; each task writes its rows of a season, so no row is shuffled for that
    pitches = written(pitch_fact(keyed), "pitch-fact", by="season_id")
    deals = written(deal_fact(keyed), "deals", by="season_id")
    episodes = written(episode_dim(keyed), "episodes")
    seasons = written(season_dim(keyed), "seasons")
    first, last = keyed.agg(F.min(F.year("season_start")), F.max(F.year("season_end"))).first()
    days = written(calendar(spark, first, last), "calendar")
    businesses = written(business_dim(spark, sf_dir), "businesses")
    return Star(
        pitches=pitches,
        deals=deals,
        sharks=shark_dim(spark),
        episodes=episodes,
        seasons=seasons,
        calendar=days,
        businesses=businesses,
    )
