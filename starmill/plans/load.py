"""Feed to staging, staging to star."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import Executor, Future, ThreadPoolExecutor
from contextvars import copy_context
from datetime import datetime
from hashlib import sha256
from re import fullmatch
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.clean import default_when, fold_key, percent_to_fraction
from starmill.operators.calendar import extend_calendar
from starmill.operators.checks import duplicate_keys
from starmill.operators.lookup import lookup, lookup_date, lookup_key
from starmill.operators.reshape import entity_names, latest_per_key, ordinal_within, split_entities
from starmill.operators.upsert import Upsert, upsert_type1
from starmill.plans.marts import star_of
from starmill.plans.model import BUCKETED_BY, CARRIED, FOLDED_KEYS, NATURAL_KEYS, SURROGATE_KEYS, LoadConfig, main_measures
from starmill.plans.rollup import create_views, renewals
from starmill.session import scratch_scope, written
from starmill.sources import files
from starmill.sources.feed import REJECT_COLUMNS, read_text, stamp, typed_rows
from starmill.sources.store import Warehouse

# ---------------------------------------------------------------------------
# feed -> staging


def batch_id(at: datetime, sources: Sequence[str] = ()) -> str:
    """Name of a batch: its stamp, and a digest of the files it comes from or else a number of its own."""
    digest = sha256("\n".join(sorted(sources)).encode()).hexdigest()[:16] if sources else uuid4().hex[:16]
    return f"{at:%Y%m%d_%H%M%S_%f}_{digest}"


def stage_rows(warehouse: Warehouse, rows: DataFrame, at: datetime, batch: str | None = None) -> str:
    """Stage classified feed rows as one batch; staging a batch of the same name again replaces it.

    The stamp of a named batch is fixed when it is staged first, so that a
    repeated micro-batch does not come out as the newest. The feed is parsed
    once: accepted and rejected rows go to partitions of one write, and the few
    rejected ones are copied to the quarantine.
    """
    if batch:
        at = _first_stamp(warehouse, batch, at)
    batch = batch or batch_id(at)
    if not fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"not a name for a batch: {batch}")
    warehouse.add_columns("pitch_raw_data", rows.schema)
    warehouse.drop_batch("pitch_raw_data", batch)
    target = warehouse.stored("pitch_raw_data").schema
    addresses = {"batch": F.lit(batch), "stamped": F.lit(f"{at:%Y%m%d_%H%M%S_%f}"), "rejected": F.col("reject_reason").isNotNull()}
    stamped = stamp(rows, at).withColumns(addresses)
    lacking = {f.name: F.lit(None).cast(f.dataType) for f in target if f.name not in stamped.columns}
    warehouse.replace("pitch_raw_data", stamped.withColumns(lacking))
    bad = warehouse.stored("pitch_raw_data").filter((F.col("batch") == batch) & F.col("rejected"))
    warehouse.drop_batch("quarantine", batch)
    warehouse.replace("quarantine", bad)
    return batch


def _first_stamp(warehouse: Warehouse, batch: str, at: datetime) -> datetime:
    known = warehouse.stored("stamps").filter(F.col("batch") == batch).first()
    if known:
        return known["import_date"]
    fixed = warehouse.spark.range(1).select(F.lit(at).cast("timestamp").alias("import_date"), F.lit(batch).alias("batch"))
    warehouse.replace("stamps", fixed)
    return at


def stage_typed(warehouse: Warehouse, rows: DataFrame, at: datetime, batch: str | None = None) -> str:
    """Stage rows that already have the feed's types."""
    none = F.lit(None).cast("string")
    return stage_rows(warehouse, rows.withColumns({c: none for c in REJECT_COLUMNS}), at, batch)


def staged(warehouse: Warehouse, batch: str, config: LoadConfig) -> DataFrame:
    """The accepted rows of a batch."""
    rows = warehouse.stored("pitch_raw_data").filter((F.col("batch") == batch) & ~F.col("rejected"))
    lacking = {f.name: F.lit(None).cast(f.dataType) for f in config.feed.typed_schema if f.name not in rows.columns}
    return rows.withColumns(lacking).select(*config.feed.names, "import_date")


def quarantined(warehouse: Warehouse) -> DataFrame:
    """Every rejected row so far, with the reason, the column and the raw line."""
    return warehouse.stored("quarantine")


def staged_batches(warehouse: Warehouse) -> list[str]:
    """Batches whose staging is complete, by the stamp of their rows."""
    specs = [dict(p.split("=", 1) for p in path.split("/")) for path in warehouse.partitions("pitch_raw_data")]
    return [batch for _, batch in sorted({(s["stamped"], s["batch"]) for s in specs})]


def failed_batches(warehouse: Warehouse) -> dict[str, str]:
    """Batches that a load has set aside, with the error."""
    return {r["batch"]: r["error"] for r in warehouse.stored("failed_batches").collect()}


def pending_batches(warehouse: Warehouse) -> list[str]:
    """Staged batches that no load has consumed or set aside."""
    failed = failed_batches(warehouse)
    return [b for b in staged_batches(warehouse) if b not in failed]


def _set_aside(warehouse: Warehouse, batch: str, error: str) -> None:
    row = warehouse.spark.range(1).select(F.lit(error).alias("error"), F.lit(batch).alias("batch"))
    warehouse.replace("failed_batches", row)


def _release(warehouse: Warehouse, batch: str) -> None:
    """Drop the staged rows of a batch that has been loaded."""
    warehouse.drop_batch("failed_batches", batch)
    warehouse.drop_batch("pitch_raw_data", batch)


def ingest_file(
    warehouse: Warehouse,
    path: str,
    archive_dir: str | None,
    at: datetime,
    config: LoadConfig = LoadConfig(),
    strict: bool = False,
    encoding: str = "cp1252",
    multi_line: bool | None = None,
) -> str | None:
    """Stage a dropped file, or all that match a glob, and archive it. No file is no error: nothing is done."""
    spark = warehouse.spark
    dropped = files.matching(spark, path)
    if not dropped:
        return None
    text = read_text(spark, dropped, config.feed, encoding, multi_line)
    batch = stage_rows(warehouse, typed_rows(text, config.feed, strict), at, batch_id(at, dropped))
    if archive_dir:
        for each in dropped:
            files.archive_file(spark, each, archive_dir, at)
    return batch


# ---------------------------------------------------------------------------
# sources of the upserts


def shark_source(stage: DataFrame, config: LoadConfig) -> DataFrame:
    """Main list and guests, one row per name; the main list wins."""
    spark = stage.sparkSession
    main = spark.createDataFrame([(n, True) for n in config.main_sharks], "shark_name string, is_main_shark boolean")
    texts = stage.filter(F.col("guest_name").isNotNull()).select("guest_name").distinct()
    guests = split_entities(texts, "guest_name", "shark_name", drop_empty=config.drop_empty_guests)
    named = main.unionByName(guests.select("shark_name", F.lit(False).alias("is_main_shark")))
    best = F.max(F.struct("is_main_shark", "shark_name")).alias("best")
    return named.groupBy(fold_key(F.col("shark_name")).alias("folded")).agg(best).select("best.shark_name", "best.is_main_shark")


def business_source(stage: DataFrame) -> DataFrame:
    """All appearances of a business; the upsert takes the latest one."""
    return stage.select(
        F.col("startup_name").alias("business_name"),
        "industry",
        "business_description",
        "company_website",
        "entrepreneur_names",
        F.col("pitchers_city").alias("entrepreneur_city"),
        F.col("pitchers_state").alias("entrepreneur_state"),
        "original_air_date",
        "pitch_number",
    )


def season_source(stage: DataFrame, calendar: DataFrame) -> DataFrame:
    spans = stage.select("season_number", "season_start", "season_end").distinct()
    spans = lookup_date(spans, calendar, "season_start", "start_id")
    spans = lookup_date(spans, calendar, "season_end", "end_id")
    number = F.col("season_number").cast("string")
    return spans.groupBy("season_number").agg(
        F.min("start_id").alias("season_start_date_id"), F.max("end_id").alias("season_end_date_id")
    ).select(
        "season_number",
        F.concat(F.lit("Season "), number).alias("season_label"),
        F.concat(F.lit("S"), number).alias("season_abbrev"),
        "season_start_date_id",
        "season_end_date_id",
    )


def episode_source(stage: DataFrame, seasons: DataFrame, calendar: DataFrame) -> DataFrame:
    aired = stage.groupBy("season_number", "episode_number", "original_air_date").agg(F.max("us_viewership").alias("us_viewership"))
    aired = lookup_key(aired, seasons, ["season_number"], "season_id", None)
    aired = lookup_date(aired, calendar, "original_air_date", "air_date_id")
    return aired.groupBy("season_id", F.col("episode_number").alias("episode_in_season_num")).agg(
        F.max("air_date_id").alias("air_date_id"), F.max("us_viewership").alias("us_viewership")
    )


def episode_numbers(episodes: DataFrame, seasons: DataFrame) -> DataFrame:
    """Episode keys by season number and episode number."""
    numbered = lookup(episodes, seasons.select("season_id", "season_number"), ["season_id"], "inner")
    return numbered.select("season_number", F.col("episode_in_season_num").alias("episode_number"), "episode_id", "season_id")


def appearance_columns(config: LoadConfig) -> list[str]:
    """The staged columns that the facts and their keys come from."""
    return [
        "season_number", "episode_number", "pitch_number", "startup_name", "original_ask_amount", "original_offered_equity",
        "valuation_requested", "got_deal", "number_of_sharks_in_deal", "total_deal_amount", "total_deal_equity", "deal_valuation",
        "royalty_deal", "loan", "advisory_shares_equity", "deal_has_conditions", *deal_columns(config),
    ]


def resolve_keys(stage: DataFrame, businesses: DataFrame, episodes: DataFrame) -> DataFrame:
    """Attach business, episode and season keys; 0 where the dimension has no row."""
    folded = businesses.select(fold_key(F.col("business_name")).alias("_business"), "business_id")
    named = stage.withColumn("_business", fold_key(F.col("startup_name")))
    keyed = lookup_key(named, folded, ["_business"], "business_id", 0)
    keyed = lookup(keyed, episodes, ["season_number", "episode_number"], "left")
    return keyed.withColumns({k: F.coalesce(k, F.lit(0).cast("bigint")) for k in ("episode_id", "season_id")}).drop("_business")


def deal_defaults(df: DataFrame) -> DataFrame:
    """Parts of a deal that the feed leaves out: absent (0) where there is a deal, unknown elsewhere."""
    deal = F.coalesce("got_deal", F.lit(False))
    return df.select(
        "*",
        default_when(deal, F.col("royalty_deal"), False).alias("is_royalty_deal"),
        default_when(deal, F.col("loan"), 0.0).alias("_loan"),
        default_when(deal, F.col("advisory_shares_equity"), 0.0).alias("advisory_shares"),
        default_when(deal, F.col("deal_has_conditions"), False).alias("_conditions"),
    ).drop("loan", "deal_has_conditions").withColumnsRenamed({"_loan": "loan", "_conditions": "deal_has_conditions"})


GUEST_CELLS = "array<struct<shark_name:string,investment_amount:double,investment_equity_pct:double>>"


def deal_columns(config: LoadConfig) -> list[str]:
    columns = [c for m in main_measures(config.main_sharks).values() for c in m.values()]
    return [*columns, "guest_name", "guest_investment_amount", "guest_investment_equity"]


def pitch_source(resolved: DataFrame, config: LoadConfig) -> DataFrame:
    """Fact rows from staged rows with keys; the investor columns ride along for the deal fact."""
    placed = ordinal_within(
        resolved, ["season_number", "episode_number"], ["pitch_number", "startup_name"], "pitch_order_in_episode"
    )
    return deal_defaults(placed).select(
        "business_id",
        "episode_id",
        "season_id",
        "pitch_order_in_episode",
        F.col("original_ask_amount").alias("ask_amount"),
        percent_to_fraction(F.col("original_offered_equity")).alias("ask_equity_pct"),
        "valuation_requested",
        F.col("got_deal").alias("is_deal"),
        F.col("number_of_sharks_in_deal").alias("number_of_sharks"),
        F.col("total_deal_amount").alias("deal_amount"),
        percent_to_fraction(F.col("total_deal_equity")).alias("deal_equity_pct"),
        F.col("deal_valuation").alias("valuation_offered"),
        "is_royalty_deal",
        "loan",
        "advisory_shares",
        "deal_has_conditions",
        *deal_columns(config),
    )


def named_deals(pitches: DataFrame, id_cols: list[str], config: LoadConfig) -> DataFrame:
    """One row per pitch and investor name, from the main columns and the guest list.

    Both kinds are cells of one array that is opened once, so the wide rows are
    read once. A guest amount is shared evenly by the names in the list.
    """

    def cell(name: Column, amount: Column, equity: Column) -> Column:
        fraction = percent_to_fraction(equity).alias("investment_equity_pct")
        return F.struct(name.alias("shark_name"), amount.alias("investment_amount"), fraction)

    main = [
        cell(F.lit(name), F.col(c["investment_amount"]), F.col(c["investment_equity_pct"]))
        for name, c in main_measures(config.main_sharks).items()
    ]
    amount, equity = F.col("guest_investment_amount"), F.col("guest_investment_equity")
    names = entity_names(F.col("guest_name"), drop_empty=config.drop_empty_guests)
    share = F.nullif(F.size("_guests"), F.lit(0))
    guests = F.transform("_guests", lambda name: cell(name, amount / share, equity / share))
    # without an amount, or without a name to give it to, there is no guest row
    has_guests = amount.isNotNull() & F.col("guest_name").isNotNull()
    cells = F.concat(F.array(*main), F.when(has_guests, guests).otherwise(F.array().cast(GUEST_CELLS)))
    opened = pitches.withColumn("_guests", names).select(*id_cols, F.inline(cells))
    return opened.filter(F.col("investment_amount").isNotNull())


def deal_source(pitches: DataFrame, sharks: DataFrame, config: LoadConfig) -> DataFrame:
    """Deal fact rows; ``pitches`` has pitch and season keys and the investor columns."""
    known = pitches.filter((F.col("business_id") != 0) & (F.col("episode_id") != 0))
    deals = named_deals(known, ["pitch_id", "episode_id", "season_id"], config)
    deals = deals.withColumn("_shark", fold_key(F.col("shark_name"))).drop("shark_name")
    keys = sharks.select(fold_key(F.col("shark_name")).alias("_shark"), "shark_id")
    return lookup(deals, keys, ["_shark"], "inner").drop("_shark")


# ---------------------------------------------------------------------------
# procedures


def populate_calendar(warehouse: Warehouse, start_year: int, end_year: int | None = None) -> None:
    """Add the days of the given years to the calendar table."""
    wanted = extend_calendar(warehouse.table("dim_date"), start_year, end_year)
    warehouse.replace("dim_date", wanted.withColumn("bucket", warehouse.bucket("dim_date", {})).coalesce(1))


def _touched(warehouse: Warehouse, name: str, source: DataFrame) -> DataFrame:
    """The stored rows in the partitions that ``source`` has rows for: as many partitions as it has at most."""
    if name not in BUCKETED_BY:
        return warehouse.stored(name)  # one partition
    addresses = warehouse.addresses(name)
    found = source.select(*addresses).distinct().collect()
    wanted = F.lit(False)
    for values in {tuple(r)[:-1] for r in found}:
        same = F.col("bucket").isin(sorted(r["bucket"] for r in found if tuple(r)[:-1] == values))
        for column, value in zip(addresses, values, strict=False):
            same &= F.col(column) == value
        wanted |= same
    return warehouse.stored(name).filter(wanted)


def upsert_table(
    warehouse: Warehouse, name: str, source: DataFrame, at: datetime, pool: Executor | None = None, within: DataFrame | None = None, **options
) -> tuple[Upsert, Future]:
    """Upsert into a table of the warehouse; only partitions that hold keys of ``source`` are read and written again.

    With ``pool`` the table is written beside what else goes on there.
    ``within`` may give rows that are cheaper to read and have all addresses of
    the source.
    """
    natural, key = NATURAL_KEYS[name], SURROGATE_KEYS[name]
    fold = [c for c in natural if c in FOLDED_KEYS]
    bucket = warehouse.bucket(name, {c: fold_key(F.col(c)) for c in fold})
    source = source.withColumn("bucket", bucket)
    addressed = source if within is None else within.withColumn("bucket", bucket)
    first = {"first_col": "first_date"} if "first_date" in CARRIED.get(name, "") else {}
    stamp_at = F.lit(at).cast("timestamp")
    result = upsert_type1(
        _touched(warehouse, name, addressed), source, natural, key, stamp_at, fold=fold,
        start_after=warehouse.max_key(name, key), stored_by=warehouse.addresses(name), **first, **options,
    )
    warehouse.keep_max_key(name, result.last_key)
    table = result.table(warehouse.addresses(name))
    if pool:
        return result, pool.submit(copy_context().run, warehouse.replace, name, table)
    warehouse.replace(name, table)
    done: Future = Future()
    done.set_result(None)
    return result, done


def _load_batch(warehouse: Warehouse, batch: str, config: LoadConfig) -> bool:
    stage = staged(warehouse, batch, config)
    at = stage.agg(F.max("import_date")).first()[0]
    if at is None:
        return False
    if config.on_duplicate == "error":
        _refuse_duplicates(stage)
    calendar = warehouse.table("dim_date")

    def sharks() -> None:
        upsert_table(warehouse, "dim_shark", shark_source(stage, config), at)

    def businesses() -> None:
        latest = {"on_duplicate": "latest", "order_by": ["original_air_date", "pitch_number"]}
        upsert_table(warehouse, "dim_business", business_source(stage), at, keep_on_match=["business_name"], **latest)

    def seasons_then_episodes() -> None:
        upsert_table(warehouse, "dim_season", season_source(stage, calendar), at)
        source = episode_source(stage, warehouse.table("dim_season"), calendar)
        upsert_table(warehouse, "dim_episode", source, at)

    # these do not depend on each other, so their jobs share the cluster
    _together(sharks, businesses, seasons_then_episodes)

    if config.on_duplicate == "latest":
        business = fold_key(F.col("startup_name"))
        keyed = stage.withColumn("_business", business)
        appearance = ["_business", "season_number", "episode_number"]
        stage = latest_per_key(keyed, appearance, ["original_air_date", "pitch_number"]).drop("_business")
    # written, so that its size is known: of a join the planner takes the product of both sizes
    episodes = written(episode_numbers(warehouse.table("dim_episode"), warehouse.table("dim_season")), "episode-numbers")
    stage = stage.select(*appearance_columns(config))  # other columns would be dealt out with them
    resolved = written(resolve_keys(stage, warehouse.table("dim_business"), episodes), "resolved")

    with ThreadPoolExecutor() as pool:
        pitches, pitches_written = upsert_table(warehouse, "fact_pitch", pitch_source(resolved, config), at, pool, resolved)
        # written, since names are split and looked up for each of the passes over them
        deals = written(deal_source(pitches.found, warehouse.table("dim_shark"), config), "deals")
        latest = {"on_duplicate": "latest", "order_by": ["investment_amount"]} if config.on_duplicate == "latest" else {}
        _, deals_written = upsert_table(warehouse, "fact_deal_shark", deals, at, pool, **latest)
        for each in (pitches_written, deals_written):
            each.result()
    _together(*renewals(warehouse, star_of(warehouse), resolved.select("season_id", "episode_id")))
    return True


def _refuse_duplicates(stage: DataFrame) -> None:
    """A business twice in an episode fails the load before a table is written."""
    appearance = ["startup_name", "season_number", "episode_number"]
    twice = duplicate_keys(stage, appearance, ["startup_name"]).first()
    if twice:
        raise ValueError(f"more than one source row for key {twice.asDict()}")


def _together(*steps: Callable[[], None]) -> None:
    """Run steps side by side, in the same scratch folder."""
    with ThreadPoolExecutor() as pool:
        running = [pool.submit(copy_context().run, each) for each in steps]
    for each in running:
        each.result()


class BatchesFailed(RuntimeError):
    """Some batches could not be loaded; all others were."""


def load_warehouse(warehouse: Warehouse, config: LoadConfig = LoadConfig(), batch: str | None = None) -> list[str]:
    """Load one staged batch, or all pending ones in the order of their stamps; returns the batches loaded.

    Does nothing while nothing is staged or the calendar is empty. Dimensions
    come before facts, seasons before episodes, pitches before deals, and the
    aggregates by episode last. A row that the table has from a batch with a
    later stamp stays as it is, so batches may come in any order. Staged rows
    are released only when all tables are written; until then, and after a
    crash, loading the same batch again gives the same tables. A batch that
    fails is set aside with its error, so that it doesn't hold up the later
    ones, and reported at the end; naming it loads it again. While another load
    is at work, ``LoadConflict`` is raised and everything stays staged.
    """
    pending = [batch] if batch else pending_batches(warehouse)
    if not pending or warehouse.table("dim_date").isEmpty():
        return []
    loaded, failed = [], {}
    with warehouse.exclusive():
        for each in pending:
            try:
                with scratch_scope(warehouse.spark):
                    if _load_batch(warehouse, each, config):
                        loaded.append(each)
            except Exception as error:  # whatever is wrong with a batch, the others are not to blame
                _set_aside(warehouse, each, f"{type(error).__name__}: {error}")
                failed[each] = error
                continue
            _release(warehouse, each)
    if failed:
        raise BatchesFailed("; ".join(f"{b}: {e}" for b, e in failed.items())) from next(iter(failed.values()))
    return loaded


def open_warehouse(spark: SparkSession, root: str, prefix: str = "", **options) -> Warehouse:
    """The warehouse in a folder, made if there is none, with its views."""
    warehouse = Warehouse(spark, root, prefix, **options).create()
    create_views(warehouse)
    return warehouse
