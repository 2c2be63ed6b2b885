"""The load from feed files to marts, on small hand-made feeds."""

import os
from datetime import datetime
from itertools import count
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starmill.plans import load, marts, rollup
from starmill.plans.integrity import integrity_report
from starmill.plans.model import TABLES, LoadConfig
from starmill.sources import files
from starmill.sources.feed import read_text, typed_rows
from starmill.sources.store import LoadConflict
from starmill.streaming.ingest import poll_warehouse

CONFIG = LoadConfig(main_sharks=("Ann O'Day", "Bob Ray"))
FIRST, SECOND, THIRD = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


def line(**values):
    """A feed line; the names of the values are column names."""
    fixed = {
        "season_number": "1",
        "episode_number": "1",
        "season_start": "2009-08-09",
        "season_end": "2010-02-05",
        "original_air_date": "2009-08-09",
        "got_deal": "0",
        "us_viewership": "4.15",
    }
    known = {**fixed, **values}
    assert set(known) <= set(CONFIG.feed.names)
    cells = [str(known.get(n, "")) for n in CONFIG.feed.names]
    return ",".join(f'"{c}"' if "," in c else c for c in cells)


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    header = ",".join(f.header for f in CONFIG.feed.fields)
    path = folder / name
    path.write_bytes("\r\n".join([header, *lines, ""]).encode("cp1252"))
    return str(path)


DEAL = {"got_deal": "1", "total_deal_amount": "300", "total_deal_equity": "30"}
PITCHES = [
    line(startup_name="Acme", pitch_number=2, industry="Tools", guest_name="Cy, and Dee", guest_investment_amount=100,
         guest_investment_equity=10, ann_o_day_investment_amount=200, ann_o_day_investment_equity=20, royalty_deal="yes", **DEAL),
    line(startup_name="Beta", pitch_number=1, industry="Food", original_ask_amount=50),
    line(startup_name="ACME", pitch_number=5, season_number=2, industry="Toys", original_air_date="2010-09-01",
         season_start="2010-09-01", season_end="2011-05-01", us_viewership="", guest_name="Bob Ray, Chip and Jo",
         bob_ray_present="1", bob_ray_investment_amount="", guest_investment_amount=300, guest_investment_equity="", **DEAL),
    line(startup_name=" ", pitch_number=6),
    line(startup_name="Gamma", pitch_number="x"),
    line(startup_name="Late", pitch_number=9, season_number=3, episode_number=4, original_air_date="2045-01-01",
         season_start="2045-01-01", season_end="2045-02-01", guest_investment_amount=5, **{"got_deal": "1"}),
]


_numbers = count()


def opened(spark, folder, **options):
    """An empty warehouse with databases of its own."""
    warehouse = load.open_warehouse(spark, str(folder / "warehouse"), f"t{next(_numbers)}_", **options)
    load.populate_calendar(warehouse, 2009, 2011)
    return warehouse


@pytest.fixture
def warehouse(spark, tmp_path):
    return opened(spark, tmp_path)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A loaded warehouse that tests only read."""
    folder = tmp_path_factory.mktemp("loaded")
    warehouse = opened(spark, folder)
    load.ingest_file(warehouse, drop(folder, "feed.csv", *PITCHES), None, FIRST, CONFIG)
    load.load_warehouse(warehouse, CONFIG)
    return warehouse


def everything(warehouse):
    return {n: sorted(map(repr, warehouse.table(n).collect())) for n in TABLES}


def test_nothing_happens_without_a_file_or_a_calendar(spark, tmp_path):
    empty = load.open_warehouse(spark, str(tmp_path / "empty"), "empty_")
    assert load.ingest_file(empty, str(tmp_path / "none.csv"), None, FIRST, CONFIG) is None
    assert load.load_warehouse(empty, CONFIG) == []
    load.ingest_file(empty, drop(tmp_path / "drop", "feed.csv", *PITCHES), None, FIRST, CONFIG)
    assert load.load_warehouse(empty, CONFIG) == []
    assert load.pending_batches(empty) != [] and empty.table("dim_shark").count() == 0


def test_ingest_archives_and_quarantines(warehouse, tmp_path, rows):
    path = drop(tmp_path / "drop", "feed.csv", *PITCHES)
    batch = load.ingest_file(warehouse, path, str(tmp_path / "archive"), FIRST, CONFIG)
    assert files.list_names(warehouse.spark, str(tmp_path / "archive")) == ["feed_20240101_000000.csv"]
    assert not files.path_exists(warehouse.spark, path)
    assert load.staged(warehouse, batch, CONFIG).count() == 4
    bad = load.quarantined(warehouse)
    assert rows(bad, "reject_reason", "reject_column") == [("missing", "startup_name"), ("unreadable", "pitch_number")]
    assert bad.filter("raw_line LIKE '%Gamma%'").count() == 1


def test_dimensions(loaded, rows):
    assert rows(loaded.table("dim_shark"), "shark_name", "is_main_shark") == [
        ("Ann O'Day", True), ("Bob Ray", True), ("Chip and Jo", False), ("Cy", False), ("Dee", False)]
    # one business for both spellings, with the attributes of the latest appearance
    assert rows(loaded.table("dim_business"), "industry") == [("Food",), ("Toys",), (None,)]
    assert rows(loaded.table("dim_season"), "season_number", "season_label", "season_abbrev", "season_start_date_id") == [
        (1, "Season 1", "S1", 20090809), (2, "Season 2", "S2", 20100901), (3, "Season 3", "S3", None)]
    episodes = loaded.table("dim_episode")
    assert rows(episodes, "episode_in_season_num", "air_date_id", "us_viewership") == [
        (1, 20090809, 4.15), (1, 20100901, None), (4, None, 4.15)]
    assert load.pending_batches(loaded) == []


def test_facts(loaded, rows):
    pitches = loaded.table("fact_pitch").join(loaded.table("dim_business").drop("import_date"), "business_id")
    columns = ["pitch_order_in_episode", "is_deal", "is_royalty_deal", "loan", "advisory_shares", "deal_has_conditions", "deal_equity_pct"]
    assert rows(pitches.filter("season_id = 1") if "season_id" in pitches.columns else pitches, *columns) == sorted(
        [(2, True, True, 0.0, 0.0, False, 0.3), (1, False, None, None, None, None, None),
         (1, True, False, 0.0, 0.0, False, 0.3), (1, True, False, 0.0, 0.0, False, None)], key=repr)
    deals = loaded.table("fact_deal_shark").join(loaded.table("dim_shark"), "shark_id")
    assert rows(deals, "shark_name", "investment_amount", "investment_equity_pct") == [
        ("Ann O'Day", 200.0, 0.2), ("Bob Ray", 150.0, None), ("Chip and Jo", 150.0, None), ("Cy", 50.0, 0.05), ("Dee", 50.0, 0.05)]


def test_integrity_report(loaded):
    report = integrity_report(loaded).collect()
    assert len(report) == 54 and len({(r.table, r.rule) for r in report}) == 54
    assert [r for r in report if r.broken] == []


def test_later_batches(warehouse, tmp_path, rows):
    def ingest(name, at, *lines):
        load.ingest_file(warehouse, drop(tmp_path / "drop", name, *lines), None, at, CONFIG)
        load.load_warehouse(warehouse, CONFIG)

    ingest("first.csv", FIRST, *PITCHES)
    before = everything(warehouse)
    ids = {r.business_name: r.business_id for r in warehouse.table("dim_business").collect()}

    # the same batch again changes nothing
    ingest("first.csv", FIRST, *PITCHES)
    assert everything(warehouse) == before

    # the next batch overwrites, adds and keeps
    old_files = {n: held(warehouse, n) for n in TABLES}
    changed = line(startup_name="beta", pitch_number=1, original_ask_amount="", guest_name="cy", guest_investment_amount=7, **DEAL)
    ingest("second.csv", SECOND, changed, line(startup_name="New", pitch_number=3))
    business = {r.business_name: r for r in warehouse.table("dim_business").collect()}
    assert business["Beta"].business_id == ids["Beta"] and business["Beta"].industry is None
    assert business["Beta"].import_date == SECOND and business["Late"].import_date == FIRST
    assert business["New"].business_id == max(ids.values()) + 1
    # the guest is a known one under another spelling
    assert warehouse.table("dim_shark").count() == 5
    assert warehouse.table("fact_deal_shark").count() == 6 and warehouse.table("fact_pitch").count() == 5
    # only the season of the batch was written again
    new_files = held(warehouse, "fact_pitch")
    assert {p.split("/")[0] for p in new_files ^ old_files["fact_pitch"]} == {"season_id=1"}


def held(warehouse, table):
    """Data files of a table, by their place in its folder."""
    folder = Path(warehouse.path(table))
    return {str(f.relative_to(folder)) for f in folder.rglob("*.parquet")}


def test_one_row_rewrites_one_bucket_of_each_table(warehouse, tmp_path):
    many = [line(startup_name=f"Business {n}", pitch_number=n, guest_name=f"Guest {n}", guest_investment_amount=n, **DEAL) for n in range(1, 60)]
    load.ingest_file(warehouse, drop(tmp_path / "drop", "many.csv", *many), None, FIRST, CONFIG)
    load.load_warehouse(warehouse, CONFIG)
    tables = ("dim_business", "fact_pitch", "fact_deal_shark")
    before = {n: held(warehouse, n) for n in tables}
    assert all(len({f.rsplit("/", 1)[0] for f in before[n]}) == warehouse.buckets for n in tables)
    load.ingest_file(warehouse, drop(tmp_path / "drop", "one.csv", many[6]), None, SECOND, CONFIG)
    load.load_warehouse(warehouse, CONFIG)
    for n in tables:
        after = held(warehouse, n)
        assert len({f.rsplit("/", 1)[0] for f in after ^ before[n]}) == 1, n
        assert warehouse.table(n).count() == 59
        assert warehouse.table(n).filter(F.col("import_date") == F.lit(SECOND)).count() == 1


def test_batches_in_any_order_give_the_same_tables(spark, tmp_path):
    """Overlapping batches, repeats included; compared by natural keys, since surrogate keys are given out as rows come."""
    def rows_of(n, *names):
        return [line(startup_name=name, pitch_number=i, industry=f"industry of {n}", us_viewership=n, original_ask_amount=n,
                     guest_name=f"Guest {name.lower()}", guest_investment_amount=100 * n, **DEAL) for i, name in enumerate(names, 1)]

    batches = {1: rows_of(1, "ACME", "Beta"), 2: rows_of(2, "acme", "Gamma"), 3: rows_of(3, "Acme", "Beta", "Delta")}
    stamps = {1: FIRST, 2: SECOND, 3: THIRD}

    def state(order, n):
        warehouse = opened(spark, tmp_path / str(n))
        for k in order:
            text = read_text(spark, drop(tmp_path / "drop", f"{k}.csv", *batches[k]), CONFIG.feed)
            load.stage_rows(warehouse, typed_rows(text, CONFIG.feed), stamps[k], f"batch_{k}")
            load.load_warehouse(warehouse, CONFIG)
        business = warehouse.table("dim_business").select("business_id", "business_name")
        sharks = warehouse.table("dim_shark").select("shark_id", "shark_name")
        facts = warehouse.table("fact_pitch").join(business, "business_id")
        deals = warehouse.table("fact_deal_shark").join(facts.select("pitch_id", "business_name"), "pitch_id").join(sharks, "shark_id")
        without = lambda df: sorted(map(repr, df.drop("business_id", "episode_id", "season_id", "pitch_id", "shark_id", "deal_shark_id").collect()))
        return {n: without(warehouse.table(n)) for n in ("dim_business", "dim_shark", "dim_season", "dim_episode")} | {"pitch": without(facts), "deal": without(deals)}

    orders = [(1, 2, 3), (3, 2, 1), (2, 3, 1, 2)]
    first, *others = [state(order, n) for n, order in enumerate(orders)]
    assert all(other == first for other in others)
    # the name is that of the first batch, the rest that of the last
    assert [r for r in first["dim_business"] if "'ACME'" in r and "industry of 3" in r]
    assert len(first["pitch"]) == 4 and len(first["deal"]) == 4


def test_large_batches_give_the_same_tables_in_few_files(spark, tmp_path, monkeypatch):
    """Batches too large to broadcast: rows that stay came out of an anti-join in as many files of a folder as there were tasks."""
    def rows_of(n, numbers):
        return [line(startup_name=f"Firm {i}", pitch_number=i, episode_number=i % 7, industry=f"of {n}", season_number=1 + i % 2,
                     guest_name=f"Guest {i % 5}", guest_investment_amount=i + n, **DEAL) for i in numbers]

    batches = {1: rows_of(1, range(60)), 2: rows_of(2, range(30, 90)), 3: rows_of(3, range(0, 90, 3))}

    def state(folder):
        warehouse = opened(spark, folder, buckets=2)
        for k, at in ((3, THIRD), (1, FIRST), (2, SECOND)):
            text = read_text(spark, drop(folder / "drop", f"{k}.csv", *batches[k]), CONFIG.feed)
            load.stage_rows(warehouse, typed_rows(text, CONFIG.feed), at, f"batch_{k}")
            load.load_warehouse(warehouse, CONFIG)
        facts = warehouse.table("fact_pitch").join(warehouse.table("dim_business").select("business_id", "business_name"), "business_id")
        deals = warehouse.table("fact_deal_shark").drop("import_date").join(facts, "pitch_id").join(warehouse.table("dim_shark").select("shark_id", "shark_name"), "shark_id")
        ids = [warehouse.table(t).select(k).orderBy(k).collect() for t, k in (("fact_pitch", "pitch_id"), ("fact_deal_shark", "deal_shark_id"), ("dim_business", "business_id"))]
        assert all(len(each) == len(set(each)) for each in ids)
        keys = ["business_id", "episode_id", "season_id", "pitch_id", "shark_id", "deal_shark_id"]
        plain = {n: sorted(map(repr, df.drop(*keys).collect())) for n, df in (("pitch", facts), ("deal", deals), ("business", warehouse.table("dim_business")))}
        return plain, max(len(list(f.glob("*.parquet"))) for f in Path(warehouse.path("fact_pitch")).glob("season_id=*/bucket=*"))

    small, _ = state(tmp_path / "small")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        large, files_of_a_folder = state(tmp_path / "large")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert large == small
    assert files_of_a_folder <= 4, files_of_a_folder


def test_a_repeated_micro_batch_keeps_its_stamp(warehouse, tmp_path):
    text = read_text(warehouse.spark, drop(tmp_path / "drop", "a.csv", line(startup_name="Acme", pitch_number=1)), CONFIG.feed)
    for at in (FIRST, SECOND):
        load.stage_rows(warehouse, typed_rows(text, CONFIG.feed), at, "stream_1")
        load.load_warehouse(warehouse, CONFIG)
    assert [r.import_date for r in warehouse.table("dim_business").collect()] == [FIRST]
    with pytest.raises(ValueError, match="name"):
        load.stage_rows(warehouse, typed_rows(text, CONFIG.feed), FIRST, "a/b")


def test_another_session_sees_a_load_without_a_call(warehouse, spark, tmp_path):
    other = spark.newSession()
    count_of = lambda table: other.sql(f"SELECT count(*) FROM {warehouse.prefix}{table}").first()[0]
    assert count_of("dwh.fact_pitch") == 0 and count_of("analytics.vw_episode_summary") == 0
    for n, at in enumerate((FIRST, SECOND), 1):
        path = drop(tmp_path / "drop", f"{n}.csv", line(startup_name=f"B{n}", pitch_number=n, season_number=n))
        load.ingest_file(warehouse, path, None, at, CONFIG)
        assert count_of("stage.pitch_raw_data") == 1
        load.load_warehouse(warehouse, CONFIG)
        assert count_of("stage.pitch_raw_data") == 0
        assert count_of("dwh.fact_pitch") == count_of("analytics.vw_episode_summary") == n
        assert other.sql(f"SELECT total_pitches FROM {warehouse.prefix}analytics.vw_alltime_summary").first()[0] == n


def test_a_warehouse_is_found_again_in_its_folder(warehouse, spark, tmp_path, rows):
    load.ingest_file(warehouse, drop(tmp_path / "drop", "feed.csv", *PITCHES), None, FIRST, CONFIG)
    load.load_warehouse(warehouse, CONFIG)
    # as another application would: other names in the catalog, the same folder
    again = load.open_warehouse(spark, warehouse.root, "again_" + warehouse.prefix, buckets=3)
    assert again.buckets == warehouse.buckets and everything(again) == everything(warehouse)
    load.ingest_file(again, drop(tmp_path / "drop", "new.csv", line(startup_name="New", pitch_number=3)), None, SECOND, CONFIG)
    load.load_warehouse(again, CONFIG)
    assert again.table("dim_business").agg(F.max("business_id")).first()[0] == warehouse.max_key("dim_business", "business_id") + 1
    with pytest.raises(ValueError, match="another warehouse"):
        load.open_warehouse(spark, str(tmp_path / "elsewhere"), warehouse.prefix)


def test_a_load_renews_the_episodes_it_touches_and_reads_their_seasons(loaded, capsys):
    star = marts.star_of(loaded)
    (touched,) = star.pitches.filter("is_royalty_deal").select("season_id", "episode_id").collect()
    steps = rollup.renewals(loaded, star, loaded.spark.createDataFrame([touched], "season_id bigint, episode_id bigint"))
    before = {n: held(loaded, n) for n in ("episode_measures", "episode_sharks")}
    state = lambda: {n: sorted(map(repr, loaded.stored(n).collect())) for n in before}
    rows_before = state()
    steps[0].args[1].explain("formatted")
    plan = capsys.readouterr().out
    pieces = [piece.strip() for piece in plan.split("\n\n")]
    scans = [s for s in pieces if s.startswith("(") and "Scan parquet" in s.split("\n")[0] and "fact_" in s.split("\n")[0]]
    assert len(scans) >= 2 and all("PartitionFilters: [" in s and "season_id" in s.split("PartitionFilters: [")[1][:200] for s in scans)
    for step in steps:
        step()
    assert state() == rows_before
    for n, files_before in before.items():
        assert {f.split("/")[0] for f in held(loaded, n) ^ files_before} == {f"season_id={touched.season_id}"}


def test_views_agree_with_the_marts_over_the_facts(loaded, spark, rows):
    star = marts.star_of(loaded)
    builds = {"alltime": marts.mart_alltime, "season": marts.mart_season, "episode": marts.mart_episode, "shark_alltime": marts.mart_shark}
    for name, build in builds.items():
        view = spark.table(f"{loaded.prefix}analytics.vw_{name}_summary")
        assert view.columns == build(star).columns and rows(view) == rows(build(star)), name
    levels = spark.table(f"{loaded.prefix}analytics.vw_all_levels")
    assert rows(levels.groupBy("mart_level").count()) == [(0, 3), (1, 3), (3, 1)]
    plan = levels._jdf.queryExecution().executedPlan().toString()
    assert "fact_pitch" not in plan and "fact_deal_shark" not in plan


def test_a_business_twice_in_an_episode(warehouse, tmp_path, rows):
    twice = [line(startup_name="Acme", pitch_number=n, original_ask_amount=n) for n in (1, 2)]
    path = drop(tmp_path / "drop", "feed.csv", *twice)
    load.ingest_file(warehouse, path, None, FIRST, CONFIG)
    with pytest.raises(Exception, match="more than one source row"):
        load.load_warehouse(warehouse, CONFIG)
    # a refused batch shows nothing and keeps its staging, set aside
    assert warehouse.table("dim_business").count() == 0 and load.pending_batches(warehouse) == []
    (batch, error), = load.failed_batches(warehouse).items()
    assert "more than one source row" in error
    latest = LoadConfig(main_sharks=CONFIG.main_sharks, on_duplicate="latest")
    load.load_warehouse(warehouse, latest, batch)
    assert rows(warehouse.table("fact_pitch"), "ask_amount", "pitch_order_in_episode") == [(2.0, 1)]


def test_marts(loaded, rows):
    star = marts.star_of(loaded)
    whole = marts.mart_alltime(star, extra=True).first().asDict()
    assert (whole["total_seasons"], whole["total_episodes"], whole["total_pitches"], whole["total_deals"]) == (3, 3, 4, 3)
    # the pitch with three investors counts three times, as in the original views, and once per pitch
    assert whole["total_investment"] == 300.0 * 3 + 300.0 * 2 and whole["total_investment_per_pitch"] == 600.0
    assert whole["has_royalties"] == 3 and whole["has_royalties_per_pitch"] == 1
    assert whole["sharks_in_deals"] == 5 and whole["deal_rate"] == 0.75
    assert whole["main_shark_deal_share"] == 2 / 3 and whole["guest_shark_deal_share"] == 2 / 3
    assert whole["avg_us_viewership"] == 4.15
    seasons = {r.season_number: r for r in marts.mart_season(star).collect()}
    assert seasons[3].season_start_date is None and seasons[2].avg_us_viewership is None
    assert seasons[3].sharks_in_deals == 0 and seasons[3].main_shark_deal_share == 0.0
    episodes = marts.mart_episode(star)
    assert rows(episodes, "episode_label") == [("Season 1, Episode 1",), ("Season 2, Episode 1",), ("Season 3, Episode 4",)]
    by_shark = {r.shark_name: r for r in marts.mart_shark(star).collect()}
    assert by_shark["Cy"].total_investment_amount == 50.0 and by_shark["Bob Ray"].avg_equity_pct_per_deal is None
    grain = marts.grain_mart(star, ["industry"])
    assert rows(grain, "industry", "total_pitches") == [("Food", 1), ("Toys", 2), (None, 1)]
    with pytest.raises(ValueError):
        marts.grain_mart(star, ["colour"])


def test_additive_columns_agree_at_every_grain(loaded):
    star = marts.star_of(loaded)
    for column in ("total_pitches", "total_deals", "total_investment", "has_royalties", "has_conditions"):
        sums = {m(star).agg(F.sum(column)).first()[0] for m in (marts.mart_alltime, marts.mart_season, marts.mart_episode)}
        assert len(sums) == 1


def test_marts_of_an_empty_warehouse(warehouse):
    star = marts.star_of(warehouse)
    row = marts.mart_alltime(star).first()
    assert row.total_pitches == 0 and row.deal_rate is None and row.total_investment is None
    assert marts.mart_season(star).count() == 0 and marts.mart_shark(star).count() == 0


def test_drop_folder(warehouse, tmp_path, rows):
    folder, archive = tmp_path / "incoming", tmp_path / "done"
    drop(folder, "a.csv", PITCHES[0], PITCHES[1])
    times = iter([FIRST, SECOND, THIRD])

    def poll():
        query = poll_warehouse(
            warehouse, str(folder), str(tmp_path / "progress"), CONFIG, str(archive), clock=lambda: next(times), max_files=1
        )
        assert query.awaitTermination(120)

    poll()
    assert warehouse.table("fact_pitch").count() == 2
    before = held(warehouse, "fact_pitch")
    poll()
    assert held(warehouse, "fact_pitch") == before
    drop(folder, "b.csv", PITCHES[2], PITCHES[4])
    poll()
    assert warehouse.table("fact_pitch").count() == 3 and load.pending_batches(warehouse) == []
    assert load.quarantined(warehouse).count() == 1


def test_two_files_with_one_stamp(warehouse, tmp_path, rows):
    for name in ("a", "b"):
        path = drop(tmp_path / "drop", f"{name}.csv", line(startup_name=f"Business {name}", pitch_number=1))
        load.ingest_file(warehouse, path, str(tmp_path / "archive"), FIRST, CONFIG)
    assert len(load.pending_batches(warehouse)) == 2
    load.load_warehouse(warehouse, CONFIG)
    assert rows(warehouse.table("dim_business"), "business_name") == [("Business a",), ("Business b",)]


def test_one_load_at_a_time(warehouse, tmp_path, rows):
    batch = load.ingest_file(warehouse, drop(tmp_path / "drop", "a.csv", line(startup_name="A", pitch_number=1)), None, FIRST, CONFIG)
    with warehouse.exclusive(), pytest.raises(LoadConflict):
        load.load_warehouse(warehouse, CONFIG)
    assert load.pending_batches(warehouse) == [batch]
    # a lock that a crash left behind holds for a while only
    lock = Path(warehouse.root) / "load.lock"
    lock.write_text("half a")
    with pytest.raises(LoadConflict):
        load.load_warehouse(warehouse, CONFIG)
    os.utime(lock, (0, 0))
    assert load.load_warehouse(warehouse, CONFIG) == [batch]
    assert rows(warehouse.table("dim_business"), "business_name", "business_id") == [("A", 1)]


def test_an_unfinished_batch_is_not_pending(warehouse, tmp_path):
    files.make_folder(warehouse.spark, f"{warehouse.path('pitch_raw_data')}/batch=b/stamped=s/rejected=false/_temporary/0")
    assert load.pending_batches(warehouse) == [] and load.load_warehouse(warehouse, CONFIG) == []


def test_batches_are_loaded_by_stamp_and_one_bad_batch_is_no_obstacle(warehouse, tmp_path, rows):
    def stage(name, at, batch, *lines):
        path = drop(tmp_path / "drop", name, *lines)
        text = read_text(warehouse.spark, path, CONFIG.feed)
        load.stage_rows(warehouse, typed_rows(text, CONFIG.feed), at, batch)

    # a stream's batch of January, a file's batch of March, and a bad one in between
    stage("old.csv", FIRST, "stream_0001", line(startup_name="Acme", pitch_number=1, industry="old"))
    stage("bad.csv", SECOND, "bad", *[line(startup_name="Twice", pitch_number=n) for n in (1, 2)])
    stage("new.csv", THIRD, "20240301", line(startup_name="Acme", pitch_number=1, industry="new"))
    assert load.pending_batches(warehouse) == ["stream_0001", "bad", "20240301"]
    with pytest.raises(load.BatchesFailed, match="bad"):
        load.load_warehouse(warehouse, CONFIG)
    assert rows(warehouse.table("dim_business"), "business_name", "industry") == [("Acme", "new")]
    assert list(load.failed_batches(warehouse)) == ["bad"]


def test_money_is_not_rounded_before_it_is_added(warehouse, tmp_path):
    third = line(startup_name="Acme", pitch_number=1, guest_name="A, B, C", guest_investment_amount=100, **DEAL)
    large = line(startup_name="Beta", pitch_number=2, guest_name="D", guest_investment_amount=2e14, **{**DEAL, "total_deal_amount": "2e14"})
    load.ingest_file(warehouse, drop(tmp_path / "drop", "m.csv", third, large), None, FIRST, CONFIG)
    load.load_warehouse(warehouse, CONFIG)
    star = marts.star_of(warehouse)
    by_shark = marts.mart_shark(star)
    assert by_shark.filter("shark_name <> 'D'").agg(F.sum("total_investment_amount")).first()[0] == pytest.approx(100, abs=1e-9)
    assert by_shark.filter("shark_name = 'D'").first().total_investment_amount == 2e14
    assert marts.mart_alltime(star, extra=True).first().total_investment_per_pitch == 2e14 + 300


def test_season_ranges_read_no_other_season(loaded, capsys):
    star = marts.in_seasons(marts.star_of(loaded), 2, 2)
    assert [r.season_number for r in marts.mart_season(star).collect()] == [2]
    star.pitches.explain("formatted")
    assert "PartitionFilters: [" in (plan := capsys.readouterr().out) and "season_id" in plan.split("PartitionFilters: [")[1][:80]
