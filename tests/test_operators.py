import random
from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmill.operators import checks
from starmill.operators.calendar import calendar, extend_calendar
from starmill.operators.keys import assign_keys
from starmill.operators.lookup import hot_keys, lookup, lookup_key, salted_join
from starmill.operators.reshape import allocate_evenly, latest_per_key, ordinal_within, split_entities, unpivot_measures
from starmill.operators.upsert import upsert_type1
from starmill.session import scratch_root, scratch_scope, written

OLD, NEW = datetime(2020, 1, 1), datetime(2021, 1, 1)


def test_calendar(spark, rows):
    days = calendar(spark, 2024)
    assert days.count() == 366
    last = days.orderBy(F.desc("date")).first()
    assert tuple(last) == (20241231, date(2024, 12, 31), 366, "Tuesday", 3, "December", 12, 2024)
    assert calendar(spark, 2000, 2030).count() == 11323
    with pytest.raises(ValueError):
        calendar(spark, 2001, 2000)


def test_extend_calendar(spark):
    days = calendar(spark, 2001).filter("month_num <> 2")
    more = extend_calendar(days, 2000, 2001)
    assert more.count() == 731 and more.select("date_id").distinct().count() == 731
    assert extend_calendar(more, 2000).count() == 731


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame(
        [("a", None, 9, "none"), ("a", date(2020, 1, 1), 1, "old"), ("b", date(2020, 1, 1), 1, "low"),
         ("b", date(2020, 1, 1), 2, "high"), (None, None, 1, "x")],
        "k string, d date, n int, v string",
    )
    assert rows(latest_per_key(df, ["k"], ["d", "n"]), "k", "v") == [("a", "old"), ("b", "high"), (None, "x")]


def test_ordinal_with_a_hot_parent(spark):
    random.seed(1)
    data = [(None if i % 50 == 0 else "hot" if i % 3 == 0 else f"p{i % 40}", random.randrange(500), i) for i in range(6000)]
    df = spark.createDataFrame(data, "parent string, position int, id int").repartition(5)
    got = ordinal_within(df, ["parent"], ["position", "id"], "n")
    assert got.columns == ["parent", "position", "id", "n"]
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("parent").orderBy("position", "id")))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_ordinals_deal_the_rows_out_once(spark, capsys):
    """They were dealt out again for a window, though they lie in order."""
    df = spark.range(1000).selectExpr("id", "id % 3 AS parent", "concat('text ', id) AS text")
    numbered = ordinal_within(df, ["parent"], ["id"], "position")
    numbered.explain("formatted")
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
    assert all(r.position == r.id // 3 + 1 for r in numbered.collect())


def test_unpivot(spark, rows):
    df = spark.createDataFrame([(1, 10.0, 1.0, None, 2.0), (2, None, None, 20.0, None)], "id int, a double, b double, c double, d double")
    cells = {"x": {"amount": "a", "share": "b"}, "y": {"amount": "c", "share": "d"}}
    assert rows(unpivot_measures(df, ["id"], cells, "who", "amount")) == [(1, "x", 10.0, 1.0), (2, "y", 20.0, None)]


@pytest.mark.parametrize(
    "text, names, drop_empty",
    [("A, and B", ["A", "B"], False), ("A, AND B", ["A", "B"], False), ("Chip and Joanna", ["Chip and Joanna"], False),
     ("A,B , C", ["A", "B", "C"], False), ("A,", ["", "A"], False), ("A,", ["A"], True), (None, [], False)],
)
def test_split_and_allocate(spark, text, names, drop_empty):
    df = spark.createDataFrame([(text, 100.0)], "names string, amount double")
    split = split_entities(df, "names", "name", "n", drop_empty=drop_empty)
    got = allocate_evenly(split, ["amount"], "n").collect()
    assert sorted(r.name for r in got) == names
    assert all(r.n == len(names) and r.amount == 100.0 / len(names) for r in got)


def test_split_handles_many_names(spark):
    text = ", ".join(f"Name {i}" for i in range(12))
    df = spark.createDataFrame([(text,)], "names string")
    assert sorted(r.n for r in split_entities(df, "names", "n").collect()) == sorted(f"Name {i}" for i in range(12))


def skewed(spark):
    data = [(1 if i % 3 else i, i) for i in range(3000)] + [(None, -i) for i in range(1, 400)]
    fact = spark.createDataFrame(data, "k int, id int")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(0, 3000, 2)] + [(1, "one")], "k bigint, name string")
    return fact, dim


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_gives_the_same_rows_with_and_without_broadcast(spark, rows, how):
    fact, dim = skewed(spark)
    plain = rows(fact.join(dim, "k", how))
    assert rows(lookup(fact, dim, ["k"], how)) == plain
    assert rows(lookup(fact, dim, ["k"], how, broadcast_bytes=0)) == plain


def test_hot_keys_are_found_and_spread(spark):
    fact, dim = skewed(spark)
    hot = hot_keys(fact, ["k"], 0.1)
    ones = fact.filter("k = 1").select(F.xxhash64("k")).first()[0]
    assert ones in hot and len(hot) <= 10
    # both sides far from broadcast size as the planner sees it: the join has the salt among its keys
    plan = salted_join(fact, dim.withColumn("k", F.col("k").cast("int")), ["k"]).explain
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        plan()
    assert "_salt" in text.getvalue()


def test_lookup_key_unknown(spark, rows):
    fact = spark.createDataFrame([("a",), ("z",), (None,)], "name string")
    dim = spark.createDataFrame([("a", 7)], "name string, id bigint")
    assert rows(lookup_key(fact, dim, ["name"], "id")) == [("a", 7), ("z", 0), (None, 0)]
    assert rows(lookup_key(fact, dim, ["name"], "id", unknown=None)) == [("a", 7), ("z", None), (None, None)]


@pytest.mark.parametrize("size", [0, 1, 5000])
def test_keys_are_dense_and_ordered(spark, size):
    names = [(f"name {i * 7919 % 100003:06d}", i) for i in range(size)]
    df = spark.createDataFrame(names, "name string, v int").repartition(7)
    got = assign_keys(df, ["name"], "id", start_after=10).collect()
    assert [r.id for r in sorted(got, key=lambda r: r.name)] == list(range(11, 11 + size))


def target(spark):
    data = [(1, "Acme", "x", OLD), (2, "Beta", "y", OLD), (3, "Gone", "z", OLD)]
    return spark.createDataFrame(data, "id bigint, name string, attribute string, import_date timestamp")


def upsert(spark, source, **options):
    df = spark.createDataFrame(source, "name string, attribute string, seen int")
    stamp = F.lit(NEW).cast("timestamp")
    return upsert_type1(target(spark), df, ["name"], "id", stamp, fold=["name"], **options)


def test_upsert(spark, rows):
    result = upsert(spark, [("ACME ", None, 1), ("Beta", "new", 2), ("delta", "d", 3), ("Ceta", "c", 4)])
    assert rows(result.table()) == [
        (1, "ACME ", None, NEW),
        (2, "Beta", "new", NEW),
        (3, "Gone", "z", OLD),
        (4, "Ceta", "c", NEW),
        (5, "delta", "d", NEW),
    ]
    assert rows(result.changed, "id", "seen") == [(1, 1), (2, 2), (4, 4), (5, 3)]


def test_upsert_keeps_the_first_spelling(spark, rows):
    result = upsert(spark, [("ACME ", None, 1)], keep_on_match=["name"])
    assert rows(result.table(), "name") == [("Acme",), ("Beta",), ("Gone",)]


def test_upsert_of_a_small_source(spark, rows):
    result = upsert(spark, [("beta", "b", 1), ("new", "n", 2)])
    assert rows(result.table(), "id", "attribute") == [(1, "x"), (2, "b"), (3, "z"), (4, "n")]


def test_a_source_too_large_to_broadcast_is_dealt_out_once(spark, rows, monkeypatch):
    """Its keys were also dealt out on their own, to thin out the target's."""
    import starmill.operators.upsert as module

    plans = {}

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, label)

    monkeypatch.setattr(module, "written", seen)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = upsert(spark, [("beta", "b", 1), ("new", "n", 2)])
        assert rows(result.table(), "id", "attribute") == [(1, "x"), (2, "b"), (3, "z"), (4, "n")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plans["matched"].count("Exchange") == 2


def test_a_source_as_large_as_the_table_is_merged_in_one_shuffle(spark, rows, monkeypatch):
    """The table's rows went through an anti-join, and new rows were dealt out once more for their keys and once for their folders."""
    import starmill.operators.upsert as module

    plans = {}

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, label)

    stamps = {0: OLD, 1: datetime(2022, 1, 1), 2: None}
    held = [(i + 1, f"Name {i}", f"a{i}", stamps[i % 2], stamps[i // 2 % 3], i % 3) for i in range(60)]
    given = [(f"NAME {i} ", f"b{i}", i, i % 3) for i in range(40, 110)]
    table = spark.createDataFrame(held, "id bigint, name string, attribute string, import_date timestamp, first_date timestamp, place int").repartition(5)
    source = spark.createDataFrame(given, "name string, attribute string, seen int, place int").repartition(4)
    options = {"fold": ["name"], "keep_on_match": ["name"], "first_col": "first_date"}
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        plain = upsert_type1(table, source, ["name"], "id", F.lit(NEW).cast("timestamp"), **options)
        monkeypatch.setattr(module, "written", seen)
        merged = upsert_type1(table, source, ["name"], "id", F.lit(NEW).cast("timestamp"), stored_by=["place"], **options)
        assert list(plans) == ["matched"] and plans["matched"].count("Exchange rangepartitioning") == 1 and "Join" not in plans["matched"]
        new = lambda df: rows(df.withColumn("id", F.when(F.col("id") <= 60, F.col("id"))))
        for part in ("found", "changed", "kept"):
            assert new(getattr(merged, part)) == new(getattr(plain, part)), part
        assert new(merged.table(["place"])) == new(plain.table(["place"]))
        assert sorted(r.id for r in merged.table().collect()) == list(range(1, 111)) and merged.last_key == plain.last_key == 110
        numbered = merged.table().filter("id > 60").select("place", F.lower(F.rtrim("name")), "id")
        assert sorted(numbered.collect()) == sorted(numbered.collect(), key=lambda r: r.id)  # by folder, then by key
        with pytest.raises(Exception, match="more than one source row"):
            upsert_type1(table, source.union(source.limit(1)), ["name"], "id", F.lit(NEW).cast("timestamp"), stored_by=["place"], **options)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_upsert_duplicates(spark, rows):
    twice = [("new", "first", 1), ("NEW", "second", 2)]
    with pytest.raises(Exception, match="more than one source row"):
        upsert(spark, twice).table().collect()
    latest = upsert(spark, twice, on_duplicate="latest", order_by=["seen"])
    assert rows(latest.changed, "attribute") == [("second",)]


def test_upsert_into_an_empty_table(spark, rows):
    empty = target(spark).limit(0)
    source = spark.createDataFrame([("b", "1"), ("a", "2")], "name string, attribute string")
    result = upsert_type1(empty, source, ["name"], "id", F.lit(NEW).cast("timestamp"))
    assert rows(result.table(), "id", "name") == [(1, "a"), (2, "b")]


def test_checks(spark, rows):
    df = spark.createDataFrame([("a", 1), ("A ", 2), ("b", None)], "name string, k bigint")
    assert rows(checks.duplicate_keys(df, ["name"], fold=["name"])) == [("a", 2)]
    dim = spark.createDataFrame([(1,)], "k bigint")
    assert rows(checks.orphans(df.na.drop(), dim, "k")) == [(2, 1)]
    report = checks.rule_report(df, ["k"], {"name": 1})
    assert rows(report) == [("k is required", 1), ("name has at most 1 characters", 1)]


def test_scratch_scope_removes_its_tables(spark):
    from starmill.sources.files import path_exists

    with scratch_scope(spark) as folder:
        assert written(spark.range(3), "three").count() == 3
        assert path_exists(spark, folder)
    assert not path_exists(spark, folder)


class FakeSession:
    """As much of a session as ``scratch_root`` looks at."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder or default)})


def test_scratch_root():
    assert scratch_root(FakeSession("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert scratch_root(FakeSession("local[2]", None)) == scratch_root(FakeSession("local[2]", None))
    with pytest.raises(RuntimeError):
        scratch_root(FakeSession("yarn", None))
