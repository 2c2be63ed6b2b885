from datetime import datetime

import pytest

from starmill.plans.model import MAIN_SHARKS, pitch_feed
from starmill.sources import files
from starmill.sources.feed import FeedSpec, Field, read_feed, spanning_files

SPEC = FeedSpec((Field("Name", "string", 20, required=True), Field("Amount", "double"), Field("Count", "int")))


def feed(tmp_path, *lines, encoding="cp1252", name="feed.csv"):
    path = tmp_path / name
    path.write_bytes("\r\n".join(["Name,Amount,Count", *lines, ""]).encode(encoding))
    return str(path)


def test_layout_has_the_declared_columns():
    spec = pitch_feed()
    assert len(spec.fields) == 53
    headers = [f.header for f in spec.fields]
    assert headers[31:33] == ["Barbara Corcoran Investment Amount", "Barbara Corcoran Investment Equity"]
    assert headers[41:46] == ["Kevin O Leary Investment Amount", "Kevin O Leary Investment Equity", "Guest Investment Amount",
                              "Guest Investment Equity", "Guest Name"]
    assert headers[-2:] == ["Kevin O Leary Present", "Guest Present"]
    kinds = [f.kind for f in spec.fields]
    counts = {k: kinds.count(k) for k in set(kinds)}
    assert counts == {"string": 10, "int": 3, "long": 1, "double": 25, "date": 3, "flag": 9, "yes": 2}
    assert len(MAIN_SHARKS) == 6


def test_good_and_bad_rows(spark, tmp_path, rows):
    path = feed(
        tmp_path,
        ' Acme ,1.5,2',
        '"Quoted, Ltd",,"3.0"',
        '"He said ""hi""",2,',
        'short,1',
        'long,1,2,3',
        'a name of more than twenty letters,1,2',
        'Bad,n/a,2',
        'Half,1,2.5',
        '  ,1,2',
    )
    good, bad = read_feed(spark, path, SPEC)
    assert rows(good) == [("Acme", 1.5, 2), ('He said "hi"', 2.0, None), ("Quoted, Ltd", None, 3)]
    assert rows(bad, "reject_reason", "reject_column") == sorted(
        [("malformed", None), ("malformed", None), ("missing", "name"), ("too_wide", "name"), ("unreadable", "amount"),
         ("unreadable", "count")], key=repr)
    lines = {r.raw_line for r in bad.collect()}
    assert {"short,1", "long,1,2,3", "Bad,n/a,2"} <= lines


def test_good_rows_do_not_depend_on_the_columns_used(spark, tmp_path):
    path = feed(tmp_path, "a,1,2", "b,1", "c,x,2")
    good = read_feed(spark, path, SPEC).good
    assert [r[0] for r in good.select("name").collect()] == ["a"]
    assert good.count() == 1
    assert good.filter("count = 2").join(good, "name").count() == 1


def test_windows_text(spark, tmp_path, rows):
    path = feed(tmp_path, "“Café” – €5,1,2")
    assert rows(read_feed(spark, path, SPEC).good, "name") == [("“Café” – €5",)]
    path = feed(tmp_path, "“Café” – €5,1,2", encoding="utf-8", name="utf.csv")
    assert rows(read_feed(spark, path, SPEC, encoding="utf-8").good, "name") == [("“Café” – €5",)]


def test_line_breaks_inside_fields_are_found(spark, tmp_path, rows):
    plain = feed(tmp_path, "a,1,2", '"say ""x""",1,2', "short,1", name="plain one.csv")
    broken = feed(tmp_path, '"two\r\nlines",1,2', "b,1,2", name="broken one.csv")
    assert spanning_files(spark, plain) == []
    assert len(spanning_files(spark, [plain, broken])) == 1
    assert rows(read_feed(spark, broken, SPEC).good, "count") == [(2,), (2,)]
    # each file is read in the way it needs
    both = read_feed(spark, str(tmp_path / "*.csv"), SPEC)
    names = [r[0].split()[0] for r in rows(both.good, "name")]
    assert names == ["a", "b", "say", "two"] and both.quarantine.count() == 1


def test_many_files_with_line_breaks(spark, tmp_path):
    for i in range(3):
        feed(tmp_path, f'"two\r\nlines {i}",1,2', "b,1,2", name=f"f {i}%.csv")
    assert read_feed(spark, str(tmp_path), SPEC).good.count() == 6


def test_strict_fails_on_a_value_but_not_on_a_shape(spark, tmp_path):
    shape = feed(tmp_path, "a,1,2", "b,1", name="shape.csv")
    assert read_feed(spark, shape, SPEC, strict=True).good.collect()[0].name == "a"
    value = feed(tmp_path, "a,1,2", "b,x,2", name="value.csv")
    with pytest.raises(Exception, match="unreadable value in column amount"):
        read_feed(spark, value, SPEC, strict=True).good.collect()


def test_wide_feed_can_be_filtered_and_joined(spark, tmp_path):
    spec = pitch_feed()
    path = tmp_path / "wide.csv"
    line = ",".join("1" if f.kind != "date" else "2001-01-01" for f in spec.fields)
    path.write_text(",".join(f.header for f in spec.fields) + "\n" + line + "\n")
    good = read_feed(spark, str(path), spec).good
    joined = good.filter("season_number = 1").join(good.select("startup_name"), "startup_name")
    assert joined.groupBy("season_number").count().collect()[0]["count"] == 1


def test_file_life_cycle(spark, tmp_path):
    path = feed(tmp_path, "a,1,2")
    assert files.path_exists(spark, path)
    assert files.path_exists(spark, str(tmp_path / "*.csv"))
    assert not files.path_exists(spark, str(tmp_path / "none.csv"))
    target = files.archive_file(spark, path, str(tmp_path / "archive"), datetime(2024, 3, 5, 7, 8, 9))
    assert target.endswith("archive/feed_20240305_070809.csv")
    assert not files.path_exists(spark, path) and files.path_exists(spark, target)
    with pytest.raises(OSError):
        files.move(spark, path, target)
