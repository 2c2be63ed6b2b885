"""The order database seen as a feed: what is dealt out between tasks, and odd keys."""

import re

import pytest
from pyspark.sql import functions as F

from starmill.plans import orders_feed as feed

SF_DIR = "/root/testdata/sf0.001"


def exchanged(df, capsys) -> list[int]:
    """For every shuffle by key in the plan: how many columns its rows have."""
    df.explain("formatted")
    plan = capsys.readouterr().out
    return [int(n) for n in re.findall(r"\) Exchange[^\n]*\nInput \[(\d+)\]", plan)]


def test_lines_are_dealt_out_as_they_are(spark, capsys):
    # sums for every investor were made first: 29 columns, in a task that reads lines in no order for nearly every line
    assert exchanged(feed.line_measures(spark, SF_DIR), capsys) == [4]


def test_orders_are_dealt_out_before_columns_are_made_of_them(spark, capsys):
    assert max(exchanged(feed.invested_rows(spark, SF_DIR), capsys)) <= 6


@pytest.fixture
def odd_lines(spark, tmp_path):
    lines = [(1, 3, 1.5, 2.0), (1, 13, 0.5, 1.0), (1, 6, 1.0, 1.0), (1, 29, 2.0, 3.0), (1, 9, None, 4.0), (2, None, 9.0, 9.0), (2, -4, 8.0, 8.0), (3, 7, None, None)]
    schema = "l_orderkey long, l_suppkey long, l_extendedprice double, l_quantity double"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_lines_without_a_supplier_belong_to_no_investor(spark, odd_lines, rows):
    found = feed.line_measures(spark, odd_lines).withColumn("others", F.coalesce(*[f"investor_{i}_investment_amount" for i in (0, 1, 2, 4, 5)]))
    columns = ["l_orderkey", "investor_3_investment_amount", "investor_3_investment_equity", "guest_investment_amount", "guest_investment_equity", "guest_name", "others"]
    assert rows(found, *columns) == [
        (1, 2.0, 3.0, 3.0, 8.0, "Guest 6, and Guest 9", None),
        (2, None, None, None, None, None, None),
        (3, None, None, None, None, "Guest 7", None),
    ]
