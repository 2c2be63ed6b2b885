import pytest
from pyspark.sql import functions as F

from starmill.functions import clean


def value(spark, expression, text):
    return spark.createDataFrame([(text,)], "t string").selectExpr(f"{expression} AS v").first().v


@pytest.mark.parametrize(
    "text, number",
    [("5", 5), (" 5 ", 5), ("+5", 5), ("-5", -5), ("5.0", 5), ("5.", 5), ("5.5", None), ("", None), ("  ", None),
     (None, None), ("99999999999", None), ("five", None), ("0x5", None), ("5d", None)],
)
def test_whole(spark, text, number):
    assert value(spark, clean.to_whole("t"), text) == number


@pytest.mark.parametrize(
    "text, number",
    [("1.5", 1.5), (" .5", 0.5), ("2.", 2.0), ("1.5E7", 1.5e7), ("1e-3", 0.001), ("NaN", None), ("Infinity", None),
     ("1d", None), ("1,5", None), ("", None), (None, None), ("1e999", None)],
)
def test_double(spark, text, number):
    assert value(spark, clean.to_double("t"), text) == number


@pytest.mark.parametrize(
    "text, day",
    [("2009-08-09", "2009-08-09"), ("8/9/2009", "2009-08-09"), ("9-Aug-09", "2009-08-09"), ("9-Aug-2009", "2009-08-09"),
     ("31-Feb-2009", None), ("soon", None), ("", None)],
)
def test_date(spark, text, day):
    found = value(spark, clean.to_date("t"), text)
    assert (found and str(found)) == day


def test_date_notations(spark):
    assert clean.date_shape("d.M.yyyy") == r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}$"
    assert clean.date_shape("d. MMMM yyyy") is None and clean.date_shape("yyyy-MM-dd'T'HH") is None
    expression = clean.to_date("t", ["d.M.yyyy", "d. MMMM yyyy"])
    assert [str(value(spark, expression, t)) for t in ("9.8.2009", "9. August 2009", "2009-08-09")] == ["2009-08-09", "2009-08-09", "None"]


def test_flags(spark):
    assert [value(spark, clean.to_flag("t"), t) for t in ("1", "0", "1.0", "", None)] == [True, False, True, None, None]
    assert [value(spark, clean.yes_flag("t"), t) for t in ("yes", " YES ", "no", "", None)] == [True, True, None, None, None]


def test_blank(spark):
    assert [value(spark, clean.blank_to_null("t"), t) for t in (" a ", "  ", None)] == ["a", None, None]


def test_small_formulas(spark):
    df = spark.sql("SELECT 'Acme  ' AS a, 1 AS one, 0 AS zero, cast(NULL AS int) AS none, true AS deal")
    row = df.select(
        clean.fold_key(F.col("a")).alias("folded"),
        F.expr(clean.ratio("one", "zero")).alias("ratio"),
        clean.join_text("S", F.col("one"), "E", F.col("none")).alias("label"),
        clean.default_when(F.col("deal"), F.col("none"), 0).alias("with_deal"),
        clean.default_when(~F.col("deal"), F.col("none"), 0).alias("without_deal"),
        clean.percent_to_fraction(F.col("one")).alias("fraction"),
    ).first()
    assert tuple(row) == ("acme", None, "S1E", 0, None, 0.01)
