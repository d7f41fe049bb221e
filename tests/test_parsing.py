import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from remitlens.functions.parsing import (
    clean_id, clean_modifiers, parse_currency, parse_date, parse_units,
)


def parsed(spark, function, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select(function(F.col("t")), "i").orderBy("i").select("*").collect()]


def test_ids_are_trimmed_and_upper_cased_and_blank_stays_blank(spark):
    assert parsed(spark, clean_id, "  ab1 ", "", "  ", None) == ["AB1", "", "", None]


def test_modifiers_lose_blanks_but_keep_case(spark):
    assert parsed(spark, clean_modifiers, "  25|59 | gT ") == ["25|59|gT"]


def test_units(spark):
    got = parsed(spark, parse_units, " 7 ", "", "x", "1.5", "40000", "-3", "0", None)
    assert got == [7, None, None, None, None, -3, 0, None]


def test_three_date_formats(spark):
    d = dt.date(2026, 3, 4)
    assert parsed(spark, parse_date, "2026-03-04", "03/04/2026", "20260304", " 2026-03-04 ") == [d] * 4


def test_bad_dates_are_null(spark):
    bad = ["2026-13-45", "2026-02-30", "3/4/2026", "04.03.2026", "", "n/a", "202603041", None]
    assert parsed(spark, parse_date, *bad) == [None] * len(bad)


def test_currency(spark):
    texts = ["$1,240.00 ", "(85.00)", "12", ".5", "1.005", "abc", "1e3", "", "(-5)", None,
             "99999999999.00", "$ 5.00"]
    want = ["1240.00", "-85.00", "12.00", "0.50", "1.01", None, None, None, None, None, None, "5.00"]
    assert parsed(spark, parse_currency, *texts) == [Decimal(w) if w else None for w in want]
