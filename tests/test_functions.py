import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabula.functions import cleaning as c
from tabula.functions import numeric as num
from tabula.functions import text as tx


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_unknown_tokens_are_trimmed_and_exact(spark):
    rows = [(" Unknown ",), ("UNKNOWN",), ("uNknown",), ("\t x ",), ("",), (None,)]
    assert values(spark, rows, "t string", c.null_unknown(F.col("t"))) == [
        None, None, "uNknown", "x", None, None]


@pytest.mark.parametrize("text, number", [
    ("1", 1.0), (" -2.5e1 ", -25.0), (".5", 0.5), ("1d", None), ("1,234", None), ("abc", None), ("", None),
    (None, None)])
def test_to_number(spark, text, number):
    assert values(spark, [(text,)], "t string", c.to_number(F.col("t"))) == [number]


def test_whole_numbers(spark):
    rows = [("7",), ("7.0",), ("7.5",), ("x",)]
    assert values(spark, rows, "t string", c.to_whole(F.col("t"))) == [7, 7, None, None]


def test_dates_try_every_layout_and_never_fail(spark):
    rows = [("2024-02-03",), ("02/03/2024",), ("2024-02-03T04:05:06",), ("2024-13-40",), ("soon",), (None,)]
    got = values(spark, rows, "t string", c.to_timestamp_any(F.col("t")))
    assert got == [dt.datetime(2024, 2, 3), dt.datetime(2024, 2, 3), dt.datetime(2024, 2, 3, 4, 5, 6),
                   None, None, None]


def test_variable_width_layout_is_still_tried(spark):
    got = values(spark, [("2/3/2024",)], "t string", c.to_timestamp_any(F.col("t"), ["yyyy-MM-dd", "M/d/yyyy"]))
    assert got == [dt.datetime(2024, 2, 3)]


def test_value_maps_leave_others_null(spark):
    rows = [("Yes",), ("No",), ("Maybe",), (None,)]
    assert values(spark, rows, "t string", c.map_values(F.col("t"), {"Yes": True, "No": False})) == [
        True, False, None, None]
    assert values(spark, [("Low",), ("Critical",)], "t string", c.ordinal(F.col("t"), ["Low", "High"])) == [0, None]


def test_extract_whole_without_match(spark):
    rows = [("CVE-2021-1",), ("none",), (None,)]
    assert values(spark, rows, "t string", c.extract_whole(F.col("t"), r"CVE-(\d{4})")) == [2021, None, None]


def test_split_list(spark):
    rows = [("a, b,,Unknown , c",), (" , ",), (None,)]
    assert values(spark, rows, "t string", c.split_list(F.col("t"))) == [["a", "b", "c"], [], []]


def test_split_quoted_list(spark):
    rows = [('"CWE-1, CWE-2"',), ("CWE-3",), ('""',), (None,)]
    assert values(spark, rows, "t string", c.split_quoted_list(F.col("t"))) == [
        ["CWE-1", "CWE-2"], ["CWE-3"], [], []]


def test_list_literals(spark):
    rows = [("['a', \"it's\"]",), ("a , b,",), ("[]",), ("",), (None,), ("['broken",)]
    assert values(spark, rows, "t string", c.parse_list_literal(F.col("t"))) == [
        ["a", "it's"], ["a", "b"], [], [], [], ["['broken"]]


def test_epoch_seconds_and_milliseconds(spark):
    rows = [(1700000000.0,), (1700000000000.0,), (None,)]
    moment = dt.datetime(2023, 11, 14, 22, 13, 20)
    assert values(spark, rows, "e double", c.epoch_to_timestamp(F.col("e"))) == [moment, moment, None]


def test_concat_keeps_separator_of_missing_parts(spark):
    assert values(spark, [("a", None), (None, None)], "x string, y string",
                  c.concat_text(F.col("x"), F.col("y"))) == ["a ", " "]


def test_first_or_default(spark):
    rows = [([" a", "b"],), ([],), (None,)]
    assert values(spark, rows, "x array<string>", c.first_or(F.col("x"), "Unknown")) == ["a", "Unknown", "Unknown"]


def test_days_round_down(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(day.replace(hour=12), day.replace(hour=10)), (day, day + dt.timedelta(hours=47)), (day, None)]
    assert values(spark, rows, "a timestamp, b timestamp", num.whole_days(F.col("a"), F.col("b"))) == [-1, 1, None]


def test_bins_are_right_closed(spark):
    edges = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    rows = [(0.0,), (0.1,), (0.1001,), (1.0,), (1.1,), (None,)]
    assert values(spark, rows, "x double", num.cut(F.col("x"), edges)) == [None, 0, 1, 5, None, None]
    assert values(spark, rows[:1], "x double", num.cut(F.col("x"), edges, include_lowest=True)) == [0]


def test_flags_and_means_with_nulls(spark):
    assert values(spark, [(None,), (4,)], "x int", num.flag(F.col("x") > 3)) == [0, 1]
    rows = [(1.0, None, 3.0), (None, None, None)]
    mean = num.row_mean(F.col("a"), F.col("b"), F.col("c"))
    assert values(spark, rows, "a double, b double, c double", mean) == [2.0, None]


def test_full_match(spark):
    rows = [("ABC",), ("ABCD",), ("abc",), (None,)]
    assert values(spark, rows, "t string", num.full_match(F.col("t"), "[A-Z]{3}")) == [1, 0, 0, 0]


def test_tokens_and_bigrams(spark):
    rows = [("The Élan vital, a x_1 élan!",), ("one",), ("",)]
    words = tx.tokens(F.col("t"), ["the"])
    assert values(spark, rows, "t string", words) == [["élan", "vital", "x_1", "élan"], ["one"], []]
    assert values(spark, rows, "t string", tx.with_bigrams(words)) == [
        ["élan", "vital", "x_1", "élan", "élan vital", "vital x_1", "x_1 élan"], ["one"], []]


def test_epochs_out_of_range_are_null(spark):
    from pyspark.sql import functions as F

    from tabula.functions.cleaning import epoch_to_timestamp

    rows = spark.createDataFrame([(1e300,), (float("nan"),), (-1e15,), (0.0,), (1.7e12,)], "e double")
    assert [r["t"] is None for r in rows.select(epoch_to_timestamp(F.col("e")).alias("t")).collect()] == [True, True, True, False, False]


def test_moments_with_fraction_or_zone(spark):
    rows = [("2024-05-01T12:34:56.789000",), ("2024-05-01 12:34:56.5",), ("2024-05-01T12:34:56Z",),
            ("2024-05-01T12:34:56.123456789+02:00",), ("2024-13-01T12:34:56Z",), ("2024-05-01T12:34:56.",)]
    got = values(spark, rows, "t string", F.date_format(c.to_timestamp_any(F.col("t")), "HH:mm:ss.SSSSSS"))
    assert got == ["12:34:56.789000", "12:34:56.500000", "12:34:56.000000", "10:34:56.123456", None, None]
