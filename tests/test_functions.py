import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from haulmark import functions as H


def evaluate(spark, fn, values, dtype="string"):
    """Apply a column function to values that arrive from a table, not as literals."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}").repartition(1)
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


CASES = [
    ("null_like", H.null_like,
     {" ": None, "N/A": None, "missing": None, "None": "None", " x ": "x", " \ty\n": "y",
      "Null": "Null", "": None, "MISSING": "MISSING", "\u2003N/A\u3000": None, "\xa0z\u2009": "z"}),
    ("to_int", H.to_int,
     {"1,234": 1234, "3.0": None, "abc": None, " 7 ": 7, "+5": 5, "N/A": None, ",": None,
      "99999999999": None, "-3": -3}),
    ("to_decimal", lambda c: H.to_decimal(c, 18, 2),
     {"98.64%": Decimal("98.64"), "1,000.5": Decimal("1000.50"), "NA": None,
      "2.345": Decimal("2.35"), "5 %": Decimal("5.00"), "7%%": None, "-2.345": Decimal("-2.35")}),
    ("num_dec", H.num_dec,
     {" 89.58 ": Decimal("89.58"), "—": None, "score 12.5 ok": Decimal("12.50"),
      "95%": Decimal("95.00"), "1,234.5": Decimal("1234.50"), "-": None, "": None}),
    ("to_float", H.to_float, {"1,5.5%": 15.5, "x": None, "1d": None, "NaN": None}),
    ("percent_number", H.percent_number,
     {"7%%": 7.0, "": None, "Missing": None, "1,200": 1200.0, "inf": None, "2f": None}),
    ("hours_label", H.hours_label, {"8 hr": 8, "10HR": 10, "none": None, None: None}),
    ("station_code", H.station_code,
     {"Dallas (dsw3)": "DSW3", "at dsw12 hub": "DSW12", " abc ": "ABC", "": None}),
    ("normalize_id", H.normalize_id,
     {" A1|B2 ": "A1", "N/A": None, "NULL": None, "a,b": "a,b", "NA": "NA"}),
    ("normalize_id list", lambda c: H.normalize_id(c, separators="|,"), {"a,b": "a", "c|d": "c"}),
    ("route_station", H.route_station, {"is12": "dsw2", "CX1": "dsw3", None: None, " IS": "dsw2"}),
    ("week_label", H.week_label,
     {"2025-36": "2025-W36", "2025-W36": "2025-W36", "Week 36": "Week 36", "wk 2025 w07 x": "2025-W07"}),
    ("service_type", H.service_type,
     {"Delivered Package": "Package", "incentives": "Incentive", " 10Hr Rt ": "10Hr Rt"}),
    ("split_list", H.split_list,
     {" a | b||c ": ["a", "b", "c"], "": [], None: None, "a,b": ["a,b"], "|x|": ["x"]}),
    ("split_list comma", lambda c: H.split_list(c, "|,"), {"a, b|c": ["a", "b", "c"]}),
    ("trailing_digits", H.trailing_digits, {"Week 44": 44, "2025-W05": 5, "none": None}),
    ("filename_week_year", H.filename_week_year,
     {"DSP_Delivery_Overview_ALL_2025-W44.csv": 2025, "a_2024-w2.csv": 2024, "x.csv": None}),
    ("label_monday", H.label_monday,
     {"2025-W36": dt.date(2025, 9, 1), "2025-W01": dt.date(2024, 12, 30), "bad": None}),
]


@pytest.mark.parametrize("name,fn,cases", CASES, ids=[c[0] for c in CASES])
def test_text_and_number_cases(spark, name, fn, cases):
    assert evaluate(spark, fn, list(cases)) == list(cases.values())


def test_to_date_spellings(spark):
    day = dt.date(2025, 9, 6)
    cases = {
        "2025-09-06": day, "09/06/2025": day, "9/6/2025": day, "9-6-2025": day, "2025/9/6": day,
        "9/6/25": day, "20250906": day, "Sep 6, 2025": day, "6 September 2025": day,
        "06-Sep-2025": day, "Saturday, September 6, 2025": day, "2025-09-06T10:11:12": day,
        "25/12/2025": dt.date(2025, 12, 25), "9/6/99": dt.date(1999, 9, 6),
        "x": None, "2025": None, "2025-13-01": None, "13/13/2025": None, "2025-02-30": None,
        "2025-09-06 nonsense": None, "": None, None: None,
    }
    assert evaluate(spark, H.to_date, list(cases)) == list(cases.values())


def test_to_datetime_clock(spark):
    cases = {
        "2025-09-06 14:05": dt.datetime(2025, 9, 6, 14, 5),
        "9/6/2025 2:05 PM": dt.datetime(2025, 9, 6, 14, 5),
        "9/6/2025 12:05:09 am": dt.datetime(2025, 9, 6, 0, 5, 9),
        "Sep 6, 2025 12:00 PM": dt.datetime(2025, 9, 6, 12),
        "2025-09-06 07:08:09.25": dt.datetime(2025, 9, 6, 7, 8, 9, 250000),
        "2025-09-06 25:00": None,
    }
    assert evaluate(spark, H.to_datetime, list(cases)) == list(cases.values())


def test_round_and_day_stamp(spark):
    rounded = evaluate(spark, lambda c: H.round_to_second(H.to_datetime(c)),
                       ["2025-01-01 00:00:00.5", "2024-12-31 23:59:59.499"])
    assert rounded == [dt.datetime(2025, 1, 1, 0, 0, 1), dt.datetime(2024, 12, 31, 23, 59, 59)]
    at_23 = dt.datetime(2025, 4, 29, 23)
    assert evaluate(spark, H.day_stamp, ["4/29/2025", "45776", "2025-04-29 10:00", "x"]) == [
        at_23, at_23, at_23, None]


def test_filename_timestamp(spark):
    cases = {
        "Routes_DSW3_2025-09-04_14_11 (PDT).csv": dt.datetime(2025, 9, 4, 14, 11),
        "Itineraries_DSW3_2025-09-04_23-51.csv": dt.datetime(2025, 9, 4, 23, 51),
        "a_2025_09_04 1:02:03.csv": dt.datetime(2025, 9, 4, 1, 2, 3),
        "a_2025-13-04_14_11.csv": None, "notes.csv": None, "a_2025-09-04_24_00.csv": None,
    }
    assert evaluate(spark, H.filename_timestamp, list(cases)) == list(cases.values())


def test_iso_week_and_bounds(spark):
    days = [dt.date(2024, 12, 30), dt.date(2021, 1, 3), dt.date(2025, 9, 7)]
    assert evaluate(spark, H.iso_week_label, days, "date") == ["2025-W01", "2020-W53", "2025-W36"]
    assert evaluate(spark, H.week_monday, days, "date") == [
        dt.date(2024, 12, 30), dt.date(2020, 12, 28), dt.date(2025, 9, 1)]
    assert evaluate(spark, H.week_sunday, days, "date")[2] == dt.date(2025, 9, 7)


def test_sunday_calendar(spark):
    days = [dt.date(2024, 12, 28), dt.date(2024, 12, 29), dt.date(2025, 1, 4), dt.date(2025, 1, 5)]
    assert evaluate(spark, H.sunday_week_year, days, "date") == [2024, 2025, 2025, 2025]
    assert evaluate(spark, H.sunday_week_number, days, "date") == [52, 1, 1, 2]


def test_length_strategy(spark):
    assert evaluate(spark, lambda c: H.limit_length(c, 3), ["abcd", "ab", None]) == ["abc", "ab", None]
    assert evaluate(spark, lambda c: H.limit_length(c, 4, "error"), ["abcd"]) == ["abcd"]
    with pytest.raises(PySparkException, match="longer than 64"):
        evaluate(spark, H.normalize_id, ["x" * 65])
    assert evaluate(spark, lambda c: H.normalize_id(c, strategy="truncate"), ["x" * 65]) == ["x" * 64]


def test_opt_int(spark):
    values = [1.9, -1.9, float("nan"), float("inf"), None]
    assert evaluate(spark, H.opt_int, values, "double") == [1, -1, None, None, None]


def test_scores(spark):
    limits = [F.lit(x) for x in (99.65, 99.0, 98.0)]
    values = [99.65, 99.64, 98.0, 97.9, None]
    got = evaluate(spark, lambda c: H.score_higher(c, *limits), values, "double")
    assert got == [Decimal("1.0000"), Decimal("0.8000"), Decimal("0.6000"), Decimal("0.4000"), None]
    limits = [F.lit(x) for x in (0.5, 1.5, 3.0)]
    got = evaluate(spark, lambda c: H.score_lower(c, *limits), [0.5, 0.5001, 3.1, None], "double")
    assert got == [Decimal("1.0000"), Decimal("0.8000"), Decimal("0.4000"), None]


def test_row_signature_marks_missing_parts(spark):
    import hashlib
    df = spark.createDataFrame([(" a ", None, None)], "t string, u string, d date")
    got = df.select(H.row_signature(H.time_text(F.col("d")), H.key_text(F.col("t")),
                                    H.key_text(F.col("u")))).first()[0]
    assert got == hashlib.sha256(b"|A|#NULL#").hexdigest()


def test_full_name(spark):
    df = spark.createDataFrame([("n", "f", "l"), (None, "f", "l"), (None, None, "l"), (None, None, None)],
                               "n string, f string, l string")
    got = [r[0] for r in df.select(H.full_name(F.col("n"), F.col("f"), F.col("l"))).collect()]
    assert got == ["n", "f l", "l", None]
