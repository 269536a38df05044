import datetime as dt

import pytest
from pyspark.sql import functions as F

from weektide.functions import calendar, numbers, text


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x")).alias("y")).collect()]


def test_week_dates_match_the_calendar_for_all_weeks(spark):
    rows = [(y, w) for y in range(1995, 2035) for w in range(0, 56)]
    df = spark.createDataFrame(rows, "y int, w int")
    got = df.select("y", "w", calendar.iso_monday("y", "w").alias("m"), calendar.iso_sunday("y", "w").alias("s"))
    for y, w, monday, sunday in got.collect():
        try:
            want = dt.date.fromisocalendar(y, w, 1)
        except ValueError:
            want = None
        assert monday == want
        assert sunday == (want + dt.timedelta(days=6) if want else None)


def test_week_53_only_where_it_exists(spark):
    df = spark.createDataFrame([(2020, 53), (2021, 53), (0, 1), (None, 1)], "y int, w int")
    got = [r[0] for r in df.select(calendar.iso_monday("y", "w")).collect()]
    assert got == [dt.date(2020, 12, 28), None, None, None]


def test_weeks_in_year_and_open_week(spark):
    df = spark.createDataFrame([(2015,), (2020,), (2023,), (2026,)], "y int")
    got = df.select(calendar.weeks_in_year("y"), calendar.last_open_week("y", 2026, 11)).collect()
    assert [tuple(r) for r in got] == [(53, 53), (53, 53), (52, 52), (53, 11)]


def test_unknown_anchor_is_an_error():
    with pytest.raises(ValueError, match="anchor"):
        calendar.week_date("y", "w", "friday")


def test_period_label(spark):
    df = spark.createDataFrame([(2024, 3), (2024, None)], "y int, w int")
    assert [r[0] for r in df.select(calendar.period_label("y", "w")).collect()] == ["2024-W03", None]


def test_clean_cell(spark):
    cases = {
        "結核 (Tuberculosis)": "Tuberculosis",
        "結核（Tuberculosis）": "Tuberculosis",
        "a (first) (second)": "second",
        "Name\r\nnext\tpart": "Name  next part",
        "nul\x00byte": "nulbyte",
        "Ｉnfluenza　": "Influenza",
        "   ": None,
        "": None,
        None: None,
        "open (bracket": "open (bracket",
    }
    assert column(spark, list(cases), text.clean_cell) == list(cases.values())


def test_clean_cell_can_leave_plain_english_alone(spark):
    got = column(spark, ["Name (detail)", "結核 (Name)"], lambda c: text.clean_cell(c, bilingual_only=True))
    assert got == ["Name (detail)", "Name"]


def test_clean_header(spark):
    cases = {
        "first\nTuberculosis": "Tuberculosis",
        "...12": None,
        "（Measles）": "Measles",
        "(Measles) (x)": "(Measles) (x)",
        "Word  (detail)": "Word (detail)",
        "Ｉnfluenza": "Influenza",
        " ": None,
    }
    assert column(spark, list(cases), text.clean_header) == list(cases.values())


def test_normalize_name(spark):
    cases = {
        "H5N1) (Avian influenza H5N1": "Avian influenza H5N1",
        "Acquired immunodeficiency syndrome (AIDS)": "AIDS",
        "Acquired immunodeficiency syndrome (AIDS": "AIDS",
        "Herpes B virus infection": "B virus disease",
        "  Scrub   typhus(Tsutsugamushi disease": "Scrub typhus",
        "Plain": "Plain",
        None: None,
    }
    assert column(spark, list(cases), text.normalize_name) == list(cases.values())
    assert column(spark, ["a"], lambda c: text.normalize_name(c, {"a": "b"})) == ["b"]


def test_normalising_twice_changes_nothing(spark):
    names = ["VRE infection", "x (y", "West Nile fever(including West Nile encephalitis", "a) (b"]
    once = column(spark, names, text.normalize_name)
    assert column(spark, once, text.normalize_name) == once


def test_name_audit_has_one_row_per_spelling(spark):
    df = spark.createDataFrame([("HIV/AIDS",), ("HIV/AIDS",), ("Measles",), (None,)], "disease string")
    got = {tuple(r) for r in text.name_audit(df, "disease").collect()}
    assert got == {("HIV/AIDS", "AIDS"), ("Measles", "Measles")}


def test_normalize_names_without_the_column(spark):
    df = spark.range(1)
    assert text.normalize_names(df, "disease").columns == ["id"]


def test_categories(spark):
    cases = {
        "Total": "total",
        "Female": "female",
        "male": "male",
        "Inside Japan": "japan",
        "Others": "others",
        "Unknown place": "unknown",
        "男性": "total",
        None: "total",
        "infant": "infant",
    }
    assert column(spark, list(cases), text.classify_category) == list(cases.values())


def test_total_rows(spark):
    names = ["Total No.", "Sub total", "総数", "合計", "Tokyo"]
    assert column(spark, names, lambda c: text.is_total_row(c)) == [True, True, False, False, False]
    assert column(spark, names, lambda c: text.is_total_row(c, "prefix")) == [True, False, False, False, False]
    assert column(spark, names, lambda c: text.is_total_row(c, "japanese")) == [False, False, True, True, False]
    with pytest.raises(ValueError):
        text.is_total_row("x", "other")


def test_fold_fullwidth(spark):
    assert column(spark, ["ＩＲ１　"], text.fold_fullwidth) == ["IＲ１ "]
    assert column(spark, ["ＩＲ１　"], lambda c: text.fold_fullwidth(c, all_ascii=True)) == ["IR1 "]


def test_data_version(spark):
    assert column(spark, ["v1.2", "2.0"], text.data_version) == ["1.2", "2.0"]


CELLS = ["12", " 12.5 ", "1,234", "-", "", "5d", "nan", "1e3", "-3.9", None, "　7", "abc"]


def test_parse_number(spark):
    got = column(spark, CELLS, numbers.parse_number)
    assert got == [12.0, 12.5, 1234.0, None, None, None, None, 1000.0, -3.9, None, 7.0, None]


def test_parse_counts(spark):
    assert column(spark, CELLS, numbers.parse_count) == [12, 12, 1234, 0, 0, 0, 0, 1000, -3, 0, 7, 0]
    assert column(spark, CELLS, numbers.parse_count_strict) == [12, 0, 0, 0, 0, 0, 0, 1000, -3, 0, 0, 0]


def test_dashes(spark):
    assert column(spark, ["-5-6", "5", "-"], numbers.drop_first_dash) == ["5-6", "5", ""]
    assert column(spark, ["-", "-5", "0.3", None], numbers.parse_dashed) == [None, 5.0, 0.3, None]


def test_format_count(spark):
    got = column(spark, [1234567.0, 1234.5, None, 0.0], numbers.format_count, "double")
    assert got == ["1,234,567", "1,234.50", "0", "0"]


def test_a_dictionary_repairs_like_every_row(spark):
    odd = [None, "", " ", "H5N1) (Avian flu", "HIV/AIDS", "Mumps (a", "Mumps  x", "a) b", "((", "))", "x)(y"]
    rows = [(k, odd[k % len(odd)], 1) for k in range(300)] + [(1000 + k, f"rare {k} (", 2) for k in range(60)]
    df = spark.createDataFrame(rows, "id long, disease string, _n int")
    want = {(r["id"], r["n"]) for r in df.select("id", text.normalize_name("disease").alias("n")).collect()}
    for known in (0, 3, 40, 10_000):
        got = text.normalize_names(df, "disease", known=known)
        assert got.columns == df.columns
        assert {(r["id"], r["disease"]) for r in got.collect()} == want
    assert text.normalize_names(df, "other") is df
    # The names are repaired after they are folded, below the join.
    plan = text.normalize_names(df, "disease")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "GlobalLimit 10000" in plan
