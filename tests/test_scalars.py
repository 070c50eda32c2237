"""Scalar functions: plain rows of each rule, then edge rows."""
import pytest
from pyspark.sql import functions as F

from sponsorlens.functions import scalars as X
from sponsorlens.functions.jobboard import board_name, split_list


def one(spark, expr, *values, schema=None):
    cols = ", ".join(f"c{i} string" for i in range(len(values)))
    df = spark.createDataFrame([tuple(values)], schema or cols)
    return df.select(expr).first()[0]


def clean(spark, name):
    return one(spark, X.clean_employer("c0"), name)


def test_clean_employer_normalizes_suffixes(spark):
    assert {clean(spark, n) for n in ("Harbor Mills Corp", "HARBOR MILLS, LLC", "harbor mills")} == {"HARBOR MILLS"}
    assert clean(spark, "Tide.Water Foods, Inc.") == "TIDE WATER FOODS"


@pytest.mark.parametrize("name,expected", [
    ("LLC", ""),                                   # a name that is only a suffix
    ("A.B. L.L.C.", "A B L L C"),                  # dotted suffixes never match once dots are gone
    ("Société Générale, Inc.", "SOCIÉTÉ GÉNÉRALE"),  # Unicode letters kept
    ("  Tab\tCorp\n", "TAB"),
    ("JPMORGAN CHASE & CO.", "JPMORGAN CHASE"),
    (None, None),
])
def test_clean_employer_edges(spark, name, expected):
    assert clean(spark, name) == expected


def annual(spark, wage, unit):
    return one(spark, X.annualize("c0", "c1"), wage, unit)


def test_annualize_units_and_bounds(spark):
    assert [annual(spark, w, u) for w, u in (("31", "Hour"), ("72,500", "Year"), ("1,450", "Week"))] == [64480, 72500, 75400]
    assert annual(spark, "800", "Month") is None       # 9600 is below the floor
    assert annual(spark, None, "Month") is None


@pytest.mark.parametrize("wage,unit,expected", [
    ("N/A", "Year", None), ("1_000_0", "Year", 10000.0), ("100d", "Year", None), ("nan", "Year", None),
    ("5000000", "Year", 5000000.0), ("5000001", "Year", None), ("10000", "Year", 10000.0),
    ("9999", "Year", None), ("$52,000.50", None, 52000.5), ("1000", "Bi-Weekly", 26000.0),
    ("50", " hour ", 104000.0), ("20000", "Decade", 20000.0), ("1e5", "year", 100000.0),
    ("5000", "Month", 60000.0), ("2000", "Week", 104000.0),
])
def test_annualize_edges(spark, wage, unit, expected):
    assert annual(spark, wage, unit) == expected


def category(spark, title, soc):
    return one(spark, X.job_category("c0", "c1"), title, soc)


def test_job_category_rules(spark):
    told = {"PAYROLL CLERK": "Other", "SOFTWARE ENGINEER III": "Software", "LEAD DATA ENGINEER": "Data", "MACHINE LEARNING LEAD": "AI/ML"}
    assert {t: category(spark, t, None) for t in told} == told


def test_job_category_order_and_words(spark):
    assert category(spark, "DATA ENGINEER", "Machine Learning") == "AI/ML"    # first rule wins
    assert category(spark, "FULLSTACK DEV", None) == "Software"
    assert category(spark, "NETWORK ADMIN", None) == "Other IT"
    assert category(spark, "CIVIL ENGINEER", None) == "Other Engineering"
    assert category(spark, "MAIL CLERK", None) == "Other"                   # AI inside a word: no
    assert category(spark, None, None) == "Other"


@pytest.mark.parametrize("text,expected", [
    ("2024-10-01", "2024-10-01"), ("10/01/2024", "2024-10-01"), ("2024-13-01", None),
    ("2024-10-01 00:00:00", "2024-10-01"), (" 2024-09-30 ", "2024-09-30"), (None, None),
])
def test_parse_date(spark, text, expected):
    got = one(spark, X.parse_date("c0"), text)
    assert (got.isoformat() if got else None) == expected


def test_fiscal_year(spark):
    df = spark.createDataFrame([("2024-09-30",), ("2024-10-01",), (None,)], "d string")
    got = [r[0] for r in df.select(X.fiscal_year(F.to_date("d"))).collect()]
    assert got == [2024, 2025, None]


@pytest.mark.parametrize("text,expected", [("2.7", 2), ("x", 1), (None, 1), ("5", 5), (" 3 ", 3)])
def test_positions(spark, text, expected):
    assert one(spark, X.int_or_one("c0"), text) == expected


@pytest.mark.parametrize("text,expected", [("Y", True), ("y", True), ("N", False), ("", False), (None, False)])
def test_yes_flag(spark, text, expected):
    assert one(spark, X.yes_flag("c0"), text) is expected


def test_soc_code_and_na_tokens(spark):
    assert one(spark, X.soc_code("c0"), " 15-1252.00 ") == "15-1252"
    assert one(spark, X.na_to_null("c0"), "N/A") is None
    assert one(spark, X.na_to_null("c0"), "NAN") == "NAN"


def test_university_flag(spark):
    assert one(spark, X.is_university("c0"), "THE OHIO STATE UNIVERSITY") is True
    assert one(spark, X.is_university("c0"), "MASSACHUSETTS INSTITUTE OF TECHNOLOGY") is True
    assert one(spark, X.is_university("c0"), "INSTITUTE FOR STUDY") is False
    assert one(spark, X.is_university("c0"), None) is False


def test_rounding_and_percent(spark):
    # 1.005 is stored as 1.00499999...: both engines agree on 1.0 with this
    # formula; an exact half (0.125) rounds up.
    df = spark.createDataFrame([(1.005, 0.125, 2, 3)], "x double, y double, a long, b long")
    r = df.select(X.round_half_up("x", 2).alias("r"), X.round_half_up("y", 2).alias("h"),
                  X.pct("a", "b", 1).alias("p")).first()
    assert r.r == 1.0 and r.h == 0.13 and r.p == 66.7
    z = spark.createDataFrame([(0, 0)], "a long, b long").select(X.pct("a", "b", 1)).first()[0]
    assert z is None


def test_like_text_is_literal_for_backslash(spark):
    df = spark.createDataFrame([("A\\B",), ("AB",)], "s string")
    assert df.where(X.contains_ci("s", "a\\")).count() == 1


def test_board_name_and_list(spark):
    assert one(spark, board_name("c0"), "Stripe, Inc.") == "stripe"
    assert one(spark, board_name("c0"), "Acme Technologies LLC") == "acme"
    assert one(spark, board_name("c0"), "LLC") == ""
    assert one(spark, split_list("c0"), " a, ,b ,") == ["a", "b"]
