"""Scalar columns on hand-worked inputs, and properties that hold for any name."""
import random

import pytest

from sponsorlens.functions import scalars as X

NAMES = {
    "Acme, Inc.": "ACME", "  acme   LLC ": "ACME", "Société Générale Corp": "SOCIÉTÉ GÉNÉRALE", "Müller\tCo": "MÜLLER",
    "3M Company": "3M", "x_y Ltd": "X_Y", "東京 Corporation": "東京", "LLC": "", "": "", "Incline Village": "INCLINE VILLAGE",
}
WAGES = [
    ("100000", "Year", 100000.0), ("$52,000.50", "Year", 52000.5), ("25", " hour ", 52000.0), ("2000", "Week", 104000.0),
    ("4000", "Bi-Weekly", 104000.0), ("7000", "MONTH", 84000.0), (" 75000 ", None, 75000.0), ("1e5", "Year", 100000.0),
    ("60000", "Decade", 60000.0), ("1_000_00", "Year", 100000.0), ("abc", "Year", None), ("", "Year", None), ("1__0", "Hour", None),
    ("-20000", "Year", None), ("9999", "Year", None), ("10000", "Year", 10000.0), ("5000001", "Year", None), ("nan", "Year", None),
    ("$$90000", "", 90000.0),
]
WORDS = ["Acme", "Société", "LLC", "Inc.", "CORP", "co", "USA", "Ltd", "University", "of", "Institute", "Müller", "東京", "A&B", "x_y", "42", "-", "/", ",", "."]


@pytest.mark.parametrize("raw, clean", NAMES.items())
def test_clean_employer(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "n string")
    assert df.select(X.clean_employer("n").alias("c")).first().c == clean


def test_annualize(spark):
    df = spark.createDataFrame([(w, u) for w, u, _ in WAGES], "w string, u string")
    got = [r.a for r in df.select(X.annualize("w", "u").alias("a")).collect()]
    assert got == [a for _, _, a in WAGES]


def test_clean_names_are_stable(spark):
    rnd = random.Random(7)
    names = ["".join(rnd.choice(WORDS) + rnd.choice([" ", "  ", "\t", ""]) for _ in range(rnd.randint(0, 6))) for _ in range(300)]
    df = spark.createDataFrame([(n,) for n in names], "n string").withColumn("c", X.clean_employer("n"))
    for r in df.select("n", "c", X.clean_employer("c").alias("again")).collect():
        assert r.c == r.c.strip() and "  " not in r.c and "\t" not in r.c and r.c == r.c.upper()
        assert not set(r.c.split()) & {"LLC", "INC", "CORP", "LTD"}, r
        assert r.again == r.c


def test_percentages_round_half_up(spark):
    cases = [(1, 8, 1, 12.5), (1, 3, 2, 33.33), (2, 3, 2, 66.67), (1, 16, 1, 6.3), (0, 5, 1, 0.0), (5, 5, 1, 100.0), (1, 0, 1, None)]
    for part, whole, d, want in cases:
        df = spark.createDataFrame([(part, whole)], "p long, w long")
        assert df.select(X.pct("p", "w", d).alias("x")).first().x == want
