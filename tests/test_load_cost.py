"""What a load and the CSV fixture cost: compiled code, texts taken apart once, few bytes on disk."""
import datetime as dt
import re
import threading

import pytest
from pyspark.sql import functions as F

from sponsorlens import session as X
from sponsorlens.functions import scalars as SC
from sponsorlens.operators import transform as TR
from sponsorlens.operators import warehouse as W
from sponsorlens.operators.warehouse import load_batch, load_lca
from sponsorlens.plans import context
from sponsorlens.sources import fixtures as FX
from sponsorlens.sources.raw import read_raw_csv
from sponsorlens.sources.sample import make_rows


@pytest.fixture()
def limit(spark):
    """The session's limit for generated methods, taken back afterwards."""
    kept = spark.conf.get(X.METHOD_LIMIT, None)
    yield
    spark.conf.unset(X.METHOD_LIMIT) if kept is None else spark.conf.set(X.METHOD_LIMIT, kept)


def test_a_load_runs_no_interpreted_methods(spark, wh, limit):
    """Staging's code has methods that the JVM would only interpret: such stages run operator by operator."""
    spark.conf.set(X.METHOD_LIMIT, "65535")
    load_lca(wh, make_rows(spark, 50, seed=21))
    assert int(spark.conf.get(X.METHOD_LIMIT)) <= 8000 and wh.read("lca_filings").count() == 50
    spark.conf.set(X.METHOD_LIMIT, "4000")          # a lower limit stays
    X.fit_methods(spark)
    assert spark.conf.get(X.METHOD_LIMIT) == "4000"


def test_packed_texts_are_split_once(spark):
    """One split of the packed texts serves all values; separators, escapes, empty texts and nulls come back."""
    texts = [("a", "", None), (TR.SEPARATOR, TR.ESCAPE, f"{TR.ESCAPE}1"), (None, None, None), ("", "", ""),
             (f"{TR.ESCAPE}2", f"x{TR.SEPARATOR}", "é\n"), ("", "b", "")]
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "id int, a string, b string, c string")
    back = TR.unpacked(TR.packed(rows).repartition(3), rows)
    assert [tuple(r) for r in back.orderBy("id").collect()] == [(i, *t) for i, t in enumerate(texts)]
    plan = back._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("substring_index") == 6     # these for bytes that are no UTF-8 only
    one = rows.select("id", "b")                    # one text only, and none at all
    assert [r.b for r in TR.unpacked(TR.packed(one), one).orderBy("id").collect()] == [t[1] for t in texts]
    assert TR.unpacked(TR.packed(rows.select("id")), rows.select("id")).count() == len(texts)


def test_strip_and_dates_by_the_short_way_are_the_same(spark):
    """Text with visible ends isn't compared with every whitespace character, and dates are cast first."""
    texts = ["", " ", "a", " a", "a ", " a ", "é", "é ", "\x1fa", "a\x85", "\x7fa\x7f", "!~", "~ x !", "　", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(SC.strip("t")).collect()]
    assert got == [None if t is None else t.strip() for t in texts]
    dates = {"2020-02-29": dt.date(2020, 2, 29), " 2/9/2020 ": dt.date(2020, 2, 9), "12/31/1999": dt.date(1999, 12, 31), "2021-02-29": None,
             "2020-03-04T05:06:07": dt.date(2020, 3, 4), "2020-03-04 05:06:07": dt.date(2020, 3, 4), "13/31/1999": None, "soon": None, "": None}
    made = spark.createDataFrame([(t,) for t in dates], "t string").select(SC.parse_date("t").alias("d"))
    assert [r.d for r in made.collect()] == [*dates.values()]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"coalesce\(try_cast", plan)


def test_ascii_names_and_titles_need_no_unicode_classes(spark):
    """Unicode-aware patterns run on text that isn't ASCII only, with the same outcome for both."""
    names = {"Acme, Inc.": "ACME", "  Foo\tBar  LLC ": "FOO BAR", "Société Générale Corp": "SOCIÉTÉ GÉNÉRALE", "A\x1cB": "A B", "LLC": "", None: None,
             "École Co.": "ÉCOLE", "State University of X, Ltd": "STATE UNIVERSITY OF X"}
    df = spark.createDataFrame([(n,) for n in names], "n string").select(SC.clean_employer("n").alias("c"))
    assert [r.c for r in df.collect()] == [*names.values()]
    assert [r[0] for r in df.select(SC.is_university("c")).collect()] == [n is not None and "UNIVERSITY" in n.upper() for n in names]
    titles = {"ml lead": "AI/ML", "Data  Engineer": "Other Engineering", "data engineer": "Data", "é software": "Software", "éAI": "Other", "ai": "AI/ML"}
    got = [r[0] for r in spark.createDataFrame([(t,) for t in titles], "t string").select(SC.job_category("t", F.lit(None).cast("string"))).collect()]
    assert got == [*titles.values()]


PERM = ("CASE_NO string, EMPLOYER_NAME_9089 string, PW_SOC_CODE_9089 string, CASE_RECEIVED_DATE string, row_seq long, "
        "source_file string")


def test_jobs_of_a_load_run_together(spark, wh, monkeypatch):
    """Both kinds are staged at the same time, so are the dimensions: each waits for the others here."""
    gates = {"staged_": threading.Barrier(2), "new_": threading.Barrier(3)}
    kept = W.Warehouse.materialise

    def materialise(self, df, name, parted=False):
        for start, gate in gates.items():
            if name.startswith(start):
                gate.wait(60)
        return kept(self, df, name, parted)

    monkeypatch.setattr(W.Warehouse, "materialise", materialise)
    perm = spark.createDataFrame([("A-100-1", "Acme LLC", "15-1252", "2020-01-02", 1, "perm.csv")], PERM)
    load_batch(wh, make_rows(spark, 50, seed=22), perm)
    assert wh.read("lca_filings").count() == 50 and wh.read("perm_filings").count() == 1
    assert sorted(r.source for r in wh.read("etl_runs").collect()) == ["lca", "perm"]


def test_together_ends_all_jobs_and_raises_the_first_error(spark):
    """In the order of the jobs, not of their failures."""
    done = []

    def job(i, wait, fails):
        wait and gate.wait(30)
        done.append(i)
        if fails:
            raise ValueError(i)
        fails is None and gate.set()
        return i

    gate = threading.Event()
    assert W._together(spark, lambda: job(1, False, False), lambda: job(2, False, False)) == [1, 2]
    with pytest.raises(ValueError, match="3"):
        W._together(spark, lambda: job(3, True, True), lambda: job(4, False, True), lambda: job(5, False, None))
    assert sorted(done) == [1, 2, 3, 4, 5]


def test_a_source_file_in_parts_keeps_each_case_in_order(spark, tmp_path):
    """Rows are dealt by their case to compressed parts of their file, and read back the last row of a case wins."""
    rows = [(f"I-200-{i % 40}-{1 + i % 7}", f"Emp {i}", "TAX ACCOUNTANT" if i % 3 else "Data Engineer", f"{1996 + i % 2}-03-04", i, f"lca_fy_{1996 + i % 2}.csv")
            for i in range(400)] + [(None, "No Case", "x", "1996-03-04", 400, "lca_fy_1996.csv")]
    raw = spark.createDataFrame(rows, "CASE_NUMBER string, EMPLOYER_NAME string, JOB_TITLE string, RECEIVED_DATE string, row_seq long, source_file string")
    raw = raw.select("*", *[F.lit(None).cast("string").alias(c) for c in ("DECISION_DATE", *FX.ODD_YEAR_LACKS)])
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    kept = spark.conf.get(coalesce)
    try:
        spark.conf.set(coalesce, "false")
        files = FX.raw_lca_as_files(raw.repartition(5), str(tmp_path / "raw"))
    finally:
        spark.conf.set(coalesce, kept)
    for year in (1996, 1997):
        assert len([f for f in files if f"lca_fy_{year}.csv/" in f and f.endswith(".csv.gz")]) > 1
    back = read_raw_csv(spark, files)
    staged = TR.stage_lca(back.withColumn("source_file", F.regexp_extract("source_path", "source_file=([^/]+)/", 1)))
    found = {(r.case_number, r.source_file): (r.employer_name, r.job_title, r.received_date) for r in staged.collect()}
    last = {}
    for case, employer, title, day, seq, file in rows:
        line, third = case and case[-1], title.startswith("TAX")
        if case is None or third and line in "56":
            continue
        last[case, file] = (f"Société {employer}" if line == "3" else employer, title.upper() + ("\nGRADE 2" if line == "2" else ""), dt.date.fromisoformat(day))
    assert found == last and len(last) > 200


def test_staging_from_files_runs_no_interpreted_methods(spark, limit, monkeypatch):
    """The staged rows are evaluated later, so the session's limit is set before."""
    raw = make_rows(spark, 20, seed=23, source_file="lca_fy_1996.csv")
    monkeypatch.setattr(context.fixtures, "raw_lca", lambda *_: raw)
    spark.conf.set(X.METHOD_LIMIT, "65535")
    assert context.staged_from_files(spark, "no folder").count() == 20
    assert int(spark.conf.get(X.METHOD_LIMIT)) <= 8000
