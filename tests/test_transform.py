"""Staging transform and keep-last dedup."""
from pyspark.sql import functions as F

from sponsorlens.operators import transform as TR
from sponsorlens.sources.sample import make_rows


def test_transform_dedupes_and_validates(spark):
    raw = make_rows(spark, 200, seed=1)
    dup = raw.limit(1).withColumn("row_seq", F.lit(10_000).cast("long"))   # same case, later row
    out = TR.stage_lca(raw.unionByName(dup))
    rows = out.collect()
    keys = [r.case_number for r in rows]
    assert len(keys) == len(set(keys)) == 200
    assert all(r.fiscal_year is not None for r in rows)
    assert all(10_000 <= r.annual_wage <= 5_000_000 for r in rows if r.annual_wage is not None)
    assert out.columns == TR.LCA_STAGED_COLUMNS


def _raw(spark, rows):
    cols = ["CASE_NUMBER", "EMPLOYER_NAME", "JOB_TITLE", "WORKSITE_CITY", "row_seq", "source_file"]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" if c != "row_seq" else "row_seq long" for c in cols))


def test_keep_last_per_file_and_validation(spark):
    raw = _raw(spark, [
        ("I-200-1", "Acme LLC", "dev", "x", 1, "a.csv"),
        ("I-200-1", "Acme Inc", "senior dev", "y", 2, "a.csv"),     # last row in file wins
        ("I-200-2", None, "dev", "x", 3, "a.csv"),                    # missing employer: dropped
        ("I-2", "Acme", "dev", "x", 4, "a.csv"),                      # five characters: dropped
        ("I-200-3", "Beta", "dev", None, 5, "a.csv"),                 # missing city stays NULL
        ("I-200-4", "Gamma", "dev", "z", 6, "a.csv"),
        ("I-200-4", None, "dev", "w", 7, "a.csv"),                    # invalid later row is dropped first
    ])
    out = {r.case_number: r for r in TR.stage_lca(raw).collect()}
    assert set(out) == {"I-200-1", "I-200-3", "I-200-4"}
    assert out["I-200-1"].job_title == "SENIOR DEV" and out["I-200-1"].employer_name_clean == "ACME"
    assert out["I-200-3"].worksite_city is None
    assert out["I-200-4"].worksite_city == "Z"
    assert out["I-200-1"].total_worker_positions == 1 and out["I-200-1"].full_time is False


def test_hot_key_dedup_is_partial(spark):
    """A key holding most rows is reduced before the shuffle (partial
    aggregate in the plan) and still yields one row."""
    raw = make_rows(spark, 3000, seed=3).withColumn("CASE_NUMBER", F.lit("I-200-HOT"))
    staged = TR.stage_lca(raw)
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert staged.count() == 1
    assert staged.first().case_number == "I-200-HOT"


def test_staging_shuffles_rows_once(spark):
    """Typing, keep-last and the derived columns take one shuffle of the rows and no copy in between."""
    raw = make_rows(spark, 50, seed=4).unionByName(make_rows(spark, 50, seed=4, source_file="b.csv"))
    staged = TR.stage_lca(raw)
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "WindowExec" not in plan
    assert staged.count() == 100


def test_rows_without_order_have_no_last(spark):
    raw = _raw(spark, [("I-200-1", "Acme", "a", "x", None, "a.csv"), ("I-200-2", "Acme", "b", "x", None, "a.csv"),
                       ("I-200-2", "Acme", "c", "x", 1, "a.csv")])
    assert [(r.case_number, r.job_title) for r in TR.stage_lca(raw).collect()] == [("I-200-2", "C")]


def test_rows_of_the_last_file(spark, tmp_path):
    """The last file of a case (by name) has its row; rows of no file are of none, and a last file whose rows
    lack their order leaves none. Only cases of several files are looked up, so that the rows stay where they are."""
    rows = [("I-1", "a.csv", 1, "x"), ("I-1", "b.csv", 2, "x"), ("I-2", "a.csv", 3, "x"), ("I-3", None, 4, "x"), ("I-4", None, 5, "x"),
            ("I-4", "a.csv", 6, "x"), ("I-5", "a.csv", 7, "x"), ("I-5", "b.csv", 8, None)]
    path = str(tmp_path / "staged")
    spark.createDataFrame(rows, "case_number string, source_file string, n long, employer_name string").write.parquet(path)
    last = TR.of_last_file(spark.read.parquet(path))
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert sorted(r.n for r in last.collect()) == [2, 3, 6]
    assert last.columns == ["case_number", "source_file", "n", "employer_name"]


def test_perm_candidates(spark):
    raw = spark.createDataFrame(
        [("A-100-1", "Certified", "2024-10-05", "Acme LLC", "15-1252.00", "90,000", "Year", 1, "perm.csv")],
        "CASE_NO string, CASE_STATUS string, CASE_RECEIVED_DATE string, EMPLOYER_NAME_9089 string, "
        "PW_SOC_CODE_9089 string, WAGE_OFFER_FROM_9089 string, WAGE_OFFER_UNIT_OF_PAY_9089 string, "
        "row_seq long, source_file string")
    r = TR.stage_perm(raw).first()
    assert r.case_number == "A-100-1" and r.soc_code == "15-1252" and r.annual_wage == 90000.0
    assert r.fiscal_year == 2025 and r.employer_name_clean == "ACME" and r.job_title is None
    assert r.job_category == "Other"
