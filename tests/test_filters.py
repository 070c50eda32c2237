"""Cross-reference joins and dashboard filters on edge rows."""
from sponsorlens.operators import filters as FL


def test_mark_and_semi_joins_with_nulls(spark):
    s = spark.createDataFrame([("Acme", "15-1"), ("Beta", "15-2"), (None, "15-1")], "employer_name string, soc_code string")
    gc = spark.createDataFrame([("Acme", "15-9"), (None, "15-2"), ("Beta", "15-2")], "employer_name string, soc_code string")
    flags = {r.employer_name: r.gc_sponsor for r in FL.mark_gc_sponsor(s, gc).collect()}
    assert flags == {"Acme": True, "Beta": True, None: None}          # NULL employer: unknown, not false
    emp = sorted(r.employer_name for r in FL.semi_employer(s, gc).collect())
    assert emp == ["Acme", "Beta"]
    role = [(r.employer_name, r.soc_code) for r in FL.semi_employer_role(s, gc).collect()]
    assert role == [("Beta", "15-2")]
    counts = {r.employer_name: r.green_cards for r in FL.gc_counts(gc).collect()}
    assert counts["Acme"] == 1 and counts["Beta"] == 1


def test_filters_wildcards_and_flags(spark):
    s = spark.createDataFrame(
        [("A_B Corp", "DATA ENGINEER", True, 150000.0, "Certified - Withdrawn", "CA", 2025),
         ("AxB Corp", "DATA ANALYST", False, 50000.0, "Denied", "TX", 2024),
         ("100% Inc", "ENGINEER", False, None, "Certified", "CA", 2025)],
        "employer_name string, job_title string, is_university boolean, annual_wage double, "
        "case_status string, worksite_state string, fiscal_year int")

    def names(**kw):
        return sorted(r.employer_name for r in FL.apply_filters(s, FL.Filters(**kw)).collect())
    assert names(employer="a_b") == ["A_B Corp", "AxB Corp"]           # '_' stays a wildcard
    assert names(employer="100%") == ["100% Inc"]
    assert names(title="engineer") == ["100% Inc", "A_B Corp"]          # upper-cased, case-sensitive LIKE
    assert names(status="cert") == ["100% Inc", "A_B Corp"]             # Certified - Withdrawn counts
    assert names(status="den") == ["AxB Corp"]
    assert names(university="0") == ["100% Inc", "AxB Corp"]
    assert names(min_wage=0) == ["100% Inc", "A_B Corp", "AxB Corp"]     # 0 means no filter here
    assert names(min_wage=100000, state="CA", year=2025) == ["A_B Corp"]
