"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame``
per operator or question, and the DuckDB SQL that must give the same rows.

Every query reads the warehouse that ``context.loaded`` builds from the
driver's tables at ``sf_dir`` (the full pipeline), so its work grows with the
data. Parameters (year 1998, thresholds, search texts) are fixed per entry;
the functions themselves take them as arguments.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as _S
from ..operators import audits as AU
from ..operators import filters as FL
from ..functions.jobboard import split_list
from ..session import new_dir
from ..sources import fixtures as FX, landing as LD, links as LK, postings as PO, sinks as SK
from ..sources.raw import route_of
from . import api, context, dashboard as H, jobs as J, library as L, views
from .oracle import AS_FILES, BY_SHIP_YEAR, RAW_LCA, with_views

Spark = Callable[[SparkSession, str], DataFrame]
YEAR = 1998

_REG: dict[str, tuple[Spark, str | None]] = {}


def register(name: str, sql: str | None, chain: str = RAW_LCA):
    def deco(fn: Spark) -> Spark:
        _REG[name] = (fn, with_views(sql, chain) if sql else None)
        return fn
    return deco


def _ld(spark, sf):
    return context.loaded(spark, sf)


def _v1(spark, sf, cols=None, extra=()):
    return views.sponsorships(_ld(spark, sf).wh, cols, extra)


def _s(spark, sf):
    return _ld(spark, sf).sponsorships()


def _gc(spark, sf):
    return _ld(spark, sf).green_cards()


CERT = "case_status ILIKE 'Certified%'"


def rhu(x: str, d: int) -> str:
    return f"floor(({x}) * {10 ** d} + 0.5) / {10 ** d}.0"


def pct_sql(part: str, whole: str, d: int) -> str:
    return rhu(f"100.0::DOUBLE * ({part}) / NULLIF(({whole})::DOUBLE, 0)", d)


# ---------------------------------------------------------------------------
# Query library Q1-Q20
# ---------------------------------------------------------------------------
@register("q01_software_engineers_in_year", f"""
SELECT employer_name, COUNT(*) AS filings FROM v1
WHERE job_title LIKE '%SOFTWARE ENGINEER%' AND fiscal_year = {YEAR} AND {CERT}
GROUP BY 1""")
def q01(spark, sf):
    return L.q1_software_engineers_in_year(_v1(spark, sf, ["employer_name", "job_title", "fiscal_year", "case_status"]), YEAR)


@register("q02_h1b_above_180k", """
SELECT employer_name, job_title, annual_wage, worksite_city, worksite_state FROM v1
WHERE visa_class = 'H-1B' AND annual_wage > 180000""")
def q02(spark, sf):
    return L.q2_h1b_above(_v1(spark, sf, ["employer_name", "job_title", "annual_wage", "worksite_city",
                                          "worksite_state", "visa_class"]))


@register("q03_universities_software", """
SELECT employer_name, COUNT(*) AS filings, ROUND(AVG(annual_wage), 0) AS avg_wage FROM v1
WHERE is_university AND job_title LIKE '%SOFTWARE ENGINEER%' GROUP BY 1""")
def q03(spark, sf):
    return L.q3_universities_software(_v1(spark, sf, ["employer_name", "is_university", "job_title", "annual_wage"]))


@register("q04_data_engineers_ohio", """
SELECT employer_name, COUNT(*) AS filings, ROUND(MEDIAN(annual_wage), 0) AS median_wage FROM v1
WHERE job_title LIKE '%DATA ENGINEER%' AND worksite_state = 'OH' GROUP BY 1""")
def q04(spark, sf):
    return L.q4_title_in_state_median(_v1(spark, sf, ["employer_name", "job_title", "worksite_state", "annual_wage"]))


@register("q05_ai_ml_california", """
SELECT employer_name, COUNT(*) AS filings, ROUND(AVG(annual_wage), 0) AS avg_wage FROM v1
WHERE job_category = 'AI/ML' AND worksite_state = 'CA' GROUP BY 1""")
def q05(spark, sf):
    return L.q5_category_in_state(_v1(spark, sf, ["employer_name", "job_category", "worksite_state", "annual_wage"]))


@register("q06_top_filers", f"""
SELECT employer_name, COUNT(*) AS total_filings, COUNT(*) FILTER (WHERE {CERT}) AS certified,
       {pct_sql(f"COUNT(*) FILTER (WHERE {CERT})", "COUNT(*)", 1)} AS cert_rate_pct
FROM v1 GROUP BY 1 ORDER BY total_filings DESC, employer_name LIMIT 50""")
def q06(spark, sf):
    return L.q6_top_filers(_v1(spark, sf, ["employer_name", "case_status"]))


@register("q07_wage_by_state", """
SELECT worksite_state, COUNT(*) AS filings, ROUND(AVG(annual_wage), 0) AS avg_wage,
       ROUND(MEDIAN(annual_wage), 0) AS median_wage
FROM v1 WHERE annual_wage IS NOT NULL GROUP BY 1""")
def q07(spark, sf):
    return L.q7_wage_by_state(_v1(spark, sf, ["worksite_state", "annual_wage"]))


@register("q08_wage_by_city", """
SELECT worksite_city, worksite_state, COUNT(*) AS filings, ROUND(MEDIAN(annual_wage), 0) AS median_wage
FROM v1 GROUP BY 1, 2 HAVING COUNT(*) >= 20""")
def q08(spark, sf):
    return L.q8_wage_by_city(_v1(spark, sf, ["worksite_city", "worksite_state", "annual_wage"]))


@register("q09_wage_by_employer_occupation", """
SELECT employer_name, soc_title, COUNT(*) AS filings, ROUND(AVG(annual_wage), 0) AS avg_wage
FROM v1 GROUP BY 1, 2 HAVING COUNT(*) >= 5""")
def q09(spark, sf):
    return L.q9_wage_by_employer_occupation(_v1(spark, sf, ["employer_name", "soc_title", "annual_wage"]))


YEARLY_SQL = """yearly AS (SELECT employer_name, fiscal_year, COUNT(*) AS filings FROM v1 GROUP BY 1, 2),
yoy AS (SELECT employer_name, fiscal_year, filings,
               filings - LAG(filings) OVER (PARTITION BY employer_name ORDER BY fiscal_year ASC NULLS LAST) AS yoy_change
        FROM yearly)"""


@register("q10_growing_sponsors", f""", {YEARLY_SQL}
SELECT * FROM yoy WHERE yoy_change > 0""")
def q10(spark, sf):
    return L.q10_growing_sponsors(_v1(spark, sf, ["employer_name", "fiscal_year"]))


@register("q11_head_to_head", """
SELECT fiscal_year, COUNT(*) FILTER (WHERE employer_name ILIKE '%1%') AS has_1,
       COUNT(*) FILTER (WHERE employer_name ILIKE '%UNIVERSITY%') AS university
FROM v1 GROUP BY 1""")
def q11(spark, sf):
    return L.q11_head_to_head(_v1(spark, sf, ["employer_name", "fiscal_year"]), "1", "UNIVERSITY",
                              ("has_1", "university"))


@register("q12_jobs_above_200k", """
SELECT employer_name, job_title, annual_wage, worksite_city, worksite_state, fiscal_year FROM v1
WHERE annual_wage >= 200000""")
def q12(spark, sf):
    return L.q12_jobs_above(_v1(spark, sf, ["employer_name", "job_title", "annual_wage", "worksite_city",
                                            "worksite_state", "fiscal_year"]))


@register("q13_wage_premium", """
SELECT employer_name, COUNT(*) AS filings, ROUND(AVG(annual_wage - prevailing_wage), 0) AS avg_premium
FROM v1 WHERE annual_wage IS NOT NULL AND prevailing_wage IS NOT NULL
GROUP BY 1 HAVING COUNT(*) >= 10""")
def q13(spark, sf):
    return L.q13_wage_premium(_v1(spark, sf, ["employer_name", "annual_wage", "prevailing_wage"]))


@register("q14_denial_rate", f"""
SELECT employer_name, COUNT(*) AS filings,
       {pct_sql("COUNT(*) FILTER (WHERE case_status = 'Denied')", "COUNT(*)", 2)} AS denial_rate_pct
FROM v1 GROUP BY 1 HAVING COUNT(*) >= 20""")
def q14(spark, sf):
    return L.q14_denial_rate(_v1(spark, sf, ["employer_name", "case_status"]))


@register("q15_category_mix", """
SELECT worksite_state, job_category, COUNT(*) AS filings FROM v1 GROUP BY 1, 2""")
def q15(spark, sf):
    return L.q15_category_mix(_v1(spark, sf, ["worksite_state", "job_category"]))


@register("q16_top_paying_occupations", """
SELECT soc_code, soc_title, COUNT(*) AS filings, ROUND(MEDIAN(annual_wage), 0) AS median_wage
FROM v1 GROUP BY 1, 2 HAVING COUNT(*) >= 10""")
def q16(spark, sf):
    return L.q16_top_paying_occupations(_v1(spark, sf, ["soc_code", "soc_title", "annual_wage"]))


@register("q17_monthly_volume", """
SELECT CAST(date_trunc('month', received_date) AS TIMESTAMP) AS month, COUNT(*) AS filings
FROM lca_fact GROUP BY 1""")
def q17(spark, sf):
    return L.q17_monthly_volume(_ld(spark, sf).wh.read("lca_filings"))


@register("q18_recent_runs", """
SELECT 'lca' AS source, source_file AS file_name, COUNT(*) AS rows_loaded, 'success' AS status, CAST(NULL AS VARCHAR) AS error
FROM lca_staged GROUP BY 2
UNION ALL SELECT 'perm', source_file, COUNT(*), 'success', NULL FROM perm_staged GROUP BY 2""")
def q18(spark, sf):
    """Without run ids and times, which differ from run to run."""
    return L.q18_recent_runs(_ld(spark, sf).wh.read("etl_runs")).select("source", "file_name", "rows_loaded", "status", "error")


@register("q19_university_vs_corporate", """
SELECT soc_title,
       ROUND(MEDIAN(annual_wage) FILTER (WHERE is_university), 0) AS university_median,
       ROUND(MEDIAN(annual_wage) FILTER (WHERE NOT is_university), 0) AS corporate_median
FROM v1 GROUP BY 1 HAVING COUNT(*) >= 20""")
def q19(spark, sf):
    return L.q19_university_vs_corporate(_v1(spark, sf, ["soc_title", "is_university", "annual_wage"]))


@register("q20_full_vs_part_time", """
SELECT employer_name, COUNT(*) FILTER (WHERE full_time) AS full_time_n,
       COUNT(*) FILTER (WHERE NOT full_time) AS part_time_n
FROM v1 GROUP BY 1 ORDER BY part_time_n DESC, employer_name LIMIT 25""")
def q20(spark, sf):
    return L.q20_full_vs_part_time(_v1(spark, sf, ["employer_name", "full_time"]))


# ---------------------------------------------------------------------------
# Views V1-V3
# ---------------------------------------------------------------------------
@register("v1_sponsorships", "SELECT * FROM v1")
def v1(spark, sf):
    return _v1(spark, sf)


@register("v2_employer_yearly", "SELECT * FROM v2")
def v2(spark, sf):
    return views.employer_yearly(_ld(spark, sf).wh)


@register("v3_perm", "SELECT * FROM v3")
def v3(spark, sf):
    return views.perm(_ld(spark, sf).wh)


# ---------------------------------------------------------------------------
# Service questions P1-P7
# ---------------------------------------------------------------------------
@register("p1_health", """SELECT 'ok' AS status, COUNT(*) AS "rows" FROM lca_fact""")
def p1(spark, sf):
    return api.health(_ld(spark, sf).wh.read("lca_filings"))


@register("p2_employer_search", """
SELECT employer_name, fiscal_year, filings, certified, avg_wage, median_wage FROM v2
WHERE employer_name ILIKE '%university%'
ORDER BY fiscal_year DESC, filings DESC, employer_name LIMIT 50""")
def p2(spark, sf):
    return api.employers(views.employer_yearly(_ld(spark, sf).wh), search="university", limit=50)


@register("p3_employer_totals", """
SELECT employer_name, CAST(SUM(filings) AS BIGINT) AS total_filings, ROUND(AVG(median_wage), 0) AS median_wage
FROM v2 GROUP BY 1 ORDER BY total_filings DESC, employer_name LIMIT 50""")
def p3(spark, sf):
    return api.employers(views.employer_yearly(_ld(spark, sf).wh), limit=50)


@register("p4_sponsors_search", """
SELECT * FROM v1
WHERE job_title ILIKE '%engineer%' AND worksite_state = 'CA' AND annual_wage >= 100000.0
ORDER BY annual_wage DESC NULLS LAST, case_number LIMIT 100""")
def p4(spark, sf):
    return api.sponsors(_v1(spark, sf), title="engineer", state="ca", min_wage=100000, limit=100)


@register("p4_sponsors_year_category", f"""
SELECT * FROM v1
WHERE fiscal_year = {YEAR} AND job_category = 'Data' AND annual_wage >= 0.0
ORDER BY annual_wage DESC NULLS LAST, case_number LIMIT 1000""")
def p4b(spark, sf):
    return api.sponsors(_v1(spark, sf), min_wage=0, year=YEAR, category="Data", limit=1000)


def _salary_sql(expr: str) -> str:
    return f"""
SELECT {expr} AS grp, COUNT(*) AS filings, ROUND(AVG(annual_wage), 0) AS avg_wage,
       ROUND(MEDIAN(annual_wage), 0) AS median_wage
FROM v1 WHERE annual_wage IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= 5
ORDER BY median_wage DESC NULLS LAST, grp LIMIT 200"""


_SALARY_COLS = {"state": ["worksite_state"], "city": ["worksite_city", "worksite_state"],
                "employer": ["employer_name"], "occupation": ["soc_title"]}


def _salary(group):
    def fn(spark, sf):
        return api.salary(_v1(spark, sf, _SALARY_COLS[group] + ["annual_wage"]), group)
    return fn


for _g, _expr in [("state", "worksite_state"), ("city", "worksite_city || ', ' || worksite_state"),
                  ("employer", "employer_name"), ("occupation", "soc_title")]:
    register(f"p5_salary_by_{_g}", _salary_sql(_expr))(_salary(_g))


@register("p6_universities", """
SELECT employer_name, COUNT(*) AS filings, ROUND(MEDIAN(annual_wage), 0) AS median_wage FROM v1
WHERE is_university GROUP BY 1 ORDER BY filings DESC, employer_name LIMIT 100""")
def p6(spark, sf):
    return api.universities(_v1(spark, sf, ["employer_name", "is_university", "annual_wage"]))


@register("p7_yoy_growth", f""", {YEARLY_SQL}
SELECT * FROM yoy WHERE yoy_change IS NOT NULL
ORDER BY yoy_change DESC, employer_name, fiscal_year LIMIT 50""")
def p7(spark, sf):
    return api.yoy_growth(_v1(spark, sf, ["employer_name", "fiscal_year"]))


# ---------------------------------------------------------------------------
# Dashboard H1-H10 and cross-references E7-E10
# ---------------------------------------------------------------------------
@register("h1_facet_states", "SELECT DISTINCT worksite_state FROM sponsorships WHERE worksite_state IS NOT NULL")
def h1a(spark, sf):
    return H.facet_states(_s(spark, sf))


@register("h1_facet_categories", "SELECT DISTINCT job_category FROM sponsorships")
def h1b(spark, sf):
    return H.facet_categories(_s(spark, sf))


@register("h1_facet_years", "SELECT DISTINCT fiscal_year FROM sponsorships WHERE fiscal_year IS NOT NULL")
def h1c(spark, sf):
    return H.facet_years(_s(spark, sf))


@register("h1_facet_visas", "SELECT DISTINCT visa_class FROM sponsorships WHERE visa_class IS NOT NULL")
def h1d(spark, sf):
    return H.facet_visas(_s(spark, sf))


def _kpi_sql(where: str) -> str:
    return f"""
SELECT COUNT(*) AS filings, {pct_sql(f"COUNT(*) FILTER (WHERE {CERT})", "COUNT(*)", 1)} AS cert,
       ROUND(MEDIAN(annual_wage), 0) AS med, COUNT(DISTINCT employer_name) AS emps
FROM sponsorships {where}"""


FILTERED = FL.Filters(title="engineer", status="cert", min_wage=50000)
FILTERED_WHERE = f"WHERE job_title LIKE '%ENGINEER%' AND annual_wage >= 50000.0 AND {CERT}"


@register("h2_kpis", _kpi_sql(""))
def h2a(spark, sf):
    return H.kpis(_s(spark, sf))


@register("h2_kpis_filtered", _kpi_sql(FILTERED_WHERE))
def h2b(spark, sf):
    return H.kpis(FL.apply_filters(_s(spark, sf), FILTERED))


UNI_FILTER = FL.Filters(university="1", year=YEAR)


@register("h3_top_employers", f"""
SELECT employer_name, COUNT(*) AS filings FROM sponsorships WHERE is_university AND fiscal_year = {YEAR}
GROUP BY 1 ORDER BY filings DESC, employer_name LIMIT 50""")
def h3(spark, sf):
    return H.top_employers(FL.apply_filters(_s(spark, sf), UNI_FILTER))


@register("h4_state_medians", f"""
SELECT worksite_state, MEDIAN(annual_wage) AS median_wage FROM sponsorships {FILTERED_WHERE}
GROUP BY 1 HAVING COUNT(*) >= 3 ORDER BY median_wage DESC NULLS LAST, worksite_state LIMIT 12""")
def h4(spark, sf):
    return H.state_medians(FL.apply_filters(_s(spark, sf), FILTERED))


@register("h5_filings_by_year", """
SELECT fiscal_year, COUNT(*) AS filings FROM sponsorships WHERE visa_class = 'H-1B'
GROUP BY 1 HAVING fiscal_year IS NOT NULL""")
def h5(spark, sf):
    return H.by_year(FL.apply_filters(_s(spark, sf), FL.Filters(visa="H-1B")))


ROW_ORDER_SQL = ("annual_wage DESC NULLS LAST, employer_name, job_title, worksite_city, worksite_state, "
                 "fiscal_year, case_status, annual_wage")
GC_EMP = "employer_name IN (SELECT DISTINCT employer_name FROM green_cards)"


@register("h6_row_view_gc", f"""
SELECT employer_name, job_title, worksite_city, worksite_state, fiscal_year, case_status, annual_wage,
       {GC_EMP} AS gc_sponsor
FROM sponsorships WHERE {GC_EMP} AND worksite_state = 'TX'
ORDER BY {ROW_ORDER_SQL} LIMIT 2000""")
def h6(spark, sf):
    gc = _gc(spark, sf)
    s = FL.apply_filters(_s(spark, sf), FL.Filters(green_card="emp", state="TX"), gc)
    return H.row_view(s, "wage_desc", gc)


@register("h6_row_view_by_year", f"""
SELECT employer_name, job_title, worksite_city, worksite_state, fiscal_year, case_status, annual_wage,
       {GC_EMP} AS gc_sponsor
FROM sponsorships WHERE job_category = 'AI/ML'
ORDER BY fiscal_year DESC NULLS LAST, annual_wage DESC NULLS LAST, employer_name, job_title, worksite_city,
         worksite_state, fiscal_year, case_status, annual_wage LIMIT 2000""")
def h6b(spark, sf):
    gc = _gc(spark, sf)
    s = FL.apply_filters(_s(spark, sf), FL.Filters(category="AI/ML"), gc)
    return H.row_view(s, "year_desc", gc)


@register("h7_grouped_view", f"""
SELECT employer_name, job_title, worksite_city, worksite_state, fiscal_year, COUNT(*) AS approved,
       ROUND(MEDIAN(annual_wage), 0) AS median_wage,
       (SELECT COUNT(*) FROM green_cards g WHERE g.employer_name = s.employer_name) AS green_cards
FROM sponsorships s WHERE {CERT}
GROUP BY 1, 2, 3, 4, 5
ORDER BY approved DESC, employer_name, job_title, worksite_city, worksite_state, fiscal_year LIMIT 2000""")
def h7(spark, sf):
    return H.grouped_view(_s(spark, sf), "approved_desc", _gc(spark, sf))


@register("h7_grouped_all", f"""
SELECT employer_name, job_title, worksite_city, worksite_state, fiscal_year, COUNT(*) AS approved,
       ROUND(MEDIAN(annual_wage), 0) AS median_wage,
       (SELECT COUNT(*) FROM green_cards g WHERE g.employer_name = s.employer_name) AS green_cards
FROM sponsorships s WHERE {CERT}
GROUP BY 1, 2, 3, 4, 5""")
def h7b(spark, sf):
    return H.grouped_view(_s(spark, sf), "approved_desc", _gc(spark, sf), limit=None)


@register("h8_suggest_employers", """
SELECT employer_name AS v, COUNT(*) AS n FROM sponsorships WHERE employer_name ILIKE '%00001%'
GROUP BY 1 ORDER BY n DESC, v LIMIT 3""")
def h8a(spark, sf):
    return H.suggestions(_s(spark, sf), "employer_name", "00001")


@register("h8_suggest_titles", """
SELECT job_title AS v, COUNT(*) AS n FROM sponsorships WHERE job_title ILIKE '%eng%'
GROUP BY 1 ORDER BY n DESC, v LIMIT 3""")
def h8b(spark, sf):
    return H.suggestions(_s(spark, sf), "job_title", " eng ")


@register("h9_download", f"""
SELECT employer_name, job_title, job_category, soc_code, soc_title, worksite_city, worksite_state,
       fiscal_year, visa_class, case_status, annual_wage, prevailing_wage, is_university,
       {GC_EMP} AS green_card_sponsor
FROM sponsorships WHERE NOT is_university AND visa_class = 'H-1B'
ORDER BY fiscal_year DESC NULLS LAST, annual_wage DESC NULLS LAST, employer_name, job_title, worksite_city, worksite_state,
         fiscal_year, case_status, annual_wage, job_category, soc_code, soc_title, visa_class, prevailing_wage, is_university
LIMIT 100000""")
def h9(spark, sf):
    gc = _gc(spark, sf)
    s = FL.apply_filters(_s(spark, sf), FL.Filters(university="0", visa="H-1B"), gc)
    return H.download_rows(s, "year_desc", gc)


CONSOLE_SQL = H.DEFAULT_CONSOLE_SQL.replace("filings DESC", "filings DESC, employer_name")    # a total order


@register("h10_console_default", CONSOLE_SQL)
def h10(spark, sf):
    ld = _ld(spark, sf)
    from ..sources.sinks import register_extracts
    register_extracts(spark, ld.sponsorships_path, ld.green_cards_path)
    return H.console(spark, CONSOLE_SQL)


@register("e7_semi_join_employer", f"SELECT * FROM sponsorships WHERE {GC_EMP}")
def e7(spark, sf):
    return FL.semi_employer(_s(spark, sf), _gc(spark, sf))


@register("e8_semi_join_employer_role", """
SELECT * FROM sponsorships WHERE (employer_name, soc_code) IN (SELECT DISTINCT employer_name, soc_code FROM green_cards)""")
def e8(spark, sf):
    return FL.semi_employer_role(_s(spark, sf), _gc(spark, sf))


@register("e9_mark_join_gc_sponsor", f"SELECT *, {GC_EMP} AS gc_sponsor FROM sponsorships")
def e9(spark, sf):
    return FL.mark_gc_sponsor(_s(spark, sf), _gc(spark, sf))


@register("e10_scalar_count_green_cards", """
SELECT employer_name, COUNT(*) AS filings,
       (SELECT COUNT(*) FROM green_cards g WHERE g.employer_name = s.employer_name) AS green_cards
FROM sponsorships s GROUP BY employer_name""")
def e10(spark, sf):
    s = _s(spark, sf).groupBy("employer_name").agg(F.count("*").alias("filings"))
    return (s.join(FL.gc_counts(_gc(spark, sf)), "employer_name", "left")
             .withColumn("green_cards", F.coalesce("green_cards", F.lit(0).cast("long"))))


# ---------------------------------------------------------------------------
# Staging, dimensions, facts, run log, audits
# ---------------------------------------------------------------------------
@register("b1_staged_lca", "SELECT * FROM lca_staged")
def b1(spark, sf):
    return _ld(spark, sf).staged_lca


@register("b2_staged_perm", "SELECT * FROM perm_staged")
def b2(spark, sf):
    return _ld(spark, sf).staged_perm


@register("d2_employers", "SELECT employer_name_clean, employer_name, is_university, first_seen_date FROM employers")
def d2e(spark, sf):
    return _ld(spark, sf).wh.read("employers").drop("employer_id", "naics_code")


@register("d2_occupations", "SELECT soc_code, soc_title, job_category FROM occupations")
def d2o(spark, sf):
    return _ld(spark, sf).wh.read("occupations").drop("occupation_id")


@register("d2_locations", """
SELECT DISTINCT worksite_city AS city, worksite_state AS state, worksite_postal_code AS postal_code
FROM (SELECT worksite_city, worksite_state, worksite_postal_code FROM lca_staged
      UNION ALL SELECT worksite_city, worksite_state, worksite_postal_code FROM perm_staged)""")
def d2l(spark, sf):
    return _ld(spark, sf).wh.read("locations").drop("location_id")


FACT_NATURAL = ("case_number, case_status, visa_class, received_date, decision_date, fiscal_year, job_title, "
                "full_time, annual_wage, prevailing_wage, wage_unit_raw, total_worker_positions, source_file")


@register("d4_lca_fact", f"SELECT {FACT_NATURAL} FROM lca_fact")
def d4(spark, sf):
    return _ld(spark, sf).wh.read("lca_filings").select(*[c.strip() for c in FACT_NATURAL.split(",")])


@register("d8_perm_fact", """
SELECT case_number, case_status, received_date, decision_date, fiscal_year, job_title, annual_wage, source_file
FROM perm_fact""")
def d8(spark, sf):
    return _ld(spark, sf).wh.read("perm_filings").select(
        "case_number", "case_status", "received_date", "decision_date", "fiscal_year", "job_title",
        "annual_wage", "source_file")


@register("a1_staged_from_files", "SELECT * FROM lca_staged", AS_FILES)
def a1(spark, sf):
    """CSV files of two header layouts, with line breaks in cells, month-first
    dates, non-ASCII names, missing employers and short case numbers (A1, A2, A4, A6, B3, B4)."""
    return context.staged_from_files(spark, sf)


@register("d4_reloaded_fact", f"SELECT {FACT_NATURAL} FROM lca_fact", BY_SHIP_YEAR)
def d4b(spark, sf):
    """Cases in several files, loaded in two batches, the last one twice: the last file's row stays."""
    return context.reloaded(spark, sf).read("lca_filings").select(*[c.strip() for c in FACT_NATURAL.split(",")])


@register("d2_reloaded_employers", """
SELECT employer_name_clean, min(employer_name) AS employer_name, bool_or(is_university) AS is_university
FROM (SELECT *, CASE WHEN source_file <= 'lca_ship_1995.csv' THEN 0 ELSE 1 END AS batch FROM lca_staged
      QUALIFY dense_rank() OVER (PARTITION BY employer_name_clean ORDER BY source_file) = 1)
GROUP BY 1""", BY_SHIP_YEAR)
def d2r(spark, sf):
    """Later loads add new employers and change none."""
    return context.reloaded(spark, sf).read("employers").select("employer_name_clean", "employer_name", "is_university")


@register("d3_surrogate_keys", """
SELECT 'employers' AS table_name, COUNT(*) AS n, CAST(1 AS BIGINT) AS least, COUNT(*) AS most, COUNT(*) AS ids
FROM (SELECT DISTINCT employer_name_clean FROM lca_staged)
UNION ALL SELECT 'locations', COUNT(*), 1, COUNT(*), COUNT(*)
FROM (SELECT DISTINCT worksite_city, worksite_state, worksite_postal_code FROM lca_staged)
UNION ALL SELECT 'occupations', COUNT(*), 1, COUNT(*), COUNT(*)
FROM (SELECT DISTINCT soc_code FROM lca_staged WHERE soc_code IS NOT NULL)""", BY_SHIP_YEAR)
def d3(spark, sf):
    """Ids of a reloaded warehouse: 1 to n, without gaps (D3)."""
    wh = context.reloaded(spark, sf)
    parts = [wh.read(t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n"), F.min(c).cast("long").alias("least"),
                            F.max(c).cast("long").alias("most"), F.count_distinct(c).alias("ids"))
             for t, c in _S.SURROGATE_KEYS.items() if t in ("employers", "locations", "occupations")]
    return parts[0].union(parts[1]).union(parts[2])


@register("g19_rows_per_source_file", """
SELECT file_name, rows_loaded FROM (
  SELECT source_file AS file_name, COUNT(*) AS rows_loaded FROM lca_staged GROUP BY 1
  UNION ALL SELECT source_file, COUNT(*) FROM perm_staged GROUP BY 1)""")
def g19(spark, sf):
    return (_ld(spark, sf).wh.read("etl_runs").where(F.col("status") == "success")
            .select("file_name", "rows_loaded"))


@register("c1_key_uniqueness", """
SELECT 'employers' AS table_name, 'employer_name_clean' AS key_columns,
       (SELECT COUNT(*) FROM (SELECT employer_name_clean FROM employers GROUP BY 1 HAVING COUNT(*) > 1)) AS duplicate_keys
UNION ALL SELECT 'occupations', 'soc_code',
       (SELECT COUNT(*) FROM (SELECT soc_code FROM occupations GROUP BY 1 HAVING COUNT(*) > 1))
UNION ALL SELECT 'lca_filings', 'case_number',
       (SELECT COUNT(*) FROM (SELECT case_number FROM lca_fact GROUP BY 1 HAVING COUNT(*) > 1))
UNION ALL SELECT 'perm_filings', 'case_number',
       (SELECT COUNT(*) FROM (SELECT case_number FROM perm_fact GROUP BY 1 HAVING COUNT(*) > 1))
UNION ALL SELECT 'lineitem', 'l_orderkey',
       (SELECT COUNT(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1))""")
def c1(spark, sf):
    """The warehouse's keys, and one that does repeat: lines by their order."""
    keys = AU.key_uniqueness(_ld(spark, sf).wh, ["employers", "occupations", "lca_filings", "perm_filings"], natural=True)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    return keys.unionByName(AU.duplicate_keys(lines, "lineitem", ["l_orderkey"]))


@register("c2_foreign_keys", """
SELECT 'lca_filings' AS table_name, 'employer_id' AS column_name,
       (SELECT COUNT(*) FROM lca_fact WHERE employer_name_clean NOT IN (SELECT employer_name_clean FROM employers)) AS orphan_rows
UNION ALL SELECT 'lca_filings', 'occupation_id',
       (SELECT COUNT(*) FROM lca_fact WHERE soc_code IS NOT NULL AND soc_code NOT IN (SELECT soc_code FROM occupations))
UNION ALL SELECT 'perm_filings', 'employer_id',
       (SELECT COUNT(*) FROM perm_fact WHERE employer_name_clean NOT IN (SELECT employer_name_clean FROM employers))
UNION ALL SELECT 'perm_filings', 'occupation_id',
       (SELECT COUNT(*) FROM perm_fact WHERE soc_code IS NOT NULL AND soc_code NOT IN (SELECT soc_code FROM occupations))
UNION ALL SELECT 'lineitem', 'l_partkey',
       (SELECT COUNT(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10))""")
def c2(spark, sf):
    """The warehouse's references, and one with orphans: lines of parts that the large parts don't hold."""
    large = spark.read.parquet(f"{sf}/part.parquet").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    lines = AU.orphans(spark.read.parquet(f"{sf}/lineitem.parquet"), "lineitem", "l_partkey", large)
    return lines.unionByName(AU.foreign_keys(_ld(spark, sf).wh, [("lca_filings", "employer_id"), ("lca_filings", "occupation_id"),
                                               ("perm_filings", "employer_id"), ("perm_filings", "occupation_id")]))


@register("c3_not_null_and_bounds", f"""
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE case_number IS NULL) AS null_case_number,
       COUNT(*) FILTER (WHERE fiscal_year IS NULL) AS null_fiscal_year,
       COUNT(*) FILTER (WHERE annual_wage IS NULL) AS null_annual_wage,
       COUNT(*) FILTER (WHERE prevailing_wage IS NULL) AS null_prevailing_wage,
       COUNT(*) FILTER (WHERE annual_wage IS NOT NULL AND NOT (annual_wage BETWEEN 10000 AND 5000000)) AS annual_wage_out_of_bounds,
       COUNT(*) FILTER (WHERE prevailing_wage IS NOT NULL AND NOT (prevailing_wage BETWEEN 10000 AND 5000000)) AS prevailing_wage_out_of_bounds
FROM lca_fact""")
def c3(spark, sf):
    return AU.lca_quality(_ld(spark, sf).wh.read("lca_filings"))


# ---------------------------------------------------------------------------
# Job boards (J1), link discovery
# ---------------------------------------------------------------------------

ROLE = "widget"


def _norm_sql(x: str) -> str:
    words = "|".join(_S.JOB_BOARD_STOPWORDS)
    return (f"trim(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9 ]', ' ', 'g'), "
            f"'\\b({words})\\b', '', 'g'))")


_KNOWN_VALUES = ", ".join(f"('{k}', '{kind}', '{slug}', {i})" for i, (k, kind, slug) in enumerate(_S.JOB_BOARDS))
JOBS_SQL = f""", top_emp AS (SELECT employer_name, COUNT(*) AS n FROM sponsorships GROUP BY 1
                ORDER BY n DESC, employer_name LIMIT 50),
known AS (SELECT * FROM (VALUES {_KNOWN_VALUES}) t(key, kind, slug, ordinal)),
boards AS (SELECT key, kind, slug, CAST(ordinal AS BIGINT) AS ordinal FROM known
           UNION ALL
           SELECT {_norm_sql('c_name')}, CASE c_custkey % 3 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'lever' ELSE 'ashby' END,
                  'cust-' || CAST(c_custkey AS VARCHAR), {len(_S.JOB_BOARDS)} + c_custkey
           FROM customer),
emp AS (SELECT employer_name FROM top_emp UNION ALL SELECT n_name FROM nation),
en AS (SELECT employer_name, {_norm_sql('employer_name')} AS n FROM emp),
matched AS (SELECT en.employer_name, b.kind, b.slug FROM en JOIN boards b
            ON en.n <> '' AND b.key <> '' AND (en.n = b.key OR contains(en.n, b.key) OR contains(b.key, en.n))
            QUALIFY row_number() OVER (PARTITION BY en.employer_name ORDER BY b.ordinal) = 1),
postings AS (SELECT CASE o.o_custkey % 3 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'lever' ELSE 'ashby' END AS kind,
                    'cust-' || CAST(o.o_custkey AS VARCHAR) AS slug, l.l_orderkey * 8 + l.l_linenumber AS pos,
                    upper(p.p_name) AS title,
                    'https://jobs.example/' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS url,
                    COALESCE(p.p_brand, '') AS loc
             FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
             JOIN part p ON p.p_partkey = l.l_partkey),
hits AS (SELECT * FROM postings WHERE contains(lower(title), '{ROLE}'))"""


def _jobs_inputs(spark, sf):
    """The page's top employers, and the nations: employers without a board."""
    nations = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_name").alias("employer_name"))
    employers = H.top_employers(_s(spark, sf)).select("employer_name").union(nations)
    return employers, PO.fixture_boards(spark, sf), PO.fixture_postings(spark, sf)


@register("j1_open_roles", JOBS_SQL + """
SELECT t.employer_name, m.kind AS board_kind, m.slug AS board_slug, m.kind IS NOT NULL AS has_feed,
       CASE WHEN m.kind IS NOT NULL THEN COALESCE(h.c, 0) END AS open_roles
FROM emp t LEFT JOIN matched m USING (employer_name)
LEFT JOIN (SELECT kind, slug, COUNT(*) AS c FROM hits GROUP BY 1, 2) h ON h.kind = m.kind AND h.slug = m.slug""")
def j1(spark, sf):
    return J.open_roles(*_jobs_inputs(spark, sf), role=ROLE)


@register("j1_open_role_listing", JOBS_SQL + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY kind, slug ORDER BY pos, title, url, loc) AS rank FROM hits)
SELECT m.employer_name, m.kind AS board_kind, m.slug AS board_slug, r.rank, r.title, r.url, r.loc
FROM matched m JOIN ranked r ON r.kind = m.kind AND r.slug = m.slug WHERE r.rank <= 40""")
def j1b(spark, sf):
    return J.open_role_listing(*_jobs_inputs(spark, sf), role=ROLE).withColumn("rank", F.col("rank").cast("long"))


@register("x19_link_discovery", """
, found AS (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1, 'i') AS l FROM pages),
ex AS (SELECT page_id, url, i - 1 AS pos, l[i] AS link FROM found, range(1, len(l) + 1) r(i)),
ab AS (SELECT page_id, pos,
              CASE WHEN starts_with(link, 'http') THEN link
                   ELSE regexp_extract(url, '^(https?://[^/?#]+)', 1) || link END AS link FROM ex),
fy AS (SELECT *, CASE WHEN regexp_extract(link, 'FY(\\d{4})', 1) <> ''
                      THEN CAST(regexp_extract(link, 'FY(\\d{4})', 1) AS INTEGER) END AS fiscal_year FROM ab)
SELECT link, page_id, pos, fiscal_year FROM fy
QUALIFY row_number() OVER (PARTITION BY link ORDER BY page_id, pos) = 1""")
def x19(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return LK.discover_links(pages, LK.ANY_LINK, min_fy=None)


@register("f7_row_view_page", f"""
SELECT employer_name, job_title, worksite_city, worksite_state, fiscal_year, case_status, annual_wage,
       {GC_EMP} AS gc_sponsor
FROM sponsorships WHERE job_category = 'Software'
ORDER BY annual_wage ASC NULLS LAST, employer_name, job_title, worksite_city, worksite_state, fiscal_year,
         case_status, annual_wage LIMIT 50 OFFSET 100""")
def f7(spark, sf):
    gc = _gc(spark, sf)
    rows = H.row_view(FL.apply_filters(_s(spark, sf), FL.Filters(category="Software")), "wage_asc", gc)
    return H.page(rows, 2)


@register("b13_sponsors_bound_parameters", """
SELECT * FROM v1
WHERE job_title ILIKE '%engineer%' AND worksite_state = 'CA' AND annual_wage >= 100000.0
ORDER BY annual_wage DESC NULLS LAST, case_number LIMIT 100""")
def b13(spark, sf):
    _v1(spark, sf).createOrReplaceTempView("v_sponsorships")
    return api.sponsors_sql(spark, "v_sponsorships", title="engineer", state="ca", min_wage=100000, limit=100)


@register("b16_grouped_view_positions", f"""
, v1p AS (SELECT v1.*, f.total_worker_positions FROM v1 JOIN lca_fact f USING (case_number))
SELECT employer_name, job_title, worksite_city, worksite_state, fiscal_year,
       CAST(SUM(total_worker_positions) AS BIGINT) AS approved, ROUND(MEDIAN(annual_wage), 0) AS median_wage,
       (SELECT COUNT(*) FROM green_cards g WHERE g.employer_name = s.employer_name) AS green_cards
FROM v1p s WHERE {CERT} AND worksite_state = 'NY'
GROUP BY 1, 2, 3, 4, 5
ORDER BY employer_name, approved DESC, job_title, worksite_city, worksite_state, fiscal_year LIMIT 2000""")
def b16(spark, sf):
    """The grouped view over a table that carries positions: the approved
    measure switches to the sum of positions (B16)."""
    v = _v1(spark, sf, ["employer_name", "job_title", "worksite_city", "worksite_state", "fiscal_year",
                        "case_status", "annual_wage"], extra=["total_worker_positions"])
    return H.grouped_view(FL.apply_filters(v, FL.Filters(state="NY")), "emp_asc", _gc(spark, sf))


# ---------------------------------------------------------------------------
# Landed files: job boards, logs, downloads, routing, stamps
# ---------------------------------------------------------------------------
LANDED_SQL = """SELECT kind, slug, row_number() OVER (PARTITION BY kind, slug ORDER BY pos, title, url, loc) - 1 AS pos, title, url,
       CASE WHEN pos % 7 = 0 THEN '' ELSE loc END AS loc FROM postings"""


def _landed(spark, sf):
    """The postings as landed JSON pages of three shapes, read back."""
    return PO.read_landed_pages(spark, PO.land_pages(PO.fixture_postings(spark, sf), new_dir(spark, "boards")))


@register("a16_landed_postings", JOBS_SQL + LANDED_SQL)
def a16(spark, sf):
    """Nested JSON of three shapes as one relation."""
    return _landed(spark, sf)


@register("j1_open_roles_landed", JOBS_SQL + """
SELECT t.employer_name, m.kind AS board_kind, m.slug AS board_slug, m.kind IS NOT NULL AS has_feed,
       CASE WHEN m.kind IS NOT NULL THEN COALESCE(h.c, 0) END AS open_roles
FROM emp t LEFT JOIN matched m USING (employer_name)
LEFT JOIN (SELECT kind, slug, COUNT(*) AS c FROM hits GROUP BY 1, 2) h ON h.kind = m.kind AND h.slug = m.slug""")
def j1c(spark, sf):
    employers, boards, _ = _jobs_inputs(spark, sf)
    return J.open_roles(employers, boards, _landed(spark, sf), role=ROLE)


LOG_SQL = """, attempts AS (SELECT event_id, 'LCA_' || user_id || '.xlsx' AS file_name, CASE event_type WHEN 'error' THEN 'FAIL' ELSE 'OK' END AS status,
    CASE WHEN event_type <> 'error' THEN value END AS size_mb, CASE WHEN event_type NOT IN ('error', 'view') THEN event_type || ' mirror' END AS via
  FROM events)"""


@register("a9_download_log", LOG_SQL + """
SELECT file_name, max_by(status, event_id) AS status, max_by({'v': size_mb}, event_id).v AS size_mb, max_by({'v': via}, event_id).v AS via, COUNT(*) AS attempts
FROM attempts GROUP BY 1""")
def a9(spark, sf):
    """Last outcome of every file in logs read by splits."""
    return LD.last_outcome(LD.parse_download_log(spark, FX.download_log(spark, sf, new_dir(spark, "logs"))))


DOWNLOAD_SQL = ", ".join(H.DOWNLOAD_COLUMNS)


@register("a15_csv_download", f"""
, marked AS (SELECT * REPLACE (job_title || ' "' || worksite_state || '",' || chr(10) || 'x' AS job_title) FROM sponsorships)
SELECT {DOWNLOAD_SQL}, row_number() OVER (ORDER BY annual_wage DESC NULLS LAST, employer_name, job_title, worksite_city, worksite_state,
       fiscal_year, case_status, annual_wage, job_category, soc_code, soc_title, visa_class, prevailing_wage, is_university) - 1 AS place
FROM marked QUALIFY place < 100000""")
def a15(spark, sf):
    """Written as CSV files by ranges and read back with the rows' places; titles hold quotes, commas and line breaks."""
    title = F.concat("job_title", F.lit(' "'), "worksite_state", F.lit('",\nx'))
    rows = _s(spark, sf).withColumn("job_title", title).select(*H.DOWNLOAD_COLUMNS)
    path = SK.write_csv_download(rows, new_dir(spark, "csv"), FL.order_for("wage_desc", grouped=False) + [H.asc(c) for c in H.DOWNLOAD_COLUMNS])
    return SK.read_csv_download(spark, path, rows.schema)


def _order_sql(mode: str, grouped: bool) -> str:
    table, ties = (FL.GROUP_ORDERS, FL.GROUP_KEYS) if grouped else (FL.ROW_ORDERS, FL.ROW_TIEBREAK)
    return ", ".join([f"{c} {d.upper()} NULLS LAST" for c, d in table[mode]] + [f"{c} ASC NULLS LAST" for c in ties])


def _placed(df, mode: str):
    """A limited result, in one partition, with its rows' places as they come."""
    return df.select(F.lit(mode).alias("sort"), "*", F.monotonically_increasing_id().alias("place"))


ROW_COLUMNS = ", ".join(FL.ROW_TIEBREAK)


@register("f1_row_orders", " UNION ALL ".join(f"""
SELECT '{m}' AS sort, {ROW_COLUMNS}, row_number() OVER (ORDER BY {_order_sql(m, False)}) - 1 AS place FROM sponsorships QUALIFY place < 2000""" for m in FL.ROW_ORDERS))
def f1(spark, sf):
    """The places of rows in each sort mode of the row view."""
    return reduce(DataFrame.unionByName, [_placed(H.row_view(_s(spark, sf), m), m) for m in FL.ROW_ORDERS])


GROUPED_COLUMNS = ", ".join(FL.GROUP_KEYS)


@register("f1_group_orders", f""", g AS (SELECT {GROUPED_COLUMNS}, COUNT(*) AS approved, ROUND(MEDIAN(annual_wage), 0) AS median_wage
  FROM sponsorships WHERE {CERT} GROUP BY ALL)""" + " UNION ALL ".join(f"""
SELECT '{m}' AS sort, *, row_number() OVER (ORDER BY {_order_sql(m, True)}) - 1 AS place FROM g QUALIFY place < 2000""" for m in FL.GROUP_ORDERS))
def f1b(spark, sf):
    """The places of groups in each sort mode of the grouped view."""
    return reduce(DataFrame.unionByName, [_placed(H.grouped_view(_s(spark, sf), m), m) for m in FL.GROUP_ORDERS])


@register("f4_employer_search_order", """
SELECT 'search' AS sort, employer_name, fiscal_year, filings, certified, avg_wage, median_wage,
       row_number() OVER (ORDER BY fiscal_year DESC, filings DESC, employer_name) - 1 AS place FROM v2
WHERE employer_name ILIKE '%university%' QUALIFY place < 500""")
def f4(spark, sf):
    """Two sort keys in opposite interest, and the largest limit allowed."""
    return _placed(api.employers(views.employer_yearly(_ld(spark, sf).wh), search="university", limit=500), "search")


@register("a7_routes", """
SELECT file_name, CASE WHEN contains(upper(file_name), 'PERM') THEN 'perm' ELSE 'lca' END AS route, COUNT(*) AS rows
FROM (SELECT SOURCE_FILE AS file_name FROM raw_lca UNION ALL SELECT source_file FROM perm_typed) GROUP BY 1, 2""")
def a7(spark, sf):
    """Rows of the fixture's files by the loader that their name sends them to."""
    names = FX.raw_lca(spark, sf).select("source_file").unionByName(FX.raw_perm(spark, sf).select("source_file"))
    return (names.select(F.col("source_file").alias("file_name"), route_of("source_file").alias("route"))
            .groupBy("file_name", "route").agg(F.count("*").alias("rows")))


@register("d9_load_stamps", """
SELECT 'lca_filings' AS table_name, fiscal_year, COUNT(*) AS rows, COUNT(*) AS stamped, true AS not_before_load FROM lca_fact GROUP BY 2
UNION ALL SELECT 'perm_filings', fiscal_year, COUNT(*), COUNT(*), true FROM perm_fact GROUP BY 2""")
def d9(spark, sf):
    """Rows with a load stamp, which is none before the start of the load that the run log names."""
    wh = _ld(spark, sf).wh
    runs = wh.read("etl_runs").where("status = 'success'").groupBy("source").agg(F.min("started_at").alias("started"))
    parts = []
    for table, kind in (("lca_filings", "lca"), ("perm_filings", "perm")):
        rows = wh.read(table).join(runs.where(F.col("source") == kind))          # one row of the run log
        parts.append(rows.groupBy("fiscal_year").agg(
            F.lit(table).alias("table_name"), F.count("*").alias("rows"), F.count("loaded_at").alias("stamped"),
            F.bool_and(F.col("loaded_at") >= F.col("started")).alias("not_before_load")))
    return parts[0].unionByName(parts[1])


@register("x20_list_argument", """
, lists AS (SELECT n_regionkey, string_agg(' ' || n_name || CASE n_nationkey % 3 WHEN 0 THEN ' , ' WHEN 1 THEN ',' ELSE '' END, ',' ORDER BY n_nationkey) AS arg
  FROM nation GROUP BY 1)
SELECT n_regionkey, unnest(list_filter(list_transform(string_split(arg, ','), lambda x: trim(x)), lambda x: x <> '')) AS item FROM lists""")
def x20(spark, sf):
    """Lists of nations as an argument with blanks and empty parts."""
    part = F.concat(F.lit(" "), "n_name", F.when(F.col("n_nationkey") % 3 == 0, " , ").when(F.col("n_nationkey") % 3 == 1, ",").otherwise(""))
    lists = (spark.read.parquet(f"{sf}/nation.parquet").groupBy("n_regionkey")
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", part.alias("p")))), lambda x: x["p"]), ",").alias("arg")))
    return lists.select("n_regionkey", F.explode(split_list("arg")).alias("item"))


@register("b15_description", "SELECT column_name AS col_name, lower(column_type) AS data_type FROM (DESCRIBE SELECT * FROM sponsorships)")
def b15(spark, sf):
    """Column names and types of the extract, in SQL's names of types."""
    _s(spark, sf).createOrReplaceTempView("sponsorships")
    names = F.create_map(*[F.lit(x) for x in ("string", "varchar", "int", "integer")])
    return H.describe(spark).select("col_name", F.coalesce(names[F.col("data_type")], "data_type").alias("data_type"))


def queries() -> dict[str, Spark]:
    return {k: fn for k, (fn, _) in _REG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _REG.items() if sql}
