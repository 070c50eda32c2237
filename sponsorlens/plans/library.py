"""The analyst query library (Q1-Q20) over the sponsorship view.

Each function takes the view (``v``: a DataFrame with the V1 columns it
needs) plus the question's parameters and returns a DataFrame. Orderings put
NULLs last in both directions, and every LIMIT orders by a total key (the
measure, then the group key) so that ties cannot change the result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import certified, contains_cs, contains_ci, month_start, pct
from ..operators.medians import with_medians

asc = F.asc_nulls_last
desc = F.desc_nulls_last


def q1_software_engineers_in_year(v: DataFrame, year: int = 2026) -> DataFrame:
    return (v.where(contains_cs("job_title", "SOFTWARE ENGINEER") & (F.col("fiscal_year") == year)
                    & certified())
             .groupBy("employer_name").agg(F.count("*").alias("filings"))
             .orderBy(desc("filings"), asc("employer_name")))


def q2_h1b_above(v: DataFrame, min_wage: float = 180000) -> DataFrame:
    return (v.where((F.col("visa_class") == "H-1B") & (F.col("annual_wage") > min_wage))
             .select("employer_name", "job_title", "annual_wage", "worksite_city", "worksite_state")
             .orderBy(desc("annual_wage")))


def q3_universities_software(v: DataFrame) -> DataFrame:
    return (v.where(F.col("is_university") & contains_cs("job_title", "SOFTWARE ENGINEER"))
             .groupBy("employer_name")
             .agg(F.count("*").alias("filings"), F.round(F.avg("annual_wage"), 0).alias("avg_wage"))
             .orderBy(desc("filings"), asc("employer_name")))


def q4_title_in_state_median(v: DataFrame, title: str = "DATA ENGINEER", state: str = "OH") -> DataFrame:
    return (v.where(contains_cs("job_title", title) & (F.col("worksite_state") == state))
             .groupBy("employer_name")
             .agg(F.count("*").alias("filings"), F.round(F.median("annual_wage"), 0).alias("median_wage"))
             .orderBy(desc("filings"), asc("employer_name")))


def q5_category_in_state(v: DataFrame, category: str = "AI/ML", state: str = "CA") -> DataFrame:
    return (v.where((F.col("job_category") == category) & (F.col("worksite_state") == state))
             .groupBy("employer_name")
             .agg(F.count("*").alias("filings"), F.round(F.avg("annual_wage"), 0).alias("avg_wage"))
             .orderBy(desc("filings"), asc("employer_name")))


def q6_top_filers(v: DataFrame, limit: int = 50) -> DataFrame:
    return (v.groupBy("employer_name")
             .agg(F.count("*").alias("total_filings"), F.count_if(certified()).alias("certified"))
             .withColumn("cert_rate_pct", pct("certified", "total_filings", 1))
             .orderBy(desc("total_filings"), asc("employer_name"))
             .limit(limit))


def q7_wage_by_state(v: DataFrame) -> DataFrame:
    paid = v.where(F.col("annual_wage").isNotNull())
    grouped = (paid.groupBy("worksite_state")
                   .agg(F.count("*").alias("filings"), F.round(F.avg("annual_wage"), 0).alias("avg_wage")))
    return (with_medians(grouped, paid, ["worksite_state"], "annual_wage", "median_wage")
             .orderBy(desc("median_wage"), asc("worksite_state")))


def q8_wage_by_city(v: DataFrame, min_filings: int = 20) -> DataFrame:
    return (v.groupBy("worksite_city", "worksite_state")
             .agg(F.count("*").alias("filings"), F.round(F.median("annual_wage"), 0).alias("median_wage"))
             .where(F.col("filings") >= min_filings)
             .orderBy(desc("median_wage"), asc("worksite_city"), asc("worksite_state")))


def q9_wage_by_employer_occupation(v: DataFrame, min_filings: int = 5) -> DataFrame:
    return (v.groupBy("employer_name", "soc_title")
             .agg(F.count("*").alias("filings"), F.round(F.avg("annual_wage"), 0).alias("avg_wage"))
             .where(F.col("filings") >= min_filings)
             .orderBy(desc("avg_wage"), asc("employer_name"), asc("soc_title")))


def yearly_changes(v: DataFrame) -> DataFrame:
    """Filings per employer and year with the change against the previous
    year present for that employer (W1, W3). The window runs over the
    per-year aggregate, so a partition holds at most one row per year."""
    w = Window.partitionBy("employer_name").orderBy(asc("fiscal_year"))
    return (v.groupBy("employer_name", "fiscal_year").agg(F.count("*").alias("filings"))
             .withColumn("yoy_change", F.col("filings") - F.lag("filings").over(w)))


def q10_growing_sponsors(v: DataFrame) -> DataFrame:
    return (yearly_changes(v).where(F.col("yoy_change") > 0)            # QUALIFY (W2)
            .orderBy(desc("yoy_change"), asc("employer_name"), asc("fiscal_year")))


def q11_head_to_head(v: DataFrame, first: str = "AMAZON", second: str = "MICROSOFT",
                     labels: tuple[str, str] = ("amazon", "microsoft")) -> DataFrame:
    return (v.groupBy("fiscal_year")
             .agg(F.count_if(contains_ci("employer_name", first)).alias(labels[0]),
                  F.count_if(contains_ci("employer_name", second)).alias(labels[1]))
             .orderBy(asc("fiscal_year")))


def q12_jobs_above(v: DataFrame, min_wage: float = 200000) -> DataFrame:
    return (v.where(F.col("annual_wage") >= min_wage)
             .select("employer_name", "job_title", "annual_wage", "worksite_city", "worksite_state",
                     "fiscal_year")
             .orderBy(desc("annual_wage")))


def q13_wage_premium(v: DataFrame, min_filings: int = 10) -> DataFrame:
    return (v.where(F.col("annual_wage").isNotNull() & F.col("prevailing_wage").isNotNull())
             .groupBy("employer_name")
             .agg(F.count("*").alias("filings"),
                  F.round(F.avg(F.col("annual_wage") - F.col("prevailing_wage")), 0).alias("avg_premium"))
             .where(F.col("filings") >= min_filings)
             .orderBy(desc("avg_premium"), asc("employer_name")))


def q14_denial_rate(v: DataFrame, min_filings: int = 20) -> DataFrame:
    return (v.groupBy("employer_name")
             .agg(F.count("*").alias("filings"),
                  F.count_if(F.col("case_status") == "Denied").alias("_denied"))
             .where(F.col("filings") >= min_filings)
             .select("employer_name", "filings", pct("_denied", "filings", 2).alias("denial_rate_pct"))
             .orderBy(desc("denial_rate_pct"), asc("employer_name")))


def q15_category_mix(v: DataFrame) -> DataFrame:
    return (v.groupBy("worksite_state", "job_category").agg(F.count("*").alias("filings"))
             .orderBy(asc("worksite_state"), desc("filings"), asc("job_category")))


def q16_top_paying_occupations(v: DataFrame, min_filings: int = 10) -> DataFrame:
    grouped = (v.groupBy("soc_code", "soc_title").agg(F.count("*").alias("filings"))
                .where(F.col("filings") >= min_filings))
    return (with_medians(grouped, v, ["soc_code", "soc_title"], "annual_wage", "median_wage")
             .orderBy(desc("median_wage"), asc("soc_code"), asc("soc_title")))


def q17_monthly_volume(lca_filings: DataFrame) -> DataFrame:
    """Runs on the base fact (it needs ``received_date``)."""
    return (lca_filings.groupBy(month_start("received_date").alias("month"))
                       .agg(F.count("*").alias("filings"))
                       .orderBy(asc("month")))


def q18_recent_runs(etl_runs: DataFrame, limit: int = 20) -> DataFrame:
    return etl_runs.orderBy(desc("started_at"), asc("run_id")).limit(limit)


def q19_university_vs_corporate(v: DataFrame, min_filings: int = 20) -> DataFrame:
    uni = F.col("is_university")
    grouped = (v.groupBy("soc_title").agg(F.count("*").alias("_n"))
                .where(F.col("_n") >= min_filings).drop("_n"))
    grouped = with_medians(grouped, v.where(uni), ["soc_title"], "annual_wage", "university_median")
    return with_medians(grouped, v.where(~uni), ["soc_title"], "annual_wage", "corporate_median")


def q20_full_vs_part_time(v: DataFrame, limit: int = 25) -> DataFrame:
    return (v.groupBy("employer_name")
             .agg(F.count_if(F.col("full_time")).alias("full_time_n"),
                  F.count_if(~F.col("full_time")).alias("part_time_n"))
             .orderBy(desc("part_time_n"), asc("employer_name"))
             .limit(limit))
