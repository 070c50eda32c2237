"""Dashboard filters (B12), PERM cross-references (E7-E10, E15) and the
named sort modes (F2, F3)."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import certified, contains_ci, contains_cs

asc = F.asc_nulls_last
desc = F.desc_nulls_last


@dataclass(frozen=True)
class Filters:
    """The ten dashboard filters. Empty values mean "no filter"."""
    employer: str = ""        # employer_name ILIKE %x%
    title: str = ""           # job_title LIKE %UPPER(x)%
    state: str = ""
    category: str = ""
    year: int | None = None
    min_wage: float = 0       # applies only when > 0
    university: str = ""      # "1" universities only, "0" companies only
    green_card: str = ""      # "emp" any PERM filing, "role" PERM for the same SOC code
    visa: str = ""
    status: str = ""          # "cert" certified only, "den" denied only


def predicates(f: Filters) -> list[Column]:
    preds = []
    if f.employer.strip():
        preds.append(contains_ci("employer_name", f.employer.strip()))
    if f.title.strip():
        preds.append(contains_cs("job_title", f.title.strip().upper()))
    if f.state:
        preds.append(F.col("worksite_state") == f.state)
    if f.category:
        preds.append(F.col("job_category") == f.category)
    if f.year:
        preds.append(F.col("fiscal_year") == int(f.year))
    if f.min_wage and f.min_wage > 0:
        preds.append(F.col("annual_wage") >= F.lit(float(f.min_wage)))
    if f.university == "1":
        preds.append(F.col("is_university"))
    if f.university == "0":
        preds.append(~F.col("is_university"))
    if f.visa:
        preds.append(F.col("visa_class") == f.visa)
    if f.status == "cert":
        preds.append(certified())
    if f.status == "den":
        preds.append(F.col("case_status") == "Denied")
    return preds


def gc_employers(gc: DataFrame) -> DataFrame:
    """Distinct PERM employers (partial aggregation before the shuffle)."""
    return gc.select("employer_name").where(F.col("employer_name").isNotNull()).distinct()


def semi_employer(s: DataFrame, gc: DataFrame) -> DataFrame:
    """Rows whose employer also filed PERM."""
    return s.join(gc_employers(gc), "employer_name", "left_semi")


def semi_employer_role(s: DataFrame, gc: DataFrame) -> DataFrame:
    """Rows whose employer filed PERM for the same SOC code."""
    keys = gc.select("employer_name", "soc_code").distinct()
    return s.join(keys, ["employer_name", "soc_code"], "left_semi")


def mark_gc_sponsor(s: DataFrame, gc: DataFrame, name: str = "gc_sponsor") -> DataFrame:
    """``employer_name IN (SELECT DISTINCT employer_name FROM gc)`` as a
    column: a left join on the distinct keys (NULL employer stays NULL)."""
    keys = gc_employers(gc).withColumn("_hit", F.lit(True))
    out = s.join(keys, "employer_name", "left")
    flag = F.when(F.col("employer_name").isNull(), F.lit(None).cast("boolean")) \
            .otherwise(F.col("_hit").isNotNull())
    return out.withColumn(name, flag).drop("_hit")


def gc_counts(gc: DataFrame) -> DataFrame:
    """E10 pre-aggregate: PERM filings per employer."""
    return gc.groupBy("employer_name").agg(F.count("*").alias("green_cards"))


def apply_filters(s: DataFrame, f: Filters, gc: DataFrame | None = None) -> DataFrame:
    """All filters; the PERM filters (E15) apply only when PERM data exists."""
    for p in predicates(f):
        s = s.where(p)
    if gc is not None and f.green_card == "emp":
        s = semi_employer(s, gc)
    if gc is not None and f.green_card == "role":
        s = semi_employer_role(s, gc)
    return s


# Sort modes (F3): (column, direction) pairs, NULLs last. Each mode is
# followed by the displayed columns so that a LIMIT cuts between rows in a
# fixed order.
ROW_ORDERS = {
    "wage_desc": [("annual_wage", "desc")],
    "wage_asc": [("annual_wage", "asc")],
    "approved_desc": [("annual_wage", "desc")],
    "year_desc": [("fiscal_year", "desc"), ("annual_wage", "desc")],
    "emp_asc": [("employer_name", "asc"), ("annual_wage", "desc")],
}
GROUP_ORDERS = {
    "wage_desc": [("median_wage", "desc")],
    "wage_asc": [("median_wage", "asc")],
    "approved_desc": [("approved", "desc")],
    "year_desc": [("fiscal_year", "desc"), ("approved", "desc")],
    "emp_asc": [("employer_name", "asc"), ("approved", "desc")],
}
ROW_TIEBREAK = ["employer_name", "job_title", "worksite_city", "worksite_state", "fiscal_year",
                "case_status", "annual_wage"]
GROUP_KEYS = ["employer_name", "job_title", "worksite_city", "worksite_state", "fiscal_year"]


def order_for(mode: str, grouped: bool) -> list[Column]:
    table = GROUP_ORDERS if grouped else ROW_ORDERS
    base = table.get(mode) or (GROUP_ORDERS["approved_desc"] if grouped else ROW_ORDERS["wage_desc"])
    ties = GROUP_KEYS if grouped else ROW_TIEBREAK
    return [desc(c) if d == "desc" else asc(c) for c, d in base] + [asc(c) for c in ties]


def first_number(mode: str, rows: DataFrame) -> tuple[str, str] | None:
    """The first column of a row order and its direction, if it is a number."""
    column, direction = (ROW_ORDERS.get(mode) or ROW_ORDERS["wage_desc"])[0]
    return (column, direction) if rows.schema[column].dataType.typeName() in ("integer", "long", "double") else None
