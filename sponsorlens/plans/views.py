"""The three warehouse views (V1-V3), built as DataFrames.

V1 and V3 read the serving tables the load keeps equal to them (one
partitioned scan, no joins). The star-join form is kept for loads and
checks: Spark cannot drop a left join on its own (it does not know the
dimension keys are unique), so it takes the columns a query needs and skips
the joins that would not contribute any of them; the inner join to employers
is always kept, since it is part of the view's row set.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.warehouse import Warehouse

V1_COLUMNS = [
    "case_number", "case_status", "visa_class", "fiscal_year", "job_title",
    "annual_wage", "prevailing_wage", "full_time", "employer_name", "is_university",
    "soc_code", "soc_title", "job_category", "worksite_city", "worksite_state",
]
V3_COLUMNS = [
    "case_number", "case_status", "fiscal_year", "job_title", "annual_wage",
    "employer_name", "is_university", "soc_code", "soc_title", "job_category",
    "worksite_city", "worksite_state",
]
_OCC = {"soc_code", "soc_title", "job_category"}
_LOC = {"worksite_city", "worksite_state"}
_EMP = {"employer_name", "is_university"}


def _star(wh: Warehouse, fact_table: str, view_cols: list[str], columns: list[str] | None,
          extra_fact: list[str] = ()) -> DataFrame:
    wanted = list(columns or view_cols) + [c for c in extra_fact if c not in (columns or view_cols)]
    f = wh.read(fact_table)
    fact_cols = [c for c in wanted if c not in _OCC | _LOC | _EMP]
    need_o = bool(_OCC & set(wanted))
    need_l = bool(_LOC & set(wanted))
    keep = set(fact_cols) | {"employer_id"}
    if need_o:
        keep.add("occupation_id")
    if need_l:
        keep.add("worksite_location_id")
    v = f.select(*[c for c in f.columns if c in keep])
    e = wh.read("employers").select("employer_id", "employer_name", "is_university")
    v = v.join(e, "employer_id", "inner")
    if need_o:
        o = wh.read("occupations").select("occupation_id", "soc_code", "soc_title", "job_category")
        v = v.join(o, "occupation_id", "left")
    if need_l:
        l = wh.read("locations").select(F.col("location_id").alias("worksite_location_id"),
                                        F.col("city").alias("worksite_city"),
                                        F.col("state").alias("worksite_state"))
        v = v.join(l, "worksite_location_id", "left")
    return v.select(*wanted)


def _serving(wh: Warehouse, table: str, view_cols: list[str], columns, extra) -> DataFrame | None:
    if table not in wh.current():
        return None
    wanted = list(columns or view_cols) + [c for c in extra if c not in (columns or view_cols)]
    return wh.read(table).select(*wanted)


def sponsorships(wh: Warehouse, columns: list[str] | None = None,
                 extra_fact: list[str] = (), materialised: bool = True) -> DataFrame:
    """``v_sponsorships`` (V1): LCA fact with employer, occupation, place.
    ``extra_fact`` adds fact columns the view leaves out (for example
    ``total_worker_positions`` or ``received_date``). Reads the serving table
    written at load time when there is one (same rows, no joins), else
    joins the star."""
    if materialised:
        s = _serving(wh, "sponsorships_serving", V1_COLUMNS, columns, extra_fact)
        if s is not None:
            return s
    return _star(wh, "lca_filings", V1_COLUMNS, columns, extra_fact)


def perm(wh: Warehouse, columns: list[str] | None = None, materialised: bool = True) -> DataFrame:
    """``v_perm`` (V3): the PERM fact with the same dimensions."""
    if materialised:
        s = _serving(wh, "perm_serving", V3_COLUMNS, columns, ())
        if s is not None:
            return s
    return _star(wh, "perm_filings", V3_COLUMNS, columns)


def employer_yearly(wh: Warehouse) -> DataFrame:
    """``v_employer_yearly`` (V2): filings, certified, rounded average and
    median wage per employer and fiscal year."""
    from ..functions.scalars import certified
    rows = sponsorships(wh, ["employer_name", "fiscal_year", "case_status", "annual_wage"])
    return (rows.groupBy("employer_name", "fiscal_year")
             .agg(F.count("*").alias("filings"),
                  F.count_if(certified()).alias("certified"),
                  F.round(F.avg("annual_wage"), 0).alias("avg_wage"),
                  F.round(F.median("annual_wage"), 0).alias("median_wage")))
