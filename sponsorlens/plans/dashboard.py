"""Dashboard questions (H1-H10) over the flat extract ``sponsorships`` and,
when PERM data exists, ``green_cards``."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import certified, contains_ci, pct
from ..operators import filters as FL
from ..operators.medians import exact_medians, with_medians
from ..operators.topk import leading_rows

asc = F.asc_nulls_last
desc = F.desc_nulls_last

ROWS_SHOWN = 2000
DOWNLOAD_CAP = 100_000
CONSOLE_ROWS = 500
# FIXED VALUE: the console's default text.
DEFAULT_CONSOLE_SQL = """SELECT employer_name, COUNT(*) AS filings, ROUND(MEDIAN(annual_wage)) AS median_wage
FROM sponsorships
WHERE job_category = 'AI/ML'
GROUP BY 1 ORDER BY filings DESC LIMIT 10"""


def facet_states(s: DataFrame) -> DataFrame:
    """H1: filter choices (distinct values, sorted)."""
    return (s.select("worksite_state").where(F.col("worksite_state").isNotNull()).distinct()
             .orderBy(asc("worksite_state")))


def facet_categories(s: DataFrame) -> DataFrame:
    return s.select("job_category").distinct().orderBy(asc("job_category"))


def facet_years(s: DataFrame) -> DataFrame:
    return (s.select("fiscal_year").where(F.col("fiscal_year").isNotNull()).distinct()
             .orderBy(desc("fiscal_year")))


def facet_visas(s: DataFrame) -> DataFrame:
    return (s.select("visa_class").where(F.col("visa_class").isNotNull()).distinct()
             .orderBy(asc("visa_class")))


def approved_measure(s: DataFrame):
    """Positions when the extract carries them, else a row count."""
    if "total_worker_positions" in s.columns:
        return F.sum("total_worker_positions").cast("long")
    return F.count("*")


def kpis(s: DataFrame) -> DataFrame:
    """H2: filings, certified %, median wage, distinct employers."""
    totals = s.agg(F.count("*").alias("filings"),
                   pct(F.count_if(certified()), F.count("*"), 1).alias("cert"),
                   F.count_distinct("employer_name").alias("emps"))
    return with_medians(totals, s, [], "annual_wage", "med").select("filings", "cert", "med", "emps")


def top_employers(s: DataFrame, limit: int = 50) -> DataFrame:
    """H3 (also the employer list handed to the postings page)."""
    return (s.groupBy("employer_name").agg(F.count("*").alias("filings"))
             .orderBy(desc("filings"), asc("employer_name")).limit(limit))


def state_medians(s: DataFrame) -> DataFrame:
    """H4: median wage by state, at least 3 filings, top 12."""
    grouped = (s.groupBy("worksite_state").agg(F.count("*").alias("_n")).where(F.col("_n") >= 3)
                .select(F.col("worksite_state").alias("_state")))
    found = exact_medians(s, ["worksite_state"], "annual_wage", "median_wage")
    return (grouped.join(found, grouped["_state"].eqNullSafe(found["worksite_state"]), "left")
             .select(F.col("_state").alias("worksite_state"), "median_wage")
             .orderBy(desc("median_wage"), asc("worksite_state")).limit(12))


def by_year(s: DataFrame) -> DataFrame:
    """H5: filings per fiscal year (the key filter runs before grouping)."""
    return (s.where(F.col("fiscal_year").isNotNull())
             .groupBy("fiscal_year").agg(F.count("*").alias("filings"))
             .orderBy(asc("fiscal_year")))


def row_view(s: DataFrame, sort: str = "wage_desc", gc: DataFrame | None = None,
             limit: int = ROWS_SHOWN) -> DataFrame:
    """H6: individual filings with the ``gc_sponsor`` flag."""
    cols = ["employer_name", "job_title", "worksite_city", "worksite_state", "fiscal_year",
            "case_status", "annual_wage"]
    out = s.select(*cols)
    if gc is not None:
        out = FL.mark_gc_sponsor(out, gc)
    return out.orderBy(*FL.order_for(sort, grouped=False)).limit(limit)


def grouped_view(s: DataFrame, sort: str = "approved_desc", gc: DataFrame | None = None,
                 limit: int | None = ROWS_SHOWN) -> DataFrame:
    """H7 (all groups, unordered, with ``limit`` None): certified filings by employer x title x city x state x year with
    approved count, median wage and PERM filings per employer (E10), which are looked up for the groups shown."""
    g = (s.where(certified())
          .groupBy(*FL.GROUP_KEYS)
          .agg(approved_measure(s).alias("approved"),
               F.round(F.median("annual_wage"), 0).alias("median_wage")))
    order = FL.order_for(sort, grouped=True)
    if limit is not None:
        g = g.orderBy(*order).limit(limit)
    if gc is not None:
        g = (g.join(FL.gc_counts(gc), "employer_name", "left")
              .withColumn("green_cards", F.coalesce(F.col("green_cards"), F.lit(0).cast("long"))))
        g = g if limit is None else g.orderBy(*order)
    return g


def suggestions(s: DataFrame, column: str, text: str, limit: int = 3) -> DataFrame:
    """H8: top values containing the typed text; none for a text of under two characters."""
    text = text.strip()
    return (s.where(contains_ci(column, text) if len(text) >= 2 else F.lit(False))
             .groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
             .orderBy(desc("n"), asc("v")).limit(limit))


DOWNLOAD_COLUMNS = ["employer_name", "job_title", "job_category", "soc_code", "soc_title",
                    "worksite_city", "worksite_state", "fiscal_year", "visa_class", "case_status",
                    "annual_wage", "prevailing_wage", "is_university"]


def download_rows(s: DataFrame, sort: str = "wage_desc", gc: DataFrame | None = None,
                  cap: int = DOWNLOAD_CAP) -> DataFrame:
    """H9: the filtered download (13 columns + PERM flag), at most ``cap``. The flag is no part of the order and
    each row has one: only the rows of the download are looked up."""
    out = s.select(*DOWNLOAD_COLUMNS)
    order = FL.order_for(sort, grouped=False) + [asc(c) for c in DOWNLOAD_COLUMNS]
    out = leading_rows(out, order, cap, FL.first_number(sort, out))
    return out if gc is None else FL.mark_gc_sponsor(out, gc, "green_card_sponsor").orderBy(*order)


PAGE_SIZE = 50


def page(rows: DataFrame, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """one page of an ordered result (``rows`` must already carry a
    total order, e.g. from ``row_view``)."""
    if number < 0:
        raise ValueError("page number must be >= 0")
    return rows.offset(number * size).limit(size)


def describe(spark: SparkSession, view: str = "sponsorships") -> DataFrame:
    """Column names and types of a registered view."""
    return spark.sql(f"DESCRIBE {view}").select("col_name", "data_type")


def console(spark: SparkSession, sql: str = DEFAULT_CONSOLE_SQL, rows: int = CONSOLE_ROWS) -> DataFrame:
    """Ad hoc SQL over the registered ``sponsorships`` and
    ``green_cards`` views (Spark SQL dialect), first ``rows`` rows shown."""
    return spark.sql(sql.strip().rstrip(";")).limit(rows)
