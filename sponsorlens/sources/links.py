"""Link discovery over stored web pages (X19), re-aimed from scraping one
download page to a distributed pass over a ``pages(page_id, url, html)``
table: every ``href`` matching a pattern, made absolute, tagged with its
fiscal year, de-duplicated keeping the first occurrence."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The original pattern: disclosure workbooks linked from the download page.
DISCLOSURE_LINKS = r'href="([^"]*LCA_Disclosure_Data[^"]*\.xlsx)"'
ANY_LINK = r'href="([^"]*)"'


def discover_links(pages: DataFrame, pattern: str = DISCLOSURE_LINKS, min_fy: int | None = 2025,
                   base_url: str | None = None) -> DataFrame:
    """Links found in whole pages (case-insensitive pattern, group 1).

    Relative links get ``base_url`` or, if not given, the page's own origin
    prepended. With ``min_fy`` set, only links naming ``FY<year>`` with a
    year at least ``min_fy`` are kept. Duplicates keep the first occurrence
    (by page id, then position in the page); the de-duplication is a partial
    aggregate, so a link repeated on every page never lands whole in one task.
    """
    found = pages.select("page_id", "url",
                         F.posexplode(F.regexp_extract_all("html", F.lit("(?i)" + pattern), 1)).alias("pos", "link"))
    origin = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1)
    prefix = F.lit(base_url) if base_url else origin
    absolute = F.when(F.col("link").startswith("http"), F.col("link")).otherwise(F.concat(prefix, F.col("link")))
    year_txt = F.regexp_extract(absolute, r"FY(\d{4})", 1)
    out = found.select("page_id", F.col("pos").cast("long").alias("pos"), absolute.alias("link"),
                       F.when(year_txt != "", year_txt.cast("int")).alias("fiscal_year"))
    if min_fy is not None:
        out = out.where(F.col("fiscal_year") >= min_fy)
    first = out.groupBy("link").agg(F.min(F.struct("page_id", "pos", "fiscal_year")).alias("_f"))
    return first.select("link", F.col("_f.page_id").alias("page_id"), F.col("_f.pos").alias("pos"),
                        F.col("_f.fiscal_year").alias("fiscal_year"))
