"""Salted top-k, link discovery (X19) and the landing report (M1)."""
from pyspark.sql import functions as F

from sponsorlens.operators.topk import top_k_per_group
from sponsorlens.sources import landing as LD
from sponsorlens.sources.links import discover_links


def test_top_k_matches_sorting(spark):
    rows = [("hot", i, (i * 7919) % 1000) for i in range(5000)] + [("cold", i, i) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, id long, v long")
    got = {(r.g, r.rank, r.id) for r in top_k_per_group(df, ["g"], [F.asc("v"), F.asc("id")], 5,
                                                        salt_col="id").collect()}
    want = set()
    for g in ("hot", "cold"):
        sel = sorted((v, i) for gg, i, v in rows if gg == g)[:5]
        want |= {(g, k + 1, i) for k, (v, i) in enumerate(sel)}
    assert got == want


def test_discover_links_year_filter_and_dedup(spark):
    pages = spark.createDataFrame([
        (1, "https://data.example.gov/performance",
         '<a HREF="/sites/LCA_Disclosure_Data_FY2024_Q4.xlsx">old</a>'
         '<a href="/sites/LCA_Disclosure_Data_FY2025_Q1.xlsx">a</a>'
         '<a href="https://cdn.example/LCA_Disclosure_Data_FY2026_Q2.xlsx">b</a>'
         '<a href="/sites/LCA_Disclosure_Data_FY2025_Q1.xlsx">dup</a>'
         '<a href="/sites/PERM_Disclosure_Data_FY2025.xlsx">perm</a>'),
        (2, "https://mirror.example/x", '<a href="/sites/LCA_Disclosure_Data_FY2025_Q1.xlsx">again</a>'),
    ], "page_id long, url string, html string")
    got = sorted((r.link, r.page_id, r.pos, r.fiscal_year)
                 for r in discover_links(pages, min_fy=2025, base_url="https://data.example.gov").collect())
    assert got == [
        ("https://cdn.example/LCA_Disclosure_Data_FY2026_Q2.xlsx", 1, 2, 2026),
        ("https://data.example.gov/sites/LCA_Disclosure_Data_FY2025_Q1.xlsx", 1, 1, 2025),
    ]
    own = {r.link for r in discover_links(pages, min_fy=None).collect()}
    assert "https://mirror.example/sites/LCA_Disclosure_Data_FY2025_Q1.xlsx" in own


LOG = """== run Fri Jul 10 14:33:31 UTC 2026 ==
OK   LCA_FY2025_Q2.xlsx 107.0MB via direct
FAIL LCA_FY2026_Q2.xlsx
     https://example/LCA_FY2026_Q2.xlsx attempt 1: HTTPError: 404
OK   LCA_FY2026_Q1.xlsx 75.6MB via archive.org mirror (may be truncated!)
FAIL LCA_FY2025_Q2.xlsx
OK   LCA_FY2025_Q2.xlsx 107.0MB via direct
"""


def test_landing_report(spark, tmp_path):
    land = tmp_path / "raw"
    land.mkdir()
    (land / "LCA_FY2025_Q2.xlsx").write_bytes(b"x" * 3_000_000)
    (land / "LCA_FY2026_Q1.xlsx").write_bytes(b"<html>error</html>")
    log = tmp_path / "download_log.txt"
    log.write_text(LOG)
    expected = LD.expected_files(spark, {"lca": {"base_url": "https://example/",
                                                 "files": ["LCA_FY2025_Q2.xlsx", "LCA_FY2026_Q2.xlsx"]}})
    landed = LD.landed_files(spark, str(land), "*.xlsx")
    runs = spark.createDataFrame([("LCA_FY2025_Q2.xlsx", 1000)], "file_name string, rows_loaded long")
    rep = {r.file_name: r for r in LD.landing_report(expected, landed, LD.parse_download_log(spark, str(log)),
                                                     runs).collect()}
    assert set(rep) == {"LCA_FY2025_Q2.xlsx", "LCA_FY2026_Q2.xlsx", "LCA_FY2026_Q1.xlsx"}
    q2 = rep["LCA_FY2025_Q2.xlsx"]
    assert q2.expected and q2.landed and not q2.too_small and q2.last_status == "OK" and q2.attempts == 3
    assert q2.rows_loaded == 1000 and q2.via == "direct"
    assert rep["LCA_FY2026_Q2.xlsx"].landed is False and rep["LCA_FY2026_Q2.xlsx"].last_status == "FAIL"
    assert rep["LCA_FY2026_Q1.xlsx"].too_small is True and rep["LCA_FY2026_Q1.xlsx"].expected is False
    assert {r.file_name for r in LD.not_landed(expected, landed).collect()} == {"LCA_FY2026_Q2.xlsx"}


def test_log_lines_are_numbered_across_splits(spark, tmp_path):
    log = tmp_path / "runs.txt"
    log.write_text("".join(f"OK   f{i % 7}.xlsx {i}.5MB via direct\n" if i % 3 else f"     note {i}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        parsed = LD.parse_download_log(spark, str(log))
        got = {r.line_no: (r.file_name, r.size_mb) for r in parsed.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {i: (f"f{i % 7}.xlsx", i + 0.5) for i in range(3000) if i % 3}
