"""Sinks (A12, A13, A15), view registration (A14), console (B17), describe
(B15), bounded arguments (F6) and pagination (F7)."""
import csv
import glob

import pytest

from sponsorlens.operators.warehouse import load_lca
from sponsorlens.plans import api, dashboard as H, views
from sponsorlens.sources import sinks
from sponsorlens.sources.sample import make_rows


@pytest.fixture()
def loaded(spark, wh):
    load_lca(wh, make_rows(spark, 400, seed=21))
    return wh


def test_extract_and_console(spark, loaded, tmp_path):
    path = sinks.write_extract(views.sponsorships(loaded), str(tmp_path / "extract"))
    assert sinks.write_perm_extract(views.perm(loaded), str(tmp_path / "perm")) is None   # no PERM rows
    assert sinks.register_extracts(spark, path) is False
    desc = {r.col_name: r.data_type for r in H.describe(spark).collect()}
    assert list(desc) == ["case_status", "visa_class", "fiscal_year", "job_title", "annual_wage",
                          "prevailing_wage", "employer_name", "is_university", "soc_code", "soc_title",
                          "job_category", "worksite_city", "worksite_state"]
    out = H.console(spark).collect()
    assert 0 < len(out) <= 10 and out[0].filings >= out[-1].filings


def test_csv_download(spark, loaded, tmp_path):
    rows = H.download_rows(views.sponsorships(loaded), "year_desc")
    out = sinks.write_csv_download(rows, str(tmp_path / "dl"), [], cap=100_000)
    files = glob.glob(out + "/part-*.csv")
    with open(files[0], newline="", encoding="utf-8-sig") as f:
        data = list(csv.reader(f))
    assert data[0] == H.DOWNLOAD_COLUMNS and len(data) == 401
    assert any("," in v for r in data[1:] for v in r)       # quoted commas survive


def test_limits_and_pages(spark, loaded):
    v1 = views.sponsorships(loaded)
    with pytest.raises(ValueError):
        api.sponsors(v1, limit=1001)
    with pytest.raises(ValueError):
        api.salary(v1, "country")
    rows = H.row_view(v1, "emp_asc")
    first, second = H.page(rows, 0).collect(), H.page(rows, 1).collect()
    allr = rows.limit(100).collect()
    assert first + second == allr
    assert api.sponsors(v1, min_wage=0, limit=5).count() == 5


def test_csv_download_by_ranges_round_trip(spark, tmp_path):
    rows = [(i, ['a "b", c', "line\nbreak", None, "x"][i % 4], i / 3 if i % 5 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, title string, wage double").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # or so few rows are one file
    try:
        out = sinks.write_csv_download(df, str(tmp_path / "dl"), [H.desc("id")], cap=1500)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(out + "/part-*.csv")) > 1                     # no merge into one task
    got = sorted((r.place, r.id, r.title, r.wage) for r in sinks.read_csv_download(spark, out, df.schema).collect())
    assert got == [(k, *rows[1999 - k]) for k in range(1500)]
