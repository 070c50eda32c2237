"""Warehouse load: idempotency, batch = sequential loads, keys, audits, run log."""
import pytest
from pyspark.sql import functions as F

from sponsorlens import schemas as S
from sponsorlens.operators import audits as AU
from sponsorlens.operators.warehouse import Warehouse, load_lca
from sponsorlens.plans import views
from sponsorlens.sources.raw import read_raw_csv
from sponsorlens.sources.sample import make_rows, write_csv


def _csv_file(spark, tmp_path, n, seed, name):
    out = str(tmp_path / f"csv-{name}")
    write_csv(make_rows(spark, n, seed=seed).coalesce(1), out)
    import glob
    import os
    part = glob.glob(os.path.join(out, "part-*.csv"))[0]
    dest = str(tmp_path / name)
    os.rename(part, dest)
    return dest


def test_end_to_end_idempotent(spark, wh, tmp_path):
    path = _csv_file(spark, tmp_path, 500, 2, "sample.csv")
    load_lca(wh, read_raw_csv(spark, [path]))
    load_lca(wh, read_raw_csv(spark, [path]))          # second run must not duplicate
    assert wh.read("lca_filings").count() == 500
    assert views.sponsorships(wh).count() == 500
    runs = wh.read("etl_runs").collect()
    assert [r.status for r in runs] == ["success", "success"] and all(r.rows_loaded == 500 for r in runs)
    ids = [r.employer_id for r in wh.read("employers").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))      # dense keys from 1, no gaps
    # a second handle on the same folder sees the committed tables
    again = Warehouse(spark, wh.root)
    assert again.read("lca_filings").count() == 500


def _raw_rows(spark, rows):
    cols = ("CASE_NUMBER string, EMPLOYER_NAME string, SOC_CODE string, SOC_TITLE string, JOB_TITLE string, "
            "RECEIVED_DATE string, WORKSITE_CITY string, row_seq long, source_file string")
    return spark.createDataFrame(rows, cols)


ROWS = [
    ("I-200-1", "Acme LLC", "15-1252", "Software Developers", "dev", "2024-01-05", "A", 1, "f1.csv"),
    ("I-200-2", "Acme, Inc.", "15-1252", "Software Devs", "dev", "2023-12-01", "B", 2, "f1.csv"),
    ("I-200-3", "Beta Corp", "15-2051", None, "ai engineer", "2024-02-01", "A", 3, "f1.csv"),
    ("I-200-1", "Gamma LLC", "15-2051", "Data Scientists", "data scientist", "2024-03-01", "C", 1, "f2.csv"),
    ("I-200-4", "acme", "15-2051", "Data Scientists", "dev", "2022-01-01", "A", 2, "f2.csv"),
    ("I-200-5", "Delta", None, None, "dev", None, None, 3, "f2.csv"),
]


def _snapshot(wh):
    emp = {r.employer_name_clean: (r.employer_name, r.first_seen_date, r.is_university)
           for r in wh.read("employers").collect()}
    occ = {r.soc_code: (r.soc_title, r.job_category) for r in wh.read("occupations").collect()}
    loc = {(r.city, r.state, r.postal_code) for r in wh.read("locations").collect()}
    v1 = sorted((r.case_number, r.employer_name, r.soc_title, r.worksite_city)
                for r in views.sponsorships(wh, ["case_number", "employer_name", "soc_title", "worksite_city"]).collect())
    return emp, occ, loc, v1


def test_batch_equals_sequential_loads(spark, tmp_path):
    """One batch of files gives the same warehouse as loading them one at a
    time in name order: later files replace facts, earlier files fix
    dimension attributes (S13, S14)."""
    raw = _raw_rows(spark, ROWS)
    batch = Warehouse(spark, str(tmp_path / "batch"))
    load_lca(batch, raw)
    seq = Warehouse(spark, str(tmp_path / "seq"))
    load_lca(seq, raw.where("source_file = 'f1.csv'"))
    load_lca(seq, raw.where("source_file = 'f2.csv'"))
    assert _snapshot(batch) == _snapshot(seq)
    emp, occ, loc, v1 = _snapshot(batch)
    assert emp["ACME"][0] == "Acme LLC"                         # first file, smallest name
    assert str(emp["ACME"][1]) == "2023-12-01"                  # min date of the first file only
    assert emp["GAMMA"][0] == "Gamma LLC"                       # introduced by the replaced row
    assert occ["15-2051"] == (None, "AI/ML")                    # first file had no title; never updated
    assert occ["15-1252"] == ("Software Developers", "Software")      # smallest non-NULL title of the first file
    assert (None, None, None) in loc                            # NULL location kept as one key
    assert ("I-200-1", "Gamma LLC", None, "C") in v1             # later file replaced the fact; title from dimension
    assert ("I-200-5", "Delta", None, None) in v1


def test_audits_clean_after_load(spark, wh):
    load_lca(wh, make_rows(spark, 300, seed=5))
    dups = AU.key_uniqueness(wh, ["employers", "locations", "occupations", "lca_filings"], natural=True)
    assert all(r.duplicate_keys == 0 for r in dups.collect())
    ids = AU.key_uniqueness(wh, ["employers", "locations", "occupations"], natural=False)
    assert all(r.duplicate_keys == 0 for r in ids.collect())
    fks = AU.foreign_keys(wh, [("lca_filings", "employer_id"), ("lca_filings", "worksite_location_id"),
                               ("lca_filings", "occupation_id")])
    assert all(r.orphan_rows == 0 for r in fks.collect())
    q = AU.lca_quality(wh.read("lca_filings")).first()
    assert q.total_rows == 300 and q.annual_wage_out_of_bounds == 0 and q.null_case_number == 0


def test_failed_load_is_logged_and_raised(spark, wh):
    bad = make_rows(spark, 10, seed=7).withColumn("RECEIVED_DATE", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception):
        load_lca(wh, bad, ["broken.csv"])
    runs = wh.read("etl_runs").collect()
    assert len(runs) == 1 and runs[0].status == "failed" and runs[0].file_name == "broken.csv"
    assert "boom" in runs[0].error
    assert "lca_filings" not in wh.current()                   # nothing half-published


def test_create_if_absent(spark, wh):
    wh.create_if_absent()
    assert wh.read("uscis_employer_stats").count() == 0
    assert set(wh.current()) >= {"employers", "lca_filings", "etl_runs", "uscis_employer_stats"}


def test_serving_table_equals_view_after_incremental_loads(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "inc"))
    raw = _raw_rows(spark, ROWS)
    load_lca(wh, raw.where("source_file = 'f1.csv'"))
    load_lca(wh, raw.where("source_file = 'f2.csv'"))
    served = views.sponsorships(wh)
    joined = views.sponsorships(wh, materialised=False)
    assert sorted(map(tuple, served.collect())) == sorted(map(tuple, joined.select(*served.columns).collect()))
    assert served.count() == 5


def test_combined_batch_equals_lca_then_perm(spark, tmp_path):
    from sponsorlens.operators.warehouse import load_batch, load_perm
    lca = _raw_rows(spark, ROWS)
    perm = spark.createDataFrame(
        [("A-100-1", "ACME", "2020-01-01", "15-9999", "Certified", 1, "p.csv"),
         ("A-100-2", "Zeta Labs", "2021-05-01", "15-1252", "Denied", 2, "p.csv")],
        "CASE_NO string, EMPLOYER_NAME_9089 string, CASE_RECEIVED_DATE string, PW_SOC_CODE_9089 string, "
        "CASE_STATUS string, row_seq long, source_file string")
    combined = Warehouse(spark, str(tmp_path / "combined"))
    load_batch(combined, lca, perm)
    seq = Warehouse(spark, str(tmp_path / "seq2"))
    load_lca(seq, lca)
    load_perm(seq, perm)
    assert _snapshot(combined) == _snapshot(seq)
    emp = _snapshot(combined)[0]
    assert emp["ACME"][0] == "Acme LLC"            # LCA files come first; PERM cannot rename
    assert emp["ZETA LABS"][0] == "Zeta Labs"
    gc = sorted((r.case_number, r.employer_name, r.soc_code) for r in views.perm(combined).collect())
    assert gc == [("A-100-1", "Acme LLC", "15-9999", ), ("A-100-2", "Zeta Labs", "15-1252")]


def test_upsert_rewrites_only_touched_years(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "parts"))
    first = _raw_rows(spark, [
        ("I-200-1", "Acme", "15-1252", "t", "dev", "2020-01-05", "A", 1, "f1.csv"),   # FY2020
        ("I-200-2", "Acme", "15-1252", "t", "dev", "2021-01-05", "A", 2, "f1.csv"),   # FY2021
        ("I-200-3", "Beta", "15-1252", "t", "dev", "2022-01-05", "A", 3, "f1.csv"),   # FY2022
    ])
    load_lca(wh, first)
    v1_parts = dict((p.split("/")[1], p) for p in wh.current()["lca_filings"][2])
    second = _raw_rows(spark, [
        ("I-200-1", "Acme", "15-1252", "t", "dev", "2023-01-05", "B", 1, "f2.csv"),   # moves 2020 -> 2023
        ("I-200-4", "Gamma", "15-1252", "t", "dev", "2023-02-05", "B", 2, "f2.csv"),
    ])
    load_lca(wh, second)
    parts = dict((p.split("/")[1], p) for p in wh.current()["lca_filings"][2])
    assert "fiscal_year=2020" not in parts                        # emptied year dropped
    assert parts["fiscal_year=2021"] == v1_parts["fiscal_year=2021"]   # untouched years keep folders
    assert parts["fiscal_year=2022"] == v1_parts["fiscal_year=2022"]
    assert parts["fiscal_year=2023"].startswith("v=000002-")
    got = sorted((r.case_number, r.fiscal_year) for r in wh.read("lca_filings").collect())
    assert got == [("I-200-1", 2023), ("I-200-2", 2021), ("I-200-3", 2022), ("I-200-4", 2023)]
    served = sorted((r.case_number, r.fiscal_year, r.worksite_city) for r in views.sponsorships(wh).collect())
    assert served == [("I-200-1", 2023, "B"), ("I-200-2", 2021, "A"), ("I-200-3", 2022, "A"), ("I-200-4", 2023, "B")]
    again = Warehouse(spark, wh.root)                              # manifest round trip
    assert again.read("lca_filings").count() == 4


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    """A reload of one case rewrites one part of its year, in the facts and in the serving table."""
    wh = Warehouse(spark, str(tmp_path / "buckets"))
    load_lca(wh, _raw_rows(spark, [(f"I-200-{i:03d}", "Acme", "15-1252", "t", "dev", "2020-01-05", "A", i, "f1.csv") for i in range(60)]))
    before = {t: set(wh.current()[t][2]) for t in ("lca_filings", "sponsorships_serving")}
    assert all(len(x) > 4 for x in before.values())
    load_lca(wh, _raw_rows(spark, [("I-200-007", "Beta", "15-1252", "t", "dev", "2020-02-05", "B", 1, "f2.csv")]))
    for t, old in before.items():
        assert len(old - set(wh.current()[t][2])) == 1, t
    served = {r.case_number: (r.employer_name, r.worksite_city) for r in views.sponsorships(wh).collect()}
    joined = {r.case_number: (r.employer_name, r.worksite_city) for r in views.sponsorships(wh, materialised=False).collect()}
    assert served == joined and len(served) == 60 and served["I-200-007"] == ("Beta", "B")


def test_one_bad_file_of_many_costs_two_loads(spark, tmp_path, monkeypatch):
    from sponsorlens.operators import warehouse as M

    raw = _raw_rows(spark, [(f"I-200-{i:03d}", f"Emp {i}", "15-1252", "t", "dev", "2020-01-05", "A", 1, f"f{i:02d}.csv") for i in range(30)])
    loads, kept = [], M._load
    monkeypatch.setattr(M, "_load", lambda *a: (loads.append(1), kept(*a))[1])
    wh = Warehouse(spark, str(tmp_path / "many"))
    with pytest.raises(Exception, match="boom"):
        M.load_batch(wh, lca_raw=_failing(spark, raw, "f17.csv"))
    assert len(loads) == 2 and wh.read("lca_filings").count() == 29
    runs = {r.file_name: r.status for r in wh.read("etl_runs").collect()}
    assert len(runs) == 30 and [f for f, s in runs.items() if s == "failed"] == ["f17.csv"]


def test_compaction_keeps_rows(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "compact"))
    raw = _raw_rows(spark, ROWS)
    load_lca(wh, raw.where("source_file = 'f1.csv'"))
    load_lca(wh, raw.where("source_file = 'f2.csv'"))
    before = {t: sorted(map(tuple, wh.read(t).collect())) for t in ("employers", "lca_filings", "etl_runs")}
    assert len(wh.current()["employers"][2]) == 2                     # one folder per load
    wh.compact(["employers", "lca_filings", "etl_runs"])
    after = {t: sorted(map(tuple, wh.read(t).collect())) for t in before}
    assert after == before
    assert len(wh.current()["employers"][2]) == 1
    assert all(p.startswith("v=000003-") for p in wh.current()["lca_filings"][2])
    assert Warehouse(spark, wh.root).read("employers").count() == len(before["employers"])


def _failing(spark, raw, name):
    """``raw`` with a title that raises for one file's rows."""
    return raw.withColumn("JOB_TITLE", F.when(F.col("source_file") == name, F.raise_error(F.lit("boom " * 2000)).cast("string"))
                          .otherwise(F.col("JOB_TITLE")))


def _state(wh):
    facts = wh.read("lca_filings").drop("loaded_at", "employer_id", "worksite_location_id", "occupation_id")
    return sorted(map(str, facts.collect())), sorted(r.employer_name_clean for r in wh.read("employers").collect())


@pytest.mark.parametrize("at", ["resolve_fact_keys", "refresh_serving", "_run_rows"])
def test_failed_load_can_be_tried_again(spark, tmp_path, monkeypatch, at):
    """Fails after the dimensions, after the facts, and after all tables."""
    from sponsorlens.operators import warehouse as M

    raw = _raw_rows(spark, ROWS).where("source_file = 'f1.csv'")
    clean, wh = Warehouse(spark, str(tmp_path / "clean")), Warehouse(spark, str(tmp_path / "retry"))
    load_lca(clean, raw)
    kept = getattr(M, at)

    def broken(*a, **k):
        if at == "_run_rows" and "failed" in a:
            return kept(*a, **k)
        raise RuntimeError("broken")

    monkeypatch.setattr(M, at, broken)
    with pytest.raises(RuntimeError):
        load_lca(wh, raw)
    monkeypatch.setattr(M, at, kept)
    assert "lca_filings" not in wh.current()
    load_lca(wh, raw)
    again = Warehouse(spark, str(tmp_path / "retry"))
    assert _state(again) == _state(clean)
    assert [r.status for r in again.read("etl_runs").orderBy("started_at").collect()] == ["failed", "success"]


def test_good_files_of_a_failed_batch_stay(spark, tmp_path):
    from sponsorlens.operators.warehouse import load_batch

    raw = _raw_rows(spark, ROWS)
    wh, clean = Warehouse(spark, str(tmp_path / "mixed")), Warehouse(spark, str(tmp_path / "good"))
    with pytest.raises(Exception):
        load_batch(wh, lca_raw=_failing(spark, raw, "f2.csv"))
    load_lca(clean, raw.where("source_file = 'f1.csv'"))
    assert _state(wh) == _state(clean)
    runs = {r.file_name: r for r in wh.read("etl_runs").collect()}
    assert (runs["f1.csv"].status, runs["f2.csv"].status) == ("success", "failed")
    assert len(runs["f2.csv"].error) > 9000                    # the whole text


def test_failed_files_are_logged_with_their_kind(spark, wh):
    from sponsorlens.operators.warehouse import load_batch

    lca = make_rows(spark, 5, seed=7).withColumns({"RECEIVED_DATE": F.raise_error(F.lit("boom")), "source_file": F.lit("a.csv")})
    perm = lca.select(F.raise_error(F.lit("boom")).cast("string").alias("CASE_NO"), F.lit("PERM_b.csv").alias("source_file"), "row_seq")
    with pytest.raises(Exception):
        load_batch(wh, lca, perm, ["a.csv", "PERM_b.csv"])
    assert {(r.file_name, r.source, r.status) for r in wh.read("etl_runs").collect()} == {
        ("a.csv", "lca", "failed"), ("PERM_b.csv", "perm", "failed")}


def test_batch_rows_are_dealt_to_parts_once(spark, wh, monkeypatch):
    """A first load shuffles the rows of a batch into parts once; the facts, the serving table and the extract
    are written from there."""
    from sponsorlens.sources.sinks import read_extract, write_extract
    frame = type(spark.range(0))
    dealt, hint = [], frame.hint
    monkeypatch.setattr(frame, "hint", lambda df, name, *a: dealt.append((name, *a)) or hint(df, name, *a))
    load_lca(wh, make_rows(spark, 300, seed=8))
    path = write_extract(views.sponsorships(wh), f"{wh.root}/extract", together=True)
    assert dealt == [("rebalance", "fiscal_year", "case_bucket")]
    rows = {t: wh.read(t).select("case_number", "fiscal_year").collect() for t in ("lca_filings", "sponsorships_serving")}
    assert len(rows["lca_filings"]) == 300 and sorted(map(str, rows["lca_filings"])) == sorted(map(str, rows["sponsorships_serving"]))
    assert read_extract(spark, path).count() == 300


def test_first_batch_is_written_once_and_as_facts(spark, wh):
    """The first snapshot of the facts is the dealt batch: there is no copy of it besides, and the tables read the same."""
    load_lca(wh, make_rows(spark, 200, seed=11))
    assert not [n for n in wh.written if n.startswith("batch_")]
    assert wh.read("lca_filings").columns == S.WAREHOUSE_TABLES["lca_filings"].fieldNames()
    columns = views.V1_COLUMNS
    served, joined = (sorted(map(str, views.sponsorships(wh, columns, materialised=m).collect())) for m in (True, False))
    assert served == joined and len(served) == 200
    load_lca(wh, make_rows(spark, 100, seed=12, source_file="later.csv"))
    assert [n for n in wh.written if n.startswith("batch_")] == ["batch_lca_filings"]
    served, joined = (sorted(map(str, views.sponsorships(wh, columns, materialised=m).collect())) for m in (True, False))
    assert served == joined


def test_dealt_rows_have_no_occupation_texts(spark, wh, monkeypatch):
    """Rows are shuffled to parts with the occupation's id; its code, title and category join the dealt rows."""
    from sponsorlens.operators import warehouse as M
    dealt, kept = [], M.by_part
    monkeypatch.setattr(M, "by_part", lambda rows: dealt.append(rows.columns) or kept(rows))
    load_lca(wh, _raw_rows(spark, ROWS))
    assert len(dealt) == 1 and not [c for c in dealt[0] if "soc" in c or "job_category" in c]
    served, joined = ({r.case_number: (r.soc_code, r.soc_title, r.job_category) for r in views.sponsorships(wh, materialised=m).collect()}
                      for m in (True, False))
    assert served == joined and served["I-200-2"][:2] == ("15-1252", "Software Developers") and served["I-200-5"] == (None, None, None)


def test_shuffles_of_a_load_start_in_proportion_to_its_files(spark, wh, tmp_path, monkeypatch):
    """Partitions that shuffles start with follow the bytes of the files that are read, with the session's number as a
    floor, and settings for small tasks are taken back."""
    from sponsorlens import session as X
    path = _csv_file(spark, tmp_path, 500, 13, "sized.csv")
    before = {k: spark.conf.get(k, None) for k in (X.INITIAL, X.ADVISORY, X.SPLIT)}
    raw = read_raw_csv(spark, [path])
    try:
        assert X.fit_partitions(spark, raw) == int(spark.conf.get(X.INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
        monkeypatch.setattr(X, "INPUT_BYTES", 1000)
        size = (tmp_path / "sized.csv").stat().st_size
        load_lca(wh, raw)
        assert spark.conf.get(X.INITIAL) == str(-(-size // 1000)) and size > 20_000
        assert {k: spark.conf.get(k, None) for k in (X.ADVISORY, X.SPLIT)} == {k: before[k] for k in (X.ADVISORY, X.SPLIT)}
        assert wh.read("lca_filings").count() == 500
    finally:
        spark.conf.unset(X.INITIAL) if before[X.INITIAL] is None else spark.conf.set(X.INITIAL, before[X.INITIAL])


def test_small_tasks_only_lowers(spark):
    from sponsorlens.session import SPLIT, TASK_BYTES, _bytes, small_tasks
    assert [_bytes(x) for x in ("64MB", "16m", "134217728b", "1g", "7")] == [64 << 20, 16 << 20, 134217728, 1 << 30, 7]
    before = spark.conf.get(SPLIT, None)
    try:
        for given, during in (("128m", str(TASK_BYTES)), ("1m", "1m")):
            spark.conf.set(SPLIT, given)
            with pytest.raises(RuntimeError), small_tasks(spark, SPLIT):
                assert spark.conf.get(SPLIT) == during
                raise RuntimeError
            assert spark.conf.get(SPLIT) == given
    finally:
        spark.conf.unset(SPLIT) if before is None else spark.conf.set(SPLIT, before)


def test_lines_of_the_fixture_are_shuffled_for_one_join(spark, tmp_path):
    """Without broadcasts, the lines go to their orders; customers were joined to the orders before."""
    from sponsorlens.sources.fixtures import raw_lca
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        plan = raw_lca(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(o_custkey" not in plan


def test_whole_rows_move_packed(spark, wh, monkeypatch):
    """Shuffles of whole rows (staging, employers, parts) carry one string for all texts but the keys."""
    from sponsorlens.operators import transform as T
    moved, kept = [], T.packed
    monkeypatch.setattr(T, "packed", lambda rows, but=(): moved.append(kept(rows, but)) or moved[-1])
    load_lca(wh, make_rows(spark, 100, seed=21))
    texts = [[f.name for f in m.schema if f.dataType.typeName() == "string"] for m in moved]
    assert texts == [["case_number", "source_file", "_packed"], ["employer_name_clean", "_packed"], ["case_number", "_packed"]]


def test_packed_texts_come_back_as_they_were(spark):
    """NULL, empty, separators, escapes, line breaks, bytes that are no UTF-8 and other types survive packing."""
    from sponsorlens.operators.transform import packed, unpacked
    odd = [None, "", "a", "\x1f", "\x1e", "\x1e0", "\x1e1", "\x1e2", "\x1e\x1f", "\x1f\x1e2", "\x1e0\x1f1", " ", "é\n\t𝄞", ",;|\\", "2"]
    rows = spark.createDataFrame([(i, a, b, None if i % 3 else 1.5, c) for i, (a, b, c) in
                                  enumerate((a, b, c) for a in odd for b in odd for c in (None, "", "\x1f"))],
                                 "n int, a string, b string, x double, c string")
    rows = rows.withColumn("bad", F.expr("cast(unhex('FF1F80') as string)"))
    for but in ([], ["b"]):
        there = packed(rows, but)
        assert set(there.columns) == {"n", "x", "_packed", *but}
        back = unpacked(there.withColumn("more", F.lit(1)), rows, but)
        assert back.columns == [*rows.columns, "more"]
        plain = lambda df: sorted(map(str, df.select(*[F.col(c).cast("binary") if t == "string" else F.col(c)
                                                       for c, t in rows.dtypes]).collect()))
        assert plain(back) == plain(rows)


def test_moved_rows_have_no_places(spark, wh, monkeypatch):
    """Rows are joined to employers and dealt to parts with the id of their place; its city and state join the
    dealt rows, also where the place has none or isn't known."""
    from sponsorlens.operators import transform as M
    seen, kept = [], M.packed
    monkeypatch.setattr(M, "packed", lambda rows, but=(): seen.append(rows.columns) or kept(rows, but))
    load_lca(wh, _raw_rows(spark, ROWS))
    assert len(seen) == 3 and not [c for cols in seen[1:] for c in cols if "city" in c or "state" in c]
    columns = ["case_number", "worksite_city", "worksite_state"]
    served, joined = (sorted(map(str, views.sponsorships(wh, columns, materialised=m).collect())) for m in (True, False))
    assert served == joined and len(served) == wh.read("lca_filings").count() > 0


def test_lines_move_with_what_their_rows_need(spark, tmp_path):
    """The fixture's lines are shuffled with the day they were shipped and one number for their flags; rows follow the
    flags as before, also where these are NULL."""
    from sponsorlens.sources.fixtures import raw_lca
    flags = [("R", "F"), ("R", "O"), ("R", None), ("N", "F"), ("N", "O"), ("N", None), ("A", "F"), ("A", None), (None, "F"), (None, "O"), (None, None)]
    at = "timestamp'1996-03-13 23:59:59'"
    tables = {
        "lineitem": spark.createDataFrame([(1, 2, 3, n, f, s) for n, (f, s) in enumerate(flags)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string")
                         .selectExpr("*", "5.0D l_quantity", "100.5D l_extendedprice", f"if(l_linenumber = 10, null, {at}) l_shipdate"),
        "orders": spark.sql(f"select 1L o_orderkey, 4L o_custkey, {at} o_orderdate, '5-LOW' o_orderpriority"),
        "customer": spark.sql("select 4L c_custkey, 'Customer#4' c_name"),
        "supplier": spark.sql("select 3L s_suppkey, 0 s_nationkey")}
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    raw = raw_lca(spark, str(tmp_path))
    found = {int(r.CASE_NUMBER.split("-")[-1]): (r.CASE_STATUS, r.DECISION_DATE) for r in raw.collect()}
    status = ["Denied", "Withdrawn", "Withdrawn", "Certified - Withdrawn", *["Certified"] * 7]
    assert found == {n: (s, None if n == 10 else "1996-03-13") for n, s in enumerate(status)}
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        plan = raw_lca(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    lines = [x for x in plan.splitlines() if "Project" in x and "l_orderkey" in x and "_status" in x and "CASE_NUMBER" not in x]
    assert lines and all("l_returnflag" not in x.split(" AS ")[-1] for x in lines)
