"""Incremental load: landed files picked up by a file-arrival stream."""
import shutil

from sponsorlens.sources.sample import make_rows, write_csv
from sponsorlens.streaming.incremental import start_incremental_load


def _land(spark, tmp_path, landing, n, seed, name):
    out = str(tmp_path / f"gen-{name}")
    write_csv(make_rows(spark, n, seed=seed).coalesce(1), out)
    import glob
    shutil.copy(glob.glob(out + "/part-*.csv")[0], landing / name)


def test_available_now_loads_new_files_once(spark, wh, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    ckpt = str(tmp_path / "ckpt")
    _land(spark, tmp_path, landing, 120, 11, "LCA_A.csv")
    _land(spark, tmp_path, landing, 80, 12, "LCA_B.csv")
    q = start_incremental_load(spark, wh, str(landing), ckpt, max_files_per_trigger=1)
    q.awaitTermination(300)
    assert wh.read("lca_filings").count() == 200
    assert len(wh.read("etl_runs").collect()) == 2          # one micro-batch per file
    # restart: only the new file is loaded
    _land(spark, tmp_path, landing, 50, 13, "LCA_C.csv")
    q = start_incremental_load(spark, wh, str(landing), ckpt)
    q.awaitTermination(300)
    assert wh.read("lca_filings").count() == 250
    assert sorted(r.file_name for r in wh.read("etl_runs").collect()) == ["LCA_A.csv", "LCA_B.csv", "LCA_C.csv"]
