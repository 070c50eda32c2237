"""Raw CSV scans: header normalisation, missing columns, NA tokens, row order."""
from sponsorlens.operators import transform as TR
from sponsorlens.sources.raw import list_raw_files, read_raw_csv


def test_headers_missing_columns_and_na(spark, tmp_path):
    a = tmp_path / "LCA_FY2024.csv"
    a.write_text(" case_number ,Employer_Name,WAGE_RATE_OF_PAY_FROM,WAGE_UNIT_OF_PAY,RECEIVED_DATE\n"
                 'I-200-0001,"Acme, Inc.","$100,000",Year,2024-10-02\n'
                 "I-200-0002,Beta LLC,N/A,Hour,10/01/2024\n")
    b = tmp_path / "LCA_FY2025.csv"
    b.write_text("EMPLOYER_NAME,CASE_NUMBER,JOB_TITLE\n"
                 "Gamma,I-200-0003,data engineer\n")
    raw = read_raw_csv(spark, [str(a), str(b)])
    rows = {r.CASE_NUMBER: r for r in raw.collect()}
    assert rows["I-200-0001"].EMPLOYER_NAME == "Acme, Inc." and rows["I-200-0001"].JOB_TITLE is None
    assert rows["I-200-0002"].WAGE_RATE_OF_PAY_FROM is None              # N/A token
    assert rows["I-200-0003"].EMPLOYER_NAME == "Gamma"                   # header order differs
    assert rows["I-200-0003"].source_file == "LCA_FY2025.csv"
    staged = {r.case_number: r for r in TR.stage_lca(raw).collect()}
    assert staged["I-200-0001"].annual_wage == 100000.0 and staged["I-200-0001"].fiscal_year == 2025
    assert staged["I-200-0002"].fiscal_year == 2025
    assert staged["I-200-0003"].job_category == "Data"


def test_keep_last_in_file_order_across_splits(spark, tmp_path):
    """Row order survives a file cut into several splits."""
    p = tmp_path / "big.csv"
    lines = ["CASE_NUMBER,EMPLOYER_NAME,JOB_TITLE"]
    for rep in range(3):
        for i in range(3000):
            lines.append(f"I-200-{i:05d},Emp {i},title {rep}")
    p.write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        raw = read_raw_csv(spark, [str(p)])
        assert raw.rdd.getNumPartitions() > 1
        titles = {r.job_title for r in TR.stage_lca(raw).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert titles == {"TITLE 2"}


def test_file_listing_routes(spark, tmp_path):
    (tmp_path / "LCA_2025.csv").write_text("CASE_NUMBER\nx\n")
    (tmp_path / "PERM_FY2025.csv").write_text("CASE_NO\nx\n")
    (tmp_path / "notes.txt").write_text("x")
    got = {r.file_name: r.route for r in list_raw_files(spark, str(tmp_path)).collect()}
    assert got == {"LCA_2025.csv": "lca", "PERM_FY2025.csv": "perm"}


def test_line_breaks_inside_cells(spark, tmp_path):
    """Only the file that has them is scanned whole; no row is made up."""
    a = tmp_path / "LCA_A.csv"
    a.write_text('CASE_NUMBER,EMPLOYER_NAME,JOB_TITLE\nI-200-0001,"Acme\nInc","a ""b"""\nI-200-0002,Beta,x\n')
    b = tmp_path / "LCA_B.csv"
    b.write_text('CASE_NUMBER,EMPLOYER_NAME,JOB_TITLE\nI-200-0003,"Gamma, Ltd",y\n')
    from sponsorlens.sources.raw import _file_heads
    heads = {p.rsplit("/", 1)[-1]: x for p, x in _file_heads(spark, [str(a), str(b)], ["CASE_NUMBER"]).items()}
    assert heads == {"LCA_A.csv": ("CASE_NUMBER,EMPLOYER_NAME,JOB_TITLE", True), "LCA_B.csv": ("CASE_NUMBER,EMPLOYER_NAME,JOB_TITLE", False)}
    rows = {r.CASE_NUMBER: (r.EMPLOYER_NAME, r.JOB_TITLE) for r in read_raw_csv(spark, [str(a), str(b)]).collect()}
    assert rows == {"I-200-0001": ("Acme\nInc", 'a "b"'), "I-200-0002": ("Beta", "x"), "I-200-0003": ("Gamma, Ltd", "y")}


def test_layouts_of_odd_files(spark, tmp_path):
    """Equal names in two folders, a name with a blank, no known header, a header alone, an empty file."""
    for d in ("x", "y"):
        (tmp_path / d).mkdir()
    (tmp_path / "x" / "f.csv").write_text("CASE_NUMBER,EMPLOYER_NAME\nI-200-0001,Acme\n")
    (tmp_path / "y" / "f.csv").write_text(' employer_name , case_number\n"Be\nta",I-200-0002\n')
    (tmp_path / "a b.csv").write_text("CASE_NUMBER,EMPLOYER_NAME\nI-200-0003,Gamma\n")
    (tmp_path / "none.csv").write_text("p,q\n1,2\n")
    (tmp_path / "head.csv").write_text("CASE_NUMBER,EMPLOYER_NAME\n")
    (tmp_path / "empty.csv").write_text("")
    paths = [str(p) for p in tmp_path.rglob("*.csv")]
    rows = read_raw_csv(spark, paths, ["CASE_NUMBER", "EMPLOYER_NAME"]).collect()
    assert sorted((r.CASE_NUMBER, r.EMPLOYER_NAME) for r in rows if r.CASE_NUMBER) == [
        ("I-200-0001", "Acme"), ("I-200-0002", "Be\nta"), ("I-200-0003", "Gamma")]
    assert sum(r.CASE_NUMBER is None for r in rows) == 1               # the line of the file without known headers
    assert read_raw_csv(spark, [str(tmp_path / "empty.csv")], ["CASE_NUMBER"]).count() == 0
