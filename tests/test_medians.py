"""Bounded exact medians against pandas."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sponsorlens.operators.medians import exact_medians, with_medians
from sponsorlens.plans import dashboard as H


def test_medians_equal_pandas(spark):
    r = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": r.choice(["a", "b", "c", None], 3000, p=[0.7, 0.2, 0.05, 0.05]),
                        "v": np.where(r.random(3000) < 0.1, np.nan, np.round(r.lognormal(11, 1, 3000), 2))})
    df = spark.createDataFrame([(k, None if v != v else float(v)) for k, v in pdf.itertuples(index=False)], "k string, v double")
    df = df.union(spark.createDataFrame([("none", None), ("one", 5.0), ("two", -1500.0), ("two", 2.0)], "k string, v double"))
    whole = df.toPandas()
    for width in (1000.0, 7.0, 1e9):
        got = {x.k: x.m for x in exact_medians(df, ["k"], "v", "m", width).collect()}
        want = {k: g.v.median() for k, g in whole.groupby("k", dropna=False) if g.v.notna().any()}
        assert {k if isinstance(k, str) else None: v for k, v in want.items()} == got
    assert exact_medians(df, [], "v", "m").first().m == whole.v.median()
    both = {x.k: x.m for x in with_medians(df.groupBy("k").agg(F.count("*").alias("n")), df, ["k"], "v", "m").collect()}
    assert both["none"] is None and both["one"] == 5.0 and None in both


def test_no_value_at_all(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert exact_medians(df, ["k"], "v", "m").count() == 0
    one = with_medians(df.agg(F.count("*").alias("n")), df, [], "v", "m").first()
    assert (one.n, one.m) == (0, None)


def test_leading_rows_of_a_large_cap(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.lit("z").alias("_y"))
    for cap in (0, 1, 777, 5000, 9000):
        got = sorted(r.x for r in H.leading_rows(df, [F.asc("x")], cap).collect())
        assert got == list(range(min(cap, 5000)))


def test_leading_rows_deal_only_what_may_lead(spark, monkeypatch):
    """With the order's first number, rows beyond it aren't dealt, and the leading rows are the same: many and few
    values, NULLs, NaN, an order by a value of which most rows have one."""
    from sponsorlens.operators import topk
    rows = spark.range(3000).selectExpr(
        "id", "if(id % 11 = 0, null, id * 7919 % 3000) many", "cast(if(id % 5 = 0, null, id % 3) as int) few",
        "if(id % 13 = 0, double('nan'), if(id % 17 = 0, null, id % 50 / 2)) x", "if(id < 2900, 1L, id) most").cache()
    frame = type(rows)
    dealt, kept = [], frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda df, *a: dealt.append(df.count()) or kept(df, *a))
    for column in ("many", "few", "x", "most"):
        for direction, first in (("desc", F.desc_nulls_last(column)), ("asc", F.asc_nulls_last(column))):
            for cap in (0, 200, 2900):
                want, got = ([r.id for r in topk.leading_rows(rows, [first, F.asc("id")], cap, f).collect()] for f in (None, (column, direction)))
                assert got == want and len(got) == min(cap, 3000)
                assert dealt[-2] == 3000 and (column != "many" or cap != 200 or dealt[-1] < 400)


def test_flags_are_looked_up_for_the_rows_shown(spark, monkeypatch):
    """PERM flags and counts are joined to the rows of a download, and to the groups of a view, after these are cut."""
    from sponsorlens.operators import filters as FL
    s = spark.range(600).selectExpr(
        "if(id % 7 = 0, null, concat('E', id % 40)) employer_name", "concat('T', id % 3) job_title", "'c' job_category", "'s' soc_code",
        "'t' soc_title", "concat('C', id % 5) worksite_city", "'CA' worksite_state", "cast(2000 + id % 9 as int) fiscal_year",
        "'H-1B' visa_class", "'Certified' case_status", "double(id % 100) annual_wage", "1.0D prevailing_wage", "false is_university")
    gc = spark.createDataFrame([("E1",), ("E2",), ("E2",), (None,)], "employer_name string")
    asked, mark = [], FL.mark_gc_sponsor
    monkeypatch.setattr(FL, "mark_gc_sponsor", lambda df, *a: asked.append(df.count()) or mark(df, *a))
    order = FL.order_for("year_desc", grouped=False) + [F.asc_nulls_last(c) for c in H.DOWNLOAD_COLUMNS]
    want = [tuple(r) for r in mark(s.select(H.DOWNLOAD_COLUMNS), gc, "green_card_sponsor").orderBy(*order).limit(50).collect()]
    assert [tuple(r) for r in H.download_rows(s, "year_desc", gc, 50).collect()] == want and asked == [50]
    for mode in FL.GROUP_ORDERS:
        groups, shown = H.grouped_view(s, mode, gc, None), H.grouped_view(s, mode, gc, 20)
        assert [tuple(r) for r in shown.collect()] == [tuple(r) for r in groups.orderBy(*FL.order_for(mode, grouped=True)).limit(20).collect()]
        plan = shown._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join") < plan.index("GlobalLimit")


def test_suggestions_for_short_texts_are_empty(spark):
    df = spark.createDataFrame([("ab",)], "t string")
    assert H.suggestions(df, "t", " a ").collect() == [] and H.suggestions(df, "t", "ab").first().n == 1


def test_salary_is_the_same_for_few_and_many_groups(spark, monkeypatch):
    from sponsorlens.plans import api

    rows = spark.range(4000).selectExpr("concat('e', id % 40) AS employer_name", "CASE WHEN id % 7 > 0 THEN 1000.0 * (id % 97) + id % 3 END AS annual_wage")
    few = [tuple(r) for r in api.salary(rows, "employer").collect()]
    monkeypatch.setattr(api, "FEW_GROUPS", 10)
    many = [tuple(r) for r in api.salary(rows, "employer").collect()]
    assert few == many and len(few) == 40
