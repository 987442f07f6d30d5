"""FIXTURES.md §2: the hand-worked attribution, baseline and output."""

import datetime as dt
from decimal import Decimal

import pytest

import golden
from adlift.config import RunConfig
from adlift.contracts import DAILY_CONVERSIONS, schema_mismatches
from adlift.plans import daily

CFG = RunConfig(start="2024-10-02", end="2024-10-03")
D2, D3 = dt.date(2024, 10, 2), dt.date(2024, 10, 3)


@pytest.fixture(scope="module")
def st(spark):
    return daily.stages(golden.sources(spark), CFG)


def test_baseline_by_day(st):
    got = {(r["date"], r["sku"]): (r["avg_units_sold_no_ad_traffic"], r["avg_sales_no_ad_traffic"])
           for r in st.baseline.collect()}
    assert set(got) == {(D2, "A"), (D3, "A")}
    assert got[(D2, "A")][0] == pytest.approx(13 / 3) and got[(D2, "A")][1] == pytest.approx(40.0)
    assert got[(D3, "A")] == (pytest.approx(3.0), pytest.approx(30.0))


def test_winners(st):
    got = {r["order_id"]: r["placement_id"] for r in st.winners.collect()}
    assert got == {"o6": "p3", "o8": "p3", "o9": "p1"}


def test_increments(st):
    got = {r["order_id"]: (r["incremental_units_sold"], r["incremental_sales"]) for r in st.incremental.collect()}
    assert got["o6"] == (pytest.approx(7 - 13 / 3), pytest.approx(30.5))
    assert got["o8"] == (0.0, 0.0) and got["o9"] == (0.0, 0.0)


def test_output(spark):
    out = daily.daily_conversions(golden.sources(spark), CFG)
    assert schema_mismatches(out, DAILY_CONVERSIONS) == []
    rows = {r["sku"]: r for r in out.collect()}
    assert set(rows) == {"A", "B"}
    a, b = rows["A"], rows["B"]
    assert (a["units_sold"], a["sales"]) == (2, Decimal("30.50"))
    assert (b["units_sold"], b["sales"]) == (0, Decimal("0.00"))
    assert a["sales_date"] == D2 and (a["sales_year"], a["sales_month"], a["sales_day"]) == (2024, 10, 2)
    assert a["ad_name"] is None and b["ad_name"] == "ad 1"  # p3's ad is missing from the dimension
    assert a["campaign_name"] == "campaign 3" and a["daily_budget"] == Decimal("53.00")
    assert a["location_name"] == "Store 1" and a["attribution_method"] == "time_based_incremental"


def test_no_history_means_no_output(spark):
    sales = [s for s in golden.SALES if s[0] not in ("o1", "o2", "o3", "o4")]
    out = daily.daily_conversions(golden.sources(spark, sales=sales), CFG)
    assert out.count() == 0


def test_run_writes_and_reruns_idempotently(spark, tmp_path):
    path = str(tmp_path / "out")
    first = daily.run(spark, golden.sources(spark), CFG, path)
    assert first["written"] and first["groups"] == 2 and first["winner_rows"] == 3
    daily.run(spark, golden.sources(spark), CFG, path)
    from adlift.sources.sink import read_daily_conversions
    back = read_daily_conversions(spark, path)
    assert back.count() == 2
    assert read_daily_conversions(spark, path, D3, D3).count() == 0
    assert read_daily_conversions(spark, path, D2, D2).count() == 2
    assert schema_mismatches(back, DAILY_CONVERSIONS) == []


def test_run_with_empty_sales_writes_nothing(spark, tmp_path):
    src = golden.sources(spark, sales=[s for s in golden.SALES if s[3] < "2024-01-01"])
    got = daily.run(spark, src, CFG, str(tmp_path / "none"))
    assert got == {"written": False, "reason": "no sales in the read window", "days_cleared": []}
    assert not (tmp_path / "none").exists()


def test_rerun_with_empty_sources_clears_its_window(spark, tmp_path):
    from adlift.sources.sink import read_daily_conversions
    path, src = str(tmp_path / "out"), golden.sources(spark)
    daily.run(spark, src, CFG, path)
    src.placements = src.placements.where("false")
    appended = daily.run(spark, src, CFG.with_(write_mode="append"), path)
    assert appended["days_cleared"] == [] and read_daily_conversions(spark, path).count() == 2
    got = daily.run(spark, src, CFG, path)
    assert got["written"] is False and got["reason"] == "no placements in the read window"
    assert got["days_cleared"] == ["2024-10-02"] and read_daily_conversions(spark, path).count() == 0


def test_run_is_one_write_and_two_guards(spark, tmp_path):
    """Queries that Spark ran: the emptiness guard, the dimension ids, the write that observes all counts."""
    ran = lambda: spark._jsparkSession.sharedState().statusStore().executionsCount()
    src, before = golden.sources(spark), ran()
    got = daily.run(spark, src, CFG, str(tmp_path / "out"))
    assert ran() - before == 3
    assert {k: v for k, v in got.items() if k != "repeated_dimension_ids"} == {
        "written": True, "groups": 2, "units_sold": 2, "null_sales": 0, "null_daily_budget": 0, "winner_rows": 3,
        "unreadable_sale_times": 0, "days_cleared": []}


def test_run_finishes_what_a_failed_run_committed(spark, tmp_path, monkeypatch):
    from adlift.sources.daytable import DayTable
    from adlift.sources.sink import read_daily_conversions
    path = str(tmp_path / "out")
    daily.run(spark, golden.sources(spark), CFG, path)
    double = golden.sources(spark)
    double.categories = double.categories.unionByName(double.categories)
    with monkeypatch.context() as m:
        m.setattr(DayTable, "_publish_day", lambda self, commit, day: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            daily.run(spark, double, CFG, path)
    sales = lambda: {r["sku"]: r["sales"] for r in read_daily_conversions(spark, path).collect()}
    assert sales() == {"A": Decimal("61.00"), "B": Decimal("0.00")}
    # A run of another day publishes them before its own.
    daily.run(spark, double, CFG.with_(start=D3), path)
    assert sales() == {"A": Decimal("61.00"), "B": Decimal("0.00")} and DayTable(spark, path, ("a", "b", "c")).pending() is None


def test_strict_mode_refuses_repeated_dimension_ids(spark, tmp_path):
    src = golden.sources(spark)
    src.categories = src.categories.unionByName(src.categories)
    with pytest.raises(ValueError, match="categories"):
        daily.run(spark, src, CFG.with_(require_unique_dimension_ids=True), str(tmp_path / "x"))
    # The job's own behaviour: the repeated id doubles the matched rows, so A's
    # increments (7 - 13/3 and 30.50) count twice: 5.33 units -> 5, 61.00 sales.
    a = daily.daily_conversions(src, CFG).where("sku = 'A'").first()
    assert (a["units_sold"], a["sales"]) == (5, Decimal("61.00"))


def test_append_mode_rerun_duplicates_like_the_job(spark, tmp_path):
    from adlift.sources.sink import read_daily_conversions
    path = str(tmp_path / "appended")
    for _ in range(2):
        daily.run(spark, golden.sources(spark), CFG.with_(write_mode="append"), path)
    assert read_daily_conversions(spark, path).count() == 4


def test_rerun_clears_a_day_that_became_empty(spark, tmp_path):
    from adlift.sources.sink import read_daily_conversions
    path = str(tmp_path / "out")
    assert daily.run(spark, golden.sources(spark), CFG, path)["days_cleared"] == []
    src = golden.sources(spark)
    src.placements = src.placements.where("begintime >= 1727913600000 OR begintime < 1727827200000")
    again = daily.run(spark, src, CFG, path)
    assert again["groups"] == 0 and again["days_cleared"] == ["2024-10-02"]
    assert read_daily_conversions(spark, path).count() == 0


def test_timestamp_form_writes_only_its_own_day(spark, tmp_path):
    """A sale of 10-02 stored in partition 10-01 belongs to 10-02's output alone."""
    from pyspark.sql import functions as F

    from adlift.sources.sink import read_daily_conversions
    src = golden.sources(spark)
    src.sales = src.sales.withColumn("day", F.when(F.col("order_id") == "o6", F.lit("1")).otherwise(F.col("day")))
    cfg = CFG.with_(sales_date_source="timestamp")
    path = str(tmp_path / "out")
    daily.run(spark, src, cfg.with_(start=D2, end=D2), path)
    daily.run(spark, src, cfg.with_(start=dt.date(2024, 10, 1), end=dt.date(2024, 10, 1)), path)
    a = read_daily_conversions(spark, path).where("sku = 'A'").collect()
    got = {r["sales_day"]: (r["sales_date"], r["sales"]) for r in a}
    # The later run of 10-01 wrote its own day and left 10-02 as it was.
    assert got[2] == (D2, Decimal("30.50")) and set(got) == {1, 2}


def test_run_reports_unreadable_times_and_repeated_ids(spark, tmp_path):
    from pyspark.sql import functions as F
    src = golden.sources(spark)
    # o8 has no time at all, which is not an unreadable one.
    src.sales = src.sales.withColumn("timestamp", F.when(F.col("order_id") == "o9", "soon").when(
        F.col("order_id") != "o8", F.col("timestamp")))
    src.categories = src.categories.unionByName(src.categories)
    got = daily.run(spark, src, CFG, str(tmp_path / "out"))
    assert got["unreadable_sale_times"] == 1 and got["repeated_dimension_ids"]["categories"] > 0


def test_columns_come_from_whichever_table_has_them(spark):
    from pyspark.sql import functions as F
    src = golden.sources(spark)
    src.sales = src.sales.drop("state", "city").withColumn("status", F.lit("from sales"))
    src.organizations = src.organizations.withColumns({"state": F.lit("OR"), "city": F.lit("Portland")})
    src.campaigns = src.campaigns.drop("campaign_type")
    src.placements = src.placements.withColumn("campaign_type", F.lit("from placements"))
    with pytest.raises(ValueError, match="'status'.*'sales', 'campaigns'"):
        daily.daily_conversions(src, CFG)
    a = daily.daily_conversions(src, CFG.with_(column_owners={"status": "sales"})).where("sku = 'A'").first()
    assert (a["state"], a["city"]) == ("OR", "Portland")
    assert (a["status"], a["campaign_type"], a["product_name"]) == ("from sales", "from placements", "product A")
    assert (a["units_sold"], a["sales"], a["daily_budget"]) == (2, Decimal("30.50"), Decimal("53.00"))
    by_campaign = daily.daily_conversions(src, CFG.with_(column_owners={"status": "campaigns"}))
    assert by_campaign.where("sku = 'A'").first()["status"] == "active"


def test_missing_or_wrongly_chosen_owner_is_an_error(spark):
    src = golden.sources(spark)
    with pytest.raises(ValueError, match="only \\['sales'\\] have"):
        daily.daily_conversions(src, CFG.with_(column_owners={"city": "campaigns"}))
    with pytest.raises(ValueError, match="no owner can be chosen"):
        daily.daily_conversions(src, CFG.with_(column_owners={"sku": "sales"}))
    src.sales = src.sales.drop("city")
    with pytest.raises(ValueError, match="'city' is in none"):
        daily.daily_conversions(src, CFG)


def test_baseline_profile(spark):
    from adlift.operators.quality import baseline_profile
    # A sale without a SKU matches no ad: it is history, and history without an ad.
    sales = [*golden.SALES, ("o11", None, 1, "2024-10-01 09:00:00", 1, 1.0)]
    st = daily.stages(golden.sources(spark, sales=sales), CFG)
    got = {r["date"]: tuple(r)[1:] for r in
           baseline_profile(spark, CFG, st.sales, st.placements_history, st.baseline).collect()}
    first, ads = dt.date(2024, 9, 27), dt.date(2024, 10, 1)
    assert got == {D2: (first, 6, ads, 1, 5, 2), D3: (first, 11, ads, 5, 6, 2)}


def test_baseline_profile_without_history(spark):
    from adlift.operators.quality import baseline_profile
    cfg = CFG.with_(start=dt.date(2023, 1, 1), end=dt.date(2023, 1, 1))
    st = daily.stages(golden.sources(spark), cfg)
    rows = baseline_profile(spark, cfg, st.sales, st.placements_history, st.baseline).collect()
    assert [tuple(r) for r in rows] == [(cfg.start, None, 0, None, 0, 0, 0)]


def test_stage_counts_count_rows_without_a_key_but_pair_none(spark):
    from adlift.operators.attribution import funnel_by_day
    day = "2024-10-02"
    sales = [*golden.SALES, ("o11", None, 1, f"{day} 10:00:00", 1, 1.0), ("o12", "A", None, f"{day} 10:00:00", 1, 1.0)]
    ads = [*golden.PLACEMENTS, ("p6", [None], 1, f"{day} 09:00:00", f"{day} 11:00:00"),
           ("p7", ["A"], None, f"{day} 09:00:00", f"{day} 11:00:00")]
    counts = {}
    for name, (s, p) in {"plain": (golden.SALES, golden.PLACEMENTS), "nulls": (sales, ads)}.items():
        st = daily.stages(golden.sources(spark, sales=s, placements=p), CFG)
        r = funnel_by_day(st.sales_run, st.placements_run, CFG.grace_seconds).where(f"date = '{day}'").first()
        counts[name] = (r["n_sales"], r["n_ads"], r["n_pairs"], r["n_in_window"])
    # o6, o7, o8 meet p1, p2 and p3, o9 meets p1; p2 ended over two hours before o7 and o8,
    # p1 before o7, and p3 (13:00) one second too early for o7.
    assert counts["plain"] == (5, 4, 10, 6)
    assert counts["nulls"] == (7, 6, 10, 6)
