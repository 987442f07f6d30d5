"""FIXTURES.md §2 small cases: one behaviour each."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import golden
from adlift.config import RunConfig
from adlift.functions import (
    clamped_increment, date_from_epoch_seconds, date_from_parts, epoch_ms_to_seconds, money,
    partition_day_predicate, resolve_choice, sales_date_padded, truncated_units,
)
from adlift.plans import daily
from adlift.plans.calendar import run_calendar


def test_choice_struct(spark):
    df = spark.createDataFrame([((1.5, None),), ((None, 2),), ((None, None),), (None,)],
                               "c struct<double: double, int: int>")
    assert [r[0] for r in df.select(resolve_choice(df, "c")).collect()] == [1.5, 2.0, None, None]


def test_choice_plain_text_never_fails(spark):
    df = spark.createDataFrame([("1.25",), ("x",), (None,)], "c string")
    assert [r[0] for r in df.select(resolve_choice(df, "c")).collect()] == [1.25, None, None]


def test_sales_date_from_parts_padded_or_not(spark):
    df = spark.createDataFrame([("2024", "7", "1"), ("2024", "07", "01"), ("2024", "13", "1"), ("2024", "2", "30")],
                               "y string, m string, d string")
    got = [r[0] for r in df.select(date_from_parts("y", "m", "d")).collect()]
    assert got == [dt.date(2024, 7, 1), dt.date(2024, 7, 1), None, None]
    got = [r[0] for r in df.limit(2).select(sales_date_padded("y", "m", "d")).collect()]
    assert got == [dt.date(2024, 7, 1), dt.date(2024, 7, 1)]


def test_epoch_ms(spark):
    df = spark.createDataFrame([(1727740800999,)], "ms long")
    r = df.select(epoch_ms_to_seconds("ms").alias("s"), date_from_epoch_seconds(epoch_ms_to_seconds("ms")).alias("d")).first()
    assert r["s"] == 1727740800 and r["d"] == dt.date(2024, 10, 1)


def test_epoch_day_ignores_session_zone(spark):
    df = spark.createDataFrame([(1727740800,)], "s long")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert df.select(date_from_epoch_seconds("s")).first()[0] == dt.date(2024, 10, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_truncation_and_money(spark):
    df = spark.createDataFrame([(2.9,), (0.99,), (2.9999999999999996,), (0.005,)], "x double")
    assert [r[0] for r in df.select(truncated_units("x")).collect()] == [2, 0, 3, 0]
    assert [r[0] for r in df.select(money("x")).collect()] == [
        Decimal("2.90"), Decimal("0.99"), Decimal("3.00"), Decimal("0.01")]


def test_clamped_increment_null_baseline(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, 7.0), (5.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(clamped_increment("a", "b")).collect()] == [0.0, 0.0, 3.0]


def test_partition_predicate(spark):
    df = spark.createDataFrame([(2024, 9, 30), (2024, 10, 1), (2024, 10, 3), (2024, 10, 4)], "year int, month int, day int")
    got = df.where(partition_day_predicate(dt.date(2024, 10, 1), dt.date(2024, 10, 3))).count()
    assert got == 2


def test_run_calendar(spark):
    cfg = RunConfig(start="2024-02-27", end="2024-03-01")
    assert [r[0] for r in run_calendar(spark, cfg).collect()] == [
        dt.date(2024, 2, 27), dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]


def test_config_validation():
    with pytest.raises(ValueError):
        RunConfig(start="2024-10-03", end="2024-10-02")
    assert RunConfig(start="2024-10-01", end="2024-10-03").read_start == dt.date(2024, 8, 2)


def _baseline_days(spark, sales):
    cfg = RunConfig(start="2024-10-02", end="2024-10-02")
    st = daily.stages(golden.sources(spark, sales=sales, placements=[]), cfg)
    return {r["sku"]: r["avg_units_sold_no_ad_traffic"] for r in st.baseline.collect()}


def test_lookback_edge(spark):
    # D = 2024-10-02: D-60 = 2024-08-03 is in, D-61 = 2024-08-02 is out.
    inside = [("a", "X", 1, "2024-08-03 23:59:59", 4, 1.0)]
    outside = [("b", "Y", 1, "2024-08-02 12:00:00", 4, 1.0)]
    assert _baseline_days(spark, inside + outside) == {"X": 4.0}


def test_three_rows_pooled_over_locations(spark):
    rows = [("a", "X", 1, "2024-10-01 10:00:00", 1, 1.0), ("b", "X", 2, "2024-10-01 09:00:00", 2, 1.0),
            ("c", "X", 3, "2024-09-30 10:00:00", 3, 1.0), ("d", "X", 1, "2024-09-29 10:00:00", 100, 1.0)]
    assert _baseline_days(spark, rows) == {"X": 2.0}


def test_recurring_order_one_winner_per_day(spark):
    sales = [("o1", "A", 1, "2024-10-02 10:00:00", 1, 1.0), ("o1", "A", 1, "2024-10-03 10:00:00", 1, 1.0)]
    placements = [("p1", ["A"], 1, "2024-10-02 09:00:00", "2024-10-02 11:00:00"),
                  ("p2", ["A"], 1, "2024-10-03 09:00:00", "2024-10-03 11:00:00")]
    cfg = RunConfig(start="2024-10-02", end="2024-10-03")
    st = daily.stages(golden.sources(spark, sales=sales, placements=placements), cfg)
    assert sorted((str(r["date"]), r["placement_id"]) for r in st.winners.collect()) == [
        ("2024-10-02", "p1"), ("2024-10-03", "p2")]


def test_two_lines_one_triple_keeps_one(spark):
    sales = [("o1", "A", 1, "2024-10-02 10:00:00", 1, 1.0), ("o1", "A", 1, "2024-10-02 10:30:00", 5, 1.0)]
    placements = [("p1", ["A"], 1, "2024-10-02 09:00:00", "2024-10-02 11:00:00")]
    cfg = RunConfig(start="2024-10-02", end="2024-10-02")
    st = daily.stages(golden.sources(spark, sales=sales, placements=placements), cfg)
    rows = st.winners.collect()
    assert len(rows) == 1 and rows[0]["units_sold"] == 1


def test_grace_is_inclusive(spark):
    sales = [("o1", "A", 1, "2024-10-02 13:00:00", 1, 1.0), ("o2", "A", 1, "2024-10-02 13:00:01", 1, 1.0)]
    placements = [("p1", ["A"], 1, "2024-10-02 09:00:00", "2024-10-02 11:00:00")]
    cfg = RunConfig(start="2024-10-02", end="2024-10-02")
    st = daily.stages(golden.sources(spark, sales=sales, placements=placements), cfg)
    assert [r["order_id"] for r in st.winners.collect()] == ["o1"]


def test_placement_belongs_to_its_begin_day(spark):
    # Starts 23:00 on 10-01, runs past midnight: it cannot credit a 10-02 sale.
    sales = [("o1", "A", 1, "2024-10-02 00:30:00", 1, 1.0)]
    placements = [("p1", ["A"], 1, "2024-10-01 23:00:00", "2024-10-02 01:00:00")]
    cfg = RunConfig(start="2024-10-01", end="2024-10-02")
    st = daily.stages(golden.sources(spark, sales=sales, placements=placements), cfg)
    assert st.winners.count() == 0


def test_dimension_miss_keeps_row(spark):
    from adlift.operators.enrich import enrich
    facts = spark.createDataFrame([(1, 99, 1, 1, 1, 1, 1)],
                                  "aislecategoryid long, campaignid long, retailerorgid long, location_id int, "
                                  "adgroupid long, winningadid long, x int")
    src = golden.sources(spark)
    dims = {n: src.dimension(n) for n in ("categories", "campaigns", "organizations", "locations", "ad_groups", "ads")}
    r = enrich(facts, dims).collect()
    assert len(r) == 1 and r[0]["campaign_name"] is None and r[0]["category_name"] == "Snacks"


def test_jdbc_options():
    from adlift.sources.catalog import jdbc_options
    assert jdbc_options("jdbc:x:y", "ads", {"user": "u"}) == {
        "url": "jdbc:x:y", "dbtable": "ads", "fetchsize": "10000", "user": "u"}
    split = jdbc_options("jdbc:x:y", "ads", fetch_size=5, partition_column="id", lower=0, upper=9, partitions=3)
    assert (split["fetchsize"], split["partitionColumn"], split["numPartitions"]) == ("5", "id", "3")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x:y", "ads", partition_column="id")


def test_jdbc_query_replaces_the_table():
    from adlift.sources.catalog import jdbc_options
    got = jdbc_options("jdbc:x", "ads", {"query": "SELECT id, name FROM ads", "driver": "d.D"})
    assert "dbtable" not in got and got["driver"] == "d.D"
    with pytest.raises(ValueError, match="cannot be split"):
        jdbc_options("jdbc:x", "ads", {"query": "SELECT 1"}, partition_column="id", lower=0, upper=1, partitions=2)


def test_command_line_jdbc_options_reach_the_reader(spark, monkeypatch):
    from adlift import cli
    from adlift.sources import catalog
    seen = {}

    def read(_, url, table, properties, **options):
        seen[table] = catalog.jdbc_options(url, table, properties, **options)
    monkeypatch.setattr(catalog, "read_jdbc_dimension", read)
    monkeypatch.setattr(catalog, "read_table", lambda *_: None)
    args = cli.parse_args("--start-date 2024-10-01 --end-date 2024-10-01 --sales s --placements p --output o --jdbc-url jdbc:x "
                          "--jdbc-fetch-size 500 --jdbc-partition ads=id,0,1000,4".split())
    catalog.from_catalog(spark, args.sales, args.placements, None, args.jdbc_url, {"user": "u"}, cli.jdbc_read(args))
    assert len(seen) == 6 and {o["fetchsize"] for o in seen.values()} == {"500"}
    assert seen["ads"]["partitionColumn"] == "id" and seen["ads"]["numPartitions"] == "4"
    assert "partitionColumn" not in seen["campaigns"] and seen["campaigns"]["user"] == "u"


def test_sub_second_sale_time_is_not_inside_the_grace(spark):
    from adlift.functions.dates import epoch_seconds_from_text
    df = spark.createDataFrame([("2024-10-02 15:00:00.5",), ("2024-10-02 15:00:00",), ("x",)], "t string")
    at = golden.epoch("2024-10-02 15:00:00")
    assert [r[0] for r in df.select(epoch_seconds_from_text("t")).collect()] == [at + 1, at, None]


def test_placements_without_id_column(spark):
    src = golden.sources(spark)
    src.placements = src.placements.drop("placement_id")
    st = daily.stages(src, RunConfig(start="2024-10-02", end="2024-10-03"))
    got = sorted((r["order_id"], r["winningadid"]) for r in st.winners.collect())
    assert got == [("o6", 1003), ("o8", 1003), ("o9", 1001)]


def test_choice_struct_bids_in_the_job(spark):
    src = golden.sources(spark)
    src.placements = src.placements.withColumn(
        "winningbidamount", F.struct(F.lit(None).cast("double").alias("double"), F.lit(3).alias("int")))
    st = daily.stages(src, RunConfig(start="2024-10-02", end="2024-10-03"))
    assert {r["winningbidamount"] for r in st.winners.collect()} == {3.0}
