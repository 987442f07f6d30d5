"""Plan shape and scale properties: pruning, no pair-producing joins, partial top-k,
set form == day-by-day form, and a hot key checked against brute force."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import golden
from adlift.config import RunConfig, fixture_config
from adlift.operators.baseline import baseline_single_day
from adlift.plans import daily
from adlift.sources import fixtures
from adlift.sources.catalog import from_catalog
from conftest import SF_MID, SF_SMALL


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def partitioned(spark, tmp_path_factory):
    """The driver tables' sales and placements as year/month/day directories."""
    root = tmp_path_factory.mktemp("partitioned")
    src = fixtures.load(spark, SF_SMALL)
    src.sales.write.partitionBy("year", "month", "day").parquet(str(root / "sales"))
    src.placements.write.partitionBy("year", "month", "day").parquet(str(root / "placements"))
    for name in ("categories", "campaigns", "organizations", "locations", "ad_groups", "ads"):
        src.dimension(name).write.parquet(str(root / name))
    dims = {n: str(root / n) for n in ("categories", "campaigns", "organizations", "locations", "ad_groups", "ads")}
    return from_catalog(spark, str(root / "sales"), str(root / "placements"), dims), src


def test_partition_pruning_reaches_the_scan(partitioned):
    src, _ = partitioned
    cfg = RunConfig(start="2024-01-20", end="2024-01-22", lookback_days=5)
    plan = plan_text(daily.stages(src, cfg).sales_run)
    assert "PartitionFilters: [" in plan and "isnotnull(year" in plan.lower()
    assert "PartitionFilters: []" not in plan


def test_partitioned_source_gives_same_output(spark, partitioned):
    src, derived = partitioned
    cfg = fixture_config()
    a = daily.daily_conversions(src, cfg)
    b = daily.daily_conversions(derived, cfg)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_no_pair_producing_joins(spark):
    out = daily.daily_conversions(fixtures.load(spark, SF_SMALL), fixture_config())
    plan = plan_text(out)
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct"):
        assert bad not in plan
    # row_number filters run as a partial (map-side) top-k before their shuffle.
    assert "WindowGroupLimit" in out._jdf.queryExecution().optimizedPlan().toString()


def test_single_day_equals_all_days(spark):
    src = fixtures.load(spark, SF_SMALL)
    cfg = fixture_config()
    st = daily.stages(src, cfg)
    for day in (dt.date(2024, 1, 2), dt.date(2024, 1, 15), dt.date(2024, 1, 30)):
        one = baseline_single_day(st.sales, st.ad_keys, day, cfg).select(
            "sku", F.round("avg_units_sold_no_ad_traffic", 9).alias("u"), F.round("avg_sales_no_ad_traffic", 9).alias("s"))
        many = st.baseline.where(F.col("date") == day).select(
            "sku", F.round("avg_units_sold_no_ad_traffic", 9).alias("u"), F.round("avg_sales_no_ad_traffic", 9).alias("s"))
        assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def hot_key_case():
    """A third of all sales and placements on one (day, sku, location)."""
    rnd = random.Random(7)
    day = "2024-10-02"
    sales, placements = [], []
    for i in range(600):
        hot = i % 3 == 0
        sku, loc = ("H", 1) if hot else (f"S{rnd.randrange(20)}", rnd.randrange(4))
        t = f"{day} {rnd.randrange(24):02d}:{rnd.randrange(60):02d}:{rnd.randrange(60):02d}"
        sales.append((f"o{i}", sku, loc, t, 1 + rnd.randrange(5), float(rnd.randrange(100))))
    for i in range(600):
        hot = i % 3 == 0
        skus, loc = (["H"], 1) if hot else ([f"S{rnd.randrange(20)}"], rnd.randrange(4))
        h, m = rnd.randrange(23), rnd.randrange(60)
        placements.append((f"p{i:04d}", skus, loc, f"{day} {h:02d}:{m:02d}:00", f"{day} {h + rnd.randrange(2):02d}:{m:02d}:30"))
    return day, sales, placements


def set_conf(spark, settings):
    """Set them, and return what puts the old values back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    return lambda: [spark.conf.unset(k) if v is None else spark.conf.set(k, v) for k, v in before.items()]


# Joins of the size of a test's tables are shuffled, and partitions of some KB count as skewed.
SPLITTING = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}


def test_hot_key_matches_brute_force(spark):
    day, sales, placements = hot_key_case()
    st = daily.stages(golden.sources(spark, sales=sales, placements=placements), RunConfig(start=day, end=day))
    got = sorted((r["order_id"], r["placement_id"]) for r in st.winners.collect())

    # Brute force: every (sale, placement) pair of a key, the job's two-branch
    # test, latest end wins (ties: begin, then id, all descending).
    con = duckdb.connect()
    con.execute("CREATE TABLE s (o VARCHAR, sku VARCHAR, loc INT, ts BIGINT)")
    con.executemany("INSERT INTO s VALUES (?, ?, ?, ?)", [(o, k, l, golden.epoch(t)) for o, k, l, t, _, _ in sales])
    con.execute("CREATE TABLE p (id VARCHAR, sku VARCHAR, loc INT, b BIGINT, e BIGINT)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?, ?, ?)",
                    [(i, k[0], l, golden.epoch(b), golden.epoch(e)) for i, k, l, b, e in placements])
    want = con.execute("""
        SELECT o, id FROM (
          SELECT s.o, p.id, row_number() OVER (PARTITION BY s.o ORDER BY p.e DESC, p.b DESC, p.id DESC) rn
          FROM s JOIN p ON s.sku = p.sku AND s.loc = p.loc
          WHERE (p.b <= s.ts AND p.e >= s.ts) OR p.e >= s.ts - 7200) WHERE rn = 1 ORDER BY 1, 2""").fetchall()
    assert got == sorted(want) and len(want) > 50


def test_attribution_reads_each_fact_once_and_broadcasts_no_fact(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(daily.stages(fixtures.load(spark, SF_SMALL), fixture_config()).winners)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("events.parquet") == 2 and "Broadcast" not in plan


def test_history_is_read_once_for_gate_and_baseline_join(spark):
    """Executed plan: sales and placements once for the run days and once for history."""
    out = daily.daily_conversions(fixtures.load(spark, SF_SMALL), fixture_config())
    out.collect()
    final = plan_text(out).split("== Initial Plan ==")[0]
    assert final.count("events.parquet") == 4 and "ReusedExchange" in final


@pytest.mark.parametrize("name, reads", [("dimension_coverage", 1), ("stage_counts", 3), ("baseline_profile", 2)])
def test_reports_read_each_fact_a_fixed_number_of_times(spark, name, reads):
    """Coverage from the winners alone; the funnel from one aggregate, the winners and the baseline."""
    from adlift.queries import QUERIES
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    assert plan.count("events.parquet") == 2 * reads


@pytest.mark.parametrize("kind", ["double", "string"])
def test_begin_day_takes_fractions_and_bad_text(spark, kind):
    last = 1727913599999.5  # 2024-10-02 23:59:59.9995
    rows = [(str(last),), ("1727827200000",), ("1727913600000",), ("1727827199999",)] + ([("bad",)] if kind == "string" else [])
    df = spark.createDataFrame(rows, "begintime string").select(F.col("begintime").cast(kind).alias("begintime"))
    assert daily.begin_day_between(df, dt.date(2024, 10, 2), dt.date(2024, 10, 2)).count() == 2


def test_command_line_run(spark, partitioned, tmp_path):
    """The job as scheduled: a date window and table locations on the command line."""
    from adlift.cli import main
    from adlift.sources.sink import read_daily_conversions

    src, derived = partitioned
    root = tmp_path / "cli"
    names = ("categories", "campaigns", "organizations", "locations", "ad_groups", "ads")
    # The module fixture wrote every input under one folder; find it from the sales path.
    base = src.sales.inputFiles()[0].split("/sales/")[0].replace("file:", "")
    argv = ["--start-date", "2024-01-01", "--end-date", "2024-01-30",
            "--sales", f"{base}/sales", "--placements", f"{base}/placements", "--output", str(root)]
    for n in names:
        argv += ["--dimension", f"{n}={base}/{n}"]
    got = main(argv, spark)
    want = daily.daily_conversions(derived, fixture_config())
    back = read_daily_conversions(spark, str(root))
    assert got["written"] and got["groups"] == back.count() == want.count() > 0
    assert back.exceptAll(want).count() == 0


def test_run_with_no_winners_in_window(spark, partitioned, tmp_path):
    """A window whose output is empty: nothing written, counts observed as zero."""
    src, _ = partitioned
    got = daily.run(spark, src, RunConfig(start="2024-01-10", end="2024-01-12"), str(tmp_path / "empty"))
    assert got["written"] and got["groups"] == 0 and got["winner_rows"] == 0


def test_attribution_splits_a_hot_key_at_runtime(spark):
    """Winners and candidate counts: the hot key's lines are split, placements are not copied."""
    from adlift.operators.attribution import candidate_counts

    day, sales, placements = hot_key_case()
    # A hot second, too: every hot line has one time.
    many = [(f"x{i}", "H", 1, f"{day} 12:00:00", 1, 1.0) for i in range(6000)]
    src = golden.sources(spark, sales=sales + many, placements=placements)
    cfg = RunConfig(start=day, end=day)
    plain = sorted(map(tuple, daily.stages(src, cfg).winners.select("order_id", "sku", "placement_id").collect()))
    back = set_conf(spark, SPLITTING)
    try:
        st = daily.stages(src, cfg)
        for df in (st.winners, candidate_counts(st.sales_run, st.placements_run, cfg.grace_seconds)):
            df.collect()
            plan = plan_text(df).split("== Initial Plan ==")[0]
            assert "SortMergeJoin(skew=true)" in plan
            # The only rows made from one are those of the tracked SKUs.
            assert plan.count("Generate explode") == 1 or "Generate explode(trackedskus" in plan
        assert sorted(map(tuple, st.winners.select("order_id", "sku", "placement_id").collect())) == plain
    finally:
        back()


def test_candidate_counts_match_pairs(spark):
    from adlift.operators.attribution import candidate_counts
    day, sales, placements = hot_key_case()
    st = daily.stages(golden.sources(spark, sales=sales, placements=placements), RunConfig(start=day, end=day))
    grain = ["date", "order_id", "sku", "location_id"]
    pairs = st.sales_run.join(st.placements_run.select("date", "sku", "location_id", "end_sec"), ["date", "sku", "location_id"])
    want = pairs.groupBy(*grain).agg(F.count("*").alias("n_pairs"),
                                     F.count(F.when(F.col("end_sec") >= F.col("ts_sec") - 7200, 1)).alias("n_in_window"))
    got = candidate_counts(st.sales_run, st.placements_run, 7200).select(want.columns)
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_winner_without_ids_does_not_depend_on_input_order(spark):
    t = ("2024-10-02 08:00:00", "2024-10-02 12:00:00")
    st = []
    for flip in (False, True):
        src = golden.sources(spark, sales=[("o1", "A", 1, "2024-10-02 11:00:00", 1, 1.0)],
                             placements=[("p1", ["A"], 1, *t), ("p2", ["A"], 1, *t)])
        offers = F.when((F.col("placement_id") == "p1") == F.lit(flip), "X").otherwise("Y")
        src.placements = src.placements.withColumn("offerCode", offers).withColumn("campaignid", F.lit(1)) \
            .withColumn("winningadid", F.lit(1)).withColumn("adgroupid", F.lit(1)).drop("placement_id")
        st.append(daily.stages(src, RunConfig(start="2024-10-02", end="2024-10-02")).winners.first()["offercode"])
    assert st == ["Y", "Y"]


def test_nothing_stays_persisted(spark, tmp_path):
    held = lambda: spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    src, before = golden.sources(spark), held()
    cfg = RunConfig(start="2024-10-02", end="2024-10-03")
    daily.daily_conversions(src, cfg).count()
    daily.run(spark, src, cfg, str(tmp_path / "out"))
    assert held() == before


def test_day_loop_equals_one_plan(spark):
    """SURVEY §5.3: the job's day-by-day loop and the one-plan form give the same rows."""
    src = fixtures.load(spark, SF_MID)
    # 2024-01-01 has no history (gated out); the next three days have output.
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(4)]
    whole = daily.daily_conversions(src, RunConfig(start=days[0], end=days[-1]))
    assert whole.count() > 0
    loop = None
    for d in days:
        one = daily.daily_conversions(src, RunConfig(start=d, end=d))
        loop = one if loop is None else loop.unionByName(one)
    assert whole.exceptAll(loop).count() == 0 and loop.exceptAll(whole).count() == 0


def test_baseline_join_skew_is_split_by_aqe(spark):
    """The baseline join is left to AQE: with one (date, sku) holding most winners,
    broadcasts off and small skew thresholds, the executed join is skew-split."""
    rnd = random.Random(1)
    sales, placements = [], []
    for i in range(6000):
        hot = i % 3 != 0
        sku, loc = ("H", rnd.randrange(4)) if hot else (f"S{rnd.randrange(200)}", rnd.randrange(8))
        day = "2024-10-02" if rnd.random() < 0.5 else "2024-10-01"
        sales.append((f"o{i}", sku, loc, f"{day} {rnd.randrange(8, 20):02d}:{rnd.randrange(60):02d}:00", 1, 10.0))
    for d in ("2024-10-01", "2024-10-02"):
        for loc in range(8):
            for sku in ["H"] + [f"S{j}" for j in range(200)]:
                placements.append((f"p{d}{loc}{sku}", [sku], loc, f"{d} 07:00:00", f"{d} 23:00:00"))
    hist = [(f"h{i}", "H" if i % 2 else f"S{i % 200}", 9, f"2024-09-{10 + i % 20:02d} 10:00:00", 2, 5.0)
            for i in range(400)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        src = golden.sources(spark, sales=sales + hist, placements=placements)
        df = daily.stages(src, RunConfig(start="2024-10-01", end="2024-10-02")).incremental
        assert len(df.collect()) == 6000
        # The winners' left join to the baseline, not another join of the plan.
        assert any("SortMergeJoin(skew=true)" in line and "LeftOuter" in line for line in plan_text(df).splitlines())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.catalog.clearCache()


def test_winner_equals_max_by_over_pairs(spark):
    """SURVEY §5.3: the row_number winner equals a max_by over the candidate pairs
    (test-only: pairs are formed here, on the smallest tables)."""
    st = daily.stages(fixtures.load(spark, SF_SMALL), fixture_config())
    keys = ["date", "sku", "location_id"]
    pairs = st.sales_run.join(st.placements_run, keys).where(
        (F.col("end_sec") >= F.col("ts_sec") - 7200))
    rank = F.struct(F.col("end_sec"), F.col("begin_sec"), F.col("placement_id"), -F.col("ts_sec"))
    by_max = pairs.groupBy("date", "order_id", "sku", "location_id").agg(
        F.max_by("placement_id", rank).alias("placement_id"))
    mine = st.winners.select("date", "order_id", "sku", "location_id", "placement_id")
    assert mine.count() > 0
    assert mine.exceptAll(by_max).count() == 0 and by_max.exceptAll(mine).count() == 0


def test_bucketed_facts_need_no_shuffle_for_their_joins(spark, tmp_path):
    """Broadcasts off: between the scans and the anti-join or the attribution there is no Exchange."""
    from adlift.operators.normalize import normalize_placements
    from adlift.sources.layout import write_bucketed

    cfg = RunConfig(start="2024-01-20", end="2024-01-25", lookback_days=10)
    st = daily.stages(fixtures.load(spark, SF_SMALL), cfg)
    placements = normalize_placements(daily.begin_day_between(st._raw_placements, cfg.read_start, cfg.end))
    facts = write_bucketed(spark, st.sales, placements, "bucketed_test", str(tmp_path / "b"), 5, (cfg.read_start, cfg.end))
    back = set_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"})
    try:
        won = facts.winners(cfg.start, cfg.end, cfg.grace_seconds)
        alone = facts.sales_without_ads(cfg.read_start, cfg.history_end, cfg.baseline_rows)
        for df in (won, alone):
            df.collect()
            plan = plan_text(df).split("== Initial Plan ==")[0]
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            assert "PartitionFilters: [isnotnull(day" in plan and "SelectedBucketsCount: 5 out of 5" in plan
        cols = ["date", "order_id", "sku", "location_id", "placement_id"]
        assert won.count() > 0
        assert sorted(map(tuple, won.select(cols).collect())) == sorted(map(tuple, st.winners.select(cols).collect()))
    finally:
        back()
        for t in (facts.sales_table, facts.placements_table):
            spark.sql(f"DROP TABLE {t}")


def test_bucketed_hot_key_matches_plain(spark, tmp_path):
    from adlift.sources.layout import write_bucketed

    day, sales, placements = hot_key_case()
    st = daily.stages(golden.sources(spark, sales=sales, placements=placements), RunConfig(start=day, end=day))
    facts = write_bucketed(spark, st.sales, st.placements_run, "bucketed_hot", str(tmp_path / "b"), 4)
    d = dt.date.fromisoformat(day)
    got = facts.winners(d, d, 7200)
    assert sorted((r.order_id, r.placement_id) for r in got.collect()) == sorted(
        (r.order_id, r.placement_id) for r in st.winners.collect())
    for t in (facts.sales_table, facts.placements_table):
        spark.sql(f"DROP TABLE {t}")


def test_command_line_backfill(spark, partitioned, tmp_path):
    from adlift.cli import main
    from adlift.sources.sink import read_daily_conversions

    src, derived = partitioned
    base = src.sales.inputFiles()[0].split("/sales/")[0].replace("file:", "")
    argv = ["--start-date", "2024-01-28", "--end-date", "2024-01-30", "--lookback-days", "5", "--versions", "files",
            "--sales", f"{base}/sales", "--placements", f"{base}/placements", "--output", str(tmp_path / "out"),
            "--backfill", str(tmp_path / "history")]
    for n in ("categories", "campaigns", "organizations", "locations", "ad_groups", "ads"):
        argv += ["--dimension", f"{n}={base}/{n}"]
    assert len(main(argv, spark)["days_run"]) == 3 and main(argv, spark)["days_run"] == []
    want = daily.daily_conversions(derived, RunConfig(start="2024-01-28", end="2024-01-30", lookback_days=5))
    back = read_daily_conversions(spark, str(tmp_path / "out"))
    assert back.exceptAll(want).count() == 0 and back.count() == want.count()
