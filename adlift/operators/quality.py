"""Q1, Q2, Q4, A3-A5, L1: data-quality reports as small result tables.

The job logs counts, date ranges, id lists and sample rows along the way, each a
separate eager action. Here each is one aggregate query whose result is bounded
by the number of sources, run days or dimension ids, never by the fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlift.config import RunConfig
from adlift.operators.normalize import SALE_KEYS
from adlift.plans.calendar import run_calendar


def source_profile(sources: dict[str, DataFrame]) -> DataFrame:
    """Q1/A3: per source, row count and earliest / latest ``date``."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("date").alias("min_date"),
            F.max("date").alias("max_date"),
        ).select(F.lit(name).alias("source"), "n_rows", "min_date", "max_date")
        for name, df in sources.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _id(df: DataFrame, name: str) -> Column:
    """An id for comparison: integers as long, anything else as text."""
    integral = isinstance(df.schema[name].dataType, T.IntegralType)
    return F.col(name).cast("long") if integral else F.col(name).cast("string")


def id_coverage(fact_ids: DataFrame, dimension: DataFrame, id_name: str) -> DataFrame:
    """Q2/A5: fact ids against a dimension's ids, side by side.

    One row per id seen on either side: whether the facts use it, whether the
    dimension has it and how many dimension rows carry it (>1 would multiply
    measures in a left join). Ids are compared as text where either side is text.
    """
    f = fact_ids.select(_id(fact_ids, id_name).alias("id")).dropna().distinct().withColumn("in_facts", F.lit(True))
    d = dimension.groupBy(_id(dimension, "id").alias("id")).agg(F.count(F.lit(1)).alias("dimension_rows"))
    if f.schema["id"].dataType != d.schema["id"].dataType:
        f, d = (x.withColumn("id", F.col("id").cast("string")) for x in (f, d))
    j = f.join(d, "id", "full_outer")
    return j.select(
        F.col("id").alias(id_name),
        F.coalesce("in_facts", F.lit(False)).alias("in_facts"),
        F.col("dimension_rows").isNotNull().alias("in_dimension"),
        F.coalesce("dimension_rows", F.lit(0)).cast("long").alias("dimension_rows"),
    )


def dimension_coverage(facts: DataFrame, dims: dict[str, DataFrame], joins) -> DataFrame:
    """Q2 for every dimension: per dimension, the distinct ids the facts use, how
    many of them the dimension lacks, the dimension's rows and how many of its ids
    repeat (a repeated id would multiply measures in the left join).

    ``joins`` is a sequence of (dimension name, fact column, ...). The facts are read
    once: their ids are stacked to (dimension, id) pairs, made distinct and met by the
    stacked dimensions in one join.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(k).cast("string").alias("id")) for n, k, *_ in joins])
    used = facts.select(F.explode(pairs).alias("p")).select("p.*").dropna().distinct().withColumn("used", F.lit(1))
    have = None
    for name, *_ in joins:
        own = dims[name].select(F.lit(name).alias("dimension"), F.col("id").cast("string").alias("id"))
        have = own if have is None else have.unionByName(own)
    have = have.groupBy("dimension", "id").agg(F.count(F.lit(1)).alias("n"))
    by = used.join(have, ["dimension", "id"], "full_outer").groupBy("dimension").agg(
        F.count("used").alias("fact_ids"),
        F.count(F.when(F.col("used").isNotNull() & F.col("n").isNull(), 1)).alias("unmatched_ids"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("dimension_rows"),
        F.count(F.when(F.col("n") > 1, 1)).alias("duplicate_ids"))
    every = facts.sparkSession.createDataFrame([(n,) for n, *_ in joins], "dimension string")
    return every.join(by, "dimension", "left").select("dimension", *[
        F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
        for c in ("fact_ids", "unmatched_ids", "dimension_rows", "duplicate_ids")])


def stage_counts(spark: SparkSession, cfg: RunConfig, funnel: DataFrame, winners: DataFrame,
                 gated: DataFrame) -> DataFrame:
    """Q4/A4: the funnel per run day: sales, ads, pairs, in-window pairs, winners.

    Every input is at most one row per day (``funnel``: ``attribution.funnel_by_day``),
    so the joins here are over at most ``cfg.n_days`` rows a side.
    """
    won = winners.groupBy("date").agg(F.count(F.lit(1)).alias("n_winners"))
    out = run_calendar(spark, cfg)
    for p in (funnel, won, gated.withColumn("has_baseline", F.lit(True))):
        out = out.join(F.broadcast(p), "date", "left")
    return out.select(
        "date",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_sales", "n_ads", "n_pairs", "n_in_window", "n_winners")],
        F.coalesce("has_baseline", F.lit(False)).alias("has_baseline"),
    )


def baseline_profile(spark: SparkSession, cfg: RunConfig, sales: DataFrame, placements_x: DataFrame,
                     baseline: DataFrame) -> DataFrame:
    """Q1/A4: what each run day's baseline rests on, one row per run day: earliest day and
    rows of sales and of (exploded) placements in its history, sales without an ad, and
    SKUs that got a baseline.

    Both facts are counted by (date, sku, location) first, so a hot key is one row of the
    join that tells sales with an ad from those without; null keys match nothing. The
    join's result is summed to history days, and each of those (at most lookback + run
    days) is copied to the run days it feeds.
    """
    keys = list(SALE_KEYS)
    lo, hi = F.lit(cfg.read_start), F.lit(cfg.history_end)
    count = lambda df, n: df.where(F.col("date").between(lo, hi)).groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    by_key = count(sales, "s").join(count(placements_x, "p"), keys, "full_outer")
    by_day = by_key.groupBy("date").agg(
        F.sum("s").alias("s"), F.sum("p").alias("p"),
        F.sum(F.when(F.col("p").isNull(), F.col("s"))).alias("no_ad"),
        F.min(F.when(F.col("s").isNotNull(), F.col("date"))).alias("s_day"),
        F.min(F.when(F.col("p").isNotNull(), F.col("date"))).alias("p_day"))
    first = F.greatest(F.date_add("date", 1), F.lit(cfg.start))
    last = F.least(F.date_add("date", cfg.lookback_days), F.lit(cfg.end))
    fed = by_day.where(first <= last).select(F.explode(F.sequence(first, last)).alias("day"), "s", "p", "no_ad", "s_day", "p_day")
    history = fed.groupBy(F.col("day").alias("date")).agg(
        F.min("s_day").alias("earliest_sale"), F.sum("s").alias("n_sales"),
        F.min("p_day").alias("earliest_ad"), F.sum("p").alias("n_ads"), F.sum("no_ad").alias("n_sales_without_ads"))
    skus = baseline.groupBy("date").agg(F.count(F.lit(1)).alias("n_baseline_skus"))
    out = run_calendar(spark, cfg).join(F.broadcast(history), "date", "left").join(F.broadcast(skus), "date", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("date", "earliest_sale", zero("n_sales"), "earliest_ad", zero("n_ads"),
                      zero("n_sales_without_ads"), zero("n_baseline_skus"))


def sample_rows(df: DataFrame, order: list[str], n: int = 2) -> DataFrame:
    """L1: ``n`` rows, first by ``order`` so the sample repeats run to run.

    Planned as a top-n (each task keeps n rows), never a full sort.
    """
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
