"""Order-independent sums: exact against fractions, and equal bits for any partitioning."""

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import golden
from adlift.config import RunConfig
from adlift.functions import exact
from adlift.operators.metrics import daily_sums, daily_sums_20key, sums_by_ids
from adlift.plans import daily


def total_of(spark, values, column=None):
    column = exact.total("x") if column is None else column
    df = spark.createDataFrame([(v,) for v in values], "v double").select(*exact.parts("x", "v"), F.lit(1).alias("one"))
    return df.groupBy().agg(*exact.summed("x"), F.sum("one").alias("n")).select(column.alias("t")).first()["t"]


@pytest.mark.parametrize("values", [
    [0.1] * 10, [1 / 3] * 3, [1e15 + 0.125, 1e-9, -1e15], [-0.5, -1.25, 0.75], [2.0 ** 52 + 0.5, 2.0 ** 52 + 0.5], [0.0], [-1e-9] * 7])
def test_totals_are_exact_to_their_last_place(spark, values):
    want = sum(map(Fraction, values))
    assert abs(Fraction(total_of(spark, values)) - want) <= Fraction(len(values) * 4, 10 ** 16)


def test_totals_of_nulls_and_values_beyond_the_parts(spark):
    assert total_of(spark, [None, None]) is None and total_of(spark, [None, 2.5]) == Decimal("2.5")
    assert total_of(spark, [1e300, 1.0]) is None and total_of(spark, [float("nan"), 1.0]) is None
    assert float(total_of(spark, [2.0 ** 60, 0.5])) == 2.0 ** 60
    mean = exact.mean("x", "n")
    assert total_of(spark, [1.0, 2.0, 4.5], mean) == 2.5 and total_of(spark, [None], mean) is None
    assert math.isnan(total_of(spark, [float("nan"), 1.0], mean)) and total_of(spark, [1e300, 1e300], mean) == 1e300


def test_a_million_rows_give_equal_bits_for_any_partitioning(spark):
    """Totals above 1e10 made of thirds of cents: the sum of doubles moves with the order, this one does not."""
    rows = spark.range(1_000_000).select(
        F.col("id"), (F.col("id") % 3).alias("g"), ((F.pmod(F.xxhash64("id"), F.lit(10 ** 10)) / 300 + F.col("id") / 7)).alias("v"))
    seen, doubles = set(), set()
    for parts, order in ((1, "id"), (7, "v"), (16, "g"), (5, None)):
        df = rows.repartition(parts, F.xxhash64("id", F.lit(parts)))
        df = df.sortWithinPartitions(order) if order else df
        cut = df.select("g", "v", *exact.parts("x", "v"))
        got = cut.groupBy("g").agg(*exact.summed("x"), F.sum("v").alias("d")).select("g", exact.total("x").alias("t"), "d").collect()
        seen.add(tuple(sorted((r.g, r.t) for r in got)))
        doubles.add(tuple(sorted((r.g, r.d) for r in got)))
    assert len(seen) == 1 and all(t > 10 ** 10 for _, t in next(iter(seen)))
    assert len(doubles) > 1  # what the test is about


def test_daily_sums_are_the_same_bits_for_any_partitioning(spark):
    """The job's two sums over large totals, direct and through the sums by ids."""
    st = daily.stages(golden.sources(spark), RunConfig(start="2024-10-02", end="2024-10-03"))
    one = st.incremental.where("order_id = 'o6'").drop("incremental_units_sold", "incremental_sales", "order_id")
    rnd = random.Random(1)
    values = spark.createDataFrame([(rnd.randrange(10 ** 7) / 3, rnd.randrange(10 ** 9) / 7) for _ in range(20_000)],
                                   "incremental_units_sold double, incremental_sales double").withColumn("sku", F.lit("A"))
    many = one.join(values, "sku")
    results = set()
    for parts in (1, 3, 8):
        rows = many.repartition(parts, "incremental_sales")
        twice = sums_by_ids(rows)
        named = {c: F.lit("x") for c in ("organization_name", "campaign_name", "ad_group_name", "ad_name", "location_name",
                                         "category_name", "status", "campaign_type")} | {"daily_budget": F.lit(1.0)}
        for df in (rows.withColumns(named), twice.withColumns(named)):
            a, b = daily_sums(df).collect(), daily_sums_20key(df).collect()
            assert len(a) == len(b) == 1
            results.add((a[0]["units_sold"], a[0]["sales"], b[0]["units_sold"], b[0]["sales"]))
    assert len(results) == 1
    assert next(iter(results))[2] > 10 ** 10
