"""J2 + F3 + W2: which ad placement gets credit for each sale.

A sale on day D is credited to a placement of the same (D, sku, location) whose end
is at most ``grace`` before the sale; the latest-ending one wins. The job's time
test, ``(begin <= ts AND end >= ts) OR end >= ts - grace``, reduces to its second
branch (the first implies it), so eligibility is ``end >= ts - grace`` and is
monotone in ``end``: if any placement of a key is eligible, the latest-ending
placement of that key is. Hence

    winner(sale) = latest(key(sale)) if latest(key).end >= sale.ts - grace

and the interval/as-of join becomes a top-1 per key (partial top-1 runs map-side,
before the shuffle) followed by a many-to-one equi-join. No (sale, placement) pairs
are formed, so a hot (day, sku, location) costs one row on the placement side. The
join is left to adaptive execution, which splits a hot key's lines at runtime and
reads its one placement with each part; nothing is salted or copied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlift.contracts import OWNED_COLUMNS
from adlift.operators.normalize import PLACEMENT_PAYLOAD, SALE_KEYS

# Total order among a key's placements (the job orders by end time only; ties are
# broken here so results are repeatable).
PLACEMENT_ORDER = (
    ("end_sec", "desc"), ("begin_sec", "desc"), ("placement_id", "desc"),
    ("winningadid", "desc"), ("campaignid", "desc"), ("adgroupid", "desc"),
    # Without an id column these make the order total: rows that tie on all of
    # them are the same placement for every output.
    *((c, "desc") for c in PLACEMENT_PAYLOAD if c not in ("winningadid", "campaignid", "adgroupid")),
    ("winningbidamount", "desc"), ("winningbidprice", "desc"),
    *((c, "desc") for c in OWNED_COLUMNS),
)

# Among several lines of one (day, order, sku, location) the earliest is kept: it is
# eligible whenever any line is (eligibility is monotone in the sale time).
LINE_ORDER = (
    ("ts_sec", "asc"), ("units_sold", "desc"), ("sale_amount", "desc"),
    *((c, "asc") for c in OWNED_COLUMNS),
    ("sales_year", "asc"), ("sales_month", "asc"), ("sales_day", "asc"),
)


def ordering(df: DataFrame, spec) -> list:
    """Columns for ``orderBy`` from (name, direction) pairs that ``df`` has; nulls always last."""
    return [F.col(c).asc_nulls_last() if d == "asc" else F.col(c).desc_nulls_last() for c, d in spec if c in df.columns]


SALE_GRAIN = ("date", "sku", "location_id", "order_id")


def latest_placement(placements_x: DataFrame) -> DataFrame:
    """One row per (date, sku, location_id): the placement that ends last."""
    w = Window.partitionBy(*SALE_KEYS).orderBy(*ordering(placements_x, PLACEMENT_ORDER))
    return placements_x.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def first_line_per_sale(lines: DataFrame) -> DataFrame:
    """W2's grain: one line per (date, order_id, sku, location_id)."""
    w = Window.partitionBy(*SALE_GRAIN).orderBy(*ordering(lines, LINE_ORDER))
    return lines.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _in_time(joined: DataFrame, grace_seconds: int) -> DataFrame:
    return joined.where(F.col("end_sec") >= F.col("ts_sec") - F.lit(grace_seconds))


def attribute(sales_n: DataFrame, placements_x: DataFrame, grace_seconds: int) -> DataFrame:
    """Winners: each sale line joined to the placement that gets its credit.

    ``sales_n`` and ``placements_x`` should already be limited to the run days.

    Raw lines meet their key's latest placement, those out of time go, and of what is
    left each sale keeps its first line: exact, because the earliest line is eligible
    whenever any line is. The join key is one struct of the three columns. To the planner
    that is not the partitioning of the top-1, nor the one the line dedupe needs, so both
    join inputs are plain shuffles of their own: the shape in which adaptive execution
    may split a skewed partition. The dedupe's shuffle carries winners only, and spreads
    a hot key by order id.
    """
    keys = list(SALE_KEYS)
    top = latest_placement(placements_x.dropna(subset=keys))
    top = top.select(F.struct(*keys).alias("_key"), *[c for c in top.columns if c not in keys])
    lines = sales_n.dropna(subset=keys).withColumn("_key", F.struct(*keys))
    joined = lines.join(top, "_key").drop("_key")
    return first_line_per_sale(_in_time(joined, grace_seconds))


def attribute_co_located(sales_n: DataFrame, placements_x: DataFrame, grace_seconds: int) -> DataFrame:
    """:func:`attribute` for facts already laid out by (date, sku, location_id).

    Joins on the plain columns, so the layout's partitioning serves the top-1, the join
    and the line dedupe: no shuffle at all (see ``adlift.sources.layout``).
    """
    keys = list(SALE_KEYS)
    joined = sales_n.dropna(subset=keys).join(latest_placement(placements_x.dropna(subset=keys)), keys)
    return first_line_per_sale(_in_time(joined, grace_seconds))


def _per_second(lines: DataFrame, placements_x: DataFrame) -> DataFrame:
    """Per (key, second t): ``c`` placements that end at t and ``m`` lines with threshold
    t (``kind`` 0 and 1), ``on_key`` placements of the key and ``at_or_after`` of them
    ending at or after t.

    Placements are grouped by (key, end second) and lines by (key, t); a running
    count over each key ordered by second gives "placements ending at or after t".
    A key's window holds one row per distinct second, not one per input row,
    however hot the key.
    """
    keys = list(SALE_KEYS)
    zero = F.lit(0).cast("long")
    ends = placements_x.groupBy(*keys, F.col("end_sec").alias("t")).agg(F.count(F.lit(1)).alias("c"))
    marks = lines.groupBy(*keys, "t").agg(F.count(F.lit(1)).alias("m"))
    both = ends.select(*keys, "t", F.lit(0).alias("kind"), "c", zero.alias("m")).unionByName(
        marks.select(*keys, "t", F.lit(1).alias("kind"), zero.alias("c"), "m")
    )
    # Placement rows sort before threshold rows of the same second (end >= t is
    # inclusive); null ends sort last, so they pair but are never in the window.
    running = Window.partitionBy(*keys).orderBy(F.col("t").desc_nulls_last(), F.col("kind").asc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    counted = both.select(
        *keys, "t", "kind", "c", "m",
        F.sum("c").over(running).alias("at_or_after"),
        F.sum("c").over(Window.partitionBy(*keys)).alias("on_key"),
    )
    # A line without a time still pairs with its key's placements but is never in window.
    return counted.withColumn("at_or_after", F.when(F.col("t").isNull(), F.lit(0)).otherwise(F.col("at_or_after")))


def _threshold_lines(sales_n: DataFrame, grace_seconds: int) -> DataFrame:
    return sales_n.select(
        *SALE_GRAIN, (F.col("ts_sec") - F.lit(grace_seconds)).alias("t")
    )


# A line without a time pairs with its key's placements but is never in window;
# the sentinel stands in for its missing threshold so joins stay plain equi-joins.
_NO_TIME = -(2 ** 62)


def candidate_counts(sales_n: DataFrame, placements_x: DataFrame, grace_seconds: int) -> DataFrame:
    """J2+F3 as counts, per (date, order_id, sku, location_id) that has an ad.

    ``n_pairs``: (line, placement) pairs on the same key, the equi-join's size.
    ``n_in_window``: those that pass the time test, the interval join's size.
    Counted without forming pairs (see ``_per_second``), then joined back to the lines.
    The counted side is unique per (key, second), so this is a plain many-to-one
    equi-join: a hot second's lines are split by adaptive execution, nothing is copied.
    """
    keys = list(SALE_KEYS)
    lines = _threshold_lines(sales_n.dropna(subset=keys), grace_seconds)
    marks = _per_second(lines, placements_x.dropna(subset=keys)).where((F.col("kind") == 1) & (F.col("on_key") > 0))
    counted = marks.select(
        *keys, F.coalesce("t", F.lit(_NO_TIME)).alias("tk"),
        F.col("on_key").alias("pairs"), F.col("at_or_after").alias("in_window"),
    )
    marked = lines.select(*SALE_GRAIN, F.coalesce("t", F.lit(_NO_TIME)).alias("tk"))
    return marked.join(counted, [*keys, "tk"]).groupBy(*SALE_GRAIN).agg(
        F.sum("pairs").cast("long").alias("n_pairs"),
        F.sum("in_window").cast("long").alias("n_in_window"),
    )


def funnel_by_day(sales_n: DataFrame, placements_x: DataFrame, grace_seconds: int) -> DataFrame:
    """Per day: sale rows, placement rows, pairs and in-window pairs, all from the
    per-second counts (one read of each fact, no per-line join).

    Rows without a SKU or location are counted but pair with nothing.
    """
    counted = _per_second(_threshold_lines(sales_n, grace_seconds), placements_x)
    pairing = (F.col("kind") == 1) & F.col("sku").isNotNull() & F.col("location_id").isNotNull()
    per_line = lambda n: F.sum(F.when(pairing, F.col("m") * F.col(n)).otherwise(0)).cast("long")
    return counted.groupBy("date").agg(
        F.sum("m").alias("n_sales"), F.sum("c").alias("n_ads"),
        per_line("on_key").alias("n_pairs"), per_line("at_or_after").alias("n_in_window"),
    )
