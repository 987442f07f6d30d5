"""Hard negatives by slot-decomposed selection, over blocks of rows against a stated query set.

Each anchor asks, for every one of its positives, for the best negatives whose score lies
between a lower and an upper share of that positive's score: windows that overlap.

- The positives' upper limits cut an anchor's scores into disjoint slots. A negative falls
  into one slot, whatever the number of windows that hold it.
- A task holds one block of rows and meets the anchors in batches: one matrix product a
  batch. It keeps the best ``k`` rows of each (anchor, slot): a combiner, so what leaves a
  block is bounded by the anchors, not by the rows that pass. Block results are cut to
  ``k`` again by a partial top-k.
- Going down from the lowest slot to the highest, an anchor's lists are merged into
  suffixes: suffix j holds the best ``k`` of all rows up to upper limit j, which answers
  every window with that limit. Its lower limit cuts the list's end.

The anchors (a fixed share of the rows) are copied to every block, rows are never copied,
and nothing is broadcast. Blocks of the positives' search are dealt by label and row, so a
label that holds a third of the rows is many blocks. Work is anchors times rows.

Rows without an id, a label or a vector, or with a null or non-finite component, take no
part. Components are whole numbers (``floor(scale * x)``); scores are their inner products,
exact up to a long. Vectors of other lengths count as padded with zeros; empty ones score
zero. Rows repeated are rows of their own: they may be each other's positives, and an anchor
row that occurs twice is answered twice. Equal scores go by the smaller id. Negative
positives' scores have no window. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlift.llm.common import save
from adlift.llm.runs import pieces

# Rows of a block at most (their vectors stay in a task's memory), and scores held at once.
BLOCK_ROWS = 1 << 17
SCORES = 1 << 22
_ROW = "rid long, vec_id long, label string, anchor boolean, q binary, dim int"


def _pack(scale: float):
    """Quantised vectors as bytes: of the narrowest whole-number type that holds a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            q, keep = [], []
            for v in b["vector"]:
                x = np.floor(scale * np.asarray(v, dtype=np.float64))
                top = np.abs(x).max(initial=0)
                # Beyond a long there is no whole number to score with; such a row is not usable.
                keep.append(bool(top < 2.0 ** 62))
                kind = np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64
                q.append(x.astype(kind).tobytes() if keep[-1] else b"")
            dim = b["vector"].map(len).astype("int32")
            yield b.drop(columns="vector").assign(q=q, dim=dim)[keep]

    return run


def prepare(rows: DataFrame, anchor: Column, label: Column, scale: float = 256.0) -> DataFrame:
    """``rid, vec_id, label, anchor, q, dim`` of the rows that take part, written once."""
    v = F.col("embedding").cast("array<double>")
    usable = F.col("vec_id").isNotNull() & label.isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    plain = rows.where(F.coalesce(usable, F.lit(False))).select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("string").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), v.alias("vector"))
    return save(plain.mapInPandas(_pack(scale), _ROW), "negatives-rows")


def _matrix(rows: pd.DataFrame, dim: int) -> np.ndarray:
    """The rows' vectors, padded to ``dim``, as a matrix of longs."""
    out = np.zeros((len(rows), dim), dtype=np.int64)
    sizes = {(len(q), d) for q, d in zip(rows["q"], rows["dim"])}
    if len(sizes) == 1:
        (size, d), = sizes
        if d:
            out[:, :d] = np.frombuffer(b"".join(rows["q"]), dtype=f"<i{size // d}").reshape(-1, d)
        return out
    for at, (q, d) in enumerate(zip(rows["q"], rows["dim"])):
        if d:
            out[at, :d] = np.frombuffer(q, dtype=f"<i{len(q) // d}")
    return out


class _Block:
    """One block of rows, by id, and its scores against batches of anchors."""

    def __init__(self, held: list[pd.DataFrame]):
        rows = pd.concat(held, ignore_index=True)
        self.ids, self.rid = rows["vec_id"].to_numpy(), rows["rid"].to_numpy()
        self.codes, self.labels = pd.factorize(rows["label"])
        self.dim = int(rows["dim"].max())
        self.whole = _matrix(rows, self.dim)
        self.top = int(np.abs(self.whole).max(initial=0))
        self.typed = {np.int64: self.whole}

    def scores(self, anchors: pd.DataFrame) -> np.ndarray:
        dim = max(self.dim, int(anchors["dim"].max()))
        a = _matrix(anchors, dim)[:, :self.dim]
        # Sums of whole numbers are exact in a float as long as none can leave its mantissa.
        largest = self.top * int(np.abs(a).max(initial=0)) * max(1, self.dim)
        kind = np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64
        if kind not in self.typed:
            self.typed[kind] = self.whole.astype(kind)
        return a.astype(kind) @ self.typed[kind].T

    def code(self, label: str) -> int:
        found = np.flatnonzero(self.labels == label)
        return int(found[0]) if len(found) else -1


def _best(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of the positions ``at`` (ascending) with the highest scores, ties by position."""
    own = scores[at]
    if len(at) > k:
        kth = np.partition(own, len(at) - k)[len(at) - k]
        at = at[own >= kth]
        own = scores[at]
    return at[np.argsort(-own, kind="stable")[:k]]


def _against_blocks(keys: list[str], select, columns: list[str]):
    """For sorted partitions in which a block's rows come before the anchors it meets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, block = None, [], None
        for k, rows in pieces(batches, [*keys, "asks"]):
            if k[:-1] != key:
                key, held, block = k[:-1], [], None
            if not k[-1]:
                held.append(rows)
                continue
            if not held and block is None:
                continue
            if block is None:
                block, held = _Block(held), []
            step = max(1, SCORES // len(block.ids))
            for a in range(0, len(rows), step):
                batch = rows.iloc[a:a + step]
                out = []
                for scores, asked in zip(block.scores(batch), batch.itertuples()):
                    out += select(block, scores, asked)
                if out:
                    yield pd.DataFrame(out, columns=columns)

    return run


def _positives(k: int):
    def select(block, scores, asked):
        at = _best(scores, np.flatnonzero((block.codes == block.code(asked.label)) & (block.rid != asked.rid)), k)
        return [(asked.rid, asked.vec_id, int(block.ids[i]), int(scores[i])) for i in at]

    return select


def _negatives(k: int):
    def select(block, scores, asked):
        uppers = asked.uppers
        passing = np.flatnonzero((scores >= asked.least) & (scores <= uppers[0]) & (block.codes != block.code(asked.label)))
        own, out = scores[passing], []
        for slot, upper in enumerate(uppers):
            below = uppers[slot + 1] if slot + 1 < len(uppers) else asked.least - 1
            at = _best(scores, passing[(own <= upper) & (own > below)], k)
            out += [(asked.rid, slot, int(block.ids[i]), int(scores[i])) for i in at]
        return out

    return select


def _dealt(rows: DataFrame, asked: DataFrame, keys: list[str], schema: str, select, columns: list[str]) -> DataFrame:
    both = rows.unionByName(asked, allowMissingColumns=True).repartition(*keys).sortWithinPartitions(*keys, "asks", "vec_id")
    return both.mapInPandas(_against_blocks(keys, select, columns), schema)


def positives(rows: DataFrame, k: int, block_rows: int) -> DataFrame:
    """``rid, vec_id, positive_id, positive_score``: each anchor's ``k`` best other rows of its label."""
    size = rows.groupBy("label").agg(F.count("*").alias("n")).select(
        "label", F.ceil(F.col("n") / F.lit(block_rows)).cast("int").alias("blocks"))
    sized = rows.join(size, "label")
    own = sized.withColumns({"b": F.pmod(F.xxhash64("rid"), "blocks").cast("int"), "asks": F.lit(0)}).drop("blocks")
    asked = sized.where("anchor").withColumns({
        "b": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "asks": F.lit(1)}).drop("blocks")
    found = _dealt(own, asked, ["label", "b"], "rid long, vec_id long, positive_id long, positive_score long",
                   _positives(k), ["rid", "vec_id", "positive_id", "positive_score"])
    w = Window.partitionBy("rid").orderBy(F.col("positive_score").desc(), "positive_id")
    return save(found.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r"), "negatives-positives")


def suffixes(by_slot: Column, slots: Column, k: int) -> Column:
    """From lists by slot, best slot first, the best ``k`` of each slot and all below it."""
    empty = F.expr("cast(array() as array<array<struct<negative_score: bigint, negative_id: bigint>>>)")
    none = F.expr("cast(array() as array<struct<negative_score: bigint, negative_id: bigint>>)")
    own = lambda j: F.transform(F.filter(by_slot, lambda e: e["slot"] == j), lambda e: F.struct(
        (-e["s"]).alias("negative_score"), e["negative_id"].alias("negative_id")))
    step = lambda below, j: F.concat(F.array(F.slice(
        F.concat(own(j), F.coalesce(F.get(below, F.lit(0)), none)), 1, k)), below)
    return F.aggregate(F.sequence(slots - 1, F.lit(0), F.lit(-1)), empty, step)


def mine(rows: DataFrame, anchor: Column, label: Column, n_positives: int = 5, n_negatives: int = 3,
         lower: int = 50, upper: int = 95, scale: float = 256.0, block_rows: int | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A negative answers a positive when ``lower * positive <= 100 * negative <= upper * positive``
    (0 <= lower <= upper). ``block_rows``: rows of a block; by default the rows are dealt over the
    session's shuffle partitions, with ``BLOCK_ROWS`` a block at most.
    """
    spark = rows.sparkSession
    taking = prepare(rows, anchor, label, scale)
    n = taking.count()
    size = block_rows or min(BLOCK_ROWS, max(1, -(-n // int(spark.conf.get("spark.sql.shuffle.partitions")))))
    best = positives(taking, n_positives, size)
    # Decimals: a share of a score near the end of the long range must not overflow.
    best = best.withColumn("limit", F.expr(f"cast(positive_score as decimal(21,0)) * {upper} div 100"))
    least = F.expr(f"(cast(positive_score as decimal(21,0)) * {lower} + 99) div 100")
    windows = best.where("positive_score >= 0").groupBy("rid").agg(
        F.sort_array(F.collect_set("limit"), asc=False).alias("uppers"), F.min(least).alias("least"))
    blocks = max(1, -(-n // size))
    own = taking.withColumns({"b": F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int"), "asks": F.lit(0)})
    asked = taking.where("anchor").join(windows, "rid").withColumns({
        "b": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "asks": F.lit(1)})
    found = _dealt(own, asked, ["b"], "rid long, slot int, negative_id long, negative_score long",
                   _negatives(n_negatives), ["rid", "slot", "negative_id", "negative_score"])
    w = Window.partitionBy("rid", "slot").orderBy(F.col("negative_score").desc(), "negative_id")
    kept = found.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n_negatives)
    lists = kept.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct(
        "slot", (-F.col("negative_score")).alias("s"), "negative_id"))).alias("by_slot"))
    merged = windows.join(lists, "rid").select("rid", "uppers", suffixes(F.col("by_slot"), F.size("uppers"), n_negatives).alias("upto"))
    answered = best.join(merged, "rid").withColumn("window", F.filter(
        F.element_at("upto", F.array_position("uppers", F.col("limit")).cast("int")),
        lambda x: x["negative_score"].cast("decimal(21,0)") * 100 >= F.col("positive_score").cast("decimal(21,0)") * lower))
    return answered.where("positive_score >= 0").select(
        F.col("vec_id").alias("anchor_id"), "positive_id", F.posexplode("window").alias("at", "x"), "positive_score").select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.negative_id").alias("negative_id"),
        "positive_score", F.col("x.negative_score").alias("negative_score"))
