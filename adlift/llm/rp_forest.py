"""Embedding near-duplicates by a forest of random-projection trees with spill overlap.

Vectors of one label are linked when their cosine (in double precision) reaches a threshold.

- Equal vectors of a label are one class: one node with a size, however many copies.
- A tree splits recursively along random directions at the median. Vectors within a margin
  of the cut go to both sides. The margin is absolute, taken from the distance that the
  threshold allows, so how likely a close pair is parted does not depend on how dense its
  surroundings are; over several independent trees, pairs parted in all of them are rare.
- The trees (directions and cuts) are fitted on a bounded sample of ``SAMPLE`` classes; every
  class is routed through them. A node is split while its largest label has more than
  ``leaf`` classes (estimated from the sample) and a cut still parts it.
- Classes are compared within their leaves, by label, each pair verified by its cosine. A leaf
  over ``leaf`` classes, such as a crowd closer together than the margin, is cut into chunks,
  and all pairs of chunks are compared in tasks of their own: no cap, no group in one task.
- A pair met in several leaves is counted in the first leaf that both share: classes carry
  the list of their leaves. Tasks return counts per class and links that span each task's
  components, never all pairs. Links are united by star rounds.

Links found are exact; a pair is missed when every tree parts it (recall is measured in the
tests and stated in the README). Up to ``leaf`` classes a label, nothing is parted at all.

Rows with a null label, or a null, empty, zero or non-finite vector or one with a null component, link
with nothing; they are returned with no links and as their own component. Vectors of different
lengths do not link. Rows repeated are members of one class. A null id never names a
component while another id is there; rows without an id are kept if none names theirs.
An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.llm.common import save
from adlift.llm.components import connected_components
from adlift.llm.runs import groups

TREES = 4
LEAF = 2048
# Classes the trees are fitted on, at most.
SAMPLE = 1 << 16
# A cut is taken when each side holds at most this share of what it cuts; so many directions are tried.
SHRINK, TRIES = 0.95, 4
FEWEST = 32


# ---- the forest ------------------------------------------------------------------

@dataclass
class Forest:
    """Inner nodes of all trees: direction, cut and children (leaves: minus their number, minus one)."""

    margin: float
    directions: list = field(default_factory=list)
    cuts: list = field(default_factory=list)
    children: list = field(default_factory=list)
    roots: list = field(default_factory=list)
    leaves: int = 0

    def route(self, units: np.ndarray) -> list[list[int]]:
        """The leaves of each vector, ascending."""
        out: list[list[int]] = [[] for _ in range(len(units))]
        todo = [(root, np.arange(len(units))) for root in self.roots]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                for i in at:
                    out[i].append(-node - 1)
                continue
            w = self.directions[node]
            place = units[at, :len(w)] @ w[:units.shape[1]] - self.cuts[node]
            left, right = self.children[node]
            todo.append((left, at[place <= self.margin]))
            todo.append((right, at[place > -self.margin]))
        return [sorted(x) for x in out]


def fit(units: np.ndarray, labels: np.ndarray, share: float, threshold: float, trees: int, leaf: int, seed: int = 0) -> Forest:
    """Trees over a sample that is a ``share`` of all classes."""
    dim = units.shape[1]
    # Half the standard deviation of two linked vectors' difference along a random direction.
    forest = Forest(margin=0.5 * float(np.sqrt(max(0.0, 2 - 2 * threshold) / max(1, dim))))
    rng = np.random.default_rng(seed)
    codes, _ = pd.factorize(labels)

    def largest(at: np.ndarray) -> tuple[int, int]:
        counts = np.bincount(codes[at])
        return int(counts.argmax()), int(counts.max())

    def grow(at: np.ndarray) -> int:
        if len(at):
            code, size = largest(at)
            own = at[codes[at] == code]
            if size / share > leaf and size >= FEWEST:
                for _ in range(TRIES):
                    w = rng.normal(size=dim)
                    w /= np.linalg.norm(w)
                    cut = float(np.median(units[own] @ w))
                    place = units[at] @ w - cut
                    left, right = at[place <= forest.margin], at[place > -forest.margin]
                    if max(np.count_nonzero(codes[x] == code) for x in (left, right)) <= SHRINK * size:
                        node = len(forest.cuts)
                        forest.directions.append(w.astype(np.float32))
                        forest.cuts.append(cut)
                        forest.children.append(None)
                        forest.children[node] = (grow(left), grow(right))
                        return node
        forest.leaves += 1
        return -forest.leaves

    forest.roots = [grow(np.arange(len(units))) for _ in range(trees)]
    return forest


def _units(vectors, dim: int | None = None) -> np.ndarray:
    """Unit vectors in double precision, padded or cut to ``dim``."""
    rows = [np.asarray(v, dtype=np.float64) for v in vectors]
    width = dim or max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        r = r / np.abs(r).max()
        out[i, :len(r)] = (r / np.sqrt(r @ r))[:width]
    return out


# ---- classes ------------------------------------------------------------------------

def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ``rid, vec_id, label, key`` (key null: links with nothing), and the classes' ``node, first_id, n, v``."""
    v = F.col("embedding").cast("array<double>")
    usable = F.col("label").isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = save(vectors.select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"), F.col("embedding").alias("v"),
        F.when(F.coalesce(usable, F.lit(False)), F.unhex(F.sha2(F.concat_ws(",", v.cast("array<string>")), 256))).alias("key")),
        "forest-rows")
    held = rows.where(F.col("key").isNotNull()).groupBy("label", "key").agg(
        F.min("rid").alias("node"), F.min("vec_id").alias("first_id"), F.count("*").alias("n"), F.any_value("v").alias("v"))
    return rows, save(held.withColumn("dim", F.size("v")), "forest-classes")


# ---- comparing ---------------------------------------------------------------------

def _shared_before(a: list, b: list, leaf: int) -> np.ndarray:
    """For each of ``a`` and each of ``b`` (leaf lists): do they share a leaf before ``leaf``?"""
    earlier = {x for own in a for x in own if x < leaf} & {x for own in b for x in own if x < leaf}
    place = {x: i for i, x in enumerate(sorted(earlier))}

    def marks(lists):
        out = np.zeros((len(lists), len(place)), dtype=np.float32)
        for i, own in enumerate(lists):
            for x in own:
                if x in place:
                    out[i, place[x]] = 1
        return out

    return marks(a) @ marks(b).T > 0


def _spanning(near: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what ``near`` (rows x cols) connects: at most one for each member."""
    out = []
    row_left, col_left = near.any(axis=1), near.any(axis=0)
    while row_left.any():
        start = int(row_left.argmax())
        row_left[start] = False
        todo = [(start, True)]
        while todo:
            at, is_row = todo.pop()
            reached = (near[at] & col_left) if is_row else (near[:, at] & row_left)
            found = np.flatnonzero(reached)
            (col_left if is_row else row_left)[found] = False
            here, there = (rows, cols) if is_row else (cols, rows)
            out += [(int(here[at]), int(there[x])) for x in found if here[at] != there[x]]
            todo += [(int(x), not is_row) for x in found]
    return out


def _compare(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (_, _, leaf, low, high), rows in groups(batches, ["label", "dim", "leaf", "low", "high"]):
            chunk = rows["chunk"].to_numpy()
            a, b = rows[chunk == low], rows[chunk == high]
            if not len(a) or not len(b):
                continue
            near = _units(a["v"]) @ _units(b["v"]).T >= threshold
            if low == high:
                np.fill_diagonal(near, False)
            if not near.any():
                continue
            some_a, some_b = near.any(axis=1), near.any(axis=0)
            near, a, b = near[np.ix_(some_a, some_b)], a[some_a], b[some_b]
            ids_a, ids_b = a["node"].to_numpy(), b["node"].to_numpy()
            links = _spanning(near.copy(), ids_a, ids_b)
            own = near & ~_shared_before(list(a["leaves"]), list(b["leaves"]), leaf)
            counts = [pd.DataFrame({"node": ids_a, "n": own @ b["n"].to_numpy()})]
            if low != high:
                counts.append(pd.DataFrame({"node": ids_b, "n": own.T @ a["n"].to_numpy()}))
            out = pd.concat(counts, ignore_index=True).assign(other=-1)
            spans = pd.DataFrame(links, columns=["node", "other"]).assign(n=0)
            yield pd.concat([out[out["n"] > 0], spans], ignore_index=True)[["node", "other", "n"]].astype("int64")

    return run


def _routed(held: DataFrame, threshold: float, trees: int, leaf: int) -> DataFrame:
    """The classes with the sorted list of their leaves; one leaf for all while no label has more than ``leaf``."""
    total = held.count()
    if not total:
        return held.withColumn("leaves", F.array(F.lit(0).cast("long")))
    sample = held.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("label", "v").toPandas()
    dim = int(sample["v"].map(len).max())
    forest = fit(_units(sample["v"], dim), sample["label"].to_numpy(), len(sample) / total, threshold, trees, leaf)
    if not forest.cuts:
        return held.withColumn("leaves", F.array(F.lit(0).cast("long")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(leaves=forest.route(_units(b["v"], dim)))

    narrow = held.select("label", "dim", "node", "n", "v")
    kind = held.schema["v"].dataType.simpleString()
    return narrow.mapInPandas(run, f"label string, dim int, node long, n long, v {kind}, leaves array<long>")


def links(held: DataFrame, threshold: float, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """``node, other, n``: links that span each task's components (other >= 0), and parts of the classes' counts."""
    routed = save(_routed(held, threshold, trees, leaf).select("label", "dim", "node", "n", "v", "leaves"), "forest-leaves")
    met = routed.select("label", "dim", "node", "n", "v", "leaves", F.explode("leaves").alias("leaf"))
    size = routed.select("label", "dim", F.explode("leaves").alias("leaf")).groupBy("label", "dim", "leaf").agg(
        F.ceil(F.count("*") / F.lit(leaf)).cast("int").alias("chunks"))
    many = size.where("chunks > 1")
    chunked = met.join(many, ["label", "dim", "leaf"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    chunked = chunked.withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    cells = chunked.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumns(
        {"low": F.least("chunk", "_o"), "high": F.greatest("chunk", "_o")}).drop("_o", "chunks")
    by = ["label", "dim", "leaf", "low", "high"]
    return save(cells.repartition(*by).sortWithinPartitions(*by).mapInPandas(
        _compare(threshold), "node long, other long, n long"), "forest-links")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding, label``."""
    rows, held = classes(vectors)
    found = links(held, threshold, trees, leaf)
    counts = found.where("n > 0").groupBy("node").agg(F.sum("n").alias("linked"))
    nodes = connected_components(found.where("other >= 0").select(F.col("node").alias("a"), F.col("other").alias("b")))
    rooted = held.select("label", "key", "node", "n", "first_id").join(nodes, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").join(
        counts, "node", "left").select(
        "label", "key", "component_id", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    alone = rows.where(F.col("key").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    joined = rows.where(F.col("key").isNotNull()).select("vec_id", "label", "key").join(named, ["label", "key"]).select(
        "vec_id", "n_links", "component_id")
    return joined.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
