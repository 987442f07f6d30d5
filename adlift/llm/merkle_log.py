"""Merkle manifest of a table: postorder append logs written by aligned builders.

A group's leaves (here: rows of one language, by id) form a binary tree: while several
nodes remain, every two neighbours become the hash of their digests' hex text, and a last
node without a neighbour becomes the hash of its own.

- Leaves get their rank from one range sort: a row's place is its place within the sorted
  partition plus the counts of the partitions before, so no group is ranked in one task.
- A builder takes an aligned stretch of ``2 ** bits`` leaves and appends every node as it
  completes, which is postorder: one log segment per builder, bounded by ``bits``. The
  roots of the stretches are the leaves of the next tier, until each group has one root;
  a tier shrinks the table ``2 ** bits``-fold.
- No node stores a pointer. :func:`node_position` gives a node's place in the log from
  subtree sizes alone, so a proof reads its siblings' digests by address. Siblings above a
  stretch are the same for all its leaves and are handed down once per stretch.

Nulls: a null field is hashed as ``-``; a null group is a group, before all others; null
ids come first in their group and are never tampered with. Empty texts are ``0:``. Rows
repeated within a group are leaves of their own, in the order of their digests (equal
digests may swap, which changes no hash). A lone leaf is its group's root. An empty table
gives an empty table. Columns other than the five hashed ones are ignored. Long texts are
hashed by Spark, outside Python.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlift.llm.common import save
from adlift.llm.runs import groups, pieces

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BITS = 12
# A step of a proof: a side (0 no sibling, 1 left, 2 right) and the sibling's digest.
STEP = 33
_SEGMENT = "g string, c long, n long, root binary, log binary"


def digest(*nodes: bytes) -> bytes:
    """The parent of one or two nodes: the hash of their digests' hex text."""
    return hashlib.sha256(b"".join(n.hex().encode() for n in nodes)).digest()


def height(leaves: int) -> int:
    return max(0, leaves - 1).bit_length()


def subtree_size(levels: int, leaves: int) -> int:
    """Nodes of a subtree of that height over ``leaves`` leaves (the last ones of a tree may be fewer)."""
    if leaves == 1 << levels:
        return (2 << levels) - 1
    return sum(-(-leaves // (1 << h)) for h in range(levels + 1))


def node_position(level: int, index: int, leaves: int) -> int:
    """Where the log of a tree over ``leaves`` leaves holds node ``index`` of ``level``.

    The nodes completed before leaf s are ``2 * s - popcount(s)``; the node itself closes
    its own subtree.
    """
    start = index << level
    return 2 * start - start.bit_count() + subtree_size(level, min(1 << level, leaves - start)) - 1


def postorder(leaves: list[bytes], levels: int) -> list[bytes]:
    """All nodes in the order of their completion, up to ``levels`` above the leaves."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def complete(node: bytes, level: int) -> None:
        while True:
            log.append(node)
            if level == levels:
                return
            waiting[level].append(node)
            if len(waiting[level]) < 2:
                return
            node = digest(*waiting[level])
            waiting[level] = []
            level += 1

    for leaf in leaves:
        complete(leaf, 0)
    for level in range(levels):
        if waiting[level]:
            node = digest(*waiting[level])
            waiting[level] = []
            complete(node, level + 1)
    return log


def steps(log: bytes, at: int, leaves: int, levels: int) -> bytes:
    """The proof steps of leaf ``at`` within a segment, lowest level first."""
    out = []
    for level in range(levels):
        sibling = (at >> level) ^ 1
        if sibling << level < leaves:
            p = 32 * node_position(level, sibling, leaves)
            out.append((b"\x01" if at >> level & 1 else b"\x02") + log[p:p + 32])
        else:
            out.append(bytes(STEP))
    return b"".join(out)


def siblings(path: bytes) -> list[bytes]:
    return [path[p + 1:p + STEP] for p in range(0, len(path), STEP) if path[p]]


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that ``leaf`` leads to with these siblings."""
    for p in range(0, len(path), STEP):
        side, other = path[p], path[p + 1:p + STEP]
        leaf = digest(leaf) if side == 0 else digest(other, leaf) if side == 1 else digest(leaf, other)
    return leaf


def _levels(n: int, bits: int) -> int:
    """Levels a segment builds: up to the root in a tree of one segment, else the full stretch."""
    return height(n) if n <= 1 << bits else bits


# ---- leaves -----------------------------------------------------------------------

def _field(value: Column) -> Column:
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def _leaf(n_chars: Column) -> Column:
    values = {"doc_id": F.col("doc_id").cast("long"), "n_chars": n_chars}
    return F.unhex(F.sha2(F.concat(*[_field(values.get(f, F.col(f))) for f in FIELDS]), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """``g, doc_id, h, t``: group key, id, leaf digest, and the tampered leaf's digest (null: not tampered)."""
    n_chars = F.col("n_chars").cast("long")
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 0
    more = F.coalesce(F.try_add(n_chars, F.lit(1).cast("long")), n_chars)
    lang = F.col("lang").cast("string")
    return docs.select(
        # A prefix keeps the bytewise order and sets the null group apart and first.
        F.when(lang.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), lang)).alias("g"),
        F.col("doc_id").cast("long").alias("doc_id"), _leaf(n_chars).alias("h"),
        F.when(tampered, _leaf(more)).alias("t"))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``i``, the place within group ``g`` by ``order``, and ``n``, the group's rows.

    Ids that grow along the sorted partitions, minus a stretch's first id, plus the rows
    of the group in earlier partitions. The table of stretches has one row per partition
    and group met there.
    """
    saved = save(rows.withColumn("_tie", F.monotonically_increasing_id()), "merkle-rows")
    by = ["g", *order, "_tie"]
    in_order = saved.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = save(in_order.withColumns({"_at": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}).drop("_tie"),
                  "merkle-order")
    stretches = placed.groupBy("g", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy("g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stretches.select("g", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                               F.sum("_rows").over(Window.partitionBy("g")).alias("n"))
    return placed.join(offsets, ["g", "_part"]).withColumn("i", F.col("_at") - F.col("_first") + F.col("_before")).drop(
        "_at", "_part", "_first", "_before")


# ---- building ------------------------------------------------------------------

def _build(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (g, c), rows in groups(batches, ["g", "c"]):
            n = int(rows["n"].iloc[0])
            log = postorder([bytes(h) for h in rows["h"]], _levels(n, bits))
            yield pd.DataFrame({"g": [g], "c": [c], "n": [n], "root": [log[-1]], "log": [b"".join(log)]})

    return run


def build(rows: DataFrame, bits: int = BITS) -> list[DataFrame]:
    """The tiers of the trees over ``g, i, n, h``: per tier ``g, c, n, root, log``, one row per builder.

    ``c``: the builder's stretch; ``n``: the nodes its group has at the tier's bottom.
    """
    tiers = []
    while True:
        stretch = rows.select("g", F.shiftright("i", bits).alias("c"), "i", "n", "h").repartition("g", "c")
        tier = save(stretch.sortWithinPartitions("g", "c", "i").mapInPandas(_build(bits), _SEGMENT), "merkle-log")
        tiers.append(tier)
        open_ = tier.where(F.col("n") > 1 << bits)
        if open_.isEmpty():
            return tiers
        rows = open_.select("g", F.col("c").alias("i"), F.ceil(F.col("n") / F.lit(1 << bits)).cast("long").alias("n"),
                            F.col("root").alias("h"))


def roots(tiers: list[DataFrame], bits: int = BITS) -> DataFrame:
    """``g, h``: the root of each group."""
    out = None
    for tier in tiers:
        done = tier.where(F.col("n") <= 1 << bits).select("g", F.col("root").alias("h"))
        out = done if out is None else out.unionByName(done)
    return out


# ---- proofs ----------------------------------------------------------------------

def _hand_down(bits: int):
    """Each segment's path, extended to every leaf of the segment."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for g, c, n, log, path in zip(*(b[x].tolist() for x in ("g", "c", "n", "log", "path"))):
                own = min(1 << bits, n - (c << bits))
                yield pd.DataFrame({"g": g, "c": [(c << bits) + at for at in range(own)],
                                    "path": [steps(log, at, own, _levels(n, bits)) + path for at in range(own)]})

    return run


def segment_paths(tiers: list[DataFrame], above: DataFrame, bits: int = BITS) -> DataFrame:
    """The lowest tier's segments with ``path``, the proof steps above each segment.

    ``above`` (g, path): the steps above each group's root.
    """
    below = None
    for tier in reversed(tiers):
        whole = tier.where(F.col("n") <= 1 << bits).join(above, "g")
        now = whole if below is None else whole.unionByName(
            tier.where(F.col("n") > 1 << bits).join(below, ["g", "c"]).select(*whole.columns))
        below = now.select("g", "c", "n", "log", "path").mapInPandas(_hand_down(bits), "g string, c long, path binary")
    return now.select("g", "c", "n", "log", "path")


def _prove(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        log = path = b""
        own = levels = 0
        for (g, c), rows in pieces(batches, ["g", "c"]):
            c, out = int(c), []
            for i, n, h, t, doc, seg_log, seg_path in zip(
                    *(rows[x].tolist() for x in ("i", "n", "h", "t", "doc_id", "log", "path"))):
                if i < 0:  # the segment comes before its leaves
                    log, path, own, levels = seg_log, seg_path, min(1 << bits, n - (c << bits)), _levels(n, bits)
                    continue
                proof = steps(log, i - (c << bits), own, levels) + path
                used = h if t is None else t
                out.append((g, doc, h.hex(), digest(*siblings(proof)).hex(), fold(used, proof).hex()))
            if out:
                yield pd.DataFrame(out, columns=["g", "doc_id", "leaf", "proof_sha256", "folded_root"])

    return run


def manifest(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Per row its leaf, group root, root, the hash of its proof, and the root its (tampered) leaf leads to."""
    placed = save(ranked(leaves(docs), ["doc_id", "h"]), "merkle-leaves")
    tiers = build(placed, bits)
    subroots = save(roots(tiers, bits), "merkle-subroots")
    # The groups' roots, in the order of the groups, are the leaves of one more tree.
    over = ranked(subroots.select(F.lit("").alias("g"), F.col("g").alias("lang_key"), "h"), ["lang_key"])
    top = save(over, "merkle-top")
    top_tiers = build(top, bits)
    found = roots(top_tiers, bits).first()
    root = found["h"].hex() if found else None
    ends = top_tiers[0].select("g").distinct().withColumn("path", F.unhex(F.lit("")))
    segments = segment_paths(top_tiers, ends, bits).mapInPandas(_hand_down(bits), "g string, c long, path binary")
    above = save(top.select(F.col("i").alias("c"), "lang_key").join(segments, "c").select(
        F.col("lang_key").alias("g"), "path"), "merkle-above")
    segs = segment_paths(tiers, above, bits).select(
        "g", "c", F.lit(-1).cast("long").alias("i"), "n", F.lit(None).cast("binary").alias("h"),
        F.lit(None).cast("binary").alias("t"), F.lit(None).cast("string").alias("doc_id"), "log", "path")
    rows = placed.select(
        "g", F.shiftright("i", bits).alias("c"), "i", "n", "h", "t", F.col("doc_id").cast("string").alias("doc_id"),
        F.lit(None).cast("binary").alias("log"), F.lit(None).cast("binary").alias("path"))
    both = rows.unionByName(segs).repartition("g", "c").sortWithinPartitions("g", "c", "i")
    proven = both.mapInPandas(_prove(bits), "g string, doc_id string, leaf string, proof_sha256 string, folded_root string")
    return proven.join(subroots, "g").select(
        F.col("doc_id").cast("long").alias("doc_id"), "leaf", F.lower(F.hex("h")).alias("subroot"),
        F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(root).cast("string")).alias("verified"))
