"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, then the Hamming distance.

A text's fingerprint has bit b set when over half of its word shingles' XXH64 hashes
(seed 42) have it. Fingerprints at most ``distance`` bits apart are linked, and linked
documents form components.

- Equal fingerprints are one node, so any number of copies costs one row.
- The 64 bits are cut into ``2 * distance`` blocks. Two fingerprints that differ in at
  most ``distance`` bits agree on at least ``distance`` whole blocks, so each
  fingerprint is listed under every choice of that many blocks (20 keys of 32 bits for
  distance 3) and meets every partner under some key. No partner is capped or dropped.
- Rows are shuffled and sorted by key; one pass over each sorted partition compares the
  fingerprints below a key and emits links that connect what is close (at most one link
  per fingerprint, not all pairs).
- A key with more than ``SPLIT`` distinct fingerprints is not compared in place: its rows
  go on to a second round, listed under choices of blocks of the other 32 bits. Below
  such a refined key at least 48 bits agree, so it holds at most 2^16 fingerprints
  (512 KB): a bound that no input can exceed.

Null texts and texts without words have fingerprint zero and are linked like any other.
Null ids are members but never name a component while another id is there. Repeated rows
get a row each. Empty tables give empty tables; columns other than ``doc_id`` and ``text``
are passed through by :func:`keep_one` and ignored elsewhere. Long texts are hashed in
slices, so memory is bounded by the text itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.llm.bloom_urls import without_keys
from adlift.llm.common import id_and_text, id_as_long, save
from adlift.llm.components import connected_components

SEED = 42
SPLIT = 2048
SLICE = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    # bytes.lower() maps A-Z alone, bytes.split() cuts at 0x20 and 0x09-0x0D alone.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    span = min(shingle, len(words))
    for at in range(0, n, SLICE):
        end = min(n, at + SLICE)
        hashes = np.array([digest(joined[a:b - 1], SEED) for a, b in zip(starts[at:end], starts[at + span:end + span])],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) for every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fps})

    return id_as_long(id_and_text(docs).mapInPandas(run, "doc_id string, fp long"))


def _masks(blocks: int, choose: int, bits: range) -> list[int]:
    """One mask per choice of ``choose`` of ``blocks`` nearly equal runs of ``bits``."""
    bits = list(bits)
    cuts = [len(bits) * k // blocks for k in range(blocks + 1)]
    runs = [sum(1 << bits[p] for p in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(runs, choose)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _links(fps: np.ndarray, distance: int, earlier: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect the fingerprints of one key as all close pairs would.

    Walks breadth first: each fingerprint reached is compared once with those not yet
    reached. At most one link per fingerprint; memory grows with their number alone. A
    pair that also agrees under an ``earlier`` mask is connected there already, directly
    or over others, so its link is left to that key.
    """
    out, left = [], np.unique(fps)
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= distance
            if near.any():
                found = left[near]
                own = found[~(((found ^ at)[:, None] & earlier) == 0).any(axis=1)]
                out += [(int(at), int(x)) for x in own]
                queue += list(found)
                left = left[~near]
    return out


def _compare_runs(distance: int, split: int | None, earlier: list[list[int]]):
    """For ``mapInPandas`` over rows sorted by (rule, key): links, and the rows of keys over ``split``.

    ``earlier``: for each rule the masks of the rules before it.
    """
    masks = [np.array([_signed(m) for m in own], dtype=np.int64) for own in earlier]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        key, size, over = None, 0, False

        def rows(links, forward):
            rule, k = key if key is not None else (0, 0)
            a = np.array([x for x, _ in links] + list(forward), dtype=np.int64)
            b = np.array([y for _, y in links] + [k] * len(forward), dtype=np.int64)
            r = np.array([-1] * len(links) + [rule] * len(forward), dtype=np.int32)
            return pd.DataFrame({"rule": r, "a": a, "b": b})

        def close():
            if over or size < 2:
                return None
            found = _links(np.concatenate(held), distance, masks[key[0]])
            return rows(found, []) if found else None

        for batch in batches:
            if not len(batch):
                continue
            rules, keys, fps = (batch[c].to_numpy() for c in ("rule", "k", "fp"))
            edge = np.flatnonzero((rules[1:] != rules[:-1]) | (keys[1:] != keys[:-1])) + 1
            starts, ends = np.r_[0, edge], np.r_[edge, len(fps)]
            # Alone below its key is the usual case; only the batch's first and last
            # run may go on in another batch.
            look = ends - starts > 1
            look[[0, -1]] = True
            for a, b in zip(starts[look], ends[look]):
                now = (int(rules[a]), int(keys[a]))
                if now != key:
                    done = close()
                    if done is not None:
                        yield done
                    key, held, size, over = now, [], 0, False
                held.append(fps[a:b])
                size += b - a
                if split is not None and size > split:
                    over = True
                    yield rows([], np.concatenate(held))
                    held = []
        done = close()
        if done is not None:
            yield done

    return run


def _meet(keyed: DataFrame, distance: int, split: int | None, earlier: list[list[int]]) -> DataFrame:
    sorted_rows = keyed.repartition("rule", "k").sortWithinPartitions("rule", "k")
    return sorted_rows.mapInPandas(_compare_runs(distance, split, earlier), "rule int, a long, b long")


def links(fps: DataFrame, distance: int, split: int = SPLIT) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints that connect all within ``distance`` bits."""
    distinct = fps.select("fp").distinct()
    blocks = 2 * max(1, distance)
    masks = _masks(blocks, blocks - distance, range(64))
    table = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(_signed(m)).alias("mask")) for i, m in enumerate(masks)])
    keyed = distinct.select("fp", F.explode(table).alias("m")).select(
        F.col("m.rule").alias("rule"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("k"), "fp")
    first = save(_meet(keyed, distance, split, [masks[:i] for i in range(len(masks))]), "simhash-links")
    near = first.where("rule < 0").select("a", "b")
    crowded = first.where("rule >= 0")
    if crowded.isEmpty():
        return near
    # The other bits of a crowded key, cut into blocks the same way.
    finer = [_masks(blocks, blocks - distance, [p for p in range(64) if not m >> p & 1]) for m in masks]
    table = F.array(*[F.array(*[F.lit(_signed(x)) for x in own]) for own in finer])
    again = crowded.select("rule", "b", "a", F.posexplode(F.element_at(table, F.col("rule") + 1)))
    earlier = [masks[:i] + [m | x for x in own[:j]] for i, (m, own) in enumerate(zip(masks, finer)) for j in range(len(own))]
    refined = again.select((F.col("rule") * F.lit(len(masks)) + F.col("pos")).alias("rule"),
                           F.col("b").bitwiseOR(F.col("a").bitwiseAND(F.col("col"))).alias("k"), F.col("a").alias("fp"))
    return near.unionByName(save(_meet(refined, distance, None, earlier), "simhash-links").select("a", "b"))


def components(docs: DataFrame, shingle: int, distance: int, split: int = SPLIT) -> DataFrame:
    """``doc_id, fp, component_id`` for every row: the smallest id reachable over links."""
    fps = save(fingerprints(docs, shingle), "simhash-fingerprints")
    nodes = connected_components(links(fps, distance, split))
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    rooted = first.join(nodes, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root")
    return fps.join(named.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """One document of each component: the row whose id names it; columns as they were.

    An id that names a component stays; its rows repeated with one text become one row.
    Documents without an id are kept unless none of them names a component.
    """
    found = save(components(docs, shingle, distance), "simhash-components")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    stay = found.where(stays).groupBy("doc_id").agg(F.count("*").alias("n"))
    drop = found.where(~stays).select(F.col("doc_id").alias("_id")).distinct().join(
        stay.select(F.col("doc_id").alias("_s")), F.col("_id").eqNullSafe(F.col("_s")), "left_anti")
    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("_text"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in"))
    key = lambda i: F.coalesce(F.col(i).cast("string"), F.lit("")).alias("key")
    rows = without_keys(rows.select("*", key("_doc")), save(drop.select(key("_id")), "simhash-drop"))
    if not stay.where("n > 1").isEmpty():
        rows = rows.withColumn("_sha", F.sha2("_text", 256)).dropDuplicates(["_doc", "_sha"])
    return rows.select(*[F.col(f"_in.`{c}`").alias(c) for c in docs.columns])
