"""Hard negatives and embedding near-duplicates against brute force, and their corner cases."""

import math
import random

import numpy as np
import pytest
from brute import frame  # noqa: F401 (a fixture)
from pyspark.sql import functions as F

from adlift.llm import rp_forest, slot_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def mined(rows, n_pos=5, n_neg=3, every=5, scale=256):
    """The contract, row by row: {(anchor, positive, rank, negative, scores): times}."""
    def usable(r):
        return r[0] is not None and r[2] is not None and r[1] is not None and all(
            x is not None and math.isfinite(x) for x in r[1])

    part = [(i, [math.floor(scale * float(np.float32(x))) for x in v], y) for i, v, y in filter(usable, rows)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for at, (a, v, label) in enumerate(part):
        if a % every:
            continue
        rest = sorted(((-score(v, w), i, y) for k, (i, w, y) in enumerate(part) if k != at))
        for s, p, _ in [x for x in rest if x[2] == label][:n_pos]:
            fits = [x for x in rest if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:n_neg]
            out += [(a, p, k, n, -s, -t) for k, (t, n, _) in enumerate(fits, 1)]
    return sorted(out)


def mine(df, **more):
    got = slot_negatives.mine(df, F.col("vec_id") % 5 == 0, F.col("label"), **more)
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got.collect())


def random_rows(n, dim, labels, seed, hot=False):
    rnd = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rnd.normal(size=dim) + 0.7
        label = 0 if hot and i % 3 == 0 else int(rnd.integers(labels))
        rows.append((i, [float(x) for x in v.round(1) if True], label))
    return rows


@pytest.mark.parametrize("block_rows", [1000, 7])
def test_negatives_equal_brute_force(frame, block_rows):
    rows = random_rows(120, 4, 3, 1, hot=True)
    want = mined(rows)
    assert len(want) > 100
    assert mine(frame(SCHEMA, rows), block_rows=block_rows) == want


def test_negatives_with_ties_repeats_and_unusable_rows(frame):
    rows = random_rows(40, 3, 2, 2)
    rows += [(100 + i, [1.0, 1.0, 1.0], i % 2) for i in range(12)]      # equal scores
    rows += [rows[5], rows[5], rows[10], rows[10]]                      # repeated rows, anchors among them
    rows += [(200, None, 1), (205, [1.0, None, 1.0], 1), (210, [1.0, float("nan"), 1.0], 1), (None, [1.0, 1.0, 1.0], 1),
             (215, [float("inf"), 1.0, 1.0], 0), (220, [1.0, 2.0, 1.0], None), (225, [], 0), (230, [0.0, 0.0, 0.0], 1),
             (235, [2.0], 1), (240, [-1.0, -1.0, -1.0], 1)]
    want = mined(rows)
    assert mine(frame(SCHEMA, rows), block_rows=9) == want and want


def test_negatives_with_large_components(frame):
    rnd = random.Random(3)
    rows = [(i, [float(rnd.randrange(1, 1 << 20)) for _ in range(3)], i % 2) for i in range(30)]
    assert mine(frame(SCHEMA, rows), block_rows=8) == mined(rows) != []
    huge = [(i, [1e30, 1.0, 1.0], i % 2) for i in range(4)]             # no long holds these
    assert mine(frame(SCHEMA, rows + huge)) == mined(rows)


def test_negatives_of_few_rows_and_clashing_columns(frame, spark):
    assert mine(frame(SCHEMA, [])) == []
    assert mine(frame(SCHEMA, [(0, [1.0], 0)])) == []
    rows = random_rows(30, 3, 2, 4)
    extra = frame(SCHEMA, rows).withColumns({c: F.lit("x") for c in ("rid", "q", "b", "asks", "anchor", "dim", "slot", "uppers")})
    assert mine(extra) == mined(rows)
    one_label = [(i, v, 0) for i, v, _ in rows]
    assert mine(frame(SCHEMA, one_label)) == []


def test_suffixes_answer_every_limit():
    """A window's answer is the suffix of its upper limit, cut at its lower one."""
    rnd = random.Random(5)
    scores = sorted((rnd.randrange(100) for _ in range(60)), reverse=True)
    uppers = [80, 55, 54, 20]
    block = type("B", (), {"codes": np.ones(60, dtype=int), "ids": np.arange(60), "code": lambda self, label: 0})()
    asked = type("A", (), {"uppers": uppers, "least": 10, "label": "0", "rid": 1})()
    by_slot = {}
    for _, slot, i, s in slot_negatives._negatives(3)(block, np.array(scores), asked):
        by_slot.setdefault(slot, []).append(s)
    assert all(len(x) <= 3 for x in by_slot.values())
    for slot, upper in enumerate(uppers):
        merged = sorted((s for k, own in by_slot.items() if k >= slot for s in own), reverse=True)[:3]
        assert merged == [s for s in scores if 10 <= s <= upper][:3]


# ---- near-duplicates ---------------------------------------------------------------

def near(rows, threshold=0.93):
    """{(vec_id, n_links, component_id, kept): times} by all pairs."""
    def usable(r):
        return r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    unit = [np.float32(r[1]).astype(float) / np.linalg.norm(np.float32(r[1]).astype(float)) if usable(r) else None for r in rows]
    linked = [[j for j, u in enumerate(unit) if j != i and unit[i] is not None and u is not None
               and rows[i][2] == rows[j][2] and len(u) == len(unit[i]) and unit[i] @ u >= threshold] for i in range(len(rows))]
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((r[0], len(linked[i]), least, r[0] == least))
    return out


def clustered(n, dim, labels, seed, spread=0.25, size=4):
    """Groups of vectors whose cosines lie on both sides of the threshold."""
    rnd = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        centre = rnd.normal(size=dim)
        centre /= np.linalg.norm(centre)
        label = int(rnd.integers(labels))
        for _ in range(int(rnd.integers(1, 2 * size))):
            v = centre + rnd.normal(size=dim) * spread / math.sqrt(dim) * rnd.random()
            rows.append((len(rows), [float(x) for x in v], label))
    return rows


def key(r):
    return tuple((x is None, x or 0) for x in r)


def found(df, **more):
    return sorted((tuple(r) for r in rp_forest.near_duplicates(df, **more).select(
        "vec_id", "n_links", "component_id", "kept").collect()), key=key)


def test_near_duplicates_equal_brute_force(frame):
    rows = clustered(300, 16, 3, 1, spread=0.5)
    want = sorted(near(rows), key=key)
    assert 50 < sum(w[1] > 0 for w in want) < 300
    assert found(frame(SCHEMA, rows)) == want


def test_trees_with_spill_find_nearly_all_links(frame):
    """Leaves of 24: many splits, many leaves a class; links found are real, few are missed."""
    rows = clustered(900, 32, 2, 2, spread=0.5)
    want = sorted(near(rows), key=key)
    got = found(frame(SCHEMA, rows), leaf=24)
    assert [r[0] for r in got] == [r[0] for r in want] and all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want) > 500


def test_crowd_closer_than_the_margin_is_compared_whole(frame):
    """150 distinct vectors around one point, with leaves of 16: no cut parts them; chunks do."""
    rnd = np.random.default_rng(3)
    centre = rnd.normal(size=16)
    rows = [(i, [float(x) for x in centre + 0.01 * rnd.normal(size=16)], 0) for i in range(150)]
    rows += [(1000 + i, v, label) for i, v, label in clustered(200, 16, 1, 4)]
    got = {r[0]: r for r in found(frame(SCHEMA, rows), leaf=16)}
    assert all(got[i][1:] == (149, 0, i == 0) for i in range(150))


def test_copies_are_one_class_and_odd_rows_stay_alone(frame):
    rows = clustered(60, 8, 2, 5)
    rows += [(100 + i, rows[7][1], rows[7][2]) for i in range(40)] + [rows[3], rows[3]]
    rows += [(200, None, 1), (201, [], 1), (202, [0.0] * 8, 1), (203, [1.0, None] + [0.0] * 6, 1), (204, [float("nan")] * 8, 0),
             (205, rows[7][1], None), (206, rows[7][1], 1 - rows[7][2]), (207, rows[7][1][:7], rows[7][2]),
             (None, rows[7][1], rows[7][2]), (208, [float("inf")] + [1.0] * 7, 0), (209, [3 * x for x in rows[7][1]], rows[7][2]),
             (None, None, 0)]
    want = [(i, n, c, i == c) for i, n, c, _ in near(rows)]
    assert found(frame(SCHEMA, rows)) == sorted(want, key=key)


def test_near_duplicates_of_empty_tables_and_clashing_columns(frame):
    assert found(frame(SCHEMA, [])) == []
    assert found(frame(SCHEMA, [(1, None, 0)])) == [(1, 0, 1, True)]
    rows = clustered(40, 8, 2, 6)
    extra = frame(SCHEMA, rows).withColumns({c: F.lit("x") for c in ("node", "n", "v", "key", "rid", "dim", "leaf", "n_links")})
    assert found(extra) == sorted(near(rows), key=key)


def test_pairs_met_in_several_leaves_count_once(frame):
    """One sample of all rows routed with a wide margin: most classes sit in several leaves."""
    rows = clustered(300, 12, 1, 7, spread=0.4)
    units = rp_forest._units([r[1] for r in rows])
    forest = rp_forest.fit(units, np.zeros(len(rows)), 1.0, 0.93, 3, 32)
    leaves = forest.route(units)
    assert max(map(len, leaves)) > 3 and all(x == sorted(set(x)) for x in leaves)
    got, want = found(frame(SCHEMA, rows), trees=3, leaf=32), sorted(near(rows), key=key)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
