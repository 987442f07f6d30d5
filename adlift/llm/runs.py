"""Groups of a sorted partition, for ``mapInPandas`` functions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def pieces(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """(key, rows) for each stretch of equal keys within a batch, in order.

    A group that goes on in the next batch comes in several pieces. Keys hold no nulls.
    """
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch[k].to_numpy() for k in keys]
        changed = np.zeros(len(batch) - 1, dtype=bool)
        for c in columns:
            changed |= c[1:] != c[:-1]
        edge = np.flatnonzero(changed) + 1
        for a, b in zip(np.r_[0, edge], np.r_[edge, len(batch)]):
            yield tuple(c[a] for c in columns), batch.iloc[a:b]


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """(key, all rows of that key); for groups whose size has a bound."""
    key, held = None, []
    for k, rows in pieces(batches, keys):
        if k != key and held:
            yield key, pd.concat(held, ignore_index=True)
            held = []
        key = k
        held.append(rows)
    if held:
        yield key, pd.concat(held, ignore_index=True)
