"""Byte-level BPE by monoid tree reduction.

A text is halved until its parts are short, each part is encoded, and neighbours are
joined by re-encoding a window around their boundary. The window grows on either side
until it ends at a cut that no match of the split pattern crosses, whatever stands around
it; tokens outside the window are then exactly those of the whole text:

- no alternative of the pattern matches white space after anything but white space, so a
  match never continues from a non-space character into a space; and
- one ordinary space between two non-space characters always begins a match.

So before such a space ("x| y") every encoding of the text has a token boundary, and the
tokens left of it do not depend on what stands right of it, nor the other way round.
Where a side has no such cut the window grows, doubling, to that whole side, which is
always exact. Decoding concatenates byte strings up the same kind of tree.

Null text is empty: no ids. Long texts cost n log n list copying and windows of a few
dozen tokens per join, except where hundreds of characters hold no single space. Empty
tables give empty tables, repeated rows a row each; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

from adlift.llm.common import id_and_text, id_as_long

LEAF = 2048
WINDOW = 64


@lru_cache(maxsize=2)
def load_ranks(path: str, pattern: str):
    """The ``tiktoken`` encoding of a ranks file, without special tokens."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("monoid", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Part:
    """A monoid element: the stretch ``text[a:b]`` and its ids."""

    __slots__ = ("a", "b", "ids")

    def __init__(self, a: int, b: int, ids: list[int]):
        self.a, self.b, self.ids = a, b, ids


def _last_cut(text: str, a: int, b: int) -> int | None:
    """The last safe cut strictly inside ``text[a:b]``, searched in growing windows from its end."""
    width = WINDOW
    while True:
        lo = max(a, b - width)
        found = None
        at = text.rfind(" ", lo + 1, b - 1)
        while at > lo:
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                found = at
                break
            at = text.rfind(" ", lo + 1, at)
        if found is not None or lo == a:
            return found
        width *= 2


def _first_cut(text: str, a: int, b: int) -> int | None:
    """The first safe cut strictly inside ``text[a:b]``, searched in growing windows from its start."""
    width = WINDOW
    while True:
        hi = min(b, a + width)
        at = text.find(" ", a + 1, hi - 1)
        while at >= 0:
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                return at
            at = text.find(" ", at + 1, hi - 1)
        if hi == b:
            return None
        width *= 2


class MonoidEncoder:
    """Encodes by halving and joining; ``encode`` and ``decode`` are tiktoken's on small parts."""

    def __init__(self, encoding, leaf: int = LEAF):
        self.small, self.leaf = encoding.encode_ordinary, leaf
        self.bytes_of = encoding.decode_bytes
        self.token_bytes = encoding.decode_single_token_bytes

    def _tail(self, text: str, part: Part, cut: int) -> int:
        """How many of the part's ids stand before ``cut``: counted from its end by bytes."""
        left = len(text[cut:part.b].encode("utf-8", "surrogatepass"))
        k = len(part.ids)
        while left > 0:
            k -= 1
            left -= len(self.token_bytes(part.ids[k]))
        assert left == 0, "a token crosses a safe cut"
        return k

    def _head(self, text: str, part: Part, cut: int) -> int:
        """How many of the part's ids stand before ``cut``: counted from its start by bytes."""
        left, k = len(text[part.a:cut].encode("utf-8", "surrogatepass")), 0
        while left > 0:
            left -= len(self.token_bytes(part.ids[k]))
            k += 1
        assert left == 0, "a token crosses a safe cut"
        return k

    def join(self, text: str, x: Part, y: Part) -> Part:
        """The element of ``text[x.a:y.b]``; associative, with empty parts as identity."""
        if not x.ids:
            return Part(x.a, y.b, y.ids)
        if not y.ids:
            return Part(x.a, y.b, x.ids)
        lo, hi = _last_cut(text, x.a, x.b), _first_cut(text, y.a, y.b)
        before = x.ids[:self._tail(text, x, lo)] if lo is not None else []
        after = y.ids[self._head(text, y, hi):] if hi is not None else []
        window = self.small(text[x.a if lo is None else lo:y.b if hi is None else hi])
        return Part(x.a, y.b, before + window + after)

    def reduce(self, text: str, a: int, b: int) -> Part:
        if b - a <= self.leaf:
            return Part(a, b, self.small(text[a:b]) if b > a else [])
        mid = (a + b) // 2
        return self.join(text, self.reduce(text, a, mid), self.reduce(text, mid, b))

    def encode(self, text: str) -> list[int]:
        return self.reduce(text, 0, len(text)).ids

    def decode(self, ids: list[int]) -> bytes:
        """Concatenates up a tree over the ids; leaves hold as many ids as a leaf characters."""
        if len(ids) <= self.leaf:
            return self.bytes_of(ids)
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """``doc_id, ids`` for every row (ids as array<int>)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = MonoidEncoder(load_ranks(ranks_path, pattern), leaf)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": [coder.encode(t or "") for t in b["text"]]})

    return id_as_long(id_and_text(docs).mapInPandas(run, "doc_id string, ids array<int>"))


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode, then decode, every text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = MonoidEncoder(load_ranks(ranks_path, pattern), leaf)
        for b in batches:
            rows = []
            for t in b["text"]:
                ids = coder.encode(t or "")
                rows.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                             hashlib.sha256(coder.decode(ids)).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out

    return id_as_long(id_and_text(docs).mapInPandas(
        run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"))
