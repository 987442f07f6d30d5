"""Packing: vector bin packing with the dot-product heuristic.

Examples are placed into sequences under simultaneous limits on tokens, segments and
loss-bearing tokens. The open sequence repeatedly takes the example whose demand has the
largest dot product with what the sequence has left (both as shares of the limits), so
long examples go into empty sequences and examples rich in one resource where that
resource is left. When none fits and cutting is allowed, the best example is cut to fill
the sequence exactly; an example longer than a sequence first fills whole ones.

Held examples are grouped by their demand (tokens, loss-bearing tokens): equal demands
score alike, so a step looks at the distinct demands and takes an example of the best,
however many examples are held.

Packing is local to a Spark partition: a partition streams through a pool of bounded
size, whatever the table's size, and no row is shuffled. With cutting allowed a sequence
that a limit leaves unfilled is cut into lengths that are powers of two, which need no
padding. Sequence ids combine the partition's number and a counter, so a recomputed task
gives the same ids.

Which ids bear loss: all, or those that start within the spans of an optional column (in
code points, such as the assistant's turns of a conversation).

Token ids come from the ``tokenizers`` file. Its vocabulary also exists as ``tiktoken``
ranks, several times faster; texts whose characters are all plain Latin (where both
libraries' patterns have one reading, see PLAIN) and that do not contain the file's
special token go there, all others to ``tokenizers`` itself.

Null text is an empty document: its one id is the end id. Repeated rows are packed each.
Empty tables give empty tables; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.llm.common import id_and_text

# Characters on which the two libraries' patterns agree: ASCII text, Latin letters, common marks.
PLAIN = regex.compile(r"[\t\n\r\x20-\x7e¡-¬®-ɏ‐-‧‰-›€]*+")
SPECIAL = "<|endoftext|>"
END_ID = 0


def load_encoder(json_path: str, ranks_path: str | None, pattern: str) -> Callable[[list[str]], list[np.ndarray]]:
    """Ids of each text, as ``tokenizers`` with the file ``json_path`` gives them."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(json_path)
    fast = None
    if ranks_path:
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str], offsets: bool = False) -> list:
        if offsets:
            found = [exact.encode(t, add_special_tokens=False) for t in texts]
            return [(np.array(e.ids, dtype=np.uint32), e.offsets) for e in found]
        out = []
        for t in texts:
            if fast is not None and SPECIAL not in t and PLAIN.fullmatch(t):
                out.append(fast.encode_to_numpy(t, disallowed_special=()))
            else:
                out.append(np.array(exact.encode(t, add_special_tokens=False).ids, dtype=np.uint32))
        return out

    return encode


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold. ``pool`` bounds the tokens held before packing goes on."""

    tokens: int = 1024
    segments: int = 256
    loss_tokens: int = 1024
    pool: int = 256 * 1024

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss_tokens) < 1:
            raise ValueError("limits must be positive")


@dataclass
class Example:
    """``loss`` marks the loss-bearing tokens (one flag per id)."""

    doc_id: int | None
    ids: np.ndarray
    loss: np.ndarray
    start: int = 0
    total: int = 0

    def cut(self, n: int) -> tuple["Example", "Example"]:
        return (Example(self.doc_id, self.ids[:n], self.loss[:n], self.start, self.total),
                Example(self.doc_id, self.ids[n:], self.loss[n:], self.start + n, self.total))

    def fits(self, tokens: int, loss: int) -> int:
        """How many leading ids fit."""
        n = min(tokens, len(self.ids))
        marks = np.cumsum(self.loss[:n])
        return int(np.searchsorted(marks, loss, side="right"))


class Packer:
    """Streams examples into sequences; ``emit(sequence, pieces)`` gets each closed one."""

    def __init__(self, limits: Limits, emit: Callable[[int, list[Example]], None], cut: bool = True):
        self.limits, self.emit, self.cut = limits, emit, cut
        self.pool: dict[tuple[int, int], list[Example]] = {}
        self.held = self.sequence = 0

    def _close(self, pieces: list[Example]) -> None:
        self.emit(self.sequence, pieces)
        self.sequence += 1

    def _hold(self, example: Example) -> tuple[int, int]:
        demand = (len(example.ids), int(example.loss.sum()))
        self.pool.setdefault(demand, []).append(example)
        self.held += demand[0]
        return demand

    def _take(self, demand: tuple[int, int]) -> Example:
        self.held -= demand[0]
        return self.pool[demand].pop()

    def add(self, example: Example) -> None:
        lim = self.limits
        while len(example.ids) >= lim.tokens or int(example.loss.sum()) > lim.loss_tokens:
            n = example.fits(lim.tokens, lim.loss_tokens)
            if not self.cut and n < len(example.ids):
                raise ValueError("an example exceeds the limits of a sequence and may not be cut")
            head, example = example.cut(n)
            self._finish([head])
        if len(example.ids):
            self._hold(example)
        if self.held >= lim.pool:
            self.drain(lim.pool // 2)

    def drain(self, until: int) -> None:
        """Pack until at most ``until`` tokens are held."""
        cap = np.array([self.limits.tokens, self.limits.segments, self.limits.loss_tokens], dtype=float)
        demands = list(self.pool)
        need = np.array([(t, 1, l) for t, l in demands], dtype=float).reshape(-1, 3)
        have = np.array([len(v) for v in self.pool.values()])
        while self.held > until:
            left, pieces = cap.copy(), []
            while left[0] > 0 and left[1] > 0 and have.any():
                score = need @ (left / cap / cap)
                fit = (have > 0) & (need <= left).all(axis=1)
                if fit.any():
                    k = int(np.argmax(np.where(fit, score, -1.0)))
                    times = 1
                    if np.count_nonzero(fit) == 1:
                        # What does not fit now will not later: this demand alone fills the rest.
                        wants = need[k] > 0
                        times = min(int(have[k]), int((left[wants] // need[k][wants]).min()))
                    pieces += [self._take(demands[k]) for _ in range(times)]
                    left -= times * need[k]
                    have[k] -= times
                    continue
                if not self.cut:
                    break
                k = int(np.argmax(np.where(have > 0, score, -1.0)))
                n = self.pool[demands[k]][-1].fits(int(left[0]), int(left[2]))
                if not n:
                    break
                head, rest = self._take(demands[k]).cut(n)
                have[k] -= 1
                pieces.append(head)
                left -= (n, 1, float(head.loss.sum()))
                demand = self._hold(rest)
                if demand in demands:
                    have[demands.index(demand)] += 1
                else:
                    demands.append(demand)
                    need, have = np.vstack([need, [(demand[0], 1, demand[1])]]), np.append(have, 1)
            self._finish(pieces)
        self.pool = {d: v for d, v in self.pool.items() if v}

    def _finish(self, pieces: list[Example]) -> None:
        """Close a sequence; an unfilled one is cut at powers of two where cutting is allowed."""
        size = sum(len(e.ids) for e in pieces)
        if not self.cut or size & (size - 1) == 0 or size >= self.limits.tokens:
            self._close(pieces)
            return
        while pieces:
            room, now = 1 << (size.bit_length() - 1), []
            size -= room
            while room:
                head = pieces.pop(0)
                if len(head.ids) > room:
                    head, rest = head.cut(room)
                    pieces.insert(0, rest)
                now.append(head)
                room -= len(head.ids)
            self._close(now)


def loss_flags(offsets: list[tuple[int, int]], spans: list[tuple[int, int]], length: int) -> np.ndarray:
    """One flag per id and one for the end id: does it start within a span?

    The end id goes with the text's last character. Spans may overlap, be empty or reach
    beyond the text.
    """
    inside = np.zeros(length + 1, dtype=np.int8)
    for a, b in spans:
        inside[max(0, a):max(0, b)] = 1
    starts = [min(a, length) for a, _ in offsets]
    return np.append(inside[starts], inside[length - 1] if length else 0).astype(np.int8)


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str | None, pattern: str,
                   limits: Limits = Limits(), loss: str | None = None) -> DataFrame:
    """One row per piece of every document of ``docs`` (``doc_id, text``).

    ``loss``: a column ``array<struct<start, end>>`` of the loss-bearing parts of the text, in
    code points. Without it, and where it is null, every id bears loss.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load_encoder(json_path, ranks_path, pattern)
        base = TaskContext.get().partitionId() << 40
        out: list[tuple] = []

        def emit(sequence: int, pieces: list[Example]) -> None:
            offset = 0
            for e in pieces:
                out.append((e.doc_id, e.start, len(e.ids), zlib.crc32(e.ids.astype("<u4").tobytes()), e.total,
                            base + sequence, offset))
                offset += len(e.ids)

        def taken() -> pd.DataFrame:
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            out.clear()
            return frame

        def flagged(texts: list[str], spans: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for text, own, marked in zip(texts, encode(texts), spans):
                flags = np.ones(len(own) + 1, dtype=np.int8)
                if marked is not None:
                    (own, offsets), = encode([text], offsets=True)
                    flags = loss_flags(offsets, [(int(m["start"]), int(m["end"])) for m in marked], len(text))
                yield np.append(own, np.uint32(END_ID)).astype(np.uint32), flags

        packer = Packer(limits, emit)
        for batch in batches:
            ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
            spans = batch["_loss"].tolist() if loss else [None] * len(batch)
            for at in range(0, len(batch), 64):
                texts = [t or "" for t in batch["text"].iloc[at:at + 64]]
                for doc_id, (own, flags) in zip(ids[at:at + 64], flagged(texts, spans[at:at + 64])):
                    packer.add(Example(doc_id, own, flags, 0, len(own)))
            if out:
                yield taken()
        packer.drain(0)
        if out:
            yield taken()

    rows = id_and_text(docs)
    if loss:
        given = F.filter(F.col(f"`{loss}`"), lambda s: s["start"].isNotNull() & s["end"].isNotNull())
        parts = F.transform(given, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end")))
        rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"),
                           F.col("text").cast("string").alias("text"), parts.alias("_loss"))
    return rows.mapInPandas(run, PIECES)
