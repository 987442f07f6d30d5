"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased, everything but letters becomes a space, and the n-grams of one to
three characters are hashed into ``BUCKETS`` features. Training counts them per language
over all labelled rows: each task adds up whole arrays and emits its nonzero counts, and
one partial aggregate sums them. The log-probability matrix (languages x buckets, 128 KB a
language) is broadcast; its size depends on the number of languages alone. Scoring adds the
matrix rows of a batch's n-grams with numpy, text by text in slices of at most ``SLICE``
characters, so a very long text needs no more memory than a short one.

Null texts and texts without a letter are ``und`` with score 0. Rows with a null language
teach nothing. Without any labelled row every text is ``und``. Ties go to the language
that sorts first. Repeated rows count each; empty tables give empty tables; columns
other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlift.llm.common import id_as_long

BUCKETS = 1 << 15
ORDERS = 3
SLICE = 1 << 18
SMOOTHING = 0.5
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def _slices(texts: list[str | None]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Groups of (text number per slice, code points, first position of each slice).

    A slice of ``n`` positions is followed by two more characters, which complete its last
    n-grams: the text's own next ones, or spaces at its end.
    """
    owners, parts, size = [], [], 0
    for i, t in enumerate(texts):
        if not t:
            continue
        t = t.lower() + "  "
        for at in range(0, len(t) - 2, SLICE):
            piece = t[at:at + SLICE + 2]
            owners.append(i)
            parts.append(piece)
            size += len(piece)
            if size >= SLICE:
                yield _group(owners, parts)
                owners, parts, size = [], [], 0
    if parts:
        yield _group(owners, parts)


def _group(owners: list[int], parts: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.where(_letters()[points], points, np.uint32(32))
    return owners, points, np.r_[0, np.cumsum([len(p) for p in parts])[:-1]]


def _features(points: np.ndarray) -> list[np.ndarray]:
    """The bucket of the n-gram that starts at each position but the last two, for n = 1..3."""
    n = len(points) - (ORDERS - 1)
    h = np.zeros(n, dtype=np.uint32)
    out = []
    for k in range(ORDERS):
        h = (h ^ points[k:k + n]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        out.append(((h * np.uint32(0x85EBCA6B) + np.uint32(k)) >> np.uint32(17)).astype(np.int32))
    return out


def _own(starts: np.ndarray, size: int) -> np.ndarray:
    """Which positions belong to a slice, not to its two completing characters."""
    own = np.ones(size - (ORDERS - 1), dtype=bool)
    ends = starts[1:]
    own[ends - 1] = own[ends - 2] = False
    return own


def count_features(rows: DataFrame) -> DataFrame:
    """``lang, bucket, n`` summed over all rows of ``lang, text``; ``bucket`` -1 counts texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, own in b.groupby("lang")["text"]:
                sums = total.setdefault(lang, np.zeros(BUCKETS + 1, dtype=np.int64))
                sums[-1] += len(own)
                for _, points, starts in _slices(list(own)):
                    keep = _own(starts, len(points))
                    for f in _features(points):
                        sums[:-1] += np.bincount(f[keep], minlength=BUCKETS)
        for lang, sums in total.items():
            at = np.flatnonzero(sums)
            yield pd.DataFrame({"lang": lang, "bucket": np.where(at == BUCKETS, -1, at), "n": sums[at]})

    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counted = rows.where("lang is not null and text is not null").mapInPandas(run, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class NaiveBayes:
    """Languages in order, their log priors and the (buckets x languages) log probabilities."""

    def __init__(self, langs: list[str], prior: np.ndarray, matrix: np.ndarray):
        self.langs, self.prior, self.matrix = langs, prior, matrix

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        n = len(self.langs)
        scores = np.zeros((len(texts), n))
        lettered = np.zeros(len(texts), dtype=bool)
        for owners, points, starts in _slices(texts) if n else ():
            keep = _own(starts, len(points))
            gathered = np.zeros((len(keep), n), dtype=np.float32)
            for f in _features(points):
                gathered += self.matrix[f]
            gathered[~keep] = 0
            np.add.at(scores, owners, np.add.reduceat(gathered, starts, axis=0, dtype=np.float64))
            has = np.add.reduceat((points[:len(keep)] != 32) & keep, starts) > 0
            np.logical_or.at(lettered, owners, has)
        if not n:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        scores += self.prior
        best = scores.argmax(axis=1)
        top = scores.max(axis=1)
        share = 1.0 / np.exp(scores - top[:, None]).sum(axis=1)
        return ([self.langs[k] if ok else UNKNOWN for k, ok in zip(best, lettered)], np.where(lettered, share, 0.0))


def train(rows: DataFrame) -> NaiveBayes:
    """The model of all rows ``lang, text``."""
    # At most languages x (buckets + 1) rows.
    counts = count_features(rows).toPandas()
    langs = sorted(counts["lang"].unique())
    code = {lang: i for i, lang in enumerate(langs)}
    sums = np.zeros((BUCKETS + 1, len(langs)))
    sums[counts["bucket"].to_numpy(), counts["lang"].map(code).to_numpy(dtype=int)] = counts["n"].to_numpy()
    texts, grams = sums[-1], sums[:-1] + SMOOTHING
    matrix = np.log(grams / grams.sum(axis=0)).astype(np.float32)
    return NaiveBayes(langs, np.log(texts / max(1, texts.sum())) if langs else np.zeros(0), matrix)


def classify(docs: DataFrame, model: NaiveBayes, *extra: Column) -> DataFrame:
    """``doc_id, <extra>, lang_pred, score`` for every row of ``docs``; ``extra``: aliased columns."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.prior, model.matrix))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = NaiveBayes(*shared.value)
        for b in batches:
            langs, scores = own.predict([None if t is None or t is pd.NA else t for t in b.pop("text")])
            yield b.assign(lang_pred=langs, score=scores)

    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), *extra,
                       F.col("text").cast("string").alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return id_as_long(rows.mapInPandas(run, f"{fields}, lang_pred string, score double"))
