"""URL filter: a blocked Bloom filter passes possible hits to an exact hash join.

Built from DataFrame functions only. The list holds two kinds of entries:

- rules ``(host, path, verdict)``: a rule fits its host and all subdomains when the
  URL's path starts with the rule's; the longest ``host + path`` wins (of equally long
  ones the greater string, of equal ones ``block``);
- listed canonical URLs (host and path, query and fragment dropped): blocked when no
  rule fits.

Each URL gives one candidate key per shape of the rules (labels in the host, length of
the path) plus its own canonical form. Candidates are tested against a filter of
512-bit blocks, eight 64-bit words each: the key's hash picks the block, a second hash
one bit in each word. What passes meets the list in an exact join on the key, which
removes every false positive. Decisions are made once per distinct URL.

The filter grows with the list, 16 bits a key, up to ``MAX_BLOCKS`` rows of 72 bytes, so its
broadcast has a fixed bound of 75 MB. That holds 33 million keys at full width and twice
as many at under 3 % false positives; a longer list passes more candidates on to the exact join. The list itself is never hinted: the optimizer broadcasts it or shuffles.

Null URLs and URLs without ``://`` have an empty host and path: no rule fits and no
listed URL is empty, so they are allowed. Repeated pages get a row each. Columns other than
``page_id`` and ``url`` are ignored, an empty table gives an empty table, and an empty
list allows every URL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlift.llm.common import lower_ascii, save

WORDS = 8
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 20


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty for null or without ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, shape, k), F.lit(""))
    return lower_ascii(part(1)), part(2)


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).cast("int")


def _masks(key: str) -> list[Column]:
    """One set bit in each of the block's words, six hash bits per word."""
    second = f"xxhash64({key}, 'bit')"
    return [F.expr(f"shiftleft(1L, cast(shiftrightunsigned({second}, {6 * j}) & 63L as int))") for j in range(WORDS)]


def bloom_filter(keys: DataFrame) -> tuple[DataFrame, int]:
    """(rows of ``block, w0..w7``, number of blocks) for a table with a column ``key``."""
    n = keys.count()
    blocks = min(MAX_BLOCKS, 1 << max(0, math.ceil(math.log2(max(1, n * BITS_PER_KEY / (64 * WORDS))))))
    masked = keys.select(_block("key", blocks).alias("block"), *[m.alias(f"m{j}") for j, m in enumerate(_masks("key"))])
    return masked.groupBy("block").agg(*[F.bit_or(f"m{j}").alias(f"w{j}") for j in range(WORDS)]), blocks


def _probe(rows: DataFrame, keys: DataFrame, how: str) -> tuple[DataFrame, Column]:
    """``rows`` joined to the filter of ``keys``, and the test whether a row's key may be among them."""
    table, blocks = bloom_filter(keys)
    table = table.withColumnRenamed("block", "_block")
    probe = rows.withColumn("_block", _block("key", blocks))
    probe = probe.select("*", *[m.alias(f"_m{j}") for j, m in enumerate(_masks("key"))])
    test = F.lit(True)
    for j in range(WORDS):
        test = test & (F.col(f"w{j}").bitwiseAND(F.col(f"_m{j}")) == F.col(f"_m{j}"))
    # At most MAX_BLOCKS rows by construction.
    return probe.join(F.broadcast(table), "_block", how), F.coalesce(test, F.lit(False))


def possible_hits(candidates: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``candidates`` whose ``key`` may be among ``keys``."""
    probed, maybe = _probe(candidates, keys, "inner")
    return probed.where(maybe).select(*candidates.columns)


def without_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose ``key`` is not among ``keys``: an exact anti-join that shuffles only possible hits.

    Rows that the filter clears stay where they are, however wide they are.
    """
    probed, maybe = _probe(rows, keys, "left")
    hits = probed.where(maybe).select(*rows.columns).join(keys.select("key"), "key", "left_anti")
    return probed.where(~maybe).select(*rows.columns).unionByName(hits.select(*rows.columns))


def distinct_urls(pages: DataFrame) -> DataFrame:
    """The distinct URLs of ``pages``, written once: one narrow column ``url``."""
    return save(pages.select(F.col("url").cast("string").alias("url")).where("url is not null").distinct(), "urls")


def judge_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, urls: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules``: host, path, verdict. ``listed``: one column ``url`` of URLs to block.
    ``urls``: the pages' :func:`distinct_urls`, where they are at hand.
    """
    rules = rules.select(F.concat(lower_ascii(F.col("host")), F.col("path")).alias("rule"),
                         F.size(F.split(F.col("host"), r"\.")).alias("labels"),
                         F.length("path").alias("len"), F.col("verdict").alias("rule_verdict"))
    # The distinct (labels, path length) pairs: bounded by the length of a URL, not by the list.
    shapes = sorted((r["labels"], r["len"]) for r in rules.select("labels", "len").distinct().collect())
    lhost, lpath = split_url(F.col("url"))
    listed_keys = listed.select(F.concat(lhost, lpath).alias("listed")).where("listed != ''").distinct()
    entries = rules.select(F.concat(F.lit("r:"), "rule").alias("key"), "rule", "rule_verdict").unionByName(
        listed_keys.select(F.concat(F.lit("u:"), "listed").alias("key"), F.lit(None).cast("string").alias("rule"),
                           F.lit("block").alias("rule_verdict")))

    host, path = split_url(F.col("url").cast("string"))
    urls = distinct_urls(pages) if urls is None else urls
    urls = urls.select("url", host.alias("host"), path.alias("path"))
    wanted = [F.expr(f"CASE WHEN length(path) >= {n} AND size(split(host, '[.]')) >= {k} "
                     f"THEN concat('r:', substring_index(host, '.', -{k}), left(path, {n})) END") for k, n in shapes]
    wanted.append(F.concat(F.lit("u:"), "host", "path"))
    candidates = urls.select("url", F.explode(F.array_compact(F.array(*wanted))).alias("key"))
    hits = possible_hits(candidates, entries.select("key").distinct()).join(entries, "key")
    fits = F.col("rule").isNotNull()
    decided = hits.groupBy("url").agg(
        F.max(F.when(fits, F.struct(F.length("rule").alias("n"), "rule", "rule_verdict"))).alias("best"),
        F.max(~fits).alias("is_listed"))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url")).join(decided, "url", "left")
    return rows.select("page_id", host.alias("host"), path.alias("path"), F.col("best.rule").alias("rule"),
                       F.coalesce(F.col("best.rule_verdict"), F.when(F.col("is_listed"), "block"), F.lit("allow"))
                       .alias("verdict"))
