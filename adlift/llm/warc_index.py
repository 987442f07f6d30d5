"""WARC archives and their capture index, merged from locally sorted runs.

Writing: one WARC/1.1 record per page, payload the html in UTF-8. Of records with equal
payloads of at least ``MIN_REVISIT`` bytes the one with the smallest page id is a
``response``; the others are ``revisit`` records, which name it in ``WARC-Refers-To`` and
carry no block, as the standard's identical-payload profile has it. Records are written by
Spark's text sink with the record terminator as line separator, so each file is a plain WARC
file (named ``.txt`` by that sink). A file holds at most ``RECORDS_PER_FILE`` records and
``FILE_BYTES`` bytes, unless one record alone is larger: longer records form classes of their
own, each of whose files holds as many as fit if all are of the class's greatest length.

Reading: files are parsed record by record by their Content-Length; digests and lengths
are taken from the payload bytes read back. A task holds one file at a time.

Index: each archive file yields its captures sorted by (URL key, timestamp, page id), a
local run. Runs are written to the shared folder, dealt out by key range, and each range
merges its runs with a loser tree: every replay from leaf to root costs log2(k) comparisons.
Ranges split on the whole key, so the captures of one hot URL spread over many tasks. The
result is ordered within and across partitions.

Null html is an empty payload. Payloads shorter than ``MIN_REVISIT`` are all responses. Rows
repeating the smallest page id of a payload are all responses, and a null id is never the
smallest; if all ids of a payload are null, its records are all responses. Line breaks in a url are
percent-encoded in the header; a null url gives an empty one. Pages carry no capture time,
so the record's date is ``EPOCH`` plus the page id in seconds (the id modulo 2^31 where it
is larger). Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.llm.common import save, shared_path

MIN_REVISIT = 100
RECORDS_PER_FILE = 2000
FILE_BYTES = 128 << 20
HEADER_BYTES = 1000
ROWS_PER_RANGE = 200_000
EPOCH = "2024-01-01 00:00:00"
END = "\r\n\r\n"
CAPTURE = ("url_key string, captured string, page_id long, record_type string, payload_digest string, "
           "payload_bytes long, refers_to long, file string, offset long, length long")
KEY = ("url_key", "captured", "page_id")


def _header(name: str, value) -> F.Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def size_classes(records_per_file: int, file_bytes: int) -> list[tuple[int, int]]:
    """(records a file may hold, longest record) of each class; the last one takes any length."""
    held = [records_per_file]
    while held[-1] > 1:
        held.append(max(1, held[-1] // 8))
    return [(n, file_bytes // n) for n in held]


def write_archives(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE,
                   file_bytes: int = FILE_BYTES) -> None:
    """One WARC record per row of ``pages`` (``page_id, url, html``) in files below ``path``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    classes = size_classes(records_per_file, file_bytes)
    # The url and two digests stand in the header; a line break of the url takes three bytes there.
    whole = F.octet_length("html") + 3 * F.octet_length("url") + HEADER_BYTES
    rows = rows.withColumn("class", sum(((whole > most).cast("int") for _, most in classes[:-1]), F.lit(0)))
    # At most one row per class.
    present = {r["class"] for r in rows.select("class").distinct().collect()} | {0}
    rows = rows.withColumns({"digest": F.sha2("html", 256), "bytes": F.octet_length("html")})
    firsts = rows.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 and first_id is not null")
    # Written first, so its real size decides between broadcasting it and shuffling.
    firsts = save(firsts.select("digest", "first_id"), "warc-firsts")
    rows = rows.join(firsts, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    seconds = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 31)).cast("int")
    date = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(EPOCH)) + seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = lambda c: F.replace(F.replace(c, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record_id = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", record_id(F.col("page_id"))),
        _header("WARC-Date", date),
        _header("WARC-Target-URI", line(F.col("url"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(revisit, F.concat(
            _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _header("WARC-Refers-To", record_id(F.col("first_id"))))).otherwise(F.lit("")),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
        F.lit("\r\n"), F.when(revisit, F.lit("")).otherwise(F.col("html")))
    for k in sorted(present):
        rows.where(F.col("class") == k).select(record.alias("value")).write.option("lineSep", END).option(
            "maxRecordsPerFile", classes[k][0]).text(f"{path}/{k}")


def read_records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record of one archive file."""
    at = 0
    while at < len(content):
        if not content.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        head_end = content.index(b"\r\n\r\n", at)
        lines = content[at:head_end].decode("utf-8").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = head_end + 4
        end = start + int(headers["Content-Length"])
        if content[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield at, end + 4 - at, headers, content[start:end]
        at = end + 4


def url_key(url: str) -> str:
    """Sort-friendly key: host labels reversed, then path and query; scheme and fragment dropped."""
    m = re.match(r"(?s).*?://([^/?#]*)([^#]*)", url)
    if not m:
        return url
    return ",".join(reversed(m[1].lower().split("."))) + ")" + (m[2] or "/")


def _page(value: str | None) -> int | None:
    number = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(number[1]) if number else None


def _order(c: Sequence) -> tuple:
    """Merge order of a capture; a null id comes first, as in Spark."""
    return c[0], c[1], c[2] is not None, c[2] or 0


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    fields = [f.split() for f in schema.split(", ")]
    frame = pd.DataFrame(rows, columns=[n for n, _ in fields])
    return frame.astype({n: "Int64" for n, t in fields if t == "long"})


def capture_runs(spark, path: str) -> DataFrame:
    """The captures of every archive file below ``path``, sorted within each file: its run."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["path"], b["content"]):
                own = []
                for offset, length, h, block in read_records(content):
                    kind = h["WARC-Type"]
                    digest = hashlib.sha256(block).hexdigest() if kind == "response" \
                        else h["WARC-Payload-Digest"].removeprefix("sha256:")
                    own.append((url_key(h["WARC-Target-URI"]), h["WARC-Date"], _page(h["WARC-Record-ID"]), kind, digest,
                                len(block) if kind == "response" else None, _page(h.get("WARC-Refers-To")),
                                file.rsplit("/", 1)[-1], offset, length))
                own.sort(key=_order)
                yield _frame(own, CAPTURE)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInPandas(run, CAPTURE)


class LoserTree:
    """Merges sorted runs: inner nodes hold the loser of their match, the root the winner."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.heads = [key(r[0]) if r else None for r in runs]
        k = len(runs)
        self.tree = [-1] * max(1, k)
        for i in range(k):
            self._enter(i)

    def _beats(self, i: int, j: int) -> bool:
        a, b = self.heads[i], self.heads[j]
        if a is None or b is None:
            return b is None and a is not None
        return (a, i) < (b, j)

    def _enter(self, i: int) -> None:
        """First round: stop at an empty node, else leave the loser and go on up."""
        node = (i + len(self.runs)) // 2
        while node:
            other = self.tree[node]
            if other < 0:
                self.tree[node] = i
                return
            if self._beats(other, i):
                self.tree[node], i = i, other
            node //= 2
        self.tree[0] = i

    def __iter__(self):
        if not self.runs:
            return
        k, tree = len(self.runs), self.tree
        while True:
            i = tree[0]
            if self.heads[i] is None:
                return
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            run = self.runs[i]
            self.heads[i] = self.key(run[self.at[i]]) if self.at[i] < len(run) else None
            node = (i + k) // 2
            while node:
                if self._beats(tree[node], i):
                    tree[node], i = i, tree[node]
                node //= 2
            tree[0] = i


def natural_runs(rows: list[tuple], source: int) -> list[list[tuple]]:
    """Cuts rows into ascending stretches of one source; a run that arrives whole stays whole."""
    out: list[list[tuple]] = []
    for r in rows:
        if out and out[-1][-1][source] == r[source] and _order(out[-1][-1]) <= _order(r):
            out[-1].append(r)
        else:
            out.append([r])
    return out


def merge_runs(runs: DataFrame, ranges: int) -> DataFrame:
    """All captures in global order of (URL key, timestamp, page id)."""
    names = [f.split()[0] for f in CAPTURE.split(", ")]
    source = names.index("file")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[list[tuple]] = []
        for b in batches:
            b = b.astype(object).where(b.notna(), None)
            held += natural_runs(list(b.itertuples(index=False, name=None)), source)
        rows = []
        for r in LoserTree(held, _order):
            rows.append(tuple(None if v is None else int(v) if isinstance(v, float) else v for v in r))
            if len(rows) == 10_000:
                yield _frame(rows, CAPTURE)
                rows = []
        if rows:
            yield _frame(rows, CAPTURE)

    dealt = runs.repartitionByRange(ranges, *[F.col(k) for k in KEY])
    # Whole numbers travel as text: beside a null, pandas would turn them into floats.
    as_text = dealt.select(*[F.col(n).cast("string").alias(n) if n in ("page_id", "refers_to") else F.col(n) for n in names])
    return as_text.mapInPandas(_typed(run, names), CAPTURE)


def _typed(run, names):
    def typed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parsed():
            for b in batches:
                for n in ("page_id", "refers_to"):
                    b[n] = pd.Series([None if v is None else int(v) for v in b[n]], dtype=object)
                yield b

        yield from run(parsed())

    return typed


def archive_captures(pages: DataFrame, records_per_file: int = RECORDS_PER_FILE,
                     file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes archives of ``pages``, reads them back and returns the merged index.

    The index is written to the shared folder in global order; a revisit's length is that
    of the response it refers to.
    """
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_archives(pages, path, records_per_file, file_bytes)
    runs = save(capture_runs(spark, path), "warc-runs")
    size = runs.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // ROWS_PER_RANGE + 1)
    return save(merge_runs(runs, ranges), "warc-index")


def resolve_revisits(index: DataFrame) -> DataFrame:
    """``index`` with the payload length of revisits taken from their response."""
    responses = index.where("record_type = 'response'").groupBy(
        F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest")).agg(
        F.max("payload_bytes").alias("_bytes"))
    revisits = index.where("record_type = 'revisit'").join(
        responses, (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left")
    fixed = revisits.withColumn("payload_bytes", F.col("_bytes")).select(*index.columns)
    return index.where("record_type = 'response'").unionByName(fixed)
