"""A Parquet table of day folders that is replaced day by day, never seen half replaced.

Layout: ``<path>/<year>=Y/<month>=M/<day>=D/part-...`` as any reader of partitioned Parquet
expects it, and beside it ``<path>/_days/``:

    stage-<n>/     rows of commit n in the same folders, until they are published
    commit-<n>     what commit n replaces: its days, and which of them have rows
    done-<n>       commit n is published

A write stages all its rows first. Creating ``commit-<n>`` is the one step that makes them
count: a rename of a complete file. After it the days are published one at a time: the old
folder goes, the staged one is renamed into its place. A run that fails before the commit
leaves the old days; one that fails after it is finished by the next write
(:func:`recover`), and until then :func:`read_days` reads the days not yet published from
the stage. So a reader gets all old or all new days of a commit.

The driver touches file names only, a bounded number per day of the window. One writer at
a time (a second one fails at the rename). Renames are atomic on HDFS and local disks; on
object stores a folder's rename is a copy, which the stage covers in the same way.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlift.functions.dates import day_number, partition_day_predicate

META = "_days"


@dataclass
class Commit:
    """One replacement of days. ``info``: what the writer wants kept with the table's state."""

    number: int
    days: list[dt.date]
    staged: list[dt.date]
    mode: str = "overwrite"
    info: dict = field(default_factory=dict)

    def to_json(self) -> str:
        iso = lambda days: [d.isoformat() for d in days]
        return json.dumps({"number": self.number, "days": iso(self.days), "staged": iso(self.staged),
                           "mode": self.mode, "info": self.info})

    @classmethod
    def from_json(cls, text: str) -> "Commit":
        x = json.loads(text)
        return cls(x["number"], [dt.date.fromisoformat(d) for d in x["days"]],
                   [dt.date.fromisoformat(d) for d in x["staged"]], x["mode"], x["info"])


class DayTable:
    def __init__(self, spark: SparkSession, path: str, parts: tuple[str, str, str]):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts
        self._jvm = spark._jvm
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- files ---------------------------------------------------------------------

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, name: str) -> list[str]:
        at = self._at(name)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def _write_text(self, name: str, text: str) -> None:
        out = self.fs.create(self._at(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def _read_text(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def folder(self, day: dt.date, below: str = "") -> str:
        y, m, d = self.parts
        return f"{below}{y}={day.year}/{m}={day.month}/{d}={day.day}"

    def _stage(self, number: int) -> str:
        return f"{META}/stage-{number:08d}/"

    # ---- state -----------------------------------------------------------------------

    def _last(self) -> tuple[Commit | None, bool]:
        """The latest commit, and whether it is published."""
        names = set(self._names(META))
        numbers = sorted(int(n.split("-")[1]) for n in names if n.startswith("commit-") and n[7:].isdigit())
        if not numbers:
            return None, True
        n = numbers[-1]
        return Commit.from_json(self._read_text(f"{META}/commit-{n:08d}")), f"done-{n:08d}" in names

    def pending(self) -> Commit | None:
        """A commit that counts but is not published yet."""
        last, done = self._last()
        return None if done else last

    def info(self) -> dict:
        """What the last commit left (its writer hands the whole state on)."""
        last, _ = self._last()
        return last.info if last else {}

    # ---- writing -----------------------------------------------------------------------

    def replace(self, df: DataFrame | None, days: list[dt.date], mode: str = "overwrite", info: dict | None = None) -> list[dt.date]:
        """Replace ``days`` by the rows of ``df`` (None: by nothing); returns the days that have rows.

        Days without rows lose their old ones, except when appending. Rows of other days are an error.
        """
        self.recover()
        last, _ = self._last()
        number = last.number + 1 if last else 1
        self.fs.delete(self._at(self._stage(number)), True)  # of a run that failed before its commit
        staged = []
        if df is not None:
            df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*self.parts).parquet(
                f"{self.path}/{self._stage(number)}")
            staged = self._staged_days(number)
        foreign = sorted(set(staged) - set(days))
        if foreign:
            raise ValueError(f"rows of days that are not replaced: {[d.isoformat() for d in foreign]}")
        commit = Commit(number, sorted(days), staged, mode, info if info is not None else (last.info if last else {}))
        draft = f"{META}/draft-{uuid.uuid4().hex}"
        self._write_text(draft, commit.to_json())
        if not self.fs.rename(self._at(draft), self._at(f"{META}/commit-{number:08d}")):
            raise RuntimeError(f"commit {number} of {self.path} exists already: another writer is at work")
        self._publish(commit)
        return staged

    def _staged_days(self, number: int) -> list[dt.date]:
        """The days that have a folder in a stage: one listing per month met."""
        out, root = [], self._stage(number)
        y, m, d = self.parts
        value = lambda name: int(name.split("=")[1])
        if any("__HIVE_DEFAULT_PARTITION__" in n for n in self._names(root)):
            raise ValueError("rows without a day")
        for yy in (n for n in self._names(root) if n.startswith(f"{y}=")):
            for mm in self._names(f"{root}{yy}"):
                out += [dt.date(value(yy), value(mm), value(dd)) for dd in self._names(f"{root}{yy}/{mm}")]
        return sorted(out)

    def _publish_day(self, commit: Commit, day: dt.date) -> None:
        """Repeatable: what was done before a failure is found done."""
        ours, theirs = self._at(self.folder(day, self._stage(commit.number))), self._at(self.folder(day))
        if commit.mode == "append":
            if self.fs.exists(ours):
                self.fs.mkdirs(theirs)
                for name in [s.getPath().getName() for s in self.fs.listStatus(ours)]:
                    self.fs.rename(self._jvm.org.apache.hadoop.fs.Path(ours, name),
                                   self._jvm.org.apache.hadoop.fs.Path(theirs, name))
                self.fs.delete(ours, True)
            return
        if day not in commit.staged:
            self.fs.delete(theirs, True)
        elif self.fs.exists(ours):
            self.fs.delete(theirs, True)
            self.fs.mkdirs(theirs.getParent())
            if not self.fs.rename(ours, theirs):
                raise RuntimeError(f"could not publish {ours}")

    def _publish(self, commit: Commit) -> None:
        for day in commit.days:
            self._publish_day(commit, day)
        self._write_text(f"{META}/done-{commit.number:08d}", "")
        self.fs.delete(self._at(self._stage(commit.number)), True)
        for n in self._names(META):
            kind, _, number = n.partition("-")
            if kind in ("commit", "done") and number.isdigit() and int(number) < commit.number:
                self.fs.delete(self._at(f"{META}/{n}"), False)

    def recover(self) -> bool:
        """Finish a commit whose publication was cut off; whether there was one."""
        commit = self.pending()
        if commit is not None:
            self._publish(commit)
        return commit is not None

    # ---- reading -------------------------------------------------------------------------

    def days(self, among: list[dt.date]) -> list[dt.date]:
        """Those of ``among`` that have published rows."""
        return [d for d in among if self.fs.exists(self._at(self.folder(d)))]

    def read(self, schema: T.StructType, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """Rows of the days in [start, end], each day from where its last commit has them."""
        within = lambda df: df if start is None and end is None else df.where(
            partition_day_predicate(start or dt.date.min, end or dt.date.max, *self.parts))
        reader = self.spark.read.schema(schema)
        commit = self.pending()
        if commit is None:
            return within(reader.parquet(self.path)).select(*schema.fieldNames())
        left = [d for d in commit.staged if self.fs.exists(self._at(self.folder(d, self._stage(commit.number))))]
        published = within(reader.parquet(self.path))
        if commit.mode == "overwrite":
            hidden = [day_number(d) for d in commit.days if d in left or d not in commit.staged]
            y, m, d = (F.col(c).cast("int") for c in self.parts)
            published = published.where(~(y * 10_000 + m * 100 + d).isin(hidden)) if hidden else published
        rows = published.select(*schema.fieldNames())
        if left:
            staged = within(reader.parquet(f"{self.path}/{self._stage(commit.number)}"))
            rows = rows.unionByName(staged.select(*schema.fieldNames()))
        return rows
