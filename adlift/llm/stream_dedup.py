"""Exact deduplication with keyed streaming state.

1. Every row gives its digest, stable id and content locator (the Parquet file that holds
   it and its row number there); these narrow rows land in the shared folder. Rows that are
   no plain scan of Parquet files have no such place and are first written to that folder.
2. A streaming aggregation keyed by digest reads them. Its state lives on disk
   (RocksDB state store, snapshots in the shared checkpoint folder), has no watermark
   and so never expires: per digest it retains the largest id, that row's locator and
   the number of rows. Counting is partial before the shuffle, so a digest that a
   third of all rows share reaches its state as one row per task. :class:`Deduplicator`
   keeps one checkpoint, so later batches meet the digests of earlier ones.
3. The state is read back with the ``statestore`` reader. Digests with two or more rows
   are hits: their members' full texts are fetched by locator and compared byte by byte.
   Rows whose bytes differ (a collision of the digest) are regrouped exactly by digest and
   text. The row that stays is the one the state's locator names.

Null text counts as empty, and empty texts are equal like any others. Of equal texts the
row with the largest id stays; null ids are smaller than any other. Rows repeated with
one id and text are one document: each counts in ``group_size``, and in :func:`judge`
all rows of the staying id are kept, while :func:`keep_one` returns just one of them (of
rows that tie, the last by file and row number).
An empty table gives an empty table; other columns are passed through by
:func:`keep_one` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlift.llm.bloom_urls import possible_hits, without_keys
from adlift.llm.common import save, shared_path, text_or_empty

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": PROVIDER,
    # One bound for all stores of an executor; what exceeds it goes to disk.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Otherwise every store, however small, preallocates 4 MB of disk for its manifest.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _is_scan(docs: DataFrame) -> bool:
    """Do the rows come straight from Parquet files, under whatever name?"""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() == "SubqueryAlias":
        plan = plan.child()
    if plan.nodeName() != "LogicalRelation":
        return False
    try:
        docs.select(*_locator(docs))
    except AnalysisException:  # files of another format number no rows
        return False
    return True


def addressed(docs: DataFrame) -> DataFrame:
    """``docs`` as a scan of Parquet files, where a file and a row number address each row.

    A join, a filter, rows in memory or another format are written to the shared folder once:
    through them a place would name no row, or several.
    """
    return docs if _is_scan(docs) else save(docs, "dedup-rows")


def _locator(source: DataFrame) -> list[Column]:
    at = source.metadataColumn("_metadata")
    return [at["file_path"].alias("file"), at["row_index"].alias("row")]


def _place() -> Column:
    """The locator as one key."""
    return F.concat("file", F.lit(":"), F.col("row").cast("string")).alias("key")


def _last() -> Column:
    """The row that stays: largest id, null ids before all others."""
    return F.max(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("order"), "doc_id", "file", "row"))


class Deduplicator:
    """Keyed state over any number of batches, in one checkpoint of the shared folder."""

    def __init__(self, spark: SparkSession, path: str | None = None, files_per_batch: int = 1000):
        self.spark = spark
        self.path = path or shared_path(spark, "dedup")
        self.files_per_batch = files_per_batch

    def land(self, docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
        """Append the digest, id and locator of every row; return the rows just landed."""
        source = addressed(docs)
        rows = source.select(F.col("doc_id").cast("long").alias("doc_id"), digest(text_or_empty()).alias("digest"),
                             *_locator(source))
        landed = save(rows, "dedup-digests")
        landed.write.mode("append").parquet(f"{self.path}/landing")
        return landed

    def advance(self) -> None:
        """Feed what has landed since the last call into the state."""
        conf = self.spark.conf
        before = {k: conf.get(k, None) for k in STATE_SETTINGS}
        for k, v in STATE_SETTINGS.items():
            conf.set(k, v)
        try:
            rows = (self.spark.readStream.schema("doc_id long, digest string, file string, row long")
                    .option("maxFilesPerTrigger", self.files_per_batch).parquet(f"{self.path}/landing"))
            state = rows.groupBy("digest").agg(_last().alias("stays"), F.count("*").alias("n"))
            query = (state.writeStream.outputMode("update").format("noop")
                     .option("checkpointLocation", f"{self.path}/state").trigger(availableNow=True).start())
            query.awaitTermination()
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)

    def index(self) -> DataFrame:
        """``digest, keep_id, file, row, n`` as the state holds them: the row that stays, and how many there are."""
        state = self.spark.read.format("statestore").load(f"{self.path}/state")
        kept = F.col("value").getField("max")
        return state.select("key.digest", kept["doc_id"].alias("keep_id"), kept["file"].alias("file"),
                            kept["row"].alias("row"), F.col("value").getField("count").alias("n"))


def _groups(source: DataFrame, digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """(rows ``doc_id, digest, file, row``, members of groups ``file, row, keep_id, stays, n`` with verified bytes).

    Members are the rows whose text another row has too; ``stays`` marks the one of each group that the
    state's locator names.
    """
    keyed = Deduplicator(source.sparkSession)
    landed = keyed.land(source, digest)
    keyed.advance()
    many = save(keyed.index().where("n > 1").select("digest", "keep_id", F.struct("file", "row").alias("kept"), "n"),
                "dedup-hits")
    stays = (F.struct("file", "row") == F.col("kept")).alias("stays")
    member = ["file", "row", "digest", "keep_id", stays, "n"]
    # Rows outside the groups do not move, and nothing after the join needs its order, so a large
    # group of copies is split there.
    found = possible_hits(landed.select("file", "row", "digest", F.col("digest").alias("key")),
                          many.select(F.col("digest").alias("key")))
    members = save(found.join(many, "digest").select(*member), "dedup-members")

    # Full bytes of the members only, by their places. A group's texts are equal if its least and
    # greatest are; the partial aggregate leaves two texts per group and task to shuffle. What the
    # filter passes beside the members has a digest of its own and so differs from nothing.
    full = source.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), *_locator(source))
    full = possible_hits(full.select("*", _place()), members.select(_place())).withColumn("digest", digest(F.col("text")))
    differ = full.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a != b").select("digest")
    collided = save(differ, "dedup-collisions")
    if collided.isEmpty():
        return landed, members
    # A digest shared by different texts: group its rows by their bytes instead.
    rows = full.join(collided, "digest").select("doc_id", "file", "row", "digest", "text")
    exact = rows.groupBy("digest", "text").agg(_last().alias("last"), F.count("*").alias("n")).select(
        "digest", "text", F.col("last.doc_id").alias("keep_id"), F.struct("last.file", "last.row").alias("kept"), "n")
    regrouped = rows.join(exact, ["digest", "text"]).select(*member)
    return landed, save(members.join(collided, "digest", "left_anti").select(*members.columns).unionByName(regrouped),
                        "dedup-members")


def judge(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` for every row of ``docs``."""
    plain = addressed(docs if _is_scan(docs) else docs.select("doc_id", "text"))
    landed, members = _groups(plain, digest)
    rows = landed.join(members.drop("digest"), ["file", "row"], "left")
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.select("doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                       F.col("doc_id").eqNullSafe(keep).alias("kept"), "digest")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every group of equal texts, with the columns of ``docs`` as they were."""
    source = addressed(docs)
    _, members = _groups(source, sha256)
    drop = members.where(~F.col("stays")).select(_place())
    rows = source.select(*_locator(source), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in"))
    rows = without_keys(rows.select(_place(), "_in"), drop)
    return rows.select(*[F.col(f"_in.`{c}`").alias(c) for c in docs.columns])
