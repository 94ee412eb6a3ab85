"""Keyed result tables written per micro-batch (O39) and text snapshots.

Layout of a table at ``path``::

    path/batch_id=N/part-*.parquet   rows written by batch N (overwritten on replay)
    path/_base/upto=B/               update mode: newest row per key of batches <= B
    path/_manifest                   finished batches and the base in force, one line of JSON

The manifest is replaced by one rename, after the data, so a reader sees a
table before or after a batch or compaction and never between.  It holds
ranges of batch ids, so it stays small, and a reader opens it and the folders
it names: no folder is listed to find out what is finished.

A replayed batch overwrites its own directory, so a retry leaves the same
rows (idempotent sink).  A batch cut short by a lost driver is in no manifest,
so it is invisible until it is re-run.  An update-mode table is compacted in
place into a base; readers then take the base plus the batches after it, so
read cost and storage stop growing with the age of the stream.  A replayed
batch at or below the base rewrites rows the base already holds, so it
changes nothing.  One stream writes a table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

BASE = "_base"
MANIFEST = "_manifest"


@dataclass
class Manifest:
    """What is finished: ``ranges`` of batch ids (both ends included, ascending) and the base, if there is one."""

    ranges: list[list[int]] = field(default_factory=list)
    base: int | None = None

    @property
    def newest(self) -> int | None:
        return self.ranges[-1][1] if self.ranges else None

    def add(self, batch_id: int) -> None:
        spans = sorted([*self.ranges, [batch_id, batch_id]])
        self.ranges = spans[:1]
        for lo, hi in spans[1:]:
            last = self.ranges[-1]
            if lo <= last[1] + 1:
                self.ranges[-1] = [last[0], max(last[1], hi)]
            else:
                self.ranges.append([lo, hi])

    def drop_below(self, batch_id: int) -> None:
        self.ranges = [[max(lo, batch_id), hi] for lo, hi in self.ranges if hi >= batch_id]

    def after(self, batch_id: int | None) -> list[int]:
        """Finished batch ids above ``batch_id`` (all, if None)."""
        return [b for lo, hi in self.ranges for b in range(lo, hi + 1) if batch_id is None or b > batch_id]


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """The manifest of the table at ``path``; an empty one if no batch is finished yet."""
    at, fs = _place(spark, f"{path}/{MANIFEST}")
    if not fs.exists(at):
        return Manifest()
    stream = fs.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def _write_manifest(spark: SparkSession, path: str, manifest: Manifest) -> None:
    at, fs = _place(spark, f"{path}/{MANIFEST}")
    new, _ = _place(spark, f"{path}/{MANIFEST}-{uuid.uuid4().hex}")
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(json.dumps({"ranges": manifest.ranges, "base": manifest.base}).encode()))
    finally:
        stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(new), fs.makeQualified(at), options)


def upsert_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch's rows under ``batch_id=N`` and enter it in the manifest."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    manifest = read_manifest(spark, path)
    manifest.add(batch_id)
    _write_manifest(spark, path, manifest)


@contextmanager
def staged(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """``df`` worked out once, written to ``path`` and read from there; the folder goes at the end.

    No executor holds the rows, in memory or on its own disk.  What a lost driver leaves behind is overwritten
    when its batch runs again.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        at, fs = _place(spark, path)
        fs.delete(at, True)


def committed_batches(spark: SparkSession, path: str) -> DataFrame:
    """Finished batch ids (one row per batch); empty when nothing was written yet."""
    ranges = read_manifest(spark, path).ranges
    df = spark.createDataFrame(ranges, "lo long, hi long")
    return df.select(F.explode(F.sequence("lo", "hi")).alias("batch_id"))


def read_latest(spark: SparkSession, path: str, keys: list[str] | None = None,
                schema: StructType | None = None) -> DataFrame:
    """Current table contents.

    ``keys=None`` (complete-mode tables): the rows of the highest finished
    batch; only that batch's folder is opened.
    With ``keys`` (update-mode tables): for each key, the row from the
    highest finished batch that wrote it.  That is a row_number per key,
    whose partial WindowGroupLimit runs before the shuffle; the base and the
    folders of the batches after it are opened.  A table with no finished
    batch reads as empty, with ``schema`` (required in that case).
    """
    manifest = read_manifest(spark, path)
    if manifest.newest is None:
        if schema is None:
            raise ValueError(f"no finished batch under {path} and no schema given")
        return spark.createDataFrame([], schema)
    if keys is None:
        return spark.read.parquet(f"{path}/batch_id={manifest.newest}")
    rows = None
    later = manifest.after(manifest.base)
    if later:
        rows = spark.read.option("basePath", path).parquet(*[f"{path}/batch_id={b}" for b in later])
        rows = rows.withColumn("batch_id", F.col("batch_id").cast("long"))
    if manifest.base is not None:
        base = spark.read.parquet(f"{path}/{BASE}/upto={manifest.base}").withColumn("batch_id", F.lit(manifest.base).cast("long"))
        rows = base if rows is None else rows.unionByName(base)
    w = Window.partitionBy(*keys).orderBy(F.col("batch_id").desc())
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "batch_id")


def read_all(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of every finished batch of an append-mode table, with ``batch_id``.

    All batches are read, so their folders are listed; the manifest's ranges prune the unfinished ones.
    """
    ranges = read_manifest(spark, path).ranges
    if not ranges:
        return spark.createDataFrame([], StructType([*schema.fields, StructField("batch_id", LongType())]))
    stored = spark.read.option("basePath", path).schema(schema).parquet(f"{path}/batch_id=*")
    done = F.lit(False)
    for lo, hi in ranges:
        done = done | F.col("batch_id").between(lo, hi)
    return stored.filter(done).withColumn("batch_id", F.col("batch_id").cast("long"))


def latest_base(spark: SparkSession, path: str) -> int | None:
    """The base in force of an update-mode table, or None."""
    return read_manifest(spark, path).base


def _sweep(spark: SparkSession, folder: str, name: str, below: int) -> None:
    """Delete ``folder/name=N`` for N under ``below``, those included that a lost driver left behind."""
    at, fs = _place(spark, f"{folder}/{name}=*")
    for status in fs.globStatus(at) or []:
        if int(status.getPath().getName().partition("=")[2]) < below:
            fs.delete(status.getPath(), True)


def compact_in_place(spark: SparkSession, path: str, keys: list[str],
                     drop_old: bool = True) -> int | None:
    """Fold an update-mode table into a base at its newest finished batch.

    Writes the newest row per key of everything finished so far to
    ``_base/upto=B`` and names it in the manifest; with ``drop_old`` the
    batches and bases below B are deleted afterwards (their rows live on in
    the base).  Returns B, or None when nothing was finished since the base.
    """
    manifest = read_manifest(spark, path)
    last = manifest.newest
    if last is None or last == manifest.base:
        return None
    read_latest(spark, path, keys).write.mode("overwrite").parquet(f"{path}/{BASE}/upto={last}")
    manifest.base = last
    if drop_old:
        manifest.drop_below(last)
    _write_manifest(spark, path, manifest)
    if drop_old:
        _sweep(spark, path, "batch_id", last)
        _sweep(spark, f"{path}/{BASE}", "upto", last)
    return last


def expire_batches(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Delete all but the newest ``keep`` (at least one) finished batches of a complete-mode table.

    A complete-mode batch holds the whole table, so older batches are
    redundant; without expiry a one-second trigger adds a full copy every
    second.  The manifest goes first, so readers never pick a batch that is
    being deleted.  Not for update-mode tables (compact those instead).
    """
    manifest = read_manifest(spark, path)
    ids = manifest.after(None)
    old, kept = ids[:-max(1, keep)], ids[-max(1, keep):]
    if old:
        manifest.drop_below(kept[0])
        _write_manifest(spark, path, manifest)
        _sweep(spark, path, "batch_id", kept[0])
    return old


def snapshot_batch(df: DataFrame, batch_id: int, prefix: str) -> None:
    """Full state of the batch as CSV text under ``prefix/batch_id=N``."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "_")
        .csv(f"{prefix}/batch_id={batch_id}")
    )


def newest_snapshot(spark: SparkSession, prefix: str) -> int | None:
    """Batch id of the newest whole snapshot; one cut short has no success marker."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{prefix}/batch_id=*/_SUCCESS")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    ids = [int(f.getPath().getParent().getName().partition("=")[2]) for f in found or []]
    return max(ids, default=None)


def read_snapshot(spark: SparkSession, prefix: str, schema: StructType) -> DataFrame:
    """The newest whole text snapshot below ``prefix``, empty if there is none."""
    last = newest_snapshot(spark, prefix)
    if last is None:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("header", True).option("nullValue", "_")
            .option("mode", "FAILFAST").csv(f"{prefix}/batch_id={last}"))
