"""Raw files derived from the driver tables, for the ingest queries and tests.

The raw fixture rows are written in two column layouts (plain CSV with a
header) or as zipped CSV members, so the header-by-name readers are
exercised on whole tables.  Rows go to a layout by a hash of their
content; every row is written exactly once.
"""

from __future__ import annotations

import csv
import io
import math
import os
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schema import CLEAN_COLUMNS, CSV_OPTIONS
from tarmac.session import scratch_path
from tarmac.sources.files import _local
from tarmac.sources.fixture import raw_flights

# Extra raw columns, as found in the monthly on-time files.
EXTRA_COLUMNS = ["FlightNum", "TailNum", "Remark"]

# Texts of the remark column, with the characters that CSV must quote.
REMARKS = ["", "on time, gate 4", 'say "hi", ok', "ends in a backslash\\", '"', "C:\\temp,x"]

#: rows of a damaged file of both layouts; a task sorts a few files, as several may hash to it
ROWS_PER_FILE = 500_000

LAYOUT_A = EXTRA_COLUMNS[:1] + CLEAN_COLUMNS + EXTRA_COLUMNS[1:]
LAYOUT_B = list(reversed(CLEAN_COLUMNS)) + EXTRA_COLUMNS


def _with_extras(df: DataFrame) -> DataFrame:
    return df.withColumn("FlightNum", F.lit("1")).withColumn("TailNum", F.lit("")).withColumn(
        "Remark", F.get(F.array(*[F.lit(r) for r in REMARKS]),
                        F.pmod(F.xxhash64(*CLEAN_COLUMNS, F.lit(7)), F.lit(len(REMARKS))).cast("int")))


def _layout_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("_layout_b", F.col("Month").cast("int") % 2 == 1)


def _rows_by_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows with extras, joined once and written to shared scratch by layout; rows without a month have none."""
    raw = _layout_flag(_with_extras(raw_flights(spark, sf_dir)))
    at = scratch_path(spark, "raw-rows")
    raw.write.partitionBy("_layout_b").parquet(at)
    return spark.read.schema(raw.schema).parquet(at)


def write_damaged_csv(spark: SparkSession, sf_dir: str, path: str, files: int | None = None) -> None:
    """As ``write_raw_csv``, as ``*.txt``: cancelled flights have a field too many, diverted ones a field too few.

    Every file begins with its header; blank lines stand between.
    """
    raw = _rows_by_layout(spark, sf_dir)
    n = files or max(2, spark.sparkContext.defaultParallelism, math.ceil(raw.count() / ROWS_PER_FILE))
    for sub, layout, flag in [("a", LAYOUT_A, False), ("b", LAYOUT_B, True)]:
        text = lambda names: F.to_csv(F.struct(*names), {"emptyValue": "", **CSV_OPTIONS})
        line = (F.when(F.col("Cancelled") == "1.00", F.concat(text(layout), F.lit(",more")))
                .when(F.col("Diverted") == "1.00", text(layout[:-1])).otherwise(text(layout)))
        rows = raw.filter(F.col("_layout_b") == F.lit(flag)).select(
            F.pmod(F.xxhash64(*CLEAN_COLUMNS), F.lit(n)).alias("file"), F.lit(2).alias("at"), line.alias("value"))
        starts = [(0, ",".join(layout)), (1, "   "), (3, "")]
        heads = spark.range(n).select(F.col("id").alias("file"), F.explode(F.array(*[
            F.struct(F.lit(at).alias("at"), F.lit(text).alias("value")) for at, text in starts])).alias("h")).select("file", "h.at", "h.value")
        (rows.unionByName(heads).repartition(n, "file").sortWithinPartitions("file", "at").select("file", "value")
         .write.mode("overwrite").partitionBy("file").text(f"{path}/{sub}"))


def write_raw_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Raw rows as header CSV in two column layouts under ``path/a`` and ``path/b``."""
    raw = _rows_by_layout(spark, sf_dir)
    for sub, layout, flag in [("a", LAYOUT_A, False), ("b", LAYOUT_B, True)]:
        (
            raw.filter(F.col("_layout_b") == F.lit(flag))
            .select(*layout)
            .write.mode("overwrite")
            .option("header", True)
            .option("emptyValue", "")
            .options(**CSV_OPTIONS)
            .csv(f"{path}/{sub}")
        )


def _open_write(path: str):
    local = _local(path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, "wb")
    from pyarrow import fs as pafs

    filesystem, p = pafs.FileSystem.from_uri(path)
    return filesystem.open_output_stream(p)


def _member_rows(part: pd.DataFrame, layout: list[str], text: io.StringIO):
    """The records of a member for a CSV writer on ``text``, with inner header rows; blank lines are written on the way."""
    remark = layout.index("Remark")
    yield layout
    for k, row in enumerate(part[layout].to_numpy().tolist()):
        if k % 5 == 0:
            row[remark] = "two\nlines"
        if k % 7 == 0:
            text.write("\n")
        if k % 50 == 0:
            yield layout  # an inner header row
        yield row


def _zip_writer(root: str, damage_b: bool = False):
    def write(batches):
        from pyspark import TaskContext

        # Names depend on the partition and batch number only, so a retried
        # task overwrites its own archives instead of adding copies.
        pid = TaskContext.get().partitionId()
        for i, pdf in enumerate(batches):
            if pdf.empty:
                continue
            name = f"{pid:05d}{i:05d}"
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED, compresslevel=1) as z:
                for member, layout, flag in [("a", LAYOUT_A, False), ("b", LAYOUT_B, True)]:
                    part = pdf[pdf["_layout_b"] == flag]
                    text = io.StringIO()
                    csv.writer(text, lineterminator="\n").writerows(_member_rows(part, layout, text))
                    z.writestr(f"On_Time_{member}.csv", text.getvalue())
            if damage_b:  # the last member's data changes, its checksum does not
                at = len(buf.getvalue()) - 1
                with zipfile.ZipFile(buf) as z:
                    info = z.infolist()[-1]
                    at = info.header_offset + 30 + len(info.filename) + info.compress_size // 2
                raw = bytearray(buf.getvalue())
                raw[at] ^= 0xFF
                buf = io.BytesIO(bytes(raw))
            with _open_write(f"{root}/p{pid % 16:02d}/{name}.zip") as fh:
                fh.write(buf.getvalue())
            yield pd.DataFrame({"archive": [name], "rows": [len(pdf)]})

    return write


def write_raw_archives(spark: SparkSession, sf_dir: str, path: str, rows_per_archive: int = 20000,
                       damage_b: bool = False) -> None:
    """Raw rows as zipped CSV archives, two members per archive, in nested folders.

    Each Arrow batch of a task becomes one archive, so archive size is
    bounded by ``rows_per_archive`` whatever the table size.  Members hold
    blank lines, inner header rows and quoted line breaks; with ``damage_b``
    the second member of every archive is damaged.
    """
    raw = _layout_flag(_with_extras(raw_flights(spark, sf_dir))).select(
        *LAYOUT_A, "_layout_b"
    )
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    prev = spark.conf.get(key, None)
    spark.conf.set(key, str(rows_per_archive))
    try:
        raw.mapInPandas(_zip_writer(path, damage_b), "archive string, rows long").write.format("noop").mode(
            "overwrite"
        ).save()
    finally:
        spark.conf.unset(key) if prev is None else spark.conf.set(key, prev)
