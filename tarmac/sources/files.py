"""Readers for raw and cleaned CSV files (O2, O3).

Raw files may hold any number of columns in any order; the twelve needed
ones are found by header name, per file.  The header lines are read on
executors, one short read per file, into a table of layouts (file, width,
positions of the twelve columns).  One scan of all lines is joined to that
table by file; each line is parsed with its file's width and the twelve
fields are taken by position, so values never swap between files of different
layouts.  The driver receives the distinct widths only.
"""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.functions.cleaning import clean_values, drop_header_rows, once
from tarmac.schema import (
    CLEAN_COLUMNS,
    CLEAN_SCHEMA,
    CORRUPT_COLUMN,
    CSV_OPTIONS,
    FROM_CSV_OPTIONS,
    MISSING_MARKER,
)
from tarmac.session import scratch_path


class MissingColumnError(ValueError):
    pass


def read_clean(spark: SparkSession, path: str, strict: bool = False, glob: str | None = None) -> DataFrame:
    """O3: cleaned CSV rows (header per file, ``_`` = missing), header rows dropped.

    Each file's header must name the twelve columns in order
    (``enforceSchema=false``); a file with another header fails, naming the
    file, instead of reading values into the wrong columns.
    ``strict=True`` fails on a row with the wrong field count (FAILFAST);
    otherwise such a row keeps its text in ``_corrupt_record``.  ``glob``
    leaves out files of other names (``*.csv``).
    """
    r = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", MISSING_MARKER)
        .option("recursiveFileLookup", True)
        .options(**CSV_OPTIONS)
    )
    if strict:
        r = r.schema(CLEAN_SCHEMA).option("mode", "FAILFAST")
    else:
        schema = StructType(CLEAN_SCHEMA.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
        r = r.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.csv(path)
    cleaned = df.select(
        *[F.col(c) for c in CLEAN_COLUMNS], *([] if strict else [F.col(CORRUPT_COLUMN)])
    )
    return drop_header_rows(cleaned)


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        p = path[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return p
    if path.startswith("/"):
        return path
    return None


def read_first_line(path: str) -> str:
    """Header record of a file (local path or any filesystem pyarrow can open); quoted fields may hold line breaks."""
    local = _local(path)
    if local is not None:
        fh = open(local, "rb")
    else:
        from pyarrow import fs as pafs

        filesystem, p = pafs.FileSystem.from_uri(path)
        fh = filesystem.open_input_stream(p)
    with fh:
        parts, quotes, at = [], 0, -1
        while at < 0:
            chunk = fh.read(65536)
            if not chunk:
                break
            at = chunk.find(b"\n")
            while at >= 0 and (quotes + chunk.count(b'"', 0, at)) % 2:  # a line break inside quotes
                at = chunk.find(b"\n", at + 1)
            quotes += chunk.count(b'"')
            parts.append(chunk if at < 0 else chunk[:at])
    return b"".join(parts).rstrip(b"\r").decode("utf-8").lstrip("﻿")


def _listing(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """path and source_file (as ``_metadata.file_path`` gives it) of every file; contents are not loaded."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return files.select("path", F.col("_metadata.file_path").alias("source_file"))


def _headers_udf(batches):
    for pdf in batches:
        yield pd.DataFrame({
            "path": pdf["path"],
            "header": [read_first_line(p) for p in pdf["path"]],
        })


def file_headers(spark: SparkSession, path: str, glob: str = "*.csv") -> dict[str, list[str]]:
    """Header line -> files with it, for files that are read whole (``multi_line``).

    The driver receives the few distinct layouts plus (path, layout id)
    pairs, the same file list Spark's own file index holds.
    """
    heads = _listing(spark, path, glob).select("path").mapInPandas(_headers_udf, "path string, header string").cache()
    try:
        # layouts are compared as text and numbered, so a path travels with a number
        layouts = [r["header"] for r in heads.select("header").distinct().collect()]
        number = F.create_map(*[x for i, h in enumerate(layouts) for x in (F.lit(h), F.lit(i))]) if layouts else None
        groups: dict[str, list[str]] = defaultdict(list)
        for r in heads.select("path", number[F.col("header")].alias("i")).collect() if layouts else []:
            groups[layouts[r["i"]]].append(r["path"])
    finally:
        heads.unpersist()
    return groups


def parse_header(line: str) -> list[str]:
    return next(csv.reader(io.StringIO(line))) if line else []


def column_positions(header: list[str], example: str) -> dict[str, int]:
    """First position of each needed column; a missing one is an error naming a file."""
    pos = {}
    for c in CLEAN_COLUMNS:
        if c not in header:
            raise MissingColumnError(f"column {c!r} missing from header of {example}")
        pos[c] = header.index(c)
    return pos


LAYOUT_SCHEMA = "source_file string, first_line string, width int, positions array<int>, missing string"


def _layouts_udf(batches):
    for pdf in batches:
        out = []
        for path, source in zip(pdf["path"], pdf["source_file"]):
            line = read_first_line(path)
            header, positions, missing = parse_header(line), None, None
            try:
                positions = list(column_positions(header, path).values())
            except MissingColumnError as e:
                missing = str(e)
            out.append((source, line.split("\n")[0].rstrip("\r"), len(header), positions, missing))
        yield pd.DataFrame(out, columns=["source_file", "first_line", "width", "positions", "missing"])


def file_layouts(spark: SparkSession, path: str, glob: str = "*.csv") -> tuple[DataFrame, list[int]]:
    """(source_file, first_line, width, positions of the twelve columns) of every file, and the distinct widths.

    The table is written once to shared scratch; a file without one of the columns is an error that names it.
    """
    at = scratch_path(spark, "layouts")
    _listing(spark, path, glob).mapInPandas(_layouts_udf, LAYOUT_SCHEMA).write.parquet(at)
    layouts = spark.read.schema(LAYOUT_SCHEMA).parquet(at)
    found = layouts.agg(F.min("missing").alias("missing"), F.sort_array(F.collect_set("width")).alias("widths")).first()
    if found["missing"] is not None:
        raise MissingColumnError(found["missing"])
    return layouts.drop("missing"), found["widths"]


def _fields(width: int, corrupt: bool) -> StructType:
    names = [f"c{i}" for i in range(width)] + [CORRUPT_COLUMN] * corrupt
    return StructType([StructField(c, StringType(), True) for c in names])


def _by_line(spark: SparkSession, path: str, strict: bool, glob: str) -> DataFrame:
    """One scan of all lines, joined to the files' layouts.

    Layouts are a row a file, broadcast only if Spark finds them small enough
    (else a sort-merge join, whose hot files are split as skewed partitions).
    A line is parsed once, with its file's width, so a wrong number of fields
    is found, whatever widths other files have.
    """
    layouts, widths = file_layouts(spark, path, glob)
    if not widths:
        return spark.createDataFrame([], RECORD_SCHEMA)
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path).select(
        "value", F.col("_metadata.file_path").alias("source_file"))
    # a line of blanks is no record; a file's first line is its header
    lines = (lines.filter(F.col("value").rlike(r"[^\x00-\x20]")).join(layouts, "source_file")
             .filter(F.col("value") != F.col("first_line")))
    options = {**FROM_CSV_OPTIONS, "mode": "FAILFAST" if strict else "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    parsed = lines.select("source_file", "positions", *[
        F.when(F.col("width") == w, F.from_csv("value", _fields(w, not strict).simpleString(), options)).alias(f"w{w}") for w in widths])
    whole = [F.when(F.col(f"w{w}").isNotNull(), F.array(*[F.col(f"w{w}.c{i}") for i in range(w)])) for w in widths]
    record = F.lit(None).cast("string") if strict else F.coalesce(*[F.col(f"w{w}.{CORRUPT_COLUMN}") for w in widths])
    fields = parsed.select("source_file", "positions", F.coalesce(*whole).alias("fields"), record.alias("record"))
    return once(fields, *[F.get("fields", F.get("positions", F.lit(k))).alias(c) for k, c in enumerate(CLEAN_COLUMNS)],
                "source_file", "record")


RECORD_SCHEMA = StructType([*CLEAN_SCHEMA.fields, *(StructField(c, StringType()) for c in ("source_file", "record"))])


def records_by_layout(spark: SparkSession, groups: Iterable[tuple[str, str, list[str]]], strict: bool, multi_line: bool) -> DataFrame:
    """Records of files or folders grouped by header: (header, a name for errors, paths)."""
    out = spark.createDataFrame([], RECORD_SCHEMA)
    for n, (line, example, paths) in enumerate(groups):
        header = parse_header(line)
        pos = column_positions(header, example)
        # pruned columns would not be counted
        r = (spark.read.option("header", True).option("multiLine", multi_line).option("columnPruning", False)
             .option("mode", "FAILFAST" if strict else "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
             .schema(_fields(len(header), not strict)).options(**CSV_OPTIONS))
        record = F.lit(None).cast("string") if strict else F.col(CORRUPT_COLUMN)
        part = r.csv(paths).select(*[F.col(f"c{pos[c]}").alias(c) for c in CLEAN_COLUMNS],
                                   F.col("_metadata.file_path").alias("source_file"), record.alias("record"))
        out = out.unionByName(part) if n else part
    # a line of blanks is no record; Spark allows no query on the corrupt column alone, and this reads another
    return out.filter(F.col("record").isNull() | ((F.trim("record") != "") & (F.length(F.concat_ws("", CLEAN_COLUMNS[0])) >= 0)))


def _records(spark: SparkSession, path: str, strict: bool, glob: str, multi_line: bool) -> DataFrame:
    """Every record of the raw files: the twelve columns as text, source_file, and ``record`` (its text, if it is malformed)."""
    if not multi_line:
        return _by_line(spark, path, strict, glob)
    groups = sorted(file_headers(spark, path, glob).items())
    return records_by_layout(spark, [(line, files[0], sorted(files)) for line, files in groups], strict, True)


def _accepted(records: DataFrame, with_source: bool) -> DataFrame:
    rows = records.filter("record IS NULL").drop("record", *([] if with_source else ["source_file"]))
    return drop_header_rows(clean_values(rows, keep=["source_file"] if with_source else []))


def read_raw(spark: SparkSession, path: str, strict: bool = False,
             with_source: bool = False, glob: str = "*.csv", multi_line: bool = False) -> DataFrame:
    """O2 + O5-O7: raw CSV files with any column layout -> cleaned twelve-column rows.

    Blank lines are skipped.  A record with another number of fields than its
    file's header fails the job when ``strict``; otherwise it is left out
    (``ingest_raw`` returns those records, too).  ``multi_line`` allows line
    breaks inside quoted fields; such files are read whole by one task each,
    so it is off by default.
    """
    return _accepted(_records(spark, path, strict, glob, multi_line), with_source)


WRONG_COUNT = "wrong number of fields"


def ingest_raw(spark: SparkSession, path: str, strict: bool = False, with_source: bool = False, glob: str = "*.csv",
               multi_line: bool = False, staging: str | None = None) -> tuple[DataFrame, DataFrame]:
    """O2 + O11: (cleaned rows, rejects as source_file, record, reason) of one parse.

    The files are parsed once and the records written once to ``staging``
    (shared storage), told apart by whether they are malformed; both results
    read that table, and a lost executor never parses again.
    """
    return split_records(_records(spark, path, strict, glob, multi_line), with_source, staging)


def split_records(records: DataFrame, with_source: bool, staging: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, rejects) of records that are written once."""
    spark = records.sparkSession
    staging = staging or scratch_path(spark, "records")
    records = records.withColumn("rejected", F.col("record").isNotNull())
    records.write.mode("overwrite").partitionBy("rejected").parquet(staging)
    stored = spark.read.schema(records.schema).parquet(staging)
    rejects = stored.filter("rejected").select("source_file", "record", F.lit(WRONG_COUNT).alias("reason"))
    return _accepted(stored.filter("NOT rejected").drop("rejected"), with_source), rejects
