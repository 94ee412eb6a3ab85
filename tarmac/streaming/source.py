"""Stream scan of cleaned CSV lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.cleaning import clean_values, drop_header_rows, typed_flights
from tarmac.schema import CLEAN_COLUMNS, CLEAN_DDL, CLEAN_SCHEMA, CORRUPT_COLUMN, CSV_OPTIONS, FROM_CSV_OPTIONS, MISSING_MARKER
from tarmac.sources.files import WRONG_COUNT


def parse_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """(record: the line, r: its fields and, if they are not twelve, the corrupt column); blank lines are no records."""
    text = F.col(value).cast("string")
    return lines.filter(F.trim(text) != "").select(
        text.alias("record"),
        # exploded, so that no later filter parses the line again (as ``functions.cleaning.once``)
        F.explode(F.array(F.from_csv(text, f"{CLEAN_DDL}, `{CORRUPT_COLUMN}` STRING",
                                     {"nullValue": MISSING_MARKER, "columnNameOfCorruptRecord": CORRUPT_COLUMN,
                                      **FROM_CSV_OPTIONS}))).alias("r"))


def lean_records(records: DataFrame) -> DataFrame:
    """The records without the text of the well-formed ones, which ``accepted`` and ``rejected`` do not read."""
    return records.select(F.when(F.col(f"r.{CORRUPT_COLUMN}").isNotNull(), F.col("record")).alias("record"), "r")


def accepted(records: DataFrame) -> DataFrame:
    """Typed flights of the well-formed records, header rows dropped."""
    rec = records.filter(F.col(f"r.{CORRUPT_COLUMN}").isNull()).select(*[F.col(f"r.{c}").alias(c) for c in CLEAN_COLUMNS])
    return typed_flights(clean_values(drop_header_rows(rec)))


def rejected(records: DataFrame) -> DataFrame:
    """(record, reason) of the lines that have not twelve fields."""
    return records.filter(F.col(f"r.{CORRUPT_COLUMN}").isNotNull()).select("record", F.lit(WRONG_COUNT).alias("reason"))


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """CSV text lines -> typed flights; all in the JVM.

    Blank lines and lines without exactly twelve fields give no flight
    (``streaming.jobs.stream_ingest`` keeps those lines in a reject table).
    """
    return accepted(parse_records(lines, value))


def stream_lines(spark: SparkSession, fmt: str = "kafka", options: dict | None = None, path: str | None = None) -> DataFrame:
    """Streaming topic lines as ``value``, from a topic or text files (options as in ``stream_clean``)."""
    r = spark.readStream.format(fmt).options(**(options or {}))
    return (r.load(path) if path is not None else r.load()).select("value")


def stream_clean(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
                 path: str | None = None) -> DataFrame:
    """Streaming typed flights from a topic (``fmt="kafka"``) or from text files.

    Kafka: pass ``kafka.bootstrap.servers``, ``subscribe`` and
    ``startingOffsets=earliest``; offsets are tracked in the query checkpoint.
    Files: ``fmt="text"`` with ``path`` (one topic line per row), or
    ``fmt="csv"`` for a directory of cleaned CSV files with headers; both
    take e.g. ``maxFilesPerTrigger``.
    """
    r = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "csv":
        r = (r.schema(CLEAN_SCHEMA).option("header", True).option("enforceSchema", False)
             .option("nullValue", MISSING_MARKER).options(**CSV_OPTIONS))
        rec = r.load(path).select(*CLEAN_COLUMNS)
        return typed_flights(clean_values(drop_header_rows(rec)))
    raw = r.load(path) if path is not None else r.load()
    return parse_lines(raw)
