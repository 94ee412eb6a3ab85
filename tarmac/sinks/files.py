"""Cleaned-record writers and the topic publisher."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.schema import CLEAN_COLUMNS, CSV_OPTIONS, MISSING_MARKER


def write_clean(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Cleaned rows as CSV with a header; missing written as ``_``; quoting on."""
    (
        df.select(*CLEAN_COLUMNS)
        .write.mode(mode)
        .option("header", True)
        .option("nullValue", MISSING_MARKER)
        .options(**CSV_OPTIONS)
        .csv(path)
    )


def write_flights(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Typed flights as Parquet partitioned by Year.

    Later queries prune columns from the Parquet footer and prune year
    directories for year filters (best flights).  Rows are rebalanced by
    Year, so files per year follow the data's size and not the number of
    tasks; AQE splits a large year over several tasks.
    """
    df.hint("rebalance", F.col("Year")).write.mode(mode).partitionBy("Year").parquet(path)


def to_topic_lines(df: DataFrame) -> DataFrame:
    """Cleaned rows as one CSV line each (``value``), missing as ``_``, no header."""
    return df.select(
        F.to_csv(F.struct(*CLEAN_COLUMNS), {"nullValue": MISSING_MARKER, **CSV_OPTIONS}).alias("value")
    )


def publish(df: DataFrame, fmt: str = "kafka", options: dict | None = None,
            path: str | None = None) -> None:
    """Each data row as one unkeyed message.

    ``fmt="kafka"`` needs the Kafka connector on the classpath and options
    such as ``kafka.bootstrap.servers``, ``topic`` and
    ``kafka.compression.type=gzip``; the connector waits for broker
    acknowledgements.  ``fmt="text"`` with ``path`` writes the same lines
    as files (used by the tests and the file-source replay).
    """
    w = to_topic_lines(df).write.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        w = w.mode("overwrite")
    w.save(path) if path is not None else w.save()
