"""End-to-end batch jobs: cleaning, and the result tables of every question.

``cleanup`` replaces the reference's archive cleaner; ``results`` replaces
its mapper/reducer pairs and writes the keyed tables they filled.  Each
result is its own Spark job over the stored flights, reading only the
columns it needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.cleaning import typed_flights
from tarmac.operators import best, metrics, quality, ranking
from tarmac.schema import CLEAN_COLUMNS, CORRUPT_COLUMN
from tarmac.session import scratch_path
from tarmac.sinks.files import write_clean, write_flights
from tarmac.sources.archives import read_archives
from tarmac.sources.files import ingest_raw, read_clean


def cleanup(spark: SparkSession, in_dir: str, out_dir: str, fmt: str = "parquet",
            source: str = "zip", lineage: bool = False) -> DataFrame:
    """Raw archives (or raw CSV files) -> cleaned rows at ``out_dir``; returns the rejects.

    ``fmt="csv"`` writes cleaned CSV (header, ``_`` for missing) as the
    reference did; ``fmt="parquet"`` writes typed flights partitioned by Year,
    which every later query reads far faster.  With ``lineage`` those rows
    also carry the archive and member (or the file) they come from.
    """
    if lineage and fmt == "csv":
        raise ValueError("cleaned CSV has twelve columns; lineage needs Parquet")
    if source == "zip":
        rows, rejects = read_archives(spark, in_dir, with_source=lineage)
    else:
        rows, wrong = ingest_raw(spark, in_dir, with_source=lineage)
        rejects = wrong.select(F.col("source_file").alias("archive"), F.lit(None).cast("string").alias("member"),
                               F.concat("reason", F.lit(": "), "record").alias("error"))
    if fmt == "csv":
        write_clean(rows, out_dir)
    else:
        write_flights(typed_flights(rows, keep=[c for c in rows.columns if c not in CLEAN_COLUMNS]), out_dir)
    return rejects


# Names of the result tables (and their keys).
RESULT_TABLES = {
    "airport_popularity": ["airport"],
    "airline_delays": ["carrier"],
    "airport_best_airlines": ["apt", "rank"],
    "airport_best_dest_airport": ["apt", "rank"],
    "src_dst_avg_delays": ["src", "dst"],
    "src_dst_best_flights_of_day": ["src", "dst", "date", "morning"],
    "popularity_rank_frequency": ["rank"],
    "quality_report": [],
}


def result_frames(flights: DataFrame, year: int | None = best.BEST_FLIGHT_YEAR,
                  n: int = ranking.TOP_N) -> dict[str, Callable[[], DataFrame]]:
    """How to make each result; some run a job of their own, so nothing is built before it is asked for."""
    return {
        "airport_popularity": lambda: metrics.airport_popularity(flights),
        "airline_delays": lambda: metrics.carrier_arrival_delay(flights),
        "airport_best_airlines": lambda: ranking.top_carriers(flights, n),
        "airport_best_dest_airport": lambda: ranking.top_destinations(flights, n),
        "src_dst_avg_delays": lambda: metrics.route_arrival_delay(flights),
        "src_dst_best_flights_of_day": lambda: best.best_flights(flights, year),
        "popularity_rank_frequency": lambda: ranking.popularity_rank_frequency(flights),
        "quality_report": lambda: quality.quality_report(flights),
    }


def results(spark: SparkSession, flights_path: str, out_dir: str,
            year: int | None = best.BEST_FLIGHT_YEAR, n: int = ranking.TOP_N,
            only: list[str] | None = None, source: str = "parquet") -> list[str]:
    """Write every question's table (or those of ``only``) as Parquet under ``out_dir/<table>``.

    ``source="csv"`` takes cleaned CSV files (``*.csv`` below the folder).
    They are parsed once, into typed rows in shared scratch that every
    question reads; rows with a wrong number of fields are counted in the
    quality report and are in no other table.
    """
    if source == "csv":
        stored = scratch_path(spark, "flights")
        write_flights(typed_flights(read_clean(spark, flights_path, glob="*.csv"), keep=[CORRUPT_COLUMN]), stored)
        flights_path = stored
    every = spark.read.parquet(flights_path)
    whole = every.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN) if CORRUPT_COLUMN in every.columns else every
    written = [name for name in RESULT_TABLES if not only or name in only]
    frames = {**result_frames(whole, year, n), "quality_report": lambda: quality.quality_report(every)}
    for name in written:
        frames[name]().write.mode("overwrite").parquet(f"{out_dir}/{name}")
    return written
