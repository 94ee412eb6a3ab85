"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables and derives flight records from
them (``tarmac.sources.fixture``), so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators import best, metrics, quality, ranking
from tarmac.plans.oracle import BEST_FLIGHTS_YEAR_FIXTURE
from tarmac.sources import fixture

Query = Callable[[SparkSession, str], DataFrame]


def _on_flights(op: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(fixture.flights(spark, sf_dir))

    run.__name__ = getattr(op, "__name__", "query")
    return run


def _raw_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: raw CSV in two column layouts, read back by header name and cleaned."""
    from tarmac.session import scratch_path
    from tarmac.sources.files import read_raw
    from tarmac.sources.publish_raw import write_raw_csv

    path = scratch_path(spark, "raw-csv")
    write_raw_csv(spark, sf_dir, path)
    return read_raw(spark, path)


def _archive_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: zipped CSV archives (two layouts per archive), unpacked and cleaned."""
    from tarmac.session import scratch_path
    from tarmac.sources.archives import read_archives
    from tarmac.sources.publish_raw import write_raw_archives

    path = scratch_path(spark, "archives")
    write_raw_archives(spark, sf_dir, path)
    rows, _ = read_archives(spark, path, staging=scratch_path(spark, "unpacked"), with_source=False)
    return rows


def _clean_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows written as cleaned CSV and read back."""
    from tarmac.session import scratch_path
    from tarmac.sinks.files import write_clean
    from tarmac.sources.files import read_clean

    path = scratch_path(spark, "clean-csv")
    write_clean(fixture.clean_flights(spark, sf_dir), path)
    return read_clean(spark, path, strict=True)


def _archive_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 with damaged members: they are rejected whole, every row of the good ones is there."""
    from pyspark.sql import functions as F

    from tarmac.session import scratch_path
    from tarmac.sources.archives import read_archives
    from tarmac.sources.publish_raw import write_raw_archives

    path = scratch_path(spark, "archives")
    write_raw_archives(spark, sf_dir, path, damage_b=True)
    rows, rejects = read_archives(spark, path, staging=scratch_path(spark, "unpacked"))
    good = rows.groupBy("member").agg(F.count(F.lit(1)).alias("num_rows")).withColumn("has_rejects", F.lit(False))
    bad = rejects.select("member", F.lit(0).cast("bigint").alias("num_rows"), F.lit(True).alias("has_rejects")).distinct()
    return good.unionByName(bad)


def _raw_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2 with records of a wrong length: rows and rejects of one parse, counted by layout."""
    from pyspark.sql import functions as F

    from tarmac.session import scratch_path
    from tarmac.sources.files import ingest_raw
    from tarmac.sources.publish_raw import write_damaged_csv

    path = scratch_path(spark, "damaged-csv")
    write_damaged_csv(spark, sf_dir, path)
    rows, rejects = ingest_raw(spark, path, with_source=True, glob="*.txt")
    layout = F.regexp_extract("source_file", r"/([ab])/file=", 1).alias("layout")
    count = F.count(F.lit(1)).alias("num_records")
    good = rows.groupBy(layout).agg(count).withColumn("reason", F.lit("accepted"))
    return good.unionByName(rejects.groupBy(layout, "reason").agg(count)).select("layout", "reason", "num_records")


def _replay(runner: str, pick: Callable = lambda df: df) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tarmac.streaming import replay

        return pick(getattr(replay, runner)(spark, sf_dir))

    run.__name__ = runner
    return run


def _stream(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tarmac.streaming import replay

        return replay.run_registered(spark, sf_dir, name)

    run.__name__ = name
    return run


QUERIES: dict[str, Query] = {
    "cleaned_flights": lambda spark, d: fixture.clean_flights(spark, d),
    "typed_flights": lambda spark, d: fixture.flights(spark, d),
    "raw_csv_ingest": _raw_csv_ingest,
    "archive_ingest": _archive_ingest,
    "airport_popularity": _on_flights(metrics.airport_popularity),
    "popularity_ranked": _on_flights(ranking.popularity_ranked),
    "top_airports": _on_flights(lambda f: ranking.popularity_ranked(f, n=10)),
    "popularity_rank_frequency": _on_flights(ranking.popularity_rank_frequency),
    "rank_frequency_loglog": _on_flights(lambda f: ranking.rank_frequency_loglog(f, digits=9)),
    "rank_frequency_fit": _on_flights(lambda f: ranking.rank_frequency_fit(f, digits=9)),
    "carrier_arrival_delay": _on_flights(metrics.carrier_arrival_delay),
    "bad_delay_count": _on_flights(metrics.bad_delay_count),
    "airport_delay_by_carrier": _on_flights(
        lambda f: metrics.airport_delay_by(f, "UniqueCarrier", "airline")
    ),
    "top_carriers": _on_flights(ranking.top_carriers),
    "top_destinations": _on_flights(ranking.top_destinations),
    "route_arrival_delay": _on_flights(metrics.route_arrival_delay),
    "best_flights": _on_flights(lambda f: best.best_flights(f, year=BEST_FLIGHTS_YEAR_FIXTURE)),
    "best_flights_all_years": _on_flights(lambda f: best.best_flights(f, year=None)),
    "clean_csv_roundtrip": _clean_csv_roundtrip,
    "archive_rejects": _archive_rejects,
    "raw_csv_rejects": _raw_csv_rejects,
    "best_events": lambda spark, d: best.best_events(fixture.events(spark, d)),
    "quality_report": _on_flights(quality.quality_report),
    "stream_popularity": _stream("stream_popularity"),
    "stream_carrier_delay": _stream("stream_carrier_delay"),
    "stream_top_carriers": _stream("stream_top_carriers"),
    "stream_top_destinations": _stream("stream_top_destinations"),
    "stream_route_delay": _stream("stream_route_delay"),
    "stream_best_flights": _stream("stream_best_flights"),
    "stream_restart": _replay("run_restart"),
    "stream_batch_sizes": _replay("run_batch_sizes"),
    "stream_bad_delays": _replay("run_bad_delays"),
    "stream_snapshot": _replay("run_snapshot"),
    "stream_clock": _replay("run_clock"),
    "stream_rejects": _replay("run_ingest", lambda tables: tables[1]),
    "stream_ingest": _replay("run_ingest", lambda tables: tables[0]),
}
