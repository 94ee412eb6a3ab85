"""Plan shape checks: no Python in the core, map-side top-k, pushed filters."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tarmac.operators.best import best_flights
from tarmac.sinks.files import write_flights
from tarmac.sources.fixture import flights

CORE = ["cleaned_flights", "airport_popularity", "carrier_arrival_delay", "airport_delay_by_carrier",
        "top_carriers", "top_destinations", "route_arrival_delay", "best_flights", "best_events",
        "quality_report", "popularity_rank_frequency", "top_airports", "bad_delay_count"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", CORE)
def test_no_python_evaluation(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_top_n_and_best_use_window_group_limit(spark):
    for name in ["top_carriers", "best_flights", "best_events"]:
        p = plan(E.queries()[name](spark, SF_SMALL))
        assert "WindowGroupLimit" in p, name


def test_top_airports_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(E.queries()["top_airports"](spark, SF_SMALL))


def test_year_filter_prunes_partitions_on_stored_flights(spark, tmp):
    write_flights(flights(spark, SF_SMALL), f"{tmp}/f")
    df = best_flights(spark.read.parquet(f"{tmp}/f"), year=1998)
    p = formatted(df)
    assert "PartitionFilters: [isnotnull(Year" in p and "(Year#" in p
    schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert schema == ("struct<Month:int,DayofMonth:int,UniqueCarrier:string,Origin:string,"
                      "Dest:string,CRSDepTime:string,ArrDelay:bigint>")
    assert "PushedFilters: [IsNotNull(ArrDelay)]" in p


def test_fact_to_orders_join_is_sort_merge(spark):
    from tarmac.sources.fixture import raw_flights

    p = plan(raw_flights(spark, SF_SMALL))
    assert "SortMergeJoin [l_orderkey" in p
    # the fact table itself is never the broadcast side
    assert "BroadcastExchange" not in p.split("SortMergeJoin [l_orderkey")[1].split("Sort [l_orderkey")[1].split("FileScan")[0]


def test_global_rank_is_right_when_exchanges_run_again(spark):
    """Ranges and offsets are read from one written table, so a shuffle that runs again cannot move their bounds apart."""
    from pyspark.sql import functions as F

    from tarmac.operators.ranking import global_row_number

    before = spark.conf.get("spark.sql.exchange.reuse", "true")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        n = 400_000
        df = spark.range(n).select((F.col("id") * 7919 % n).alias("v"), F.rand(3).alias("noise"))
        ranked = global_row_number(df, [F.col("v")])
        assert ranked.filter(F.col("rank") != F.col("v") + 1).count() == 0
        assert ranked.count() == n
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)


def test_flights_writer_partitions_by_year_and_keeps_rows(spark, tmp):
    import os

    df = flights(spark, SF_SMALL)
    write_flights(df, f"{tmp}/f")
    years = sorted(d for d in os.listdir(f"{tmp}/f") if d.startswith("Year="))
    assert len(years) == df.select("Year").distinct().count()
    assert spark.read.parquet(f"{tmp}/f").count() == df.count()
