"""Batch jobs and the command line, end to end on files derived from the driver tables."""

import pyarrow.parquet  # noqa: F401

from conftest import SF_SMALL
from tarmac.__main__ import main
from tarmac.plans.jobs import RESULT_TABLES
from tarmac.sources.fixture import clean_flights
from tarmac.sources.publish_raw import write_raw_archives


def test_cleanup_then_results(spark, tmp):
    write_raw_archives(spark, SF_SMALL, f"{tmp}/zips", rows_per_archive=1000)
    open(f"{tmp}/zips/broken.zip", "wb").write(b"not a zip")
    assert main(["cleanup", f"{tmp}/zips", f"{tmp}/flights"]) == 0
    rej = spark.read.parquet(f"{tmp}/flights_rejects").collect()
    assert len(rej) == 1 and rej[0]["archive"].endswith("broken.zip")
    assert spark.read.parquet(f"{tmp}/flights").count() == clean_flights(spark, SF_SMALL).count()
    assert main(["results", f"{tmp}/flights", f"{tmp}/out", "--all-years"]) == 0
    for name in RESULT_TABLES:
        assert spark.read.parquet(f"{tmp}/out/{name}").count() > 0, name
    top = spark.read.parquet(f"{tmp}/out/airport_best_airlines")
    assert top.groupBy("apt").count().filter("count > 10").count() == 0


def test_cleanup_to_csv_then_publish_text(spark, tmp):
    write_raw_archives(spark, SF_SMALL, f"{tmp}/zips")
    assert main(["cleanup", f"{tmp}/zips", f"{tmp}/clean", "--csv"]) == 0
    assert main(["publish", f"{tmp}/clean", "--format", "text", "--path", f"{tmp}/topic"]) == 0
    lines = spark.read.text(f"{tmp}/topic")
    assert lines.count() == clean_flights(spark, SF_SMALL).count()
    assert lines.filter(lines.value.startswith("Year,")).count() == 0


HEADER = "Year,Month,DayofMonth,DayOfWeek,UniqueCarrier,Origin,Dest,CRSDepTime,DepDelay,ArrDelay,Cancelled,Diverted\n"


def test_results_from_cleaned_csv_equal_those_from_stored_flights(spark, tmp):
    from tarmac.functions.cleaning import typed_flights
    from tarmac.sinks.files import write_clean, write_flights

    clean = clean_flights(spark, SF_SMALL)
    write_clean(clean, f"{tmp}/clean")
    open(f"{tmp}/clean/notes.txt", "w").write("no flights\n")
    open(f"{tmp}/clean/short.csv", "w").write(HEADER + "2008,1,2\n")
    write_flights(typed_flights(clean), f"{tmp}/flights")
    assert main(["results", f"{tmp}/clean", f"{tmp}/a", "--all-years", "--csv"]) == 0
    assert main(["results", f"{tmp}/flights", f"{tmp}/b", "--all-years"]) == 0
    for name in RESULT_TABLES:
        a, b = spark.read.parquet(f"{tmp}/a/{name}"), spark.read.parquet(f"{tmp}/b/{name}")
        if name == "quality_report":
            assert a.first()["corrupt_rows"] == 1 and a.first()["num_rows"] == b.first()["num_rows"] + 1
        else:
            assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name


def test_cleanup_keeps_lineage_if_asked(spark, tmp):
    write_raw_archives(spark, SF_SMALL, f"{tmp}/zips", rows_per_archive=1000)
    assert main(["cleanup", f"{tmp}/zips", f"{tmp}/flights", "--lineage"]) == 0
    got = spark.read.parquet(f"{tmp}/flights")
    assert got.count() == clean_flights(spark, SF_SMALL).count()
    assert got.filter("archive LIKE '%.zip' AND member LIKE 'On_Time_%.csv'").count() == got.count()
    assert got.select("archive", "member").distinct().count() >= 4


def test_padded_carriers_and_airports_are_one_key(spark, tmp):
    import os

    from tarmac.operators.metrics import airport_popularity, carrier_arrival_delay

    os.makedirs(f"{tmp}/raw")
    rows = [f"2008,1,2,3,{c},{o},JFK,0900,5,{d},0,0\n" for c, o, d in [("AA ", "ORD", 4), ("AA", " ORD", 8), (" AA", "ORD ", 9)]]
    open(f"{tmp}/raw/a.csv", "w").write(HEADER + "".join(rows))
    assert main(["cleanup", f"{tmp}/raw", f"{tmp}/out", "--raw-csv", "--lineage"]) == 0
    flights = spark.read.parquet(f"{tmp}/out")
    assert [tuple(r) for r in carrier_arrival_delay(flights).collect()] == [("AA", 7.0, 3)]
    assert sorted(map(tuple, airport_popularity(flights).collect())) == [("JFK", 3), ("ORD", 3)]
    assert flights.filter("source_file LIKE '%a.csv'").count() == 3
