"""Batch log, bad counts, rejects and snapshots: nothing is lost, counted twice or taken from an unfinished write."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac.__main__ import main
from tarmac.plans.jobs import results
from tarmac.sinks.files import publish, write_flights
from tarmac.sinks.tables import newest_snapshot, read_all, read_latest, read_snapshot, snapshot_batch, upsert_batch
from tarmac.sources.files import ingest_raw
from tarmac.sources.fixture import clean_flights, flights
from tarmac.sources.publish_raw import write_damaged_csv
from tarmac.streaming.jobs import stream_bad_delays, stream_ingest, stream_popularity
from tarmac.streaming.progress import observe_bad_delays
from tarmac.streaming.replay import logged, run_to_end
from tarmac.streaming.source import stream_clean, stream_lines


def test_batch_log_holds_more_batches_than_spark_remembers(spark, tmp):
    lines = clean_flights(spark, SF_SMALL).limit(1100)
    publish(lines.repartition(110), fmt="text", path=f"{tmp}/in")
    src = observe_bad_delays(stream_clean(spark, "text", {"maxFilesPerTrigger": "1"}, f"{tmp}/in"))
    log = logged(spark, stream_popularity(src), f"{tmp}/t", f"{tmp}/c", f"{tmp}/log", "many-batches", every=30).collect()
    assert sorted(r["batch_id"] for r in log) == list(range(110))
    assert sum(r["input_rows"] for r in log) == 1100
    stored = spark.read.text(f"{tmp}/in").count()
    assert stored == 1100
    bad = flights(spark, SF_SMALL).filter("ArrDelay_bad").count()
    assert 0 <= sum(r["observed"]["bad_delays.bad_arr_delay"] for r in log) <= bad


def test_bad_delays_of_a_replayed_batch_count_once(spark, tmp):
    publish(clean_flights(spark, SF_SMALL).repartition(4), fmt="text", path=f"{tmp}/in")
    job = stream_bad_delays(stream_clean(spark, "text", {"maxFilesPerTrigger": "2"}, f"{tmp}/in"))
    run_to_end(job, f"{tmp}/t", f"{tmp}/c")
    want = flights(spark, SF_SMALL).filter("ArrDelay_bad").count()
    total = lambda: read_all(spark, f"{tmp}/t", job.output_schema()).agg(F.sum("bad_arr_delay")).first()[0]
    assert total() == want > 0
    again = read_all(spark, f"{tmp}/t", job.output_schema()).filter("batch_id = 1").drop("batch_id").collect()
    upsert_batch(spark.createDataFrame(again, job.output_schema()), 1, f"{tmp}/t")
    assert total() == want
    # data without a marker: a batch cut short
    spark.createDataFrame(again, job.output_schema()).write.parquet(f"{tmp}/t/batch_id=7")
    assert total() == want
    assert read_all(spark, f"{tmp}/none", job.output_schema()).count() == 0


def test_stream_ingest_keeps_every_line(spark, tmp):
    good = "2008,1,2,3,AA,ORD,JFK,0900,5,7,0,0"
    lines = [good, "", "   ", good + ",x", "2008,1", "Year" + good[4:], 'say "hi"', "_,_,_,_,_,_,_,_,_,_,_,_"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp}/in")
    job = stream_ingest(stream_lines(spark, "text", None, f"{tmp}/in"))
    run_to_end(job, f"{tmp}/t", f"{tmp}/c")
    rejects = read_latest(spark, f"{tmp}/t/rejects").collect()
    assert sorted(r["record"] for r in rejects) == sorted([good + ",x", "2008,1", 'say "hi"'])
    assert {r["reason"] for r in rejects} == {"wrong number of fields"}
    rows = read_latest(spark, f"{tmp}/t/rows").collect()
    assert len(rows) == 2 and sorted(r["ArrDelay"] or 0 for r in rows) == [0, 7]


def test_raw_rejects_come_from_the_parse_that_gives_the_rows(spark, tmp):
    write_damaged_csv(spark, SF_SMALL, f"{tmp}/raw", files=3)
    rows, rejects = ingest_raw(spark, f"{tmp}/raw", glob="*.txt", staging=f"{tmp}/staged")
    for df in (rows, rejects):
        assert "staged" in df.inputFiles()[0]  # both read the written parse
    clean = clean_flights(spark, SF_SMALL)
    damaged = "Cancelled = '1' OR Diverted = '1'"
    assert rejects.count() == clean.filter(damaged).count() > 0
    assert rejects.filter("trim(record) = ''").count() == 0
    want = clean.filter(f"NOT ({damaged})")
    assert rows.exceptAll(want).count() == 0 and want.exceptAll(rows).count() == 0


def test_cleanup_of_raw_csv_lists_its_rejects(spark, tmp):
    os.makedirs(f"{tmp}/raw")
    header = "Year,Month,DayofMonth,DayOfWeek,UniqueCarrier,Origin,Dest,CRSDepTime,DepDelay,ArrDelay,Cancelled,Diverted"
    with open(f"{tmp}/raw/a.csv", "w") as f:
        f.write(header + "\n2008,1,2,3,AA,ORD,JFK,0900,5,7,0,0\n   \n2008,1,2\n\n")
    assert main(["cleanup", f"{tmp}/raw", f"{tmp}/out", "--raw-csv"]) == 0
    rejects = spark.read.parquet(f"{tmp}/out_rejects").collect()
    assert [(r["archive"].rsplit("/", 1)[1], r["error"]) for r in rejects] == [("a.csv", "wrong number of fields: 2008,1,2")]
    assert spark.read.parquet(f"{tmp}/out").count() == 1


def test_snapshot_reader_ignores_unfinished_ones(spark, tmp):
    df = spark.createDataFrame([("ORD", 3), (None, 1)], "airport string, num_flights long")
    assert newest_snapshot(spark, f"{tmp}/s") is None and read_snapshot(spark, f"{tmp}/s", df.schema).count() == 0
    for batch in (2, 9, 10):
        snapshot_batch(df.withColumn("num_flights", F.col("num_flights") + batch), batch, f"{tmp}/s")
    os.remove(f"{tmp}/s/batch_id=10/_SUCCESS")
    assert newest_snapshot(spark, f"{tmp}/s") == 9
    assert sorted(map(tuple, read_snapshot(spark, f"{tmp}/s", df.schema).collect()), key=str) == [("ORD", 12), (None, 10)]


def test_results_builds_only_what_is_asked_for(spark, tmp, monkeypatch):
    from tarmac.operators import ranking

    write_flights(flights(spark, SF_SMALL), f"{tmp}/f")
    monkeypatch.setattr(ranking, "popularity_rank_frequency", lambda *_: 1 / 0)  # runs a job when built
    assert results(spark, f"{tmp}/f", f"{tmp}/out", only=["airline_delays"]) == ["airline_delays"]
    assert os.listdir(f"{tmp}/out") == ["airline_delays"]
