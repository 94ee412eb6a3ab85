"""Stream equals batch, restart continues totals, replay leaves the table unchanged."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac.operators.best import best_flights
from tarmac.operators.metrics import airport_popularity
from tarmac.sinks.files import publish
from tarmac.sinks.tables import compact_in_place, read_latest, snapshot_batch, upsert_batch
from tarmac.sources.fixture import clean_flights, flights
from tarmac.streaming.jobs import stream_best_flights, stream_popularity
from tarmac.streaming.progress import observe_bad_delays, progress
from tarmac.streaming.replay import run_to_end
from tarmac.streaming.source import stream_clean


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stream_popularity_three_batches_then_restart(spark, tmp):
    inp, out, ck = f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck"
    clean = clean_flights(spark, SF_SMALL)
    a, b = clean.randomSplit([0.6, 0.4], seed=1)
    publish(a.repartition(5), fmt="text", path=f"{inp}/part1")
    src = observe_bad_delays(stream_clean(spark, "text", {"maxFilesPerTrigger": "2"}, f"{inp}/*"))
    job = stream_popularity(src)
    q = job.start(out, ck, trigger={"availableNow": True})
    q.awaitTermination()
    prog = [p for p in progress(q) if p["numInputRows"]]
    assert len(prog) == 3
    bad = sum(p["observed"]["bad_delays"]["bad_arr_delay"] for p in prog)
    from tarmac.functions.cleaning import typed_flights as _tf
    assert bad == _tf(a).filter("ArrDelay_bad").count() > 0
    first = rows(read_latest(spark, out))
    assert first == rows(airport_popularity(flights(spark, SF_SMALL).limit(0).unionByName(
        __import__("tarmac.functions.cleaning", fromlist=["x"]).typed_flights(a))))
    # restart with more files: totals continue from the checkpoint
    publish(b.repartition(2), fmt="text", path=f"{inp}/part2")
    src2 = stream_clean(spark, "text", {"maxFilesPerTrigger": "2"}, f"{inp}/*")
    run_to_end(stream_popularity(src2), out, ck)
    assert rows(read_latest(spark, out)) == rows(airport_popularity(flights(spark, SF_SMALL)))


def test_replayed_batch_leaves_table_unchanged(spark, tmp):
    df = airport_popularity(flights(spark, SF_SMALL))
    upsert_batch(df, 0, f"{tmp}/t")
    before = rows(read_latest(spark, f"{tmp}/t"))
    upsert_batch(df, 0, f"{tmp}/t")
    assert rows(read_latest(spark, f"{tmp}/t")) == before
    assert len(before) == df.count()


def test_later_better_flight_replaces_and_compact(spark, tmp):
    keys = ["src", "dst", "date", "morning"]
    b0 = spark.createDataFrame([("A", "B", None, True, "AA", "0900", 10)],
                               "src string, dst string, date date, morning boolean, carrier string, dep_time string, arr_delay bigint")
    b1 = b0.withColumn("arr_delay", F.lit(3).cast("bigint")).withColumn("carrier", F.lit("ZZ"))
    upsert_batch(b0, 0, f"{tmp}/t")
    upsert_batch(b1, 1, f"{tmp}/t")
    got = read_latest(spark, f"{tmp}/t", keys).collect()
    assert [(r["carrier"], r["arr_delay"]) for r in got] == [("ZZ", 3)]
    before = rows(read_latest(spark, f"{tmp}/t", keys))
    compact_in_place(spark, f"{tmp}/t", keys)
    assert rows(read_latest(spark, f"{tmp}/t", keys)) == before


def test_uncommitted_batch_is_invisible(spark, tmp):
    df = airport_popularity(flights(spark, SF_SMALL))
    upsert_batch(df, 0, f"{tmp}/t")
    df.limit(1).write.mode("overwrite").parquet(f"{tmp}/t/batch_id=1")  # data without marker
    assert len(rows(read_latest(spark, f"{tmp}/t"))) == df.count()


def test_stream_best_flights_equals_batch_over_all_years(spark, tmp):
    inp = f"{tmp}/in"
    publish(clean_flights(spark, SF_SMALL).repartition(4), fmt="text", path=inp)
    src = stream_clean(spark, "text", {"maxFilesPerTrigger": "1"}, inp)
    job = stream_best_flights(src, year=None)
    run_to_end(job, f"{tmp}/out", f"{tmp}/ck")
    got = rows(read_latest(spark, f"{tmp}/out", job.keys).select(
        "src", "dst", "date", "morning", "carrier", "dep_time", "arr_delay"))
    assert got == rows(best_flights(flights(spark, SF_SMALL), year=None))


def test_snapshot_batch_text(spark, tmp):
    df = airport_popularity(flights(spark, SF_SMALL))
    snapshot_batch(df, 4, f"{tmp}/apt_counts")
    assert os.path.isdir(f"{tmp}/apt_counts/batch_id=4")
    back = spark.read.option("header", True).option("nullValue", "_").csv(f"{tmp}/apt_counts/batch_id=4")
    assert back.count() == df.count()


def test_empty_stream_gives_empty_table(spark, tmp):
    from tarmac.streaming.jobs import stream_top_carriers

    publish(clean_flights(spark, SF_SMALL).filter("false"), fmt="text", path=f"{tmp}/in")
    job = stream_top_carriers(stream_clean(spark, "text", {}, f"{tmp}/in"))
    run_to_end(job, f"{tmp}/out", f"{tmp}/ck")
    out = read_latest(spark, f"{tmp}/out", None, schema=job.output_schema())
    assert out.count() == 0
    assert out.columns == ["apt", "rank", "airline", "avg_delay", "num_flights"]


def test_complete_mode_retention_keeps_newest_batches(spark, tmp):
    from tarmac.sinks.tables import committed_batches

    inp = f"{tmp}/in"
    publish(clean_flights(spark, SF_SMALL).repartition(4), fmt="text", path=inp)
    job = stream_popularity(stream_clean(spark, "text", {"maxFilesPerTrigger": "1"}, inp))
    job.retain = 2
    run_to_end(job, f"{tmp}/out", f"{tmp}/ck")
    ids = sorted(r[0] for r in committed_batches(spark, f"{tmp}/out").collect())
    assert len(ids) == 2 and ids[-1] >= 3
    assert not os.path.exists(f"{tmp}/out/batch_id=0")
    assert rows(read_latest(spark, f"{tmp}/out")) == rows(airport_popularity(flights(spark, SF_SMALL)))


def test_stream_snapshots_each_batch(spark, tmp):
    inp = f"{tmp}/in"
    publish(clean_flights(spark, SF_SMALL).repartition(2), fmt="text", path=inp)
    job = stream_popularity(stream_clean(spark, "text", {"maxFilesPerTrigger": "1"}, inp))
    job.snapshot_prefix = f"{tmp}/apt_counts"
    run_to_end(job, f"{tmp}/out", f"{tmp}/ck")
    assert sorted(d for d in os.listdir(f"{tmp}/apt_counts") if d.startswith("batch_id=")) == ["batch_id=0", "batch_id=1"]


def test_kafka_style_binary_values_parse_like_text(spark):
    from pyspark.sql import functions as F

    from tarmac.sinks.files import to_topic_lines
    from tarmac.streaming.source import parse_lines

    clean = clean_flights(spark, SF_SMALL)
    lines = to_topic_lines(clean).select(F.col("value").cast("binary").alias("value"))
    header = spark.createDataFrame([(bytearray(b"Year,Month,DayofMonth,DayOfWeek,UniqueCarrier,Origin,Dest,"
                                               b"CRSDepTime,DepDelay,ArrDelay,Cancelled,Diverted"),)], "value binary")
    parsed = parse_lines(lines.unionByName(header))
    assert rows(parsed) == rows(flights(spark, SF_SMALL))


def test_stream_from_cleaned_csv_directory(spark, tmp):
    from tarmac.sinks.files import write_clean

    write_clean(clean_flights(spark, SF_SMALL).repartition(3), f"{tmp}/clean")
    src = stream_clean(spark, "csv", {"maxFilesPerTrigger": "1"}, f"{tmp}/clean")
    run_to_end(stream_popularity(src), f"{tmp}/out", f"{tmp}/ck")
    assert rows(read_latest(spark, f"{tmp}/out")) == rows(airport_popularity(flights(spark, SF_SMALL)))


def test_read_latest_of_table_without_batches(spark, tmp):
    import pytest

    from tarmac.streaming.jobs import stream_route_delay

    job = stream_route_delay(stream_clean(spark, "text", {}, SF_SMALL))
    out = read_latest(spark, f"{tmp}/never_written", job.keys, schema=job.output_schema())
    assert out.count() == 0 and out.columns == ["src", "dst", "avg_delay", "num_flights"]
    with pytest.raises(ValueError):
        read_latest(spark, f"{tmp}/never_written")


def test_update_mode_compaction_in_place_keeps_answers(spark, tmp):
    from tarmac.sinks.tables import compact_in_place, latest_base

    inp = f"{tmp}/in"
    publish(clean_flights(spark, SF_SMALL).repartition(6), fmt="text", path=inp)
    job = stream_best_flights(stream_clean(spark, "text", {"maxFilesPerTrigger": "1"}, inp), year=None)
    job.compact_every = 2
    run_to_end(job, f"{tmp}/out", f"{tmp}/ck")
    assert latest_base(spark, f"{tmp}/out") is not None
    expected = rows(best_flights(flights(spark, SF_SMALL), year=None))
    got = rows(read_latest(spark, f"{tmp}/out", job.keys).select(
        "src", "dst", "date", "morning", "carrier", "dep_time", "arr_delay"))
    assert got == expected
    # old batches are gone, and compacting again at the same point is a no-op
    kept = [d for d in os.listdir(f"{tmp}/out") if d.startswith("batch_id=")]
    assert len(kept) < 6
    compact_in_place(spark, f"{tmp}/out", job.keys)
    assert rows(read_latest(spark, f"{tmp}/out", job.keys).select(
        "src", "dst", "date", "morning", "carrier", "dep_time", "arr_delay")) == expected


def test_replayed_batch_below_base_changes_nothing(spark, tmp):
    from tarmac.sinks.tables import compact_in_place

    keys = ["src", "dst", "date", "morning"]
    schema = "src string, dst string, date date, morning boolean, carrier string, dep_time string, arr_delay bigint"
    b0 = spark.createDataFrame([("A", "B", None, True, "AA", "0900", 10), ("C", "D", None, True, "CC", "1000", 7)], schema)
    b1 = spark.createDataFrame([("A", "B", None, True, "ZZ", "0800", 3)], schema)
    upsert_batch(b0, 0, f"{tmp}/t")
    upsert_batch(b1, 1, f"{tmp}/t")
    before = rows(read_latest(spark, f"{tmp}/t", keys))
    assert compact_in_place(spark, f"{tmp}/t", keys) == 1
    upsert_batch(b1, 1, f"{tmp}/t")  # replay of the last batch after compaction
    assert rows(read_latest(spark, f"{tmp}/t", keys)) == before
    assert len(before) == 2


def test_manifest_names_what_is_finished_and_readers_list_no_other_folder(spark, tmp):
    from tarmac.sinks.tables import Manifest, _write_manifest, read_manifest

    m = Manifest()
    for b in [3, 0, 1, 9, 2, 1]:
        m.add(b)
    assert m.ranges == [[0, 3], [9, 9]] and m.newest == 9 and m.after(2) == [3, 9]
    m.drop_below(2)
    assert m.ranges == [[2, 3], [9, 9]]

    schema = "k string, v long"
    upsert_batch(spark.createDataFrame([("a", 1), ("b", 1)], schema), 10_000, f"{tmp}/t")
    _write_manifest(spark, f"{tmp}/t", Manifest([[0, 10_000]]))  # ten thousand batches; only the newest has a folder
    assert rows(read_latest(spark, f"{tmp}/t")) == rows(spark.createDataFrame([("a", 1), ("b", 1)], schema))
    assert os.path.getsize(f"{tmp}/t/_manifest") < 100
    _write_manifest(spark, f"{tmp}/t", Manifest([[0, 10_000]], base=9_999))  # update mode: the base and one batch
    spark.createDataFrame([("b", 0), ("c", 0)], schema).write.parquet(f"{tmp}/t/_base/upto=9999")
    assert sorted(map(tuple, read_latest(spark, f"{tmp}/t", ["k"]).collect())) == [("a", 1), ("b", 1), ("c", 0)]
    assert compact_in_place(spark, f"{tmp}/t", ["k"]) == 10_000
    assert read_manifest(spark, f"{tmp}/t") == Manifest([[10_000, 10_000]], base=10_000)
    assert sorted(os.listdir(f"{tmp}/t/_base"))[-1] == "upto=10000" and len(os.listdir(f"{tmp}/t/_base")) == 1
    assert len(read_latest(spark, f"{tmp}/t", ["k"]).collect()) == 3


def test_folder_that_no_manifest_names_is_not_read_and_is_swept(spark, tmp):
    from tarmac.sinks.tables import expire_batches, read_all

    df = spark.createDataFrame([("a", 1)], "k string, v long")
    for b in range(4):
        upsert_batch(df.withColumn("v", df.v + b), b, f"{tmp}/t")
    df.write.parquet(f"{tmp}/t/batch_id=7")  # a driver lost before the manifest
    assert read_latest(spark, f"{tmp}/t").first()["v"] == 4
    assert sorted(r["batch_id"] for r in read_all(spark, f"{tmp}/t", df.schema).collect()) == [0, 1, 2, 3]
    assert expire_batches(spark, f"{tmp}/t", keep=2) == [0, 1]
    assert sorted(d for d in os.listdir(f"{tmp}/t") if d.startswith("batch_id=")) == ["batch_id=2", "batch_id=3", "batch_id=7"]
    assert read_latest(spark, f"{tmp}/t").first()["v"] == 4
