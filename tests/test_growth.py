"""Costs that must not grow faster than the rows: expressions worked out once, files and tasks by size, one join for all parts."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from tarmac.functions.cleaning import clean_value, once, valid_delay
from tarmac.schema import CLEAN_COLUMNS
from tarmac.sinks.tables import read_all, upsert_batch
from tarmac.sources import archives, publish_raw
from tarmac.sources.files import read_raw
from tarmac.sources.fixture import clean_flights
from tarmac.streaming import jobs, replay
from tarmac.streaming.source import accepted, parse_lines, parse_records, rejected, stream_lines


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_raw_line_is_parsed_once(spark, tmp):
    os.makedirs(f"{tmp}/raw")
    with open(f"{tmp}/raw/a.csv", "w") as f:
        f.write(",".join(CLEAN_COLUMNS) + "\n2008,1,2,3,AA,ORD,JFK,0900,5.00,7,0,0\n")
    rows = read_raw(spark, f"{tmp}/raw")
    assert optimized(rows).count("from_csv") == 1
    assert [tuple(r) for r in rows.collect()] == [("2008", "1", "2", "3", "AA", "ORD", "JFK", "0900", "5", "7", "0", "0")]


def test_a_topic_line_is_parsed_once(spark):
    lines = spark.createDataFrame([("2008,1,2,3,AA,ORD,JFK,0900,5,7,0,0",), ("2008,1",), (" ",)], "value string")
    rows = valid_delay(parse_lines(lines), "ArrDelay")
    assert optimized(rows).count("from_csv") == 1
    assert [r["ArrDelay"] for r in rows.collect()] == [7]


def test_best_flights_make_a_date_once(spark):
    p = optimized(E.queries()["best_flights_all_years"](spark, SF_SMALL))
    assert p.count("make_date") == 1


def test_once_keeps_rows_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (None, None), (None, None)], "x int, y string")
    got = once(df, "y", (F.col("x") + 1).alias("z"))
    assert got.columns == ["y", "z"]
    assert sorted(map(str, map(tuple, got.collect()))) == ["('a', 2)", "(None, None)", "(None, None)"]


def test_both_forms_of_clean_value_agree(spark):
    odd = ["", "_", ".00", "_.00", "5.00", "5.00.00", "-5.0", "a_", "__", " .00", ".00 ", "x\n.00", "_\n", "é.00", "00", None]
    df = spark.createDataFrame([(v,) for v in odd], "v string").select("v", clean_value("v").alias("a"), clean_value("v", True).alias("b"))
    for r in df.collect():
        assert r["a"] == r["b"], r
    assert {r["v"]: r["a"] for r in df.collect()}["_.00"] == "_"


def test_parts_of_a_feed_are_joined_once(spark, tmp):
    parts = replay._feed(spark, SF_SMALL, 3, f"{tmp}/feed")
    clean = clean_flights(spark, SF_SMALL)
    for k, part in enumerate(parts):
        assert "Join" not in optimized(part)
        want = clean.filter(F.col("DayofMonth").cast("int") % 3 == k)
        assert part.columns == CLEAN_COLUMNS
        assert part.exceptAll(want).count() == 0 and want.exceptAll(part).count() == 0


def test_published_files_follow_the_rows(spark, monkeypatch):
    cores = max(2, spark.sparkContext.defaultParallelism)
    assert replay.files_per_batch(spark, SF_SMALL) == cores
    monkeypatch.setattr(replay, "ROWS_PER_FILE", 50)
    rows = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert replay.files_per_batch(spark, SF_SMALL) == -(-rows // 150) > cores


def test_damaged_files_follow_the_rows(spark, tmp, monkeypatch):
    monkeypatch.setattr(publish_raw, "ROWS_PER_FILE", 200)
    publish_raw.write_damaged_csv(spark, SF_SMALL, f"{tmp}/raw")
    rows = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    for layout in ("a", "b"):
        assert len([d for d in os.listdir(f"{tmp}/raw/{layout}") if d.startswith("file=")]) == -(-rows // 200)


def test_many_members_share_tasks(spark, tmp, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(archives, "TASKS_PER_CORE", 1, raising=False)
    os.makedirs(f"{tmp}/in")
    for i in range(3 * cores):
        with zipfile.ZipFile(f"{tmp}/in/{i}.zip", "w") as z:
            z.writestr("a.csv", ",".join(CLEAN_COLUMNS) + f"\n{i},1,2,3,AA,ORD,JFK,0900,5,7,0,0\n")
    files, manifest = archives.stage_archives(spark, f"{tmp}/in", f"{tmp}/staged")
    assert manifest.count() == 3 * cores
    assert len([f for f in os.listdir(f"{tmp}/staged/_manifest") if f.startswith("part-")]) <= cores
    rows, rejects = archives.read_archives(spark, f"{tmp}/in", f"{tmp}/again")
    assert sorted(int(r["Year"]) for r in rows.collect()) == list(range(3 * cores)) and rejects.count() == 0


GOOD = "2008,1,2,3,AA,ORD,JFK,0900,5,7,0,0"


def ingested(spark, tmp, monkeypatch, table, fail=lambda batch_id: False):
    """Ingest three lines a batch, two batches; of the frames written to ``table``: plan, files read, texts kept of well-formed lines."""
    seen = []

    def look(df, batch_id, path):
        if path.endswith(f"/{table}"):
            files = df.inputFiles()
            kept = spark.read.parquet(*files).filter("record IS NOT NULL").count() if files else None
            seen.append((optimized(df), files, kept))
            if fail(batch_id):
                raise RuntimeError("a lost write")
        upsert_batch(df, batch_id, path)

    monkeypatch.setattr(jobs, "upsert_batch", look)
    for k in range(0 if os.path.exists(f"{tmp}/in") else 2):
        lines = [(f"{GOOD},{k}",), (GOOD.replace("AA", f"A{k}"),), ("  ",)]
        spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{tmp}/in/{k}")
    lines = stream_lines(spark, "text", {"maxFilesPerTrigger": "1"}, f"{tmp}/in/*")
    replay.run_to_end(jobs.stream_ingest(lines), f"{tmp}/t", f"{tmp}/c")
    return seen


def test_an_ingested_batch_is_read_from_storage_and_not_cached(spark, tmp, monkeypatch):
    seen = ingested(spark, tmp, monkeypatch, "rows")
    assert len(seen) == 2
    for plan, files, kept in seen:
        assert "InMemoryRelation" not in plan and "from_csv" not in plan
        assert files and all("/_parsed/batch_id=" in f for f in files)
        assert kept == 1
    rows = read_all(spark, f"{tmp}/t/rows", accepted(parse_records(spark.createDataFrame([], "value string"))).schema)
    assert sorted((r["UniqueCarrier"], r["ArrDelay"]) for r in rows.collect()) == [("A0", 7), ("A1", 7)]
    assert not os.listdir(f"{tmp}/t/_parsed")  # the parsed batches are gone


def test_rejects_of_a_batch_that_failed_and_ran_again_are_whole(spark, tmp, monkeypatch):
    with pytest.raises(Exception, match="a lost write"):
        ingested(spark, tmp, monkeypatch, "rejects", fail=lambda batch_id: batch_id == 1)
    assert not os.listdir(f"{tmp}/t/_parsed")  # of the failed batch neither
    os.makedirs(f"{tmp}/t/_parsed/batch_id=1")
    with open(f"{tmp}/t/_parsed/batch_id=1/part-0.parquet", "w") as f:
        f.write("left behind by a lost driver")
    seen = ingested(spark, tmp, monkeypatch, "rejects")
    assert seen and all("InMemoryRelation" not in plan and "/_parsed/batch_id=" in files[0] for plan, files, _ in seen)
    rejects = read_all(spark, f"{tmp}/t/rejects", rejected(parse_records(spark.createDataFrame([], "value string"))).schema)
    found = sorted((r["batch_id"], r["record"], r["reason"]) for r in rejects.collect())
    assert [(b, w) for b, _, w in found] == [(0, "wrong number of fields"), (1, "wrong number of fields")]
    assert sorted(r for _, r, _ in found) == [f"{GOOD},0", f"{GOOD},1"]
