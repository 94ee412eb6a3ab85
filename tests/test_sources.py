"""Raw CSV by header name, zipped archives, cleaned CSV, writers."""

import io
import os
import zipfile

import pytest

from tarmac.schema import CLEAN_COLUMNS
from tarmac.sinks.files import write_clean, write_flights
from tarmac.sources.archives import read_archives
from tarmac.sources.files import MissingColumnError, ingest_raw, read_clean, read_raw

EXTRA = ["FlightNum", "TailNum"]


def csv_text(cols, rows):
    lines = [",".join(cols)]
    for r in rows:
        lines.append(",".join(r.get(c, "") for c in cols))
    return "\n".join(lines) + "\n"


R1 = dict(Year="2008", Month="1", DayofMonth="2", DayOfWeek="3", UniqueCarrier="AA", Origin="ORD",
          Dest="LAX", CRSDepTime="905", DepDelay="-3.00", ArrDelay="7.00", Cancelled="0.00",
          Diverted="0.00", FlightNum="12", TailNum="N1")
R2 = dict(R1, UniqueCarrier="UA", ArrDelay="", Origin="SFO")


def test_read_raw_mixed_column_orders(spark, tmp):
    os.makedirs(f"{tmp}/a/b")
    order1 = EXTRA + CLEAN_COLUMNS
    order2 = list(reversed(CLEAN_COLUMNS)) + ["Year"]  # duplicate name: first match wins
    open(f"{tmp}/a/one.csv", "w").write(csv_text(order1, [R1]))
    open(f"{tmp}/a/b/two.csv", "w").write(csv_text(order2, [R2, dict(zip(order2, order2))]))
    rows = read_raw(spark, tmp, with_source=True).collect()
    got = sorted((r["UniqueCarrier"], r["Origin"], r["ArrDelay"], r["DepDelay"], r["CRSDepTime"]) for r in rows)
    assert got == [("AA", "ORD", "7", "-3", "905"), ("UA", "SFO", None, "-3", "905")]
    assert all(r["source_file"].endswith(".csv") for r in rows)


def test_read_raw_missing_column_names_file(spark, tmp):
    cols = [c for c in CLEAN_COLUMNS if c != "Dest"]
    open(f"{tmp}/nodest.csv", "w").write(csv_text(cols, [R1]))
    with pytest.raises(MissingColumnError, match="nodest.csv"):
        read_raw(spark, tmp)


def zip_bytes(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    return buf.getvalue()


def test_read_archives_nested_same_member_names_and_bad_archive(spark, tmp):
    os.makedirs(f"{tmp}/in/a")
    os.makedirs(f"{tmp}/in/b/c")
    open(f"{tmp}/in/a/x.zip", "wb").write(zip_bytes({"m.csv": csv_text(CLEAN_COLUMNS, [R1]), "notes.txt": "x"}))
    open(f"{tmp}/in/b/c/y.zip", "wb").write(zip_bytes({"m.csv": csv_text(EXTRA + CLEAN_COLUMNS, [R2, R1])}))
    open(f"{tmp}/in/b/broken.zip", "wb").write(b"not a zip at all")
    rows, rejects = read_archives(spark, f"{tmp}/in", staging=f"{tmp}/staging")
    got = sorted((os.path.basename(r["archive"]), r["member"], r["UniqueCarrier"], r["ArrDelay"]) for r in rows.collect())
    assert got == [("x.zip", "m.csv", "AA", "7"), ("y.zip", "m.csv", "AA", "7"), ("y.zip", "m.csv", "UA", None)]
    rej = rejects.collect()
    assert len(rej) == 1 and rej[0]["archive"].endswith("broken.zip")


def test_read_archives_quoted_line_break(spark, tmp):
    os.makedirs(f"{tmp}/in")
    text = ",".join(CLEAN_COLUMNS + ["Note"]) + "\n" + ",".join(R1[c] for c in CLEAN_COLUMNS) + ',"two\nlines"\n'
    open(f"{tmp}/in/q.zip", "wb").write(zip_bytes({"q.csv": text}))
    rows, _ = read_archives(spark, f"{tmp}/in", staging=f"{tmp}/staging")
    assert rows.count() == 1


def test_write_and_read_clean_roundtrip(spark, tmp):
    from conftest import SF_SMALL
    from tarmac.sources.fixture import clean_flights, flights

    clean = clean_flights(spark, SF_SMALL)
    write_clean(clean, f"{tmp}/clean")
    back = read_clean(spark, f"{tmp}/clean")
    assert back.filter("_corrupt_record is not null").count() == 0
    a = sorted(map(tuple, clean.collect()), key=str)
    b = sorted(map(tuple, back.drop("_corrupt_record").collect()), key=str)
    assert a == b
    write_flights(flights(spark, SF_SMALL), f"{tmp}/flights")
    assert spark.read.parquet(f"{tmp}/flights").count() == clean.count()


def test_read_clean_field_count_and_header_rows(spark, tmp):
    good = ",".join(R1[c] for c in CLEAN_COLUMNS)
    text = ",".join(CLEAN_COLUMNS) + "\n" + good + "\n" + ",".join(CLEAN_COLUMNS) + "\n" + "1,2\n"
    open(f"{tmp}/c.csv", "w").write(text)
    df = read_clean(spark, tmp).cache()
    assert df.count() == 2
    assert df.filter("_corrupt_record is not null").count() == 1
    with pytest.raises(Exception):
        read_clean(spark, tmp, strict=True).collect()


def test_read_clean_rejects_file_with_other_header(spark, tmp):
    cols = list(reversed(CLEAN_COLUMNS))
    open(f"{tmp}/swapped.csv", "w").write(csv_text(cols, [R1]))
    with pytest.raises(Exception, match="swapped.csv"):
        read_clean(spark, tmp).collect()


def test_archive_member_missing_column_names_archive_and_member(spark, tmp):
    os.makedirs(f"{tmp}/in")
    cols = [c for c in CLEAN_COLUMNS if c != "Dest"]
    open(f"{tmp}/in/nodest.zip", "wb").write(zip_bytes({"month.csv": csv_text(cols, [R1])}))
    with pytest.raises(MissingColumnError, match="nodest.zip:month.csv"):
        read_archives(spark, f"{tmp}/in", staging=f"{tmp}/staging")


def test_read_raw_quoted_comma_stays_in_its_field(spark, tmp):
    cols = EXTRA + CLEAN_COLUMNS
    lines = [",".join(cols), ",".join('"N1, spare"' if c == "TailNum" else '"A,B"' if c == "UniqueCarrier"
                                      else R1.get(c, "") for c in cols)]
    open(f"{tmp}/q.csv", "w").write("\n".join(lines) + "\n")
    r = read_raw(spark, tmp).first()
    assert r["UniqueCarrier"] == "A,B" and r["Origin"] == "ORD" and r["ArrDelay"] == "7"


def test_topic_lines_quote_commas_and_round_trip(spark):
    from tarmac.functions.cleaning import typed_flights
    from tarmac.schema import CLEAN_SCHEMA
    from tarmac.sinks.files import to_topic_lines
    from tarmac.streaming.source import parse_lines

    row = tuple("A,B" if c == "UniqueCarrier" else None if c == "DepDelay" else R1[c].replace(".00", "")
                for c in CLEAN_COLUMNS)
    df = spark.createDataFrame([row], CLEAN_SCHEMA)
    line = to_topic_lines(df).first()["value"]
    assert '"A,B"' in line and ",_," in line
    back = parse_lines(to_topic_lines(df)).first()
    want = typed_flights(df).first()
    assert back == want and back["UniqueCarrier"] == "A,B" and back["DepDelay"] is None


AWKWARD = ['say "hi", ok', "ends in a backslash\\", '"', "", "a,b"]


def test_read_raw_doubled_quotes_backslashes_blank_lines_and_underscore(spark, tmp):
    cols = ["Remark"] + CLEAN_COLUMNS
    rows = [dict(R1, Remark=t, DepDelay="_") for t in AWKWARD]
    import csv
    import io

    out = io.StringIO()
    csv.writer(out, lineterminator="\n\n").writerows([cols] + [[r[c] for c in cols] for r in rows])
    open(f"{tmp}/q.csv", "w").write(out.getvalue())
    got = read_raw(spark, tmp).collect()
    assert len(got) == len(AWKWARD)
    assert all(r["Origin"] == "ORD" and r["ArrDelay"] == "7" and r["DepDelay"] is None for r in got)


def test_read_raw_wrong_field_count_is_a_reject_or_an_error(spark, tmp):
    good = csv_text(CLEAN_COLUMNS, [R1]).replace("\r", "")
    open(f"{tmp}/q.csv", "w").write(good + "1,2,3\n" + ",".join(["9"] * 14) + "\n")
    assert read_raw(spark, tmp).count() == 1
    assert sorted(r["record"] for r in ingest_raw(spark, tmp)[1].collect()) == ["1,2,3", ",".join(["9"] * 14)]
    with pytest.raises(Exception):
        read_raw(spark, tmp, strict=True).collect()


def test_header_longer_than_a_mebibyte_and_with_a_quoted_line_break(tmp):
    from tarmac.sources.files import parse_header, read_first_line

    long = ",".join(f"column_{i}" for i in range(120_000)) + ',"two\nlines",end'
    open(f"{tmp}/h.csv", "w").write(long + "\n1,2\n")
    got = read_first_line(f"{tmp}/h.csv")
    assert got == long and len(long) > 1 << 20 and parse_header(got)[-2:] == ["two\nlines", "end"]


def test_damaged_member_is_rejected_whole(spark, tmp):
    os.makedirs(f"{tmp}/in")
    good = zip_bytes({"a.csv": csv_text(CLEAN_COLUMNS, [R1] * 3)})
    bad = bytearray(zip_bytes({"b.csv": csv_text(CLEAN_COLUMNS, [dict(R1, ArrDelay=str(i)) for i in range(2000)])}))
    for k, at in enumerate(range(60, len(bad) // 2, 97)):
        damaged = bytearray(bad)
        damaged[at] ^= 0x5A
        open(f"{tmp}/in/bad{k}.zip", "wb").write(damaged)
    open(f"{tmp}/in/good.zip", "wb").write(good)
    rows, rejects = read_archives(spark, f"{tmp}/in", staging=f"{tmp}/staging")
    assert rows.count() == 3 and rejects.count() == k + 1


def test_unknown_scheme_raises_instead_of_rejecting():
    from tarmac.sources.archives import open_random_access

    with pytest.raises(Exception):
        open_random_access("nosuch://bucket/x.zip")


def test_topic_blank_and_short_lines_give_no_flight(spark):
    from tarmac.streaming.source import parse_lines

    good = ",".join(R1[c] for c in CLEAN_COLUMNS)
    lines = spark.createDataFrame([(x,) for x in [good, "", "  ", "1,2,3", good + ",x,y"]], "value string")
    assert parse_lines(lines).count() == 1


def test_ten_thousand_small_files_bring_no_path_to_the_driver(spark, tmp, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    layouts = [CLEAN_COLUMNS, EXTRA + CLEAN_COLUMNS, list(reversed(CLEAN_COLUMNS))]
    for k in range(10_000):
        if k % 1000 == 0:
            os.makedirs(f"{tmp}/in/{k // 1000}")
        with open(f"{tmp}/in/{k // 1000}/f {k}.csv", "w") as f:
            f.write(csv_text(layouts[k % 3], [dict(R1, ArrDelay=str(k))]))
    collected = []
    plain = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: collected.append(plain(df)) or collected[-1])
    df = read_raw(spark, f"{tmp}/in", with_source=True)
    assert sum(map(len, collected)) <= 1 and "f 1" not in str(collected)
    from pyspark.sql import functions as F

    got = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("ArrDelay").cast("long")).alias("s"),
                 F.count_distinct("source_file").alias("files"), F.min("Origin").alias("o"), F.max("Origin").alias("p")).first()
    assert tuple(got) == (10_000, 10_000 * 9_999 // 2, 10_000, "ORD", "ORD")


def test_record_of_another_files_width_is_a_reject_of_its_own(spark, tmp):
    narrow, wide = CLEAN_COLUMNS, EXTRA + CLEAN_COLUMNS
    line = lambda cols: ",".join(R1[c] for c in cols)
    open(f"{tmp}/n.csv", "w").write("﻿" + csv_text(narrow, [R1]).replace("\n", "\r\n") + line(wide) + "\r\n \t \r\n")
    open(f"{tmp}/w.csv", "w").write(csv_text(wide, [R1]) + line(narrow) + "\n")
    rows, rejects = ingest_raw(spark, tmp, with_source=True)
    assert sorted((os.path.basename(r["source_file"]), r["record"]) for r in rejects.collect()) == [("n.csv", line(wide)), ("w.csv", line(narrow))]
    assert [(r["Origin"], r["ArrDelay"]) for r in rows.collect()] == [("ORD", "7")] * 2


def test_layouts_too_large_to_broadcast_are_joined_by_sorting(spark, tmp):
    open(f"{tmp}/a.csv", "w").write(csv_text(CLEAN_COLUMNS, [R1]))
    open(f"{tmp}/b.csv", "w").write(csv_text(EXTRA + CLEAN_COLUMNS, [R2]))
    key = "spark.sql.autoBroadcastJoinThreshold"
    prev = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert sorted(r["UniqueCarrier"] for r in read_raw(spark, tmp).collect()) == ["AA", "UA"]
    finally:
        spark.conf.set(key, prev)
