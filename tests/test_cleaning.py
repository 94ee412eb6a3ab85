"""Hand-made edge rows (FIXTURES §5) through cleaning and typing."""

from pyspark.sql import functions as F

from tarmac.functions.cleaning import clean_values, drop_header_rows, typed_flights
from tarmac.functions.flight import dep_hour, flight_date
from tarmac.operators.metrics import airport_popularity, bad_delay_count, carrier_arrival_delay
from tarmac.operators.quality import quality_report
from tarmac.schema import CLEAN_COLUMNS, CLEAN_SCHEMA


def raw(spark, rows):
    """rows: list of dicts with some of the twelve columns (rest blank)."""
    full = [tuple(r.get(c, "") for c in CLEAN_COLUMNS) for r in rows]
    return spark.createDataFrame(full, CLEAN_SCHEMA)


BASE = dict(Year="2008", Month="1", DayofMonth="3", DayOfWeek="4", UniqueCarrier="AA",
            Origin="ORD", Dest="LAX", CRSDepTime="0900", DepDelay="1", ArrDelay="2",
            Cancelled="0.00", Diverted="0.00")


def row(**kw):
    r = dict(BASE)
    r.update(kw)
    return r


def typed(spark, rows):
    return typed_flights(clean_values(raw(spark, rows)))


def test_delay_parsing(spark):
    cases = ["-5.00", "5.5", ".00", "", " 5 ", "+5", "-5", "bad", "1_000", "5L", "99999999999"]
    df = typed(spark, [row(ArrDelay=c) for c in cases]).select("ArrDelay", "ArrDelay_bad")
    got = [(r[0], r[1]) for r in df.collect()]
    assert got == [
        (-5, False), (None, True), (None, False), (None, False), (5, False), (5, False),
        (-5, False), (None, True), (None, True), (None, True), (99999999999, False),
    ]


def test_zero_cents_stripped_from_all_fields(spark):
    df = clean_values(raw(spark, [row(Cancelled="1.00", Month="3.00")])).first()
    assert df["Cancelled"] == "1" and df["Month"] == "3"


def test_only_missing_key_has_no_row_and_bad_counted(spark):
    rows = [row(UniqueCarrier="AA", ArrDelay="10"), row(UniqueCarrier="BB", ArrDelay=""),
            row(UniqueCarrier="AA", ArrDelay="4.5"), row(UniqueCarrier="AA", ArrDelay="-4")]
    t = typed(spark, rows)
    res = {r["carrier"]: (r["avg_delay"], r["num_flights"]) for r in carrier_arrival_delay(t).collect()}
    assert res == {"AA": (3.0, 2)}
    assert bad_delay_count(t).first()["bad_delays"] == 1


def test_cancelled_counts_in_popularity_and_null_airport_group(spark):
    rows = [row(Cancelled="1.00", DepDelay="", ArrDelay=""), row(Origin=""), row()]
    pop = {r["airport"]: r["num_flights"] for r in airport_popularity(typed(spark, rows)).collect()}
    assert pop == {"ORD": 2, "LAX": 3, None: 1}
    assert sum(pop.values()) == 2 * len(rows)


def test_header_rows_dropped(spark):
    hdr = dict(zip(CLEAN_COLUMNS, CLEAN_COLUMNS))
    df = drop_header_rows(clean_values(raw(spark, [hdr, row(), row(Year="")])))
    assert df.count() == 2


def test_half_day_and_date(spark):
    times = ["1159", "1200", "0000", "900", "", "ab"]
    df = typed(spark, [row(CRSDepTime=t) for t in times]).select(dep_hour().alias("h"))
    assert [r["h"] for r in df.collect()] == [11, 12, 0, 9, None, None]
    d = typed(spark, [row(Month="2", DayofMonth="31"), row(Month="2", DayofMonth="28")])
    got = [r[0] for r in d.select(flight_date()).collect()]
    assert got[0] is None and str(got[1]) == "2008-02-28"


def test_quality_report_counts(spark):
    rows = [row(), row(ArrDelay="bad"), row(ArrDelay=""), row(Origin=""), row(CRSDepTime=""),
            row(Month="2", DayofMonth="31"), row(DepDelay="x")]
    q = quality_report(typed(spark, rows)).first().asDict()
    assert q["num_rows"] == 7
    assert q["bad_arr_delay"] == 1 and q["missing_arr_delay"] == 1
    assert q["missing_origin"] == 1 and q["bad_dep_time"] == 1 and q["bad_date"] == 1
    assert q["bad_dep_delay"] == 1


def test_quality_strict_raises(spark):
    import pytest

    from tarmac.operators.quality import DataQualityError

    with pytest.raises(DataQualityError):
        quality_report(typed(spark, [row(ArrDelay="bad")]), strict=True)
    quality_report(typed(spark, [row()]), strict=True)


def test_empty_input(spark):
    t = typed(spark, [])
    assert airport_popularity(t).count() == 0
    assert carrier_arrival_delay(t).count() == 0
    assert t.select(F.count("*")).first()[0] == 0


def test_parse_delay_text_columns(spark):
    from tarmac.functions.cleaning import parse_delay

    df = parse_delay(spark.createDataFrame([(" 7",), ("x",), (None,)], "ArrDelay string"), "ArrDelay")
    assert [(r["ArrDelay_value"], r["ArrDelay_bad"]) for r in df.collect()] == [(7, False), (None, True), (None, False)]


def test_flight_date_matches_string_parse_on_grid(spark):
    years = [1900, 1999, 2000, 2004, 2008, 2100, 0]
    grid = [(y, m, d) for y in years for m in range(0, 14) for d in range(0, 33)] + [(None, 1, 1)]
    df = spark.createDataFrame(grid, "Year int, Month int, DayofMonth int")
    ref = F.try_to_date(F.concat_ws("-", F.lpad(F.col("Year").cast("string"), 4, "0"),
                                    F.col("Month").cast("string"), F.col("DayofMonth").cast("string")),
                        "yyyy-M-d")
    # Year 0 is outside the calendar (DateType starts at 0001): always null.
    assert df.filter((F.col("Year") == 0) & flight_date().isNotNull()).count() == 0
    rest = df.filter(F.col("Year").isNull() | (F.col("Year") != 0))
    assert rest.filter(~flight_date().eqNullSafe(ref)).count() == 0
    assert df.filter(flight_date().isNotNull()).count() == 6 * 365 + 3  # leap: 2000, 2004, 2008


def test_every_operator_on_empty_input(spark):
    from tarmac.operators import best, metrics, ranking

    t = typed(spark, [])
    empties = [
        metrics.airport_popularity(t), metrics.carrier_arrival_delay(t), metrics.route_arrival_delay(t),
        metrics.airport_delay_by(t, "UniqueCarrier", "airline"), ranking.top_carriers(t),
        ranking.top_destinations(t), ranking.popularity_ranked(t), ranking.popularity_ranked(t, n=10),
        ranking.popularity_rank_frequency(t), ranking.rank_frequency_loglog(t),
        best.best_flights(t, 2008), best.best_flights(t, None),
    ]
    assert [df.count() for df in empties] == [0] * len(empties)
    q = quality_report(t).first().asDict()
    assert q["num_rows"] == 0 and all(v == 0 for v in q.values())
    assert bad_delay_count(t).first()["bad_delays"] == 0


def test_project_morning_date_route_helpers(spark):
    from tarmac.functions.cleaning import project_clean
    from tarmac.functions.flight import route_key, with_flight_date, with_morning

    wide = raw(spark, [row(CRSDepTime="1130"), row(CRSDepTime="1300", Month="2", DayofMonth="30")])
    wide = wide.withColumn("TailNum", F.lit("N1")).select("TailNum", *reversed(CLEAN_COLUMNS))
    assert project_clean(wide).columns == CLEAN_COLUMNS
    t = with_flight_date(with_morning(typed(spark, [row(CRSDepTime="1130"),
                                                   row(CRSDepTime="1300", Month="2", DayofMonth="30")])))
    got = [(r["morning"], None if r["date"] is None else str(r["date"])) for r in t.collect()]
    assert got == [(True, "2008-01-03"), (False, None)]
    assert [r[0] for r in t.select(route_key()).collect()] == ["ORD_LAX", "ORD_LAX"]


def test_quality_report_counts_corrupt_rows_from_read_clean(spark, tmp):
    from tarmac.sources.files import read_clean

    good = ",".join(BASE[c] for c in CLEAN_COLUMNS)
    open(f"{tmp}/c.csv", "w").write(",".join(CLEAN_COLUMNS) + "\n" + good + "\n1,2\n")
    df = read_clean(spark, tmp).cache()
    q = quality_report(typed_flights(clean_values(df, keep=["_corrupt_record"]), keep=["_corrupt_record"])).first()
    assert q["num_rows"] == 2 and q["corrupt_rows"] == 1


def test_delay_parsing_is_strict_with_ansi_off(spark):
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = typed(spark, [row(ArrDelay=c) for c in ["5.5", "5.00", "+5", "x"]]).select("ArrDelay", "ArrDelay_bad")
        assert [(r[0], r[1]) for r in df.collect()] == [(None, True), (5, False), (5, False), (None, True)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
