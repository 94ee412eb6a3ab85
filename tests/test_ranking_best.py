"""Ranking and best-row semantics, and invariants against brute force."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.operators.best import best_flights, best_row
from tarmac.operators.metrics import airport_delay_by
from tarmac.operators.ranking import global_row_number, top_n_per_airport
from test_cleaning import row, typed


def test_rank_ties_by_name_more_and_fewer_than_ten(spark):
    rows = []
    # airport A: 12 carriers, C00 and C01 tie on mean 5
    for i in range(12):
        rows.append(row(Origin="A", UniqueCarrier=f"C{i:02d}", DepDelay=str(5 if i < 2 else 10 + i)))
    # airport B: 3 carriers
    for i in range(3):
        rows.append(row(Origin="B", UniqueCarrier=f"D{i}", DepDelay=str(3 - i)))
    out = top_n_per_airport(typed(spark, rows), "UniqueCarrier", "airline").collect()
    a = sorted((r["rank"], r["airline"]) for r in out if r["apt"] == "A")
    b = sorted((r["rank"], r["airline"]) for r in out if r["apt"] == "B")
    assert len(a) == 10 and a[0] == (1, "C00") and a[1] == (2, "C01")
    assert b == [(1, "D2"), (2, "D1"), (3, "D0")]


def test_top_n_of_all_equals_aggregate(spark):
    rows = [row(Origin=random.choice("XYZ"), UniqueCarrier=random.choice("PQRST"),
                DepDelay=str(random.randint(-20, 60))) for _ in range(300)]
    t = typed(spark, rows)
    full = top_n_per_airport(t, "UniqueCarrier", "airline", n=1000)
    agg = airport_delay_by(t, "UniqueCarrier", "airline")
    assert full.count() == agg.count()


def test_global_row_number_matches_single_partition_window(spark):
    random.seed(7)
    data = [(f"k{i}", random.randint(0, 30)) for i in range(500)]
    df = spark.createDataFrame(data, "k string, v int").repartition(13)
    order = [F.col("v").desc(), F.col("k").asc()]
    got = {r["k"]: r["rank"] for r in global_row_number(df, order, num_partitions=7).collect()}
    ref = {r["k"]: r["rank"] for r in df.withColumn("rank", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == ref


def test_best_flight_tie_takes_earlier_departure_and_year_filter(spark):
    rows = [
        row(CRSDepTime="0930", ArrDelay="5", UniqueCarrier="BB"),
        row(CRSDepTime="0815", ArrDelay="5", UniqueCarrier="CC"),
        row(CRSDepTime="1000", ArrDelay="9", UniqueCarrier="AA"),
        row(CRSDepTime="1300", ArrDelay="1", UniqueCarrier="AA"),   # afternoon group
        row(Year="2007", CRSDepTime="0700", ArrDelay="-50"),       # other year
        row(CRSDepTime="", ArrDelay="-60"),                        # bad time
        row(Month="2", DayofMonth="31", ArrDelay="-70"),           # invalid date
    ]
    out = {(r["morning"]): (r["carrier"], r["dep_time"], r["arr_delay"])
           for r in best_flights(typed(spark, rows), year=2008).collect()}
    assert out == {True: ("CC", "0815", 5), False: ("AA", "1300", 1)}


def test_best_row_equals_group_minimum(spark):
    random.seed(3)
    data = [(random.randint(0, 9), random.randint(0, 1000), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k int, v int, id int").repartition(9)
    got = {r["k"]: (r["v"], r["id"]) for r in best_row(df, ["k"], [F.col("v"), F.col("id")]).collect()}
    ref = {}
    for k, v, i in data:
        if k not in ref or (v, i) < ref[k]:
            ref[k] = (v, i)
    assert got == ref


def test_results_independent_of_partitioning(spark):
    random.seed(11)
    rows = [row(Origin=random.choice("XYZ"), Dest=random.choice("XYZ"), UniqueCarrier=random.choice("PQ"),
                ArrDelay=str(random.randint(-9, 9)), CRSDepTime=f"{random.randint(0, 23):02d}00")
            for _ in range(200)]
    t = typed(spark, rows)
    a = sorted(map(tuple, best_flights(t.repartition(1), 2008).collect()))
    b = sorted(map(tuple, best_flights(t.repartition(17), 2008).collect()))
    assert a == b


def test_hot_key_holding_most_rows(spark):
    """One airport / route / key with well over a third of all rows: same answers as brute force."""
    random.seed(5)
    rows = []
    for i in range(3000):
        hot = i % 5 != 0  # 80 % of rows on one route
        rows.append(row(Origin="HOT" if hot else random.choice("ABC"), Dest="DST" if hot else random.choice("ABC"),
                        UniqueCarrier=random.choice(["AA", "BB", "CC", "DD"]), DepDelay=str(random.randint(-30, 90)),
                        ArrDelay=str(random.randint(-30, 90)), CRSDepTime=f"{random.randint(0, 23):02d}{random.randint(0, 59):02d}"))
    t = typed(spark, rows).repartition(16)
    from tarmac.operators.metrics import airport_popularity, route_arrival_delay

    pop = {r["airport"]: r["num_flights"] for r in airport_popularity(t).collect()}
    assert pop["HOT"] == sum(1 for r in rows if r["Origin"] == "HOT")
    assert sum(pop.values()) == 2 * len(rows)
    routes = {(r["src"], r["dst"]): (r["avg_delay"], r["num_flights"]) for r in route_arrival_delay(t).collect()}
    hot = [int(r["ArrDelay"]) for r in rows if r["Origin"] == "HOT"]
    assert routes[("HOT", "DST")] == (sum(hot) / len(hot), len(hot))
    best = {(r["src"], r["morning"]): (r["arr_delay"], r["dep_time"])
            for r in best_flights(t, 2008).filter("src = 'HOT'").collect()}
    for morning in (True, False):
        cand = [(int(r["ArrDelay"]), r["CRSDepTime"]) for r in rows
                if r["Origin"] == "HOT" and (int(r["CRSDepTime"][:2]) < 12) == morning]
        assert best[("HOT", morning)] == min(cand)


def test_global_rank_without_exchange_reuse(spark):
    from pyspark.sql import functions as F
    from tarmac.operators.ranking import global_row_number

    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        n = 400_000
        df = spark.range(n).select(((F.col("id") * 7919) % n).alias("v"))
        ranked = global_row_number(df, [F.col("v").asc()])
        assert ranked.filter(F.col("rank") != F.col("v") + 1).count() == 0 and ranked.count() == n
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_five_character_time_has_its_hour(spark):
    from tarmac.functions.flight import dep_hour, padded_dep_time

    df = spark.createDataFrame([("09:05",), ("905",), ("1430",), ("9:5",)], "CRSDepTime string")
    got = df.select(dep_hour().alias("h"), padded_dep_time().alias("p")).collect()
    assert [r["h"] for r in got] == [9, 9, 14, None] and [r["p"] for r in got][:3] == ["0905", "0905", "1430"]
