"""Best row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.cleaning import once, valid_delay
from tarmac.functions.flight import dep_hour, flight_date, padded_dep_time, NOON

# Fixed value: the year the best-flight question asks about.
BEST_FLIGHT_YEAR = 2008

# The columns that best flights are made of.  They are worked out before the date and the half-day:
# in one step with these, Spark's generated code for a row is too long to be compiled.
BEST_COLUMNS = ["Year", "Month", "DayofMonth", "Origin", "Dest", "UniqueCarrier", "CRSDepTime", "ArrDelay"]


def best_row(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each key group under ``order`` (a total order wins ties).

    ``row_number() = 1`` plans a partial WindowGroupLimit before the shuffle:
    each map task keeps one row per key, so a key holding a third of all rows
    reaches the final task as one row per map task, never as a whole group.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def best_flights(df: DataFrame, year: int | None = BEST_FLIGHT_YEAR) -> DataFrame:
    """O22 (Q-G): lowest arrival delay by (route, date, half-day) in ``year``.

    Ties: earlier scheduled departure, then carrier (D8).  Rows without a
    delay, with an unreadable time (D9) or an impossible date are dropped;
    ``quality_report`` counts them.  ``year=None`` keeps all years.
    """
    f = df if year is None else df.filter(F.col("Year") == F.lit(year))
    f = once(
        once(valid_delay(f, "ArrDelay"), *BEST_COLUMNS),
        F.col("Origin").alias("src"),
        F.col("Dest").alias("dst"),
        flight_date().alias("date"),
        (dep_hour("CRSDepTime") < F.lit(NOON)).alias("morning"),
        F.col("UniqueCarrier").alias("carrier"),
        F.col("CRSDepTime").alias("dep_time"),
        F.col("ArrDelay").alias("arr_delay"),
        padded_dep_time("CRSDepTime").alias("_dep_order"),
    ).filter(F.col("date").isNotNull() & F.col("morning").isNotNull())
    order = [
        F.col("arr_delay").asc(),
        F.col("_dep_order").asc(),
        F.col("carrier").asc_nulls_last(),
        F.col("dep_time").asc(),
    ]
    return best_row(f, ["src", "dst", "date", "morning"], order).drop("_dep_order")


def best_events(events: DataFrame) -> DataFrame:
    """O23 on ``events``: lowest value per (event_type, day, half-day); ties by ts, event_id."""
    e = events.select(
        "event_type",
        F.to_date("ts").alias("date"),
        (F.hour("ts") < F.lit(NOON)).alias("morning"),
        "event_id",
        "user_id",
        "ts",
        "value",
    )
    order = [F.col("value").asc_nulls_last(), F.col("ts").asc(), F.col("event_id").asc()]
    return best_row(e, ["event_type", "date", "morning"], order)
