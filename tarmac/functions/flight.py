"""Flight-level derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a scheduled hour below this is "morning".
NOON = 12
# Fixed value: a scheduled time is one to four digits, HHMM without leading zeros, or HH:MM.
DEP_TIME_PATTERN = r"^([0-9]{1,4}|[0-9]{2}:[0-9]{2})\z"


def dep_hour(c: Column | str = "CRSDepTime") -> Column:
    """Scheduled hour: first two characters of the time padded to four ("900" -> 09)."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.trim(c)
    return F.when(t.rlike(DEP_TIME_PATTERN), F.substring(F.lpad(t, 4, "0"), 1, 2).cast("int"))


def padded_dep_time(c: Column | str = "CRSDepTime") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.lpad(F.regexp_replace(F.trim(c), ":", ""), 4, "0")


def with_morning(df: DataFrame, time_col: str = "CRSDepTime", name: str = "morning") -> DataFrame:
    """Half-day flag, null when the time is missing or unparseable."""
    return df.withColumn(name, dep_hour(time_col) < F.lit(NOON))


def days_in_month(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return (
        F.when(m == 2, F.when(leap, F.lit(29)).otherwise(F.lit(28)))
        .when(m.isin(4, 6, 9, 11), F.lit(30))
        .otherwise(F.lit(31))
    )


def flight_date(year: str = "Year", month: str = "Month", day: str = "DayofMonth") -> Column:
    """Calendar date from integer parts; an impossible date (31 February) gives null.

    Validity is checked with integer arithmetic and ``make_date`` runs only on
    valid parts (so it never raises under ANSI mode), which avoids formatting
    and re-parsing a date string for every row.
    """
    y, m, d = F.col(year), F.col(month), F.col(day)
    valid = (
        y.between(1, 9999) & m.between(1, 12) & (d >= 1) & (d <= days_in_month(y, m))
    )
    return F.when(valid, F.make_date(y, m, d))


def with_flight_date(df: DataFrame, name: str = "date") -> DataFrame:
    return df.withColumn(name, flight_date())


def airport_endpoints(df: DataFrame, origin: str = "Origin", dest: str = "Dest") -> DataFrame:
    """One row per flight endpoint (departure and arrival airport)."""
    return df.select(F.explode(F.array(F.col(origin), F.col(dest))).alias("airport"))


def route_key(origin: str = "Origin", dest: str = "Dest") -> Column:
    """Route as one text key, when a single column is wanted."""
    return F.concat_ws("_", F.col(origin), F.col(dest))
