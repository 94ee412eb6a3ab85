"""Counts and mean delays by key.

Every mean is an exact bigint sum divided once by a count, as a double;
``avg`` over doubles is avoided because addition order could change the
last digit between runs.  All aggregates are plain sum/count, so Spark
plans a partial HashAggregate before the shuffle: a hot airport that holds
a third of all rows still ships one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.cleaning import bad_flag_name, valid_delay
from tarmac.functions.flight import airport_endpoints


def mean_of(total: str = "total_delay", count: str = "num_flights") -> Column:
    return (F.col(total).cast("double") / F.col(count)).alias("avg_delay")


def delay_totals(df: DataFrame, keys: list[str | Column], delay: str) -> DataFrame:
    """(keys..., total_delay, num_flights) over rows with a usable delay (O9 then group, D5)."""
    return valid_delay(df, delay).groupBy(*keys).agg(
        F.sum(delay).alias("total_delay"), F.count(F.lit(1)).alias("num_flights")
    )


def airport_popularity(df: DataFrame) -> DataFrame:
    """O18 (Q-A): flights touching each airport; a missing airport is its own group."""
    return airport_endpoints(df).groupBy("airport").agg(F.count(F.lit(1)).alias("num_flights"))


def carrier_arrival_delay(df: DataFrame) -> DataFrame:
    """O19 (Q-B): mean arrival delay and flight count per carrier."""
    t = delay_totals(df, [F.col("UniqueCarrier").alias("carrier")], "ArrDelay")
    return t.select("carrier", mean_of(), "num_flights")


def airport_delay_by(df: DataFrame, param: str, name: str | None = None,
                     delay: str = "DepDelay", airport: str = "Origin") -> DataFrame:
    """Total and mean delay by (airport, parameter column), flat key."""
    name = name or param
    t = delay_totals(df, [F.col(airport).alias("apt"), F.col(param).alias(name)], delay)
    return t.select("apt", name, "total_delay", "num_flights", mean_of())


def route_arrival_delay(df: DataFrame) -> DataFrame:
    """O21 (Q-E): mean arrival delay and count per (origin, destination)."""
    t = delay_totals(df, [F.col("Origin").alias("src"), F.col("Dest").alias("dst")], "ArrDelay")
    return t.select("src", "dst", mean_of(), "num_flights")


def bad_delay_count(df: DataFrame, col: str = "ArrDelay") -> DataFrame:
    """Number of present-but-unparseable delays in ``col`` (one row)."""
    return df.agg(F.count_if(F.col(bad_flag_name(col))).alias("bad_delays"))
