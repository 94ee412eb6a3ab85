"""Ranking, sort and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators.metrics import airport_delay_by, airport_popularity
from tarmac.session import scratch_path

# Fixed value: length of the per-airport top lists.
TOP_N = 10


def top_n_per_airport(df: DataFrame, param: str, name: str, n: int = TOP_N,
                      delay: str = "DepDelay", airport: str = "Origin") -> DataFrame:
    """Per airport, the ``n`` values of ``param`` with the lowest mean delay.

    Ranks start at 1; ties in the mean are broken by the parameter value (D1, D2).
    The ranking runs on the aggregated (airport, parameter) rows; Spark inserts
    a partial WindowGroupLimit before the exchange, so at most ``n`` rows per
    airport and map task are shuffled.
    """
    return rank_within_airport(airport_delay_by(df, param, name, delay=delay, airport=airport), name, n)


def rank_within_airport(agg: DataFrame, name: str, n: int = TOP_N) -> DataFrame:
    """Top ``n`` rows per ``apt`` of (apt, name, avg_delay, num_flights) rows, ranked from 1."""
    w = Window.partitionBy("apt").orderBy(F.col("avg_delay").asc(), F.col(name).asc_nulls_last())
    return (
        agg.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= n)
        .select("apt", "rank", name, "avg_delay", "num_flights")
    )


def top_carriers(df: DataFrame, n: int = TOP_N) -> DataFrame:
    """O24 (Q-C): ten carriers with the lowest mean departure delay per origin."""
    return top_n_per_airport(df, "UniqueCarrier", "airline", n)


def top_destinations(df: DataFrame, n: int = TOP_N) -> DataFrame:
    """O25 (Q-D): ten destinations with the lowest mean departure delay per origin."""
    return top_n_per_airport(df, "Dest", "dest_airport", n)


def popularity_order() -> list[Column]:
    return [F.col("num_flights").desc(), F.col("airport").asc_nulls_last()]


def popularity_ranked(df: DataFrame, n: int | None = None) -> DataFrame:
    """Airports by flight count, descending; with ``n`` a top-n report.

    With ``n`` the plan is TakeOrderedAndProject (per-partition top-n, then a
    merge of n rows per partition); without it, a range-partitioned sort.
    """
    out = airport_popularity(df).orderBy(*popularity_order())
    return out.limit(n) if n is not None else out


def global_row_number(df: DataFrame, order: list[Column], name: str = "rank",
                      num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` over a total order without a single-partition window.

    Rows are range-partitioned by the order and sorted within partitions;
    each row's rank is the number of rows in earlier partitions plus its
    position in its own.  The per-partition counts are one row per
    partition (bounded by ``num_partitions``), so broadcasting them is safe.
    The numbered rows are written once to shared scratch and read by both
    branches: range bounds are sampled, so planning the exchange twice could
    place rows differently in each.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    path = scratch_path(spark, "ranked")
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_pid")
        .agg(F.min("_mid").alias("_base"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select("_pid", "_base", "_before")
    )
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_before") + F.col("_mid") - F.col("_base") + 1).cast("int"))
        .drop("_pid", "_mid", "_base", "_before")
    )


def popularity_rank_frequency(df: DataFrame) -> DataFrame:
    """O27 (Q-F): rank against flight count; ties get distinct ranks (by airport)."""
    ranked = global_row_number(airport_popularity(df), popularity_order())
    return ranked.select("rank", "airport", "num_flights")


def rank_frequency_loglog(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Natural logs of rank and count, the points behind the log-log plot; rounded only if asked."""
    rf = popularity_rank_frequency(df)
    log = lambda c: F.ln(F.col(c)) if digits is None else F.round(F.ln(F.col(c)), digits)
    return rf.select("rank", log("rank").alias("ln_rank"), log("num_flights").alias("ln_count"))


def rank_frequency_fit(df: DataFrame, digits: int | None = None) -> DataFrame:
    """The line through the log-log points by least squares (slope, intercept, r2, and how many points)."""
    points = rank_frequency_loglog(df)
    fit = points.agg(F.regr_slope("ln_count", "ln_rank").alias("slope"), F.regr_intercept("ln_count", "ln_rank").alias("intercept"),
                     F.regr_r2("ln_count", "ln_rank").alias("r2"), F.count(F.lit(1)).alias("num_points"))
    return fit if digits is None else fit.select(*[F.round(c, digits).alias(c) for c in ("slope", "intercept", "r2")], "num_points")
