"""Raw flight records shaped from the driver's TPC-H-style tables.

One raw record per ``lineitem`` row; every field is text, as in a raw
CSV file (blank = missing, numbers often written ``<int>.00``).

Plan shape: the two small nation lookups are joined to ``supplier`` and
``customer`` first, and ``customer`` to ``orders``, so the fact table
(``lineitem``) is joined to pre-shaped dimensions only.  No broadcast is
forced: Catalyst broadcasts a side only when its estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks with run-time
sizes), and falls back to a shuffled sort-merge join beyond it.  That is
what keeps ``part``/``supplier``/``customer`` safe at 100 TB, where they
no longer fit in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.cleaning import clean_values, typed_flights

# Fixed values of the fixture definition.
MINUTES_PER_DAY = 1440
DEP_ORDER_FACTOR = 7
DEP_LINE_FACTOR = 61
ARR_DELAY_OFFSET = 25
BAD_DELAY_QUANTITY = 50
CANCELLED_QUANTITY = 1
DIVERTED_QUANTITY = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _txt(c: Column) -> Column:
    return c.cast("string")


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text raw records, the twelve fields by name (FIXTURES §6)."""
    t = lambda n: table(spark, sf_dir, n)
    nation = t("nation").select("n_nationkey", "n_name")
    origin = (
        t("supplier").select("s_suppkey", "s_nationkey")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_name").alias("origin_name"))
    )
    dest = (
        t("customer").select("c_custkey", "c_nationkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("dest_name"))
    )
    orders = (
        t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        .join(dest, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderdate", "dest_name")
    )
    part = t("part").select("p_partkey", "p_brand")
    li = t("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    # Fact-to-orders is a join of two tables that both grow with the data, so
    # it is a sort-merge join at every size: both sides hash-partitioned on the
    # order key (spill-safe, never a broadcast of a fact-sized side).  The
    # exchange also spreads the row work over all cores when the input is a
    # single large file.
    j = (
        li.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(origin, F.col("l_suppkey") == F.col("s_suppkey"))
    )

    d = F.col("o_orderdate").cast("date")
    q = F.col("l_quantity")
    days = F.datediff(F.col("l_shipdate").cast("date"), d)
    x = (F.col("l_orderkey") * DEP_ORDER_FACTOR + F.col("l_linenumber") * DEP_LINE_FACTOR) % MINUTES_PER_DAY
    hhmm = F.concat(
        F.lpad(_txt(F.floor(x / 60)), 2, "0"), F.lpad(_txt(x % 60), 2, "0")
    )
    dep_delay = F.when(q == CANCELLED_QUANTITY, F.lit("")).otherwise(
        F.concat(_txt(days), F.lit(".00"))
    )
    arr_delay = (
        F.when(q.isin(CANCELLED_QUANTITY, DIVERTED_QUANTITY), F.lit(""))
        .when(q == BAD_DELAY_QUANTITY, F.lit("bad"))
        .otherwise(F.concat(_txt(days + q.cast("bigint") - ARR_DELAY_OFFSET), F.lit(".00")))
    )
    return j.select(
        _txt(F.year(d)).alias("Year"),
        _txt(F.month(d)).alias("Month"),
        _txt(F.dayofmonth(d)).alias("DayofMonth"),
        _txt(F.weekday(d) + 1).alias("DayOfWeek"),
        F.col("p_brand").alias("UniqueCarrier"),
        F.col("origin_name").alias("Origin"),
        F.col("dest_name").alias("Dest"),
        hhmm.alias("CRSDepTime"),
        dep_delay.alias("DepDelay"),
        arr_delay.alias("ArrDelay"),
        F.when(q == CANCELLED_QUANTITY, F.lit("1.00")).otherwise(F.lit("0.00")).alias("Cancelled"),
        F.when(q == DIVERTED_QUANTITY, F.lit("1.00")).otherwise(F.lit("0.00")).alias("Diverted"),
    )


def clean_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned text records (what the cleaning step writes)."""
    return clean_values(raw_flights(spark, sf_dir))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed cleaned records, the input of every question."""
    return typed_flights(clean_flights(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
