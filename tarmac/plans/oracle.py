"""DuckDB SQL equal in meaning to each registered query.

The CTEs rebuild the fixture view (raw text records), the cleaning step
and the typed form; each query then reads ``flights`` (or ``clean``).
"""

from __future__ import annotations

_RAW = r"""
raw AS (
  SELECT
    CAST(year(o.o_orderdate) AS VARCHAR) AS "Year",
    CAST(month(o.o_orderdate) AS VARCHAR) AS "Month",
    CAST(day(o.o_orderdate) AS VARCHAR) AS "DayofMonth",
    CAST(isodow(o.o_orderdate) AS VARCHAR) AS "DayOfWeek",
    p.p_brand AS "UniqueCarrier",
    ns.n_name AS "Origin",
    nc.n_name AS "Dest",
    lpad(CAST(((l.l_orderkey * 7 + l.l_linenumber * 61) % 1440) // 60 AS VARCHAR), 2, '0')
      || lpad(CAST(((l.l_orderkey * 7 + l.l_linenumber * 61) % 1440) % 60 AS VARCHAR), 2, '0')
      AS "CRSDepTime",
    CASE WHEN l.l_quantity = 1 THEN ''
         ELSE CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS VARCHAR) || '.00'
    END AS "DepDelay",
    CASE WHEN l.l_quantity IN (1, 2) THEN ''
         WHEN l.l_quantity = 50 THEN 'bad'
         ELSE CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE))
                   + CAST(l.l_quantity AS BIGINT) - 25 AS VARCHAR) || '.00'
    END AS "ArrDelay",
    CASE WHEN l.l_quantity = 1 THEN '1.00' ELSE '0.00' END AS "Cancelled",
    CASE WHEN l.l_quantity = 2 THEN '1.00' ELSE '0.00' END AS "Diverted"
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey
)"""

_COLS = ["Year", "Month", "DayofMonth", "DayOfWeek", "UniqueCarrier", "Origin", "Dest",
         "CRSDepTime", "DepDelay", "ArrDelay", "Cancelled", "Diverted"]

_CLEAN = "clean AS (\n  SELECT\n" + ",\n".join(
    f"    NULLIF(regexp_replace(\"{c}\", '\\.00$', ''), '') AS \"{c}\"" for c in _COLS
) + "\n  FROM raw\n)"


def _int(c: str, t: str) -> str:
    """Sign and digits after trimming, else NULL (Spark's try_cast on text)."""
    return (f"CASE WHEN regexp_full_match(trim(\"{c}\"), '[+-]?[0-9]+') "
            f"THEN TRY_CAST(trim(\"{c}\") AS {t}) END")


def _typed(c: str) -> str:
    if c in ("Year", "Month", "DayofMonth", "DayOfWeek", "Cancelled", "Diverted"):
        return f"{_int(c, 'INTEGER')} AS \"{c}\""
    if c in ("DepDelay", "ArrDelay"):
        return f"{_int(c, 'BIGINT')} AS \"{c}\""
    return f"\"{c}\""


_FLIGHTS = "flights AS (\n  SELECT\n" + ",\n".join(f"    {_typed(c)}" for c in _COLS) + ",\n" + ",\n".join(
    f"    (\"{c}\" IS NOT NULL AND ({_int(c, 'BIGINT')}) IS NULL) AS \"{c}_bad\""
    for c in ("DepDelay", "ArrDelay")
) + "\n  FROM clean\n)"

_BASE = "WITH " + ",\n".join([_RAW, _CLEAN, _FLIGHTS])

_DEP_HOUR = ("CASE WHEN regexp_full_match(trim(\"CRSDepTime\"), '[0-9]{1,4}|[0-9]{2}:[0-9]{2}') "
             "THEN CAST(substr(lpad(trim(\"CRSDepTime\"), 4, '0'), 1, 2) AS INTEGER) END")
_DATE = ("TRY_CAST(TRY_STRPTIME(CAST(\"Year\" AS VARCHAR) || '-' || CAST(\"Month\" AS VARCHAR) || '-' "
         "|| CAST(\"DayofMonth\" AS VARCHAR), '%Y-%m-%d') AS DATE)")

_POP = """pop AS (
  SELECT airport, CAST(count(*) AS BIGINT) AS num_flights
  FROM (SELECT "Origin" AS airport FROM flights UNION ALL SELECT "Dest" AS airport FROM flights) e
  GROUP BY airport
)"""

_RANKED = _POP + """,
rf AS (
  SELECT CAST(row_number() OVER (ORDER BY num_flights DESC, airport ASC NULLS LAST) AS INTEGER) AS rank,
         airport, num_flights
  FROM pop
)"""


def _top_n(param: str, name: str) -> str:
    return _BASE + f""",
agg AS (
  SELECT "Origin" AS apt, "{param}" AS {name},
         CAST(sum("DepDelay") AS BIGINT) AS total_delay, CAST(count(*) AS BIGINT) AS num_flights
  FROM flights WHERE "DepDelay" IS NOT NULL
  GROUP BY "Origin", "{param}"
)
SELECT apt, rank, {name}, avg_delay, num_flights FROM (
  SELECT apt, {name}, num_flights,
         CAST(total_delay AS DOUBLE) / num_flights AS avg_delay,
         CAST(row_number() OVER (PARTITION BY apt
              ORDER BY CAST(total_delay AS DOUBLE) / num_flights ASC, {name} ASC NULLS LAST) AS INTEGER) AS rank
  FROM agg
) t WHERE rank <= 10"""


def _best_flights(year: int | None) -> str:
    of_year = f'"Year" = {year} AND ' if year is not None else ""
    return _BASE + f""",
f AS (
  SELECT "Origin" AS src, "Dest" AS dst, {_DATE} AS date, ({_DEP_HOUR} < 12) AS morning,
         "UniqueCarrier" AS carrier, "CRSDepTime" AS dep_time, "ArrDelay" AS arr_delay,
         lpad(replace(trim("CRSDepTime"), ':', ''), 4, '0') AS dep_order
  FROM flights
  WHERE {of_year}"ArrDelay" IS NOT NULL
)
SELECT src, dst, date, morning, carrier, dep_time, arr_delay FROM (
  SELECT *, row_number() OVER (PARTITION BY src, dst, date, morning
            ORDER BY arr_delay ASC, dep_order ASC, carrier ASC NULLS LAST, dep_time ASC) AS rn
  FROM f WHERE date IS NOT NULL AND morning IS NOT NULL
) t WHERE rn = 1"""


BEST_FLIGHTS_YEAR_FIXTURE = 1998

SQL: dict[str, str] = {
    "cleaned_flights": _BASE + "\nSELECT * FROM clean",
    "typed_flights": _BASE + "\nSELECT * FROM flights",
    "airport_popularity": _BASE + ",\n" + _POP + "\nSELECT airport, num_flights FROM pop",
    "popularity_ranked": _BASE + ",\n" + _POP
    + "\nSELECT airport, num_flights FROM pop ORDER BY num_flights DESC, airport ASC NULLS LAST",
    "top_airports": _BASE + ",\n" + _POP
    + "\nSELECT airport, num_flights FROM pop ORDER BY num_flights DESC, airport ASC NULLS LAST LIMIT 10",
    "popularity_rank_frequency": _BASE + ",\n" + _RANKED + "\nSELECT rank, airport, num_flights FROM rf",
    "rank_frequency_loglog": _BASE + ",\n" + _RANKED
    + "\nSELECT rank, round(ln(rank), 9) AS ln_rank, round(ln(num_flights), 9) AS ln_count FROM rf",
    "carrier_arrival_delay": _BASE + """
SELECT "UniqueCarrier" AS carrier,
       CAST(sum("ArrDelay") AS DOUBLE) / count(*) AS avg_delay,
       CAST(count(*) AS BIGINT) AS num_flights
FROM flights WHERE "ArrDelay" IS NOT NULL GROUP BY "UniqueCarrier\"""",
    "bad_delay_count": _BASE + """
SELECT CAST(count(*) FILTER (WHERE "ArrDelay_bad") AS BIGINT) AS bad_delays FROM flights""",
    "airport_delay_by_carrier": _BASE + """
SELECT "Origin" AS apt, "UniqueCarrier" AS airline,
       CAST(sum("DepDelay") AS BIGINT) AS total_delay, CAST(count(*) AS BIGINT) AS num_flights,
       CAST(sum("DepDelay") AS DOUBLE) / count(*) AS avg_delay
FROM flights WHERE "DepDelay" IS NOT NULL GROUP BY "Origin", "UniqueCarrier\"""",
    "top_carriers": _top_n("UniqueCarrier", "airline"),
    "top_destinations": _top_n("Dest", "dest_airport"),
    "route_arrival_delay": _BASE + """
SELECT "Origin" AS src, "Dest" AS dst,
       CAST(sum("ArrDelay") AS DOUBLE) / count(*) AS avg_delay,
       CAST(count(*) AS BIGINT) AS num_flights
FROM flights WHERE "ArrDelay" IS NOT NULL GROUP BY "Origin", "Dest\"""",
    "best_flights": _best_flights(BEST_FLIGHTS_YEAR_FIXTURE),
    "best_flights_all_years": _best_flights(None),
    "best_events": """
SELECT event_type, date, morning, event_id, user_id, ts, value FROM (
  SELECT event_type, CAST(ts AS DATE) AS date, (hour(ts) < 12) AS morning,
         event_id, user_id, ts, value,
         row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), (hour(ts) < 12)
                            ORDER BY value ASC NULLS LAST, ts ASC, event_id ASC) AS rn
  FROM events
) t WHERE rn = 1""",
    "quality_report": _BASE + f"""
SELECT CAST(count(*) AS BIGINT) AS num_rows,
       CAST(count(*) FILTER (WHERE "Origin" IS NULL) AS BIGINT) AS missing_origin,
       CAST(count(*) FILTER (WHERE "Dest" IS NULL) AS BIGINT) AS missing_dest,
       CAST(count(*) FILTER (WHERE "UniqueCarrier" IS NULL) AS BIGINT) AS missing_carrier,
       CAST(count(*) FILTER (WHERE "DepDelay" IS NULL AND NOT "DepDelay_bad") AS BIGINT) AS missing_dep_delay,
       CAST(count(*) FILTER (WHERE "DepDelay_bad") AS BIGINT) AS bad_dep_delay,
       CAST(count(*) FILTER (WHERE "ArrDelay" IS NULL AND NOT "ArrDelay_bad") AS BIGINT) AS missing_arr_delay,
       CAST(count(*) FILTER (WHERE "ArrDelay_bad") AS BIGINT) AS bad_arr_delay,
       CAST(count(*) FILTER (WHERE {_DEP_HOUR} IS NULL) AS BIGINT) AS bad_dep_time,
       CAST(count(*) FILTER (WHERE {_DATE} IS NULL) AS BIGINT) AS bad_date
FROM flights""",
}

# Ingest queries read files written from the same rows: they equal the cleaning.
SQL["raw_csv_ingest"] = SQL["cleaned_flights"]
SQL["archive_ingest"] = SQL["cleaned_flights"]
SQL["clean_csv_roundtrip"] = SQL["cleaned_flights"]

# Streaming versions must equal their batch results.
for _s, _b in [
    ("stream_popularity", "airport_popularity"),
    ("stream_carrier_delay", "carrier_arrival_delay"),
    ("stream_top_carriers", "top_carriers"),
    ("stream_top_destinations", "top_destinations"),
    ("stream_route_delay", "route_arrival_delay"),
    ("stream_best_flights", "best_flights"),
]:
    SQL[_s] = SQL[_b]

SQL["stream_restart"] = SQL["route_arrival_delay"]
SQL["stream_snapshot"] = SQL["airport_popularity"]
SQL["stream_clock"] = SQL["airport_popularity"]

# The replay publishes its rows in three micro-batches.
SQL["stream_batch_sizes"] = _BASE + """
SELECT CAST(3 AS BIGINT) AS num_batches, CAST(count(*) AS BIGINT) AS input_rows, CAST(2 AS BIGINT) AS last_batch FROM clean"""
SQL["stream_bad_delays"] = _BASE + """
SELECT CAST(count(*) FILTER (WHERE "ArrDelay_bad") AS BIGINT) AS bad_arr_delay,
       CAST(count(*) FILTER (WHERE "DepDelay_bad") AS BIGINT) AS bad_dep_delay FROM flights"""

SQL["rank_frequency_fit"] = _BASE + ",\n" + _RANKED + """
SELECT round(regr_slope(ln(num_flights), ln(rank)), 9) AS slope, round(regr_intercept(ln(num_flights), ln(rank)), 9) AS intercept,
       round(regr_r2(ln(num_flights), ln(rank)), 9) AS r2, CAST(count(*) AS BIGINT) AS num_points
FROM rf"""

# Damaged inputs: cancelled flights have a field too many, diverted ones one too few; layout b holds the odd months.
_LINE = "concat_ws(',', " + ", ".join(f"coalesce(\"{c}\", '_')" for c in _COLS) + ")"
_SHORT = "concat_ws(',', " + ", ".join(f"coalesce(\"{c}\", '_')" for c in _COLS[:-1]) + ")"
_DAMAGED = "(\"Cancelled\" = '1' OR \"Diverted\" = '1')"
SQL["stream_rejects"] = _BASE + f"""
SELECT CASE WHEN "Cancelled" = '1' THEN {_LINE} || ',more' ELSE {_SHORT} END AS record, 'wrong number of fields' AS reason
FROM clean WHERE {_DAMAGED}"""
SQL["stream_ingest"] = _BASE + """
SELECT * FROM flights WHERE "Cancelled" <> 1 AND "Diverted" <> 1"""
SQL["raw_csv_rejects"] = _BASE + f"""
SELECT CASE WHEN CAST("Month" AS INTEGER) % 2 = 1 THEN 'b' ELSE 'a' END AS layout,
       CASE WHEN {_DAMAGED} THEN 'wrong number of fields' ELSE 'accepted' END AS reason, CAST(count(*) AS BIGINT) AS num_records
FROM clean GROUP BY 1, 2"""
# the second member (odd months) of every archive is damaged and rejected whole
SQL["archive_rejects"] = _BASE + """
SELECT 'On_Time_a.csv' AS member, CAST(count(*) AS BIGINT) AS num_rows, FALSE AS has_rejects FROM clean WHERE CAST("Month" AS INTEGER) % 2 = 0
UNION ALL
SELECT DISTINCT 'On_Time_b.csv', CAST(0 AS BIGINT), TRUE FROM clean"""
