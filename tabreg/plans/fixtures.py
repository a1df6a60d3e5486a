"""Flight-shaped projection of the driver's ``lineitem`` table.

The test tables hold no flights, so every flight query runs on this
projection: 29 raw string columns shaped like the public flight data (HHMM
clocks, ``NA`` text, nulls) plus three bigint keys for keyed splits. It is a
single projection, and Catalyst prunes the lineitem scan to the columns it
reads. A table of more than ``ROWS_PER_PARTITION`` rows is dealt out first.

``FLIGHTS_SQL`` is the same projection in plain SQL, used by the DuckDB
oracles; the two must stay equal.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("l_orderkey", "l_linenumber", "l_partkey")

# --- fixed values: the columns of the flight table -------------------------
RAW_COLUMNS = (
    "Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime", "CRSArrTime",
    "UniqueCarrier", "FlightNum", "TailNum", "CRSElapsedTime", "ArrDelay", "DepDelay",
    "Origin", "Dest", "Distance", "TaxiOut", "ArrTime", "ActualElapsedTime", "AirTime",
    "TaxiIn", "Cancelled", "CancellationCode", "Diverted", "CarrierDelay", "WeatherDelay",
    "NASDelay", "SecurityDelay", "LateAircraftDelay",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: The projection of so many rows is one task's work.
ROWS_PER_PARTITION = 100_000


def spread(df: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """``df`` dealt evenly over tasks by its row count (read from the file footers).

    A scan has no more busy tasks than its files have row groups, which may
    hold millions of rows; the narrow rows are shuffled before they grow wide.
    """
    n = math.ceil(df.count() / rows_per_partition)
    return df.repartition(n) if n > 1 else df


def flights_from_lineitem(lineitem: DataFrame, keep_keys: bool = True) -> DataFrame:
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    qty = F.col("l_quantity").cast("int")
    na = F.lit("NA")
    null = F.lit(None).cast("string")

    def s(c):
        return c.cast("string")

    cols = [
        s(F.year("l_shipdate")).alias("Year"),
        s(F.month("l_shipdate")).alias("Month"),
        s(F.dayofmonth("l_shipdate")).alias("DayofMonth"),
        s(ok % 7 + 1).alias("DayOfWeek"),
        F.when(ok % 50 == 0, na).otherwise(s((ok % 24) * 100 + pk % 60)).alias("DepTime"),
        s((ok % 24) * 100 + pk % 45).alias("CRSDepTime"),
        s(((ok + 2) % 24) * 100 + sk % 60).alias("CRSArrTime"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("UniqueCarrier"),
        s(pk).alias("FlightNum"),
        F.when(sk % 10 == 0, null).when(sk % 10 == 1, na)
         .otherwise(F.concat(F.lit("N"), s(sk))).alias("TailNum"),
        s(pk % 300 + 30).alias("CRSElapsedTime"),
        F.when(ok % 40 == 0, na).otherwise(s(qty - 25 + ln + pk % 7 - 3)).alias("ArrDelay"),
        F.when(ln == 7, na).otherwise(s(qty - 25)).alias("DepDelay"),
        F.concat(F.lit("A"), s(sk % 5)).alias("Origin"),
        F.concat(F.lit("B"), s(pk % 6)).alias("Dest"),
        s(F.round(F.col("l_extendedprice") / 50).cast("int")).alias("Distance"),
        F.when(sk % 20 == 3, null).otherwise(s(ln * 2)).alias("TaxiOut"),
        na.alias("ArrTime"), na.alias("ActualElapsedTime"), na.alias("AirTime"), na.alias("TaxiIn"),
        F.lit("0").alias("Cancelled"), null.alias("CancellationCode"), F.lit("0").alias("Diverted"),
        na.alias("CarrierDelay"), na.alias("WeatherDelay"), na.alias("NASDelay"),
        na.alias("SecurityDelay"), na.alias("LateAircraftDelay"),
    ]
    if keep_keys:
        cols += [ok, ln, pk]
    return lineitem.select(*cols)


def flights(spark: SparkSession, sf_dir: str, keep_keys: bool = True) -> DataFrame:
    """The flight-shaped table for a scale-factor folder."""
    return flights_from_lineitem(spread(table(spark, sf_dir, "lineitem")), keep_keys=keep_keys)


FLIGHTS_SQL = """
select cast(year(l_shipdate) as string) as Year, cast(month(l_shipdate) as string) as Month,
 cast(day(l_shipdate) as string) as DayofMonth, cast(l_orderkey % 7 + 1 as string) as DayOfWeek,
 case when l_orderkey % 50 = 0 then 'NA' else cast((l_orderkey % 24) * 100 + l_partkey % 60 as string) end as DepTime,
 cast((l_orderkey % 24) * 100 + l_partkey % 45 as string) as CRSDepTime,
 cast(((l_orderkey + 2) % 24) * 100 + l_suppkey % 60 as string) as CRSArrTime,
 concat(l_returnflag, l_linestatus) as UniqueCarrier, cast(l_partkey as string) as FlightNum,
 case when l_suppkey % 10 = 0 then null when l_suppkey % 10 = 1 then 'NA'
      else concat('N', cast(l_suppkey as string)) end as TailNum,
 cast(l_partkey % 300 + 30 as string) as CRSElapsedTime,
 case when l_orderkey % 40 = 0 then 'NA'
      else cast(cast(l_quantity as int) - 25 + l_linenumber + l_partkey % 7 - 3 as string) end as ArrDelay,
 case when l_linenumber = 7 then 'NA' else cast(cast(l_quantity as int) - 25 as string) end as DepDelay,
 concat('A', cast(l_suppkey % 5 as string)) as Origin, concat('B', cast(l_partkey % 6 as string)) as Dest,
 cast(cast(round(l_extendedprice / 50) as int) as string) as Distance,
 case when l_suppkey % 20 = 3 then null else cast(l_linenumber * 2 as string) end as TaxiOut,
 'NA' as ArrTime, 'NA' as ActualElapsedTime, 'NA' as AirTime, 'NA' as TaxiIn, '0' as Cancelled,
 cast(null as string) as CancellationCode, '0' as Diverted, 'NA' as CarrierDelay, 'NA' as WeatherDelay,
 'NA' as NASDelay, 'NA' as SecurityDelay, 'NA' as LateAircraftDelay, l_orderkey, l_linenumber, l_partkey
from lineitem
"""
