"""The four raw inputs, derived from the given tables.

One SQL text serves Spark and DuckDB; where the dialects differ the text has a
slot. Every input is a projection or one aggregation of a whole table, so its
size grows with the data. See FIXTURES.md for what each column exercises.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SPARK = {
    "dmy": "date_format(l.flown, 'dd-MM-yyyy')",
    "dow": "weekday({}) + 1",
    "copies": "LATERAL VIEW explode(CASE WHEN l.l_orderkey%50=0 THEN array(1,2) ELSE array(1) END) c AS copy",
}
DUCKDB = {
    "dmy": "strftime(l.flown, '%d-%m-%Y')",
    "dow": "isodow({})",
    "copies": ", unnest(CASE WHEN l.l_orderkey%50=0 THEN [1,2] ELSE [1] END) AS c(copy)",
}


def _flight_columns(short: bool) -> str:
    """Columns that completed and failed flights share, from distance to delay causes."""
    suffix = {"Short": "", "Medium": "", "Long": ""} if short else {
        "Short": " >1500Mi", "Medium": " <3000Mi", "Long": " <6000Mi"
    }
    causes = {
        "Carrier": "cast(l.l_partkey%7 AS int)",
        "Weather": "cast(l.l_suppkey%7 AS int)",
        "NAS": "l.l_linenumber-1",
        "Security": "cast(l.l_orderkey%8 AS int)",
        "LastAircraft": "cast(l.l_orderkey%9 AS int)",
    }
    missing = {"Carrier": "l.l_orderkey%41=0 OR l.l_orderkey%31=0"}
    minutes = ",\n  ".join(
        f"CASE WHEN {missing.get(name, 'l.l_orderkey%41=0')} THEN NULL"
        f" WHEN l.l_orderkey%5=0 THEN 0 ELSE {value} END AS Delay_{name}"
        for name, value in causes.items()
    )
    low_dep, high_dep = ("Low Departure Delay", "Hight Departure Delay") if short else ("Low <5min", "Hight >60min")
    low_arr, high_arr = ("Low Arrival Delay", "hight Arrival Delay") if short else ("Low <5min", "hight >60min")
    return f"""
  CASE WHEN l.l_orderkey%89=0 THEN NULL WHEN l.l_partkey%3=0 THEN 'n00'
       WHEN l.l_partkey%7=0 THEN 'x'||cast(5*l.l_suppkey AS string)
       ELSE 'n'||lpad(cast(l.l_suppkey%8 AS string),2,'0') END AS Dep_Airport,
  'City '||cast(l.l_suppkey%8 AS string) AS Dep_CityName,
  'n'||lpad(cast((l.l_partkey+l.l_suppkey)%2 AS string),2,'0') AS Arr_Airport,
  'City '||cast((l.l_partkey+l.l_suppkey)%2 AS string) AS Arr_CityName,
  CASE l.l_linenumber%4 WHEN 0 THEN 'Night' WHEN 1 THEN 'Morning' WHEN 2 THEN 'Afternoon' ELSE 'Evening' END AS DepTime_label,
  cast(30+l.l_quantity*5 AS int) AS Flight_Duration,
  CASE l.l_linenumber%4 WHEN 0 THEN 'Short Haul{suffix["Short"]}' WHEN 1 THEN 'Medium Haul{suffix["Medium"]}'
       WHEN 2 THEN 'Long Haul{suffix["Long"]}' ELSE 'Ultra' END AS Distance_type,
  CASE WHEN l.l_orderkey%53=0 THEN NULL WHEN l.l_orderkey%7=0 THEN 0 ELSE cast(l.l_quantity AS int)-25 END AS Dep_Delay,
  CASE WHEN l.l_quantity>25 THEN 1 ELSE 0 END AS Dep_Delay_Tag,
  CASE WHEN l.l_quantity<30 THEN '{low_dep}' ELSE '{high_dep}' END AS Dep_Delay_Type,
  CASE WHEN l.l_orderkey%59=0 THEN NULL WHEN l.l_orderkey%11=0 THEN 0 ELSE cast(l.l_quantity AS int)-20-l.l_linenumber END AS Arr_Delay,
  CASE WHEN l.l_quantity<40 THEN '{low_arr}' ELSE '{high_arr}' END AS Arr_Delay_Type,
  {minutes}"""


def raw_sql(name: str, dialect: dict[str, str], table: Callable[[str], str] = str) -> str:
    """SELECT of a raw input; ``table`` spells a table name for the engine."""
    d = dialect
    if name == "flights":
        return f"""
SELECT CASE WHEN l.l_orderkey%97=0 THEN NULL ELSE {d["dmy"]} END AS FlightDate,
  cast({d["dow"].format("l.flown")} AS int) AS Day_Of_Week,
  ' Air '||cast(CASE WHEN l.l_partkey%11=0 THEN l.l_suppkey ELSE l.l_partkey%2 END AS string)||' ' AS Airline, 'T'||cast(l.l_suppkey AS string) AS Tail_Number,
  CASE l.l_partkey%3 WHEN 0 THEN 'boeing ' WHEN 1 THEN 'Airbus' ELSE ' embraer' END AS Manufacturer,
  'M'||cast(l.l_partkey%20 AS string) AS Model, cast(l.l_partkey%30 AS int) AS Aicraft_age,
  {_flight_columns(short=False)}
FROM (SELECT *, make_date(cast(year(l_shipdate) AS int), cast((month(l_shipdate)-1)%3+1 AS int),
                          cast(least(day(l_shipdate),28) AS int)) AS flown
      FROM {table("lineitem")} WHERE l_returnflag='N') l
{d["copies"]}"""
    if name == "cancelled":
        return f"""
SELECT l.flown AS FlightDate, cast({d["dow"].format("l.flown")} AS int) AS Day_Of_Week,
  ' Air '||cast(CASE WHEN l.l_partkey%11=0 THEN l.l_suppkey ELSE l.l_partkey%2 END AS string)||' ' AS Airline, 'T'||cast(l.l_suppkey AS string) AS Tail_Number,
  CASE WHEN l.l_orderkey%103=0 THEN NULL WHEN l.l_returnflag='R' THEN 1 ELSE 0 END AS Cancelled,
  CASE WHEN (l.l_returnflag='A' AND l.l_orderkey%61<>0) OR l.l_linenumber=1 THEN 1 ELSE 0 END AS Diverted,
  {_flight_columns(short=True)}
FROM (SELECT *, cast(l_shipdate AS date) AS flown
      FROM {table("lineitem")} WHERE l_returnflag IN ('R','A')) l
{d["copies"]}"""
    if name == "weather":
        # half of the orders belong to 25 shared stations, the others to stations whose number grows with the customers
        station = """CASE WHEN o_custkey%2=0 THEN 'n'||lpad(cast(o_custkey%25 AS string),2,'0')
       ELSE 'x'||cast(o_custkey AS string) END"""
        return f"""
SELECT cast(o_orderdate AS date) AS time, {station} AS airport_id,
  CASE WHEN min(o_orderkey)%23=0 THEN NULL ELSE min(o_custkey%80)*0.5e0-10 END AS tavg,
  min(o_custkey%80)*0.5e0-15 AS tmin,
  CASE WHEN min(o_orderkey)%29=0 THEN NULL ELSE min(o_custkey%80)*0.5e0-5+max(o_orderkey%6) END AS tmax,
  CASE min(o_orderkey)%4 WHEN 0 THEN NULL WHEN 1 THEN 0e0 ELSE max(o_orderkey%9)*0.25e0 END AS prcp,
  CASE WHEN min(o_orderkey)%3=0 THEN 2.5e0 ELSE NULL END AS snow,
  cast(CASE WHEN min(o_orderkey)%5=0 THEN NULL ELSE min(o_orderkey)%360 END AS double) AS wdir,
  CASE min(o_orderkey)%6 WHEN 0 THEN 0e0 WHEN 1 THEN 20e0 WHEN 2 THEN 40e0 WHEN 3 THEN 60e0 WHEN 4 THEN 60.5e0 ELSE NULL END AS wspd,
  CASE min(o_orderkey)%7 WHEN 0 THEN 999.5e0 WHEN 1 THEN 1000e0 WHEN 2 THEN 1020e0 WHEN 3 THEN 1020.5e0 WHEN 4 THEN NULL ELSE 1010e0 END AS pres
FROM {table("orders")} GROUP BY {station}, cast(o_orderdate AS date)"""
    if name == "airports":
        return f"""
SELECT CASE WHEN c_custkey%5=0 THEN ' x'||cast(c_custkey AS string)||' ' WHEN c_nationkey=3 THEN ' unused '
       ELSE ' n'||lpad(cast(c_nationkey AS string),2,'0')||' ' END AS IATA_CODE,
  ' Airport '||cast(c_nationkey AS string)||' INTL' AS AIRPORT, 'City '||cast(c_nationkey AS string)||' ' AS CITY,
  CASE WHEN c_nationkey=24 THEN NULL WHEN c_nationkey=23 THEN 'DC' WHEN c_nationkey%8=0 THEN 'NY'
       WHEN c_nationkey%8=1 THEN 'GA' WHEN c_nationkey%8=2 THEN 'OH' WHEN c_nationkey%8=3 THEN 'TX'
       WHEN c_nationkey%8=4 THEN 'CA' WHEN c_nationkey%8=5 THEN 'AK' WHEN c_nationkey%8=6 THEN 'HI' ELSE 'PR' END AS STATE,
  'USA' AS COUNTRY, 20+cast(c_nationkey AS double)/3 AS LATITUDE, -70-cast(c_nationkey AS double)/7 AS LONGITUDE
FROM {table("customer")}"""
    raise KeyError(name)


SOURCE_TABLE = {"flights": "lineitem", "cancelled": "lineitem", "weather": "orders", "airports": "customer"}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw input as a lazy DataFrame."""
    source = SOURCE_TABLE[name]
    df = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    return spark.sql(raw_sql(name, SPARK, lambda t: "{" + t + "}"), **{source: df})


# About one scan split of text: a compressed file is read by one task.
RAW_RECORDS_PER_FILE = 500_000


def write_raw_csv(df: DataFrame, path: str) -> None:
    """A raw input as compressed CSV files, outer blanks kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RAW_RECORDS_PER_FILE)
        .csv(path)
    )


def scratch_dir(spark: SparkSession) -> str:
    """A new folder for one run, removed when the session's JVM ends.

    It lies in the shared folder that the cluster names, or below the warehouse
    where none is named; both are open to every executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{shared.rstrip('/')}/aeroledger-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder
