"""Fixed schema of the RAW trips table, layer names and column catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The 19 RAW columns in table order, with their types.
TRIPS_COLUMNS = [
    ("vendorid", T.LongType()),
    ("tpep_pickup_datetime", T.TimestampNTZType()),
    ("tpep_dropoff_datetime", T.TimestampNTZType()),
    ("passenger_count", T.DoubleType()),
    ("trip_distance", T.DoubleType()),
    ("ratecodeid", T.DoubleType()),
    ("store_and_fwd_flag", T.StringType()),
    ("pulocationid", T.LongType()),
    ("dolocationid", T.LongType()),
    ("payment_type", T.LongType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("airport_fee", T.DoubleType()),
]

# Column descriptions carried as StructField metadata ("comment").
COLUMN_COMMENTS = {
    "vendorid": "vendor identifier",
    "tpep_pickup_datetime": "pickup date and time",
    "tpep_dropoff_datetime": "drop-off date and time",
    "passenger_count": "number of passengers",
    "trip_distance": "trip distance in miles",
    "pulocationid": "pickup zone id",
    "dolocationid": "drop-off zone id",
    "fare_amount": "metered fare",
    "total_amount": "total amount paid",
    "trip_duration_minutes": "trip duration in minutes (minute boundaries crossed)",
    "avg_speed_mph": "average speed in miles per hour",
    "tip_percentage": "tip as a percentage of the fare",
    "pickup_date": "pickup date",
    "total_trips": "number of trips",
    "pickup_zone": "pickup zone id",
    "popularity_rank": "rank of the zone by trip count",
    "pickup_hour": "pickup hour (0-23)",
}

TABLE_COMMENTS = {
    "trips_raw": "raw yellow-taxi trips loaded from monthly Parquet files",
    "clean_trips": "cleaned and enriched trips",
    "daily_summary": "daily trip summary",
    "zone_analysis": "per pickup-zone summary",
    "hourly_patterns": "demand patterns per hour",
    "trip_categories": "trips per distance category and day type",
}

# Three storage layers, one Spark database each.
LAYERS = ("raw", "staging", "final")


def trips_schema(with_comments: bool = True) -> T.StructType:
    fields = []
    for name, dtype in TRIPS_COLUMNS:
        meta = {"comment": COLUMN_COMMENTS[name]} if with_comments and name in COLUMN_COMMENTS else {}
        fields.append(T.StructField(name, dtype, True, meta))
    return T.StructType(fields)


TRIPS = trips_schema()
TRIPS_NAMES = [n for n, _ in TRIPS_COLUMNS]


def create_fixed_schema(spark: SparkSession, table: str = "raw.trips_raw",
                        location: str | None = None) -> None:
    """Declare the RAW table (fixed schema and the pickup's DATE, Parquet,
    partitioned by month); ``load_months(table=...)`` fills it."""
    db = table.split(".")[0] if "." in table else None
    if db:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    cols = ", ".join(f"{n} {t.simpleString()}" for n, t in TRIPS_COLUMNS) + ", pickup_day date"
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}, load_month STRING) "
              f"USING parquet PARTITIONED BY (load_month){loc}")


def table_location(spark: SparkSession, table: str) -> str:
    """Where the files of a stored table lie."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def with_comments(df: DataFrame, comments: dict[str, str] | None = None) -> DataFrame:
    """Attach catalog comments to matching columns (metadata only, no data work)."""
    comments = COLUMN_COMMENTS if comments is None else comments
    cols = []
    for f in df.schema.fields:
        c = df[f.name]
        if f.name in comments:
            c = c.alias(f.name, metadata={**(f.metadata or {}), "comment": comments[f.name]})
        cols.append(c)
    return df.select(*cols)


def catalog_df(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, type, comment) for each given table's schema."""
    rows = []
    for tname, df in tables.items():
        for f in df.schema.fields:
            comment = (f.metadata or {}).get("comment") or COLUMN_COMMENTS.get(f.name)
            rows.append((tname, f.name, f.dataType.simpleString(), comment))
    return spark.createDataFrame(rows, "table string, column string, type string, comment string")
