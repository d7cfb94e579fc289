"""File readers: session CSVs and metrics CSVs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Session CSV headers and the names used here, in output order.
SESSION_COLUMNS = {
    "sessionID": "session_id",
    "stationID": "station_id",
    "connectionTime": "arrival_time",
    "disconnectTime": "departure_time",
    "kWhDelivered": "energy_kwh",
}
METRICS_SCHEMA = "region string, region_id long, alpha double, mae double, pinball_loss double"


def parse_session_time(text: Column) -> Column:
    """RFC 1123 ('Wed, 25 Apr 2018 11:08:39 GMT', weekday ignored) or ISO, as UTC."""
    rfc = F.try_to_timestamp(F.regexp_replace(text, "^[A-Za-z]+, *", ""), F.lit("d MMM yyyy HH:mm:ss z"))
    return F.coalesce(rfc, text.try_cast("timestamp"))


def normalise_sessions(raw: DataFrame) -> DataFrame:
    """Five named columns; rows that do not arrive before they depart are dropped."""
    missing = [new for old, new in SESSION_COLUMNS.items() if old not in raw.columns]
    if missing:
        raise ValueError(f"session file lacks columns: {missing}")
    named = raw.select(*[F.col(old).alias(new) for old, new in SESSION_COLUMNS.items()])
    return named.select(
        "session_id",
        "station_id",
        parse_session_time(F.col("arrival_time")).alias("arrival_time"),
        parse_session_time(F.col("departure_time")).alias("departure_time"),
        F.col("energy_kwh").try_cast("double").alias("energy_kwh"),
    ).filter("arrival_time < departure_time")


def load_sessions(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files at ``path``, each with its columns in an order of its own."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    names_all = reduce(lambda a, b: a & b, [F.contains("value", F.lit(c)) for c in SESSION_COLUMNS])
    heads = lines.groupBy("file").agg(F.min(F.when(names_all, F.col("value"))).alias("header"))
    # Files with one header are read together; the driver sees a row for each file.
    forms: dict[str | None, list[str]] = {}
    for r in heads.collect():
        forms.setdefault(r.header, []).append(r.file)
    parts = [normalise_sessions(spark.read.option("header", True).csv(files)) for files in forms.values()]
    return reduce(DataFrame.unionByName, parts) if parts else normalise_sessions(spark.read.option("header", True).csv(path))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).option("header", True).csv(path)


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
