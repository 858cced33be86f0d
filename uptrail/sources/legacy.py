"""Readers for the older delimited logs (fields separated by 0x01)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from uptrail import schemas
from uptrail.functions import clock

SEPARATOR = "\u0001"


def read_delimited(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("sep", SEPARATOR).option("quote", "").csv(path)


def read_delimited_logs(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.LEGACY_LOG)


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Hosts with service, site and ROC, under the short stored names."""
    return trim_sites(read_delimited(spark, path, schemas.LEGACY_SITES))


def trim_sites(sites: DataFrame) -> DataFrame:
    return sites.select(F.col("hostname").alias("h"), F.col("service").alias("srv"),
                        F.col("site").alias("st"), "roc")


def read_detail_log(spark: SparkSession, path: str) -> DataFrame:
    return detail_short(read_delimited(spark, path, schemas.LEGACY_DETAIL))


def detail_short(log: DataFrame) -> DataFrame:
    """Detail log under the short stored names, with date and time as integers."""
    ts = F.col("timestamp")
    return log.select(
        ts.alias("ts"), "roc", F.col("monitoring_box").alias("mb"), F.col("metric").alias("mn"),
        F.col("service_type").alias("sf"), F.col("hostname").alias("sh"), F.col("status").alias("s"),
        "vo", F.col("vo_fqan").alias("vof"), F.col("summary").alias("sum"),
        F.col("message").alias("msg"), clock.date_int(clock.text_date(ts)).alias("di"),
        clock.time_int(clock.seconds_of_day(ts)).alias("ti"))


def read_raw_data(logs: DataFrame, dates: str, profiles: DataFrame) -> DataFrame:
    """Rows of one partition (dates as yyyymmdd) that belong to a known profile."""
    return (logs.where(F.col("dates") == dates)
            .join(profiles.select("profile"), "profile", "left_semi"))


def trim_profiles(rows: DataFrame) -> DataFrame:
    """Profile lines without their leading bookkeeping fields, each once."""
    return rows.select("profile", "service_flavour", "metric").distinct()
