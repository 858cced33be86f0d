"""Readers for the fact and dimension tables.

``format`` is any batch source: parquet by default, ``avro`` where the package is on the class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from uptrail import schemas
from uptrail.functions import clock
from uptrail.operators import selection


def read_table(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet",
               partitions: tuple[str, ...] = ()) -> DataFrame:
    """Read with a fixed schema; ``partitions`` are directory columns (dates or strings)."""
    fields = [T.StructField(p, T.DateType() if p == "date" else T.StringType())
              for p in partitions if p not in schema.names]
    return spark.read.format(format).schema(T.StructType([*schema.fields, *fields])).load(path)


def text_tags(df: DataFrame) -> DataFrame:
    """Tags as map<string,string>; stored tags may hold numbers."""
    return df.withColumn("tags", F.col("tags").cast("map<string,string>"))


def read_metric_data(spark: SparkSession, path: str, date: str, last: str | None = None,
                     format: str = "parquet") -> DataFrame:
    """Probe results of the days date..last and of the day before, pruned by partition."""
    md = read_table(spark, path, schemas.METRIC_DATA, format, ("date",))
    return selection.for_date(md, clock.shift(date, -1), last or date)


def read_endpoint_groups(spark: SparkSession, path: str, format: str = "parquet",
                         partitions: tuple[str, ...] = ()) -> DataFrame:
    return text_tags(read_table(spark, path, schemas.ENDPOINT_GROUPS, format, partitions))


def read_group_groups(spark: SparkSession, path: str, format: str = "parquet",
                      partitions: tuple[str, ...] = ()) -> DataFrame:
    return text_tags(read_table(spark, path, schemas.GROUP_GROUPS, format, partitions))


def read_metric_profiles(spark: SparkSession, path: str, format: str = "parquet",
                         partitions: tuple[str, ...] = ()) -> DataFrame:
    """(profile, service, metric), each once."""
    mp = read_table(spark, path, schemas.METRIC_PROFILES, format, partitions)
    return mp.select("profile", "service", "metric", *partitions).distinct()


def parse_downtimes(downtimes: DataFrame) -> DataFrame:
    """Start and end as TIMESTAMP_NTZ."""
    rest = [c for c in downtimes.columns if c not in ("start_time", "end_time")]
    return downtimes.select(*rest, clock.parse_ts(F.col("start_time")).alias("start_ts"),
                            clock.parse_ts(F.col("end_time")).alias("end_ts"))


def read_downtimes(spark: SparkSession, path: str, format: str = "parquet",
                   partitions: tuple[str, ...] = ()) -> DataFrame:
    return parse_downtimes(read_table(spark, path, schemas.DOWNTIMES, format, partitions))


def read_weights(spark: SparkSession, path: str, format: str = "parquet",
                 partitions: tuple[str, ...] = ()) -> DataFrame:
    weights = read_table(spark, path, schemas.WEIGHTS, format, partitions)
    return weights.withColumn("weight", F.col("weight").cast("int"))


def read_recomputations(spark: SparkSession, path: str) -> DataFrame:
    """Recomputation requests from JSON arrays."""
    return spark.read.schema(schemas.RECOMPUTATIONS).json(path, multiLine=True)


# The six ingested tables, and whether each is also kept per report.
INGESTED = {"metric_data": False, "endpoint_groups": True, "group_groups": True,
            "metric_profiles": True, "downtimes": True, "weights": True}


def register_tables(spark: SparkSession, root: str, format: str = "parquet") -> list[str]:
    """Make the ingested tables below ``root`` queryable by name; returns the names."""
    names = []
    for name, per_report in INGESTED.items():
        partitions = ("report", "date") if per_report else ("date",)
        table = read_table(spark, f"{root}/{name}", schemas.PAYLOADS[name], format, partitions)
        table.createOrReplaceTempView(name)
        names.append(name)
    return names


def create_tables(spark: SparkSession, root: str, database: str, format: str = "parquet") -> list[str]:
    """The ingested tables below ``root`` as external tables of the catalog, partitioned by date, and by
    report where they are kept per report; returns their names. They outlive the session where the catalog does.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    for name, per_report in INGESTED.items():
        fields = [*schemas.PAYLOADS[name].fields, *([T.StructField("report", T.StringType())] if per_report else []),
                  T.StructField("date", T.DateType())]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        parts = ", ".join(["report", "date"] if per_report else ["date"])
        names.append(f"`{database}`.{name}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {names[-1]} ({columns}) USING {format} PARTITIONED BY ({parts}) LOCATION '{root}/{name}'")
    repair_tables(spark, names)
    return names


def repair_tables(spark: SparkSession, names: list[str]) -> None:
    """Lets the catalog see partitions that have landed since."""
    for name in names:
        spark.catalog.recoverPartitions(name)
