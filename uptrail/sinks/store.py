"""Result tables on files.

Results are kept by (report, date): a run replaces exactly the partitions it wrote. So running a day
again, or running it on two attempts, leaves one copy, as an upsert on the result key would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# Partition columns and row key of each result table.
TABLES: dict[str, tuple[list[str], list[str]]] = {
    "service_ar": (["report", "date"], ["name", "supergroup"]),
    "endpoint_group_ar": (["report", "date"], ["name", "supergroup"]),
    "status_metrics": (["report", "date_integer"],
                       ["endpoint_group", "service", "host", "metric", "timestamp"]),
    "status_endpoints": (["report", "date_integer"],
                         ["endpoint_group", "service", "host", "timestamp"]),
    "status_services": (["report", "date_integer"], ["endpoint_group", "service", "timestamp"]),
    "status_endpoint_groups": (["report", "date_integer"], ["endpoint_group", "timestamp"]),
}


def overwrite_partitions(df: DataFrame, path: str, partitions: list[str],
                         format: str = "parquet") -> None:
    """Replace the partitions present in ``df``, leave the others alone.

    Rows are brought together by partition in shares of about the advisory size: a large report is
    many files, a small one is one.
    """
    (df.hint("rebalance", *partitions).write.format(format)
     .mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).save(path))


def upsert(df: DataFrame, root: str, table: str) -> None:
    """Write one of the result tables."""
    partitions, _ = TABLES[table]
    overwrite_partitions(df, f"{root}/{table}", partitions)


def read_results(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A result table as it was written: report ids stay texts, whatever they look like."""
    path = f"{root}/{table}"
    kinds = {"report": StringType(), **{c: IntegerType() for c in TABLES[table][0] if c != "report"}}
    found = spark.read.parquet(path).schema
    return spark.read.schema(StructType([StructField(f.name, kinds.get(f.name, f.dataType)) for f in found])).parquet(path)


def append(df: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    df.write.mode("append").partitionBy(*(partitions or [])).parquet(path)


def merge_rows(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Row-level upsert: fresh rows, and stored rows with no fresh row on their key."""
    return stored.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def delete_results(spark: SparkSession, root: str, table: str, date: int,
                   report: str | None = None) -> int:
    """Delete a day, optionally of one report only; returns the number of rows deleted.

    The partition directories are removed through the file system Spark uses, under the names that
    Spark gives them. Rows that are still there afterwards are an error.
    """
    partitions, _ = TABLES[table]
    stored = read_results(spark, root, table)
    hit = F.col(partitions[1]) == date
    if report is not None:
        hit = hit & (F.col("report") == report)
    rows = stored.where(hit)
    count = rows.count()
    if count:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for found, in rows.select("report").distinct().collect():  # one name per report
            name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString("report", found)
            path = jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/{name}/{partitions[1]}={date}")
            path.getFileSystem(conf).delete(path, True)
        parts = jvm.org.apache.hadoop.fs.Path(f"{root}/{table}/report=*/*=*")
        left = parts.getFileSystem(conf).globStatus(parts)
        if left and read_results(spark, root, table).where(hit).count():
            raise OSError(f"rows of {date} are still in {root}/{table}")
    return count


def write_landing(df: DataFrame, root: str, per_report: bool = False) -> None:
    """Raw landing, one directory per date (and per report for dimensions)."""
    overwrite_partitions(df, root, ["report", "date"] if per_report else ["date"])
