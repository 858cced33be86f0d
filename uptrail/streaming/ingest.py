"""Ingestion of message envelopes: decode, quarantine, route to dated directories."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from uptrail import schemas

HEADER_PREFIX = "attr_"
ROLL = "30 minutes"


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Stream of envelope texts from files, one JSON object per line."""
    return spark.readStream.format("text").load(path)


def read_topic(spark: SparkSession, servers: str, tenant: str, kind: str,
               per_trigger: int | None = None) -> DataFrame:
    """Stream of envelope texts from the topic of a tenant and payload kind.

    Needs the Kafka package on the class path.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", f"{tenant}.{kind}"))
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def decode_payload(data: Column) -> Column:
    """Text of a base64 payload, null when it is not base64."""
    return F.try_to_binary(data, F.lit("base64")).cast("string")


def decode_envelope(df: DataFrame, schema_root: str = "",
                    prefix: str = HEADER_PREFIX) -> DataFrame:
    """Body and headers of each envelope.

    Every attribute becomes a header, its name behind ``prefix``; the reference to the payload's schema is one more. A message
    that cannot be read keeps its raw text and has a null body.
    """
    parsed = F.from_json("value", schemas.ENVELOPE)
    named = F.transform_keys("e.attributes", lambda k, _: F.concat(F.lit(prefix), k))
    body = decode_payload(F.col("e.data"))
    reference = F.concat(F.lit(schema_root), F.try_element_at("e.attributes", F.lit("type")),
                         F.lit(".avsc"))
    usable = F.col("e.attributes").isNotNull() & body.isNotNull()
    return df.withColumn("e", parsed).select(
        F.col("value").alias("raw"), F.when(usable, body).alias("body"),
        F.when(usable, named).alias("headers"),
        F.when(usable, reference).alias("schema_url"),
        F.when(usable, F.try_element_at("e.attributes", F.lit("type"))).alias("type"),
        F.when(usable, F.try_element_at("e.attributes", F.lit("partition_date"))).alias("date"))


def payload_rows(decoded: DataFrame, kind: str) -> DataFrame:
    """Typed rows of one payload kind (JSON bodies), with their partition date."""
    row = F.from_json("body", schemas.PAYLOADS[kind])
    return (decoded.where(F.col("type") == kind).select(row.alias("row"), "date")
            .select("row.*", F.col("date").cast("date").alias("date")))


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.where("body IS NULL").select("raw")


def land_stream(decoded: DataFrame, path: str, checkpoint: str,
                once: bool = False) -> StreamingQuery:
    """Write decoded messages to type= and date= directories.

    Unreadable ones go to a partition of their own, so nothing is lost. ``once`` takes what is
    there and stops; otherwise a batch is written every half hour.
    """
    routed = decoded.select("raw", "body", "schema_url",
                            F.coalesce("type", F.lit("unreadable")).alias("type"),
                            F.coalesce("date", F.lit("none")).alias("date"))
    writer = (routed.writeStream.format("parquet").partitionBy("type", "date")
              .option("path", path).option("checkpointLocation", checkpoint))
    trigger = {"availableNow": True} if once else {"processingTime": ROLL}
    return writer.trigger(**trigger).start()


def refresh_stream(decoded: DataFrame, run_day: Callable[[list[str]], None], checkpoint: str,
                   once: bool = False, every: str = "1 hour") -> StreamingQuery:
    """Run the daily jobs again for the days a batch touches.

    ``run_day`` gets the touched days (a handful of texts); results are replaced per day, so a
    batch that is tried again changes nothing.
    """
    def batch(df: DataFrame, _epoch: int) -> None:
        days = [row.date for row in df.where("date IS NOT NULL").select("date").distinct()
                .orderBy("date").collect()]
        if days:
            run_day(days)

    trigger = {"availableNow": True} if once else {"processingTime": every}
    return (decoded.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())
