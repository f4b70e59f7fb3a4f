"""Messages in and out: JSON values on a topic or in a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions import values as V


def event_message() -> Column:
    """Accepted event as message value."""
    return F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("eventId"),
            F.col("event_type").alias("eventType"),
            F.col("customer_id").cast("string").alias("customerId"),
            V.iso("event_time").alias("eventTime"),
            V.iso("ingestion_time").alias("ingestionTime"),
            F.parse_json("metadata").alias("metadata"),
            F.col("source").alias("source"),
        )
    )


def late_message() -> Column:
    """Late event with receipt time and watermark."""
    return F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("eventId"),
            F.col("event_type").alias("eventType"),
            F.col("customer_id").cast("string").alias("customerId"),
            V.iso("event_time").alias("eventTime"),
            F.parse_json("metadata").alias("metadata"),
            V.iso("received_at").alias("receivedAt"),
            V.iso("watermark").alias("watermark"),
        )
    )


def usage_message() -> Column:
    """Final usage window; the event ids stay in their own table."""
    return F.to_json(
        F.struct(
            F.col("aggregation_id").alias("aggregationId"),
            F.col("customer_id").cast("string").alias("customerId"),
            F.col("metric_type").alias("metricType"),
            V.iso("window_start").alias("windowStart"),
            V.iso("window_end").alias("windowEnd"),
            F.col("value").cast("string").alias("value"),
            F.col("unit").alias("unit"),
            F.col("event_count").alias("eventCount"),
            F.col("is_final").alias("isFinal"),
        )
    )


def messages(rows: DataFrame, value: Column, key: str = "customer_id", sent_at=None) -> DataFrame:
    """(key, value, sent_at): keyed, so that one customer's messages keep their order."""
    sent = F.current_timestamp() if sent_at is None else V.moment(sent_at)
    return rows.select(F.col(key).cast("string").alias("key"), value.alias("value"), sent.alias("sent_at"))


def send(rows: DataFrame, target: str, servers: str | None = None) -> None:
    """Append messages to a topic, or to a folder of JSON lines when no server is given."""
    if servers:
        rows.select("key", "value").write.format("kafka").options(
            **{"kafka.bootstrap.servers": servers, "topic": target}
        ).save()
    else:
        rows.select("key", "value", "sent_at").write.mode("append").json(target)


MESSAGE = "key string, value string, sent_at timestamp"


def receive(spark: SparkSession, source: str, servers: str | None = None, from_start: bool = False) -> DataFrame:
    """Stream of messages from a topic (latest offset by default) or a folder of JSON lines."""
    if servers:
        offsets = "earliest" if from_start else "latest"
        options = {"kafka.bootstrap.servers": servers, "subscribe": source, "startingOffsets": offsets}
        return spark.readStream.format("kafka").options(**options).load().selectExpr(
            "cast(key as string) key", "cast(value as string) value", "timestamp sent_at"
        )
    return spark.readStream.schema(MESSAGE).json(source)
