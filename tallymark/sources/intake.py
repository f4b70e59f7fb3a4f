"""Raw event requests to accepted events and reasons for refusal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions import values as V
from tallymark.operators.skew import keyed_join
from tallymark.schemas import EVENT_MESSAGE

# The fields a request may carry, and the shape of ids.
REQUEST_FIELDS = ["eventId", "eventType", "customerId", "eventTime", "metadata", "source"]
UUID_PATTERN = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[1-8][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


def validate_requests(raw: DataFrame, ingested_at, body: str = "body") -> DataFrame:
    """Parsed requests with ``reason``; null reason means accepted.

    The body is parsed once into a variant, which keeps the type of every field.
    """
    parsed = raw.withColumn("_body", F.try_parse_json(body)).withColumn("ingestion_time", V.moment(ingested_at))
    fields = F.json_object_keys(body)

    def kind(name: str) -> Column:
        return F.schema_of_variant(F.try_variant_get("_body", f"$.{name}", "variant"))

    def text(name: str) -> Column:
        return F.try_variant_get("_body", f"$.{name}", "string")

    def given(name: str) -> Column:
        return kind(name).isNotNull() & (kind(name) != "VOID")

    is_object = F.schema_of_variant("_body").startswith("OBJECT")
    event_time = V.parse_iso(text("eventTime"))
    time_ok = (kind("eventTime") == "STRING") & event_time.isNotNull()
    unknown = F.size(F.array_except(fields, F.array(*[F.lit(f) for f in REQUEST_FIELDS]))) > 0
    reason = (
        F.when(F.col("_body").isNull() | ~is_object, "MALFORMED_BODY")
        .when(unknown, "UNKNOWN_FIELD")
        .when(~_true((kind("eventId") == "STRING") & text("eventId").rlike(UUID_PATTERN)), "INVALID_EVENT_ID")
        .when(~_true((kind("eventType") == "STRING") & (text("eventType") != "")), "INVALID_EVENT_TYPE")
        .when(~_true((kind("customerId") == "STRING") & text("customerId").rlike(UUID_PATTERN)), "INVALID_CUSTOMER_ID")
        .when(~_true(time_ok), "INVALID_EVENT_TIME")
        .when(_true(event_time > F.col("ingestion_time") + F.expr("interval 1 day")), "INVALID_EVENT_TIME")
        .when(given("metadata") & ~_true(kind("metadata").startswith("OBJECT")), "INVALID_METADATA")
        .when(given("source") & ~_true(kind("source") == "STRING"), "INVALID_SOURCE")
    )
    return parsed.select(
        *raw.columns,
        text("eventId").alias("event_id"),
        text("eventType").alias("event_type"),
        text("customerId").alias("customer_id"),
        event_time.alias("event_time"),
        F.col("ingestion_time"),
        F.when(given("metadata"), F.try_variant_get("_body", "$.metadata", "string")).otherwise("{}").alias("metadata"),
        F.nullif(text("source"), F.lit("")).alias("source"),
        reason.alias("reason"),
    )


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def split_requests(raw: DataFrame, ingested_at, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(accepted events, refused requests with reason)."""
    judged = validate_requests(raw, ingested_at, body)
    accepted = judged.filter(F.col("reason").isNull()).drop("reason", body)
    return accepted, judged.filter(F.col("reason").isNotNull()).select(*raw.columns, "event_id", "reason")


def decode_messages(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(events, dead letters) from JSON messages; an unreadable message stops nothing."""
    # Exploded, so that a message is parsed once and not again for every use of a field.
    decoded = messages.withColumn("_event", F.explode(F.array(F.from_json(F.col(value).cast("string"), EVENT_MESSAGE))))
    event_time = V.parse_iso("_event.eventTime")
    broken = F.col("_event.eventId").isNull() | event_time.isNull()
    events = decoded.filter(~broken).select(
        F.col("_event.eventId").alias("event_id"),
        F.col("_event.eventType").alias("event_type"),
        F.col("_event.customerId").alias("customer_id"),
        event_time.alias("event_time"),
        V.parse_iso("_event.ingestionTime").alias("ingestion_time"),
        F.coalesce("_event.metadata", F.lit("{}")).alias("metadata"),
        F.col("_event.source").alias("source"),
        # Only late events carry when they were received and what refused them.
        V.parse_iso("_event.receivedAt").alias("received_at"),
        V.parse_iso("_event.watermark").alias("watermark"),
    )
    return events, decoded.filter(broken).select(*messages.columns)


def with_metric(events: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Metric of an event: its type, or what a small (event_type, metric_type) table says."""
    if mapping is None:
        return events.withColumn("metric_type", F.col("event_type"))
    names = mapping.select("event_type", F.col("metric_type").alias("_mapped"))
    joined = keyed_join(events, names, ["event_type"], ["event_id"])
    return joined.withColumn("metric_type", F.coalesce("_mapped", "event_type")).drop("_mapped")
