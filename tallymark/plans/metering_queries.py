"""Intake, deduplication, lateness and usage windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.functions import money as M
from tallymark.functions import values as V
from tallymark.operators import analytics, dedup, metering, reconcile
from tallymark.plans import workload as W
from tallymark.plans.registry import iso_sql, placed, query, ts, ts_sql
from tallymark.session import materialise, work_path
from tallymark.sources import intake, retention, tables, topics

AS_OF = "2024-01-20 12:30:00"

# --- intake ----------------------------------------------------------------------------


def _raw_requests(spark, sf_dir):
    """Every event as a request body; some of them broken in one of nine ways."""
    kind = F.col("event_id") % 20
    hexes = F.lpad(F.hex("event_id"), 12, "0")
    event_uuid = F.concat(F.lit("11111111-2222-4333-8444-"), F.lower(hexes))
    customer_uuid = F.concat(F.lit("aaaaaaaa-bbbb-4ccc-8ddd-"), F.lpad(F.hex("customer_id"), 12, "0"))

    def field(name, value):
        return F.concat(F.lit(f'"{name}":'), value)

    def text(value):
        return F.concat(F.lit('"'), value, F.lit('"'))

    parts = F.array(
        field("eventId", text(F.when(kind == 1, "not-a-uuid").otherwise(event_uuid))),
        F.when(kind != 2, field("eventType", text(F.when(kind == 3, "").otherwise(F.col("event_type"))))),
        field("customerId", F.when(kind == 4, F.lit("17")).otherwise(text(customer_uuid))),
        field("eventTime", text(F.when(kind == 5, "2024-13-45T00:00:00Z").when(kind == 6, "2031-01-01T00:00:00Z").otherwise(V.iso("event_time")))),
        F.when(kind == 7, field("metadata", F.lit("[1,2]"))).when(kind != 10, field("metadata", F.col("props"))),
        F.when(kind == 8, field("source", F.lit("5"))).when(kind == 11, field("source", F.lit("null"))).when(
            kind == 12, field("source", text(F.lit("gateway")))
        ),
        F.when(kind == 9, field("color", text(F.lit("red")))),
    )
    body = F.when(kind == 0, F.lit('{"eventId":')).otherwise(
        F.concat(F.lit("{"), F.array_join(F.array_compact(parts), ","), F.lit("}"))
    )
    return W.telemetry(spark, sf_dir).select(F.col("event_id").alias("request_id"), "ingestion_time", body.alias("body"))


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT event_id AS request_id, printf('11111111-2222-4333-8444-%012x', event_id) AS event_id,
              event_type, {ts_sql("date_trunc('millisecond', event_time)")} AS event_time,
              CASE WHEN event_id % 20 = 10 THEN '{{}}' ELSE replace(props, ' ', '') END AS metadata,
              CASE WHEN event_id % 20 = 12 THEN 'gateway' END AS source
            FROM telemetry WHERE event_id % 20 >= 10""",
    )
)
def intake_accepted(spark, sf_dir):
    """Requests that pass all checks, with defaults filled in."""
    raw = _raw_requests(spark, sf_dir)
    accepted, _ = intake.split_requests(raw.withColumnRenamed("ingestion_time", "at"), F.col("at"))
    return accepted.select("request_id", "event_id", "event_type", ts("event_time", "event_time"), "metadata", "source")


@query(
    W.sql(
        ["telemetry"],
        """SELECT event_id AS request_id, CASE event_id % 20 WHEN 0 THEN 'MALFORMED_BODY' WHEN 1 THEN 'INVALID_EVENT_ID'
             WHEN 2 THEN 'INVALID_EVENT_TYPE' WHEN 3 THEN 'INVALID_EVENT_TYPE' WHEN 4 THEN 'INVALID_CUSTOMER_ID'
             WHEN 5 THEN 'INVALID_EVENT_TIME' WHEN 6 THEN 'INVALID_EVENT_TIME' WHEN 7 THEN 'INVALID_METADATA'
             WHEN 8 THEN 'INVALID_SOURCE' ELSE 'UNKNOWN_FIELD' END AS reason
           FROM telemetry WHERE event_id % 20 < 10""",
    )
)
def intake_refused(spark, sf_dir):
    """Requests that fail a check, with the first reason."""
    raw = _raw_requests(spark, sf_dir)
    _, refused = intake.split_requests(raw.withColumnRenamed("ingestion_time", "at"), F.col("at"))
    return refused.select("request_id", "reason")


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(customer_id AS VARCHAR) AS customer_id,
              {ts_sql("date_trunc('millisecond', event_time)")} AS event_time,
              {ts_sql("date_trunc('millisecond', ingestion_time)")} AS ingestion_time, replace(props, ' ', '') AS metadata
            FROM telemetry WHERE event_id % 50 <> 0""",
    )
)
def message_round_trip(spark, sf_dir):
    """Events sent as JSON messages and decoded again; damaged ones are set aside."""
    events = W.telemetry(spark, sf_dir).withColumns({"metadata": F.col("props"), "source": F.lit(None).cast("string")})
    value = F.when(F.col("event_id") % 50 == 0, F.lit("{broken")).otherwise(topics.event_message())
    sent = topics.messages(events, value, sent_at=F.col("ingestion_time"))
    decoded, _ = intake.decode_messages(sent)
    return decoded.select("event_id", "event_type", "customer_id", ts("event_time", "event_time"), ts("ingestion_time", "ingestion_time"), "metadata")


@query(W.sql(["telemetry"], "SELECT CAST(customer_id AS VARCHAR) AS key, count(*) AS dead FROM telemetry WHERE event_id % 50 = 0 GROUP BY 1"))
def message_dead_letters(spark, sf_dir):
    """Undecodable messages per message key."""
    events = W.telemetry(spark, sf_dir).withColumn("source", F.lit(None).cast("string"))
    value = F.when(F.col("event_id") % 50 == 0, F.lit("{broken")).otherwise(topics.event_message())
    _, dead = intake.decode_messages(topics.messages(events, value, sent_at=F.col("ingestion_time")))
    return dead.groupBy("key").agg(F.count(F.lit(1)).alias("dead"))


# --- duplicates ------------------------------------------------------------------------


def _with_copies(spark, sf_dir):
    events = W.telemetry(spark, sf_dir).drop("metadata", "props")
    later = events.filter("event_id % 10 = 0").withColumn("ingestion_time", F.col("ingestion_time") + F.expr("interval 1 hour"))
    return events.unionByName(later).unionByName(events.filter("event_id % 30 = 0"))


_COPIES = {
    "copies": """SELECT event_id, event_type, customer_id, event_time, ingestion_time, value FROM telemetry
      UNION ALL SELECT event_id, event_type, customer_id, event_time, ingestion_time + INTERVAL 1 HOUR, value FROM telemetry WHERE event_id % 10 = 0
      UNION ALL SELECT event_id, event_type, customer_id, event_time, ingestion_time, value FROM telemetry WHERE event_id % 30 = 0"""
}


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT event_id, customer_id, {ts_sql('ingestion_time')} AS ingestion_time FROM copies
            QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time) = 1""",
        _COPIES,
    )
)
def event_first_copies(spark, sf_dir):
    """Events once each, the first arrival winning."""
    return dedup.first_copies(_with_copies(spark, sf_dir)).select("event_id", "customer_id", ts("ingestion_time", "ingestion_time"))


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT event_id, {ts_sql('ingestion_time')} AS ingestion_time, count(*) AS copies, 'DUPLICATE_EVENT_ID' AS reason
            FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time) AS n FROM copies) WHERE n > 1
            GROUP BY event_id, ingestion_time""",
        _COPIES,
    )
)
def event_refused_copies(spark, sf_dir):
    """Copies refused as duplicates."""
    later = dedup.later_copies(_with_copies(spark, sf_dir))
    return later.select("event_id", ts("ingestion_time", "ingestion_time"), "copies", "reason")


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT event_id, count(*) AS copies, {ts_sql('min(ingestion_time)')} AS first_arrival, {ts_sql('max(ingestion_time)')} AS last_arrival
            FROM copies GROUP BY event_id HAVING count(*) > 1""",
        _COPIES,
    )
)
def event_conflicts(spark, sf_dir):
    """Repeated event ids with their copies."""
    return dedup.conflicts(_with_copies(spark, sf_dir)).select(
        "event_id", "copies", ts("first_arrival", "first_arrival"), ts("last_arrival", "last_arrival")
    )


@query(
    W.sql(
        ["telemetry"],
        "SELECT event_id, customer_id, value FROM telemetry t WHERE NOT EXISTS (SELECT 1 FROM telemetry s WHERE s.event_id = t.event_id AND s.event_time < TIMESTAMP '2024-01-21')",
    )
)
def events_not_stored(spark, sf_dir):
    """Events whose id is not in the stored part of the table."""
    events = W.telemetry(spark, sf_dir)
    stored = events.filter(F.col("event_time") < "2024-01-21")
    return dedup.not_stored(events, stored).select("event_id", "customer_id", "value")


@query(W.sql(["telemetry"], "SELECT count(*) AS refused, min(event_id) AS lowest, max(event_id) AS highest FROM telemetry WHERE event_time < TIMESTAMP '2024-01-21'"))
def events_already_stored(spark, sf_dir):
    """Events refused because their id is stored."""
    events = W.telemetry(spark, sf_dir)
    known = dedup.already_stored(events, events.filter(F.col("event_time") < "2024-01-21"))
    return known.agg(F.count(F.lit(1)).alias("refused"), F.min("event_id").alias("lowest"), F.max("event_id").alias("highest"))


# --- search ----------------------------------------------------------------------------


@query(
    W.sql(
        ["telemetry"],
        f"SELECT event_id, customer_id, event_type, {ts_sql('event_time')} AS event_time, CAST(row_number() OVER (ORDER BY telemetry.event_time DESC, event_id) AS INTEGER) AS place FROM telemetry WHERE event_type = 'purchase' ORDER BY telemetry.event_time DESC, event_id LIMIT 100",
    )
)
def event_search(spark, sf_dir):
    """Newest 100 purchases."""
    found = analytics.search_events(W.telemetry(spark, sf_dir), event_type="purchase")
    return placed(found, few=True).select("event_id", "customer_id", "event_type", ts("event_time", "event_time"), "place")


@query(
    W.sql(
        ["telemetry"],
        f"SELECT event_id, {ts_sql('event_time')} AS event_time FROM telemetry WHERE customer_id = 7 AND event_type = 'view' ORDER BY telemetry.event_time DESC, event_id LIMIT 5",
    )
)
def event_search_customer(spark, sf_dir):
    """Newest five views of one customer."""
    found = analytics.search_events(W.telemetry(spark, sf_dir), 7, "view", 5)
    return found.select("event_id", ts("event_time", "event_time"))


@query(W.sql(["telemetry"], "SELECT least(count(*), 100) AS count FROM telemetry WHERE event_type = 'click'"))
def event_search_count(spark, sf_dir):
    """Number of events a search returns."""
    return analytics.search_count(W.telemetry(spark, sf_dir), event_type="click")


@query(
    W.sql(
        ["telemetry", "customers"],
        """SELECT event_id, 'found' AS outcome FROM telemetry WHERE event_id IN (SELECT customer_id * 11 FROM customers)
           UNION ALL SELECT customer_id * 11, 'missing' FROM customers WHERE customer_id * 11 NOT IN (SELECT event_id FROM telemetry)""",
    )
)
def event_lookup_many(spark, sf_dir):
    """Events by a list of ids, and the ids without an event."""
    ids = W.customers(spark, sf_dir).select((F.col("customer_id") * 11).alias("event_id"))
    found, missing = analytics.lookup_many(W.telemetry(spark, sf_dir), ids, "event_id")
    return found.select("event_id", F.lit("found").alias("outcome")).unionByName(
        missing.select("event_id", F.lit("missing").alias("outcome"))
    )


# --- lateness --------------------------------------------------------------------------


@query(
    W.sql(
        ["judged"],
        f"""SELECT event_id, customer_id, {ts_sql('event_time')} AS event_time, {ts_sql('ingestion_time')} AS received_at,
              {ts_sql('ingestion_time - INTERVAL 1 HOUR')} AS watermark FROM judged WHERE late""",
    )
)
def late_events(spark, sf_dir):
    """Events whose window had started before the watermark on arrival."""
    arrival = F.col("ingestion_time")
    _, late = metering.split_late(W.telemetry(spark, sf_dir), arrival)
    return metering.late_envelope(late, arrival).select(
        "event_id", "customer_id", ts("event_time", "event_time"), ts("received_at", "received_at"), ts("watermark", "watermark")
    )


@query(
    W.sql(
        ["judged"],
        f"""SELECT event_id, '{{"eventId":"' || event_id || '","eventType":"' || event_type || '","customerId":"' || customer_id
              || '","eventTime":"' || {iso_sql('event_time')} || '","metadata":' || replace(props, ' ', '')
              || ',"receivedAt":"' || {iso_sql('ingestion_time')} || '","watermark":"' || {iso_sql('ingestion_time - INTERVAL 1 HOUR')} || '"}}' AS message
            FROM judged WHERE late""",
    )
)
def late_messages(spark, sf_dir):
    """Late events as messages."""
    arrival = F.col("ingestion_time")
    events = W.telemetry(spark, sf_dir).withColumn("metadata", F.col("props"))
    _, late = metering.split_late(events, arrival)
    return metering.late_envelope(late, arrival).select("event_id", topics.late_message().alias("message"))


@query(
    W.sql(
        ["judged"],
        """SELECT event_type, count(*) AS events, count(*) FILTER (late) AS late_events FROM judged GROUP BY event_type""",
    )
)
def late_share_by_type(spark, sf_dir):
    """Events and late events per type."""
    late = metering.is_late(F.col("ingestion_time"))
    return W.telemetry(spark, sf_dir).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(late).alias("late_events")
    )


# --- usage -----------------------------------------------------------------------------


def on_time_usage(spark, sf_dir, size="1 hour"):
    on_time, _ = metering.split_late(W.telemetry(spark, sf_dir), F.col("ingestion_time"))
    return metering.meter(on_time, size)


@query(
    W.sql(
        ["usage"],
        f"""SELECT aggregation_id, customer_id, metric_type, {ts_sql('window_start')} AS window_start, {ts_sql('window_end')} AS window_end,
              value, unit, event_count FROM usage""",
    )
)
def usage_hourly(spark, sf_dir):
    """Usage of on-time events per customer, metric and hour."""
    return on_time_usage(spark, sf_dir).select(
        "aggregation_id", "customer_id", "metric_type", ts("window_start", "window_start"), ts("window_end", "window_end"), "value", "unit", "event_count"
    )


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT customer_id, metric_type, {ts_sql("date_trunc('day', event_time)")} AS window_start,
              CAST(CASE WHEN metric_type IN ('api_calls','bandwidth_mb','compute_hours') THEN sum(value)
                WHEN metric_type = 'storage_gb_peak' THEN greatest(max(value), 0) ELSE count(*) END AS DECIMAL(20,6)) AS value,
              count(*) AS event_count, CAST(CAST((2 * sum(CAST(value * 1000000 AS HUGEINT)) + count(*)) // (2 * count(*)) AS DECIMAL(20,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(20,6)) AS average_value
            FROM telemetry GROUP BY customer_id, metric_type, date_trunc('day', event_time)""",
    )
)
def usage_daily_average(spark, sf_dir):
    """Daily usage with the average event value."""
    usage = metering.meter(W.telemetry(spark, sf_dir), "1 day", with_average=True)
    return usage.select(
        "customer_id", "metric_type", ts("window_start", "window_start"), "value", "event_count",
        "average_value",
    )


@query(
    W.sql(
        ["usage", "judged"],
        """SELECT u.aggregation_id, j.event_id FROM usage u JOIN judged j ON j.customer_id = u.customer_id AND j.metric_type = u.metric_type
             AND date_trunc('hour', j.event_time) = u.window_start WHERE NOT j.late""",
    )
)
def usage_event_ids(spark, sf_dir):
    """Which events every usage window counted."""
    on_time, _ = metering.split_late(W.telemetry(spark, sf_dir), F.col("ingestion_time"))
    return metering.usage_events(on_time)


@query(
    W.sql(
        ["usage"],
        f"""SELECT aggregation_id, window_end <= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR AS is_final FROM usage""",
    )
)
def usage_finalised(spark, sf_dir):
    """Final flag of every window at a processing time."""
    return metering.finalise(on_time_usage(spark, sf_dir), AS_OF).select("aggregation_id", "is_final")


@query(
    W.sql(
        ["usage"],
        f"""SELECT aggregation_id FROM usage WHERE window_end <= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR
              AND window_end > TIMESTAMP '2024-01-18 00:00:00'""",
    )
)
def usage_finalisable(spark, sf_dir):
    """Windows an earlier run left open that are due now."""
    earlier = metering.finalise(on_time_usage(spark, sf_dir), "2024-01-18 01:00:00")
    return metering.finalisable(earlier, AS_OF).select("aggregation_id")


@query(
    W.sql(
        ["usage"],
        f"""SELECT '{{"aggregationId":"' || aggregation_id || '","customerId":"' || customer_id || '","metricType":"' || metric_type
              || '","windowStart":"' || {iso_sql('window_start')} || '","windowEnd":"' || {iso_sql('window_end')} || '","value":"' || value
              || '","unit":"' || unit || '","eventCount":' || event_count || ',"isFinal":true}}' AS message
            FROM usage WHERE window_end <= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR""",
    )
)
def usage_messages(spark, sf_dir):
    """Final windows as messages."""
    final = metering.finalise(on_time_usage(spark, sf_dir), AS_OF).filter("is_final")
    return final.select(topics.usage_message().alias("message"))


@query(
    W.sql(
        ["usage"],
        f"""SELECT customer_id, metric_type, {ts_sql("date_trunc('month', window_start)")} AS month, CAST(sum(value) AS DECIMAL(28,6)) AS total_usage,
              count(*) AS aggregation_count, {ts_sql('max(window_end)')} AS last_window_end
            FROM usage WHERE window_end <= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR GROUP BY customer_id, metric_type, date_trunc('month', window_start)""",
    )
)
def usage_monthly(spark, sf_dir):
    """Monthly summary of final usage."""
    monthly = analytics.monthly_usage(metering.finalise(on_time_usage(spark, sf_dir), AS_OF))
    return monthly.select("customer_id", "metric_type", ts("month", "month"), "total_usage", "aggregation_count", ts("last_window_end", "last_window_end"))


@query(
    W.sql(
        ["usage"],
        f"""SELECT metric_type, {ts_sql('window_start')} AS window_start, value, window_end <= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR AS is_final
            FROM usage WHERE customer_id = 3""",
    )
)
def usage_of_customer(spark, sf_dir):
    """Usage list of one customer."""
    usage = metering.finalise(on_time_usage(spark, sf_dir), AS_OF)
    return analytics.usage_of_customer(usage, 3).select("metric_type", ts("window_start", "window_start"), "value", "is_final")


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT metric_type, {ts_sql('s')} AS window_start, {ts_sql('s + INTERVAL 15 MINUTE')} AS window_end, count(*) AS event_count,
              CAST(sum(value) AS DECIMAL(20,6)) AS sum_value, CAST(CAST((2 * sum(CAST(value * 1000000 AS HUGEINT)) + count(*)) // (2 * count(*)) AS DECIMAL(20,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(20,6)) AS average_value
            FROM (SELECT metric_type, value, unnest([time_bucket(INTERVAL 5 MINUTE, event_time) - INTERVAL 10 MINUTE,
                    time_bucket(INTERVAL 5 MINUTE, event_time) - INTERVAL 5 MINUTE, time_bucket(INTERVAL 5 MINUTE, event_time)]) AS s FROM telemetry)
            GROUP BY metric_type, s""",
    )
)
def usage_sliding(spark, sf_dir):
    """Fifteen-minute windows every five minutes, per metric."""
    windows = metering.sliding_usage(W.telemetry(spark, sf_dir), 15, 5, ["metric_type"])
    return windows.select(
        "metric_type", ts("window_start", "window_start"), ts("window_end", "window_end"), "event_count", "sum_value",
        "average_value",
    )


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT customer_id, {ts_sql('min(event_time)')} AS session_start, {ts_sql('max(event_time) + INTERVAL 2 HOUR')} AS session_end,
              count(*) AS event_count, CAST(sum(value) AS DECIMAL(20,6)) AS value
            FROM (SELECT *, sum(CASE WHEN before IS NULL OR event_time >= before + INTERVAL 2 HOUR THEN 1 ELSE 0 END)
                     OVER (PARTITION BY customer_id ORDER BY event_time, event_id) AS session
                  FROM (SELECT *, lag(event_time) OVER (PARTITION BY customer_id ORDER BY event_time, event_id) AS before FROM telemetry))
            GROUP BY customer_id, session""",
    )
)
def usage_sessions(spark, sf_dir):
    """Bursts of a customer's events with gaps below two hours."""
    sessions = metering.session_usage(W.telemetry(spark, sf_dir), 120, ["customer_id"])
    return sessions.select("customer_id", ts("session_start", "session_start"), ts("session_end", "session_end"), "event_count", "value")


@query(
    W.sql(
        ["telemetry"],
        """SELECT customer_id, metric_type, strftime(date_trunc('day', event_time), '%Y-%m-%d') AS day,
             CAST(CASE WHEN metric_type IN ('api_calls','bandwidth_mb','compute_hours') THEN sum(value)
               WHEN metric_type = 'storage_gb_peak' THEN greatest(max(value), 0) ELSE count(*) END AS DECIMAL(20,6)) AS value,
             count(*) AS event_count,
             CAST(CASE WHEN count(*) FILTER (event_id % 4 = 0) IN (0, count(*)) THEN 1 ELSE 2 END AS INTEGER) AS version
           FROM telemetry GROUP BY customer_id, metric_type, date_trunc('day', event_time)""",
    )
)
def usage_versions(spark, sf_dir):
    """Daily windows after a second batch of events: changed windows get the next version."""
    events = W.telemetry(spark, sf_dir)
    first = metering.meter(events.filter("event_id % 4 <> 0"), "1 day").withColumn("version", F.lit(1))
    later = metering.bump_versions(first, metering.meter(events, "1 day"))
    day = F.date_format("window_start", "yyyy-MM-dd").alias("day")
    return later.select("customer_id", "metric_type", day, "value", "event_count", "version")


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT {ts_sql("date_trunc('hour', event_time)")} AS window_start, count(*) AS event_count, {ts_sql('min(event_time)')} AS first_event_at,
              array_to_string(list(event_id ORDER BY event_time, event_id)[1:3], ',') AS first_events
            FROM telemetry GROUP BY date_trunc('hour', event_time)""",
    )
)
def events_per_window(spark, sf_dir):
    """Events per hour with the first three ids."""
    windows = analytics.events_per_window(W.telemetry(spark, sf_dir))
    return windows.select(ts("window_start", "window_start"), "event_count", ts("first_event_at", "first_event_at"), "first_events")


# --- values ----------------------------------------------------------------------------


def _shaped(spark, sf_dir):
    """Events whose metadata value comes in twelve shapes."""
    shapes = ['{}', '{"value":null}', '{"value":""}', '{"value":false}', '{"value":0}', '{"value":"0"}', '{"value":"7.25"}',
              '{"value":true}', '{"value":"many"}', '{"value":0.0}', None, '{"other":3}']
    kind = F.col("event_id") % 12
    metadata = F.when(kind == 10, F.concat(F.lit('{"value":'), F.col("value").cast("decimal(20,2)").cast("string"), F.lit("}")))
    for number, shape in enumerate(shapes):
        if shape is not None:
            metadata = metadata.when(kind == number, shape)
    return W.telemetry(spark, sf_dir).withColumn("metadata", metadata)


@query(
    W.sql(
        ["telemetry"],
        """SELECT event_id, CAST(CASE WHEN metric_type = 'signup' THEN 1 WHEN event_id % 12 IN (0, 1, 2, 3, 4, 9, 11) THEN 1 WHEN event_id % 12 = 5 THEN 0
             WHEN event_id % 12 = 6 THEN 7.25 WHEN event_id % 12 = 10 THEN CASE WHEN value = 0 THEN 1 ELSE value END END AS DECIMAL(20,6)) AS on_time_value,
             CAST(CASE WHEN event_id % 12 IN (0, 1, 11) THEN 1 WHEN event_id % 12 IN (4, 5, 9) THEN 0 WHEN event_id % 12 = 6 THEN 7.25
             WHEN event_id % 12 = 10 THEN value END AS DECIMAL(20,6)) AS late_value
           FROM telemetry""",
    )
)
def event_values(spark, sf_dir):
    """Value of an event on time and late, for every shape of metadata."""
    return _shaped(spark, sf_dir).select(
        "event_id", V.on_time_value("metadata", "metric_type").alias("on_time_value"), V.late_value("metadata").alias("late_value")
    )


@query(
    W.sql(
        ["telemetry"],
        "SELECT metric_type, count(*) AS refused FROM telemetry WHERE event_id % 12 IN (7, 8) AND metric_type <> 'signup' GROUP BY metric_type",
    )
)
def event_values_refused(spark, sf_dir):
    """Events of summed or maximum metrics whose value is not a number."""
    _, refused = metering.event_values(_shaped(spark, sf_dir))
    return refused.groupBy("metric_type").agg(F.count(F.lit(1)).alias("refused"))


@query(
    W.sql(
        ["telemetry"],
        """SELECT metric_type, CASE metric_type WHEN 'api_calls' THEN 'Api Calls usage' WHEN 'bandwidth_mb' THEN 'Bandwidth Mb usage'
             WHEN 'compute_hours' THEN 'Compute Hours usage' WHEN 'storage_gb_peak' THEN 'Storage Gb Peak usage' ELSE 'Signup usage' END AS description,
             CASE metric_type WHEN 'bandwidth_mb' THEN 'megabytes' WHEN 'compute_hours' THEN 'hours' ELSE 'count' END AS unit,
             CASE metric_type WHEN 'signup' THEN 'count' WHEN 'storage_gb_peak' THEN 'max' ELSE 'sum' END AS strategy, count(*) AS events
           FROM telemetry GROUP BY metric_type""",
    )
)
def metric_names(spark, sf_dir):
    """Title, unit and strategy of the metrics in use."""
    counted = W.telemetry(spark, sf_dir).groupBy("metric_type").agg(F.count(F.lit(1)).alias("events"))
    return counted.select(
        "metric_type", V.usage_description("metric_type").alias("description"), V.unit_of("metric_type").alias("unit"),
        V.strategy("metric_type").alias("strategy"), "events",
    )


@query(
    """WITH m AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS DECIMAL(20,6)) AS qty, CAST(l_discount AS DECIMAL(6,4)) AS rate FROM lineitem)
       SELECT l_returnflag, CAST(sum(price) AS DECIMAL(18,2)) AS total, CAST(sum(CAST(price * rate AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS discounts,
         CAST(sum(price - CAST(price * rate AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS net,
         CAST(sum(CAST((CAST(price * 100 AS HUGEINT) * 2 + CAST(l_quantity AS HUGEINT)) // (2 * CAST(l_quantity AS HUGEINT)) AS HUGEINT)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS unit_prices,
         CAST(sum(CASE WHEN price > 50000 THEN 1 WHEN price = 50000 THEN 0 ELSE -1 END) AS BIGINT) AS compared,
         CAST(sum(CAST(qty * CAST(1.5 AS DECIMAL(2,1)) AS DECIMAL(20,6))) AS DECIMAL(28,6)) AS scaled, CAST(sum(greatest(qty, 25)) AS DECIMAL(28,6)) AS floored,
         CAST(sum(qty + CAST(0.5 AS DECIMAL(2,1))) AS DECIMAL(28,6)) AS shifted, count(*) FILTER (price > 50000) AS above, count(*) FILTER (price = 50000) AS equal
       FROM m GROUP BY l_returnflag"""
)
def money_arithmetic(spark, sf_dir):
    """Every money and quantity operation over all line items."""
    rows = W.table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        M.money("l_extendedprice").alias("price"),
        M.quantity("l_quantity").alias("qty"),
        F.col("l_discount").cast("decimal(6,4)").alias("rate"),
    )
    pivot = F.lit("50000.00").cast("decimal(18,2)")
    discount = M.multiply_money("price", "rate")
    return rows.groupBy("l_returnflag").agg(
        M.sum_money("price").alias("total"),
        M.sum_money(discount).alias("discounts"),
        M.sum_money(M.add_money(M.subtract_money("price", discount), M.zero_money())).alias("net"),
        M.sum_money(M.divide_money("price", "qty")).alias("unit_prices"),
        F.sum(M.compare_money("price", pivot)).alias("compared"),
        F.sum(M.multiply_quantity("qty", F.lit("1.5").cast("decimal(2,1)"))).cast("decimal(28,6)").alias("scaled"),
        F.sum(M.max_quantity("qty", F.lit(25))).cast("decimal(28,6)").alias("floored"),
        F.sum(M.add_quantity("qty", F.lit("0.5").cast("decimal(2,1)"), M.zero_quantity())).cast("decimal(28,6)").alias("shifted"),
        F.count_if(M.greater_money("price", pivot)).alias("above"),
        F.count_if(M.equal_money("price", pivot)).alias("equal"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,12)) AS parsed, CAST(l_tax AS DECIMAL(20,4)) AS at_four, CAST(l_tax AS DECIMAL(17,1)) AS at_one,
         l_returnflag = '0' AS flag_is_number FROM lineitem"""
)
def money_precisions(spark, sf_dir):
    """Amounts read from text, and rates at other precisions; what is no number is null."""
    lines = W.table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", M.to_decimal(F.col("l_extendedprice").cast("string")).alias("parsed"), M.money_at("l_tax", 4).alias("at_four"),
        M.money_at("l_tax", 1).alias("at_one"), M.to_decimal("l_returnflag").isNotNull().alias("flag_is_number"),
    )


# --- event tables ----------------------------------------------------------------------


@query(
    W.sql(
        ["telemetry"],
        """SELECT CASE WHEN event_time < TIMESTAMP '2024-02-14' - INTERVAL 30 DAY THEN 'archive' ELSE 'live' END AS part, count(*) AS events,
             CAST(sum(value) AS DECIMAL(28,6)) AS value FROM telemetry GROUP BY 1""",
    )
)
def event_retention(spark, sf_dir):
    """Events older than 30 days go to the archive."""
    live, old = tables.split_by_age(W.telemetry(spark, sf_dir), "event_time", "2024-02-14")
    both = live.withColumn("part", F.lit("live")).unionByName(old.withColumn("part", F.lit("archive")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("events"), F.sum("value").cast("decimal(28,6)").alias("value"))


@query(
    W.sql(
        ["telemetry"],
        """SELECT strftime(event_time, '%Y-%m') AS month, metric_type, count(*) AS events, CAST(count(DISTINCT customer_id) AS BIGINT) AS customers
           FROM telemetry WHERE event_time < TIMESTAMP '2024-02-01' GROUP BY ALL""",
    )
)
def event_table_saved(spark, sf_dir):
    """Events stored by month in two saves and scanned again with the declared columns."""
    path, events = work_path(spark, "events"), W.telemetry(spark, sf_dir)
    for rest in (0, 1):
        tables.write_table(events.filter(F.col("event_id") % 2 == rest), path, "telemetry_events")
    stored = tables.read_table(spark, path, "telemetry_events").filter("month < '2024-02'")
    metric = W.telemetry(spark, sf_dir).select("event_type", "metric_type").distinct()
    return stored.join(F.broadcast(metric), "event_type").groupBy("month", "metric_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("customer_id").alias("customers")
    )


@query(
    W.sql(
        ["telemetry"],
        """SELECT step, CASE WHEN event_time < before THEN 'archive' ELSE 'live' END AS part, count(*) AS events, CAST(sum(value) AS DECIMAL(28,6)) AS value
           FROM telemetry, (VALUES ('1 copied', TIMESTAMP '2024-01-15'), ('2 repeated', TIMESTAMP '2024-01-15'), ('3 next', TIMESTAMP '2024-01-21')) AS steps(step, before)
           GROUP BY ALL""",
    )
)
def event_retention_repeated(spark, sf_dir):
    """Rows of both parts after a run that stopped half-way, after it was repeated, and after the next one."""
    live, archive = work_path(spark, "live"), work_path(spark, "archive")
    tables.write_by_month(W.telemetry(spark, sf_dir), "event_time", live, "overwrite")
    moved = retention.Retention(spark, live, archive, "event_time")

    def parts(step: str):
        both = moved.live().withColumn("part", F.lit("live")).unionByName(moved.archived().withColumn("part", F.lit("archive")))
        counted = both.groupBy("part").agg(F.count(F.lit(1)).alias("events"), F.sum("value").cast("decimal(28,6)").alias("value"))
        # Files change with the next step, so the counts are taken now.
        return materialise(counted.withColumn("step", F.lit(step)))

    moved.copy("first", "2024-02-14")
    found = parts("1 copied")
    for _ in range(2):
        moved.run("first", "2024-02-14")
    found = found.unionByName(parts("2 repeated"))
    moved.run("second", "2024-02-20")
    return found.unionByName(parts("3 next"))


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT count(*) AS event_count, count(*) FILTER (date_trunc('hour', event_time) < ingestion_time - INTERVAL 1 HOUR) AS late_events,
              CAST(max(epoch_us(ingestion_time) - epoch_us(event_time)) / 1000000 AS DECIMAL(18,3)) AS max_lag_seconds,
              CAST(avg((epoch_us(ingestion_time) - epoch_us(event_time)) / 1000000) AS DECIMAL(18,3)) AS mean_lag_seconds,
              CAST(quantile_disc((epoch_us(ingestion_time) - epoch_us(event_time)) / 1000000, 0.99) AS DECIMAL(18,3)) AS p99_lag_seconds,
              quantile_disc((epoch_us(ingestion_time) - epoch_us(event_time)) / 1000000, 0.99) > 300 AS lag_alert,
              count(*) FILTER (date_trunc('hour', event_time) < ingestion_time - INTERVAL 1 HOUR) > 0.01 * count(*) AS late_alert
            FROM telemetry""",
    )
)
def event_quality(spark, sf_dir):
    """Lag and late share, with alerts."""
    metrics = reconcile.quality_metrics(W.telemetry(spark, sf_dir), F.col("ingestion_time"))
    limits = reconcile.alerts(metrics)
    return metrics.drop("late_rate").withColumns(
        {"lag_alert": limits.select("lag_alert").scalar(), "late_alert": limits.select("late_alert").scalar()}
    )


@query(
    W.sql(
        ["telemetry"],
        f"SELECT event_id % 8 AS partition, {ts_sql('max(event_time)')} AS watermark FROM telemetry GROUP BY event_id % 8",
    )
)
def watermark_partitions(spark, sf_dir):
    """Latest event time per source partition."""
    found = reconcile.partition_watermarks(W.telemetry(spark, sf_dir), F.col("event_id") % 8)
    return found.select("partition", ts("watermark", "watermark"))


@query(
    W.sql(
        ["telemetry"],
        f"SELECT {ts_sql('min(w)')} AS watermark, count(*) AS partitions FROM (SELECT max(event_time) AS w FROM telemetry GROUP BY event_id % 8)",
    )
)
def watermark_global(spark, sf_dir):
    """The slowest partition's watermark."""
    found = reconcile.global_watermark(W.telemetry(spark, sf_dir), F.col("event_id") % 8)
    return found.select(ts("watermark", "watermark"), "partitions")


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT partition, {ts_sql('watermark')} AS watermark, {ts_sql('since')} AS since
            FROM (SELECT customer_id AS partition, max(event_time) AS watermark, arg_max(ingestion_time, (event_time, -epoch_us(ingestion_time))) AS since
                  FROM telemetry GROUP BY customer_id) WHERE since < TIMESTAMP '2024-01-30 18:00:00' - INTERVAL 30 MINUTE""",
    )
)
def watermark_stuck(spark, sf_dir):
    """Sources whose watermark has not moved for thirty minutes."""
    progress = W.telemetry(spark, sf_dir).select(
        F.col("customer_id").alias("partition"), F.col("ingestion_time").alias("observed_at"), F.col("event_time").alias("watermark")
    )
    stuck = reconcile.stuck_watermarks(progress, "2024-01-30 18:00:00")
    return stuck.select("partition", ts("watermark", "watermark"), ts("since", "since"))
