"""Streams run to their end over the given events, compared with the batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.operators import lags, metering
from tallymark.plans import workload as W
from tallymark.plans.registry import money, query, ts, ts_sql
from tallymark.session import work_path
from tallymark.sources import files, intake, topics
from tallymark.streaming import jobs

ONCE = {"availableNow": True}


def _event_stream(spark, sf_dir):
    """The events table as a stream of files."""
    schema = W.table(spark, sf_dir, "events").schema
    plain = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = spark.readStream.schema(plain).parquet(f"{sf_dir}/event[s].parquet")
    times = [f.name for f in schema.fields if f.dataType.typeName() == "timestamp"]
    return W.telemetry_of(raw.withColumns({c: F.col(c).cast("timestamp") for c in times}))


def _routed(spark, sf_dir) -> str:
    folder = work_path(spark, "routed")
    stream = jobs.route_events(
        _event_stream(spark, sf_dir), folder, f"{folder}/_state", clock=F.col("ingestion_time"), trigger=ONCE
    )
    stream.awaitTermination()
    return folder


@query(
    W.sql(
        ["usage"],
        f"SELECT aggregation_id, customer_id, metric_type, {ts_sql('window_start')} AS window_start, value, event_count FROM usage",
    )
)
def stream_usage(spark, sf_dir):
    """Usage windows from a stream of events, late ones routed aside."""
    usage = jobs.current_usage(spark, _routed(spark, sf_dir))
    return usage.select("aggregation_id", "customer_id", "metric_type", ts("window_start", "window_start"), "value", "event_count")


def _arriving(spark, sf_dir, parts: int, again: int = 0):
    """Events as a stream of ``parts`` files, one a batch; each file from the second on also holds copies of the one before."""
    folder = work_path(spark, "arriving")
    events = W.telemetry(spark, sf_dir)
    part = F.pmod(F.col("event_id"), F.lit(parts))
    first = events.withColumn("arrival", part)
    if again:
        copies = events.filter(F.pmod(F.col("event_id") / parts, F.lit(again)).cast("int") == 0).withColumn("arrival", part + 1)
        first = first.unionByName(copies.filter(F.col("arrival") < parts).withColumn("ingestion_time", F.col("ingestion_time") + F.expr("interval 1 hour")))
    first.repartition(parts, "arrival").write.partitionBy("arrival").parquet(folder)
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder).drop("arrival")


@query(W.sql(["usage"], f"SELECT aggregation_id, customer_id, metric_type, {ts_sql('window_start')} AS window_start, value, event_count FROM usage"))
def stream_usage_merged(spark, sf_dir):
    """Usage windows counted in ten batches, whose parts are merged on the way."""
    folder = work_path(spark, "merged")
    jobs.route_events(_arriving(spark, sf_dir, 10), folder, f"{folder}/_state", clock=F.col("ingestion_time"), trigger=ONCE).awaitTermination()
    usage = jobs.current_usage(spark, folder)
    return usage.select("aggregation_id", "customer_id", "metric_type", ts("window_start", "window_start"), "value", "event_count")


@query(W.sql(["usage"], "SELECT aggregation_id, value, event_count FROM usage"))
def stream_usage_restarted(spark, sf_dir):
    """Usage windows of a stream that was stopped three times, once after it wrote a batch it had not noted yet."""
    folder = work_path(spark, "restarted")
    events = W.telemetry(spark, sf_dir)
    for part in range(3):
        events.filter(F.pmod("event_id", F.lit(3)) == part).write.mode("append").parquet(f"{folder}/events")
        for _ in range(2):
            stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events")
            jobs.route_events(stream, f"{folder}/out", f"{folder}/_state", clock=F.col("ingestion_time"), trigger=ONCE).awaitTermination()
            # As if the stream had stopped before it noted its last batch: it is run again.
            commits = f"{folder}/_state/commits"
            files.remove(spark, f"{commits}/{max((n for n in files.children(spark, commits) if n.isdigit()), key=int)}")
    return jobs.current_usage(spark, f"{folder}/out").select("aggregation_id", "value", "event_count")


@query(
    W.sql(
        ["telemetry"],
        """SELECT event_id, CAST(1 AS BIGINT) AS times_stored,
             CAST(CASE WHEN CAST(event_id // 10 AS BIGINT) % 3 = 0 AND event_id % 10 < 9 THEN 1 ELSE 0 END AS BIGINT) AS times_refused,
             CAST(1 AS BIGINT) AS times_published FROM telemetry""",
    )
)
def stream_known_ids(spark, sf_dir):
    """Events of ten batches stored and published once; copies that come a batch later are refused by the index of ids."""
    folder = work_path(spark, "stored")
    events = _arriving(spark, sf_dir, 10, again=3).withColumn("source", F.lit(None).cast("string"))

    def publish(rows) -> None:
        rows.write.mode("append").parquet(f"{folder}/published")

    jobs.store_and_publish(events, folder, f"{folder}/_state", publish, ONCE).awaitTermination()
    stored = spark.read.parquet(f"{folder}/events").select("event_id", F.lit(1).alias("s"), F.lit(0).alias("r"), F.lit(0).alias("p"))
    refused = spark.read.parquet(f"{folder}/refused").select("event_id", F.lit(0).alias("s"), F.col("copies").alias("r"), F.lit(0).alias("p"))
    published = spark.read.parquet(f"{folder}/published").select(F.get_json_object("value", "$.eventId").cast("long").alias("event_id"), F.lit(0).alias("s"), F.lit(0).alias("r"), F.lit(1).alias("p"))
    every = stored.unionByName(refused).unionByName(published)
    return every.groupBy("event_id").agg(F.sum("s").alias("times_stored"), F.sum("r").alias("times_refused"), F.sum("p").alias("times_published"))


@query(W.sql(["usage"], "SELECT aggregation_id, value, event_count FROM usage WHERE window_end <= TIMESTAMP '2024-01-20 12:30:00' - INTERVAL 1 HOUR"))
def stream_final_usage(spark, sf_dir):
    """Windows of the stream that are due at a processing time."""
    return jobs.final_usage(spark, _routed(spark, sf_dir), "2024-01-20 12:30:00").select("aggregation_id", "value", "event_count")


@query(W.rated_sql("SELECT charge_id, customer_id, source_event_id, subtotal FROM rated WHERE reason IS NULL AND source_event_id IS NOT NULL"))
def stream_late_charges(spark, sf_dir):
    """Late events of the stream rated one by one by a second stream."""
    folder = _routed(spark, sf_dir)
    schema = spark.read.parquet(f"{folder}/late_events").schema
    late = spark.readStream.schema(schema).parquet(f"{folder}/late_events")
    jobs.rate_late_events(late, W.books(spark), W.rules(spark), f"{folder}/rated", f"{folder}/_rating", trigger=ONCE).awaitTermination()
    return spark.read.parquet(f"{folder}/rated/charges").select("charge_id", "customer_id", "source_event_id", money("subtotal", "subtotal"))


@query(W.sql(["usage"], "SELECT aggregation_id, value, event_count, CAST(1 AS BIGINT) AS times FROM usage WHERE window_end <= TIMESTAMP '2024-01-20 12:30:00' - INTERVAL 1 HOUR"))
def stream_finalised_once(spark, sf_dir):
    """Windows stored as final by three runs, one of them repeated, and how often each was published."""
    folder = _routed(spark, sf_dir)
    for run, as_of in (("1", "2024-01-10 00:30:00"), ("2", "2024-01-20 12:30:00"), ("2", "2024-01-20 12:30:00")):
        again = work_path(spark, "published") if run == "1" else f"{folder}/published-2"
        jobs.finalise_due(spark, folder, as_of, run, lambda rows, to=again: rows.write.mode("overwrite").json(to))
    final = jobs.finalised_usage(spark, folder)
    return final.groupBy("aggregation_id").agg(F.first("value").alias("value"), F.first("event_count").alias("event_count"), F.count(F.lit(1)).alias("times"))


@query(
    W.rated_sql("SELECT CAST(customer_id AS VARCHAR) AS customer_id, source_event_id, subtotal FROM rated WHERE reason IS NULL AND source_event_id IS NOT NULL")
)
def message_path_late_charges(spark, sf_dir):
    """Events sent, received, decoded, metered and routed; late ones sent on, received and rated."""
    folder = work_path(spark, "messages")
    events = W.telemetry(spark, sf_dir).withColumn("source", F.lit(None).cast("string"))
    topics.send(topics.messages(events, topics.event_message(), sent_at=F.col("ingestion_time")), f"{folder}/events")
    decoded, _ = intake.decode_messages(topics.receive(spark, f"{folder}/events"))
    names = W.telemetry(spark, sf_dir).select("event_type", "metric_type").distinct()
    valued, _ = metering.event_values(intake.with_metric(decoded.drop("received_at", "watermark"), names))
    jobs.route_events(valued, f"{folder}/routed", f"{folder}/_routing", clock=F.col("ingestion_time"), trigger=ONCE).awaitTermination()
    late = spark.read.parquet(f"{folder}/routed/late_events")
    topics.send(topics.messages(late, topics.late_message(), sent_at=F.col("received_at")), f"{folder}/late")
    received, _ = intake.decode_messages(topics.receive(spark, f"{folder}/late"))
    named = intake.with_metric(received, names)
    jobs.rate_late_events(named, W.books(spark), W.rules(spark), f"{folder}/rated", f"{folder}/_rating", trigger=ONCE).awaitTermination()
    return spark.read.parquet(f"{folder}/rated/charges").select("customer_id", "source_event_id", money("subtotal", "subtotal"))


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT customer_id, metric_type, {ts_sql("date_trunc('day', event_time)")} AS window_start, CAST(CASE WHEN metric_type IN ('api_calls','bandwidth_mb','compute_hours') THEN sum(value)
              WHEN metric_type = 'storage_gb_peak' THEN greatest(max(value), 0) ELSE count(*) END AS DECIMAL(20,6)) AS value, count(*) AS event_count
            FROM telemetry GROUP BY customer_id, metric_type, date_trunc('day', event_time)""",
    )
)
def stream_windowed_usage(spark, sf_dir):
    """Daily usage kept in Spark's own window state, last update per window."""
    folder = work_path(spark, "windowed")
    usage = jobs.windowed_usage(_event_stream(spark, sf_dir), "1 day", "40 days")

    def write(batch, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    started = usage.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/_state").trigger(**ONCE).start()
    started.awaitTermination()
    rows = spark.read.parquet(f"{folder}/out")
    latest = rows.groupBy("customer_id", "metric_type", "window_start").agg(F.max(F.struct("batch_id", "value", "event_count")).alias("last"))
    return latest.select("customer_id", "metric_type", ts("window_start", "window_start"), F.col("last.value").alias("value"), F.col("last.event_count").alias("event_count"))


_SESSIONS = f"""SELECT customer_id, {ts_sql('min(event_time)')} AS session_start, {ts_sql('max(event_time) + INTERVAL 2 HOUR')} AS session_end,
      count(*) AS event_count, CAST(sum(value) AS DECIMAL(20,6)) AS value
    FROM (SELECT *, sum(CASE WHEN before IS NULL OR event_time >= before + INTERVAL 2 HOUR THEN 1 ELSE 0 END)
             OVER (PARTITION BY customer_id ORDER BY event_time, event_id) AS session
          FROM (SELECT *, lag(event_time) OVER (PARTITION BY customer_id ORDER BY event_time, event_id) AS before FROM telemetry))
    GROUP BY customer_id, session"""


@query(W.sql(["telemetry"], _SESSIONS))
def stream_sessions(spark, sf_dir):
    """Sessions of a stream that was stopped between its batches and started again."""
    folder = work_path(spark, "sessions")
    events = W.telemetry(spark, sf_dir).select("customer_id", "event_time", "value")
    # Every other event comes with the second start, so that sessions grow together over it.
    parts = [events.filter("unix_micros(event_time) % 2000 < 1000"), events.filter("unix_micros(event_time) % 2000 >= 1000")]
    end = events.limit(1).withColumns({"customer_id": F.lit(-1).cast("bigint"), "event_time": F.lit("2100-01-01").cast("timestamp")})
    for part in (*parts, end):
        part.select(*events.columns).write.mode("append").parquet(f"{folder}/events")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/events")
        sessions = jobs.windowed_sessions(stream, "2 hours", "60 days", ["customer_id"])
        sink = sessions.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/_state")
        sink.trigger(**ONCE).start(f"{folder}/out").awaitTermination()
    found = spark.read.schema(sessions.schema).parquet(f"{folder}/out")
    return found.select("customer_id", ts("session_start", "session_start"), ts("session_end", "session_end"), "event_count", "value")


_LAGS = {
    "lagging": """SELECT date_trunc('hour', ingestion_time) AS hour, CAST(customer_id % 4 AS VARCHAR) AS partition,
        greatest(epoch_us(ingestion_time) - epoch_us(event_time), 0) // 1000 AS lag FROM telemetry""",
    "slotted": """SELECT partition, greatest(length(bin(lag)) - 8, 0) * 128 + (lag >> greatest(length(bin(lag)) - 8, 0)) AS slot FROM lagging""",
    "counted": """SELECT partition, slot, CAST(sum(count(*)) OVER (PARTITION BY partition ORDER BY slot) AS BIGINT) AS seen,
        CAST(sum(count(*)) OVER (PARTITION BY partition) AS BIGINT) AS events FROM slotted GROUP BY partition, slot""",
    "reached": "SELECT partition, max(events) AS events, min(slot) AS slot FROM counted WHERE seen >= ceil(events * 0.99) GROUP BY partition",
}


@query(
    W.sql(
        ["telemetry"],
        f"""SELECT r.partition, events, ((slot - greatest(slot // 128 - 1, 0) * 128 + 1) << greatest(slot // 128 - 1, 0)) - 1 AS p99_lag_ms, {ts_sql('w.watermark')} AS watermark
            FROM reached r JOIN (SELECT CAST(customer_id % 4 AS VARCHAR) AS partition, max(event_time) AS watermark FROM telemetry GROUP BY 1) w USING (partition)""",
        _LAGS,
    )
)
def stream_lags(spark, sf_dir):
    """99th percentile of the lag and watermark per source partition, from what a stream of ten batches stored."""
    folder = work_path(spark, "lags")
    events = _arriving(spark, sf_dir, 10)
    jobs.watch_lags(events, folder, f"{folder}/_state", F.col("customer_id") % 4, F.col("ingestion_time"), ONCE).awaitTermination()
    slow = lags.lag_quantile(jobs.lags_of(spark, folder), 0.99, ["partition"])
    come = jobs.progress_of(spark, folder).groupBy("partition").agg(F.max("watermark").alias("watermark"))
    return slow.join(come, "partition").select("partition", "events", F.col("lag_ms").alias("p99_lag_ms"), ts("watermark", "watermark"))
