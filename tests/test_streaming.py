"""Streams against the batch operators, with restarts and repeats."""

import glob

from pyspark.sql import functions as F

from tallymark.operators import metering
from tallymark.plans import workload
from tallymark.streaming import jobs

ONCE = {"availableNow": True}


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def write_files(events, folder, count):
    events.withColumn("_n", F.col("event_id") % count).repartition(count, "_n").drop("_n").write.mode("append").parquet(folder)


def stream_of(spark, folder, like):
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_no_event_is_lost_over_restarts(spark, sf_dir, tmp_path):
    events = workload.telemetry(spark, sf_dir)
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    on_time, late = metering.split_late(events, F.col("ingestion_time"))
    for part in (events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")):
        write_files(part, source, 3)
        for _ in range(2):  # the second start finds nothing new
            jobs.route_events(stream_of(spark, source, events), out, state, F.col("ingestion_time"), trigger=ONCE).awaitTermination()
    usage = jobs.current_usage(spark, out)
    assert same(usage, metering.meter(on_time))
    routed = spark.read.parquet(f"{out}/late_events")
    assert same(routed.select("event_id"), late.select("event_id"))
    assert same(spark.read.parquet(f"{out}/usage_events").select("event_id"), on_time.select("event_id"))
    runs = jobs.usage_store(spark, out).runs()
    assert len(glob.glob(f"{out}/late_events/batch_id=*")) == 6 and [(r.level, r.last) for r in runs] == [(1, 3), (0, 4), (0, 5)]
    recent = jobs.final_usage(spark, out, "2024-01-20", since="2024-01-10")
    wanted = metering.finalise(usage, "2024-01-20").filter("is_final AND window_start >= '2024-01-10'")
    assert same(recent, wanted)


def test_repeated_batch_counts_once(spark, sf_dir, tmp_path):
    """A batch that is run again after a crash replaces its own output."""
    events = workload.telemetry(spark, sf_dir)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(events, source, 1)
    for state in ("one", "two"):  # a lost checkpoint repeats batch 0
        stream = spark.readStream.schema(events.schema).parquet(source)
        jobs.route_events(stream, out, str(tmp_path / state), F.col("ingestion_time"), trigger=ONCE).awaitTermination()
    on_time, _ = metering.split_late(events, F.col("ingestion_time"))
    assert same(jobs.current_usage(spark, out), metering.meter(on_time))


def test_duplicates_are_dropped_and_publishing_may_fail(spark, sf_dir, tmp_path):
    events = workload.telemetry(spark, sf_dir).withColumn("source", F.lit(None).cast("string"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(events.unionByName(events.filter("event_id % 5 = 0")), source, 2)
    sent = []

    def publish(batch):
        sent.append(batch.count())
        raise RuntimeError("no broker")

    stream = spark.readStream.schema(events.schema).parquet(source)
    jobs.store_and_publish(stream, out, str(tmp_path / "state"), publish, ONCE).awaitTermination()
    stored = spark.read.parquet(f"{out}/events")
    refused = spark.read.parquet(f"{out}/refused")
    copies = events.filter("event_id % 5 = 0").count()
    assert stored.count() == events.count() == sum(sent) and refused.agg(F.sum("copies")).first()[0] == copies
    # A copy that comes in much later is refused as well.
    late = events.filter("event_id % 50 = 0").withColumn("ingestion_time", F.col("ingestion_time") + F.expr("interval 100 days"))
    late.write.mode("append").parquet(source)
    jobs.store_and_publish(spark.readStream.schema(events.schema).parquet(source), out, str(tmp_path / "state"), publish, ONCE).awaitTermination()
    assert spark.read.parquet(f"{out}/events").count() == events.count()
    assert spark.read.parquet(f"{out}/refused").agg(F.sum("copies")).first()[0] == copies + late.count()


def test_windows_close_in_append_mode(spark, sf_dir, tmp_path):
    events = workload.telemetry(spark, sf_dir)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events.orderBy("event_time").coalesce(1).write.parquet(source)
    usage = jobs.windowed_usage(spark.readStream.schema(events.schema).parquet(source), "1 day", "1 hour")
    usage.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(**ONCE).start(out).awaitTermination()
    closed = spark.read.schema(usage.schema).parquet(out)
    batch = metering.meter(events, "1 day").select(*closed.columns)
    assert closed.exceptAll(batch).isEmpty() and 0 < closed.count() <= batch.count()


def test_late_charges(spark, sf_dir, tmp_path):
    from tallymark.operators import rating

    events = workload.telemetry(spark, sf_dir)
    _, late = metering.split_late(events, F.col("ingestion_time"))
    late = late.withColumn("received_at", F.col("ingestion_time"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    late.write.parquet(source)
    stream = spark.readStream.schema(late.schema).parquet(source)
    books, rules = workload.books(spark), workload.rules(spark)
    jobs.rate_late_events(stream, books, rules, out, str(tmp_path / "state"), trigger=ONCE).awaitTermination()
    options = rating.RatingOptions(trail=False)
    charges, unrated = rating.rate(rating.late_events_to_rate(late, ["received_at"]), books, rules, F.col("received_at"), options)
    assert same(spark.read.parquet(f"{out}/charges").drop("batch_id"), charges)
    assert spark.read.parquet(f"{out}/unrated").count() == unrated.count() > 0
