"""Intake, duplicates, lateness and windows."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from tallymark.operators import dedup, metering
from tallymark.sources import intake, topics

EVENT = {
    "eventId": "3f2b8f6e-1111-4a2b-9c3d-0123456789ab",
    "eventType": "api_call",
    "customerId": "7d9f8f6e-2222-4a2b-8c3d-0123456789ab",
    "eventTime": "2024-01-15T14:23:45Z",
}

CASES = [
    (EVENT | {"metadata": {"endpoint": "/api/users"}, "source": "api-gateway"}, None),
    (EVENT, None),
    (EVENT | {"eventTime": "2024-01-15"}, None),
    (EVENT | {"eventTime": "2024-01-15T14:23:45.123+02:00"}, None),
    (EVENT | {"metadata": None, "source": None}, None),
    (EVENT | {"eventId": "evt-1"}, "INVALID_EVENT_ID"),
    (EVENT | {"eventId": 5}, "INVALID_EVENT_ID"),
    ({k: v for k, v in EVENT.items() if k != "eventType"}, "INVALID_EVENT_TYPE"),
    (EVENT | {"eventType": ""}, "INVALID_EVENT_TYPE"),
    (EVENT | {"customerId": "cust_1"}, "INVALID_CUSTOMER_ID"),
    (EVENT | {"eventTime": "soon"}, "INVALID_EVENT_TIME"),
    (EVENT | {"eventTime": "2024-02-30T00:00:00Z"}, "INVALID_EVENT_TIME"),
    (EVENT | {"eventTime": "2024-01-17T15:00:00Z"}, "INVALID_EVENT_TIME"),
    (EVENT | {"metadata": [1]}, "INVALID_METADATA"),
    (EVENT | {"metadata": "x"}, "INVALID_METADATA"),
    (EVENT | {"source": 7}, "INVALID_SOURCE"),
    (EVENT | {"metricType": "x"}, "UNKNOWN_FIELD"),
    ([1], "MALFORMED_BODY"),
    ("{", "MALFORMED_BODY"),
]


def test_intake(spark):
    bodies = [(i, c if isinstance(c, str) else json.dumps(c)) for i, (c, _) in enumerate(CASES)]
    raw = spark.createDataFrame(bodies, "n int, body string")
    judged = intake.validate_requests(raw, "2024-01-16 14:00:00").orderBy("n").collect()
    assert [r["reason"] for r in judged] == [reason for _, reason in CASES]
    accepted, refused = intake.split_requests(raw, "2024-01-16 14:00:00")
    assert accepted.count() + refused.count() == len(CASES)
    first, second, *_ = accepted.orderBy("n").collect()
    assert (first["metadata"], first["source"]) == ('{"endpoint":"/api/users"}', "api-gateway")
    assert (second["metadata"], second["source"]) == ("{}", None)


def test_messages_round_trip(spark, rows, tmp_path):
    events = rows(
        "event_id string, event_type string, customer_id string, event_time timestamp, ingestion_time timestamp, metadata string, source string",
        "('e1', 'click', 'c1', '2024-01-01 10:00:00', '2024-01-01 10:00:01', '{\"value\":3}', null), "
        "('e2', 'click', 'c2', '2024-01-01 11:00:00', '2024-01-01 11:00:01', '{}', 'app')",
    )
    folder = str(tmp_path / "topic")
    topics.send(topics.messages(events, topics.event_message()), folder)
    bad = spark.sql("SELECT 'k' AS key, '{oops' AS value, current_timestamp() AS sent_at")
    topics.send(bad, folder)
    got, dead = intake.decode_messages(spark.read.schema(topics.MESSAGE).json(folder))
    assert sorted((r["event_id"], r["metadata"], r["source"]) for r in got.collect()) == [("e1", '{"value":3}', None), ("e2", "{}", "app")]
    assert dead.count() == 1
    assert topics.receive(spark, folder).isStreaming


def test_metric_mapping(spark, rows):
    events = rows("event_id int, event_type string", "(1, 'click'), (2, 'odd')")
    mapping = rows("event_type string, metric_type string", "('click', 'api_calls')")
    assert {r["event_id"]: r["metric_type"] for r in intake.with_metric(events, mapping).collect()} == {1: "api_calls", 2: "odd"}
    assert {r["metric_type"] for r in intake.with_metric(events).collect()} == {"click", "odd"}


def test_first_copy_wins_and_all_others_are_reported(spark, rows):
    events = rows(
        "event_id string, ingestion_time timestamp, value int",
        "('a', '2024-01-01 00:00:02', 2), ('a', '2024-01-01 00:00:01', 1), ('a', '2024-01-01 00:00:01', 1), "
        "('b', '2024-01-01 00:00:01', 5)",
    )
    kept = dedup.first_copies(events)
    assert sorted((r["event_id"], r["value"]) for r in kept.collect()) == [("a", 1), ("b", 5)]
    refused = dedup.later_copies(events).collect()
    assert sorted((r["value"], r["copies"]) for r in refused) == [(1, 1), (2, 1)]
    assert dedup.not_stored(kept, kept.filter("event_id = 'a'")).count() == 1
    assert dedup.already_stored(kept, kept.filter("event_id = 'a'")).first()["reason"] == "DUPLICATE_EVENT_ID"


def test_no_copy_is_lost_without_id_or_arrival(spark, rows):
    events = rows(
        "event_id string, ingestion_time timestamp, value int",
        "('a', NULL, 1), ('a', NULL, 2), ('a', NULL, 2), ('b', NULL, 5), (NULL, '2024-01-01', 1), (NULL, NULL, 1), ('c', '2024-01-01', 1), ('c', NULL, 0)",
    )
    first, again = dedup.first_copies(events), dedup.later_copies(events)
    assert sorted((str(r["event_id"]), r["value"], r["copies"]) for r in again.collect()) == [("None", 1, 1), ("a", 2, 2), ("c", 0, 1)]
    assert first.count() + again.agg(F.sum("copies")).first()[0] == events.count()


def test_times_do_not_depend_on_the_session(spark):
    from tallymark.functions import values

    zone = spark.conf.get("spark.sql.session.timeZone")
    moments = spark.sql("SELECT timestamp_micros(m) AS t FROM VALUES (1704067200000000), (1710037800123456), (-1), (253402300799999999) AS v(m)")
    found = []
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            texts = moments.select(values.iso("t"), values.utc_text("t"), values.month_key("t"), values.stable_id(values.utc_text("t"))).collect()
            back = spark.sql("SELECT '2024-01-15' AS a, '2024-03-10T02:30:00' AS b, '2024-01-15T10:00:00+05:30' AS c")
            found.append((texts, back.select(*[F.unix_micros(values.parse_iso(c)) for c in "abc"]).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found[0] == found[1] == found[2]
    assert [r[0] for r in found[0][0]] == ["2024-01-01T00:00:00.000Z", "2024-03-10T02:30:00.123Z", "1969-12-31T23:59:59.999Z", "9999-12-31T23:59:59.999Z"]
    assert [r[1] for r in found[0][0]][:2] == ["2024-01-01 00:00:00", "2024-03-10 02:30:00.123456"]


def test_heavily_repeated_event(spark):
    """One id holds most rows, half of them equal."""
    events = spark.range(300).select(
        F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id")).alias("event_id"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("ingestion_time"),
    ).unionByName(spark.sql("SELECT 8L AS event_id, 8L AS ingestion_time"))
    refused = dedup.later_copies(events.withColumn("v", F.lit(1)), rows_per_task=20)
    per_id = {r["event_id"]: r["n"] for r in refused.groupBy("event_id").agg(F.sum("copies").alias("n")).collect()}
    assert per_id == {1: 239, 8: 1}
    assert refused.filter("event_id = 1 AND ingestion_time = 0").first()["copies"] == 119


EVENTS = "event_id int, customer_id string, metric_type string, event_time timestamp, value decimal(20,6)"


def test_strategies(spark, rows):
    events = rows(
        EVENTS,
        "(1, 'c', 'api_calls', '2024-01-01 10:10:00', 10), (2, 'c', 'api_calls', '2024-01-01 10:50:00', 5), "
        "(3, 'c', 'storage_gb_peak', '2024-01-01 10:10:00', 30), (4, 'c', 'storage_gb_peak', '2024-01-01 10:20:00', 50), "
        "(5, 'c', 'storage_gb_peak', '2024-01-01 12:20:00', -5), (6, 'c', 'api_call', '2024-01-01 10:10:00', 99), "
        "(7, 'c', 'api_calls', '2024-01-31 23:59:50', 1)",
    )
    usage = {(r["metric_type"], str(r["window_start"])): r for r in metering.meter(events).collect()}
    summed = usage["api_calls", "2024-01-01 10:00:00"]
    assert (summed["value"], summed["event_count"], summed["unit"]) == (Decimal(15), 2, "count")
    assert usage["storage_gb_peak", "2024-01-01 10:00:00"]["value"] == 50
    assert usage["storage_gb_peak", "2024-01-01 12:00:00"]["value"] == 0
    assert usage["api_call", "2024-01-01 10:00:00"]["value"] == 1
    assert str(usage["api_calls", "2024-01-31 23:00:00"]["window_end"]) == "2024-02-01 00:00:00"


def test_late_and_final_are_separate_rules(spark, rows):
    as_of = "2024-01-01 12:30:00"
    events = rows(
        EVENTS,
        "(1, 'c', 'm', '2024-01-01 11:59:59', 1), (2, 'c', 'm', '2024-01-01 12:00:00', 1), (3, 'c', 'm', '2023-12-31 12:00:00', 1)",
    )
    on_time, late = metering.split_late(events, as_of)
    assert [r["event_id"] for r in on_time.collect()] == [2]
    assert sorted(r["event_id"] for r in late.collect()) == [1, 3]
    final = metering.finalise(metering.meter(events), "2024-01-01 13:00:00")
    assert {str(r["window_end"]): r["is_final"] for r in final.collect()} == {
        "2024-01-01 12:00:00": True,
        "2024-01-01 13:00:00": False,
        "2023-12-31 13:00:00": True,
    }
    assert metering.finalisable(final.withColumn("is_final", F.lit(False)), "2024-01-01 14:00:00").count() == 3


def test_merged_parts_equal_one_pass(spark, sf_dir):
    from tallymark.plans import workload

    events = workload.telemetry(spark, sf_dir)
    parts = None
    for remainder in range(3):
        batch = events.filter(F.col("event_id") % 3 == remainder)
        part = batch.groupBy("customer_id", "metric_type", F.window("event_time", "1 day")["start"].alias("window_start")).agg(
            *metering.partial_aggregates()
        )
        parts = part if parts is None else parts.unionByName(part)
    merged, direct = metering.merge_partials(parts, "1 day"), metering.meter(events, "1 day")
    assert merged.exceptAll(direct).isEmpty() and direct.exceptAll(merged).isEmpty()


def test_window_ids_match_event_bridge(spark, sf_dir):
    from tallymark.plans import workload

    events = workload.telemetry(spark, sf_dir)
    usage, bridge = metering.meter(events), metering.usage_events(events)
    counted = bridge.groupBy("aggregation_id").agg(F.count(F.lit(1)).alias("event_count"))
    assert usage.select("aggregation_id", "event_count").exceptAll(counted).isEmpty()
    assert bridge.count() == events.count()


def test_sliding_equals_spark_windows(spark, sf_dir):
    from tallymark.plans import workload

    events = workload.telemetry(spark, sf_dir)
    ours = metering.sliding_usage(events, 60, 15, ["metric_type"]).select("metric_type", "window_start", "event_count", "sum_value")
    spark_own = events.groupBy("metric_type", F.window("event_time", "60 minutes", "15 minutes")["start"].alias("window_start")).agg(
        F.count(F.lit(1)).alias("event_count"), F.sum("value").cast("decimal(20,6)").alias("sum_value")
    )
    assert ours.exceptAll(spark_own).isEmpty() and spark_own.exceptAll(ours).isEmpty()


def test_sessions_equal_spark_sessions(spark, sf_dir):
    from tallymark.plans import workload

    events = workload.telemetry(spark, sf_dir)
    ours = metering.session_usage(events, 90, ["customer_id"]).select("customer_id", "session_start", "session_end", "event_count")
    spark_own = events.groupBy("customer_id", F.session_window("event_time", "90 minutes").alias("s")).agg(
        F.count(F.lit(1)).alias("event_count")
    ).select("customer_id", "s.start", "s.end", "event_count").toDF(*ours.columns)
    assert ours.exceptAll(spark_own).isEmpty() and spark_own.exceptAll(ours).isEmpty()


def test_versions(spark, rows):
    ddl = "customer_id string, metric_type string, window_start timestamp, value decimal(20,6), event_count bigint"
    current = rows(ddl + ", version int", "('a', 'm', '2024-01-01 00:00:00', 1, 1, 1), ('b', 'm', '2024-01-01 00:00:00', 2, 2, 3)")
    update = rows(ddl, "('a', 'm', '2024-01-01 00:00:00', 1, 1), ('b', 'm', '2024-01-01 00:00:00', 5, 3), ('c', 'm', '2024-01-01 00:00:00', 1, 1)")
    got = {r["customer_id"]: (r["version"], int(r["value"])) for r in metering.bump_versions(current, update).collect()}
    assert got == {"a": (1, 1), "b": (4, 5), "c": (1, 1)}


def test_sample_events(spark):
    """Windows one hour old or more have started before the watermark."""
    from tallymark.sources import samples

    now = "2024-01-15 12:20:00"
    usable, refused = metering.event_values(samples.sample_events(spark, now))
    assert refused.isEmpty()
    on_time, late = metering.split_late(usable, now)
    assert (on_time.count(), late.count()) == (5, 11)
    usage = metering.meter(usable)
    assert usage.count() == 4 and usage.agg(F.sum("event_count")).first()[0] == 16


def test_the_value_of_an_event_is_parsed_once(rows):
    given = [('{"value": 5}', 5), ('{"value": "7.5"}', 7.5), ('{"value": 0}', 1), ('{"value": "0"}', 0), ('{"value": true}', None), ("{}", 1), ("x", 1), ('{"value": "a"}', None)]
    sent = rows("id int, metadata string, metric_type string", ", ".join(f"({n}, '{text}', 'api_calls')" for n, (text, _) in enumerate(given))).repartition(2)
    usable, refused = metering.event_values(sent)
    assert usable.columns == [*sent.columns, "value"]
    assert {r["id"]: float(r["value"]) for r in usable.collect()} == {n: value for n, (_, value) in enumerate(given) if value is not None}
    assert {(r["id"], r["reason"]) for r in refused.collect()} == {(4, "CALCULATION_ERROR"), (7, "CALCULATION_ERROR")}
    for found in (usable, refused):
        assert found._jdf.queryExecution().optimizedPlan().toString().lower().count("parse_json(") + found._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_a_message_is_parsed_once(rows):
    values = ["null", "'x'", "'{\"eventId\":\"a\"}'", "'[1'", "''", "'{\"eventId\":\"b\",\"eventTime\":\"2024-01-01T00:00:00Z\"}'"]
    sent = rows("key string, value string", ", ".join(f"('{n}', {value})" for n, value in enumerate(values))).repartition(2)
    events, dead = intake.decode_messages(sent)
    assert [(r["event_id"], r["metadata"]) for r in events.collect()] == [("b", "{}")]
    assert sorted(r["key"] for r in dead.collect()) == ["0", "1", "2", "3", "4"]
    for found in (events, dead):
        assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
