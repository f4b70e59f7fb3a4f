"""Reconciliation, lineage, re-rating, table rules and maintenance."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.operators import integrity, lineage, metering, reconcile, rerating
from tallymark.schemas import TABLES
from tallymark.sources import tables


def test_chains(spark):
    pairs = [(i, i - 1 if i % 50 else None) for i in range(200)] + [(900, 899)]
    invoices = spark.createDataFrame(pairs, "invoice_id int, reference_invoice_id int")
    got = {r["invoice_id"]: (r["root_invoice_id"], r["depth"]) for r in lineage.correction_chains(invoices).collect()}
    assert got == {i: (i - i % 50, i % 50) for i in range(200)} | {900: (900, 0)}
    assert lineage.corrections_of(invoices, 50).count() == 50


def test_cycles_are_reported_and_lose_no_other_invoice(spark):
    pairs = [(1, 2), (2, 1), (3, 2), (4, 4), (5, None), (6, 5), (7, 6)]
    invoices = spark.createDataFrame(pairs, "invoice_id int, reference_invoice_id int")
    got = {r["invoice_id"]: (r["root_invoice_id"], r["depth"]) for r in lineage.correction_chains(invoices).collect()}
    assert got == {1: (None, None), 2: (None, None), 3: (None, None), 4: (None, None), 5: (5, 0), 6: (5, 1), 7: (5, 2)}


def test_heavy_charge_is_traced(spark):
    """One window holds nine tenths of the events."""
    events = spark.range(500).select(
        F.col("id").alias("event_id"), F.expr("timestamp_seconds(id)").alias("event_time"), F.lit("m").alias("metric_type"),
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("aggregation_id"),
    )
    charges = spark.createDataFrame([("ch1", "hot", None, 5.0), ("ch2", "cold", None, 1.0)], "charge_id string, aggregation_id string, source_event_id string, subtotal double")
    traced = lineage.charge_events(charges, events, events.limit(0), rows_per_task=20)
    assert {r["charge_id"]: r["count"] for r in traced.groupBy("charge_id").count().collect()} == {"ch1": 450, "ch2": 50}
    books = spark.createDataFrame([("b", "Book")], "price_book_id string, name string")
    told = lineage.explain_charges(charges.withColumn("price_book_id", F.lit("b")), books, traced, 3)
    hot = told.filter("charge_id = 'ch1'").first()
    assert [e["event_id"] for e in hot["source_event_sample"]] == [0, 1, 2] and hot["source_event_count"] == 450


def test_rerating(rows):
    ddl = "aggregation_id string, customer_id string, charge_id string, subtotal decimal(12,2), rerating_job_id string, supersedes_charge_id string"
    old = rows(ddl, "('a', 'c', 'o1', 500, null, null), ('b', 'c', 'o2', 10, null, null)")
    new = rows(ddl, "('a', 'c', 'n1', 520, null, null), ('b', 'c', 'n2', 10, null, null), ('d', 'e', 'n3', 4, null, null)")
    changed = rerating.charge_differences(old, new)
    assert {r["aggregation_id"]: r["difference"] for r in changed.collect()} == {"a": Decimal("20.00"), "d": Decimal("4.00")}
    replaced = rerating.superseding_charges(new, changed, "job")
    assert {r["supersedes_charge_id"] for r in replaced.collect()} == {"o1", None}
    corrections = rerating.job_corrections(changed, "job")
    assert {r["idempotency_key"] for r in corrections.collect()} == {"job:c", "job:e"}
    assert rerating.new_corrections(corrections, corrections).isEmpty()
    assert rerating.job_result(corrections, "job").first()["total_adjustment_amount"] == Decimal("24.00")


def test_materiality(spark):
    cases = [("0.99", "10", False), ("1.00", "10", True), ("-5", "100", True), ("5", "6000", False), ("6", "6000", True)]
    for change, total, material in cases:
        column = reconcile.is_material(F.lit(change).cast("decimal(12,2)"), F.lit(total).cast("decimal(12,2)"))
        assert spark.range(1).select(column.alias("m")).first()["m"] is material


def test_identical_runs_do_not_differ(spark, sf_dir):
    from tallymark.plans import rating_queries

    one, two = (rating_queries.charges(spark, sf_dir) for _ in range(2))
    assert reconcile.differences(one, two).isEmpty()


def test_violations(rows):
    books = rows(
        "price_book_id string, parent_id string, effective_from timestamp, effective_until timestamp",
        "('a', null, '2024-01-01 00:00:00', null), ('b', 'a', '2024-02-01 00:00:00', '2024-01-01 00:00:00'), ('c', 'a', '2024-02-01 00:00:00', null), ('d', 'gone', '2024-03-01 00:00:00', null)",
    )
    got = sorted((r["rule"], r["row_key"]) for r in integrity.violations("price_books", {"price_books": books}).collect())
    assert got == [("book_parent", "d"), ("effective_dates", "b"), ("version_start", "a|2024-02-01 00:00:00")]
    lines = rows("line_item_id string, invoice_id string, line_number int", "('x', 'i', 0), ('y', 'i', 1)")
    known = rows("invoice_id string", "('i')")
    assert [r["rule"] for r in integrity.violations("invoice_line_items", {"invoice_line_items": lines, "invoices": known}).collect()] == ["line_number"]
    events = rows("event_id string, event_time timestamp, ingestion_time timestamp", "('e', '2024-01-03 00:00:01', '2024-01-02 00:00:00'), ('f', '2024-01-03 00:00:00', '2024-01-02 00:00:00')")
    assert [r["row_key"] for r in integrity.violations("telemetry_events", {"telemetry_events": events}).collect()] == ["e"]


def test_repeated_values_are_counted_in_parts_of_bounded_size(spark, monkeypatch):
    # Half of the rows hold one value, three rows a null, one value comes twice.
    key = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id").isin(1, 3, 5), None).when(F.col("id").isin(7, 9), "two").otherwise(F.concat(F.lit("k"), "id"))
    lines = spark.range(1000).select(key.alias("line_item_id"), F.lit(1).alias("line_number"), F.array("id").alias("charge_ids"))

    def found():
        return integrity.violations("invoice_line_items", {"invoice_line_items": lines})

    want = sorted(r["row_key"] for r in found().collect())
    monkeypatch.setattr(integrity, "ROWS_PER_PART", 40)
    assert sorted(r["row_key"] for r in found().collect()) == want == ["", "hot", "two"]
    # The aggregate has a part for every 40 rows, whatever the bytes.
    assert found().filter("rule = 'line_key'").rdd.getNumPartitions() >= 25


def test_tables_round_trip(spark, sf_dir, tmp_path):
    from tallymark.plans import workload

    path = str(tmp_path / "events")
    events = workload.telemetry(spark, sf_dir)
    tables.write_table(events, path, "telemetry_events")
    back = tables.read_table(spark, path, "telemetry_events")
    assert back.count() == events.count()
    assert set(back.columns) == {f.split()[0] for f in TABLES["telemetry_events"].split(", ")} | {"month"}
    live, old = str(tmp_path / "live"), str(tmp_path / "old")
    tables.archive(back.drop("month"), "event_time", "2024-02-10", live, old)
    kept, gone = spark.read.parquet(live).count(), spark.read.parquet(old).count()
    assert kept + gone == events.count() and kept and gone


def test_customer_changes(rows):
    current = rows("customer_id string, name string, email string", "('a', 'A', 'a@x'), ('b', 'B', null)")
    changes = rows("customer_id string, name string", "('a', 'A2'), ('b', null), ('c', 'C')")
    after = {r["customer_id"]: (r["name"], r["email"]) for r in tables.upsert(current, changes, "customer_id").collect()}
    assert after == {"a": ("A2", "a@x"), "b": ("B", None), "c": ("C", None)}
    kept, missing = tables.delete(current, rows("customer_id string", "('a'), ('z')"), "customer_id")
    assert [r["customer_id"] for r in kept.collect()] == ["b"] and [r["customer_id"] for r in missing.collect()] == ["z"]


def test_watermarks(rows):
    events = rows("p int, event_time timestamp", "(1, '2024-01-01 10:00:00'), (1, '2024-01-01 12:00:00'), (2, '2024-01-01 11:00:00')")
    assert str(reconcile.global_watermark(events, F.col("p")).first()["watermark"]) == "2024-01-01 11:00:00"


def test_quality(rows):
    events = rows("event_time timestamp", "('2024-01-01 10:10:00'), ('2024-01-01 11:58:00')")
    metrics = reconcile.quality_metrics(events, "2024-01-01 12:00:00")
    row = metrics.first()
    assert (row["late_events"], row["late_rate"], row["max_lag_seconds"]) == (1, Decimal("0.500000"), Decimal("6600.000"))
    assert reconcile.alerts(metrics).first().asDict() == {"lag_alert": True, "late_alert": True}


def test_conservation(spark, sf_dir):
    from tallymark.plans import workload

    events = workload.telemetry(spark, sf_dir)
    assert reconcile.conservation(events, metering.meter(events)).first()["conserved"]
    assert not reconcile.conservation(events, metering.meter(events.filter("event_id > 5"))).first()["conserved"]


def test_stored_tables_are_read_in_pieces(spark):
    from tallymark.session import stored

    rows = spark.range(0, 200_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("name"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        kept = stored(rows, "pieces")
        # A checkpoint would keep the one part.
        assert kept.dtypes == rows.dtypes and kept.rdd.getNumPartitions() > 4
        assert kept.exceptAll(rows).isEmpty() and kept.count() == 200_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_heavy_lines_that_come_twice_are_joined_as_often_as_they_come(spark):
    line = spark.sql("SELECT 'l' AS line_item_id, 'i' AS invoice_id, 'd' AS description, 1 AS amount, 6L AS charge_count")
    charges = spark.range(6).select(F.lit("l").alias("line_item_id"), F.col("id").cast("string").alias("charge_id"))
    traced = spark.range(6).select(F.col("id").cast("string").alias("charge_id"), F.col("id").alias("event_id"))
    found = lineage.line_events(line.unionAll(line), charges, traced, rows_per_task=2)
    assert sorted(r.event_id for r in found.collect()) == sorted([*range(6)] * 2)
