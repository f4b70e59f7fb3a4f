"""Reconciliation, lineage, re-rating, table rules and maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.functions import values as V
from tallymark.operators import agreement, analytics, integrity, lineage, metering, rating, reconcile, rerating
from tallymark.plans import workload as W
from tallymark.plans.invoice_queries import _run_ctes, run
from tallymark.plans.metering_queries import AS_OF, on_time_usage
from tallymark.plans.rating_queries import charges, to_rate
from tallymark.plans.registry import money, placed, query, ts, ts_sql
from tallymark.session import materialise, stored
from tallymark.sources import tables

# --- events, usage, charges ------------------------------------------------------------


def _damaged_usage(spark, sf_dir):
    """Usage with a few windows lost, repeated, miscounted or made up."""
    usage = metering.finalise(on_time_usage(spark, sf_dir), AS_OF)
    kept = usage.filter("customer_id % 10 <> 1")
    wrong = kept.withColumn("event_count", F.col("event_count") + F.when(F.col("customer_id") % 10 == 2, 1).otherwise(0))
    twice = wrong.filter("customer_id % 10 = 3")
    extra = wrong.filter("customer_id % 10 = 4").withColumns(
        {"customer_id": F.col("customer_id") + 1000000, "aggregation_id": F.concat(F.lit("x"), "aggregation_id")}
    )
    return wrong.unionByName(twice).unionByName(extra)


_DAMAGED = {
    "kept": f"""SELECT customer_id, metric_type, window_start, aggregation_id, value, window_end <= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR AS is_final,
        event_count + CASE WHEN customer_id % 10 = 2 THEN 1 ELSE 0 END AS event_count FROM usage WHERE customer_id % 10 <> 1""",
    "stored": """SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE customer_id % 10 = 3
        UNION ALL SELECT customer_id + 1000000, metric_type, window_start, 'x' || aggregation_id, value, is_final, event_count FROM kept WHERE customer_id % 10 = 4""",
}


@query(
    W.sql(
        ["usage"],
        """SELECT status, count(*) AS windows, CAST(sum(coalesce(events, 0)) AS BIGINT) AS events FROM (
             SELECT CASE WHEN s.n IS NULL THEN 'missing_aggregation' WHEN j.events IS NULL OR s.n > 1 THEN 'extra_aggregation'
               WHEN j.events <> s.counted THEN 'count_mismatch' ELSE 'match' END AS status, j.events
             FROM (SELECT customer_id, metric_type, window_start, event_count AS events FROM usage) j
             FULL JOIN (SELECT customer_id, metric_type, window_start, sum(event_count) AS counted, count(*) AS n FROM stored GROUP BY 1, 2, 3) s
             USING (customer_id, metric_type, window_start)) GROUP BY status""",
        _DAMAGED,
    )
)
def reconcile_events(spark, sf_dir):
    """On-time events against stored windows, per outcome."""
    on_time, _ = metering.split_late(W.telemetry(spark, sf_dir), F.col("ingestion_time"))
    found = reconcile.events_to_usage(on_time, _damaged_usage(spark, sf_dir))
    return found.groupBy("status").agg(
        F.count(F.lit(1)).alias("windows"), F.sum(F.coalesce("event_count", F.lit(0))).alias("events")
    )


def _damaged_charges(spark, sf_dir):
    rows = charges(spark, sf_dir)
    kept = rows.filter("customer_id % 12 <> 5")
    wrong = kept.withColumn("quantity", (F.col("quantity") + F.when(F.col("customer_id") % 12 == 6, 1).otherwise(0)).cast("decimal(20,6)"))
    again = wrong.filter("customer_id % 12 = 7").withColumns(
        {"charge_id": F.concat(F.lit("again-"), "charge_id"), "calculated_at": F.col("calculated_at") + F.expr("interval 1 day")}
    )
    return wrong.unionByName(again)


_DAMAGED_CHARGES = {
    "good": """SELECT charge_id, customer_id, aggregation_id, calculated_at, subtotal, CAST(quantity + CASE WHEN customer_id % 12 = 6 THEN 1 ELSE 0 END AS DECIMAL(20,6)) AS quantity
        FROM rated WHERE reason IS NULL AND customer_id % 12 <> 5""",
    "charged": """SELECT * FROM good UNION ALL SELECT 'again-' || charge_id, customer_id, aggregation_id, calculated_at + INTERVAL 1 DAY, subtotal, quantity FROM good WHERE customer_id % 12 = 7""",
}


@query(
    W.rated_sql(
        f"""SELECT status, count(*) AS windows FROM (
              SELECT CASE WHEN c.n IS NULL THEN 'missing_charge' WHEN u.value IS NULL OR c.n > 1 THEN 'extra_charge' WHEN u.value <> c.quantity THEN 'quantity_mismatch' ELSE 'match' END AS status
              FROM (SELECT * FROM usage WHERE window_end <= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR) u
              FULL JOIN (SELECT aggregation_id, sum(quantity) AS quantity, count(*) AS n FROM charged WHERE aggregation_id IS NOT NULL GROUP BY 1) c USING (aggregation_id)) GROUP BY status""",
        extra=_DAMAGED_CHARGES,
    )
)
def reconcile_usage(spark, sf_dir):
    """Final windows against charges, per outcome."""
    usage = metering.finalise(on_time_usage(spark, sf_dir), AS_OF)
    found = reconcile.usage_to_charges(usage, _damaged_charges(spark, sf_dir))
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("windows"))


@query(
    W.rated_sql(
        "SELECT aggregation_id, count(*) AS charge_count, 'again-' || min(charge_id) FILTER (charge_id NOT LIKE 'again-%') AS kept_charge_id FROM charged WHERE aggregation_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        extra=_DAMAGED_CHARGES,
    )
)
def duplicate_charges(spark, sf_dir):
    """Windows charged more than once and the charge to keep."""
    return reconcile.duplicate_charges(_damaged_charges(spark, sf_dir))


@query(
    W.rated_sql("SELECT charge_id FROM charged WHERE aggregation_id IS NOT NULL AND customer_id % 12 = 7 AND charge_id NOT LIKE 'again-%'", extra=_DAMAGED_CHARGES)
)
def duplicate_charges_to_void(spark, sf_dir):
    """All but the newest charge of such windows."""
    return reconcile.charges_to_void(_damaged_charges(spark, sf_dir)).select("charge_id")


@query(
    W.sql(
        ["order_invoices"],
        """SELECT customer_id, month, charged, invoiced, CASE WHEN n IS NULL THEN 'no_invoice' WHEN charged IS NULL THEN 'no_charges' WHEN charged = invoiced THEN 'match'
             WHEN n > 1 THEN 'multiple_invoices' ELSE 'total_mismatch' END AS status
           FROM (SELECT o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m') AS month, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS charged
                 FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2) c
           FULL JOIN (SELECT customer_id, strftime(billing_period_start, '%Y-%m') AS month, CAST(sum(subtotal) AS DECIMAL(18,2)) AS invoiced, count(*) AS n FROM order_invoices GROUP BY 1, 2) i
           USING (customer_id, month)""",
    )
)
def reconcile_charges(spark, sf_dir):
    """Line item charges against invoices per customer and month."""
    orders = W.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("invoice_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("calculated_at"))
    # Lines are summed per order first: one order may have very many.
    sums = W.order_lines(spark, sf_dir).groupBy("invoice_id").agg(F.sum("amount").alias("subtotal"))
    lines = sums.join(orders, "invoice_id")
    return reconcile.charges_to_invoices(lines, W.order_invoices(spark, sf_dir)).select("customer_id", "month", "charged", "invoiced", "status")


def _ledger(spark, sf_dir):
    """Entries of billed invoices; some months have one entry too many."""
    billed = W.order_invoices(spark, sf_dir).filter("status IN ('issued', 'paid')")
    entries = billed.select("invoice_id", F.col("total").alias("amount"), F.col("issued_at").alias("transaction_date"), F.lit("revenue").alias("account"))
    return entries.unionByName(entries.filter("invoice_id % 500 = 0")).unionByName(entries.withColumn("account", F.lit("tax")))


@query(
    W.sql(
        ["order_invoices"],
        """SELECT month, total_invoiced, CAST(total_invoiced + coalesce(more, 0) AS DECIMAL(18,2)) AS total_revenue, CAST(-coalesce(more, 0) AS DECIMAL(18,2)) AS difference,
             CASE WHEN coalesce(more, 0) = 0 THEN 'tied' ELSE 'discrepancy' END AS status
           FROM (SELECT strftime(issued_at, '%Y-%m') AS month, CAST(sum(total) AS DECIMAL(18,2)) AS total_invoiced, sum(total) FILTER (invoice_id % 500 = 0) AS more
                 FROM order_invoices WHERE status IN ('issued', 'paid') GROUP BY 1)""",
    )
)
def reconcile_ledger(spark, sf_dir):
    """Billed totals against the revenue ledger per month."""
    return reconcile.invoices_to_ledger(W.order_invoices(spark, sf_dir), _ledger(spark, sf_dir))


@query(
    W.sql(
        ["telemetry", "usage"],
        f"""SELECT strftime(day, '%Y-%m-%d') AS day, events_ingested, events_processed, aggregations_created, aggregations_finalized,
              greatest(events_ingested - events_processed, 0) AS missing_events, CASE WHEN events_ingested = events_processed THEN 'clean' ELSE 'discrepancies' END AS status
            FROM (SELECT date_trunc('day', event_time) AS day, count(*) AS events_ingested FROM telemetry GROUP BY 1)
            JOIN (SELECT date_trunc('day', window_start) AS day, CAST(sum(event_count) AS BIGINT) AS events_processed, count(*) AS aggregations_created,
                    count(*) FILTER (window_end <= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR) AS aggregations_finalized FROM usage GROUP BY 1) USING (day)""",
    )
)
def report_daily_events(spark, sf_dir):
    """Events received and aggregated per day."""
    usage = metering.finalise(on_time_usage(spark, sf_dir), AS_OF)
    report = reconcile.daily_event_report(W.telemetry(spark, sf_dir), usage)
    return report.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    W.sql(
        ["order_invoices"],
        """SELECT *, CAST(abs(coalesce(total_charges, 0) - coalesce(total_invoiced, 0)) AS DECIMAL(18,2)) AS rounding_difference,
             CASE WHEN abs(coalesce(total_charges, 0) - coalesce(total_invoiced, 0)) < 0.01 THEN 'balanced' ELSE 'discrepancies' END AS status
           FROM (SELECT strftime(l_shipdate, '%Y-%m') AS month, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_charges FROM lineitem GROUP BY 1)
           FULL JOIN (SELECT strftime(billing_period_start, '%Y-%m') AS month, CAST(sum(subtotal) AS DECIMAL(18,2)) AS total_invoiced, CAST(sum(credits_applied) AS DECIMAL(18,2)) AS total_credits,
               CAST(sum(total) AS DECIMAL(18,2)) AS net_billed, count(*) AS invoice_count, count(DISTINCT customer_id) AS customer_count FROM order_invoices GROUP BY 1) USING (month)""",
    ).replace("count(*) AS invoice_count", "count(*) AS invoice_count").replace("SELECT *, CAST(abs", "SELECT month, total_charges, total_invoiced, total_credits, net_billed, coalesce(invoice_count, 0) AS invoice_count, coalesce(customer_count, 0) AS customer_count, CAST(abs")
)
def report_monthly_invoices(spark, sf_dir):
    """Charges and invoices per month."""
    lines = W.order_lines(spark, sf_dir).select(F.col("amount").alias("subtotal"), F.col("created_at").alias("calculated_at"))
    return reconcile.monthly_invoice_report(lines, W.order_invoices(spark, sf_dir))


@query(W.sql(["judged"], f"SELECT event_id, customer_id, {ts_sql('event_time')} AS event_time FROM judged WHERE late"))
def orphan_events(spark, sf_dir):
    """Events that no usage window counted: here the late ones."""
    events = W.telemetry(spark, sf_dir)
    on_time, _ = metering.split_late(events, F.col("ingestion_time"))
    return reconcile.orphan_events(events, metering.usage_events(on_time)).select("event_id", "customer_id", ts("event_time", "event_time"))


@query(W.sql(["telemetry", "usage"], "SELECT event_count, counted_events, event_count = counted_events AS conserved FROM (SELECT (SELECT count(*) FROM telemetry) AS event_count, CAST((SELECT sum(event_count) FROM usage) AS BIGINT) AS counted_events)"))
def conservation_on_time(spark, sf_dir):
    """On-time usage leaves the late events uncounted."""
    return reconcile.conservation(W.telemetry(spark, sf_dir), on_time_usage(spark, sf_dir))


@query(
    W.sql(
        ["telemetry"],
        """SELECT event_count, counted_events, event_count = counted_events AS conserved FROM (SELECT count(*) AS event_count,
             CAST((SELECT sum(n) FROM (SELECT count(*) AS n FROM telemetry GROUP BY customer_id, metric_type, date_trunc('day', event_time))) AS BIGINT) AS counted_events
           FROM events)""",
    )
)
def conservation_all(spark, sf_dir):
    """Without the late split every event is counted once."""
    events = W.telemetry(spark, sf_dir)
    return reconcile.conservation(events, metering.meter(events, "1 day"))


_CHANGED = {
    "stored": "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM lineitem",
    "second": """SELECT * REPLACE (CASE WHEN l_orderkey % 97 = 5 AND l_linenumber = 2 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
      FROM stored WHERE NOT (l_orderkey % 89 = 3 AND l_linenumber = 1)
      UNION ALL SELECT * FROM stored WHERE l_orderkey % 101 = 7 AND l_linenumber = 3""",
}


@query(
    W.sql(
        [],
        f"""SELECT 'first' AS side, l_orderkey, l_linenumber, l_quantity, l_returnflag, {ts_sql('l_shipdate')} AS l_shipdate FROM (SELECT * FROM stored EXCEPT ALL SELECT * FROM second)
            UNION ALL SELECT 'second', l_orderkey, l_linenumber, l_quantity, l_returnflag, {ts_sql('l_shipdate')} FROM (SELECT * FROM second EXCEPT ALL SELECT * FROM stored)""",
        _CHANGED,
    )
)
def agreement_differences(spark, sf_dir):
    """Rows changed, removed and repeated between two tables, found by fingerprints of key ranges."""
    stored = W.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    more = F.when((key % 97 == 5) & (line == 2), F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    second = stored.filter(~((key % 89 == 3) & (line == 1))).withColumn("l_quantity", more)
    second = second.unionByName(stored.filter((key % 101 == 7) & (line == 3)))
    found = agreement.differences(stored, second, ["l_orderkey"], rows_to_join=50_000)
    return found.select("side", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", ts("l_shipdate", "l_shipdate"))


# --- lineage ---------------------------------------------------------------------------


def _traced(spark, sf_dir, rated=None):
    """Events behind charges."""
    events = W.telemetry(spark, sf_dir)
    on_time, late = metering.split_late(events, F.col("ingestion_time"))
    counted = metering.usage_events(on_time, carry=["event_time", "metric_type"])
    return lineage.charge_events(rated or materialise(charges(spark, sf_dir)), counted, late)


_TRACED = {
    "traced": """SELECT r.charge_id, r.subtotal, j.event_id, j.event_time FROM rated r JOIN usage u USING (aggregation_id) JOIN judged j
          ON j.customer_id = u.customer_id AND j.metric_type = u.metric_type AND date_trunc('hour', j.event_time) = u.window_start AND NOT j.late WHERE r.reason IS NULL
        UNION ALL SELECT r.charge_id, r.subtotal, j.event_id, j.event_time FROM rated r JOIN judged j ON CAST(j.event_id AS VARCHAR) = r.source_event_id WHERE r.reason IS NULL"""
}


@query(W.rated_sql(f"SELECT charge_id, subtotal, event_id, {ts_sql('event_time')} AS event_time FROM traced", extra=_TRACED))
def trace_charges(spark, sf_dir):
    """Events behind every charge."""
    return _traced(spark, sf_dir).select("charge_id", money("subtotal", "subtotal"), "event_id", ts("event_time", "event_time"))


@query(
    W.rated_sql(
        "SELECT l.line_item_id, l.invoice_id, l.description, t.charge_id, t.event_id FROM traced t JOIN billable b USING (charge_id) JOIN lines l USING (customer_id, period_start, metric_type)",
        needs=("requests", "customers", "credits", "earlier"), extra=_run_ctes() | _TRACED,
    )
)
def trace_invoice_lines(spark, sf_dir):
    """Events behind every invoice line."""
    done = run(spark, sf_dir)
    found = lineage.line_events(done.line_items, done.line_charges, _traced(spark, sf_dir))
    return found.select("line_item_id", "invoice_id", "description", "charge_id", "event_id")


@query(
    W.rated_sql(
        f"""SELECT r.charge_id, k.name AS price_book_name, t.n AS source_event_count, {ts_sql('t.first_at')} AS first_event_at, t.sample FROM rated r JOIN books k USING (price_book_id)
            JOIN (SELECT charge_id, count(*) AS n, min(event_time) AS first_at, array_to_string(list(event_id ORDER BY event_time, event_id)[1:2], ',') AS sample FROM traced GROUP BY 1) t USING (charge_id)
            WHERE r.reason IS NULL""",
        extra=_TRACED,
    )
)
def explain_charges(spark, sf_dir):
    """Price book, event count and sample events of every charge."""
    rated = materialise(charges(spark, sf_dir))
    rows = lineage.explain_charges(rated, W.books(spark), materialise(_traced(spark, sf_dir, rated)), sample=2)
    sample = F.array_join(F.transform("source_event_sample", lambda e: e["event_id"].cast("string")), ",")
    return rows.select("charge_id", "price_book_name", "source_event_count", ts("first_event_at", "first_event_at"), sample.alias("sample"))


@query(
    W.rated_sql(
        "SELECT DISTINCT b.charge_id, l.invoice_id, CAST(l.line_number AS INTEGER) AS line_number, b.charge AS subtotal FROM billable b JOIN lines l USING (customer_id, period_start, metric_type)",
        needs=("requests", "customers", "credits", "earlier"), extra=_run_ctes(),
    )
)
def charges_of_invoices(spark, sf_dir):
    """Charges with the invoice and line they are on."""
    done = run(spark, sf_dir)
    found = analytics.charges_of_invoices(done.line_items, done.line_charges, charges(spark, sf_dir))
    return found.select("charge_id", "invoice_id", "line_number", money("subtotal", "subtotal"))


def _chained(spark, sf_dir):
    """Order n refers to order n - 3 within blocks of sixty."""
    key = F.col("invoice_id")
    return W.order_invoices(spark, sf_dir).withColumn("reference_invoice_id", F.when(key % 60 >= 3, key - 3))


@query(
    W.sql(
        ["order_invoices"],
        """SELECT invoice_id, root_invoice_id, depth FROM chain""",
        {
            "linked": "SELECT invoice_id, CASE WHEN invoice_id % 60 >= 3 THEN invoice_id - 3 END AS ref FROM order_invoices",
            "chain": """SELECT * FROM (WITH RECURSIVE c AS (SELECT invoice_id, invoice_id AS root_invoice_id, CAST(0 AS BIGINT) AS depth FROM linked WHERE ref IS NULL
                UNION ALL SELECT l.invoice_id, c.root_invoice_id, c.depth + 1 FROM linked l JOIN c ON l.ref = c.invoice_id) SELECT * FROM c)""",
        },
    )
)
def correction_chains(spark, sf_dir):
    """Root and depth of every invoice in its chain of corrections."""
    return lineage.correction_chains(_chained(spark, sf_dir))


@query(
    W.sql(
        ["order_invoices"],
        "SELECT invoice_id, root_invoice_id, depth FROM chain",
        {
            "linked": "SELECT invoice_id, CASE WHEN invoice_id % 60 >= 3 THEN invoice_id - 3 END AS ref FROM order_invoices",
            "chain": """SELECT * FROM (WITH RECURSIVE c AS (SELECT invoice_id, invoice_id AS root_invoice_id, CAST(0 AS BIGINT) AS depth FROM linked WHERE ref IS NULL
                UNION ALL SELECT l.invoice_id, c.root_invoice_id, c.depth + 1 FROM linked l JOIN c ON l.ref = c.invoice_id) SELECT * FROM c)""",
        },
    )
)
def correction_chains_extended(spark, sf_dir):
    """Root and depth of every invoice, stored as three batches of invoices come in."""
    invoices, place = _chained(spark, sf_dir), F.col("invoice_id") % 60
    stored = lineage.correction_chains(invoices.filter(place < 20))
    for new in (invoices.filter((place >= 20) & (place < 40)), invoices.filter(place >= 40)):
        stored = materialise(stored.unionByName(lineage.extend_chains(stored, new)))
    return stored


@query(W.sql(["order_invoices"], "SELECT invoice_id, total, CAST((invoice_id - 61) // 3 AS BIGINT) AS depth FROM order_invoices WHERE invoice_id BETWEEN 60 AND 119 AND invoice_id % 3 = 1"))
def corrections_of_invoice(spark, sf_dir):
    """One invoice and everything that corrects it."""
    return lineage.corrections_of(_chained(spark, sf_dir), 61).select("invoice_id", "total", "depth")


# --- re-rating -------------------------------------------------------------------------


def _job(spark, sf_dir):
    """(new charges, differences) after two prices were corrected."""
    rule = F.col("rule_id")
    price = F.when(rule == "b-peak", "2.75").when(rule == "a-comp", "0.74").cast("decimal(12,6)")
    tiers = F.transform("tiers", lambda t: t.withField("unitPrice", F.coalesce(price, t["unitPrice"])))
    books, rules = W.books(spark), W.rules(spark)
    corrected = rules.withColumn("tiers", tiers)
    options = rating.RatingOptions(trail=False)
    usage = to_rate(spark, sf_dir).filter("aggregation_id IS NOT NULL")
    changed = materialise(rerating.changed_usage(usage, rerating.price_changes((books, rules), (books, corrected), options)))
    # What is stored for this usage; there is no stored table of charges here.
    stored = rating.rate(changed, books, rules, F.col("calculated_at"), options)[0]
    return rerating.rerate(changed, stored, books, corrected, F.lit("2024-02-10").cast("timestamp"), options)


def _differences(spark, sf_dir):
    return _job(spark, sf_dir)[1]


_RERATED = {
    "before_and_after": """SELECT aggregation_id, customer_id, charge_id, subtotal AS original_subtotal,
        CASE rule_id WHEN 'b-peak' THEN CAST(2.75 AS DECIMAL(18,2)) WHEN 'a-comp' THEN CAST(CAST(0.74 AS DECIMAL(18,2)) * quantity AS DECIMAL(18,2)) ELSE subtotal END AS rerated_subtotal
        FROM rated WHERE reason IS NULL AND aggregation_id IS NOT NULL""",
    "changed": "SELECT *, CAST(rerated_subtotal - original_subtotal AS DECIMAL(18,2)) AS difference FROM before_and_after WHERE rerated_subtotal <> original_subtotal",
}


@query(W.rated_sql("SELECT aggregation_id, customer_id, original_subtotal, rerated_subtotal, difference FROM changed", extra=_RERATED))
def rerate_differences(spark, sf_dir):
    """Charges that change when the usage is rated again."""
    rows = _differences(spark, sf_dir)
    return rows.select("aggregation_id", "customer_id", money("original_subtotal", "original_subtotal"), money("rerated_subtotal", "rerated_subtotal"), "difference")


@query(W.rated_sql("SELECT sha256('job-1|' || charge_id) AS charge_id, 'job-1' AS rerating_job_id, charge_id AS supersedes_charge_id, rerated_subtotal AS subtotal FROM changed", extra=_RERATED))
def rerate_charges(spark, sf_dir):
    """New charges that replace the differing ones."""
    rows = rerating.superseding_charges(*_job(spark, sf_dir), "job-1")
    return rows.select("charge_id", "rerating_job_id", "supersedes_charge_id", money("subtotal", "subtotal"))


@query(
    W.rated_sql(
        "SELECT customer_id, CAST(sum(difference) AS DECIMAL(18,2)) AS adjustment, count(*) AS changed_charges, 'job-1:' || customer_id AS idempotency_key FROM changed WHERE customer_id % 4 <> 0 GROUP BY customer_id",
        extra=_RERATED,
    )
)
def rerate_corrections(spark, sf_dir):
    """One correction per customer, without those an earlier run created."""
    corrections = rerating.job_corrections(_differences(spark, sf_dir), "job-1")
    stored = W.customers(spark, sf_dir).filter("customer_id % 4 = 0").select(
        F.concat(F.lit("job-1:"), F.col("customer_id").cast("string")).alias("idempotency_key")
    )
    return rerating.new_corrections(corrections, stored).select("customer_id", "adjustment", "changed_charges", "idempotency_key")


@query(
    W.rated_sql(
        "SELECT 'job-1' AS job_id, count(*) AS charges_created, count(DISTINCT customer_id) AS correction_count, CAST(sum(difference) AS DECIMAL(18,2)) AS total_adjustment_amount FROM changed",
        extra=_RERATED,
    )
)
def rerate_result(spark, sf_dir):
    """Counters of the re-rating job."""
    return rerating.job_result(rerating.job_corrections(_differences(spark, sf_dir), "job-1"), "job-1")


@query(
    W.rated_sql(
        """SELECT customer_id, adjustment, abs(adjustment) >= 1 AND abs(adjustment) >= invoice_total * 0.001 AS material FROM (
             SELECT customer_id, CAST(sum(difference) AS DECIMAL(18,2)) AS adjustment, CAST(sum(total) AS DECIMAL(18,2)) AS invoice_total
             FROM (SELECT customer_id, sum(difference) AS difference FROM changed GROUP BY 1) JOIN (SELECT o_custkey AS customer_id, sum(CAST(o_totalprice AS DECIMAL(18,2))) / 1000 AS total FROM orders GROUP BY 1) USING (customer_id) GROUP BY 1)""",
        extra=_RERATED,
    ).replace("sum(CAST(o_totalprice AS DECIMAL(18,2))) / 1000 AS total", "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(18,2)) AS total")
)
def rerate_material(spark, sf_dir):
    """Which corrections are large enough to be billed."""
    corrections = rerating.job_corrections(_differences(spark, sf_dir), "job-1")
    totals = W.order_invoices(spark, sf_dir).groupBy("customer_id").agg(
        (F.sum("total") * F.lit("0.001").cast("decimal(4,3)")).cast("decimal(18,2)").alias("invoice_total")
    )
    return corrections.join(totals, "customer_id").select(
        "customer_id", "adjustment", reconcile.is_material(F.col("adjustment"), F.col("invoice_total")).alias("material")
    )


@query(
    W.sql(
        ["usage"],
        """SELECT aggregation_id, customer_id, metric_type, value FROM usage WHERE customer_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
           AND metric_type IN ('api_calls', 'bandwidth_mb') AND window_start >= TIMESTAMP '2024-01-05' AND window_end <= TIMESTAMP '2024-01-20'""",
    )
)
def rerate_scope(spark, sf_dir):
    """Usage windows of a re-rating job: one market segment, two metrics, fifteen days."""
    segment = W.customers(spark, sf_dir).filter("c_mktsegment = 'BUILDING'")
    scope = rerating.in_scope(on_time_usage(spark, sf_dir), "2024-01-05", "2024-01-20", segment, ["api_calls", "bandwidth_mb"])
    return scope.select("aggregation_id", "customer_id", "metric_type", "value")


@query(W.rated_sql("SELECT count(*) AS charges, CAST(0 AS BIGINT) AS differences FROM rated WHERE reason IS NULL"))
def determinism_of_one_run(spark, sf_dir):
    """The same usage rated twice, the second time in another order and over other tasks."""
    options = rating.RatingOptions(trail=False)
    usage, books, rules = to_rate(spark, sf_dir), W.books(spark), W.rules(spark)
    one = rating.rate(usage, books, rules, F.col("calculated_at"), options)[0]
    two = rating.rate(usage.repartition(7, "metric_type"), books, rules.orderBy("rule_id"), F.col("calculated_at"), options)[0]
    differences = reconcile.differences(one, two).agg(F.count(F.lit(1)).alias("differences"))
    return one.agg(F.count(F.lit(1)).alias("charges")).withColumn("differences", differences.scalar())


@query(W.rated_sql("SELECT charge_id, subtotal, 'first' AS side FROM rated WHERE reason IS NULL AND rule_id = 'a-peak'"))
def determinism_differences(spark, sf_dir):
    """Charges of one run that a run without one rule lacks."""
    options = rating.RatingOptions(trail=False)
    usage, books = to_rate(spark, sf_dir), W.books(spark)
    one = rating.rate(usage, books, W.rules(spark), F.col("calculated_at"), options)[0]
    two = rating.rate(usage, books, W.rules(spark).filter("rule_id <> 'a-peak'"), F.col("calculated_at"), options)[0]
    # Charges of both runs, written once.
    one, two = (stored(run.select("charge_id", "subtotal"), "run") for run in (one, two))
    rows = reconcile.differences(one, two)
    return rows.select("charge_id", money("subtotal", "subtotal"), "side")


@query(
    W.sql(
        ["order_invoices"],
        """SELECT invoice_id, original_debit, correction_debit, correction_credit, CAST(original_debit + correction_debit - correction_credit - expected AS DECIMAL(18,2)) AS discrepancy,
             original_debit + correction_debit - correction_credit = expected AS is_balanced
           FROM (SELECT c.invoice_id, coalesce(b.booked, 0) AS original_debit, greatest(c.change, 0) AS correction_debit, greatest(-c.change, 0) AS correction_credit, c.expected
             FROM (SELECT i.invoice_id + 1000000 AS invoice_id, i.invoice_id AS ref, CAST(CASE WHEN i.invoice_id % 2 = 0 THEN 10 ELSE -10 END AS DECIMAL(18,2)) AS change,
                    CAST(i.total + CASE WHEN i.invoice_id % 2 = 0 THEN 10 ELSE -10 END AS DECIMAL(18,2)) AS expected FROM order_invoices i) c
             LEFT JOIN (SELECT invoice_id, CAST(sum(total * CASE WHEN invoice_id % 500 = 0 THEN 2 ELSE 1 END) AS DECIMAL(18,2)) AS booked FROM order_invoices WHERE status IN ('issued', 'paid') GROUP BY 1) b ON b.invoice_id = c.ref)""",
    )
)
def correction_balance(spark, sf_dir):
    """Do ledger and corrections add up to the expected revenue?"""
    change = F.when(F.col("invoice_id") % 2 == 0, 10).otherwise(-10).cast("decimal(18,2)")
    corrections = W.order_invoices(spark, sf_dir).select(
        (F.col("invoice_id") + 1000000).alias("invoice_id"),
        F.col("invoice_id").alias("reference_invoice_id"),
        change.alias("total"),
        (F.col("total") + change).cast("decimal(18,2)").alias("expected_total"),
    )
    ledger = _ledger(spark, sf_dir).filter("account = 'revenue'").select("invoice_id", "amount")
    found = reconcile.correction_balance(corrections, ledger)
    return found.select("invoice_id", "original_debit", "correction_debit", "correction_credit", "discrepancy", "is_balanced")


# --- table rules and maintenance -------------------------------------------------------


@query(
    W.sql(
        ["order_invoices"],
        """SELECT 'billing_period' AS rule, count(*) AS violations FROM order_invoices WHERE invoice_id % 9 = 0
           UNION ALL SELECT 'invoice_status', count(*) FROM order_invoices WHERE invoice_id % 11 = 0
           UNION ALL SELECT 'invoice_type', count(*) FROM order_invoices WHERE invoice_id % 13 = 0
           UNION ALL SELECT 'invoice_number', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)
           UNION ALL SELECT 'invoice_reference', count(*) FROM order_invoices WHERE invoice_id + 5 NOT IN (SELECT invoice_id FROM order_invoices)""",
    )
)
def violations_invoices(spark, sf_dir):
    """Broken rules of the invoice table, counted."""
    key = F.col("invoice_id")
    invoices = W.order_invoices(spark, sf_dir).withColumns(
        {
            "billing_period_end": F.when(key % 9 == 0, F.col("billing_period_start")).otherwise(F.col("billing_period_end")),
            "status": F.when(key % 11 == 0, "open").otherwise(F.col("status")),
            "invoice_type": F.when(key % 13 == 0, "pro_forma").otherwise("standard"),
            "invoice_number": F.concat(F.lit("INV-"), F.col("customer_id").cast("string")),
            "reference_invoice_id": key + 5,
        }
    )
    return integrity.violation_counts("invoices", {"invoices": invoices})


@query(
    W.rated_sql(
        """SELECT 'charge_usage' AS rule, charge_id AS row_key FROM rated WHERE reason IS NULL AND aggregation_id IS NOT NULL AND customer_id % 10 = 1
           UNION ALL SELECT 'charge_rule', charge_id FROM rated WHERE reason IS NULL AND rule_id = 'a-peak'"""
    )
)
def violations_charges(spark, sf_dir):
    """Charges whose usage window or rule does not exist."""
    usage = on_time_usage(spark, sf_dir).filter("customer_id % 10 <> 1")
    rules = W.rules(spark).filter("rule_id <> 'a-peak'")
    # Stored tables, written once.
    rated, usage = stored(charges(spark, sf_dir), "charges"), stored(usage, "usage")
    known = {"rated_charges": rated, "aggregated_usage": usage, "price_rules": rules, "price_books": W.books(spark)}
    return integrity.violations("rated_charges", known)


@query(
    W.sql(
        ["telemetry"],
        """SELECT 'event_time' AS rule, CAST(event_id AS VARCHAR) AS row_key FROM telemetry WHERE event_id % 40 = 3
           UNION ALL SELECT 'event_key', CAST(event_id AS VARCHAR) FROM telemetry WHERE event_id % 30 = 7""",
    )
)
def violations_events(spark, sf_dir):
    """Events from the future and repeated event ids."""
    events = W.telemetry(spark, sf_dir).withColumn(
        "event_time", F.when(F.col("event_id") % 40 == 3, F.col("ingestion_time") + F.expr("interval 2 days")).otherwise(F.least("event_time", "ingestion_time"))
    )
    again = events.filter("event_id % 30 = 7").withColumn("event_time", F.col("ingestion_time"))
    return integrity.violations("telemetry_events", {"telemetry_events": events.unionByName(again)})


@query(
    W.sql(
        ["usage"],
        """SELECT 'window_order' AS rule, aggregation_id AS row_key FROM usage WHERE metric_type = 'api_calls' AND event_count > 1
           UNION ALL SELECT 'positive_value', aggregation_id FROM usage WHERE metric_type <> 'api_calls' AND event_count = 1
           UNION ALL SELECT 'usage_key', aggregation_id FROM usage WHERE customer_id % 10 = 4""",
    )
)
def violations_usage(spark, sf_dir):
    """Windows that end at their start, negative values and repeated ids."""
    usage = on_time_usage(spark, sf_dir).withColumns(
        {
            "window_end": F.when((F.col("metric_type") == "api_calls") & (F.col("event_count") > 1), F.col("window_start")).otherwise(F.col("window_end")),
            "value": F.when((F.col("metric_type") != "api_calls") & (F.col("event_count") == 1), -1).otherwise(F.abs("value")),
            "rerating_job_id": F.lit(None).cast("string"),
        }
    )
    again = usage.filter("customer_id % 10 = 4").withColumns(
        {"rerating_job_id": F.lit("again"), "window_end": F.col("window_start") + F.expr("interval 1 hour"), "value": F.lit(1)}
    )
    return integrity.violations("aggregated_usage", {"aggregated_usage": usage.unionByName(again)})


@query(
    """WITH b AS (SELECT o_orderkey AS id, o_custkey + 1 AS parent FROM orders)
       SELECT 'effective_dates' AS rule, CAST(id AS VARCHAR) AS row_key FROM b WHERE id % 7 = 1
       UNION ALL SELECT 'book_parent', CAST(id AS VARCHAR) FROM b WHERE parent NOT IN (SELECT o_orderkey FROM orders)
       UNION ALL SELECT 'version_start', o_custkey + 1 || '|' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1"""
)
def violations_books(spark, sf_dir):
    """Price books that end before they start, without their parent, or with a shared start."""
    orders = W.table(spark, sf_dir, "orders")
    start = F.col("o_orderdate").cast("timestamp")
    books = orders.select(
        F.col("o_orderkey").alias("price_book_id"), (F.col("o_custkey") + 1).alias("parent_id"), start.alias("effective_from"),
        F.when(F.col("o_orderkey") % 7 == 1, start - F.expr("interval 1 day")).alias("effective_until"),
    )
    return integrity.violations("price_books", {"price_books": books})


@query(
    """SELECT 'pricing_model' AS rule, CAST(p_partkey AS VARCHAR) AS row_key FROM part WHERE p_size % 5 = 0
       UNION ALL SELECT 'rule_book', CAST(p_partkey AS VARCHAR) FROM part WHERE p_size NOT IN (SELECT n_nationkey FROM nation)
       UNION ALL SELECT 'rule_metric', p_size || '|' || p_brand FROM part GROUP BY p_size, p_brand HAVING count(*) > 1"""
)
def violations_rules(spark, sf_dir):
    """Price rules of an unknown model, without their book, or twice for a metric."""
    rules = W.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("rule_id"), F.col("p_size").alias("price_book_id"), F.col("p_brand").alias("metric_type"),
        F.when(F.col("p_size") % 5 == 0, "barter").otherwise("flat").alias("pricing_model"),
    )
    books = W.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("price_book_id"))
    return integrity.violations("price_rules", {"price_rules": rules, "price_books": books})


@query(
    """SELECT 'line_number' AS rule, l_orderkey || '-' || l_linenumber AS row_key FROM lineitem WHERE l_linenumber = 7
       UNION ALL SELECT 'line_invoice', l_orderkey || '-' || l_linenumber FROM lineitem WHERE l_orderkey % 11 = 0
       UNION ALL SELECT 'line_key', l_orderkey || '-' || l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def violations_lines(spark, sf_dir):
    """Invoice lines with a number below one, without their invoice, or with a repeated id."""
    lines = W.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_item_id"), F.col("l_orderkey").alias("invoice_id"),
        F.when(F.col("l_linenumber") == 7, 0).otherwise(F.col("l_linenumber")).alias("line_number"),
    )
    invoices = W.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("invoice_id")).filter("invoice_id % 11 <> 0")
    return integrity.violations("invoice_line_items", {"invoice_line_items": lines, "invoices": invoices})


@query(
    """SELECT 'adjustment_credit' AS rule, CAST(o_orderkey AS VARCHAR) AS row_key FROM orders WHERE o_custkey % 5 = 0
       UNION ALL SELECT 'adjustment_invoice', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 13 = 0"""
)
def violations_adjustments(spark, sf_dir):
    """Adjustments without their invoice or credit."""
    orders = W.table(spark, sf_dir, "orders")
    rows = orders.select(F.col("o_orderkey").alias("adjustment_id"), F.col("o_orderkey").alias("invoice_id"), F.col("o_custkey").alias("credit_id"))
    known = {
        "invoice_adjustments": rows,
        "invoices": rows.select("invoice_id").filter("invoice_id % 13 <> 0"),
        "customer_credits": rows.select("credit_id").filter("credit_id % 5 <> 0"),
    }
    return integrity.violations("invoice_adjustments", known)


@query(
    """SELECT 'credit_amount' AS rule, CAST(c_custkey AS VARCHAR) AS row_key FROM customer WHERE c_acctbal < 0
       UNION ALL SELECT 'credit_customer', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey = 3"""
)
def violations_credits(spark, sf_dir):
    """Credits with a negative balance, or without their customer."""
    rows = W.table(spark, sf_dir, "customer")
    credits = rows.select(
        F.col("c_custkey").alias("credit_id"), F.col("c_custkey").alias("customer_id"),
        F.col("c_acctbal").alias("remaining_amount"), F.lit(1_000_000).alias("amount"),
    )
    known = {"customer_credits": credits, "customers": rows.filter("c_nationkey <> 3").select(F.col("c_custkey").alias("customer_id"))}
    return integrity.violations("customer_credits", known)


@query(
    """SELECT 'customer_status' AS rule, CAST(c_custkey AS VARCHAR) AS row_key FROM customer WHERE c_nationkey = 7
       UNION ALL SELECT 'customer_external_id', c_mktsegment || '-' || c_nationkey FROM customer GROUP BY c_mktsegment, c_nationkey HAVING count(*) > 1"""
)
def violations_customers(spark, sf_dir):
    """Customers with an unknown status or a shared external id."""
    rows = W.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("external_id"),
        F.when(F.col("c_nationkey") == 7, "unknown").otherwise("active").alias("status"),
    )
    return integrity.violations("customers", {"customers": rows})


@query(
    """SELECT coalesce(c_custkey, k) AS customer_id, CASE WHEN k IS NULL OR k % 2 = 1 THEN c_name ELSE 'Renamed ' || k END AS name,
         CASE WHEN k IS NOT NULL THEN 'suspended' WHEN c_custkey % 17 = 0 THEN 'suspended' ELSE 'active' END AS status
       FROM customer FULL JOIN (SELECT c_custkey * 2 + c_custkey % 2 AS k FROM customer) ON k = c_custkey"""
)
def customers_upsert(spark, sf_dir):
    """Customers after a change set: some new, some changed in part."""
    current = W.customers(spark, sf_dir).select("customer_id", "name", "status")
    key = (F.col("c_custkey") * 2 + F.col("c_custkey") % 2).alias("customer_id")
    changes = W.table(spark, sf_dir, "customer").select(key).withColumns(
        {
            "name": F.when(F.col("customer_id") % 2 == 0, F.concat(F.lit("Renamed "), F.col("customer_id").cast("string"))),
            "status": F.lit("suspended"),
        }
    )
    return tables.upsert(current, changes, "customer_id")


@query(
    """SELECT c_custkey AS customer_id, 'kept' AS outcome FROM customer WHERE c_custkey % 3 <> 0
       UNION ALL SELECT c_custkey * 3, 'missing' FROM customer WHERE c_custkey * 3 NOT IN (SELECT c_custkey FROM customer)"""
)
def customers_delete(spark, sf_dir):
    """Customers left after deletions, and ids that were not there."""
    ids = W.customers(spark, sf_dir).select((F.col("customer_id") * 3).alias("customer_id"))
    kept, missing = tables.delete(W.customers(spark, sf_dir), ids, "customer_id")
    return kept.select("customer_id", F.lit("kept").alias("outcome")).unionByName(missing.select("customer_id", F.lit("missing").alias("outcome")))


@query(W.sql(["customers"], "SELECT customer_id, name, status, CAST(row_number() OVER (ORDER BY customer_id DESC) AS INTEGER) AS place FROM customers"))
def customers_newest_first(spark, sf_dir):
    """All customers, highest id first."""
    rows = W.customers(spark, sf_dir).withColumn("created_at", F.col("customer_id"))
    return placed(analytics.newest_first(rows, "created_at", "customer_id")).select("customer_id", "name", "status", "place")


@query(
    W.sql(
        ["customers"],
        "SELECT tax_region, billing_currency, CAST(CASE coalesce(tax_region, '') WHEN 'EU-DE' THEN 0.19 WHEN 'EU-FR' THEN 0.20 WHEN 'UK-VAT' THEN 0.20 WHEN 'NO-TAX' THEN 0.00 ELSE 0.05 END AS DECIMAL(5,2)) AS tax_rate, "
        "CAST(CASE billing_currency WHEN 'EUR' THEN 0.92 WHEN 'GBP' THEN 0.78 WHEN 'JPY' THEN 150 WHEN 'BRL' THEN 5 ELSE 1 END AS DECIMAL(9,2)) AS exchange_rate, count(*) AS customers FROM customers GROUP BY 1, 2",
    )
)
def customer_rates(spark, sf_dir):
    """Tax and exchange rates of the customers, read from their metadata."""
    region = F.when(F.col("tax_region").isNotNull(), F.to_json(F.struct(F.col("tax_region").alias("taxRegion")))).otherwise("{}")
    rows = W.customers(spark, sf_dir).withColumn("region", V.tax_region(region))
    return rows.groupBy("tax_region", "billing_currency").agg(
        F.max(V.tax_rate("region")).alias("tax_rate"), F.max(V.exchange_rate("billing_currency")).alias("exchange_rate"), F.count(F.lit(1)).alias("customers")
    )


