"""Price books and charges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.operators import analytics, metering, pricebooks, rating
from tallymark.plans import workload as W
from tallymark.plans.metering_queries import on_time_usage
from tallymark.plans.registry import money, placed, query, ts, ts_sql
from tallymark.sources import tables

# --- inputs ----------------------------------------------------------------------------


def to_rate(spark, sf_dir):
    """Usage windows and late events, with the time they are rated."""
    _, late = metering.split_late(W.telemetry(spark, sf_dir), F.col("ingestion_time"))
    due = F.col("window_end") + F.expr("interval 1 hour")
    windows = rating.usage_to_rate(on_time_usage(spark, sf_dir).withColumn("calculated_at", due), ["calculated_at"])
    delayed = rating.late_events_to_rate(late.withColumn("calculated_at", F.col("ingestion_time")), ["calculated_at"])
    return windows.unionByName(delayed)


def rated(spark, sf_dir, options=rating.RatingOptions(trail=False), usage=None):
    usage = to_rate(spark, sf_dir) if usage is None else usage
    return rating.rate(usage, W.books(spark), W.rules(spark), F.col("calculated_at"), options)


def charges(spark, sf_dir, **options):
    return rated(spark, sf_dir, rating.RatingOptions(**({"trail": False} | options)))[0]


# --- books -----------------------------------------------------------------------------

_BOOK_OF = """(SELECT b.{what} FROM books b WHERE b.effective_from <= t.event_time
  AND (b.effective_until IS NULL OR b.effective_until > t.event_time) ORDER BY b.effective_from DESC, b.price_book_id LIMIT 1)"""


@query(
    W.sql(
        ["telemetry", "books"],
        f"SELECT event_id, {_BOOK_OF.format(what='price_book_id')} AS price_book_id, {_BOOK_OF.format(what='version')} AS price_version FROM telemetry t",
    )
)
def book_as_of_join(spark, sf_dir):
    """Price book in force at every event."""
    found = pricebooks.attach_book(W.telemetry(spark, sf_dir), W.books(spark), "event_time", ["event_id"])
    return found.select("event_id", "price_book_id", "price_version")


@query(
    W.sql(
        ["telemetry", "books", "tiers"],
        """SELECT event_id, (SELECT b.price_book_id FROM books b WHERE b.effective_from <= t.event_time
             AND (b.effective_until IS NULL OR b.effective_until > t.event_time)
             AND b.price_book_id IN (SELECT price_book_id FROM tiers r WHERE r.metric_type = t.metric_type)
             ORDER BY b.effective_from DESC, b.price_book_id LIMIT 1) AS price_book_id FROM telemetry t""",
    )
)
def book_as_of_join_by_metric(spark, sf_dir):
    """Latest price book with a rule for the metric at every event."""
    versions = W.books(spark).join(W.rules(spark).select("price_book_id", "metric_type"), "price_book_id")
    found = pricebooks.attach_book(W.telemetry(spark, sf_dir), versions, "event_time", ["event_id"], ["metric_type"])
    return found.select("event_id", "price_book_id")


@query(
    W.sql(
        ["telemetry", "books"],
        f"SELECT {ts_sql('event_time')} AS day, {_BOOK_OF.format(what='price_book_id')} AS price_book_id FROM (SELECT DISTINCT date_trunc('day', event_time) AS event_time FROM telemetry) t",
    )
)
def book_of_day(spark, sf_dir):
    """Price book in force on every day with events."""
    days = W.telemetry(spark, sf_dir).select(F.date_trunc("day", "event_time").alias("day")).distinct()
    return pricebooks.effective_book(W.books(spark), days, "day").select(ts("day", "day"), "price_book_id")


@query(
    W.sql(
        ["telemetry", "books"],
        f"SELECT {ts_sql('day')} AS day FROM (SELECT DISTINCT date_trunc('day', event_time) AS day FROM telemetry) d WHERE NOT EXISTS (SELECT 1 FROM books b WHERE b.effective_from <= d.day AND (b.effective_until IS NULL OR b.effective_until > d.day))",
    )
)
def book_uncovered_days(spark, sf_dir):
    """Days with events but without a price book at their start."""
    days = W.telemetry(spark, sf_dir).select(F.date_trunc("day", "event_time").alias("day")).distinct()
    return pricebooks.uncovered_dates(W.books(spark), days).select(ts("day", "day"))


def _order_books(spark, sf_dir):
    """A price book version per order, in families of one customer each.

    Most versions end where the next one starts; some are open, late or inverted.
    """
    orders = W.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("price_book_id"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_custkey").alias("parent_id"),
        F.col("o_orderdate").alias("effective_from"),
        F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("version"),
    )
    key = F.col("price_book_id")
    until = (
        F.when(key % 7 == 0, None)
        .when(key % 7 == 1, F.col("effective_from") - F.expr("interval 1 day"))
        .otherwise(F.col("effective_from") + F.make_dt_interval(days=(key % 90).cast("int")))
    )
    return orders.withColumn("effective_until", until)


_ORDER_BOOKS = {
    "versions": """SELECT o_orderkey AS price_book_id, 'Order ' || o_orderkey AS name, o_custkey AS parent_id, o_orderdate AS effective_from,
      CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate + to_days(CAST(o_orderkey % 90 AS INTEGER)) END AS effective_until
      FROM orders"""
}


@query(
    W.sql(
        [],
        """SELECT l_orderkey, l_linenumber, b.price_book_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey
           LEFT JOIN LATERAL (SELECT price_book_id FROM versions v WHERE v.parent_id = o_custkey AND v.effective_from <= l_shipdate
             AND (v.effective_until IS NULL OR v.effective_until > l_shipdate) ORDER BY v.effective_from DESC, v.price_book_id LIMIT 1) b ON TRUE""",
        _ORDER_BOOKS,
    )
)
def book_as_of_join_by_customer(spark, sf_dir):
    """Order book of the customer in force at every ship date."""
    customers = W.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("parent_id"))
    lines = W.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    found = pricebooks.attach_book(
        lines.join(customers, "l_orderkey"), _order_books(spark, sf_dir), "l_shipdate", ["l_orderkey", "l_linenumber"], ["parent_id"]
    )
    return found.select("l_orderkey", "l_linenumber", "price_book_id")


@query(
    W.sql(
        [],
        """SELECT price_book_id, parent_id, problem FROM (
             SELECT *, CASE WHEN effective_until IS NOT NULL AND effective_from >= effective_until THEN 'INVERTED' WHEN next_from IS NULL THEN NULL
               WHEN effective_until IS NULL OR effective_until > next_from THEN 'OVERLAP' WHEN effective_until < next_from THEN 'GAP' END AS problem
             FROM (SELECT *, lead(effective_from) OVER (PARTITION BY parent_id ORDER BY effective_from, price_book_id) AS next_from FROM versions))
           WHERE problem IS NOT NULL""",
        _ORDER_BOOKS,
    )
)
def book_version_problems(spark, sf_dir):
    """Versions that are inverted, overlap the next one or leave a gap."""
    return pricebooks.version_problems(_order_books(spark, sf_dir)).select("price_book_id", "parent_id", "problem")


_NEW_VERSIONS = _ORDER_BOOKS | {
    "fresh": """SELECT 1000000 + c_custkey AS price_book_id, c_custkey AS parent_id,
        CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2001-01-01' ELSE TIMESTAMP '2001-10-01' END AS effective_from FROM customer""",
    "latest": "SELECT parent_id, max(effective_from) AS current_from, arg_max(coalesce(effective_until, TIMESTAMP '9999-01-01'), (effective_from, price_book_id)) AS current_until FROM versions GROUP BY parent_id",
    "judged_versions": """SELECT f.*, CASE WHEN f.effective_from < TIMESTAMP '2001-09-01' THEN 'IN_THE_PAST' WHEN f.effective_from <= l.current_from THEN 'NOT_AFTER_CURRENT'
        WHEN l.current_until <> TIMESTAMP '9999-01-01' AND l.current_until <> f.effective_from THEN 'GAP_OR_OVERLAP' END AS reason
        FROM fresh f LEFT JOIN latest l USING (parent_id)""",
}


def _added_versions(spark, sf_dir):
    new = W.table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1000000).alias("price_book_id"),
        F.lit("New").alias("name"),
        F.col("c_custkey").alias("parent_id"),
        F.when(F.col("c_custkey") % 5 == 0, "2001-01-01").otherwise("2001-10-01").cast("timestamp").alias("effective_from"),
        F.lit("new").alias("version"),
        F.lit(None).cast("timestamp").alias("effective_until"),
    )
    return pricebooks.add_versions(_order_books(spark, sf_dir), new, "2001-09-01")


@query(W.sql([], "SELECT price_book_id, reason FROM judged_versions WHERE reason IS NOT NULL", _NEW_VERSIONS))
def book_versions_refused(spark, sf_dir):
    """New versions that may not be added."""
    return _added_versions(spark, sf_dir)[1].select("price_book_id", "reason")


@query(
    W.sql(
        [],
        f"""SELECT v.price_book_id, {ts_sql('coalesce(v.effective_until, j.effective_from)')} AS effective_until FROM versions v
              LEFT JOIN judged_versions j ON j.parent_id = v.parent_id AND j.reason IS NULL
            UNION ALL SELECT price_book_id, NULL FROM judged_versions WHERE reason IS NULL""",
        _NEW_VERSIONS,
    )
)
def book_versions_added(spark, sf_dir):
    """Price books after new versions closed the open ones."""
    return _added_versions(spark, sf_dir)[0].select("price_book_id", ts("effective_until", "effective_until"))


@query(W.sql([], f"SELECT price_book_id, {ts_sql('effective_from')} AS effective_from, CAST(row_number() OVER (ORDER BY versions.effective_from DESC, price_book_id) AS INTEGER) AS place FROM versions", _ORDER_BOOKS))
def books_newest_first(spark, sf_dir):
    """All price books, newest first."""
    ordered = pricebooks.books_newest_first(_order_books(spark, sf_dir))
    return placed(ordered).select("price_book_id", ts("effective_from", "effective_from"), "place")


def _supplier_rules(spark, sf_dir):
    """A rule per supplier in the book of its nation."""
    return W.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("rule_id"), F.col("s_nationkey").alias("price_book_id"), F.col("s_name").alias("metric_type")
    )


def _nation_books(spark, sf_dir):
    return W.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("price_book_id"), F.col("n_name").alias("name"))


@query("SELECT n_nationkey AS price_book_id, n_name AS name, count(s_suppkey) AS rule_count FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2")
def rules_per_book(spark, sf_dir):
    """Number of rules per price book."""
    return pricebooks.rules_per_book(_nation_books(spark, sf_dir), _supplier_rules(spark, sf_dir))


@query("SELECT s_suppkey AS rule_id, s_name AS metric_type FROM supplier WHERE s_nationkey = 3")
def rules_of_book(spark, sf_dir):
    """Rules of one price book."""
    return pricebooks.rules_of_book(_supplier_rules(spark, sf_dir), 3).select("rule_id", "metric_type")


@query(
    """SELECT s_suppkey AS rule_id, CASE WHEN s_nationkey >= 20 THEN 'refused' ELSE 'stored' END AS outcome FROM supplier
       UNION ALL SELECT -p_partkey - 1, CASE WHEN p_size - 1 >= 20 THEN 'refused' ELSE 'stored' END FROM part"""
)
def rules_appended(spark, sf_dir):
    """New rules are stored when their book exists, refused otherwise."""
    known = _nation_books(spark, sf_dir).filter("price_book_id < 20")
    existing = _supplier_rules(spark, sf_dir)
    valid, orphaned = tables.append_checked(existing.limit(0), existing, known, "price_book_id", "PRICE_BOOK_NOT_FOUND")
    new = W.table(spark, sf_dir, "part").select(
        (-F.col("p_partkey") - 1).alias("rule_id"), (F.col("p_size") - 1).alias("price_book_id"), F.col("p_name").alias("metric_type")
    )
    stored, refused = tables.append_checked(valid, new, known, "price_book_id", "PRICE_BOOK_NOT_FOUND")
    return (
        stored.select("rule_id", F.lit("stored").alias("outcome"))
        .unionByName(refused.select("rule_id", F.lit("refused").alias("outcome")))
        .unionByName(orphaned.select("rule_id", F.lit("refused").alias("outcome")))
    )


# --- charges ---------------------------------------------------------------------------

_CHARGE = "charge_id, customer_id, metric_type, price_book_id, price_version, rule_id, CAST(quantity AS DECIMAL(20,6)) AS quantity, unit_price, subtotal"
_FIELDS = ["charge_id", "customer_id", "metric_type", "price_book_id", "price_version", "rule_id", "quantity", "unit_price"]
_SUMMED = "SELECT rule_id, count(*) AS charges, CAST(sum(quantity) AS DECIMAL(28,6)) AS quantity, CAST(sum(subtotal) AS DECIMAL(18,2)) AS subtotal FROM rated WHERE reason IS NULL GROUP BY rule_id"


def _per_rule(rows):
    return rows.groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("charges"),
        F.sum("quantity").cast("decimal(28,6)").alias("quantity"),
        money(F.sum("subtotal"), "subtotal"),
    )


@query(W.rated_sql(f"SELECT {_CHARGE} FROM rated WHERE reason IS NULL"))
def charges_rated(spark, sf_dir):
    """Charges of all usage windows and late events."""
    return charges(spark, sf_dir).select(*_FIELDS, money("subtotal", "subtotal"))


@query(W.rated_sql("SELECT customer_id, metric_type, CAST(quantity AS DECIMAL(20,6)) AS quantity, price_book_id, reason FROM rated WHERE reason IS NOT NULL"))
def charges_unrated(spark, sf_dir):
    """Usage without a charge, with the reason."""
    return rated(spark, sf_dir)[1].select("customer_id", "metric_type", "quantity", "price_book_id", "reason")


@query(W.rated_sql(f"SELECT {_CHARGE}, source_event_id, {ts_sql('calculated_at')} AS calculated_at FROM rated WHERE reason IS NULL AND source_event_id IS NOT NULL"))
def charges_of_late_events(spark, sf_dir):
    """Late events, each rated as a charge of its own."""
    _, late = metering.split_late(W.telemetry(spark, sf_dir), F.col("ingestion_time"))
    wanted = rating.late_events_to_rate(late, ["ingestion_time"])
    rows, _ = rating.rate(wanted, W.books(spark), W.rules(spark), F.col("ingestion_time"), rating.RatingOptions(trail=False))
    return rows.select(*_FIELDS, money("subtotal", "subtotal"), "source_event_id", ts("calculated_at", "calculated_at"))


@query(W.rated_sql(_SUMMED, price_scale=6))
def charges_unrounded_prices(spark, sf_dir):
    """Charges with unit prices kept at six decimals, per rule."""
    return _per_rule(charges(spark, sf_dir, price_scale=6))


@query(W.rated_sql(_SUMMED, flat="per_unit"))
def charges_flat_per_unit(spark, sf_dir):
    """Charges with the flat model read as price per unit, per rule."""
    return _per_rule(charges(spark, sf_dir, flat_mode="per_unit"))


@query(W.rated_sql(_SUMMED, committed="overage"))
def charges_committed_overage(spark, sf_dir):
    """Charges with committed units and overage priced apart, per rule."""
    return _per_rule(charges(spark, sf_dir, committed_mode="overage"))


@query(W.rated_sql(_SUMMED, lookup="rule_first"))
def charges_rule_first(spark, sf_dir):
    """Charges when the book is chosen among those with a rule for the metric."""
    return _per_rule(charges(spark, sf_dir, lookup="rule_first"))


_MONTHLY = {
    "monthly": """SELECT customer_id, metric_type, CAST(sum(value) AS DECIMAL(20,6)) AS quantity, date_trunc('month', window_start) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS effective_date,
        customer_id || metric_type || date_trunc('month', window_start) AS aggregation_id, CAST(NULL AS VARCHAR) AS source_event_id, TIMESTAMP '2024-02-01' AS calculated_at
        FROM usage GROUP BY customer_id, metric_type, date_trunc('month', window_start)"""
}


@query(
    W.rated_sql(
        f"SELECT customer_id, metric_type, {ts_sql('effective_date')} AS month, CAST(quantity AS DECIMAL(20,6)) AS quantity, subtotal FROM rated WHERE reason IS NULL",
        source="monthly", before=_MONTHLY,
    )
)
def charges_period_tiers(spark, sf_dir):
    """Usage rated once per month, so that tiers cover the month."""
    monthly = rating.period_usage(on_time_usage(spark, sf_dir))
    last_day = F.col("effective_date") + F.expr("interval 1 month") - F.expr("interval 1 day")
    usage = rating.usage_to_rate(monthly).withColumns({"effective_date": last_day, "calculated_at": F.lit("2024-02-01").cast("timestamp")})
    found = rated(spark, sf_dir, usage=usage)[0]
    return found.select("customer_id", "metric_type", ts("effective_date", "month"), "quantity", money("subtotal", "subtotal"))


def _plain(expression: str) -> str:
    text = f"CAST({expression} AS VARCHAR)"
    return f"(CASE WHEN strpos({text}, '.') > 0 THEN rtrim(rtrim({text}, '0'), '.') ELSE {text} END)"


_FORMULAS = {
    "entered": """SELECT n, tier, unit_price, flat_fee, pricing_model, quantity, fitting, tier_count,
        CAST(greatest(least(quantity, coalesce(up_to, quantity)) - lower_limit, 0) AS DECIMAL(20,6)) AS units,
        (pricing_model = 'tiered' AND (quantity > lower_limit OR tier = 1)) OR (pricing_model = 'volume' AND tier = coalesce(fitting, tier_count))
          OR (pricing_model NOT IN ('tiered', 'volume') AND tier = 1) AS used FROM stepped""",
    "formulas": f"""SELECT n, count(*) FILTER (pricing_model = 'tiered') AS tiers_applied, string_agg(CASE pricing_model
        WHEN 'tiered' THEN '(' || {_plain('unit_price')} || ' × ' || {_plain('units')} || ' + ' || {_plain('flat_fee')} || ')'
        WHEN 'volume' THEN {_plain('unit_price')} || ' × ' || {_plain('quantity')} || ' + ' || {_plain('flat_fee')}
        WHEN 'flat' THEN {_plain('unit_price')} ELSE {_plain('unit_price')} || ' × ' || {_plain('quantity')} END, ' + ' ORDER BY tier) AS formula
        FROM entered WHERE used GROUP BY n""",
}


@query(
    W.rated_sql(
        """SELECT r.charge_id, CASE r.pricing_model WHEN 'committed' THEN 'per_unit' ELSE r.pricing_model END AS model, f.formula,
             CASE WHEN r.pricing_model = 'tiered' THEN CAST(f.tiers_applied AS INTEGER) END AS tiers_applied
           FROM rated r JOIN formulas f USING (n) WHERE r.reason IS NULL""",
        extra=_FORMULAS,
    )
)
def charges_trail(spark, sf_dir):
    """How every charge came about."""
    rows = charges(spark, sf_dir, trail=True)
    trail = F.col("calculation_metadata")
    return rows.select(
        "charge_id", trail["model"].alias("model"), trail["formula"].alias("formula"), F.size(trail["tiersApplied"]).alias("tiers_applied")
    )


@query(
    W.rated_sql(
        f"""SELECT charge_id, customer_id, {ts_sql('calculated_at')} AS created_at, {ts_sql('period_start')} AS period_start, rule_id, coalesce(rule_unit, 'x') AS unit
            FROM rated JOIN requests p USING (customer_id) WHERE reason IS NULL AND calculated_at BETWEEN period_start AND period_end""",
        needs=("requests",),
    )
)
def charges_in_period(spark, sf_dir):
    """Charges of every requested billing period, with metric and unit of their rule."""
    from tallymark.operators.invoicing import with_rule

    found = rating.charges_for_periods(charges(spark, sf_dir), W.requests(spark, sf_dir))
    named = with_rule(found, W.rules(spark))
    return named.select("charge_id", "customer_id", ts("created_at", "created_at"), ts("period_start", "period_start"), "rule_id", F.col("rule_unit").alias("unit"))


@query(
    W.rated_sql(
        """SELECT customer_id, p.n, count(*) AS charges, CAST(sum(subtotal) AS DECIMAL(18,2)) AS subtotal FROM rated JOIN periods p USING (customer_id)
           WHERE reason IS NULL AND calculated_at BETWEEN p.period_start AND p.period_end GROUP BY customer_id, p.n""",
        extra={
            "periods": """SELECT c_custkey AS customer_id, n, TIMESTAMP '2024-01-01' + to_days(CAST(3 * n AS INTEGER)) + to_hours(c_custkey % 5) AS period_start,
              TIMESTAMP '2024-01-01' + to_days(CAST(3 * n AS INTEGER)) + to_hours(c_custkey % 5 + n * n * n * n) AS period_end FROM customer, range(12) AS r(n)"""
        },
    )
)
def charges_in_overlapping_periods(spark, sf_dir):
    """Charges of twelve periods a customer that overlap, from none to twenty months long."""
    customers = W.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    numbered = customers.withColumn("n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(11).cast("long"))))
    start = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("n").cast("int") * 3, (F.col("customer_id") % 5).cast("int"))
    periods = numbered.withColumn("period_start", start)
    periods = periods.withColumn("period_end", start + F.make_dt_interval(F.lit(0), (F.col("n") * F.col("n") * F.col("n") * F.col("n")).cast("int")))
    found = rating.charges_for_periods(charges(spark, sf_dir), periods)
    return found.groupBy("customer_id", "n").agg(F.count(F.lit(1)).alias("charges"), F.sum("subtotal").cast("decimal(18,2)").alias("subtotal"))


@query(W.rated_sql(f"SELECT charge_id, metric_type, subtotal, {ts_sql('calculated_at')} AS created_at, CAST(row_number() OVER (ORDER BY rated.calculated_at, charge_id) AS INTEGER) AS place FROM rated WHERE reason IS NULL AND customer_id = 3"))
def charges_of_customer(spark, sf_dir):
    """Charges of one customer, oldest first."""
    found = analytics.charges_of_customer(charges(spark, sf_dir), 3)
    ordered = analytics.oldest_first(found, "created_at", "charge_id")
    return placed(ordered).select("charge_id", "metric_type", money("subtotal", "subtotal"), ts("created_at", "created_at"), "place")


@query(
    W.rated_sql(
        """SELECT customer_id, count(*) AS charges, CAST(sum(subtotal) AS DECIMAL(18,2)) AS total FROM rated WHERE reason IS NULL
           GROUP BY customer_id ORDER BY total DESC, customer_id LIMIT 10"""
    )
)
def charges_top_customers(spark, sf_dir):
    """Ten customers with the highest charges: events to usage to charges."""
    totals = charges(spark, sf_dir).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("charges"), money(F.sum("subtotal"), "total")
    )
    return totals.orderBy(F.col("total").desc(), "customer_id").limit(10)


@query(
    W.rated_sql(
        """SELECT customer_id, metric_type, aggregation_id, source_event_id, price_book_id, CASE WHEN reason IS NULL AND subtotal <= 9999999999.99 THEN rule_id END AS rule_id,
             CASE WHEN reason IS NULL AND subtotal <= 9999999999.99 THEN subtotal END AS subtotal, CASE WHEN reason IS NULL AND subtotal > 9999999999.99 THEN 'CALCULATION_ERROR' ELSE reason END AS reason
           FROM rated""",
        source="large_usage",
        before=W.MANY_SQL,
    )
)
def charges_many_books(spark, sf_dir):
    """Usage rated by a book for each supplier with all pricing models; some quantities are too large for an amount."""
    usage = to_rate(spark, sf_dir)
    large = F.lit("90000000000000").cast("decimal(20,6)")
    usage = usage.withColumn("quantity", F.when(F.col("customer_id") % 50 == 1, large).otherwise(F.col("quantity")))
    books, rules = W.many_books(spark, sf_dir), W.many_rules(spark, sf_dir)
    found, unrated = rating.rate(usage, books, rules, F.col("calculated_at"), rating.RatingOptions(trail=False))
    key = ["customer_id", "metric_type", "aggregation_id", "source_event_id", "price_book_id"]
    none = F.lit(None).cast("string")
    charged = found.select(*key, "rule_id", money("subtotal", "subtotal"), none.alias("reason"))
    return charged.unionByName(unrated.select(*key, none.alias("rule_id"), money(F.lit(None), "subtotal"), "reason"))
