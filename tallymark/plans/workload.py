"""The given tables read as billing data, in Spark and in SQL.

events    -> telemetry: customer, metric, value; arrival 0 to 27 minutes after the event
customer  -> customers with currency and tax region, and their credits
orders    -> invoices (customer, month) with a status
lineitem  -> invoice lines with the return flag as metric
Price books and rules are a small fixed catalogue over the days of the events.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.plans.registry import id_sql
from tallymark.schemas import TIERS

# --- catalogue -------------------------------------------------------------------------

BOOKS = [
    # id, name, family, version, from, until
    ("book-a", "January", "fam", "v1", "2024-01-02 00:00:00", "2024-01-15 00:00:00"),
    ("book-b", "Mid January", "fam", "v2", "2024-01-15 00:00:00", None),
    ("book-promo", "Promotion", "promo", "p1", "2024-01-10 06:00:00", "2024-01-12 00:00:00"),
]

RULES = [
    # id, book, metric, model, unit, [(up to, unit price, flat fee)]
    ("a-api", "book-a", "api_calls", "tiered", "count", [(10, "0.10", "0"), (50, "0.08", "1.00"), (None, "0.05", "0")]),
    ("a-band", "book-a", "bandwidth_mb", "volume", "megabytes", [(20, "0.50", "0"), (60, "0.40", "2.00"), (None, "0.30", "0")]),
    ("a-comp", "book-a", "compute_hours", "per_unit", "hours", [(None, "0.755", "0")]),
    ("a-peak", "book-a", "storage_gb_peak", "flat", "count", [(None, "3.505", "0")]),
    ("b-api", "book-b", "api_calls", "tiered", "count", [(5, "0.020", "0"), (25, "0.015", "0.25"), (60, "0.010", "0")]),
    ("b-band", "book-b", "bandwidth_mb", "volume", "megabytes", [(15, "0.45", "0"), (70, "0.35", "1.50")]),
    ("b-comp", "book-b", "compute_hours", "committed", "hours", [(30, "0.50", "0"), (None, "0.75", "0")]),
    ("b-peak", "book-b", "storage_gb_peak", "flat", "count", [(None, "2.50", "0")]),
    ("b-sign", "book-b", "signup", "per_unit", "count", [(None, "0.015", "0")]),
    ("p-api", "book-promo", "api_calls", "per_unit", "count", [(None, "0.01", "0")]),
    ("p-odd", "book-promo", "compute_hours", "custom", "hours", [(None, "0.01", "0")]),
]


def _quoted(value) -> str:
    return "NULL" if value is None else f"'{value}'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_quoted(v) for v in row) + ")" for row in rows)


def _tiers_json(tiers) -> str:
    return json.dumps(
        [
            {"tier": i + 1, "upTo": up_to, "unitPrice": float(price), "flatFee": float(fee)}
            for i, (up_to, price, fee) in enumerate(tiers)
        ]
    )


def books(spark: SparkSession) -> DataFrame:
    return spark.sql(
        f"""SELECT price_book_id, name, parent_id, version, CAST(f AS TIMESTAMP) AS effective_from,
                   CAST(u AS TIMESTAMP) AS effective_until
            FROM VALUES {_values(BOOKS)} AS t(price_book_id, name, parent_id, version, f, u)"""
    )


def rules(spark: SparkSession) -> DataFrame:
    rows = [(r, b, m, model, unit, _tiers_json(tiers)) for r, b, m, model, unit, tiers in RULES]
    table = spark.sql(
        f"SELECT * FROM VALUES {_values(rows)} AS t(rule_id, price_book_id, metric_type, pricing_model, unit, tiers)"
    )
    return table.withColumn("tiers", F.from_json("tiers", TIERS))


# --- catalogue of many books: one for each supplier, with a rule for each of four metrics ---------

MANY_METRICS = ["api_calls", "bandwidth_mb", "compute_hours", "storage_gb_peak"]
MANY_MODELS = ["flat", "per_unit", "tiered", "volume", "committed"]


def many_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    start = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=(key * 7 % 700).cast("int"))
    until = F.when(key % 4 != 0, start + F.make_dt_interval(days=(key % 9 + 1).cast("int")))
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s-"), key).alias("price_book_id"), F.concat(F.lit("v"), key).alias("version"),
        start.alias("effective_from"), until.alias("effective_until"),
    )


def many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, n = F.col("s_suppkey"), F.col("n")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.posexplode(F.array(*[F.lit(m) for m in MANY_METRICS])).alias("n", "metric_type"))
    limit = (key % 20 + 5).cast("decimal(20,6)")
    price = lambda k: (F.lit("0.0125").cast("decimal(5,4)") * (k % 7 + 1).cast("int")).cast("decimal(12,6)")

    def tier(number: int, up_to, unit_price, fee):
        return F.struct(F.lit(number).alias("tier"), up_to.alias("upTo"), unit_price.alias("unitPrice"), fee.cast("decimal(12,2)").alias("flatFee"))

    second = F.when(key % 6 == 0, (limit * 4).cast("decimal(20,6)"))
    tiers = [tier(1, limit, price(key), F.lit(0)), tier(2, second, price(key + n), key % 3)]
    model = F.element_at(F.array(*[F.lit(m) for m in MANY_MODELS]), ((key + n) % 5 + 1).cast("int"))
    return rows.select(
        F.concat_ws("-", F.lit("s"), key, "metric_type").alias("rule_id"), F.concat(F.lit("s-"), key).alias("price_book_id"), "metric_type",
        model.alias("pricing_model"), F.lit("count").alias("unit"), F.array(*tiers).cast(TIERS).alias("tiers"),
    )


MANY_SQL = {
    "books": """SELECT 's-' || s_suppkey AS price_book_id, 'v' || s_suppkey AS version, TIMESTAMP '2024-01-01' + to_hours(CAST(s_suppkey * 7 % 700 AS INTEGER)) AS effective_from,
        CASE WHEN s_suppkey % 4 <> 0 THEN TIMESTAMP '2024-01-01' + to_hours(CAST(s_suppkey * 7 % 700 AS INTEGER)) + to_days(CAST(s_suppkey % 9 + 1 AS INTEGER)) END AS effective_until
      FROM supplier""",
    "tiers": f"""SELECT 's-' || s_suppkey || '-' || metric_type AS rule_id, 's-' || s_suppkey AS price_book_id, metric_type, {MANY_MODELS}[(s_suppkey + m - 1) % 5 + 1] AS pricing_model,
        'count' AS unit, CAST(tier AS INTEGER) AS tier, CAST(CASE WHEN tier = 1 THEN s_suppkey % 20 + 5 WHEN s_suppkey % 6 = 0 THEN (s_suppkey % 20 + 5) * 4 END AS DECIMAL(20,6)) AS up_to,
        CAST(CAST(0.0125 AS DECIMAL(5,4)) * CASE WHEN tier = 1 THEN s_suppkey % 7 + 1 ELSE (s_suppkey + m - 1) % 7 + 1 END AS DECIMAL(12,6)) AS unit_price,
        CAST(CASE WHEN tier = 2 THEN s_suppkey % 3 ELSE 0 END AS DECIMAL(12,2)) AS flat_fee, 2 AS tier_count
      FROM supplier, (SELECT unnest({MANY_METRICS}) AS metric_type, unnest(range(1, 5)) AS m) AS metrics, range(1, 3) AS t(tier)""",
    "large_usage": """SELECT * REPLACE (CASE WHEN customer_id % 50 = 1 THEN CAST(90000000000000 AS DECIMAL(20,6)) ELSE quantity END AS quantity) FROM to_rate""",
}

# --- tables ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; times without zone are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in plain}) if plain else df


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_of(table(spark, sf_dir, "events"))


def telemetry_of(events: DataFrame) -> DataFrame:
    """Events, from a table or a stream, as telemetry."""
    event_type = F.col("event_type")
    metric = (
        F.when(event_type == "click", "api_calls")
        .when(event_type == "view", "bandwidth_mb")
        .when(event_type == "purchase", "compute_hours")
        .when(event_type == "error", "storage_gb_peak")
        .otherwise(event_type)
    )
    value = F.col("value").cast("decimal(20,6)")
    return events.select(
        "event_id",
        "event_type",
        metric.alias("metric_type"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("event_time"),
        (F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 10).cast("int") * 3)).alias("ingestion_time"),
        value.alias("value"),
        F.concat(F.lit('{"value": '), F.col("value").cast("decimal(20,2)").cast("string"), F.lit("}")).alias("metadata"),
        F.col("props"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pick(names: list[str]):
        return F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("c_nationkey") % 5 + 1).cast("int"))

    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        pick(["USD", "EUR", "GBP", "JPY", "BRL"]).alias("billing_currency"),
        F.when(F.col("c_custkey") % 11 != 0, pick(["US-STANDARD", "EU-DE", "EU-FR", "UK-VAT", "NO-TAX"])).alias("tax_region"),
        F.when(F.col("c_custkey") % 17 == 0, "suspended").otherwise("active").alias("status"),
        "c_mktsegment",
        "c_acctbal",
    )


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three credits per customer with a positive balance: two lasting, one expiring."""
    balance = F.col("c_acctbal").cast("decimal(18,2)")
    owners = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select("c_custkey", balance.alias("balance"))
    numbered = owners.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    return numbered.select(
        F.concat(F.lit("cr-"), F.col("c_custkey").cast("string"), F.lit("-"), F.col("n").cast("string")).alias("credit_id"),
        F.col("c_custkey").alias("customer_id"),
        (F.col("balance") * F.col("n") / 500).cast("decimal(12,2)").alias("remaining_amount"),
        F.when((F.col("c_custkey") % 13 == 0) & (F.col("n") == 1), "void").otherwise("active").alias("status"),
        F.when(F.col("n") == 3, F.lit("2024-06-01 00:00:00").cast("timestamp")).alias("expires_at"),
        (F.lit("2023-06-10 00:00:00").cast("timestamp") - F.make_dt_interval(days=F.col("n"))).alias("created_at"),
    )


def order_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invoice per order; its period is the month of the order."""
    start = F.date_trunc("month", "o_orderdate")
    total = F.col("o_totalprice").cast("decimal(18,2)")
    status = F.col("o_orderstatus")
    billed = status.isin("F", "P")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("customer_id"),
        start.alias("billing_period_start"),
        F.add_months(start, 1).cast("timestamp").alias("billing_period_end"),
        F.col("o_orderdate").alias("created_at"),
        total.alias("total"),
        (total / F.lit(1.05).cast("decimal(5,2)")).cast("decimal(18,2)").alias("subtotal"),
        F.when(status == "F", "issued").when(status == "P", "paid").otherwise("draft").alias("status"),
        F.when(billed, F.col("o_orderdate") + F.expr("interval 3 days")).alias("issued_at"),
        F.element_at(
            F.array(F.lit("USD"), F.lit("EUR"), F.lit("GBP")), (F.col("o_orderkey") % 3 + 1).cast("int")
        ).alias("currency"),
    )
    return rows.withColumns(
        {"tax": (F.col("total") - F.col("subtotal")).cast("decimal(18,2)"), "credits_applied": F.lit(0).cast("decimal(18,2)")}
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charges of the invoices above: one per line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_returnflag").alias("metric_type"),
        F.col("l_quantity").cast("decimal(20,6)").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_shipdate").alias("created_at"),
        "l_partkey",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two billing periods per customer; every tenth customer asks for dollars.

    Ten keys beyond the last one are not customers.
    """
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    missing = known.filter("customer_id < 10").select((F.col("customer_id") + 1000000000).alias("customer_id"))
    periods = F.array(
        F.struct(F.lit("2024-01-01 00:00:00").alias("s"), F.lit("2024-01-15 23:59:59.999999").alias("e")),
        F.struct(F.lit("2024-01-16 00:00:00").alias("s"), F.lit("2024-01-31 23:59:59.999999").alias("e")),
    )
    return (
        known.unionByName(missing)
        .withColumn("_p", F.explode(periods))
        .select(
            "customer_id",
            F.col("_p.s").cast("timestamp").alias("period_start"),
            F.col("_p.e").cast("timestamp").alias("period_end"),
            F.when(F.col("customer_id") % 10 == 0, "USD").alias("currency"),
        )
    )


def earlier_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices of the first period that every third customer already has, in two issues."""
    third = table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("customer_id"))
    rows = third.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    issued = F.lit("2024-01-04 00:00:00").cast("timestamp") + F.make_dt_interval(days=F.col("n") * (F.col("customer_id") % 7).cast("int"))
    return rows.select(
        F.concat(F.lit("old-"), F.col("customer_id").cast("string"), F.lit("-"), F.col("n").cast("string")).alias("invoice_id"),
        "customer_id",
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("billing_period_start"),
        F.lit("2024-01-15 23:59:59.999999").cast("timestamp").alias("billing_period_end"),
        F.when(F.col("n") == 1, "issued").when(F.col("customer_id") % 2 == 0, "paid").otherwise("draft").alias("status"),
        issued.alias("issued_at"),
        F.lit("2024-01-03 00:00:00").cast("timestamp").alias("created_at"),
    )


# --- the same in SQL -------------------------------------------------------------------

_RULE_ROWS = ", ".join(
    f"('{r}', '{b}', '{m}', '{model}', '{unit}', {i + 1}, "
    f"{'NULL' if up_to is None else up_to}, {price}, {fee}, {len(tiers)})"
    for r, b, m, model, unit, tiers in RULES
    for i, (up_to, price, fee) in enumerate(tiers)
)

CTES: dict[str, tuple[list[str], str]] = {
    "telemetry": (
        [],
        """SELECT event_id, event_type,
             CASE event_type WHEN 'click' THEN 'api_calls' WHEN 'view' THEN 'bandwidth_mb'
                  WHEN 'purchase' THEN 'compute_hours' WHEN 'error' THEN 'storage_gb_peak' ELSE event_type END AS metric_type,
             user_id AS customer_id, ts AS event_time,
             ts + to_minutes(CAST(event_id % 10 AS INTEGER) * 3) AS ingestion_time,
             CAST(value AS DECIMAL(20,6)) AS value, props
           FROM events""",
    ),
    "judged": (
        ["telemetry"],
        """SELECT *, date_trunc('hour', event_time) < ingestion_time - INTERVAL 1 HOUR AS late FROM telemetry""",
    ),
    "usage": (
        ["judged"],
        f"""SELECT *, {id_sql('customer_id', 'metric_type', "strftime(window_start, '%Y-%m-%d %H:%M:%S')", "'1 hour'")} AS aggregation_id
            FROM (SELECT customer_id, metric_type, date_trunc('hour', event_time) AS window_start,
             date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end,
             CAST(CASE WHEN metric_type IN ('api_calls', 'bandwidth_mb', 'compute_hours') THEN sum(value)
                  WHEN metric_type IN ('storage_gb_peak', 'concurrent_users_max') THEN greatest(max(value), 0)
                  ELSE count(*) END AS DECIMAL(20,6)) AS value,
             CASE metric_type WHEN 'api_calls' THEN 'count' WHEN 'bandwidth_mb' THEN 'megabytes'
                  WHEN 'compute_hours' THEN 'hours' WHEN 'storage_gb_hours' THEN 'gb_hours' ELSE 'count' END AS unit,
             count(*) AS event_count
           FROM judged WHERE NOT late GROUP BY customer_id, metric_type, date_trunc('hour', event_time))""",
    ),
    "books": (
        [],
        f"""SELECT price_book_id, name, parent_id, version, CAST(f AS TIMESTAMP) AS effective_from, CAST(u AS TIMESTAMP) AS effective_until
            FROM (VALUES {_values(BOOKS)}) AS t(price_book_id, name, parent_id, version, f, u)""",
    ),
    "tiers": (
        [],
        f"""SELECT rule_id, price_book_id, metric_type, pricing_model, unit, tier, CAST(up_to AS DECIMAL(20,6)) AS up_to,
              CAST(unit_price AS DECIMAL(12,6)) AS unit_price, CAST(flat_fee AS DECIMAL(12,2)) AS flat_fee, tier_count
            FROM (VALUES {_RULE_ROWS}) AS t(rule_id, price_book_id, metric_type, pricing_model, unit, tier, up_to, unit_price, flat_fee, tier_count)""",
    ),
    "to_rate": (
        ["judged", "usage"],
        """SELECT customer_id, metric_type, value AS quantity, window_start AS effective_date, aggregation_id,
             CAST(NULL AS VARCHAR) AS source_event_id, window_end + INTERVAL 1 HOUR AS calculated_at FROM usage
           UNION ALL
           SELECT customer_id, metric_type, value, event_time, NULL, CAST(event_id AS VARCHAR), ingestion_time
           FROM judged WHERE late""",
    ),
    "customers": (
        [],
        """SELECT c_custkey AS customer_id, c_name AS name,
             ['USD','EUR','GBP','JPY','BRL'][c_nationkey % 5 + 1] AS billing_currency,
             CASE WHEN c_custkey % 11 <> 0 THEN ['US-STANDARD','EU-DE','EU-FR','UK-VAT','NO-TAX'][c_nationkey % 5 + 1] END AS tax_region,
             CASE WHEN c_custkey % 17 = 0 THEN 'suspended' ELSE 'active' END AS status, c_mktsegment, c_acctbal
           FROM customer""",
    ),
    "credits": (
        [],
        """SELECT 'cr-' || c_custkey || '-' || n AS credit_id, c_custkey AS customer_id,
             CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) * n AS DECIMAL(18,2)) * CAST(0.002 AS DECIMAL(4,3)) AS DECIMAL(12,2)) AS remaining_amount,
             CASE WHEN c_custkey % 13 = 0 AND n = 1 THEN 'void' ELSE 'active' END AS status,
             CASE WHEN n = 3 THEN TIMESTAMP '2024-06-01' END AS expires_at,
             TIMESTAMP '2023-06-10' - to_days(n) AS created_at
           FROM customer, (VALUES (1), (2), (3)) AS k(n) WHERE c_acctbal > 0""",
    ),
    "order_invoices": (
        [],
        """SELECT *, total - subtotal AS tax FROM (
             SELECT o_orderkey AS invoice_id, o_custkey AS customer_id, date_trunc('month', o_orderdate) AS billing_period_start,
             date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS billing_period_end, o_orderdate AS created_at,
             CAST(o_totalprice AS DECIMAL(18,2)) AS total,
             CAST(CAST((CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS HUGEINT) * 200 + 105) // 210 AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS subtotal,
             CASE o_orderstatus WHEN 'F' THEN 'issued' WHEN 'P' THEN 'paid' ELSE 'draft' END AS status,
             CASE WHEN o_orderstatus IN ('F','P') THEN o_orderdate + INTERVAL 3 DAY END AS issued_at,
             ['USD','EUR','GBP'][o_orderkey % 3 + 1] AS currency, CAST(0 AS DECIMAL(18,2)) AS credits_applied
           FROM orders)""",
    ),
    "requests": (
        [],
        """SELECT customer_id, CAST(s AS TIMESTAMP) AS period_start, CAST(e AS TIMESTAMP) AS period_end,
             CASE WHEN customer_id % 10 = 0 THEN 'USD' END AS currency
           FROM (SELECT c_custkey AS customer_id FROM customer
                 UNION ALL SELECT c_custkey + 1000000000 FROM customer WHERE c_custkey < 10),
                (VALUES ('2024-01-01 00:00:00', '2024-01-15 23:59:59.999999'),
                        ('2024-01-16 00:00:00', '2024-01-31 23:59:59.999999')) AS p(s, e)""",
    ),
    "earlier": (
        [],
        """SELECT 'old-' || c_custkey || '-' || n AS invoice_id, c_custkey AS customer_id,
             TIMESTAMP '2024-01-01' AS billing_period_start, TIMESTAMP '2024-01-15 23:59:59.999999' AS billing_period_end,
             CASE WHEN n = 1 THEN 'issued' WHEN c_custkey % 2 = 0 THEN 'paid' ELSE 'draft' END AS status,
             TIMESTAMP '2024-01-04' + to_days(CAST(n * (c_custkey % 7) AS INTEGER)) AS issued_at
           FROM customer, (VALUES (1), (2)) AS k(n) WHERE c_custkey % 3 = 0""",
    ),
}


def sql(needs: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """Body with the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in CTES[name][0]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    # A name given anew goes before the one known here.
    parts = [f"{name} AS ({CTES[name][1]})" for name in ordered if name not in (extra or {})]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _rated(price_scale: int, flat: str, committed: str, lookup: str, source: str) -> dict[str, str]:
    price = f"CAST(unit_price AS DECIMAL(18,{price_scale}))"
    book = (
        "SELECT {what} FROM books b {rule} WHERE b.effective_from <= u.effective_date "
        "AND (b.effective_until IS NULL OR b.effective_until > u.effective_date) "
        "ORDER BY b.effective_from DESC, b.price_book_id LIMIT 1"
    )
    rule = (
        "JOIN (SELECT DISTINCT price_book_id, metric_type FROM tiers) r ON r.price_book_id = b.price_book_id AND r.metric_type = u.metric_type"
        if lookup == "rule_first"
        else ""
    )
    graduated = "pricing_model = 'tiered'" if committed == "per_unit" else "pricing_model IN ('tiered', 'committed')"
    flat_charge = f"CAST({price} AS DECIMAL(18,2))" if flat == "once" else f"CAST({price} * quantity AS DECIMAL(18,2))"
    single = "pricing_model = 'per_unit'" if committed == "overage" else "pricing_model IN ('per_unit', 'committed')"
    missing = "'NO_PRICE_RULE'" if lookup == "rule_first" else "'NO_PRICE_BOOK_FOR_DATE'"
    return {
        "numbered": f"SELECT u.*, row_number() OVER () AS n FROM {source} u",
        "booked": f"SELECT u.*, ({book.format(what='b.price_book_id', rule=rule)}) AS price_book_id FROM numbered u",
        "stepped": """SELECT b.n, b.quantity, t.*, coalesce(lag(t.up_to) OVER (PARTITION BY b.n ORDER BY t.tier), 0) AS lower_limit,
             min(CASE WHEN t.up_to IS NULL OR b.quantity <= t.up_to THEN t.tier END) OVER (PARTITION BY b.n) AS fitting
           FROM booked b JOIN tiers t ON t.price_book_id = b.price_book_id AND t.metric_type = b.metric_type""",
        "amounts": f"""SELECT n, min(rule_id) AS rule_id, min(pricing_model) AS pricing_model, min(unit) AS rule_unit,
             max(CASE WHEN tier = 1 THEN unit_price END) AS unit_price,
             CAST(sum(CASE
               WHEN {graduated} THEN CASE WHEN quantity > lower_limit OR tier = 1 THEN
                  CAST({price} * greatest(least(quantity, coalesce(up_to, quantity)) - lower_limit, 0) AS DECIMAL(18,2)) + flat_fee ELSE 0 END
               WHEN pricing_model = 'volume' THEN CASE WHEN tier = coalesce(fitting, tier_count) THEN
                  CAST({price} * quantity AS DECIMAL(18,2)) + flat_fee ELSE 0 END
               WHEN pricing_model = 'flat' THEN CASE WHEN tier = 1 THEN {flat_charge} ELSE 0 END
               WHEN {single} THEN CASE WHEN tier = 1 THEN CAST({price} * quantity AS DECIMAL(18,2)) ELSE 0 END
             END) AS DECIMAL(18,2)) AS subtotal
           FROM stepped GROUP BY n""",
        "rated": f"""SELECT b.*, bk.version AS price_version, a.rule_id, a.pricing_model, a.rule_unit, a.unit_price, a.subtotal,
             CASE WHEN b.price_book_id IS NULL THEN {missing} WHEN a.rule_id IS NULL THEN 'NO_PRICE_RULE'
                  WHEN a.subtotal IS NULL THEN 'INVALID_PRICE_RULE' END AS reason,
             {id_sql('b.customer_id', 'b.metric_type', 'b.aggregation_id', 'b.source_event_id', 'a.rule_id', "CASE WHEN b.effective_date = date_trunc('second', b.effective_date) THEN strftime(b.effective_date, '%Y-%m-%d %H:%M:%S') ELSE rtrim(strftime(b.effective_date, '%Y-%m-%d %H:%M:%S.%f'), '0') END")} AS charge_id
           FROM booked b LEFT JOIN amounts a USING (n) LEFT JOIN books bk ON bk.price_book_id = b.price_book_id""",
    }


def rated_sql(
    body: str,
    price_scale: int = 2,
    flat: str = "once",
    committed: str = "per_unit",
    lookup: str = "book_first",
    source: str = "to_rate",
    needs: tuple[str, ...] = (),
    extra: dict[str, str] | None = None,
    before: dict[str, str] | None = None,
) -> str:
    """SQL over the CTE ``rated``: charges and reasons computed tier by tier."""
    steps = (before or {}) | _rated(price_scale, flat, committed, lookup, source) | (extra or {})
    return sql(["to_rate", "books", "tiers", *needs], body, steps)
