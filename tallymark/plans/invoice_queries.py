"""Invoice runs, corrections, credits, exports and revenue."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.operators import analytics, credits, invoicing
from tallymark.operators.summaries import Summary
from tallymark.plans import workload as W
from tallymark.plans.rating_queries import charges
from tallymark.plans.registry import id_sql, iso_sql, money, placed, query, ts, ts_sql

AS_OF = "2024-02-05 00:00:00"

# --- inputs ----------------------------------------------------------------------------


def run(spark, sf_dir, **options):
    """Invoices for all requests of the workload."""
    return invoicing.generate_invoices(
        W.requests(spark, sf_dir),
        W.customers(spark, sf_dir),
        charges(spark, sf_dir),
        W.rules(spark),
        W.earlier_invoices(spark, sf_dir),
        W.credits(spark, sf_dir),
        AS_OF,
        **options,
    )


_FX = "CASE {c} WHEN 'USD' THEN 1.00 WHEN 'EUR' THEN 0.92 WHEN 'GBP' THEN 0.78 WHEN 'JPY' THEN 150.00 WHEN 'BRL' THEN 5.00 ELSE 1.00 END"
_TAX = "CASE {r} WHEN 'EU-DE' THEN 0.19 WHEN 'EU-FR' THEN 0.20 WHEN 'UK-VAT' THEN 0.20 WHEN 'NO-TAX' THEN 0.00 ELSE 0.05 END"
_D = "DECIMAL(18,2)"
_TIME = "strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _text_of(column: str) -> str:
    plain = f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
    return f"CASE WHEN {column} = date_trunc('second', {column}) THEN {plain} ELSE rtrim(strftime({column}, '%Y-%m-%d %H:%M:%S.%f'), '0') END"


def _run_ctes(basis: str = "calculated_at", lasting: str = "expires_at IS NULL") -> dict[str, str]:
    return {
        "prior": """SELECT * FROM earlier WHERE status IN ('issued', 'paid')
          QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY issued_at DESC, invoice_id) = 1""",
        "asked": """SELECT r.*, c.billing_currency, c.tax_region, p.invoice_id AS prior_id, p.issued_at FROM requests r JOIN customers c USING (customer_id)
          LEFT JOIN prior p ON p.customer_id = r.customer_id AND p.billing_period_start = r.period_start AND p.billing_period_end = r.period_end""",
        "billable": f"""SELECT a.*, r.charge_id, r.metric_type, r.quantity, r.subtotal AS charge, r.calculated_at, r.rule_unit FROM asked a JOIN rated r
          ON r.customer_id = a.customer_id AND r.{basis} BETWEEN a.period_start AND a.period_end
          WHERE r.reason IS NULL AND (a.prior_id IS NULL OR r.calculated_at > a.issued_at)""",
        "sums": """SELECT customer_id, period_start, metric_type, CAST(sum(quantity) AS DECIMAL(20,6)) AS quantity, sum(charge) AS rated_amount,
          count(*) AS charge_count, min(calculated_at) AS first_at, min(rule_unit) AS unit FROM billable GROUP BY customer_id, period_start, metric_type""",
        "totals": "SELECT customer_id, period_start, sum(rated_amount) AS rated, sum(charge_count) AS charge_count FROM sums GROUP BY 1, 2",
        "headers": f"""SELECT *, {id_sql('customer_id', _text_of('period_start'), _text_of('period_end'), 'invoice_type', 'prior_id')} AS invoice_id,
            CAST(subtotal * CAST({_TAX.format(r='tax_region')} AS DECIMAL(5,2)) AS {_D}) AS tax
          FROM (SELECT a.*, coalesce(a.currency, billing_currency) AS invoice_currency, CASE WHEN prior_id IS NULL THEN 'standard' ELSE 'correction' END AS invoice_type,
              CAST(coalesce(t.charge_count, 0) AS BIGINT) AS charge_count,
              CAST(CAST(coalesce(t.rated, 0) AS {_D}) * CAST({_FX.format(c='coalesce(a.currency, billing_currency)')} AS DECIMAL(9,2)) AS {_D}) AS subtotal
            FROM asked a LEFT JOIN totals t USING (customer_id, period_start)) WHERE prior_id IS NULL OR charge_count > 0""",
        "credit_spans": f"""SELECT *, sum(remaining_amount) OVER w AS c1, sum(remaining_amount) OVER w - remaining_amount AS c0
          FROM credits WHERE status = 'active' AND {lasting} AND remaining_amount > 0
          WINDOW w AS (PARTITION BY customer_id ORDER BY expires_at NULLS LAST, created_at, credit_id ROWS UNBOUNDED PRECEDING)""",
        "invoice_spans": """SELECT *, sum(subtotal + tax) OVER w AS t1, sum(subtotal + tax) OVER w - (subtotal + tax) AS t0 FROM headers
          WINDOW w AS (PARTITION BY customer_id ORDER BY period_start, invoice_id ROWS UNBOUNDED PRECEDING)""",
        "paid": f"""SELECT i.invoice_id, c.credit_id, CAST(least(c1, t1) - greatest(c0, t0) AS {_D}) AS amount
          FROM invoice_spans i JOIN credit_spans c ON c.customer_id = i.customer_id AND c0 < t1 AND t0 < c1""",
        "final": f"""SELECT h.*, CAST(coalesce(p.used, 0) AS {_D}) AS credits_applied, CAST(subtotal + tax - coalesce(p.used, 0) AS {_D}) AS total,
            CASE invoice_type WHEN 'correction' THEN 'CORR-' ELSE 'INV-' END || h.invoice_id[1:32] AS invoice_number
          FROM headers h LEFT JOIN (SELECT invoice_id, sum(amount) AS used FROM paid GROUP BY invoice_id) p USING (invoice_id)""",
        "lines": f"""SELECT h.invoice_id, s.*, CAST(s.rated_amount * CAST({_FX.format(c='h.invoice_currency')} AS DECIMAL(9,2)) AS {_D}) AS amount,
            row_number() OVER (PARTITION BY h.invoice_id ORDER BY s.first_at, s.metric_type) AS line_number,
            {id_sql('h.invoice_id', 's.metric_type')} AS line_item_id,
            CASE s.metric_type WHEN 'api_calls' THEN 'Api Calls usage' WHEN 'bandwidth_mb' THEN 'Bandwidth Mb usage' WHEN 'compute_hours' THEN 'Compute Hours usage'
              WHEN 'storage_gb_peak' THEN 'Storage Gb Peak usage' ELSE 'Signup usage' END AS description
          FROM headers h JOIN sums s USING (customer_id, period_start)""",
        "priced_lines": """SELECT *, CASE WHEN quantity > 0 THEN CAST(CAST((CAST(amount * 100 AS HUGEINT) * 2000000 + CAST(quantity * 1000000 AS HUGEINT)) // (2 * CAST(quantity * 1000000 AS HUGEINT)) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,6))
            ELSE 0 END AS unit_price FROM lines""",
    }


def _sql(body: str, **options) -> str:
    return W.rated_sql(body, needs=("requests", "customers", "credits", "earlier"), extra=_run_ctes(**options))


_HEADER_SQL = f"""SELECT invoice_id, invoice_number, invoice_type, customer_id, {ts_sql('period_start')} AS period_start, invoice_currency AS currency,
  subtotal, tax, credits_applied, total, prior_id AS reference_invoice_id, charge_count,
  CASE WHEN prior_id IS NOT NULL THEN 'Back-filled usage from late events' END AS correction_reason, 'draft' AS status FROM final"""


def _headers(rows):
    return rows.select(
        "invoice_id", "invoice_number", "invoice_type", "customer_id", ts("period_start", "period_start"), "currency",
        money("subtotal", "subtotal"), money("tax", "tax"), money("credits_applied", "credits_applied"), money("total", "total"),
        "reference_invoice_id", "charge_count", "correction_reason", "status",
    )


# --- invoice runs ----------------------------------------------------------------------


@query(_sql(_HEADER_SQL))
def invoice_headers(spark, sf_dir):
    """Invoices of all customers: currency, tax, credits, corrections, empty periods."""
    return _headers(run(spark, sf_dir).invoices)


@query(_sql(_HEADER_SQL, basis="effective_date"))
def invoice_headers_by_event_time(spark, sf_dir):
    """The same with charges placed by the time of use."""
    return _headers(run(spark, sf_dir, basis="effective_date").invoices)


@query(_sql(_HEADER_SQL, lasting=f"(expires_at IS NULL OR expires_at >= TIMESTAMP '{AS_OF}')"))
def invoice_headers_expiring_credits(spark, sf_dir):
    """The same with credits that have not expired yet."""
    return _headers(run(spark, sf_dir, honour_expiry=True).invoices)


@query(
    _sql(
        "SELECT line_item_id, invoice_id, CAST(line_number AS INTEGER) AS line_number, description, metric_type, quantity, unit, CAST(unit_price AS DECIMAL(12,6)) AS unit_price, amount, charge_count FROM priced_lines"
    )
)
def invoice_lines(spark, sf_dir):
    """Line items of all invoices."""
    return run(spark, sf_dir).line_items


@query(_sql("SELECT l.line_item_id, b.charge_id FROM billable b JOIN lines l USING (customer_id, period_start, metric_type)"))
def invoice_line_charges(spark, sf_dir):
    """Charges behind every line item."""
    return run(spark, sf_dir).line_charges


@query(_sql(f"SELECT {id_sql('invoice_id', 'credit_id')} AS adjustment_id, invoice_id, credit_id, amount, 'credit_application' AS type, 'Applied from credit ' || credit_id AS reason FROM paid WHERE amount > 0"))
def invoice_adjustments(spark, sf_dir):
    """Credits used per invoice."""
    rows = run(spark, sf_dir).adjustments
    return rows.withColumn("amount", money("amount"))


@query(
    _sql(
        f"""SELECT credit_id, CASE WHEN u.used IS NOT NULL AND remaining_amount = u.used THEN 'fully_used' ELSE status END AS status,
              CAST(remaining_amount - coalesce(u.used, 0) AS {_D}) AS remaining_amount
            FROM credits LEFT JOIN (SELECT credit_id, sum(amount) AS used FROM paid WHERE amount > 0 GROUP BY credit_id) u USING (credit_id)"""
    )
)
def invoice_credit_balances(spark, sf_dir):
    """Credits after the invoice run."""
    return run(spark, sf_dir).credits.select("credit_id", "status", money("remaining_amount", "remaining_amount"))


@query(_sql("SELECT a.customer_id, a.prior_id AS invoice_id FROM asked a LEFT JOIN totals t USING (customer_id, period_start) WHERE a.prior_id IS NOT NULL AND t.charge_count IS NULL"))
def invoice_unchanged(spark, sf_dir):
    """Billed invoices without new charges."""
    return run(spark, sf_dir).unchanged.select("customer_id", "invoice_id")


@query(W.sql(["requests", "customers"], f"SELECT customer_id, {ts_sql('period_start')} AS period_start, 'CUSTOMER_NOT_FOUND' AS reason FROM requests WHERE customer_id NOT IN (SELECT customer_id FROM customers)"))
def invoice_rejected(spark, sf_dir):
    """Requests for unknown customers."""
    return run(spark, sf_dir).rejected.select("customer_id", ts("period_start", "period_start"), "reason")


@query(
    _sql(
        f"""SELECT invoice_id, 'Invoice Number,' || invoice_number || chr(10) || 'Type,' || invoice_type || chr(10) || 'Customer ID,' || customer_id || chr(10)
              || 'Period,' || {iso_sql('period_start')} || ' to ' || {iso_sql('period_end')} || chr(10) || 'Status,draft' || chr(10) || 'Currency,' || invoice_currency || chr(10) || chr(10)
              || 'Line #,Description,Metric,Quantity,Unit,Unit Price,Amount' || chr(10) || coalesce(l.text, '') || chr(10)
              || 'Subtotal,,,,,$,' || subtotal || chr(10) || 'Tax (' || CAST({_TAX.format(r='tax_region')} * 100 AS INTEGER) || '%),,,,,$,' || tax || chr(10)
              || 'Credits Applied,,,,,$,' || credits_applied || chr(10) || 'Total,,,,,$,' || total AS csv
            FROM final LEFT JOIN (SELECT invoice_id, string_agg(concat_ws(',', line_number, description, metric_type, quantity, unit, CAST(unit_price AS DECIMAL(12,6)), amount) || chr(10), '' ORDER BY line_number) AS text
              FROM priced_lines GROUP BY invoice_id) l USING (invoice_id)"""
    )
)
def invoice_csv(spark, sf_dir):
    """Text export of every invoice."""
    done = run(spark, sf_dir)
    return invoicing.csv_text(invoicing.csv_rows(done.invoices, done.line_items, W.customers(spark, sf_dir)))


@query(
    _sql(
        """SELECT f.invoice_id, coalesce(string_agg(l.line_number || ':' || l.metric_type || ':' || l.amount, ';' ORDER BY l.line_number), '') AS lines
           FROM final f LEFT JOIN lines l USING (invoice_id) GROUP BY f.invoice_id"""
    )
)
def invoice_with_lines(spark, sf_dir):
    """Invoices with their lines nested."""
    done = run(spark, sf_dir)
    nested = invoicing.invoices_with_lines(done.invoices, done.line_items)
    line = F.transform("lines", lambda r: F.concat_ws(":", r["line_number"].cast("string"), r["metric_type"], r["amount"].cast("string")))
    return nested.select("invoice_id", F.coalesce(F.array_join(line, ";"), F.lit("")).alias("lines"))


_SALES = {
    "allocated": """SELECT i.invoice_id, c.credit_id, CAST(least(c1, t1) - greatest(c0, t0) AS DECIMAL(18,2)) AS amount
       FROM (SELECT *, sum(total) OVER w AS t1, sum(total) OVER w - total AS t0 FROM order_invoices WINDOW w AS (PARTITION BY customer_id ORDER BY billing_period_start, CAST(invoice_id AS VARCHAR) ROWS UNBOUNDED PRECEDING)) i
       JOIN (SELECT *, sum(bal) OVER w AS c1, sum(bal) OVER w - bal AS c0 FROM (SELECT *, CAST(remaining_amount * 20000 AS DECIMAL(18,2)) AS bal FROM credits WHERE status = 'active')
             WINDOW w AS (PARTITION BY customer_id ORDER BY expires_at NULLS LAST, created_at, credit_id ROWS UNBOUNDED PRECEDING)) c
         ON c.customer_id = i.customer_id AND c0 < t1 AND t0 < c1"""
}


@query(W.sql(["order_invoices", "credits"], "SELECT CAST(invoice_id AS VARCHAR) AS invoice_id, credit_id, amount FROM allocated WHERE amount > 0", _SALES))
def credit_allocation(spark, sf_dir):
    """Large credits spread over all orders of a customer."""
    totals = W.order_invoices(spark, sf_dir).select(
        F.col("invoice_id").cast("string").alias("invoice_id"), "customer_id",
        F.col("billing_period_start").alias("period_start"), F.col("total").alias("amount"),
    )
    balance = (F.col("remaining_amount") * 20000).cast("decimal(18,2)")
    large = W.credits(spark, sf_dir).filter("status = 'active'").withColumn("remaining_amount", balance)
    return credits.allocate(totals, large).select("invoice_id", "credit_id", money("amount", "amount"))


# --- invoice tables --------------------------------------------------------------------


@query(
    W.sql(
        ["order_invoices"],
        f"""SELECT invoice_id, customer_id, {ts_sql('billing_period_start')} AS billing_period_start FROM order_invoices WHERE status IN ('issued', 'paid')
            QUALIFY row_number() OVER (PARTITION BY customer_id, billing_period_start ORDER BY issued_at DESC, created_at DESC, invoice_id) = 1""",
    )
)
def invoice_latest_billed(spark, sf_dir):
    """Latest issued or paid invoice per customer and period."""
    found = invoicing.billed_invoices(W.order_invoices(spark, sf_dir))
    return found.select("invoice_id", "customer_id", ts("billing_period_start", "billing_period_start"))


def _issue(spark, sf_dir):
    ids = W.table(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0").select((F.col("o_orderkey") * 2).alias("invoice_id"))
    return invoicing.issue(W.order_invoices(spark, sf_dir), ids, AS_OF)


@query(
    W.sql(
        ["order_invoices"],
        f"""SELECT invoice_id, CASE WHEN invoice_id % 6 = 0 THEN 'issued' ELSE status END AS status,
              {ts_sql(f"CASE WHEN invoice_id % 6 = 0 AND status <> 'issued' THEN TIMESTAMP '{AS_OF}' ELSE issued_at END")} AS issued_at FROM order_invoices""",
    )
)
def invoice_issue(spark, sf_dir):
    """Invoices after issuing a list of them."""
    return _issue(spark, sf_dir)[0].select("invoice_id", "status", ts("issued_at", "issued_at"))


@query(
    W.sql(
        ["order_invoices"],
        """SELECT o.o_orderkey * 2 AS invoice_id, CASE WHEN i.invoice_id IS NULL THEN 'INVOICE_NOT_FOUND' ELSE 'INVOICE_ALREADY_ISSUED' END AS reason
           FROM orders o LEFT JOIN order_invoices i ON i.invoice_id = o.o_orderkey * 2 WHERE o.o_orderkey % 3 = 0 AND (i.invoice_id IS NULL OR i.status = 'issued')""",
    )
)
def invoice_issue_refused(spark, sf_dir):
    """Ids that could not be issued."""
    return _issue(spark, sf_dir)[1]


@query(
    W.sql(
        ["order_invoices"],
        """SELECT o.o_orderkey * 2 AS invoice_id, CASE WHEN i.invoice_id IS NULL THEN 'missing' ELSE 'found' END AS outcome
           FROM orders o LEFT JOIN order_invoices i ON i.invoice_id = o.o_orderkey * 2""",
    )
)
def invoice_lookup_many(spark, sf_dir):
    """Invoices by a list of ids."""
    ids = W.table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 2).alias("invoice_id"))
    found, missing = invoicing.find_invoices(W.order_invoices(spark, sf_dir), ids)
    return found.select("invoice_id", F.lit("found").alias("outcome")).unionByName(missing.select("invoice_id", F.lit("missing").alias("outcome")))


@query(W.sql(["order_invoices"], f"SELECT invoice_id, {ts_sql('created_at')} AS created_at, total, CAST(row_number() OVER (ORDER BY order_invoices.created_at DESC, invoice_id) AS INTEGER) AS place FROM order_invoices WHERE customer_id = 10"))
def invoices_of_customer(spark, sf_dir):
    """Invoices of one customer, newest first."""
    found = invoicing.invoices_of_customer(W.order_invoices(spark, sf_dir), 10)
    return placed(found).select("invoice_id", ts("created_at", "created_at"), "total", "place")


# --- revenue ---------------------------------------------------------------------------


@query(
    W.sql(
        ["order_invoices"],
        """SELECT strftime(billing_period_start, '%Y-%m') AS month, CAST(sum(total) AS DECIMAL(18,2)) AS total_revenue, CAST(sum(subtotal) AS DECIMAL(18,2)) AS subtotal_revenue,
             CAST(sum(tax) AS DECIMAL(18,2)) AS total_tax FROM order_invoices WHERE status IN ('issued', 'paid') GROUP BY 1""",
    )
)
def revenue_monthly(spark, sf_dir):
    """Billed revenue per month."""
    return analytics.monthly_revenue(W.order_invoices(spark, sf_dir))


@query(
    W.sql(
        ["order_invoices"],
        """SELECT strftime(billing_period_start, '%Y-%m') AS month, currency, CAST(sum(total) AS DECIMAL(18,2)) AS total_revenue, CAST(sum(subtotal) AS DECIMAL(18,2)) AS subtotal_revenue,
             CAST(sum(tax) AS DECIMAL(18,2)) AS total_tax FROM order_invoices WHERE status IN ('issued', 'paid') AND billing_period_start >= TIMESTAMP '2000-09-01' GROUP BY 1, 2""",
    )
)
def revenue_last_year(spark, sf_dir):
    """Billed revenue of the last twelve months, currencies apart."""
    return analytics.monthly_revenue(W.order_invoices(spark, sf_dir), 12, "2001-08-15", by_currency=True)


@query(
    """SELECT l_returnflag AS metric_type, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue,
         CAST(sum(CAST(l_quantity AS DECIMAL(20,6))) AS DECIMAL(28,6)) AS total_quantity FROM lineitem GROUP BY 1"""
)
def revenue_by_metric(spark, sf_dir):
    """Revenue and quantity per metric."""
    return analytics.revenue_by_metric(W.order_lines(spark, sf_dir))


@query(
    W.sql(
        ["order_invoices"],
        """SELECT customer_id, CAST(sum(total) AS DECIMAL(18,2)) AS total_revenue FROM order_invoices WHERE status IN ('issued', 'paid')
           GROUP BY customer_id ORDER BY total_revenue DESC, customer_id LIMIT 10""",
    )
)
def revenue_top_customers(spark, sf_dir):
    """Ten customers with the highest billed revenue."""
    return analytics.top_customers(W.order_invoices(spark, sf_dir))


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ("customer", "events", "orders", "lineitem")))
def table_counts(spark, sf_dir):
    """Rows per table."""
    return analytics.table_counts({t: W.table(spark, sf_dir, t) for t in ("customer", "events", "orders", "lineitem")})


@query(
    """SELECT l_returnflag AS metric_type, l_linenumber AS line_number, count(*) AS rows, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue,
         CAST(max(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS largest
       FROM lineitem WHERE NOT (l_orderkey % 4 = 1 OR (l_orderkey % 4 = 2 AND l_extendedprice > 30000)) GROUP BY ALL"""
)
def revenue_kept_by_changes(spark, sf_dir):
    """Revenue per metric and line number after three rounds of lines added and withdrawn."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    lines = W.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_returnflag").alias("metric_type"), F.col("l_linenumber").alias("line_number"), price.alias("amount"), "l_extendedprice"
    )
    kept = Summary(["metric_type", "line_number"], {"revenue": "amount"}, {"largest": "amount"})
    key, none = F.col("l_orderkey") % 4, F.lit(False)
    rounds = [(key == 1, none), (key == 2, key == 1), (key == 3, (key == 2) & (F.col("l_extendedprice") > 30000))]
    there, summary = key == 0, kept.full(lines.filter(key == 0))
    for added, withdrawn in rounds:
        there = (there | added) & ~withdrawn
        summary = kept.changed(summary, lines.filter(added), lines.filter(withdrawn), lines.filter(there))
    revenue = F.col("revenue").cast("decimal(18,2)").alias("revenue")
    return summary.select("metric_type", "line_number", "rows", revenue, "largest")
