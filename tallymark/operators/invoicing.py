"""Charges to invoices, corrections and line items."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.functions import values as V
from tallymark.functions.money import divide_money, multiply_money, zero_money
from tallymark.operators.credits import adjustments, allocate, spend, usable_credits
from tallymark.operators.dedup import best_row
from tallymark.operators.rating import charges_for_periods
from tallymark.operators.skew import at_most, keyed_join
from tallymark.session import materialise

PERIOD = ["customer_id", "period_start", "period_end"]


def billed_invoices(invoices: DataFrame) -> DataFrame:
    """Latest issued or paid invoice per customer and period."""
    billed = invoices.filter(F.col("status").isin(settings.BILLED_STATUSES))
    newest = [F.col("issued_at").desc_nulls_first(), F.col("created_at").desc_nulls_first(), F.col("invoice_id").asc()]
    return best_row(billed, ["customer_id", "billing_period_start", "billing_period_end"], newest)


def with_rule(charges: DataFrame, rules: DataFrame, **limits) -> DataFrame:
    """Charges with metric and unit of their rule; 'unknown' when the rule is missing."""
    looked_up = rules.select(
        "rule_id", F.col("metric_type").alias("rule_metric"), F.col("unit").alias("rule_unit")
    )
    joined = keyed_join(charges.drop("metric_type"), looked_up, ["rule_id"], ["charge_id"], "left", **limits)
    return joined.withColumn("metric_type", F.coalesce("rule_metric", F.lit("unknown"))).drop("rule_metric")


def billable_charges(
    requests: DataFrame, charges: DataFrame, prior: DataFrame, basis: str = "created_at", **limits
) -> DataFrame:
    """Charges of every requested period, without those an issued invoice covers."""
    periods = requests.select(*PERIOD).join(_prior_by_period(prior), PERIOD, "left")
    matched = charges_for_periods(charges, periods, basis, **limits)
    fresh = F.col("prior_invoice_id").isNull() | (F.col("calculated_at") > F.col("prior_issued_at"))
    return matched.filter(fresh)


def _prior_by_period(prior: DataFrame) -> DataFrame:
    return prior.select(
        "customer_id",
        F.col("billing_period_start").alias("period_start"),
        F.col("billing_period_end").alias("period_end"),
        F.col("invoice_id").alias("prior_invoice_id"),
        F.col("issued_at").alias("prior_issued_at"),
    )


def line_sums(charges: DataFrame) -> DataFrame:
    """Charges per period and metric; the unit is that of the first charge.

    The heavy step groups on plain columns with fixed-size buffers, so it runs as a
    hash aggregate with a partial step on the charge side.
    """
    per_unit = charges.groupBy(*PERIOD, "metric_type", "rule_unit").agg(
        F.sum("quantity").alias("quantity"),
        F.sum("subtotal").alias("amount"),
        F.count(F.lit(1)).alias("charge_count"),
        F.min("created_at").alias("first_charge_at"),
    )
    return per_unit.groupBy(*PERIOD, "metric_type").agg(
        F.sum("quantity").cast("decimal(20,6)").alias("quantity"),
        F.sum("amount").cast("decimal(18,2)").alias("rated_amount"),
        F.sum("charge_count").alias("charge_count"),
        F.min("first_charge_at").alias("first_charge_at"),
        F.coalesce(
            F.min(F.struct("first_charge_at", F.col("rule_unit").alias("unit")))["unit"], F.lit("units")
        ).alias("unit"),
    )


def invoice_headers(
    requests: DataFrame, customers: DataFrame, sums: DataFrame, prior: DataFrame, **limits
) -> tuple[DataFrame, DataFrame]:
    """(new headers before credits, billed invoices that stay unchanged)."""
    totals = sums.groupBy(*PERIOD).agg(
        F.sum("rated_amount").cast("decimal(18,2)").alias("rated_subtotal"),
        F.sum("charge_count").alias("charge_count"),
    )
    known = customers.select("customer_id", "billing_currency", "tax_region")
    joined = (
        keyed_join(requests, known, ["customer_id"], ["period_start", "period_end"], "inner", **limits)
        .join(_prior_by_period(prior), PERIOD, "left")
        .join(totals, PERIOD, "left")
        .withColumn("charge_count", F.coalesce("charge_count", F.lit(0)))
    )
    corrects = F.col("prior_invoice_id").isNotNull()
    unchanged = joined.filter(corrects & (F.col("charge_count") == 0)).select(
        *PERIOD, F.col("prior_invoice_id").alias("invoice_id")
    )
    fresh = joined.filter(~corrects | (F.col("charge_count") > 0))
    currency = F.coalesce("currency", "billing_currency", F.lit(settings.DEFAULT_CURRENCY))
    rated = F.coalesce("rated_subtotal", zero_money())
    headers = (
        fresh.withColumn("currency", currency)
        .withColumn("invoice_type", F.when(corrects, "correction").otherwise("standard"))
        .withColumn("exchange_rate", V.exchange_rate("currency"))
        .withColumn("subtotal", multiply_money(rated, F.col("exchange_rate")))
        .withColumn("tax", multiply_money("subtotal", V.tax_rate("tax_region")))
        .withColumn("total_before_credits", (F.col("subtotal") + F.col("tax")).cast("decimal(18,2)"))
        .withColumn("invoice_id", V.stable_id("customer_id", V.utc_text("period_start"), V.utc_text("period_end"), "invoice_type", "prior_invoice_id"))
        .select(
            "invoice_id",
            V.invoice_number("invoice_type", "invoice_id").alias("invoice_number"),
            "invoice_type",
            *PERIOD,
            "currency",
            "exchange_rate",
            "subtotal",
            "tax",
            "total_before_credits",
            "charge_count",
            F.col("prior_invoice_id").alias("reference_invoice_id"),
            F.when(corrects, settings.CORRECTION_REASON).alias("correction_reason"),
            F.lit("draft").alias("status"),
            F.lit(None).cast("timestamp").alias("issued_at"),
        )
    )
    return headers, unchanged


def line_items(headers: DataFrame, sums: DataFrame) -> DataFrame:
    """One line per invoice and metric, numbered in order of the first charge.

    Each line is converted on its own, so lines may differ from the subtotal by cents.
    Numbering orders at most one row per metric of an invoice.
    """
    keyed = headers.select(*PERIOD, "invoice_id", "exchange_rate").join(sums, PERIOD)
    amount = multiply_money("rated_amount", "exchange_rate")
    number = F.row_number().over(Window.partitionBy("invoice_id").orderBy("first_charge_at", "metric_type"))
    priced = keyed.withColumn("amount", amount)
    unit_price = F.when(F.col("quantity") > 0, divide_money("amount", "quantity")).otherwise(zero_money())
    return priced.select(
        V.stable_id("invoice_id", "metric_type").alias("line_item_id"),
        "invoice_id",
        number.alias("line_number"),
        V.usage_description("metric_type").alias("description"),
        "metric_type",
        "quantity",
        "unit",
        unit_price.cast("decimal(12,6)").alias("unit_price"),
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        "charge_count",
    )


def line_charges(headers: DataFrame, charges: DataFrame, **limits) -> DataFrame:
    """(line_item_id, charge_id): replaces a charge id list on the line."""
    keyed = keyed_join(
        charges.select(*PERIOD, "metric_type", "charge_id"),
        headers.select(*PERIOD, "invoice_id"),
        PERIOD,
        ["charge_id"],
        "inner",
        **limits,
    )
    return keyed.select(V.stable_id("invoice_id", "metric_type").alias("line_item_id"), "charge_id")


class InvoiceRun:
    """Output tables of one invoice run, each worked out when it is asked for.

    What several outputs hang on (line sums, headers, credit use) is written once and
    kept; an output that needs none of these does not wait for them.
    """

    def __init__(
        self,
        requests: DataFrame,
        customers: DataFrame,
        charges: DataFrame,
        rules: DataFrame,
        invoices: DataFrame,
        credits: DataFrame,
        as_of,
        basis: str,
        honour_expiry: bool,
        split_credits: bool | None,
        limits: dict,
    ):
        self._requests, self._customers, self._charges, self._rules = requests, customers, charges, rules
        self._credits, self._as_of = credits, as_of
        self._basis, self._honour_expiry, self._split_credits, self._limits = basis, honour_expiry, split_credits, limits
        self._prior = billed_invoices(invoices)

    def _few(self, df: DataFrame) -> bool:
        return at_most(df, self._limits.get("broadcast_rows", settings.BROADCAST_ROWS))

    @cached_property
    def _few_customers(self) -> bool:
        return self._few(self._customers)

    @cached_property
    def _few_requests(self) -> bool:
        return self._few(self._requests)

    @cached_property
    def _checked(self) -> DataFrame:
        exists = self._customers.select("customer_id", F.lit(True).alias("_exists"))
        by_period = ["period_start", "period_end"]
        return keyed_join(self._requests, exists, ["customer_id"], by_period, "left", small=self._few_customers, **self._limits)

    @cached_property
    def _known(self) -> DataFrame:
        return self._checked.filter("_exists").drop("_exists")

    @property
    def rejected(self) -> DataFrame:
        """Requests for customers that do not exist."""
        missing = self._checked.filter("_exists IS NULL").drop("_exists")
        return missing.withColumn("reason", F.lit("CUSTOMER_NOT_FOUND"))

    @cached_property
    def _billable(self) -> DataFrame:
        matched = billable_charges(self._known, self._charges, self._prior, self._basis, small=self._few_requests, **self._limits)
        return with_rule(matched, self._rules, **self._limits)

    @cached_property
    def _sums(self) -> DataFrame:
        # One row per period and metric.
        return materialise(line_sums(self._billable))

    @cached_property
    def _split(self) -> tuple[DataFrame, DataFrame]:
        return invoice_headers(self._known, self._customers, self._sums, self._prior, small=self._few_customers, **self._limits)

    @cached_property
    def _headers(self) -> DataFrame:
        return materialise(self._split[0])

    @property
    def unchanged(self) -> DataFrame:
        """Billed periods without new charges."""
        return self._split[1]

    @cached_property
    def _paid(self) -> DataFrame:
        usable = usable_credits(self._credits, self._as_of, self._honour_expiry)
        amount = F.col("total_before_credits").alias("amount")
        totals = self._headers.select("customer_id", "invoice_id", "period_start", amount)
        return materialise(allocate(totals, usable, self._split_credits))

    @property
    def invoices(self) -> DataFrame:
        applied = self._paid.groupBy("invoice_id").agg(F.sum("amount").cast("decimal(18,2)").alias("credits_applied"))
        return (
            self._headers.join(applied, "invoice_id", "left")
            .withColumn("credits_applied", F.coalesce("credits_applied", zero_money()))
            .withColumn("total", (F.col("total_before_credits") - F.col("credits_applied")).cast("decimal(18,2)"))
        )

    @property
    def line_items(self) -> DataFrame:
        return line_items(self._headers, self._sums)

    @property
    def line_charges(self) -> DataFrame:
        counts = self._sums.groupBy(*PERIOD).agg(F.sum("charge_count").alias("n"))
        return line_charges(self._headers, self._billable, small=self._few_requests, counts=counts, **self._limits)

    @property
    def adjustments(self) -> DataFrame:
        return adjustments(self._paid)

    @property
    def credits(self) -> DataFrame:
        return spend(self._credits, self._paid)


def generate_invoices(
    requests: DataFrame,
    customers: DataFrame,
    charges: DataFrame,
    rules: DataFrame,
    invoices: DataFrame,
    credits: DataFrame,
    as_of,
    basis: str = "created_at",
    honour_expiry: bool = False,
    split_credits: bool | None = None,
    **limits,
) -> InvoiceRun:
    """Invoices for all requested (customer, period) pairs in one job.

    ``requests`` has customer_id, period_start, period_end and currency (may be null).
    A period that already has an issued or paid invoice gets a correction with the
    charges calculated since then, or stays unchanged.  Periods without charges still
    get an invoice of 0.
    """
    return InvoiceRun(
        requests, customers, charges, rules, invoices, credits, as_of, basis, honour_expiry, split_credits, limits
    )


def issue(invoices: DataFrame, ids: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """(next invoice snapshot, refused ids).  Only an already issued invoice is refused."""
    asked = ids.select("invoice_id").distinct()
    marked = invoices.join(asked.withColumn("_asked", F.lit(True)), "invoice_id", "left")
    change = F.coalesce("_asked", F.lit(False)) & (F.col("status") != "issued")
    snapshot = marked.withColumns(
        {
            "issued_at": F.when(change, V.moment(as_of)).otherwise(F.col("issued_at")),
            "status": F.when(change, "issued").otherwise(F.col("status")),
        }
    ).drop("_asked")
    found = asked.join(invoices.select("invoice_id", "status"), "invoice_id", "left")
    refused = found.withColumn(
        "reason",
        F.when(F.col("status").isNull(), "INVOICE_NOT_FOUND").when(F.col("status") == "issued", "INVOICE_ALREADY_ISSUED"),
    ).filter(F.col("reason").isNotNull())
    return snapshot, refused.select("invoice_id", "reason")


# Fixed value: header of the line table.
CSV_COLUMNS = "Line #,Description,Metric,Quantity,Unit,Unit Price,Amount"


def csv_rows(invoices: DataFrame, lines: DataFrame, customers: DataFrame) -> DataFrame:
    """(invoice_id, section, position, text): the text lines of every invoice.

    One row per line, so a writer can range-partition by invoice and position.
    """
    regions = customers.select("customer_id", "tax_region")
    rated = keyed_join(invoices, regions, ["customer_id"], ["invoice_id"])
    percent = V.percentage(V.tax_rate("tax_region"))
    period = F.concat(V.iso("period_start"), F.lit(" to "), V.iso("period_end"))

    def label(name: str, value: Column) -> Column:
        return F.concat(F.lit(name), F.lit(","), value.cast("string"))

    head = [
        label("Invoice Number", F.col("invoice_number")),
        label("Type", F.col("invoice_type")),
        label("Customer ID", F.col("customer_id")),
        label("Period", period),
        label("Status", F.col("status")),
        label("Currency", F.col("currency")),
        F.lit(""),
        F.lit(CSV_COLUMNS),
    ]
    tail = [
        F.lit(""),
        label("Subtotal,,,,,$", F.col("subtotal")),
        F.concat(F.lit("Tax ("), percent, F.lit("%),,,,,$,"), F.col("tax").cast("string")),
        label("Credits Applied,,,,,$", F.col("credits_applied")),
        label("Total,,,,,$", F.col("total")),
    ]

    def block(section: int, texts: list[Column]) -> DataFrame:
        return rated.select(
            "invoice_id", F.lit(section).alias("section"), F.posexplode(F.array(*texts)).alias("position", "text")
        )

    fields = ["line_number", "description", "metric_type", "quantity", "unit", "unit_price", "amount"]
    body = lines.select(
        "invoice_id",
        F.lit(1).alias("section"),
        F.col("line_number").alias("position"),
        F.concat_ws(",", *[F.col(c).cast("string") for c in fields]).alias("text"),
    )
    return block(0, head).unionByName(body).unionByName(block(2, tail))


def csv_text(rows: DataFrame) -> DataFrame:
    """Whole text per invoice; an invoice has a fixed frame and one line per metric."""
    ordered = F.array_sort(F.collect_list(F.struct("section", "position", "text")))
    return rows.groupBy("invoice_id").agg(F.array_join(F.transform(ordered, lambda r: r["text"]), "\n").alias("csv"))


def invoices_with_lines(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """Invoices with their lines nested, in line order; at most one line per metric."""
    nested = lines.groupBy("invoice_id").agg(
        F.array_sort(
            F.collect_list(F.struct("line_number", "metric_type", "quantity", "unit_price", "amount"))
        ).alias("lines")
    )
    return invoices.join(nested, "invoice_id", "left")


def invoices_of_customer(invoices: DataFrame, customer_id) -> DataFrame:
    return invoices.filter(F.col("customer_id") == customer_id).orderBy(F.col("created_at").desc_nulls_first(), "invoice_id")


def find_invoices(invoices: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bulk lookup: (found invoices, ids without an invoice)."""
    asked = ids.select("invoice_id").distinct()
    return invoices.join(asked, "invoice_id", "left_semi"), asked.join(invoices, "invoice_id", "left_anti")
