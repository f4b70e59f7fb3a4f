"""Spending customer credits on invoice totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.functions import values as V
from tallymark.operators.scans import groups_fit, neighbours, running_total


def credit_order() -> list[Column]:
    """Soonest expiry first, those without expiry last, then the oldest."""
    return [F.col("expires_at").asc_nulls_last(), F.col("created_at").asc(), F.col("credit_id").asc()]


def usable_credits(credits: DataFrame, as_of, honour_expiry: bool = False) -> DataFrame:
    """Active credits with a balance.

    By default only credits without expiry count; ``honour_expiry`` also takes those
    that have not expired by ``as_of``.
    """
    lasting = F.col("expires_at").isNull()
    if honour_expiry:
        lasting = lasting | (F.col("expires_at") >= V.moment(as_of))
    return credits.filter((F.col("status") == "active") & lasting & (F.col("remaining_amount") > 0))


def allocate(
    totals: DataFrame,
    credits: DataFrame,
    split: bool | None = None,
    rows_per_task: int = settings.ROWS_PER_TASK,
) -> DataFrame:
    """(customer_id, invoice_id, credit_id, amount): who pays what.

    ``totals`` has customer_id, invoice_id, period_start, amount.  Credits are spent
    in ``credit_order``, invoices served by period start and id.

    Laid end to end, a customer's credits and invoices are two rulers on one axis.
    Their marks are merged and sorted; between two marks exactly one credit and one
    invoice meet, so the work is the number of marks, not credits times invoices.
    """
    if split is None:
        split = not (
            groups_fit(totals, ["customer_id"], rows_per_task) and groups_fit(credits, ["customer_id"], rows_per_task)
        )
    keys = ["customer_id"]
    invoice_marks = running_total(
        totals.filter(F.col("amount") > 0).select("customer_id", "invoice_id", "period_start", "amount"),
        keys,
        [F.col("period_start").asc(), F.col("invoice_id").asc()],
        "amount",
        "mark",
        split,
    ).select("customer_id", "mark", F.lit(0).alias("kind"), "invoice_id", F.lit(None).cast("string").alias("credit_id"))
    credit_marks = running_total(
        credits.filter(F.col("remaining_amount") > 0).select(
            "customer_id", "credit_id", "expires_at", "created_at", "remaining_amount"
        ),
        keys,
        credit_order(),
        "remaining_amount",
        "mark",
        split,
    ).select("customer_id", "mark", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("invoice_id"), "credit_id")
    pieces = neighbours(
        invoice_marks.unionByName(credit_marks),
        keys,
        [F.col("mark").asc(), F.col("kind").asc()],
        previous={"mark_before": "mark"},
        following={"paid_invoice": "invoice_id", "paying_credit": "credit_id"},
        split=split,
    )
    amount = (F.col("mark") - F.coalesce("mark_before", F.lit(0))).cast("decimal(18,2)")
    return (
        pieces.filter(F.col("paid_invoice").isNotNull() & F.col("paying_credit").isNotNull())
        .select(
            "customer_id",
            F.col("paid_invoice").alias("invoice_id"),
            F.col("paying_credit").alias("credit_id"),
            amount.alias("amount"),
        )
        .filter(F.col("amount") > 0)
    )


def adjustments(allocations: DataFrame) -> DataFrame:
    """One adjustment per invoice and credit used."""
    return allocations.select(
        V.stable_id("invoice_id", "credit_id").alias("adjustment_id"),
        "invoice_id",
        "credit_id",
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        F.lit("credit_application").alias("type"),
        F.concat(F.lit("Applied from credit "), "credit_id").alias("reason"),
    )


def spend(credits: DataFrame, allocations: DataFrame) -> DataFrame:
    """Next credit snapshot: balances reduced, empty credits closed."""
    used = allocations.groupBy("credit_id").agg(F.sum("amount").alias("_used"))
    left = (F.col("remaining_amount") - F.coalesce("_used", F.lit(0))).cast("decimal(12,2)")
    emptied = F.col("_used").isNotNull() & (left == 0)
    return (
        credits.join(used, "credit_id", "left")
        .withColumns({"status": F.when(emptied, "fully_used").otherwise(F.col("status")), "remaining_amount": left})
        .drop("_used")
    )

