"""Schemas of the stored tables and messages."""

from __future__ import annotations

TIERS = "array<struct<tier:int,upTo:decimal(20,6),unitPrice:decimal(12,6),flatFee:decimal(12,2)>>"

# A tier as it was used by a charge.
TIERS_APPLIED = (
    "array<struct<tier:int,units:decimal(20,6),unitPrice:decimal(12,6),flatFee:decimal(12,2),charge:decimal(18,2)>>"
)

TABLES: dict[str, str] = {
    "telemetry_events": (
        "event_id string, event_type string, customer_id string, event_time timestamp, "
        "ingestion_time timestamp, metadata string, source string, processed_at timestamp, "
        "processing_version string, created_at timestamp"
    ),
    "aggregated_usage": (
        "aggregation_id string, customer_id string, metric_type string, window_start timestamp, "
        "window_end timestamp, value decimal(20,6), unit string, event_count bigint, "
        "is_final boolean, version int, computed_at timestamp, rerating_job_id string"
    ),
    "usage_events": ("aggregation_id string, event_id string"),
    "price_books": (
        "price_book_id string, name string, description string, parent_id string, version string, "
        "effective_from timestamp, effective_until timestamp, currency string, created_by string, created_at timestamp"
    ),
    "price_rules": (
        "rule_id string, price_book_id string, metric_type string, pricing_model string, "
        f"tiers {TIERS}, "
        "unit string"
    ),
    "rated_charges": (
        "charge_id string, customer_id string, aggregation_id string, source_event_id string, "
        "price_book_id string, price_version string, rule_id string, quantity decimal(20,6), "
        "unit_price decimal(12,6), subtotal decimal(12,2), currency string, "
        "calculated_at timestamp, created_at timestamp, rerating_job_id string, "
        "supersedes_charge_id string"
    ),
    "invoices": (
        "invoice_id string, invoice_number string, invoice_type string, customer_id string, "
        "billing_period_start timestamp, billing_period_end timestamp, subtotal decimal(12,2), "
        "tax decimal(12,2), credits_applied decimal(12,2), total decimal(12,2), currency string, "
        "status string, issued_at timestamp, due_at timestamp, paid_at timestamp, "
        "reference_invoice_id string, correction_reason string, metadata string, created_at timestamp"
    ),
    "invoice_line_items": (
        "line_item_id string, invoice_id string, line_number int, description string, "
        "metric_type string, quantity decimal(20,6), unit string, unit_price decimal(12,6), "
        "amount decimal(12,2)"
    ),
    "invoice_line_charges": ("line_item_id string, charge_id string"),
    "invoice_adjustments": (
        "adjustment_id string, invoice_id string, credit_id string, amount decimal(12,2), "
        "type string, reason string"
    ),
    "customers": (
        "customer_id string, external_id string, name string, email string, "
        "billing_currency string, billing_cycle string, status string, tax_region string, created_at timestamp"
    ),
    "customer_credits": (
        "credit_id string, customer_id string, amount decimal(12,2), remaining_amount decimal(12,2), "
        "currency string, status string, expires_at timestamp, created_at timestamp"
    ),
    "rerating_jobs": (
        "job_id string, triggered_by string, reason string, window_start timestamp, "
        "window_end timestamp, status string, started_at timestamp, completed_at timestamp, "
        "charges_created bigint, total_adjustment_amount decimal(18,2)"
    ),
}

EVENT_MESSAGE = (
    "eventId string, eventType string, customerId string, eventTime string, "
    "ingestionTime string, metadata string, source string, receivedAt string, watermark string"
)
