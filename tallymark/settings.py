"""Fixed business values and their defaults."""

from __future__ import annotations

# How a metric's events combine within a window.
# Metrics not listed count their events.
SUM_METRICS = ["api_calls", "bandwidth_mb", "compute_hours"]
MAX_METRICS = ["storage_gb_peak", "concurrent_users_max"]

# Unit of a metric; others use DEFAULT_UNIT.
UNITS = {
    "api_calls": "count",
    "storage_gb_hours": "gb_hours",
    "bandwidth_mb": "megabytes",
    "compute_hours": "hours",
}
DEFAULT_UNIT = "count"

# Tax rate by region.
TAX_RATES = {
    "US-STANDARD": "0.05",
    "EU-DE": "0.19",
    "EU-FR": "0.20",
    "UK-VAT": "0.20",
    "NO-TAX": "0.00",
}
DEFAULT_TAX_REGION = "US-STANDARD"
DEFAULT_TAX_RATE = "0.05"

# Exchange rate from the rating currency.
EXCHANGE_RATES = {"USD": "1.00", "EUR": "0.92", "GBP": "0.78", "JPY": "150.00", "BRL": "5.00"}
DEFAULT_EXCHANGE_RATE = "1.00"
DEFAULT_CURRENCY = "USD"

WINDOW_SIZE = "1 hour"
ALLOWED_LATENESS = "1 hour"

CORRECTION_REASON = "Back-filled usage from late events"
BILLED_STATUSES = ["issued", "paid"]

# A lookup side above this many rows is joined by shuffle instead of broadcast.
BROADCAST_ROWS = 200_000
# Nor is one above this many bytes, where a row's size is known.
BROADCAST_BYTES = 16 << 20
# A join or window key with more rows than this is split over several tasks.
ROWS_PER_TASK = 4_000_000
