"""DataFrame operators: metering, pricing, rating, invoicing, reconciliation."""
