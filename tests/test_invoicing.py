"""Invoices from literal charges."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.operators import analytics, invoicing

START, END = "2024-01-01 00:00:00", "2024-01-31 23:59:59"


@pytest.fixture
def world(rows):
    """run(charges, ...) -> InvoiceRun for customer 'c' and one period."""

    def run(charges, credits="('none', 'x', 0, 'active', null, '2023-01-01 00:00:00')", invoices=None, currency="USD", region=None, requests=None, **options):
        rules = rows("rule_id string, metric_type string, unit string", "('r1', 'api_calls', 'requests'), ('r2', 'storage_gb_hours', 'gb_hours')")
        quoted = "null" if region is None else f"'{region}'"
        return invoicing.generate_invoices(
            requests if requests is not None else rows("customer_id string, period_start timestamp, period_end timestamp, currency string", f"('c', '{START}', '{END}', null)"),
            rows("customer_id string, billing_currency string, tax_region string", f"('c', '{currency}', {quoted})"),
            rows(
                "charge_id string, customer_id string, rule_id string, quantity decimal(20,6), subtotal decimal(12,2), calculated_at timestamp, created_at timestamp",
                charges,
            ),
            rules,
            rows(
                "invoice_id string, customer_id string, billing_period_start timestamp, billing_period_end timestamp, status string, issued_at timestamp, created_at timestamp",
                invoices or f"('old', 'nobody', '{START}', '{END}', 'issued', '{START}', '{START}')",
            ),
            rows("credit_id string, customer_id string, remaining_amount decimal(12,2), status string, expires_at timestamp, created_at timestamp", credits),
            "2024-02-01 00:00:00",
            **options,
        )

    return run


def charge(n, rule, quantity, amount, at="2024-01-10 00:00:00"):
    return f"('ch{n}', 'c', '{rule}', {quantity}, {amount}, '{at}', '{at}')"


THREE = ", ".join([charge(1, "r1", 500, 50), charge(2, "r1", 250, 25), charge(3, "r2", 100, 40, "2024-01-11 00:00:00")])


def test_totals_and_lines(world):
    done = world(THREE)
    invoice = done.invoices.first()
    assert (invoice["subtotal"], invoice["tax"], invoice["total"]) == (Decimal("115.00"), Decimal("5.75"), Decimal("120.75"))
    assert (invoice["invoice_type"], invoice["status"], invoice["currency"]) == ("standard", "draft", "USD")
    lines = done.line_items.orderBy("line_number").collect()
    assert [(r["line_number"], r["description"], r["amount"], r["unit"]) for r in lines] == [
        (1, "Api Calls usage", Decimal("75.00"), "requests"),
        (2, "Storage Gb Hours usage", Decimal("40.00"), "gb_hours"),
    ]
    assert [r["unit_price"] for r in lines] == [Decimal("0.10"), Decimal("0.40")]
    assert done.line_charges.count() == 3
    assert done.adjustments.isEmpty() and done.unchanged.isEmpty() and done.rejected.isEmpty()


def test_credit(world):
    done = world(charge(1, "r1", 10, 100), credits="('cr', 'c', 50, 'active', null, '2023-01-01 00:00:00')")
    invoice = done.invoices.first()
    assert (invoice["credits_applied"], invoice["total"]) == (Decimal("50.00"), Decimal("55.00"))
    adjustment = done.adjustments.first()
    assert (adjustment["credit_id"], adjustment["amount"], adjustment["reason"]) == ("cr", Decimal("50.00"), "Applied from credit cr")
    assert done.credits.first()["status"] == "fully_used"


@pytest.mark.parametrize("region, tax", [("EU-DE", "19.00"), ("NO-TAX", "0.00"), (None, "5.00")])
def test_tax(world, region, tax):
    invoice = world(charge(1, "r1", 10, 100), region=region).invoices.first()
    assert invoice["tax"] == Decimal(tax) and invoice["total"] == 100 + Decimal(tax)


def test_currency(world):
    done = world(charge(1, "r1", 10, 100), currency="BRL")
    assert done.invoices.first()["subtotal"] == Decimal("500.00")
    assert done.line_items.first()["amount"] == Decimal("500.00")


def test_correction_holds_only_new_charges(world):
    issued = f"('inv', 'c', '{START}', '{END}', 'issued', '2024-01-20 10:00:00', '{START}'), ('draft', 'c', '{START}', '{END}', 'draft', null, '{START}')"
    done = world(charge(1, "r1", 10, 100) + ", " + charge(2, "r1", 2, 20, "2024-01-25 00:00:00"), invoices=issued)
    invoice = done.invoices.first()
    assert (invoice["invoice_type"], invoice["subtotal"], invoice["reference_invoice_id"]) == ("correction", Decimal("20.00"), "inv")
    assert invoice["invoice_number"].startswith("CORR-") and invoice["correction_reason"].startswith("Back-filled")
    assert [r["charge_id"] for r in done.line_charges.collect()] == ["ch2"]


def test_nothing_new_leaves_the_issued_invoice(world):
    done = world(charge(1, "r1", 10, 100), invoices=f"('inv', 'c', '{START}', '{END}', 'paid', '2024-01-20 10:00:00', '{START}')")
    assert done.invoices.isEmpty() and done.unchanged.first()["invoice_id"] == "inv"


def test_empty_period_and_unknown_customer(world, rows):
    asked = rows(
        "customer_id string, period_start timestamp, period_end timestamp, currency string",
        "('c', '2023-01-01 00:00:00', '2023-01-31 00:00:00', 'EUR'), ('who', '2023-01-01 00:00:00', '2023-01-31 00:00:00', null)",
    )
    done = world(THREE, requests=asked)
    invoice = done.invoices.first()
    assert (invoice["total"], invoice["currency"], invoice["charge_count"]) == (Decimal("0.00"), "EUR", 0)
    assert done.rejected.first()["reason"] == "CUSTOMER_NOT_FOUND"
    assert done.line_items.isEmpty()


def test_missing_rule_is_unknown_and_zero_quantity_has_no_unit_price(world):
    line = world(charge(1, "gone", 0, 5)).line_items.first()
    assert (line["metric_type"], line["unit"], line["unit_price"]) == ("unknown", "units", Decimal("0"))


def test_period_ends_are_included(world):
    both = ", ".join([charge(1, "r1", 1, 1, START), charge(2, "r1", 1, 2, END), charge(3, "r1", 1, 4, "2024-02-01 00:00:00")])
    assert world(both).invoices.first()["subtotal"] == Decimal("3.00")


def test_split_paths_agree(world):
    plain = world(THREE, credits="('cr', 'c', 50, 'active', null, '2023-01-01 00:00:00')")
    forced = world(THREE, credits="('cr', 'c', 50, 'active', null, '2023-01-01 00:00:00')", split_credits=True, broadcast_rows=0, rows_per_task=1)
    for name in ("invoices", "line_items", "line_charges", "adjustments", "credits"):
        assert getattr(plain, name).exceptAll(getattr(forced, name)).isEmpty(), name


def test_csv(world, rows):
    done = world(charge(1, "r1", 1000, 100))
    customers = rows("customer_id string, tax_region string", "('c', 'EU-DE')")
    text = invoicing.csv_text(invoicing.csv_rows(done.invoices, done.line_items, customers)).first()["csv"].split("\n")
    assert text[1:3] == ["Type,standard", "Customer ID,c"]
    assert text[3] == "Period,2024-01-01T00:00:00.000Z to 2024-01-31T23:59:59.000Z"
    assert text[6:9] == ["", invoicing.CSV_COLUMNS, "1,Api Calls usage,api_calls,1000.000000,requests,0.100000,100.00"]
    assert text[9:11] == ["", "Subtotal,,,,,$,100.00"]
    assert text[11].startswith("Tax (19%),,,,,$,") and text[-1].startswith("Total,,,,,$,")


def test_issue(rows):
    invoices = rows("invoice_id string, status string, issued_at timestamp", "('a', 'draft', null), ('b', 'issued', '2024-01-01 00:00:00'), ('c', 'void', null), ('d', 'draft', null)")
    ids = rows("invoice_id string", "('a'), ('b'), ('c'), ('zz')")
    after, refused = invoicing.issue(invoices, ids, "2024-02-01")
    assert {r["invoice_id"]: r["status"] for r in after.collect()} == {"a": "issued", "b": "issued", "c": "issued", "d": "draft"}
    assert {r["invoice_id"]: r["reason"] for r in refused.collect()} == {"b": "INVOICE_ALREADY_ISSUED", "zz": "INVOICE_NOT_FOUND"}


def test_revenue(rows):
    invoices = rows(
        "customer_id string, billing_period_start timestamp, total decimal(12,2), subtotal decimal(12,2), tax decimal(12,2), status string",
        "('a', '2024-01-01 00:00:00', 10, 9, 1, 'issued'), ('a', '2024-02-01 00:00:00', 20, 18, 2, 'paid'), ('b', '2024-02-01 00:00:00', 30, 27, 3, 'draft'), ('b', '2022-02-01 00:00:00', 5, 4, 1, 'paid')",
    )
    assert [(r["month"], r["total_revenue"]) for r in analytics.monthly_revenue(invoices).collect()] == [
        ("2022-02", Decimal("5.00")), ("2024-01", Decimal("10.00")), ("2024-02", Decimal("20.00"))]
    assert [r["month"] for r in analytics.monthly_revenue(invoices, 12, "2024-02-15").collect()] == ["2024-01", "2024-02"]
    assert [r["customer_id"] for r in analytics.top_customers(invoices, 1).collect()] == ["a"]


def test_nulls_sort_as_in_the_stored_order(rows):
    given = rows("k string, t timestamp", "('a', null), ('b', '2024-01-01 00:00:00'), ('c', '2024-02-01 00:00:00')")
    assert [r["k"] for r in analytics.newest_first(given, "t", "k").collect()] == ["a", "c", "b"]
    assert [r["k"] for r in analytics.oldest_first(given, "t", "k").collect()] == ["b", "c", "a"]
