from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.functions import money as M
from tallymark.functions import values as V


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def dec(text, kind="decimal(20,6)"):
    return F.lit(text).cast(kind)


@pytest.mark.parametrize(
    "column, expected",
    [
        (lambda: M.money(dec("10.505")), "10.51"),
        (lambda: M.money(dec("-10.505")), "-10.51"),
        (lambda: M.money_at(dec("0.0151234", "decimal(12,7)"), 6), "0.015123"),
        (lambda: M.add_money(dec("0.1"), dec("0.2")), "0.30"),
        (lambda: M.subtract_money(dec("10.00"), dec("3.33")), "6.67"),
        (lambda: M.multiply_money(dec("10.50"), dec("3")), "31.50"),
        (lambda: M.multiply_money(dec("0.02"), dec("1234")), "24.68"),
        (lambda: M.divide_money(dec("10.00"), dec("3")), "3.33"),
        (lambda: M.divide_money(dec("10.00"), dec("0")), None),
        (lambda: M.zero_money(), "0.00"),
        (lambda: M.quantity(dec("1.23456789", "decimal(20,8)")), "1.234568"),
        (lambda: M.add_quantity(dec("100.5"), dec("200.3")), "300.800000"),
        (lambda: M.multiply_quantity(dec("1.5"), dec("2")), "3.000000"),
        (lambda: M.max_quantity(dec("30"), dec("50")), "50.000000"),
        (lambda: M.zero_quantity(), "0.000000"),
        (lambda: M.to_decimal(F.lit("12.5")), "12.500000000000"),
        (lambda: M.to_decimal(F.lit("many")), None),
    ],
)
def test_money(spark, column, expected):
    assert one(spark, column()) == (None if expected is None else Decimal(expected))


def test_money_comparisons(spark):
    assert one(spark, M.compare_money(dec("1"), dec("2"))) == -1
    assert one(spark, M.compare_money(dec("2"), dec("2.00"))) == 0
    assert one(spark, M.greater_money(dec("2.01"), dec("2")))
    assert one(spark, M.equal_money(dec("2.0"), dec("2")))


def test_sum_of_nothing_is_zero(spark):
    empty = spark.range(0).select(dec("1").alias("v"))
    assert empty.agg(M.sum_money("v").alias("s")).first()["s"] == Decimal("0.00")


@pytest.mark.parametrize("text, shown", [("0.020000", "0.02"), ("12.000000", "12"), ("100", "100"), ("0", "0"), ("10.5", "10.5")])
def test_plain_number(spark, text, shown):
    kind = "decimal(20,6)" if "." in text else "int"
    assert one(spark, M.plain_number(F.lit(text).cast(kind))) == shown


VALUES = [
    # metadata, on time, late
    ("{}", "1", "1"),
    ('{"value":null}', "1", "1"),
    ('{"value":""}', "1", None),
    ('{"value":false}', "1", None),
    ('{"value":0}', "1", "0"),
    ('{"value":0.0}', "1", "0"),
    ('{"value":"0"}', "0", "0"),
    ('{"value":"10"}', "10", "10"),
    ('{"value":5}', "5", "5"),
    ('{"value":2.5}', "2.5", "2.5"),
    ('{"value":true}', None, None),
    ('{"value":"many"}', None, None),
]


def test_event_values(spark, rows):
    given = rows("n int, m string", ", ".join(f"({i}, '{m}')" for i, (m, _, _) in enumerate(VALUES)))
    found = given.select("n", V.on_time_value("m").alias("a"), V.late_value("m").alias("b")).orderBy("n").collect()
    for row, (text, on_time, late) in zip(found, VALUES):
        assert row["a"] == (None if on_time is None else Decimal(on_time)), text
        assert row["b"] == (None if late is None else Decimal(late)), text


def test_counted_metrics_ignore_the_value(spark):
    assert one(spark, V.on_time_value(F.lit('{"value":"many"}'), F.lit("signup"))) == 1
    assert one(spark, V.on_time_value(F.lit('{"value":"many"}'), F.lit("api_calls"))) is None


def test_names(spark):
    assert one(spark, V.metric_title(F.lit("storage_gb_hours"))) == "Storage Gb Hours"
    assert one(spark, V.metric_title(F.lit("apiCALL_x"))) == "ApiCALL X"
    assert one(spark, V.usage_description(F.lit("api_calls"))) == "Api Calls usage"
    assert one(spark, V.unit_of(F.lit("bandwidth_mb"))) == "megabytes"
    assert one(spark, V.unit_of(F.lit("api_call"))) == "count"
    assert one(spark, V.strategy(F.lit("concurrent_users_max"))) == "max"
    assert one(spark, V.strategy(F.lit("storage_gb_hours"))) == "count"


def test_rates(spark):
    assert one(spark, V.tax_rate(F.lit("EU-DE"))) == Decimal("0.19")
    assert one(spark, V.tax_rate(F.lit(None).cast("string"))) == Decimal("0.05")
    assert one(spark, V.tax_rate(F.lit("MOON"))) == Decimal("0.05")
    assert one(spark, V.exchange_rate(F.lit("BRL"))) == Decimal("5.00")
    assert one(spark, V.exchange_rate(F.lit("CHF"))) == Decimal("1.00")
    assert one(spark, V.percentage(V.tax_rate(F.lit("EU-FR")))) == "20"
    assert one(spark, V.tax_region(F.lit('{"taxRegion":"UK-VAT"}'))) == "UK-VAT"
    assert one(spark, V.tax_region(F.lit("{}"))) == "US-STANDARD"


def test_times(spark):
    at = F.lit("2024-01-31 23:59:50").cast("timestamp")
    assert one(spark, V.iso(V.window_start(at))) == "2024-01-31T23:00:00.000Z"
    assert one(spark, V.iso(V.parse_iso(F.lit("2024-01-15T14:23:45.123Z")))) == "2024-01-15T14:23:45.123Z"
    assert one(spark, V.parse_iso(F.lit("yesterday"))) is None
    assert one(spark, V.month_key(at)) == "2024-01"


def test_ids_are_stable_and_distinct(spark):
    first = one(spark, V.stable_id(F.lit("a"), F.lit(1)))
    assert first == one(spark, V.stable_id(F.lit("a"), F.lit(1)))
    assert first != one(spark, V.stable_id(F.lit("a"), F.lit(2)))
    number = one(spark, V.invoice_number(F.lit("correction"), F.lit(first)))
    assert number == "CORR-" + first[:32]


def test_places_of_an_ordered_table_without_one_task_for_all(spark):
    from tallymark.operators.scans import numbered

    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("x"))
    got = numbered(df, "n", [F.col("x").desc()])
    assert "Exchange SinglePartition" not in got.filter("n > 0").select("x", "n")._jdf.queryExecution().toString().split("Join")[0]
    ranked = sorted((r.x for r in df.collect()), reverse=True)
    assert [(r.x, r.n) for r in got.orderBy("n").collect()] == [(x, i + 1) for i, x in enumerate(ranked)]
    assert numbered(df.filter("x < 0"), "n", [F.col("x")]).count() == 0
