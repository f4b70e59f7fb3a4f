"""Price books, price steps and charges, against plain loops."""

import json
import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.operators import pricebooks, rating
from tallymark.schemas import TIERS

CENT = Decimal("0.01")


def cents(value):
    return Decimal(value).quantize(CENT, ROUND_HALF_UP)


def graduated(tiers, quantity, scale):
    """Tier by tier: what is left after the lower tiers goes into the next one."""
    unit = Decimal(1).scaleb(-scale)
    left, limit_before, total, used = quantity, Decimal(0), Decimal(0), 0
    for limit, price, fee in tiers:
        room = None if limit is None else limit - limit_before
        if room is None:
            taken = max(Decimal(0), left)
        else:
            taken = max(Decimal(0), min(left, room))
        if taken <= 0 and left > 0:
            limit_before = limit
            continue
        total += cents(price.quantize(unit, ROUND_HALF_UP) * taken) + fee
        used += 1
        left -= taken
        limit_before = limit
        if left <= 0:
            break
    return total, used


def by_volume(tiers, quantity, scale):
    unit = Decimal(1).scaleb(-scale)
    chosen = next((t for t in tiers if t[0] is None or quantity <= t[0]), tiers[-1])
    return cents(chosen[1].quantize(unit, ROUND_HALF_UP) * quantity) + chosen[2]


def rule_table(spark, rules):
    """rules: [(id, model, [(limit, price, fee)])], all in book 'b' with the id as metric."""
    data = [
        (
            rule_id,
            "b",
            rule_id,
            model,
            "count",
            json.dumps(
                [
                    {"tier": i + 1, "upTo": None if t[0] is None else float(t[0]), "unitPrice": float(t[1]), "flatFee": float(t[2])}
                    for i, t in enumerate(tiers)
                ]
            ),
        )
        for rule_id, model, tiers in rules
    ]
    table = spark.createDataFrame(data, "rule_id string, price_book_id string, metric_type string, pricing_model string, unit string, tiers string")
    return table.withColumn("tiers", F.from_json("tiers", TIERS))


def book_table(spark, books):
    data = [(b, b, None, "v", start, end) for b, start, end in books]
    return spark.createDataFrame(
        data, "price_book_id string, name string, parent_id string, version string, effective_from timestamp, effective_until timestamp"
    )


def usage_table(spark, rows):
    return spark.createDataFrame(
        [("c", m, Decimal(q), t, f"a{i}", None) for i, (m, q, t) in enumerate(rows)],
        "customer_id string, metric_type string, quantity decimal(20,6), effective_date timestamp, aggregation_id string, source_event_id string",
    )


BOOK = [("b", datetime(2024, 1, 1), None)]
NOON = datetime(2024, 1, 5, 12)


def amounts(spark, rules, rows, **options):
    charges, unrated = rating.rate(
        usage_table(spark, rows), book_table(spark, BOOK), rule_table(spark, rules), NOON, rating.RatingOptions(**options)
    )
    got = {r["aggregation_id"]: r for r in charges.collect()}
    missed = {r["aggregation_id"]: r["reason"] for r in unrated.collect()}
    return got, missed


D = Decimal
DOCUMENTED = [(D(1000), D("0.02"), D(0)), (D(10000), D("0.015"), D(0)), (None, D("0.01"), D(0))]


@pytest.mark.parametrize(
    "model, tiers, quantity, options, expected",
    [
        ("tiered", [(D(1000), D("0.10"), D(0)), (None, D("0.05"), D(0))], 1200, {}, "110.00"),
        ("tiered", DOCUMENTED, 12500, {}, "225.00"),
        ("tiered", DOCUMENTED, 12500, {"price_scale": 6}, "180.00"),
        ("tiered", DOCUMENTED, 1000, {}, "20.00"),
        ("tiered", [(D(10), D("1"), D("2.50"))], 0, {}, "2.50"),
        ("tiered", [(D(10), D("1"), D(0))], 25, {}, "10.00"),
        ("tiered", [], 25, {}, "0.00"),
        ("volume", [(D(1000), D("0.10"), D(0)), (None, D("0.08"), D(0))], 5000, {}, "400.00"),
        ("volume", [(D(1000), D("0.10"), D(0)), (D(2000), D("0.08"), D("3"))], 5000, {}, "403.00"),
        ("flat", [(None, D("0.02"), D(0))], 1234, {}, "0.02"),
        ("flat", [(None, D("0.02"), D(0))], 1234, {"flat_mode": "per_unit"}, "24.68"),
        ("flat", [], 10, {}, "0.00"),
        ("per_unit", [(None, D("0.015"), D(0))], 100, {}, "2.00"),
        ("per_unit", [(None, D("0.015"), D(0))], 100, {"price_scale": 6}, "1.50"),
        ("committed", [(D(1000), D("0.50"), D(0)), (None, D("0.75"), D(0))], 1200, {}, "600.00"),
        ("committed", [(D(1000), D("0.50"), D(0)), (None, D("0.75"), D(0))], 1200, {"committed_mode": "overage"}, "650.00"),
    ],
)
def test_known_amounts(spark, model, tiers, quantity, options, expected):
    got, missed = amounts(spark, [("m", model, tiers)], [("m", quantity, NOON)], **options)
    assert not missed
    assert got["a0"]["subtotal"] == Decimal(expected)


def test_reasons(spark):
    rules = [("odd", "custom", [(None, D(1), D(0))]), ("bare", "volume", []), ("unit", "per_unit", [(None, D(1), D(0))])]
    rows = [("odd", 1, NOON), ("bare", 1, NOON), ("unit", -1, NOON), ("none", 1, NOON), ("unit", 1, datetime(2023, 12, 31)), ("unit", 2, NOON)]
    got, missed = amounts(spark, rules, rows)
    assert missed == {
        "a0": "INVALID_PRICE_RULE",
        "a1": "INVALID_PRICE_RULE",
        "a2": "CALCULATION_ERROR",
        "a3": "NO_PRICE_RULE",
        "a4": "NO_PRICE_BOOK_FOR_DATE",
    }
    assert list(got) == ["a5"]


def test_trail(spark):
    got, _ = amounts(
        spark,
        [("t", "tiered", [(D(1000), D("0.10"), D(0)), (None, D("0.05"), D(1))]), ("v", "volume", [(None, D("0.08"), D(2))]), ("f", "flat", [(None, D("0.02"), D(0))])],
        [("t", 1200, NOON), ("v", 5000, NOON), ("f", 7, NOON)],
    )
    tiered = got["a0"]["calculation_metadata"]
    assert tiered["formula"] == "(0.1 × 1000 + 0) + (0.05 × 200 + 1)"
    assert [t["charge"] for t in tiered["tiersApplied"]] == [Decimal("100.00"), Decimal("11.00")]
    assert tiered["effectiveDate"] == "2024-01-05T12:00:00.000Z"
    assert got["a1"]["calculation_metadata"]["formula"] == "0.08 × 5000 + 2"
    assert got["a2"]["calculation_metadata"]["formula"] == "0.02"
    assert got["a0"]["unit_price"] == Decimal("0.10") and got["a0"]["currency"] == "USD"


def random_tiers(rng):
    limits = [D(rng.choice([5, 10, 10, 20, 30, 50, 80])) for _ in range(rng.randint(1, 5))]
    if rng.random() < 0.6:
        limits.sort()
    if rng.random() < 0.5:
        limits[rng.randrange(len(limits)) if rng.random() < 0.3 else -1] = None
    return [(limit, D(rng.randint(0, 4000)) / 10000, D(rng.randint(0, 300)) / 100) for limit in limits]


@pytest.mark.parametrize("scale", [2, 6])
def test_random_tiers_match_the_loops(spark, scale):
    rng = random.Random(scale)
    rules, rows, expected = [], [], []
    for n in range(120):
        tiers = random_tiers(rng)
        rules += [(f"t{n}", "tiered", tiers), (f"v{n}", "volume", tiers)]
        for _ in range(6):
            quantity = D(rng.choice([0, 5, 10, 20, 50, 100, rng.randint(0, 12000) / 100])).quantize(D("0.01"))
            total, used = graduated(tiers, quantity, scale)
            rows += [(f"t{n}", quantity, NOON), (f"v{n}", quantity, NOON)]
            expected += [(total, used), (by_volume(tiers, quantity, scale), None)]
    got, missed = amounts(spark, rules, rows, price_scale=scale)
    assert not missed
    for i, (total, used) in enumerate(expected):
        charge = got[f"a{i}"]
        assert charge["subtotal"] == total, (i, rows[i])
        if used is not None:
            assert len(charge["calculation_metadata"]["tiersApplied"]) == used, (i, rows[i])


def random_books(rng, count):
    start = datetime(2024, 1, 1)
    books = []
    for n in range(count):
        begin = start + timedelta(hours=rng.randint(0, 24 * 120))
        end = None if rng.random() < 0.2 else begin + timedelta(hours=rng.randint(1, 24 * 60))
        books.append((f"b{n:03d}", begin, end))
    return books


@pytest.mark.parametrize("shuffled", [False, True])
def test_as_of_join_with_overlapping_books(spark, shuffled):
    rng = random.Random(7)
    books = random_books(rng, 40)
    times = [datetime(2023, 12, 20) + timedelta(minutes=rng.randint(0, 60 * 24 * 250)) for _ in range(400)]
    times += [b[1] for b in books] + [b[2] for b in books if b[2]]
    facts = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "n int, at timestamp")
    limits = {"broadcast_rows": 0, "rows_per_task": 50} if shuffled else {}
    found = pricebooks.attach_book(facts, book_table(spark, books), "at", ["n"], **limits)
    got = {r["n"]: r["price_book_id"] for r in found.collect()}
    assert len(got) == len(times)
    for i, at in enumerate(times):
        valid = [b for b in books if b[1] <= at and (b[2] is None or b[2] > at)]
        want = min(valid, key=lambda b: (-b[1].timestamp(), b[0]))[0] if valid else None
        assert got[i] == want, at


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0}, {"broadcast_rows": 0, "rows_per_task": 500}])
def test_any_dates_and_any_number_of_books(spark, limits):
    """One book since 1900, some until 9999, and more short ones than fit a list."""
    short = [(f"s{n:05d}", datetime(2030, 1, 1) + timedelta(hours=n), datetime(2030, 1, 1) + timedelta(hours=n + 1)) for n in range(2_100)]
    books = [("old", datetime(1900, 1, 1), None), ("far", datetime(1960, 1, 1), datetime(1965, 1, 1)), ("end", datetime(2031, 1, 1), datetime(9999, 12, 31)), *short]
    times = {
        "none": datetime(1899, 12, 31), "old": datetime(1900, 1, 1), "far": datetime(1961, 5, 5), "old ": datetime(1969, 6, 1), "old  ": datetime(2024, 6, 1),
        "s00000": datetime(2030, 1, 1), "s02099": datetime(2030, 3, 29, 11, 59), "old   ": datetime(2030, 3, 29, 12), "end": datetime(5000, 1, 1), "old    ": datetime(9999, 12, 31),
    }
    facts = spark.createDataFrame([*times.items(), ("null", None)], "n string, at timestamp")
    found = pricebooks.attach_book(facts, book_table(spark, books), "at", ["n"], **limits)
    got = {r["n"]: r["price_book_id"] for r in found.collect()}
    assert got == {n: None if n in ("none", "null") else n.strip() for n in [*times, "null"]}


def test_amounts_too_large_are_reported_not_raised(spark):
    from tallymark.operators import rating

    books = book_table(spark, [("b", datetime(2024, 1, 1), None)])
    rules = spark.sql(
        "SELECT 'r' AS rule_id, 'b' AS price_book_id, 'm' AS metric_type, 'per_unit' AS pricing_model, 'count' AS unit,"
        " array(named_struct('tier', 1, 'upTo', CAST(NULL AS decimal(20,6)), 'unitPrice', CAST(5 AS decimal(12,6)), 'flatFee', CAST(0 AS decimal(12,2)))) AS tiers"
    )
    usage = spark.sql(
        "SELECT 'c' AS customer_id, 'm' AS metric_type, CAST(q AS decimal(20,6)) AS quantity, TIMESTAMP '2024-02-01' AS effective_date,"
        " a AS aggregation_id, CAST(NULL AS string) AS source_event_id FROM VALUES ('1', 90000000000), ('2', 10) AS t(a, q)"
    )
    charges, unrated = rating.rate(usage, books, rules, "2024-03-01")
    assert [(r["aggregation_id"], str(r["subtotal"])) for r in charges.collect()] == [("2", "50.00")]
    assert [(r["aggregation_id"], r["reason"]) for r in unrated.collect()] == [("1", "CALCULATION_ERROR")]


def test_price_boundary_is_inclusive(spark):
    books = book_table(spark, [("v1", datetime(2024, 1, 1), datetime(2024, 1, 15)), ("v2", datetime(2024, 1, 15), None)])
    dates = spark.createDataFrame([(datetime(2024, 1, 14, 23, 59, 59),), (datetime(2024, 1, 15),), (datetime(2030, 1, 1),), (datetime(2023, 1, 1),)], "as_of timestamp")
    got = [r["price_book_id"] for r in pricebooks.effective_book(books, dates).orderBy("as_of").collect()]
    assert got == [None, "v1", "v2", "v2"]


def test_sample_books(spark):
    """Three books with one start: the smallest id answers, whatever the row order."""
    from tallymark.operators import integrity
    from tallymark.sources import samples

    books, rules = samples.sample_books(spark), samples.sample_rules(spark)
    usage = usage_table(spark, [("api_call", 10, NOON), ("api_calls", 10, NOON)])
    charges, unrated = rating.rate(usage, books, rules, NOON)
    charge = charges.first()
    assert (charge["price_book_id"], charge["subtotal"]) == ("agreed", Decimal("0.01"))
    assert unrated.first()["reason"] == "NO_PRICE_RULE"
    volume = usage_table(spark, [("api_call", 12500, NOON)])
    one = books.filter("price_book_id = 'graded'")
    assert rating.rate(volume, one, rules, NOON)[0].first()["subtotal"] == Decimal("225.00")
    assert {r["rule_count"] for r in pricebooks.rules_per_book(books, rules).collect()} == {3}
    tables = {"price_rules": rules, "price_books": books, "customers": samples.sample_customers(spark)}
    assert all(integrity.violations(name, tables).isEmpty() for name in tables)


def test_both_join_ways_give_the_same_charges(spark, sf_dir):
    from tallymark.plans import rating_queries, workload

    usage = rating_queries.to_rate(spark, sf_dir)
    def run(**limits):
        options = rating.RatingOptions(trail=False, **limits)
        return rating.rate(usage, workload.books(spark), workload.rules(spark), F.col("calculated_at"), options)

    (charges, unrated), (slow, slow_unrated) = run(), run(broadcast_rows=0, rows_per_task=100)
    assert charges.exceptAll(slow).isEmpty() and slow.exceptAll(charges).isEmpty()
    assert unrated.exceptAll(slow_unrated).isEmpty() and slow_unrated.exceptAll(unrated).isEmpty()


def test_versions(spark):
    family = lambda df: df.withColumn("parent_id", F.lit("f"))
    books = family(book_table(spark, [("a", datetime(2024, 1, 1), datetime(2024, 2, 1)), ("b", datetime(2024, 3, 1), None)]))
    assert [r["problem"] for r in pricebooks.version_problems(books).collect()] == ["GAP"]
    new = family(book_table(spark, [("c", datetime(2024, 5, 1), None)]))
    after, refused = pricebooks.add_versions(books, new, "2024-04-01")
    assert refused.isEmpty()
    ends = {r["price_book_id"]: r["effective_until"] for r in after.collect()}
    assert ends == {"a": datetime(2024, 2, 1), "b": datetime(2024, 5, 1), "c": None}
    _, refused = pricebooks.add_versions(books, new, "2024-06-01")
    assert refused.first()["reason"] == "IN_THE_PAST"
    days = pricebooks.date_range(spark, "2024-01-30", "2024-02-02")
    assert pricebooks.uncovered_dates(books, days).count() == 2


def test_only_final_usage_is_rated(spark, rows):
    usage = rows(
        "customer_id string, metric_type string, value decimal(20,6), window_start timestamp, aggregation_id string, is_final boolean",
        "('c', 'm', 1, '2024-01-01 00:00:00', 'a', true), ('c', 'm', 1, '2024-01-01 01:00:00', 'b', false)",
    )
    assert [r["aggregation_id"] for r in rating.usage_to_rate(usage).collect()] == ["a"]


def test_late_event_becomes_a_charge_request(spark, rows):
    late = rows("event_id string, customer_id string, metric_type string, event_time timestamp, metadata string", "('e', 'c', 'api_calls', '2024-01-01 12:00:00', '{\"value\":100}')")
    row = rating.late_events_to_rate(late).first()
    assert (row["quantity"], row["aggregation_id"], row["source_event_id"]) == (100, None, "e")


def brute_books(books, dates):
    """The book in force at each (group, date): latest start, then smallest id."""
    out = {}
    for group, date in dates:
        fit = [(-a, i) for i, g, a, b in books if g == group and a <= date and (b is None or b > date) and (b is None or b > a)]
        out[(group, date)] = min(fit)[1] if fit else None
    return out


@pytest.mark.parametrize("path", ["lists", "ranks", "times"])
def test_every_way_of_looking_up_a_book_gives_the_same(spark, path, monkeypatch):
    rng = random.Random(5)
    books = []
    for n in range(160):
        start = rng.randrange(-40, 60)
        books.append((f"b{n:03}", f"g{rng.randrange(6)}", start, rng.choice([None, start, start - 3, start + rng.randrange(1, 90)])))
    dates = [(f"g{g}", d) for g in range(7) for d in range(-45, 160, 3)]
    want = brute_books(books, dates)
    day = lambda c: F.timestamp_micros(F.col(c) * 86_400_000_000)
    table = spark.createDataFrame([(i, g, a, b, "v") for i, g, a, b in books], "price_book_id string, g string, a long, b long, version string")
    table = table.select("price_book_id", "g", day("a").alias("effective_from"), day("b").alias("effective_until"), "version")
    facts = spark.createDataFrame(dates, "g string, d long").withColumn("at", day("d"))
    if path != "lists":
        monkeypatch.setattr(pricebooks, "GROUP_BOOKS", 0)
    if path == "times":
        monkeypatch.setattr(pricebooks, "groups_fit", lambda *a: False)
    for keys, lookup in ((["g"], want), ([], brute_books([(i, 0, a, b) for i, _, a, b in books], [(0, d) for _, d in dates]))):
        for limit in (200_000, 1):
            found = pricebooks.attach_book(facts, table.drop(*({"g"} - set(keys))), "at", ["g", "d"], keys, broadcast_rows=limit)
            assert {(r.g if keys else 0, r.d): r.price_book_id for r in found.collect()} == lookup


def test_periods_of_any_length_meet_each_charge_once(spark):
    rng = random.Random(8)
    hour = lambda c: F.timestamp_micros(F.col(c) * 3_600_000_000)
    at = lambda: rng.randrange(-20_000, 600_000)
    charges = [(f"c{n}", f"u{rng.randrange(4)}", at()) for n in range(400)] + [("none", "u1", None)]
    lengths = [0, 1, 5, 24, 70, 24 * 7, 24 * 20, 24 * 31, 24 * 80, 24 * 365, 24 * 3000, 24 * 30_000, -5]
    periods = []
    for n in range(120):
        start = rng.choice([c[2] for c in charges if c[2] is not None]) - rng.choice([0, 0, 3, 500])
        periods.append((n, f"u{rng.randrange(5)}", start, start + rng.choice(lengths)))
    want = sorted((c, n) for c, u, t in charges for n, v, a, b in periods if u == v and t is not None and a <= t <= b)
    left = spark.createDataFrame(charges, "charge_id string, customer_id string, t long").select("charge_id", "customer_id", hour("t").alias("created_at"))
    right = spark.createDataFrame([*periods, (900, "u1", None, 5), (901, "u1", 5, None)], "n long, customer_id string, a long, b long")
    right = right.select("n", "customer_id", hour("a").alias("period_start"), hour("b").alias("period_end"))
    for limits in ({}, {"broadcast_rows": 0, "rows_per_task": 20}):
        found = rating.charges_for_periods(left, right, **limits)
        assert set(found.columns) == {"customer_id", "charge_id", "created_at", "n", "period_start", "period_end"}
        assert sorted((r.charge_id, r.n) for r in found.collect()) == want and len(want) > 300


def test_a_charge_is_compared_with_two_of_a_hundred_and_twenty_months(spark):
    months = spark.range(120).select(F.lit(1).alias("customer_id"), F.expr("timestamp'2015-01-01' + make_ym_interval(0, int(id))").alias("period_start"))
    months = months.withColumn("period_end", F.expr("period_start + make_ym_interval(0, 1) - interval 1 second"))
    filed = rating._filed(months).select(F.explode("_slots.slots").alias("slot"), F.col("_slots.unit").alias("unit"))
    assert filed.select("unit").distinct().count() == 1
    assert filed.groupBy("slot").count().agg(F.max("count")).first()[0] <= 2
    assert rating.charges_for_periods(months.limit(0).select("customer_id", F.lit("c").alias("charge_id"), F.col("period_start").alias("created_at")), months.limit(0)).count() == 0


def test_slots_of_periods_are_plain_arithmetic(spark):
    moments = [datetime(1969, 12, 31, 23), datetime(2024, 1, 1), datetime(2024, 1, 15, 23, 59), datetime(2024, 2, 29), datetime(2031, 5, 1)]
    rows = [(a, b) for a in moments for b in moments] + [(None, moments[0]), (moments[0], None)]
    periods = spark.createDataFrame(rows, "period_start timestamp, period_end timestamp")
    filed = rating._filed(periods)
    # A lambda is worked out anew for every use of its result.
    assert "lambda" not in filed._jdf.queryExecution().optimizedPlan().toString()
    found = filed.collect()
    assert len(found) == 15
    for r in found:
        day = lambda t: (t - datetime(1970, 1, 1)).days
        month = lambda t: t.year * 12 + t.month - 1
        hour = lambda t: (t - datetime(1970, 1, 1)) // timedelta(hours=1)
        ways = [hour, day, lambda t: day(t) // 7, month, *[lambda t, n=n: month(t) // n for n in (3, 12, 120)], lambda t: 0]
        unit, first, last = next((n, w(r.period_start), w(r.period_end)) for n, w in enumerate(ways) if w(r.period_end) - w(r.period_start) <= 1)
        assert (r._slots.unit, r._slots.slots) == (unit, list(dict.fromkeys([first, last])))
