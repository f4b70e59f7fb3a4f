"""Scans over split groups, heavy-key joins and credit allocation."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymark.operators import credits
from tallymark.operators.scans import groups_fit, neighbours, running_total
from tallymark.operators.skew import at_most, keyed_join


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows belong to one key."""
    return spark.range(900).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.col("id"),
        (F.col("id") % 17).cast("decimal(18,2)").alias("v"),
        F.when(F.col("id") % 7 == 0, F.col("id")).alias("mark"),
    )


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_split_running_total(skewed):
    whole = running_total(skewed, ["k"], [F.col("id").asc()], "v", "t", split=False)
    parts = running_total(skewed, ["k"], [F.col("id").asc()], "v", "t", split=True)
    assert same(whole, parts.select(*whole.columns))


def test_split_neighbours(skewed):
    wanted = {"previous": {"before": "v"}, "next_row": {"after": "mark"}, "following": {"coming": "mark"}}
    whole = neighbours(skewed, ["k"], [F.col("id").asc()], **wanted, split=False)
    parts = neighbours(skewed, ["k"], [F.col("id").asc()], **wanted, split=True)
    assert same(whole, parts.select(*whole.columns))


def test_group_size_check(skewed):
    assert groups_fit(skewed, ["k"], 600)
    assert not groups_fit(skewed, ["k"], 599)
    assert at_most(skewed, 900) and not at_most(skewed, 899)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_heavy_keys_are_spread(skewed, spark, how):
    lookup = skewed.filter("k <> 'k3'").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plain = skewed.join(lookup, "k", how)
    spread = keyed_join(skewed, lookup, ["k"], ["id"], how, broadcast_rows=0, rows_per_task=40)
    assert same(plain, spread.select(*plain.columns))
    ranged = keyed_join(skewed, lookup, ["k"], ["id"], how, F.col("id") < F.col("n"), broadcast_rows=0, rows_per_task=40)
    wanted = skewed.join(lookup.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & (F.col("id") < F.col("n")), how).drop("k2")
    assert same(wanted, ranged.select(*wanted.columns))


def test_null_keys_match_nothing_and_are_kept(spark):
    facts = spark.range(40).select(F.when(F.col("id") % 2 == 0, F.col("id") % 4).alias("k"), "id")
    lookup = spark.range(4).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    got = keyed_join(facts, lookup, ["k"], ["id"], "left", broadcast_rows=0, rows_per_task=3)
    assert got.count() == 40 and got.filter("name IS NULL").count() == 20


def spend_in_order(invoices, balances):
    """Plain loop: invoices in order, each taking from the credits in order."""
    paid, left = [], dict(balances)
    for invoice, amount in invoices:
        for credit, _ in balances:
            used = min(left[credit], amount)
            if used > 0:
                paid.append((invoice, credit, used))
                left[credit] -= used
                amount -= used
    return paid


@pytest.mark.parametrize("split", [False, True])
def test_allocation_matches_the_loop(spark, split):
    rng = random.Random(3)
    totals, balances, expected = [], [], []
    for customer in range(40):
        hot = customer == 0
        invoices = [
            (f"i{customer}-{n:03d}", Decimal(rng.choice([0, 5, 10, 10, 25, 7.5]))) for n in range(60 if hot else rng.randint(0, 5))
        ]
        owned = [
            (f"c{customer}-{n:03d}", Decimal(rng.choice([0, 5, 10, 30, 2.5]))) for n in range(60 if hot else rng.randint(0, 5))
        ]
        start = datetime(2024, 1, 1)
        totals += [(customer, i, start + timedelta(days=n), a) for n, (i, a) in enumerate(invoices)]
        balances += [(c, customer, None, start + timedelta(hours=n), a) for n, (c, a) in enumerate(owned)]
        expected += spend_in_order(invoices, owned)
    bills = spark.createDataFrame(totals, "customer_id int, invoice_id string, period_start timestamp, amount decimal(18,2)")
    funds = spark.createDataFrame(balances, "credit_id string, customer_id int, expires_at timestamp, created_at timestamp, remaining_amount decimal(18,2)")
    got = credits.allocate(bills, funds, split).collect()
    assert sorted((r["invoice_id"], r["credit_id"], r["amount"]) for r in got) == sorted(expected)
    after = credits.spend(funds.withColumn("status", F.lit("active")), credits.allocate(bills, funds, split))
    used = {}
    for _, credit, amount in expected:
        used[credit] = used.get(credit, 0) + amount
    for row, (credit, _, _, _, amount) in zip(after.orderBy("credit_id").collect(), sorted(balances)):
        assert row["remaining_amount"] == amount - used.get(credit, 0)
        assert row["status"] == ("fully_used" if credit in used and row["remaining_amount"] == 0 else "active")


def test_usable_credits(spark, rows):
    given = rows(
        "credit_id string, status string, expires_at timestamp, remaining_amount decimal(12,2)",
        "('a', 'active', null, 5), ('b', 'active', '2024-06-01 00:00:00', 5), ('c', 'active', '2023-06-01 00:00:00', 5), ('d', 'void', null, 5), ('e', 'active', null, 0)",
    )
    assert [r["credit_id"] for r in credits.usable_credits(given, "2024-01-01").collect()] == ["a"]
    assert sorted(r["credit_id"] for r in credits.usable_credits(given, "2024-01-01", honour_expiry=True).collect()) == ["a", "b"]


def test_following_rows_are_not_gone_through_for_every_row(skewed):
    found = neighbours(skewed, ["k"], [F.col("id").asc()], following={"coming": "mark"}, split=False)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "currentrow$(), unboundedfollowing$()" not in plan.lower()
    rows = sorted((r.k, r.id, r.mark, r.coming) for r in found.collect())
    for i, (k, _, _, coming) in enumerate(rows):
        assert coming == next((m for other, _, m, _ in rows[i:] if other == k and m is not None), None)


def test_facts_without_heavy_keys_are_counted_once_and_not_salted(skewed):
    lookup = skewed.select("k").distinct().withColumn("name", F.upper("k"))
    joined = keyed_join(skewed, lookup, ["k"], ["id"], "left", small=False, rows_per_task=700)
    assert "_salt" not in joined._jdf.queryExecution().analyzed().toString()
    assert joined.filter(F.col("name") == F.upper("k")).count() == 900
