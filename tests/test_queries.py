"""Every registered query: its plan, and its rows against its SQL."""

import duckdb
import pytest

from __spark_entry__ import entry
from tallymark.plans import load

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = load()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    plan = plan_of(df)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan, unwanted
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert normal(df.columns, df.collect()) == normal(names, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry(spark).count() == 10


def test_scans_read_only_what_is_needed(spark, sf_dir):
    plan = plan_of(QUERIES["event_search"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)" in plan
    assert "props" not in plan.split("ReadSchema")[1] and "TakeOrderedAndProject" in plan
    plan = plan_of(QUERIES["revenue_by_metric"](spark, sf_dir))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string>" in plan


@pytest.mark.parametrize("name", ["event_first_copies", "invoice_latest_billed"])
def test_copies_of_a_key_are_cut_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert plan.index("Exchange hashpartitioning") < plan.index("Partial", plan.index("Exchange hashpartitioning"))
    assert "WindowGroupLimit" in plan[plan.index("Exchange hashpartitioning") :]


def test_usage_is_aggregated_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["usage_hourly"](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan and "SortAggregate" not in plan


def test_rating_does_not_shuffle_the_facts(spark, sf_dir):
    from pyspark.sql import functions as F

    from tallymark.operators import rating
    from tallymark.plans import workload

    events = workload.telemetry(spark, sf_dir)
    wanted = rating.late_events_to_rate(events, ["ingestion_time"])
    rows, _ = rating.rate(wanted, workload.books(spark), workload.rules(spark), F.col("ingestion_time"), rating.RatingOptions(trail=False))
    plan = plan_of(rows)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # Nothing above the scan of the facts is an exchange; the price books come as a subquery.
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet [event_id" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-*"))
    for line in reversed(lines[:scan]):
        indent = len(line) - len(line.lstrip(" :+-*"))
        if indent < depth:
            depth = indent
            assert "Exchange" not in line, line
