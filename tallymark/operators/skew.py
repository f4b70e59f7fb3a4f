"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.session import materialise

SALT = "_salt"
SPLITS = "_splits"
NULL_SALTS = 1 << 16


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows; only one number leaves each task."""
    return df.count() <= rows


def keyed_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    row_id: Sequence[str],
    how: str = "left",
    condition: Column | None = None,
    broadcast_rows: int = settings.BROADCAST_ROWS,
    rows_per_task: int = settings.ROWS_PER_TASK,
    small: bool | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on equal ``keys`` plus an optional condition.

    A counted, small lookup is broadcast and the facts are not shuffled.  A larger
    one is joined by shuffle, with keys that hold more than ``rows_per_task`` facts
    spread over several tasks by a hash of ``row_id``, which must tell rows apart.
    Facts with a null key match nothing and are spread as well.
    Columns of both sides must differ except for the keys.  ``small`` passes on the
    answer when the caller has already bounded the lookup by ``broadcast_rows``, and
    ``counts`` (keys, n) the number of facts per key, which is counted otherwise.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    if small is None:
        small = at_most(lookup, broadcast_rows)
    if small:
        return _join(facts, F.broadcast(lookup), list(keys), condition, how)
    keys = list(keys)
    # At most rows / rows_per_task keys can be this heavy, which bounds the broadcast.
    if counts is None:
        counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    heavy = counts.filter(F.col("n") > rows_per_task).select(
        *keys, F.ceil(F.col("n") / rows_per_task).cast("int").alias(SPLITS)
    )
    # Written out, so that the facts are worked out once for it, however many joins hang on this one.
    heavy = materialise(heavy)
    if heavy.isEmpty():
        return _join(facts, lookup, keys, condition, how)
    place = F.xxhash64(*row_id)
    unmatched = reduce(or_, [F.col(key).isNull() for key in keys])
    salted = facts.join(F.broadcast(heavy), keys, "left").withColumn(
        SALT,
        F.when(unmatched, F.pmod(place, F.lit(NULL_SALTS)).cast("int"))
        .when(F.col(SPLITS).isNull(), 0)
        .otherwise(F.pmod(place, F.col(SPLITS)).cast("int")),
    )
    copies = lookup.join(F.broadcast(heavy), keys, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SPLITS), F.lit(1)) - 1))
    )
    return _join(salted.drop(SPLITS), copies.drop(SPLITS), [*keys, SALT], condition, how).drop(SALT)


def _join(left: DataFrame, right: DataFrame, keys: list[str], condition, how: str) -> DataFrame:
    if condition is None:
        return left.join(right, keys, how)
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = condition
    for key in keys:
        on = on & (F.col(key) == F.col(f"_r_{key}"))
    return left.join(renamed, on, how).drop(*[f"_r_{key}" for key in keys])
