"""Do two tables hold the same rows?  Fingerprints first, rows only where they differ.

Rows are dealt by a hash of their key into the leaves of a tree.  The fingerprint of a leaf is
the number of its rows and the sums of two hashes of them, which do not depend on their order
or place.  Tables that agree are read once each.  Where leaves differ, each is divided again
and only their rows, written out once, are looked at, until what is left is little enough to be
joined or does not become less.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.operators.skew import at_most
from tallymark.session import materialise

#: Leaves that a node of the tree is divided into, and levels of the tree.
BRANCHES, LEVELS = 4096, 4
#: Differing leaves with at most this many rows are compared row by row.
ROWS_TO_JOIN = 1_000_000
#: Hashes are added in halves, so that sums of up to 2**31 rows of a leaf are exact.
_HALF = (1 << 32) - 1

PATH, ABOVE = "_path", "_above"
_SUMS = ["rows", "a_low", "a_high", "b_low", "b_high"]


def fingerprints(table: DataFrame, key: Sequence[str], level: int = 0, within: DataFrame | None = None, branches: int = BRANCHES) -> DataFrame:
    """(path, rows, sums of hashes) of the leaves of a level of the tree; ``within`` are paths of the level above."""
    columns = table.columns
    rows = _placed(table, key, level, branches)
    if within is not None:
        rows = _inside(rows, within)
    halves = []
    for seed, names in ((1, _SUMS[1:3]), (2, _SUMS[3:])):
        value = F.xxhash64(*[F.col(c) for c in columns], F.lit(seed))
        halves += [value.bitwiseAND(_HALF).alias(names[0]), F.shiftrightunsigned(value, 32).alias(names[1])]
    return rows.select(PATH, *halves).groupBy(PATH).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(n).alias(n) for n in _SUMS[1:]])


def differences(
    first: DataFrame,
    second: DataFrame,
    key: Sequence[str] | None = None,
    rows_to_join: int = ROWS_TO_JOIN,
    branches: int = BRANCHES,
) -> DataFrame:
    """Rows that one table holds more often than the other, with ``side``: 'first' or 'second'.

    ``key`` names columns that tell rows apart; without it all columns do.  Rows count as often
    as they occur.  Tables whose fingerprints agree are taken as equal: two hashes of 64 bits,
    summed over each leaf, and the number of rows agree by chance in one of 2**100 cases.
    """
    columns = first.columns
    key, tables = list(key or columns), [first, second.select(*columns)]
    within = before = None
    for level in range(LEVELS):
        sides = [fingerprints(t, key, level, within, branches) for t in tables]
        named = [s.select(PATH, *[F.col(c).alias(f"_{n}_{c}") for c in _SUMS]) for n, s in enumerate(sides)]
        differ = reduce(or_, [~F.col(f"_0_{c}").eqNullSafe(F.col(f"_1_{c}")) for c in _SUMS])
        held = F.coalesce("_0_rows", F.lit(0)) + F.coalesce("_1_rows", F.lit(0))
        within = materialise(named[0].join(named[1], PATH, "full_outer").filter(differ).select(PATH, held.alias("rows")))
        left = within.agg(F.sum("rows").alias("n")).first()["n"] or 0
        if not left:
            return first.limit(0).withColumn("side", F.lit("first"))
        # Tables may be dear to work out: of the leaves that differ, rows are written once for all steps that follow.
        tables = [materialise(_inside(_placed(t, key, level + 1, branches), within).select(*columns)) for t in tables]
        # Where differences lie in most leaves, more levels would leave nothing out.
        if left <= rows_to_join or (before is not None and 2 * left > before):
            break
        before = left
    only_first = tables[0].exceptAll(tables[1]).withColumn("side", F.lit("first"))
    return only_first.unionByName(tables[1].exceptAll(tables[0]).withColumn("side", F.lit("second")))


def agree(first: DataFrame, second: DataFrame, key: Sequence[str] | None = None) -> bool:
    return differences(first, second, key).isEmpty()


def _placed(table: DataFrame, key: Sequence[str], level: int, branches: int) -> DataFrame:
    """Rows with their path down to the level, and one branch further."""
    place = F.xxhash64(*[F.col(k) for k in key], F.lit(0))
    return table.withColumns({n: F.pmod(place, F.lit(branches**depth)) for n, depth in ((ABOVE, level), (PATH, level + 1))})


def _inside(rows: DataFrame, within: DataFrame) -> DataFrame:
    """The rows below the given paths of the level above."""
    paths = within.select(F.col(PATH).alias(ABOVE))
    return rows.join(F.broadcast(paths) if at_most(paths, settings.BROADCAST_ROWS) else paths, ABOVE, "left_semi")
