"""Summaries kept up by changes: rows that were added and rows that were withdrawn.

Counts and sums follow from the changes alone.  A maximum follows as well, except where the
row that held it is withdrawn and none of the added ones reaches it; only groups of that kind
are read again from the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.operators.skew import at_most
from tallymark.session import materialise


@dataclass(frozen=True)
class Summary:
    """Number of rows per key, sums and maxima of columns: {name of the result: column}."""

    keys: Sequence[str]
    sums: dict[str, str] = field(default_factory=dict)
    maxima: dict[str, str] = field(default_factory=dict)
    rows: str = "rows"

    def full(self, table: DataFrame) -> DataFrame:
        """The summary of a whole table."""
        sums = [F.sum(c).alias(n) for n, c in self.sums.items()]
        return table.groupBy(*self.keys).agg(F.count(F.lit(1)).alias(self.rows), *sums, *[F.max(c).alias(n) for n, c in self.maxima.items()])

    def changed(self, stored: DataFrame, added: DataFrame, withdrawn: DataFrame, table: DataFrame) -> DataFrame:
        """The summary after a change; ``table`` holds the rows as they are after it.

        Keys that hold null are groups like others.  A group without rows is gone.  A sum of
        nulls alone is null, as in ``full``; how many values are behind it is not stored, so
        columns that are added up should hold none.
        """
        kinds = {f.name: f.dataType for f in stored.schema.fields}
        more, less = (_named(self.full(t), self.keys, side) for t, side in ((added, "_more"), (withdrawn, "_less")))
        changes = more.join(less, self._same(more, less), "full_outer")
        # Keys come from whichever side has them.
        both = [F.coalesce(f"_more_{k}", f"_less_{k}").alias(f"_new_{k}") for k in self.keys]
        changes = changes.select(*both, *[c for c in changes.columns if c[6:] not in self.keys])
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_new_{k}"))
        # Changes are few beside what is stored; where they are proven so, the stored side stays in place.
        changes = materialise(changes.withColumn("_changed", F.lit(True)))
        joined = stored.join(changes, same, "full_outer")
        zero = lambda name: F.coalesce(F.col(name), F.lit(0))
        moved = {n: zero(n) + zero(f"_more_{n}") - zero(f"_less_{n}") for n in (self.rows, *self.sums)}
        present = F.col(self.rows).isNotNull()
        keys = [F.when(present, F.col(k)).otherwise(F.col(f"_new_{k}")).alias(k) for k in self.keys]
        maxima = [F.greatest(n, f"_more_{n}").alias(n) for n in self.maxima]
        gone = [F.coalesce((F.col(f"_less_{n}") >= F.col(n)) & ~(F.coalesce(F.col(f"_more_{n}") >= F.col(n), F.lit(False))), F.lit(False)) for n in self.maxima]
        stale = F.lit(False)
        for g in gone:
            stale = stale | g
        after = joined.select(*keys, *[F.when(F.col("_changed"), m).otherwise(F.col(n)).cast(kinds[n]).alias(n) for n, m in moved.items()], *maxima, stale.alias("_stale"))
        after = after.filter(F.col(self.rows) > 0)
        if not self.maxima:
            return after.drop("_stale")
        after = materialise(after)
        again = after.filter("_stale").select(*self.keys)
        if again.isEmpty():
            return after.drop("_stale")
        return after.filter(~F.col("_stale")).drop("_stale").unionByName(self._reread(after, table))

    def _reread(self, after: DataFrame, table: DataFrame) -> DataFrame:
        """Groups whose maximum went, with that of the rows that are left."""
        stale = after.filter("_stale").drop("_stale", *self.maxima)
        wanted = stale.select(*[F.col(k).alias(f"_new_{k}") for k in self.keys])
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_new_{k}"))
        few = at_most(wanted, settings.BROADCAST_ROWS)
        rows = table.join(F.broadcast(wanted) if few else wanted, same, "left_semi")
        found = rows.groupBy(*self.keys).agg(*[F.max(c).alias(n) for n, c in self.maxima.items()])
        found = found.select(*[F.col(k).alias(f"_new_{k}") for k in self.keys], *self.maxima)
        return stale.join(found, same, "left").select(*after.drop("_stale").columns)

    def _same(self, more: DataFrame, less: DataFrame) -> Column:
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(f"_more_{k}").eqNullSafe(F.col(f"_less_{k}"))
        return same


def _named(rows: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{side}_{c}") for c in rows.columns])
