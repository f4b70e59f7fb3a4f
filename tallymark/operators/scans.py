"""Running totals and neighbours within ordered groups of any size.

A plain window sends a whole group to one task.  When a group may be larger than
``rows_per_task`` the rows are range-partitioned by (group, order), each part is
scanned on its own, and a small table of one row per (group, part) carries totals
and boundary rows from part to part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.operators.skew import at_most
from tallymark.session import materialise

PART = "_part"
PLACE = "_place"


def groups_fit(df: DataFrame, keys: Sequence[str], rows_per_task: int = settings.ROWS_PER_TASK) -> bool:
    """Whether every group can be scanned by one task."""
    if at_most(df, rows_per_task):
        return True
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows_per_task)
    return large.isEmpty()


def ordered_parts(df: DataFrame, keys: Sequence[str], order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """Rows with the number of their range part; ``order`` must end in a unique column.

    Written out once: range bounds come from a sample, so two evaluations could
    number the rows differently.
    """
    spark = df.sparkSession
    count = parts or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(count, *[F.col(k) for k in keys], *order)
    return materialise(ranged.withColumn(PART, F.spark_partition_id()))


def numbered(ordered: DataFrame, name: str = "place", order: Sequence[Column] = ()) -> DataFrame:
    """Rows with their place, from 1, in the order they come out, or in that of ``order``.

    Every part of the ordered table numbers its own rows; how many rows the parts before it
    hold comes from a table of one row per part.  No task sees more than its own part.
    """
    if order:
        ordered = ordered.orderBy(*order)
    # Part and number within the part; written out once, since bounds of parts come from a sample.
    rows = materialise(ordered.withColumn(name, F.monotonically_increasing_id()))
    part = F.shiftright(name, 33)
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(part.alias(PART)).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.col(name).bitwiseAND((1 << 33) - 1)
    joined = rows.withColumn(PART, part).join(F.broadcast(offsets), PART)
    return joined.withColumn(name, F.col("_before") + within + 1).drop(PART, "_before")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: str,
    out: str,
    split: bool | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of the group up to this one."""
    keys = list(keys)
    if split is None:
        split = not groups_fit(df, keys)
    total_type = "decimal(28,2)"
    upto = (Window.unboundedPreceding, Window.currentRow)
    if not split:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
        return df.withColumn(out, F.sum(value).over(window).cast(total_type))
    parts = ordered_parts(df, keys, order)
    earlier = (
        parts.groupBy(*keys, PART)
        .agg(F.sum(value).alias("_sum"))
        .withColumn(
            "_before",
            F.sum("_sum").over(
                Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .drop("_sum")
    )
    window = Window.partitionBy(*keys, PART).orderBy(*order).rowsBetween(*upto)
    scanned = parts.withColumn("_within", F.sum(value).over(window))
    return (
        scanned.join(earlier, [*keys, PART], "left")
        .withColumn(out, (F.col("_within") + F.coalesce(F.col("_before"), F.lit(0))).cast(total_type))
        .drop("_within", "_before", PART)
    )


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    next_row: dict[str, str] | None = None,
    split: bool | None = None,
) -> DataFrame:
    """Add columns taken from other rows of the ordered group.

    ``previous``  {out: column} value on the row before;
    ``next_row``  {out: column} value on the row after;
    ``following`` {out: column} first non-null value on this row or later.
    """
    keys = list(keys)
    previous, following, next_row = previous or {}, following or {}, next_row or {}
    if split is None:
        split = not groups_fit(df, keys)
    if not split:
        return _scan(df, keys, order, previous, following, next_row)

    parts = ordered_parts(df, keys, order)
    scanned = _scan(parts, [*keys, PART], order, previous, following, next_row)
    place = Window.partitionBy(*keys, PART).orderBy(*order)
    scanned = scanned.withColumn("_first", F.row_number().over(place) == 1)
    scanned = scanned.withColumn("_last", F.lead(F.lit(False), 1, True).over(place))

    edges = (
        scanned.groupBy(*keys, PART)
        .agg(
            *[F.max(F.when(F.col("_last"), F.struct(F.col(c)))).alias(f"_last_{o}") for o, c in previous.items()],
            *[F.max(F.when(F.col("_first"), F.struct(F.col(c)))).alias(f"_head_{o}") for o, c in next_row.items()],
            *[F.max(F.when(F.col("_first"), F.col(o))).alias(f"_open_{o}") for o in following],
        )
    )
    by_part = Window.partitionBy(*keys).orderBy(PART)
    after = by_part.rowsBetween(1, Window.unboundedFollowing)
    edges = edges.select(
        *keys,
        PART,
        *[F.lag(f"_last_{o}").over(by_part)[c].alias(f"_carry_{o}") for o, c in previous.items()],
        *[F.lead(f"_head_{o}").over(by_part)[c].alias(f"_carry_{o}") for o, c in next_row.items()],
        *[F.first(f"_open_{o}", ignorenulls=True).over(after).alias(f"_carry_{o}") for o in following],
    )
    joined = scanned.join(edges, [*keys, PART], "left")
    filled = {o: F.when(F.col("_first"), F.col(f"_carry_{o}")).otherwise(F.col(o)) for o in previous}
    filled |= {o: F.when(F.col("_last"), F.col(f"_carry_{o}")).otherwise(F.col(o)) for o in next_row}
    filled |= {o: F.coalesce(F.col(o), F.col(f"_carry_{o}")) for o in following}
    names = [*previous, *next_row, *following]
    return joined.withColumns(filled).drop("_first", "_last", PART, *[f"_carry_{o}" for o in names])


def _scan(df, keys, order, previous, following, next_row) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    added = {o: F.lag(c).over(window) for o, c in previous.items()}
    added |= {o: F.lead(c).over(window) for o, c in next_row.items()}
    if not following:
        return df.withColumns(added)
    # A frame that ends with the group is gone through again for every row, so rows are taken from the last one on.
    numbered_rows = df.withColumns(added | {PLACE: F.row_number().over(window)})
    backwards = Window.partitionBy(*keys).orderBy(F.col(PLACE).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return numbered_rows.withColumns({o: F.last(c, ignorenulls=True).over(backwards) for o, c in following.items()}).drop(PLACE)
