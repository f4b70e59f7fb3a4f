"""Effective-dated price books: lookup intervals, price steps, validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark import settings
from tallymark.functions import values as V
from tallymark.schemas import TIERS_APPLIED as APPLIED
from tallymark.operators.scans import groups_fit, neighbours
from tallymark.operators.skew import keyed_join


STEP_FIELDS = {
    "quantity_from": "decimal(20,6)",
    "quantity_to": "decimal(20,6)",
    "step_start": "decimal(20,6)",
    "base": "decimal(18,2)",
    "step_price": "decimal(18,6)",
    "step_fee": "decimal(12,2)",
    "tier": "int",
    "tier_price": "decimal(12,6)",
    "lower_formula": "string",
    "lower_tiers": APPLIED,
}


def is_effective(when: Column, start="effective_from", until="effective_until") -> Column:
    """Start included, end excluded, no end means still valid."""
    return (F.col(start) <= when) & (F.col(until).isNull() | (F.col(until) > when))


def price_lookup(
    facts: DataFrame,
    rules: DataFrame,
    steps: DataFrame,
    row_id: Sequence[str],
    broadcast_rows: int = settings.BROADCAST_ROWS,
    rows_per_task: int = settings.ROWS_PER_TASK,
) -> DataFrame:
    """Add the price step for book, metric and quantity; ``steps`` come from ``rules``."""
    quantity = F.col("quantity")
    in_step = (F.col("quantity_from").isNull() | (quantity > F.col("quantity_from"))) & (
        F.col("quantity_to").isNull() | (quantity <= F.col("quantity_to"))
    )
    keys = ["price_book_id", "metric_type"]
    small = _few_steps(rules, broadcast_rows)
    return keyed_join(facts, steps, keys, row_id, "left", in_step, broadcast_rows, rows_per_task, small)


def effective_book(books: DataFrame, dates: DataFrame, date: str = "as_of") -> DataFrame:
    """Book in force on each date; dates without one are kept with nulls."""
    return attach_book(dates.withColumn("_id", V.stable_id(V.utc_text(date))), books, date, ["_id"]).drop("_id")


def disjoint_pieces(books: DataFrame, keys: Sequence[str] = (), rows_per_task: int = settings.ROWS_PER_TASK) -> DataFrame:
    """Books as disjoint intervals (per ``keys``), the latest start winning, the smaller id among equals.

    Books may overlap or be nested.  Between two neighbouring start or end dates the
    answer cannot change, so the winner is looked up once per date of change; where no
    book is in force a piece without one says so.  A piece ends where the next begins.
    """
    groups = list(keys) or [ALL]
    spans = _spans(books, keys).withColumn(ALL, F.lit(1))
    ends = F.array(F.unix_micros("effective_from"), F.unix_micros("effective_until"))
    dates = spans.select(*groups, F.explode(ends).alias("piece_from")).filter("piece_from IS NOT NULL").distinct()
    winners = (_winners_by_rank if groups_fit(dates, groups, rows_per_task) else _winners_by_time)(spans, dates, groups)
    return dates.join(winners, [*groups, "piece_from"], "left").select(
        *groups, "piece_from", F.col("_book.price_book_id").alias("price_book_id"), F.col("_book.version").alias("price_version")
    )


def listed_pieces(books: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The disjoint pieces of every group as one sorted array ``_pieces``, for groups of at most GROUP_BOOKS books.

    One aggregate gathers the books of a group; each of its dates then takes the best of
    those in force.
    """
    groups = list(keys) or [ALL]
    book = F.struct(
        (-F.unix_micros("effective_from")).alias("rank"), "price_book_id", "version", F.coalesce(F.unix_micros("effective_until"), F.lit(END)).alias("until")
    )
    # Sorted, so that the first one in force is the best.
    gathered = _spans(books, keys).withColumn(ALL, F.lit(1)).groupBy(*groups).agg(F.array_sort(F.collect_list(book)).alias("_books"))
    starts = F.transform("_books", lambda b: -b["rank"])
    ends = F.filter(F.transform("_books", lambda b: b["until"]), lambda until: until < END)
    dates = F.array_sort(F.array_distinct(F.concat(starts, ends)))

    def piece(date: Column) -> Column:
        best = F.get(F.filter("_books", lambda b: (-b["rank"] <= date) & (b["until"] > date)), F.lit(0))
        return F.struct(date.alias("piece_from"), best["price_book_id"].alias("price_book_id"), best["version"].alias("price_version"))

    return gathered.select(*groups, F.transform(dates, piece).alias("_pieces"))


ALL = "_all"
# Microseconds of all dates Spark knows, before and after 1970, lie within 2 to this power.
TIME_BITS = 58
END = 1 << TIME_BITS
# A piece in memory takes about this many bytes.  A row meets the array of its group, which is
# kept short: so many books at most, and a search of so many halvings.
PIECE_BYTES, GROUP_BOOKS, SEARCH_BITS = 120, 128, 8
# So does a price step, and a tier in its trail.
STEP_BYTES, TIER_BYTES = 300, 150


def _winners_by_rank(spans: DataFrame, dates: DataFrame, groups: list[str]) -> DataFrame:
    """Winner at every date, by slots over the ranks of the group's dates.

    An interval of time is an interval of ranks, and a group with n dates has log2(n) sizes
    of slots.  A group's dates are ordered in one task.
    """
    by_date = Window.partitionBy(*groups).orderBy("piece_from")
    ranked = dates.withColumn("_rank", F.row_number().over(by_date).cast("long") - 1)
    dated = spans.select(*groups, F.unix_micros("effective_from").alias("_from"), F.unix_micros("effective_until").alias("_until"), _book())
    # Both ends of a book in one pass over the dates of its group; an open end lies behind all of them.
    first = ranked.select(*groups, F.col("piece_from").alias("_from"), F.col("_rank").alias("_a"))
    last = ranked.select(*groups, F.col("piece_from").alias("_until"), F.col("_rank").alias("_b"))
    size = ranked.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    spread = dated.join(first, [*groups, "_from"]).join(last, [*groups, "_until"], "left").join(size, groups)
    levels = lambda n: F.explode(F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int"))).alias("_size")
    sized = spread.select(*groups, "_a", F.coalesce("_b", "_n").alias("_b"), "_book", levels(F.col("_n")))
    asked = ranked.join(size, groups).select(*groups, "piece_from", "_rank", levels(F.col("_n")))
    return _best_of_slots(sized, asked, "_rank", groups)


def _winners_by_time(spans: DataFrame, dates: DataFrame, groups: list[str]) -> DataFrame:
    """Winner at every date, by slots over time itself, for groups that one task could not order.

    Time is halved again and again into aligned slots, whatever the dates.
    """
    levels = F.explode(F.sequence(F.lit(0), F.lit(TIME_BITS + 1))).alias("_size")
    until = F.coalesce(F.unix_micros("effective_until"), F.lit(END))
    sized = spans.select(*groups, F.unix_micros("effective_from").alias("_a"), until.alias("_b"), _book(), levels)
    return _best_of_slots(sized, dates.select(*groups, "piece_from", levels), "piece_from", groups)


def _best_of_slots(sized: DataFrame, asked: DataFrame, place: str, groups: list[str]) -> DataFrame:
    """Best book at every place without comparing places and books in pairs.

    A book [_a, _b) is written to the few largest aligned slots that make it up, each slot
    keeps its best book, and a place asks the one slot per size that contains it.
    """
    # First slot inside the interval, and first slot behind it; slots before 1970 have negative numbers.
    inside = F.expr("shiftright(_a + shiftleft(1L, _size) - 1, _size)")
    behind = F.expr("shiftright(_b, _size)")
    slots = sized.withColumns({"_i": inside, "_j": behind}).filter("_i < _j")
    slots = slots.withColumn(
        "_slot", F.explode(F.expr("array_compact(array(IF(pmod(_i, 2) = 1, _i, NULL), IF(pmod(_j, 2) = 1, _j - 1, NULL)))"))
    )
    best = slots.groupBy(*groups, "_size", "_slot").agg(F.min("_book").alias("_book"))
    answers = asked.withColumn("_slot", F.expr(f"shiftright({place}, _size)")).join(best, [*groups, "_size", "_slot"])
    return answers.groupBy(*groups, "piece_from").agg(F.min("_book").alias("_book"))


def _book() -> Column:
    """A book as it is compared: later starts first, then smaller ids."""
    return F.struct((-F.unix_micros("effective_from")).alias("rank"), "price_book_id", "version").alias("_book")


def _spans(books: DataFrame, keys: Sequence[str]) -> DataFrame:
    valid = F.col("effective_until").isNull() | (F.col("effective_until") > F.col("effective_from"))
    return books.filter(valid).select(*keys, "price_book_id", "version", "effective_from", "effective_until")


def _few_steps(rules: DataFrame, limit: int) -> bool:
    """Whether there are at most ``limit`` price steps, of bounded size in all.

    A rule has up to its tiers plus two, each with the tiers below it in its trail.
    """
    steps = F.coalesce(F.size("tiers"), F.lit(0)) + 2
    sizes = rules.agg(F.sum(steps).alias("rows"), F.sum(steps.cast("long") * (STEP_BYTES + TIER_BYTES * steps)).alias("bytes")).first()
    return (sizes["rows"] or 0) <= limit and (sizes["bytes"] or 0) <= settings.BROADCAST_BYTES


def attach_book(
    facts: DataFrame,
    books: DataFrame,
    date: str,
    row_id: Sequence[str],
    keys: Sequence[str] = (),
    broadcast_rows: int = settings.BROADCAST_ROWS,
    rows_per_task: int = settings.ROWS_PER_TASK,
) -> DataFrame:
    """Add price_book_id and price_version valid at ``date``; null where none is.

    The last piece that begins at or before the date answers.  Where their number is
    checked to be small, pieces are sent to all tasks as one short sorted array per group,
    and every fact searches its array by halving; otherwise facts and pieces are put in
    order together and each piece is carried forward, in parts where a group is too large
    for one task.
    """
    keys = list(keys)
    most, pieces = _list_sizes(books, keys)
    if most > GROUP_BOOKS:
        return _carry_book(facts, disjoint_pieces(books, keys, rows_per_task), date, row_id, keys or [ALL], rows_per_task)
    listed = listed_pieces(books, keys)
    if not keys:
        found = facts.withColumn("_pieces", listed.select("_pieces").scalar())
    else:
        small = pieces <= min(broadcast_rows, settings.BROADCAST_BYTES // PIECE_BYTES)
        found = keyed_join(facts, listed, keys, row_id, "left", None, broadcast_rows, rows_per_task, small)
    return _search_book(found, date).select(*facts.columns, "price_book_id", "price_version")


def _list_sizes(books: DataFrame, keys: list[str]) -> tuple[int, int]:
    """(books of the largest group, bound on all pieces); a book makes two pieces at most."""
    sizes = books.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return sizes["most"] or 0, 2 * (sizes["all"] or 0)


def _search_book(found: DataFrame, date: str) -> DataFrame:
    """The last of the sorted ``_pieces`` that begins at or before the date."""
    piece = search("_pieces", "piece_from", F.unix_micros(F.col(date).cast("timestamp")), SEARCH_BITS)
    # A struct, so that the search is done once for both columns.
    found = found.withColumn("_piece", piece)
    return found.select("*", F.col("_piece.price_book_id").alias("price_book_id"), F.col("_piece.price_version").alias("price_version"))


def search(pieces: str, start: str, when: Column, bits: int) -> Column:
    """The last entry of a sorted array (of less than 2**(bits + 1)) whose ``start`` is at or before ``when``, by halving."""

    def later(count: Column, step: Column) -> Column:
        """Number of entries known to begin at or before it, after one more halving."""
        reached = (count + step <= F.size(pieces)) & (F.get(pieces, count + step - 1)[start] <= when)
        return F.when(reached, count + step).otherwise(count)

    steps = F.array(*[F.lit(1 << bit) for bit in range(bits, -1, -1)])
    count = F.aggregate(F.filter(steps, lambda s: s <= F.size(pieces)), F.lit(0), later)
    return F.when(F.col(pieces).isNotNull(), F.get(pieces, count - 1))


def _carry_book(facts: DataFrame, pieces: DataFrame, date: str, row_id: Sequence[str], groups: list[str], rows_per_task: int) -> DataFrame:
    dated = facts if ALL not in groups else facts.withColumn(ALL, F.lit(1))
    dated = dated.withColumn("_when", F.unix_micros(F.col(date).cast("timestamp")))
    begun = pieces.select(*groups, F.col("piece_from").alias("_when"), F.struct("price_book_id", "price_version").alias("_piece"))
    both = dated.unionByName(begun, allowMissingColumns=True).withColumn("_fact", F.col("_piece").isNull())
    # Backwards in time, so that the piece of a fact is the first one that follows; facts come before pieces of their time.
    order = [F.col("_when").desc_nulls_last(), F.col("_fact").desc(), *[F.col(c) for c in row_id]]
    split = not groups_fit(both, groups, rows_per_task)
    carried = neighbours(both, groups, order, following={"_found": "_piece"}, split=split)
    found = F.when(F.col("_when").isNotNull(), F.col("_found"))
    return carried.filter("_fact").select(*facts.columns, found["price_book_id"].alias("price_book_id"), found["price_version"].alias("price_version"))


def price_steps(
    rules: DataFrame,
    price_scale: int = 2,
    flat_mode: str = "once",
    committed_mode: str = "per_unit",
    trail: bool = True,
) -> DataFrame:
    """Rules as quantity ranges with a closed charge formula.

    Every model becomes rows (quantity_from, quantity_to] with
    charge = base + round(step_price * (quantity - step_start)) + step_fee, where
    ``base`` is what the full lower tiers cost.  Rating is then one lookup and one
    multiplication per row, whatever the number of tiers.  Steps come from the tier
    array of their own rule, without a shuffle.

    ``price_scale``     decimals kept of a unit price (2, or 6 for unrounded prices)
    ``flat_mode``       'once' charges the price once, 'per_unit' per unit
    ``committed_mode``  'per_unit', or 'overage' for first tier then overage price
    ``trail``           also give the lower tiers as text and records
    """
    if flat_mode not in ("once", "per_unit") or committed_mode not in ("per_unit", "overage"):
        raise ValueError("unknown flat_mode or committed_mode")
    single = ["flat", "per_unit"] + (["committed"] if committed_mode == "per_unit" else [])
    graduated = ["tiered"] + (["committed"] if committed_mode == "overage" else [])
    price = f"decimal({6 + price_scale},{price_scale})"
    steps = f"""CASE
        WHEN pricing_model IN {_in(single)} THEN array({_single_step(price, flat_mode)})
        WHEN pricing_model = 'volume' THEN {_volume_steps(price)}
        WHEN pricing_model IN {_in(graduated)} THEN {_graduated_steps(price, trail)} END"""
    return (
        rules.selectExpr(*RULE_COLUMNS, "coalesce(tiers, array()) AS tiers")
        # Tiers after the first one without a limit are never reached.
        .withColumn("_open", F.expr("array_position(transform(tiers, t -> t.upTo IS NULL), true)"))
        .withColumn("tiers", F.expr("CASE WHEN _open > 0 THEN slice(tiers, 1, CAST(_open AS INT)) ELSE tiers END"))
        .withColumn("_used_up", F.expr(_used_up(price)))
        .withColumn("_roomy", F.expr("filter(_used_up, u -> u.units IS NULL OR u.units > 0)"))
        # Rules that cannot be applied keep one row without amounts.
        .withColumn("_steps", F.expr(steps))
        .withColumn("_step", F.expr(f"explode(CASE WHEN size(_steps) > 0 THEN _steps ELSE array({_step()}) END)"))
        .select(*RULE_KEYS, "_step.*")
        .drop(*([] if trail else ["lower_formula", "lower_tiers"]))
    )


RULE_KEYS = ["rule_id", "price_book_id", "metric_type", "pricing_model", "rule_unit", "unit_price"]
RULE_COLUMNS = [
    "rule_id",
    "price_book_id",
    "metric_type",
    "pricing_model",
    "unit AS rule_unit",
    "CAST(coalesce(get(tiers, 0).unitPrice, 0) AS decimal(12,6)) AS unit_price",
]


def _in(names: list[str]) -> str:
    return "(" + ", ".join(f"'{name}'" for name in names) + ")"


def _step(**given: str) -> str:
    """One price step as SQL; fields not given are null."""
    fields = [f"'{name}', CAST({given.get(name, 'NULL')} AS {kind})" for name, kind in STEP_FIELDS.items()]
    return f"named_struct({', '.join(fields)})"


def _single_step(price: str, flat_mode: str) -> str:
    """First price for all units, or once."""
    once = f"(pricing_model = 'flat' AND {str(flat_mode == 'once').lower()})"
    return _step(
        step_start="0",
        base=f"CASE WHEN {once} THEN CAST(unit_price AS {price}) ELSE 0 END",
        step_price=f"CASE WHEN {once} THEN 0 ELSE CAST(unit_price AS {price}) END",
        step_fee="0",
        tier="1",
        tier_price="unit_price",
    )


def _volume_steps(price: str) -> str:
    """A tier prices all units when it is the first whose limit holds the quantity."""

    def step(tier: str, position: str, end: str) -> str:
        return _step(
            quantity_from=f"array_max(transform(slice(tiers, 1, {position}), e -> e.upTo))",
            quantity_to=end,
            step_start="0",
            base="0",
            step_price=f"CAST({tier}.unitPrice AS {price})",
            step_fee=f"coalesce({tier}.flatFee, 0)",
            tier=f"least({position} + 1, size(tiers))",
            tier_price=f"{tier}.unitPrice",
        )

    reached = f"""filter(transform(tiers, (t, i) -> {step('t', 'i', 't.upTo')}),
        s -> s.quantity_from IS NULL OR s.quantity_to IS NULL OR s.quantity_to > s.quantity_from)"""
    # Above every limit the last tier applies.
    last = "element_at(tiers, -1)"
    above = f"CASE WHEN {last}.upTo IS NULL THEN array() ELSE array({step(last, 'size(tiers)', 'NULL')}) END"
    return f"CASE WHEN size(tiers) = 0 THEN array() ELSE concat({reached}, {above}) END"


def _used_up(price: str) -> str:
    """What every tier costs when used up to its limit; no units where it has none."""
    room = "CAST(t.upTo - coalesce(get(tiers, i - 1).upTo, 0) AS decimal(20,6))"
    fee = "CAST(coalesce(t.flatFee, 0) AS decimal(12,2))"
    charge = f"CAST(CAST(CAST(t.unitPrice AS {price}) * {room} AS decimal(18,2)) + {fee} AS decimal(18,2))"
    return f"""transform(tiers, (t, i) -> named_struct('tier', i + 1, 'units', {room},
        'unitPrice', CAST(t.unitPrice AS decimal(12,6)), 'flatFee', {fee}, 'charge', {charge}))"""


def _total(rows: str, field: str, kind: str) -> str:
    return f"aggregate({rows}, CAST(0 AS {kind}), (total, u) -> CAST(total + u.{field} AS {kind}))"


def _formula(rows: str) -> str:
    def number(field: str) -> str:
        return f"regexp_replace(CAST(u.{field} AS string), '[.]?0+$', '')"

    text = f"concat('(', {number('unitPrice')}, ' × ', {number('units')}, ' + ', {number('flatFee')}, ')')"
    return f"array_join(transform({rows}, u -> {text}), ' + ')"


def _graduated_steps(price: str, trail: bool) -> str:
    """Each tier prices the units between its limit and the one before it.

    Tiers are taken in stored order.  One without room (limit not above the limit
    before it) is skipped, except that quantity 0 always falls into the first tier.
    Units above the last limit stay unpriced.
    """

    def explained(rows: str) -> dict[str, str]:
        return {"lower_formula": _formula(rows), "lower_tiers": rows} if trail else {}

    lower = "slice(_roomy, 1, i)"
    start = _total(lower, "units", "decimal(20,6)")
    within = _step(
        quantity_from=f"CASE WHEN u.tier > 1 THEN {start} END",
        quantity_to=f"{start} + u.units",
        step_start=start,
        base=_total(lower, "charge", "decimal(18,2)"),
        step_price=f"CAST(u.unitPrice AS {price})",
        step_fee="u.flatFee",
        tier="u.tier",
        tier_price="u.unitPrice",
        **explained(lower),
    )
    end = _total("_roomy", "units", "decimal(20,6)")
    beyond = _step(
        quantity_from=f"CASE WHEN size(tiers) > 0 THEN {end} END",
        step_start=end,
        base=_total("_roomy", "charge", "decimal(18,2)"),
        step_price="0",
        step_fee="0",
        tier_price="0",
        **explained("_roomy"),
    )
    zero_quantity = _step(
        quantity_to="0",
        step_start="0",
        base="0",
        step_price=f"CAST(_used_up[0].unitPrice AS {price})",
        step_fee="_used_up[0].flatFee",
        tier="1",
        tier_price="_used_up[0].unitPrice",
        **({"lower_formula": "''", "lower_tiers": "array()"} if trail else {}),
    )
    return f"""concat(
        transform(_roomy, (u, i) -> {within}),
        CASE WHEN exists(tiers, t -> t.upTo IS NULL) THEN array() ELSE array({beyond}) END,
        CASE WHEN coalesce(get(_used_up, 0).units <= 0, false) THEN array({zero_quantity}) ELSE array() END)"""


def books_newest_first(books: DataFrame) -> DataFrame:
    return books.orderBy(F.col("effective_from").desc_nulls_first(), "price_book_id")


def rules_of_book(rules: DataFrame, price_book_id) -> DataFrame:
    return rules.filter(F.col("price_book_id") == price_book_id)


def rules_per_book(books: DataFrame, rules: DataFrame) -> DataFrame:
    """Number of rules of every book, 0 included."""
    counts = rules.groupBy("price_book_id").agg(F.count("rule_id").alias("rule_count"))
    return books.select("price_book_id", "name").join(counts, "price_book_id", "left").withColumn(
        "rule_count", F.coalesce("rule_count", F.lit(0))
    )


def version_problems(books: DataFrame, family: str = "parent_id", split: bool | None = None) -> DataFrame:
    """Versions of a family that are inverted, leave a gap or overlap the next one."""
    ordered = neighbours(
        books,
        [family],
        [F.col("effective_from").asc(), F.col("price_book_id").asc()],
        next_row={"next_from": "effective_from"},
        split=split,
    )
    problem = (
        F.when(F.col("effective_until").isNotNull() & (F.col("effective_from") >= F.col("effective_until")), "INVERTED")
        .when(F.col("next_from").isNull(), None)
        .when(F.col("effective_until").isNull() | (F.col("effective_until") > F.col("next_from")), "OVERLAP")
        .when(F.col("effective_until") < F.col("next_from"), "GAP")
    )
    return ordered.withColumn("problem", problem).filter(F.col("problem").isNotNull())


def add_versions(books: DataFrame, new: DataFrame, as_of, family: str = "parent_id") -> tuple[DataFrame, DataFrame]:
    """(books with accepted versions, refused versions with reason).

    At most one new version per family and call.  A new version may not start in the
    past, must start after the current one, and must meet a current version that
    already has an end.  Accepting it closes the open version at its start.
    """
    current = (
        books.groupBy(family)
        .agg(F.max(F.struct("effective_from", "price_book_id", "effective_until")).alias("_current"))
    )
    judged = new.join(current, family, "left").withColumn(
        "reason",
        F.when(F.col("effective_from") < V.moment(as_of), "IN_THE_PAST")
        .when(F.col("effective_from") <= F.col("_current.effective_from"), "NOT_AFTER_CURRENT")
        .when(
            F.col("_current.effective_until").isNotNull()
            & (F.col("_current.effective_until") != F.col("effective_from")),
            "GAP_OR_OVERLAP",
        ),
    )
    accepted = judged.filter(F.col("reason").isNull()).drop("_current", "reason")
    closing = accepted.select(family, F.col("effective_from").alias("_closes_at"))
    closed = (
        keyed_join(books, closing, [family], ["price_book_id"])
        .withColumn("effective_until", F.coalesce("effective_until", "_closes_at"))
        .drop("_closes_at")
    )
    return closed.unionByName(accepted), judged.filter(F.col("reason").isNotNull()).drop("_current")


def uncovered_dates(books: DataFrame, dates: DataFrame, date: str = "day") -> DataFrame:
    """Dates on which no book is in force."""
    return effective_book(books, dates, date).filter(F.col("price_book_id").isNull()).select(date)


def date_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    """All days of a range, as the start of each day."""
    return spark.sql(f"SELECT explode(sequence(TIMESTAMP '{first}', TIMESTAMP '{last}', INTERVAL 1 DAY)) AS day")
