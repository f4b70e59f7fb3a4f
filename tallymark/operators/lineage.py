"""From an invoice back to its events, and along chains of corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallymark.operators.analytics import first_rows
from tallymark.operators.skew import keyed_join
from tallymark.session import materialise

#: Invoices of a chain that the driver keeps.
FRONT = 1000


def charge_events(
    charges: DataFrame,
    window_events: DataFrame,
    single_events: DataFrame,
    usage: DataFrame | None = None,
    **limits,
) -> DataFrame:
    """(charge_id, subtotal, event_id, event_time, metric_type): events behind charges.

    ``window_events`` says which window counted an event (``usage_events`` carrying
    event_time and metric_type).  Late charges name their event themselves; it is
    looked up in ``single_events``, the late events.  A window with very many events
    is spread over several tasks; ``usage`` gives the counts when it is at hand.
    """
    counts = None if usage is None else usage.select("aggregation_id", F.col("event_count").alias("n"))
    details = ["event_id", "event_time", "metric_type"]
    windows = charges.filter(F.col("aggregation_id").isNotNull()).select("aggregation_id", "charge_id", "subtotal")
    through_windows = keyed_join(
        window_events.select("aggregation_id", *details),
        windows,
        ["aggregation_id"],
        ["event_id"],
        "inner",
        small=False,
        counts=counts,
        **limits,
    )
    id_type = single_events.schema["event_id"].dataType
    named = charges.filter(F.col("source_event_id").isNotNull()).select(
        "charge_id", "subtotal", F.col("source_event_id").cast(id_type).alias("event_id")
    )
    direct = named.join(single_events.select(*details), "event_id")
    columns = ["charge_id", "subtotal", *details]
    return through_windows.select(*columns).unionByName(direct.select(*columns))


def line_events(line_items: DataFrame, line_charges: DataFrame, traced: DataFrame, **limits) -> DataFrame:
    """Invoice lines with the events behind them; ``traced`` is from ``charge_events``.

    Line names are joined to the charges first, so that the long event side is
    joined once, on the charge.
    """
    named = line_items.select("line_item_id", "invoice_id", "description", "amount")
    # One row a line, also where lines come twice.
    counts = line_items.groupBy("line_item_id").agg(F.max("charge_count").alias("n")) if "charge_count" in line_items.columns else None
    placed = keyed_join(line_charges, named, ["line_item_id"], ["charge_id"], "inner", small=False, counts=counts, **limits)
    return keyed_join(traced, placed, ["charge_id"], ["event_id"], "inner", small=False, **limits)


def explain_charges(charges: DataFrame, books: DataFrame, traced: DataFrame, sample: int = 3) -> DataFrame:
    """Why a charge is what it is: price book, trail, event count and a few events."""
    counted = traced.groupBy("charge_id").agg(
        F.count(F.lit(1)).alias("source_event_count"),
        F.min("event_time").alias("first_event_at"),
        F.max("event_time").alias("last_event_at"),
    )
    few = first_rows(traced.select("charge_id", "event_time", "event_id"), ["charge_id"], ["event_time", "event_id"], sample)
    samples = few.groupBy("charge_id").agg(
        F.array_sort(F.collect_list(F.struct("event_time", "event_id"))).alias("source_event_sample")
    )
    named = books.select("price_book_id", F.col("name").alias("price_book_name"))
    return (
        charges.join(named, "price_book_id", "left")
        .join(counted, "charge_id", "left")
        .join(samples, "charge_id", "left")
    )


def correction_chains(invoices: DataFrame) -> DataFrame:
    """(invoice_id, root_invoice_id, depth) for every invoice.

    Each round every invoice jumps to the ancestor of its ancestor, so a chain of n
    corrections takes log2(n) rounds, and each round is cut off by a checkpoint.  An
    invoice that still has an ancestor after more steps than there are references goes
    back to a cycle: it has neither root nor depth.
    """
    ids = invoices.select("invoice_id", "reference_invoice_id")
    links = ids.select("invoice_id", F.col("reference_invoice_id").alias("ancestor"), F.lit(1).cast("bigint").alias("steps"))
    links = links.filter(F.col("ancestor").isNotNull())
    # A reference to an unknown invoice starts a chain of its own.
    links = materialise(links.join(ids.select(F.col("invoice_id").alias("ancestor")), "ancestor", "left_semi"))
    cyclic = None
    for _ in range(links.count().bit_length() + 1):
        above = links.select(
            F.col("invoice_id").alias("ancestor"), F.col("ancestor").alias("_next"), F.col("steps").alias("_more")
        )
        jumped = materialise(
            keyed_join(links, above, ["ancestor"], ["invoice_id"]).select(
                "invoice_id",
                F.coalesce("_next", "ancestor").alias("ancestor"),
                (F.col("steps") + F.coalesce("_more", F.lit(0))).alias("steps"),
                F.col("_next").isNotNull().alias("_moved"),
            )
        )
        links = jumped.drop("_moved")
        if jumped.filter("_moved").isEmpty():
            break
        cyclic = jumped
    else:
        links = cyclic
    rooted = ~F.coalesce("_moved", F.lit(False)) if "_moved" in links.columns else F.lit(True)
    return ids.select("invoice_id").join(links, "invoice_id", "left").select(
        "invoice_id",
        F.when(rooted, F.coalesce("ancestor", "invoice_id")).alias("root_invoice_id"),
        F.when(rooted, F.coalesce("steps", F.lit(0))).alias("depth"),
    )


def extend_chains(stored: DataFrame, new: DataFrame) -> DataFrame:
    """(invoice_id, root_invoice_id, depth) of new invoices, by the stored rows of earlier ones.

    The work is that of the new invoices: chains among them are found as in
    ``correction_chains``, and only the first of each is looked up in what is stored.  An
    invoice whose predecessor comes after it starts a chain of its own, so invoices are to be
    given in batches that hold a predecessor no later than its successors.
    """
    own = correction_chains(new).withColumnsRenamed({"root_invoice_id": "_first", "depth": "_deeper"})
    firsts = new.select(F.col("invoice_id").alias("_first"), F.col("reference_invoice_id").alias("_before"))
    firsts = own.join(firsts, "_first", "left")
    above = stored.select(F.col("invoice_id").alias("_before"), "root_invoice_id", "depth")
    # Many corrections may go back to one invoice.
    asked = firsts.select("_before").filter(F.col("_before").isNotNull()).distinct()
    found = keyed_join(firsts, above.join(asked, "_before", "left_semi"), ["_before"], ["invoice_id"])
    return found.select(
        "invoice_id",
        F.coalesce("root_invoice_id", "_first").alias("root_invoice_id"),
        (F.col("_deeper") + F.coalesce(F.col("depth") + 1, F.lit(0))).alias("depth"),
    )


def corrections_of(invoices: DataFrame, invoice_id) -> DataFrame:
    """One invoice and all corrections that go back to it, with their depth below it.

    Goes down level by level: each step reads the references of the table and keeps those to
    the invoices found last, so there are as many steps as the chain has levels.  An invoice is
    found once, also in a cycle.
    """
    links = invoices.select("invoice_id", "reference_invoice_id")
    kind = invoices.schema["invoice_id"].dataType
    depths = {r.invoice_id: 0 for r in links.filter(F.col("invoice_id") == invoice_id).limit(1).collect()}
    front, depth = list(depths), 0
    # As long as few are found, their ids are given to the scan itself.
    while front and len(depths) <= FRONT:
        depth += 1
        below = links.filter(F.col("reference_invoice_id").isin([F.lit(i).cast(kind) for i in front]))
        front = [r.invoice_id for r in below.select("invoice_id").limit(FRONT + 1).collect()]
        if len(front) > FRONT:
            depth -= 1
            break
        front = [i for i in dict.fromkeys(front) if i not in depths]
        depths |= dict.fromkeys(front, depth)
    found = invoices.sparkSession.createDataFrame(list(depths.items()), StructType([StructField("invoice_id", kind), StructField("depth", LongType())]))
    if front:
        found = _further(links, found, depth)
    return invoices.join(found, "invoice_id").orderBy("depth", "invoice_id")


def _further(links: DataFrame, found: DataFrame, depth: int) -> DataFrame:
    """The levels below ``depth``, where a chain is too wide for the driver."""
    front = found.filter(F.col("depth") == depth).select("invoice_id")
    while not front.isEmpty():
        depth += 1
        below = links.join(front.select(F.col("invoice_id").alias("reference_invoice_id")), "reference_invoice_id", "left_semi")
        front = materialise(below.select("invoice_id").distinct().join(found, "invoice_id", "left_anti"))
        found = found.unionByName(front.withColumn("depth", F.lit(depth).cast("bigint")))
    return found
