"""Values, names and times taken from events and customers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark import settings

DAY_MICROS = 86_400_000_000
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def moment(value) -> Column:
    """A processing time given as Column, datetime or text."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp")


def before(when, span: str) -> Column:
    return moment(when) - F.expr(f"interval {span}")


def window_start(event_time, size: str = settings.WINDOW_SIZE) -> Column:
    return F.window(_col(event_time), size)["start"]


def _utc_parts(ts) -> tuple[Column, Column]:
    """Date and microsecond of the day in UTC, whatever the session's time zone."""
    micros = F.unix_micros(_col(ts).cast("timestamp"))
    of_day = F.pmod(micros, F.lit(DAY_MICROS))
    days = ((micros - of_day) / DAY_MICROS).cast("int")
    return F.date_from_unix_date(days), of_day


def _clock(of_day: Column) -> Column:
    """hh:mm:ss of a microsecond of the day."""
    seconds = F.floor(of_day / 1_000_000).cast("int")
    parts = [F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60]
    return F.concat_ws(":", *[F.lpad(p.cast("int").cast("string"), 2, "0") for p in parts])


def iso(ts) -> Column:
    """UTC time to the millisecond, as 2024-01-15T14:23:45.000Z."""
    day, of_day = _utc_parts(ts)
    millis = F.lpad((F.floor(of_day / 1000) % 1000).cast("int").cast("string"), 3, "0")
    return F.concat(day.cast("string"), F.lit("T"), _clock(of_day), F.lit("."), millis, F.lit("Z"))


def utc_text(ts) -> Column:
    """UTC time as text, fractions only where there are any; for ids."""
    day, of_day = _utc_parts(ts)
    fraction = F.lpad((of_day % 1_000_000).cast("string"), 6, "0")
    ended = F.regexp_replace(F.concat(F.lit("."), fraction), "[.]?0+$", "")
    return F.concat(day.cast("string"), F.lit(" "), _clock(of_day), ended)


def parse_iso(text) -> Column:
    """Timestamp from ISO-8601 text; null when it is malformed.

    The pattern also keeps out words such as 'now', which a cast would accept.
    Without a zone it is UTC.
    """
    text = _col(text)
    zone = F.when(text.rlike(r"T.*(Z|[+-]\d{2}:?\d{2})$"), "").when(text.contains("T"), "Z").otherwise("T00:00:00Z")
    return F.when(text.rlike(ISO_PATTERN), F.concat(F.regexp_replace(text, ",", "."), zone).try_cast("timestamp"))


def month_key(ts) -> Column:
    """UTC month, as 2024-01."""
    return F.substring(_utc_parts(ts)[0].cast("string"), 1, 7)


# Slots of time from short to long; the last one holds everything.
SLOTS = ["hour", "day", "week", "month", "quarter", "year", "decade", "ever"]


def slot(ts, unit: str) -> Column:
    """Number of the UTC slot of time that holds ``ts``; neighbouring slots have neighbouring numbers."""
    if unit == "ever":
        return F.lit(0).cast("bigint")
    micros = F.unix_micros(_col(ts).cast("timestamp"))
    if unit == "hour":
        return F.floor(micros / 3_600_000_000)
    day, _ = _utc_parts(ts)
    if unit in ("day", "week"):
        return F.floor(F.unix_date(day) / (1 if unit == "day" else 7))
    months = F.year(day).cast("bigint") * 12 + F.month(day) - 1
    return F.floor(months / {"month": 1, "quarter": 3, "year": 12, "decade": 120}[unit])


def strategy(metric) -> Column:
    """'sum', 'max' or 'count'."""
    metric = _col(metric)
    return (
        F.when(metric.isin(settings.SUM_METRICS), "sum")
        .when(metric.isin(settings.MAX_METRICS), "max")
        .otherwise("count")
    )


def unit_of(metric) -> Column:
    return _lookup(_col(metric), settings.UNITS, settings.DEFAULT_UNIT)


def on_time_value(metadata, metric=None) -> Column:
    """Value an on-time event adds to its window; null means it cannot be used.

    A missing, null, empty, false or numerically zero value counts as 1, while the
    text "0" stays 0.  Metrics that only count never look at the value.
    """
    return parsed_value(F.try_parse_json(_col(metadata)), metric)


def parsed_value(parsed: Column, metric=None) -> Column:
    """The same of metadata parsed into a variant."""
    found = F.try_variant_get(parsed, "$.value", "variant")
    kind = F.schema_of_variant(found)
    text = F.try_variant_get(parsed, "$.value", "string")
    number = F.try_variant_get(parsed, "$.value", "decimal(20,6)")
    is_text = kind == "STRING"
    is_flag = kind == "BOOLEAN"
    falsy = (
        kind.isNull()
        | (kind == "VOID")
        | (is_text & (text == ""))
        | (is_flag & (text == "false"))
        | (~is_text & ~is_flag & (F.try_variant_get(parsed, "$.value", "double") == 0))
    )
    value = F.when(falsy, F.lit(1).cast("decimal(20,6)")).when(is_flag, None).otherwise(number)
    if metric is None:
        return value
    return F.when(strategy(metric) == "count", F.lit(1).cast("decimal(20,6)")).otherwise(value)


def late_value(metadata) -> Column:
    """Value of a late event: 1 only when absent or null; null when it is not a number."""
    text = F.coalesce(F.get_json_object(_col(metadata), "$.value"), F.lit("1"))
    return text.try_cast("decimal(20,6)")


def metric_title(metric) -> Column:
    """storage_gb_hours -> Storage Gb Hours; letters after the first are kept."""
    words = F.transform(
        F.split(_col(metric), "_"),
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2))),
    )
    return F.array_join(words, " ")


def usage_description(metric) -> Column:
    return F.concat(metric_title(metric), F.lit(" usage"))


def tax_region(metadata) -> Column:
    return F.coalesce(F.get_json_object(_col(metadata), "$.taxRegion"), F.lit(settings.DEFAULT_TAX_REGION))


def tax_rate(region) -> Column:
    region = F.coalesce(_col(region), F.lit(settings.DEFAULT_TAX_REGION))
    return _lookup(region, settings.TAX_RATES, settings.DEFAULT_TAX_RATE).cast("decimal(5,2)")


def exchange_rate(currency) -> Column:
    return _lookup(_col(currency), settings.EXCHANGE_RATES, settings.DEFAULT_EXCHANGE_RATE).cast("decimal(9,2)")


def percentage(rate) -> Column:
    """0.19 -> '19'."""
    return (_col(rate) * 100).cast("decimal(5,0)").cast("string")


def stable_id(*columns) -> Column:
    """Same key columns, same id: reruns do not create new rows.

    Times go in as ``utc_text``, so that the id does not depend on the session.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def invoice_number(kind, invoice_id) -> Column:
    prefix = F.when(_col(kind) == "correction", "CORR-").otherwise("INV-")
    return F.concat(prefix, F.substring(_col(invoice_id), 1, 32))


def _lookup(key: Column, table: dict[str, str], default: str) -> Column:
    """A fixed table as one CASE expression: no join, no shuffle."""
    items = iter(table.items())
    name, value = next(items)
    out = F.when(key == name, value)
    for name, value in items:
        out = out.when(key == name, value)
    return out.otherwise(default)


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
