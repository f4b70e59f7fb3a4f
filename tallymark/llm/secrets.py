"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary words.

Everything runs on built-in functions.  A regular expression gives the matches of a text
(``regexp_extract_all``) and the text between them (``split``); their lengths, summed
along the text, give each match's place in code points.

The models are first-order character chains.  Random strings are labelled by the fixed
patterns: what stands after an assignment, access keys, hex runs, of all documents.  Ordinary
identifiers come from a bounded sample of different texts (TRAIN_DOCS, smallest hashes),
outside the fixed patterns' spans: short words and numbers as they stand; three words in a
row joined the way identifiers are (IDENTIFIERS of them: with ``_``, ``-``, ``/``, in camel
case or capitals, with numbers, as dates); and tokens of the scored length that three or
more different texts hold.  So one secret, however often copied, teaches nothing.

A token outside the fixed patterns' spans is a secret if the mean log-likelihood ratio per
character is above the limit.  That lies a quarter of the way (NEAR) from the upper scores
of the identifiers to the lower ones of the labelled strings that mix letters and digits,
and is never below LEAST.  UUIDs are identifiers by policy, not secrets.  Only transition counts, at most
two per pair of characters of the token alphabet, and the hashes of the sample reach the
driver.

Defined cases: a null text is empty and has no spans.  Equal texts are scanned once, so
copies and repeated rows get equal spans.  Without labelled strings a model gives all
characters equal shares.  A character said over and over is filler, not a secret.  Spans of
different kinds may overlap; redaction masks their union.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import col, free_name

# Patterns by kind, and the length from which a match (an assignment's value) counts.
KINDS = ["assign", "access", "hex", "random"]
PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{16,}",
    "random": r"[A-Za-z0-9+/_=-]{12,}",
}
LENGTHS = {"assign": 12, "access": 18, "hex": 16, "random": 12}
BASE_KINDS = KINDS[:3]

#: Different texts, and joined words of them, that ordinary identifiers are learnt from.
TRAIN_DOCS, IDENTIFIERS = 2000, 20_000
#: A token of a secret's length is ordinary if so many different texts of the sample hold it.
RECURRING = 3
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
#: Whole tokens of 8 to 11 characters: words, also joined ones, and numbers or dates.
_WORDS = r"(?<![A-Za-z0-9+/_=-])(?:[A-Za-z][A-Za-z/_-]{7,10}|[0-9][0-9+/_=-]{7,10})(?![A-Za-z0-9+/_=-])"
_VALUES = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}"""
#: Whole words, for joining.
_PLAIN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z]{2,11}(?![A-Za-z0-9+/_=-])"
_BASE = r"AKIA[A-Z0-9]+|[0-9a-f]{16,}"
_UUID = r"(?i)(^|[=/])[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
#: Least score per character, in nats, whatever the samples say.
LEAST = 0.75
MASK = "[SECRET]"
#: Weight of the fall-back shares, in characters, and the largest ratio of a pair, in nats.
BACKOFF, MOST = 5.0, 4.0
#: Share of repeated characters in ordinary strings, whatever the words say.
REPEAT = 0.02
#: Shares of the random strings below, and of the words above, the scores that the limit lies between.
LOW, HIGH = 0.1, 0.001
#: Where between them it lies, from the words on: labelled strings may be of one alphabet, others are of many.
NEAR = 0.25

_SPAN = "array<struct<kind:string,nth:int,gap:int,length:int,value:string>>"


def _has(text: Column, kinds) -> Column:
    found = F.lit(False)
    for kind in kinds:
        found = found | text.rlike(PATTERNS[kind])
    return found


def _holds(text: Column, model: Model) -> Column:
    """Whether a text has a base match or a token that scores above the limit; most texts have long words alone."""
    tokens = F.regexp_extract_all(text, F.lit(PATTERNS["random"]), F.lit(0))
    return _has(text, BASE_KINDS) | F.exists(tokens, model.secret)


def _texts(docs: DataFrame, text_col: str, model: Model | None = None) -> DataFrame:
    """(key, text): each different text that may hold spans, without a model base spans, once."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    found = docs.select(text.alias("text"))
    found = found.filter(_has(F.col("text"), BASE_KINDS) if model is None else _holds(F.col("text"), model))
    return found.select(F.sha2("text", 256).alias("key"), "text").dropDuplicates(["key"])


def _listed(kind: str) -> Column:
    """The matches of a kind in order, each with the gap before it; the gap at the end has no match beside it."""
    pattern = F.lit(PATTERNS[kind])
    whole = F.regexp_extract_all("text", pattern, F.lit(0))
    value = F.regexp_extract_all("text", pattern, F.lit(2)) if kind == "assign" else whole
    zipped = F.arrays_zip(F.split("text", PATTERNS[kind], -1).alias("gap"), whole.alias("whole"), value.alias("value"))

    def span(z, nth):
        lengths = F.length(z["gap"]).alias("gap"), F.length(z["whole"]).alias("length")
        return F.struct(F.lit(kind).alias("kind"), nth.alias("nth"), *lengths, z["value"].alias("value"))

    return F.transform(zipped, span)


def _matches(texts: DataFrame, kinds) -> DataFrame:
    """(key, kind, start, end, value) of every match of the patterns, short ones included."""
    rows = [F.when(_has(F.col("text"), [kind]), _listed(kind)).otherwise(F.array().cast(_SPAN)) for kind in kinds]
    found = texts.select("key", F.explode(F.concat(*rows)).alias("m")).select("key", "m.*").filter(F.col("length").isNotNull())
    along = Window.partitionBy("key", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("length")).over(along)
    return found.withColumn("end", end).select("key", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "value")


def _long_enough(matches: DataFrame) -> DataFrame:
    least = F.lit(0)
    for kind, n in LENGTHS.items():
        least = F.when(F.col("kind") == kind, n).otherwise(least)
    return matches.filter(F.length("value") >= least)


def _code(char) -> Column:
    return F.instr(F.lit(ALPHABET), char)


@dataclass
class Model:
    """Log-likelihood ratio of each pair of characters (0 stands for none and others), and the limit."""

    ratios: list[float]
    limit: float = LEAST

    @cached_property
    def table(self) -> Column:
        """The ratios as one literal, not an expression for each."""
        return F.lit(np.array(self.ratios))

    def score(self, value: Column) -> Column:
        """Mean ratio per character of a token."""
        size, table = len(ALPHABET) + 1, self.table
        step = lambda a, ch: F.struct(
            _code(ch).alias("at"), (a["sum"] + F.element_at(table, a["at"] * size + _code(ch) + 1)).alias("sum")
        )
        start = F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("sum"))
        return F.aggregate(F.split(value, ""), start, step, lambda a: a["sum"]) / F.length(value)

    def secret(self, value: Column) -> Column:
        """Whether a token scores above the limit; without a single pair above it the mean cannot be."""
        size, name = len(ALPHABET) + 1, lambda c: c if c.isalnum() else "\\" + c
        pairs = []
        for a in range(size):
            after = [name(c) for b, c in enumerate(ALPHABET, 1) if self.ratios[a * size + b] > self.limit]
            if after:
                pairs.append((name(ALPHABET[a - 1]) if a else "^") + "[" + "".join(after) + "]")
        return value.rlike("|".join(pairs) or "(?!)") & (self.score(value) > self.limit) & ~value.rlike(_UUID)


def _transitions(values: DataFrame, kind: str) -> DataFrame:
    """(kind, a, b, n): how often character b follows a, by their codes."""
    chars = values.select(F.transform(F.split("value", ""), _code).alias("c"))
    pairs = chars.select(F.explode(F.arrays_zip(F.concat(F.array(F.lit(0)), "c").alias("a"), F.col("c").alias("b"))).alias("p"))
    pairs = pairs.select("p.a", "p.b").filter(F.col("b").isNotNull())
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "a", "b", "n")


def _smallest(df: DataFrame, place: Column, rows: int) -> DataFrame:
    """The rows with the ``rows`` smallest of their places, which differ but for chance; only numbers are put in order."""
    count = df.agg(F.approx_count_distinct(place)).first()[0]
    bound = int((1 << 30) * min(1.0, 1.5 * rows / max(1, count)))
    places = df.select(place.alias("at")).filter(F.col("at") <= bound).distinct().orderBy("at").limit(rows).collect()
    return df.filter(place <= (places[-1].at if places else -1))


def _some_texts(docs: DataFrame, text_col: str, rows: int) -> DataFrame:
    """(text): about ``rows`` different texts, however often each occurs."""
    texts = docs.select(col(text_col).cast("string").alias("text")).filter(F.col("text").isNotNull())
    return _smallest(texts, F.pmod(F.xxhash64("text"), F.lit(1 << 30)), rows).dropDuplicates(["text"])


def _ordinary(texts: DataFrame, identifiers: int = IDENTIFIERS) -> DataFrame:
    """(value) of ordinary words, numbers and identifiers; assigned values and other base matches are none."""
    plain = texts.select(F.regexp_replace(F.regexp_replace("text", _VALUES, " "), _BASE, " ").alias("text"))
    words = plain.select(F.explode(F.regexp_extract_all("text", F.lit(_WORDS), F.lit(0))).alias("value"))
    tokens = plain.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(PATTERNS["random"]), F.lit(0)))).alias("value"))
    known = tokens.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= RECURRING).select("value")
    return words.unionByName(known).unionByName(_joined(plain, identifiers))


def _joined(plain: DataFrame, rows: int) -> DataFrame:
    """(value): three words in a row of the texts, joined in one of the ways below, by their hash."""
    listed = plain.select(F.regexp_extract_all("text", F.lit(_PLAIN), F.lit(0)).alias("w")).filter(F.size("w") >= 3)
    three = F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.transform(F.slice("w", i, 3), F.lower))
    triples = listed.select(F.explode(three).alias("t"))
    triples = _smallest(triples, F.pmod(F.xxhash64("t"), F.lit(1 << 30)), rows).dropDuplicates(["t"])
    a, b, c = (F.get("t", F.lit(i)) for i in range(3))
    number = F.pmod(F.xxhash64("t", F.lit(1)), F.lit(1000)).cast("int")
    text, digit = number.cast("string"), (number % 10).cast("string")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    year = (F.pmod(F.xxhash64("t", F.lit(2)), F.lit(80)) + 1970).cast("string")
    month, day, hour = two(number % 12 + 1), two(number % 28 + 1), two(number % 24)
    ways = [
        F.concat_ws("_", a, b, c), F.upper(F.concat_ws("_", a, b, c)), F.concat_ws("_", a, b, text), F.upper(F.concat_ws("_", a, b, text)),
        F.concat(a, F.initcap(b), F.initcap(c)), F.concat(F.initcap(a), F.initcap(b), F.initcap(c)), F.concat(F.initcap(a), F.initcap(b), digit),
        F.concat(F.upper(a), F.initcap(b), F.initcap(c)), F.concat(F.upper(a), F.lit("-v"), digit, F.lit("-"), b, digit),
        F.concat_ws("-", a, b, c), F.concat(F.lit("/"), F.concat_ws("/", a, b, c)), F.concat_ws("/", a, b, F.initcap(c)), F.concat(a, F.lit("/"), b, digit, F.lit("/"), c),
        F.concat(a, b, c), F.concat(a, F.lit("="), b, text), F.concat(year, month, day, F.lit("_"), a, b),
        F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit("T"), hour), F.concat_ws("-", F.lpad(text, 3, "0"), two(number % 97), F.lpad((number * 13 % 10000).cast("string"), 4, "0"), digit),
    ]
    way = F.pmod(F.xxhash64("t", F.lit(3)), F.lit(len(ways))).cast("int") + 1
    return triples.select(F.element_at(F.array(*ways), way).alias("value")).filter(F.length("value") >= LENGTHS["random"])


def fit(docs: DataFrame, text_col: str = "text", train_docs: int = TRAIN_DOCS, identifiers: int = IDENTIFIERS) -> Model:
    """Both models from labelled strings, and the limit between their scores."""
    random = _long_enough(_matches(_texts(docs, text_col), BASE_KINDS)).select("value")
    texts = _some_texts(docs, text_col, train_docs).persist()
    words = _ordinary(texts, identifiers)
    labelled = random.withColumn("kind", F.lit("random")).unionByName(words.withColumn("kind", F.lit("word"))).persist()
    try:
        kinds = {k: labelled.filter(F.col("kind") == k) for k in ("random", "word")}
        counted = _transitions(kinds["random"], "random").unionByName(_transitions(kinds["word"], "word")).collect()
        model = Model(_ratios(counted))
        score = model.score(F.col("value"))
        mixed = kinds["random"].filter(F.col("value").rlike("[A-Za-z]") & F.col("value").rlike("[0-9]"))
        low = mixed.agg(F.percentile_approx(score, LOW, 10000)).first()[0]
        long = kinds["word"].filter(F.length("value") >= LENGTHS["random"])
        high = long.agg(F.percentile_approx(score, 1 - HIGH, 10000)).first()[0]
    finally:
        labelled.unpersist()
        texts.unpersist()
    if high is not None:
        model.limit = max(LEAST, high if low is None else high + NEAR * (low - high))
    return model


def _ratios(counted) -> list[float]:
    """Log-likelihood ratios of all pairs, bounded so that one character cannot decide alone."""
    size = len(ALPHABET) + 1
    n = {kind: [[0] * size for _ in range(size)] for kind in ("random", "word")}
    for r in counted:
        n[r["kind"]][r["a"]][r["b"]] += r["n"]
    # Words fall back on the shares of their characters, random strings on equal shares:
    # labelled secrets are of a few alphabets, others may use any.
    chars = [sum(row[b] for row in n["word"]) + 0.5 for b in range(size)]
    shares = [c / sum(chars) for c in chars]
    out = []
    for a in range(size):
        random, word = sum(n["random"][a]), sum(n["word"][a])
        for b in range(size):
            p_random = 0.5 / size + 0.5 * (n["random"][a][b] + BACKOFF / size) / (random + BACKOFF)
            p_word = (1 - REPEAT) * (n["word"][a][b] + BACKOFF * shares[b]) / (word + BACKOFF) + REPEAT * (a == b)
            out.append(round(max(-MOST, min(MOST, math.log(p_random / p_word))), 4))
    return out


def spans(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(key, spans): the spans of each different text that has any, by start, then kind as listed."""
    found = _long_enough(_matches(_texts(docs, text_col, model), KINDS))
    order = F.lit(0)
    for i, kind in enumerate(KINDS):
        order = F.when(F.col("kind") == kind, i).otherwise(order)
    found = found.withColumn("order", order)
    # Latest end of the base spans that start before, and earliest start of those after.
    base_end, base_start = (F.when(F.col("kind") != "random", F.col(c)) for c in ("end", "start"))
    place = Window.partitionBy("key").orderBy("start", "order")
    before = F.max(base_end).over(place.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(base_start).over(place.rowsBetween(1, Window.unboundedFollowing))
    alone = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    found = found.withColumn("alone", alone)
    # A token is scored only where no base span overlaps it.
    secret = F.when(F.col("kind") != "random", True).when(F.col("alone"), model.secret(F.col("value"))).otherwise(False)
    listed = F.array_sort(F.collect_list(F.struct("start", "order", "end", "kind")))
    return found.filter(secret).groupBy("key").agg(listed.alias("spans"))


def _keyed(docs: DataFrame, model: Model, text_col: str, key: str, spread: Column) -> DataFrame:
    """Rows with the key of their text; texts without any span get keys that meet nothing, spread evenly."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    return docs.withColumn(key, F.when(_holds(text, model), F.sha2(text, 256)).otherwise(F.concat(F.lit("-"), F.xxhash64(spread).cast("string"))))


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row."""
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    keyed = _keyed(rows, model, "text", "key", F.col("doc_id")).select("doc_id", "key")
    none = F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>")
    return keyed.join(spans(docs, model, text_col), "key", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def as_text(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: Model, text_col: str = "text", mask: str = MASK) -> DataFrame:
    """All rows and columns, with every span of the text replaced by ``mask``."""
    key, at = (free_name(docs.columns, n) for n in ("secret_key", "secret_spans"))
    merged = F.aggregate(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))),
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda out, s: F.when((F.size(out) > 0) & (F.element_at(out, -1)["end"] >= s["start"]), F.concat(
            F.slice(out, 1, F.size(out) - 1),
            F.array(F.struct(F.element_at(out, -1)["start"].alias("start"), F.greatest(F.element_at(out, -1)["end"], s["end"]).alias("end"))),
        )).otherwise(F.concat(out, F.array(s))),
    )
    found = spans(docs, model, text_col).select(F.col("key").alias(key), merged.alias(at))
    hashable = [col(name) for name, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    keyed = _keyed(docs, model, text_col, key, F.struct(*hashable))
    text, places = col(text_col), F.col(at)
    # Each span with the text before it, then the rest.
    pieces = F.transform(
        F.sequence(F.lit(1), F.size(places)),
        lambda i: F.concat(_between(text, F.when(i > 1, F.get(places, i - 2)["end"]).otherwise(F.lit(0)), F.get(places, i - 1)["start"]), F.lit(mask)),
    )
    rest = _between(text, F.element_at(places, -1)["end"], F.length(text))
    joined = keyed.join(found, key, "left")
    masked = joined.withColumn(text_col, F.when(places.isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), rest)))
    return masked.select([col(c) for c in docs.columns])


def _between(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))
