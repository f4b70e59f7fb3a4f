"""URL filters: path rules, then naive Bayes over segmented host names and path tokens.

Host labels are cut into words by a unigram model: the counts are those of the words in
all page texts, and the best split (Viterbi) maximises the product of the word
probabilities; an unknown piece costs ten times more for each further letter.  Every
count of a word that is found is one more, and a seed word has a prior share besides
(SEED_SHARE), whether pages write it or not.  With that share a seed of six letters or more is found
beside unknown letters, and a shorter one beside words that pages write: ``winporn`` is cut,
``adulthood`` and ``downloads`` are not.  Counts are joined to the pieces of host labels,
of the lengths that words have, so no task holds the vocabulary.

The classifier is trained on all pages.  No table says which pages are unwanted, so pages
whose host holds one of the seed words stand for what to block, all others for what to
allow; a caller who knows better passes a table of labelled hosts, which goes before the
seeds.  Multinomial naive Bayes carries the labels over to the words and path tokens that
come with them.  Scores are kept per distinct host and per distinct path shape; pages are
joined to both.

Defined cases: a null url, or one without ``://``, has an empty host and path and is
judged by the class shares alone.  Of rules that fit the longest wins, among equals the
first given.  Repeated rows are judged alike.  Hosts and words may be of any length; the
time for a label grows with its length and with the words found in it.  Without pages
there are no verdicts.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import BROADCAST_BYTES, col, slices, values
from tallymark.session import materialise

# Words that mark a host as unwanted when the classifier is trained.
SEEDS = ["adult", "ads", "bets", "casino", "escort", "payday", "pills", "porn", "spam", "viagra", "warez", "xxx"]

#: Share of all words that each seed has before any is read.
SEED_SHARE = 5e-6
_TOKENS = "[^a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """Applies to a host and its subdomains, where the path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def lower(text: Column) -> Column:
    """A-Z lowered, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def parse(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    text = F.coalesce(url, F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return lower(F.regexp_extract(text, parts, 1)), F.regexp_extract(text, parts, 2)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, else nulls."""
    ranked = sorted(rules, key=lambda r: -len(r.text))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in ranked]
    pick = lambda attribute: F.coalesce(F.lit(None).cast("string"), *[F.when(f, getattr(r, attribute)) for f, r in zip(fits, ranked, strict=True)])
    return pick("text"), pick("verdict")


def _tokens(text: Column) -> Column:
    return F.filter(F.split(lower(text), _TOKENS), lambda t: t != "")


def word_counts(texts: DataFrame, html_col: str, seeds: list[str] = SEEDS, seed_share: float = SEED_SHARE) -> DataFrame:
    """(word, n) of the words in page texts, markup left out, and of the seeds; n is one more than found, and for seeds their share more."""
    plain = F.regexp_replace(F.coalesce(col(html_col), F.lit("")), "(?s)<[^>]*>", " ")
    words = texts.select(F.explode(F.split(lower(plain), _TOKENS)).alias("word")).filter(F.col("word") != "")
    found = materialise(words.groupBy("word").agg((F.count(F.lit(1)) + 1).cast("double").alias("n")))
    prior = max(1e-9, seed_share * (found.agg(F.sum("n")).first()[0] or 0.0))
    known = texts.sparkSession.createDataFrame([(s, prior) for s in seeds], "word string, n double")
    return found.unionByName(known).groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(label: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """The most likely split of a label; ``known`` counts its pieces by (start, length), of equal splits that with the longer last piece.

    Two unknown pieces side by side are never better than one, so an unknown piece is either
    gone on with or begun anew, and its length needs no bound.
    """
    ends: dict[int, list[tuple[int, float]]] = {}
    for (start, length), n in known.items():
        ends.setdefault(start + length, []).append((length, n))
    letter, begin = math.log(10), math.log(10 / total)
    best: list[tuple[float, int]] = [(0.0, 0)]
    unknown, since = -math.inf, 0
    for end in range(1, len(label) + 1):
        if best[-1][0] + begin > unknown:
            unknown, since = best[-1][0] + begin, end - 1
        unknown -= letter
        options = [(best[end - length][0] + math.log(n / total), length) for length, n in ends.get(end, [])]
        best.append(max([*options, (unknown, end - since)]))
    words, at = [], len(label)
    while at:
        words.append(label[at - best[at][1] : at])
        at -= best[at][1]
    return words[::-1]


def segment(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) of distinct labels, by the word counts (word, n)."""
    sizes = counts.groupBy(F.length("word").alias("length")).agg(F.sum("n").alias("n")).collect()
    total = sum(r.n for r in sizes) or 1.0
    # As many lengths as words have; most labels are shorter than most of them.
    lengths = F.array(*[F.lit(r.length) for r in sorted(sizes)]).cast("array<int>")
    starts = F.sequence(F.lit(1), F.length("label"))
    pieces = labels.select("label", F.explode(starts).alias("start"))
    fitting = F.filter(lengths, lambda n: n <= F.length("label") - F.col("start") + 1)
    pieces = pieces.withColumn("length", F.explode(fitting)).withColumn("piece", F.substring(F.col("label"), F.col("start"), F.col("length")))
    found = pieces.join(counts, pieces["piece"] == counts["word"]).select(
        "label", F.struct((F.col("start") - 1).alias("start"), "length", "n").alias("known")
    )
    listed = labels.join(found.groupBy("label").agg(F.collect_list("known").alias("known")), "label", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            words = []
            for label, known in zip(values(batch, "label"), values(batch, "known"), strict=True):
                words.append(viterbi(label, {(k["start"], k["length"]): k["n"] for k in known or []}, total))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("label")), pa.array(words, pa.list_(pa.string()))], names=["label", "words"])

    return listed.mapInArrow(run, "label string, words array<string>")


def _attach(facts: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """Scores by key; broadcast only if their measured size allows it, else adaptive execution splits hot keys."""
    size = scores.agg(F.sum(F.length(key) * 4 + 64)).first()[0] or 0
    return facts.join(F.broadcast(scores) if size <= BROADCAST_BYTES else scores, key, "left")


def judge(
    pages: DataFrame,
    rules: list[Rule],
    seeds: list[str] = SEEDS,
    url_col: str = "url",
    html_col: str = "html",
    id_col: str = "page_id",
    labelled: DataFrame | None = None,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row; score is the log odds for blocking.

    ``labelled`` is a table (host, block), each host once.
    """
    host, path = parse(col(url_col))
    rows = pages.select(col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    # Numbers in paths are all the same token.
    shape = F.array_join(F.transform(_tokens(F.col("path")), lambda t: F.when(t.rlike("^[0-9]+$"), "0").otherwise(t)), "/")
    rows = rows.withColumn("shape", shape)

    # From here on one row per distinct (host, shape), counted.
    seen = materialise(rows.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n")))
    hosts = seen.groupBy("host").agg(F.sum("n").alias("n"))
    labels = hosts.select("host", F.posexplode(_tokens(F.col("host"))).alias("nth", "label"))
    split = segment(labels.select("label").distinct(), word_counts(pages, html_col, seeds))
    words = labels.join(split, "label").groupBy("host").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("nth", "words"))), lambda s: s["words"])).alias("words"))
    words = hosts.join(words, "host", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    block = F.arrays_overlap("words", F.array(*[F.lit(s) for s in seeds]))
    if labelled is not None:
        words = words.join(labelled.select("host", F.col("block").alias("label")), "host", "left")
        block = F.coalesce("label", block)
    words = materialise(words.select("host", "n", "words", block.alias("block")))

    of_hosts = words.select("block", "n", F.explode("words").alias("token"))
    of_paths = seen.join(words.select("host", "block"), "host").groupBy("block", "shape").agg(F.sum("n").alias("n"))
    of_paths = of_paths.select("block", "n", F.explode(F.split("shape", "/")).alias("token")).filter(F.col("token") != "")
    side = lambda flag: F.coalesce(F.sum(F.when(F.col("block") == flag, F.col("n"))), F.lit(0))
    # Host words and path tokens are different events.
    tagged = of_hosts.withColumn("token", F.concat(F.lit("h:"), "token")).unionByName(of_paths.withColumn("token", F.concat(F.lit("p:"), "token")))
    tokens = materialise(tagged.groupBy("token").agg(side(True).alias("bad"), side(False).alias("good")))
    sums = tokens.agg(F.sum("bad"), F.sum("good"), F.count(F.lit(1))).first()
    shares = words.agg(side(True), side(False)).first()
    bad_all, good_all, size = sums[0] or 0, sums[1] or 0, sums[2]
    prior = math.log((shares[0] + 1) / (shares[1] + 1))
    ratio = F.log((F.col("bad") + 1) / F.lit(bad_all + size)) - F.log((F.col("good") + 1) / F.lit(good_all + size))
    tokens = tokens.select("token", ratio.alias("ratio"))

    host_words = words.select("host", F.explode("words").alias("token")).withColumn("token", F.concat(F.lit("h:"), "token"))
    host_scores = host_words.join(tokens, "token").groupBy("host").agg(F.sum("ratio").alias("host_score"))
    shapes = seen.select("shape").distinct()
    shape_tokens = shapes.select("shape", F.explode(F.split("shape", "/")).alias("token")).withColumn("token", F.concat(F.lit("p:"), "token"))
    shape_scores = shape_tokens.join(tokens, "token").groupBy("shape").agg(F.sum("ratio").alias("shape_score"))

    scored = _attach(_attach(rows, materialise(host_scores), "host"), materialise(shape_scores), "shape")
    score = F.lit(prior) + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("shape_score", F.lit(0.0))
    rule, fixed = rule_of(F.col("host"), F.col("path"), rules)
    return scored.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(fixed, F.when(score > 0, "block").otherwise("allow")).alias("verdict"), score.alias("score"),
    )
