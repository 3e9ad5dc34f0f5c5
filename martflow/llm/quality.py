"""Quality classifier: interpolated modified Kneser-Ney word n-grams.

Trained on every trusted text but those kept back (below), repeated rows once. A
``Sample`` bounds that on demand (at most ``rows`` texts, one of an id, with at
most ``words`` words together, chosen by a hash of the id). All
counts are Spark aggregations and joins: bigram counts, continuation counts,
context totals, and the three discounts of each order from its counts of
counts.

In an interpolated model the log probability of a word after another is

    log p(b | a) = log l(a) + log p(b) + gain(a, b)

where l(a) is the weight left to the lower order after a (1 if a was never a
context), p(b) the continuation probability (that of an unknown word if b is
new) and gain is zero unless the bigram was seen. Each word of a text is once
the following word and once the context, so a text's log probability is the
sum of one number per n-gram that it holds. Scoring is therefore one count
join: all n-grams of all texts against one table of n-gram values, summed by
text, and the perplexity is 10 ** (-sum / tokens), the end being a token.

That is how a bounded model is used (``sample=``, or ``broadcast=True``). The model
of all trusted texts grows with them, and two numbers for each n-gram of a text
are several times the text, so there blocks of texts ask for their distinct
n-grams' counts, packed (``bigrams``): the same sums of the same numbers.

A text is rejected if its perplexity is above the ``quantile`` of its language,
taken over all trusted texts that the model wasn't trained on (over the
trusted texts of all languages for a language that has none). One trusted text
in ``KEPT_BACK``, by a hash of the id, is never trained on, so that there are
such texts however few are trusted.

Defined results: null and empty texts have one token, the end; a null language
is a language of its own; repeated rows each give a row; without trusted texts
nothing is rejected (null threshold); contradicting labels of an id make it
untrusted; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bigrams
from .common import written

BEGIN, FINISH = "\n<s>", "\n</s>"  # no word holds a line break


KEPT_BACK = 4


@dataclass(frozen=True)
class Sample:
    rows: int = 4000
    words: int = 2_000_000


def _words(text: str) -> Column:
    """BEGIN, the lower-cased words, FINISH."""
    w = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    return F.concat(F.array(F.lit(BEGIN)), w, F.array(F.lit(FINISH)))


def _pairs(words: str) -> Column:
    """(a, b) of each neighbouring pair."""
    n = F.size(words)
    return F.arrays_zip(F.slice(words, F.lit(1), n - 1).alias("a"), F.slice(words, F.lit(2), n - 1).alias("b"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that all their labels call good and not toxic."""
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"),
                                                                   F.count("quality").alias("n"), F.count(F.lit(1)).alias("m")) \
        .where("q = 1 and coalesce(t, 0) = 0 and n = m").select("doc_id")


def trained_on() -> Column:
    """Whether the texts of a trusted id train the model (the others judge it)."""
    return F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(KEPT_BACK)) != 0


def training_texts(docs: DataFrame, trusted: DataFrame, sample: Sample | None = None) -> DataFrame:
    """(doc_id, words) of every text of the trusted ids that train, or of the sample."""
    if sample is None:
        return docs.select("doc_id", "text").join(trusted.where(trained_on()), "doc_id", "left_semi").distinct() \
            .select("doc_id", _words("text").alias("words"))
    order = F.xxhash64(F.lit(5), "doc_id")
    chosen = trusted.where(trained_on()).select("doc_id", order.alias("h")).orderBy("h", "doc_id").limit(sample.rows)
    rows = docs.join(F.broadcast(chosen), "doc_id")  # sample.rows ids
    # of an id's rows the one with the smallest text hash, so that rows are bounded like ids
    texts = written(rows.select("doc_id", F.struct(F.xxhash64("text").alias("key"), "h", _words("text").alias("words")).alias("r"))
                    .groupBy("doc_id").agg(F.min("r").alias("r")).select("doc_id", "r.h", "r.words"))
    upto = F.sum("n").over(Window.orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    within = texts.select("doc_id", "h", F.size("words").alias("n")).withColumn("upto", upto) \
        .where(F.col("upto") <= sample.words).select("doc_id")  # a window over the sizes of sample.rows texts
    return texts.join(within, "doc_id").select("doc_id", "words")


def discounts(n: list[int]) -> list[float]:
    """Modified discounts of counts 1, 2 and 3 or more; ``n``: how many counts are 0 to 4."""
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    return [min(max(k - (k + 1) * y * n[k + 1] / n[k] if n[k] else y * k, 0.05), k - 0.05) for k in (1, 2, 3)]


def _discounts(counts: DataFrame, c: str) -> list[float]:
    n = {r["k"]: r["n"] for r in counts.groupBy(F.least(c, F.lit(5)).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return discounts([n.get(k, 0) for k in range(5)])


def _discount(c: str, d: list[float]) -> Column:
    return F.when(F.col(c) == 1, d[0]).when(F.col(c) == 2, d[1]).otherwise(d[2])


def _gram(*words) -> Column:
    return F.xxhash64(F.lit(len(words)), *words)


def model(texts: DataFrame) -> tuple[DataFrame, float]:
    """(gram long, value double) of every n-gram that a text's sum gains from,
    and the log10 probability of an unknown word."""
    pairs = texts.select(F.explode(_pairs("words")).alias("p")).select("p.a", "p.b")
    two = written(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c")))
    one = two.groupBy("b").agg(F.count(F.lit(1)).alias("c"))
    types, total = one.agg(F.count(F.lit(1)), F.sum("c")).first()
    if not types:
        return two.select(_gram("a").alias("gram"), F.lit(0.0).alias("value")), 0.0
    d1, d2 = _discounts(one, "c"), _discounts(two, "c")
    left = one.agg(F.sum(_discount("c", d1))).first()[0] / total
    unknown = left / (types + 1)
    p1 = one.select("b", ((F.col("c") - _discount("c", d1)) / total + unknown).alias("p"))
    context = two.groupBy("a").agg(F.sum("c").alias("n"), F.sum(_discount("c", d2)).alias("d")).select("a", "n", (F.col("d") / F.col("n")).alias("left"))
    gains = two.join(context, "a").join(p1, "b").select(
        _gram("a", "b").alias("gram"),
        F.log10(((F.col("c") - _discount("c", d2)) / F.col("n") + F.col("left") * F.col("p")) / (F.col("left") * F.col("p"))).alias("value"))
    words = p1.select(F.col("b").alias("w"), F.log10(F.col("p") / unknown).alias("v")) \
        .unionByName(context.select(F.col("a").alias("w"), F.log10("left").alias("v"))) \
        .groupBy("w").agg(F.sum("v").alias("value")).select(_gram("w").alias("gram"), "value")
    return written(gains.unionByName(words)), math.log10(unknown)


def perplexities(docs: DataFrame, table: DataFrame, unknown: float, broadcast: bool = False) -> DataFrame:
    """(doc_id, text_key, lang, copies, n_tokens, perplexity) of the distinct
    (id, text, language) rows of ``docs``."""
    w = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "lang", _words("text").alias("words"))
    ref = F.xxhash64("doc_id", "text_key", "lang").alias("ref")
    texts = w.groupBy("doc_id", "text_key", "lang").agg(F.count(F.lit(1)).alias("copies"), F.max(F.size("words") - 1).cast("long").alias("n_tokens"))
    # a pair stands for itself and for its first word as context and follower
    rows = w.select(ref, F.explode(_pairs("words")).alias("p")).select("ref", F.explode(F.array(_gram("p.a"), _gram("p.a", "p.b"))).alias("gram"))
    table = F.broadcast(table) if broadcast else table
    value = rows.join(table, "gram").groupBy("ref").agg(F.sum("value").alias("v"))
    return texts.withColumn("ref", ref).join(value, "ref", "left") \
        .select("doc_id", "text_key", "lang", "copies", (F.col("n_tokens") * F.col("copies")).alias("n"), F.coalesce("v", F.lit(0.0)).alias("v"), "n_tokens")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.995, sample: Sample | None = None, doc_id: str = "doc_id",
             text: str = "text", lang: str = "lang", broadcast: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, lang, n_tokens,
    perplexity, threshold, kept."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"))
    trusted = trusted_ids(labels.select("doc_id", "quality", "toxic"))
    if sample is None and not broadcast:
        def trained(rows):
            """One row of each text of the ids that train."""
            return rows.join(trusted.where(trained_on()), "doc_id", "left_semi").groupBy("doc_id", "text_key") \
                .agg(F.min(F.struct("block", "row")).alias("r")).select("r.block", "r.row")
        lowered = src.select("doc_id", F.xxhash64("text").alias("text_key"), "lang", F.lower(F.coalesce("text", F.lit(""))).alias("text"))
        scored = bigrams.log_probabilities(lowered, trained, discounts) \
            .select("doc_id", "text_key", "lang", F.lit(1).alias("copies"), "n_tokens", F.pow(F.lit(10.0), -F.col("v") / F.col("n_tokens")).alias("perplexity"))
        scored = written(scored)
    else:
        texts = training_texts(src, trusted, sample)  # read once where all train, small where sampled
        table, unknown = model(texts)
        finish = table.where(F.col("gram") == _gram(F.lit(FINISH))).agg(F.sum("value")).first()[0] or 0.0
        found = perplexities(src, table, unknown, broadcast)
        scored = written(found.withColumn(
            # the end is a follower in each copy and never a context, so it has no pair of its own
            "perplexity", F.pow(F.lit(10.0), -(F.col("v") + F.col("copies") * F.lit(finish) + F.col("n") * F.lit(unknown)) / F.col("n"))).drop("v", "n"))
    judged = scored.join(trusted, "doc_id")
    judged = judged.where(~trained_on()) if sample is None else judged.join(texts.select("doc_id").distinct(), "doc_id", "left_anti")
    at = F.percentile_approx("perplexity", F.lit(quantile), F.lit(100_000))
    limits = judged.groupBy("lang").agg(at.alias("limit")).select(F.col("lang").alias("of"), "limit")
    overall = judged.agg(at.alias("any")).first()["any"]
    return scored.join(limits, F.col("lang").eqNullSafe(F.col("of")), "left") \
        .withColumn("threshold", F.coalesce(F.col("limit"), F.lit(overall).cast("double"))) \
        .select("doc_id", "text_key", "lang", "n_tokens", "perplexity", "threshold",
                F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept"),
                F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rejected rows; all columns kept."""
    bad = classify(docs, labels, doc_id=doc_id, text=text, **options).where(~F.col("kept")) \
        .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    return docs.join(bad, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__key")), "left_anti")
