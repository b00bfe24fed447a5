"""Quality by the perplexity of a Kneser-Ney model of trusted text.

An interpolated modified Kneser-Ney model over bytes (``ORDER`` of them) is
trained on a bounded sample of trusted documents. Each distinct gram of the
corpus meets the model's tables in sharded joins, which give its probability
level by level, and the answers return to the documents (see ``shards``). A
document's bits per byte are judged against its language: the limit lies
``MARGIN`` times as far above the upper quantile of held-out trusted documents
as that lies above their median. A word that repeats the one before it is
written as a mark that tells how long the run is, so that long runs of one
word are as improbable as they are in trusted text; scores
of short texts are drawn to the median by ``SHORT`` bytes.

The only bound is the training sample, ``sample`` documents (those with the
smallest hash of their id); every document is scored in full.

Defined results: a text without a word (null, empty) is rejected; a document
without a language, or with one that has no held-out trusted document, is
judged by the limit of all languages; with no trusted document at all every
text with a word is kept; repeated rows are judged one by one; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_of_id, numbered, released, written
from tessera.llm.shards import Corpus

ORDER = 5
SAMPLE = 20_000
QUANTILE = 0.99
MARGIN = 2.0
SHORT = 64
#: Marks of the first, second, ... repetition of a word; the last goes on.
MARKS = [bytes([i]) for i in range(1, 9)]


def marked_words(text: bytes) -> list[bytes]:
    """Words; one that equals the word before it becomes a mark."""
    words = text.split()
    out, run = [], 0
    for i, word in enumerate(words):
        run = run + 1 if i and word == words[i - 1] else 0
        out.append(MARKS[min(run, len(MARKS)) - 1] if run else word)
    return out


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """The three modified Kneser-Ney discounts from counts of counts."""
    if not n1:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    pairs = [(n1, n2), (n2, n3), (n3, n4)]
    return [min(i + 1.0, max(0.05, i + 1 - (i + 2) * y * b / a)) if a else 0.5 * (i + 1) for i, (a, b) in enumerate(pairs)]


def kneser_ney(grams: DataFrame, order: int) -> DataFrame:
    """log2 P(last byte | the bytes before) for each gram (shard, key, n);
    rows with n = 0 are asked for but did not train: shard, key, value."""
    levels = [grams.select("shard", "key", F.col("n").alias("c"))]
    for k in range(order - 1, 0, -1):
        levels.append(written(levels[-1].groupBy(F.col("key").bitwiseAND(F.lit(256**k - 1)).alias("key"))
                              .agg(F.sum((F.col("c") > 0).cast("long")).alias("c")), "kn-level"))
    below = None
    for k, level in enumerate(reversed(levels), start=1):
        seen = level.where("c > 0").withColumn("context", F.shiftright("key", 8))
        of = seen.agg(*[F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
        d = discounts(*[of[f"n{i}"] or 0 for i in (1, 2, 3, 4)])
        discount = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        contexts = seen.groupBy("context").agg(F.sum("c").alias("total"), F.sum(discount).alias("left"))
        lower = F.lit(1 / 256)
        rows = level
        if below is not None:
            rows = rows.withColumn("suffix", F.col("key").bitwiseAND(F.lit(256 ** (k - 1) - 1))).join(below, "suffix").drop("suffix")
            lower = F.col("lower")
        rows = rows.withColumn("context", F.shiftright("key", 8)).join(contexts, "context", "left")
        p = F.when(F.col("total").isNull(), lower).otherwise(
            (F.when(F.col("c") > 0, F.col("c") - discount).otherwise(0.0) + F.col("left") * lower) / F.col("total"))
        if k == order:
            return rows.select("shard", "key", F.log2(p).alias("value"))
        below = rows.select(F.col("key").alias("suffix"), p.alias("lower"))


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, quantile: float = QUANTILE) -> DataFrame:
    """Per document (doc_id, text, lang), given labels (doc_id, quality,
    toxic): doc_id, row_id (see ``numbered``), lang, perplexity (per byte),
    score and its limit (bits per byte), kept."""
    with released(docs.sparkSession):
        return _judged(docs, labels, sample, quantile)


def _judged(docs: DataFrame, labels: DataFrame, sample: int, quantile: float) -> DataFrame:
    known = (labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min((F.col("quality") == 1) & ~(F.coalesce(F.col("toxic"), F.lit(0)) == 1)).alias("good")))
    good = known.where("good and doc_id is not null").select("doc_id", (crc_of_id() % 4 == 0).alias("holdout"))
    chosen = good.where("not holdout").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", F.lit(True).alias("chosen"))
    # At most ``sample`` ids, whatever the size of the tables.
    marked = numbered(docs.select("doc_id", "text", "lang")).join(F.broadcast(chosen), "doc_id", "left")
    corpus = Corpus(marked.select("doc_id", "row_id", "text", F.col("lang").alias("tag"), F.coalesce("chosen", F.lit(False)).alias("train")),
                    marked_words, ORDER, with_words=False)
    # Stored, so that the joins' shuffle files are gone when the answers go out.
    scores = corpus.scores(written(kneser_ney(corpus.counts(), ORDER), "kn-values"))
    scores = written(scores.select("doc_id", "row_id", F.col("tag").alias("lang"), "n_bytes", (-F.col("gram_score")).alias("bits")), "scores")
    held = (scores.join(good.where("holdout").select("doc_id"), "doc_id", "left_semi")
            .withColumn("each", F.col("bits") / F.col("n_bytes")))
    middle = held.groupBy("lang").agg(F.percentile_approx("each", 0.5, 10_000).alias("middle"), F.count("*").alias("n"))
    every = held.agg(F.percentile_approx("each", 0.5, 10_000).alias("every_middle"))

    def drawn(middle: str):
        return (F.col("bits") + SHORT * F.col(middle)) / (F.col("n_bytes") + SHORT)

    def limit(score, middle: str):
        return (1 + MARGIN) * F.percentile_approx(score, quantile, 10_000) - MARGIN * F.first(middle)

    every_middle = every.first()["every_middle"]
    with_middle = held.join(middle, held["lang"].eqNullSafe(middle["lang"])).drop(middle["lang"])
    per_language = with_middle.groupBy("lang").agg(limit(drawn("middle"), "middle").alias("limit"), F.first("middle").alias("middle"))
    every_limit = (held.withColumn("middle", F.lit(every_middle).cast("double"))
                   .agg(limit(drawn("middle"), "middle").alias("limit")).first()["limit"])
    limits = per_language.where("lang is not null").withColumnRenamed("lang", "of")
    out = scores.join(limits, F.col("lang") == F.col("of"), "left").drop("of")
    out = (out.withColumn("middle", F.coalesce("middle", F.lit(every_middle).cast("double")))
           .withColumn("limit", F.coalesce("limit", F.lit(every_limit).cast("double")))
           .withColumn("score", F.coalesce(drawn("middle"), F.col("bits") / F.col("n_bytes"))))
    return out.select("doc_id", "row_id", "lang", F.pow(F.lit(2.0), F.col("bits") / F.col("n_bytes")).alias("perplexity"),
                      "score", "limit",
                      ((F.col("n_bytes") > 1) & (F.col("limit").isNull() | (F.col("score") <= F.col("limit")))).alias("kept"))
