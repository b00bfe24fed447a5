"""Language-model scores by context-tree weighting.

The alphabet is bits: each byte is eight binary decisions, and each context
of 0 to ``DEPTH`` bytes holds a Krichevsky-Trofimov estimator per decision. A
node's weighted probability is the even mixture of its own estimate and the
product over its longer contexts, computed once over the whole training
corpus, bottom up. The statistics are then frozen: the prediction of a bit
mixes the estimates along its context path with the posterior weights of the
nodes, top down. A path ends at the deepest context that was seen.

Counting, both passes over the tree and the scoring are joins and
aggregations of keys, so the tree may be of any size: see ``shards``.

Defined results: a null or empty text is the end token alone; repeated rows
and ids are scored one by one; rows with a null id are held out or not as the
caller says (the query: they train, since their remainder is unknown); an
empty table gives an empty result; with no training text every bit has
probability one half; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, written
from tessera.llm.shards import Corpus

#: Longest context, in bytes, and the shortest one whose subtree is one group.
DEPTH, TOP = 5, 3


def lower_words(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def log_gamma(x: Column) -> Column:
    """ln gamma(x) for x > 0: Stirling's series at x + 6."""
    z = x + 6
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5)))
    product = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def log_kt(n0: Column, n1: Column) -> Column:
    """ln of the KT probability of n0 zeros and n1 ones in any order."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


class Subtrees:
    """The tree below some contexts of ``TOP`` bytes, from grams (key, n)."""

    def __init__(self, key: np.ndarray, n: np.ndarray) -> None:
        self.key, self.n = key, n
        symbol = key & 255
        rows = np.arange(len(key))
        # One entry per decision of each gram: its context and binary prefix.
        prefix = np.concatenate([(1 << j) | (symbol >> (8 - j)) for j in range(8)])
        bit = np.concatenate([(symbol >> (7 - j)) & 1 for j in range(8)])
        context = np.tile(key >> 8, 8)
        count = np.tile(n, 8)
        # Contexts in order of their bytes from the newest back: a node of any
        # depth is a run of entries.
        newest = np.zeros(len(context), np.int64)
        for i in range(DEPTH):
            newest |= ((context >> (8 * i)) & 255) << (8 * (DEPTH - 1 - i))
        id_ = (newest >> (8 * (DEPTH - TOP))) << 8 | prefix  # a top context and a prefix
        by = np.lexsort((newest, id_))
        self.entry = np.empty(len(by), np.int64)
        self.entry[by] = np.arange(len(by))
        newest, id_, bit, count = newest[by], id_[by], bit[by], count[by]
        self.levels: list[dict[str, np.ndarray]] = []
        new = np.ones(len(by), bool)
        new[1:] = id_[1:] != id_[:-1]
        for depth in range(TOP, DEPTH + 1):
            part = newest >> (8 * (DEPTH - depth))
            new[1:] |= part[1:] != part[:-1]
            first = np.flatnonzero(new)
            n1 = np.add.reduceat(count * bit, first) if len(first) else count
            n0 = (np.add.reduceat(count, first) if len(first) else count) - n1
            self.levels.append({"first": first, "n0": n0, "n1": n1, "own": kt(n0, n1), "of": np.cumsum(new) - 1})
        self.top_context = (key[by % max(1, len(rows))] >> 8) & (256**TOP - 1) if len(rows) else key
        self.prefix = prefix[by]
        deeper = self.levels[-1]
        deeper["stay"] = np.ones(len(deeper["first"]))
        weighted = deeper["own"]
        for level, below in zip(self.levels[-2::-1], self.levels[:0:-1], strict=True):
            longer = np.bincount(level["of"][below["first"]], weighted, len(level["first"]))
            weighted = np.logaddexp(level["own"], longer) - math.log(2)
            level["stay"] = np.exp(level["own"] - weighted) / 2
        self.weighted = weighted

    def tops(self) -> dict[str, np.ndarray]:
        top = self.levels[0]
        return {"context": self.top_context[top["first"]], "node": self.prefix[top["first"]],
                "n0": top["n0"], "n1": top["n1"], "weighted": self.weighted}

    def predict(self, mixed: np.ndarray, rest: np.ndarray, one: np.ndarray) -> np.ndarray:
        """log10 P of every gram, given what the shorter contexts hand to each
        top node."""
        for i, level in enumerate(self.levels):
            if i:
                up = self.levels[i - 1]["of"][level["first"]]
                mixed, rest, one = mixed[up], rest[up], one[up]
            estimate = (level["n1"] + 0.5) / (level["n0"] + level["n1"] + 1.0)
            one = np.where(level["n0"] + level["n1"] > 0, mixed + rest * estimate, one)
            mixed = mixed + rest * level["stay"] * estimate
            rest = rest * (1 - level["stay"])
        one = one[self.levels[-1]["of"]][self.entry].reshape(8, -1)
        symbol = self.key & 255
        return sum(np.log10(np.where((symbol >> (7 - j)) & 1, one[j], 1 - one[j])) for j in range(8))


def kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the KT probability of n0 zeros and n1 ones in any order."""
    def log_gamma(x):
        z = x + 6
        return ((z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3)
                + 1 / (1260 * z**5) - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)))
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


def gram_values(grams: DataFrame, groups: int) -> DataFrame:
    """log10 P(last byte | the bytes before) for each gram (shard, key, n);
    rows with n = 0 are asked for but did not train: shard, key, value.

    The subtrees below the contexts of ``TOP`` bytes are independent, given
    what the few shorter contexts say: those are aggregated as a table."""
    top = f"shiftright(key, 8) & {256**TOP - 1}"
    grams = grams.withColumn("own", F.expr(f"pmod(xxhash64({top}), {groups})"))

    def climb(rows: pa.Table) -> pa.Table:
        tops = Subtrees(rows.column("key").to_numpy(), rows.column("n").to_numpy()).tops()
        return pa.table({k: pa.array(v, pa.float64() if k == "weighted" else pa.int64()) for k, v in tops.items()})

    level = written(grams.groupBy("own").applyInArrow(climb, "context long, node long, n0 long, n1 long, weighted double"), "ctw-level")
    up = []
    for depth in range(TOP - 1, -1, -1):
        shorter = F.col("context").bitwiseAND(F.lit(256**depth - 1))
        level = (level.groupBy(shorter.alias("context"), "node")
                 .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("longer"))
                 .withColumn("own", log_kt(F.col("n0"), F.col("n1")))
                 .withColumn("most", F.greatest("own", "longer"))
                 .withColumn("weighted", F.col("most") + F.log((F.exp(F.col("own") - F.col("most"))
                                                                + F.exp(F.col("longer") - F.col("most"))) / 2))
                 .withColumn("stay", F.exp(F.col("own") - F.col("weighted")) / 2)
                 .select("context", "node", "n0", "n1", "weighted", "stay"))
        level = written(level, "ctw-level")
        up.append(level)
    # Top down: ``mixed`` of the mass is settled by shorter contexts, ``rest``
    # goes on; ``one`` is the prediction if the path ends here.
    estimate = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
    down = None
    for depth, level in enumerate(reversed(up)):
        level = level.withColumn("parent", F.col("context").bitwiseAND(F.lit(256**max(0, depth - 1) - 1)))
        if down is None:
            level = level.withColumn("mixed0", F.lit(0.0)).withColumn("rest0", F.lit(1.0)).withColumn("one0", F.lit(0.5))
        else:
            level = level.join(down.select(F.col("context").alias("parent"), "node", F.col("mixed").alias("mixed0"),
                                           F.col("rest").alias("rest0"), F.col("one").alias("one0")), ["parent", "node"])
        seen = F.col("n0") + F.col("n1") > 0
        down = (level.withColumn("one", F.when(seen, F.col("mixed0") + F.col("rest0") * estimate).otherwise(F.col("one0")))
                .withColumn("mixed", F.col("mixed0") + F.col("rest0") * F.col("stay") * estimate)
                .withColumn("rest", F.col("rest0") * (1 - F.col("stay")))
                .select("context", "node", "mixed", "rest", "one"))
    handed = down.withColumnRenamed("context", "parent")

    def descend(rows: pa.Table, above: pa.Table) -> pa.Table:
        trees = Subtrees(rows.column("key").to_numpy(), rows.column("n").to_numpy())
        tops = trees.tops()
        given = above.column("top").to_numpy() << 8 | above.column("node").to_numpy()
        by = np.argsort(given)
        at = by[np.searchsorted(given[by], tops["context"] << 8 | tops["node"])]
        value = trees.predict(*(above.column(c).to_numpy()[at] for c in ("mixed", "rest", "one")))
        return pa.table({"shard": rows.column("shard"), "key": rows.column("key"), "value": pa.array(value, pa.float64())})

    # Each top context gets the nodes of its parent, at most 255.
    tops = grams.select(F.expr(top).alias("top")).distinct().withColumn("parent", F.expr(f"top & {256**(TOP - 1) - 1}"))
    above = (tops.join(handed, "parent").drop("parent")
             .withColumn("other", F.expr(f"pmod(xxhash64(top), {groups})")))
    return (grams.groupBy("own").cogroup(above.groupBy("other"))
            .applyInArrow(descend, "shard int, key long, value double"))


def lm_scores(docs: DataFrame) -> DataFrame:
    """Scores of (doc_id, text, train): doc_id, train, n_tokens, n_known,
    train_tokens, base_score (a unigram model of words), score (log10
    probability of the text under the tree)."""
    corpus = Corpus(docs.select("doc_id", "text", "train"), lower_words, DEPTH + 1, with_words=True)
    counts = corpus.counts()
    words = counts.where("key < 0")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
                      F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)).alias("types")).first()
    under = total["tokens"] + 0.1 * (total["types"] + 1)
    values = (words.select("shard", "key", F.col("n").cast("double").alias("value"))
              .unionByName(gram_values(counts.where("key >= 0"), max(12, corpus.shards))))
    return (corpus.scores(values, lambda n: np.log10((n + 0.1) / under))
            .select("doc_id", "train", "n_tokens", "n_known", F.lit(total["tokens"]).cast("long").alias("train_tokens"),
                    F.col("word_score").alias("base_score"), F.col("gram_score").alias("score")))
