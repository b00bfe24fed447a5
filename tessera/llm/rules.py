"""Quality rules with risk-controlled thresholds.

Each document has counts (words, symbols, repeated lines and words) and from
them shares, one per rule. A rule rejects a document whose share exceeds the
rule's cutoff in the document's stratum, its language. What is certified, on
labelled holdouts, is a set of rules at one cutoff, with all it rejects: for
each stratum and each of the 31 sets, cutoffs are tested from the loosest to
the tightest, each with the exact binomial probability of as few rejected good
documents as were seen, were the true rate ``ALPHA``; testing stops at the
first that fails its level, ``DELTA`` divided by the number of strata and sets
(Bonferroni; within a set the fixed order needs no further correction). So
with probability 1 - ``DELTA`` the rules used in a stratum together reject no
more than ``ALPHA`` of its good documents, in every stratum at once. A trial is
a labelled text: rows of one id count once, and so do equal texts, good only if
all their labels say so. Of the certified sets the one that catches the most
bad documents is used, at the loosest cutoff that catches nearly as many.
All documents together are one more stratum. Where a language's labels certify
cutoffs but none of them catches a bad document, the set of all documents
holds, at its cutoff or the tightest certified there if that is looser. Where a
language has too few labels to certify a cutoff, or its good documents exceed
even the loosest too often, there is none, whatever holds for all documents.

Defined results: a null or empty text has no words and fails the base rules; a
null language is a stratum; documents without a label never count; a share
with no words is 0; repeated rows are judged one by one; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow, slices, text_bytes, written

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
NOT_LETTERS = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122))
ALPHA, DELTA = 0.02, 0.05
#: Candidate cutoffs of every share, loosest first.
CUTOFFS = [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01]
RULES = {
    "symbols": "n_symbols / word_chars",
    "lines": "n_dup_lines / n_lines",
    "repeats": "n_repeat_words / n_words",
    "runs": "n_run_words / n_words",
    "capitals": "n_capitals / n_letters",
}
#: Every set of rules, as bits of their places in RULES.
SETS = range(1, 2 ** len(RULES))
#: Share of what the tightest certified cutoff catches that is enough.
ENOUGH = 0.99


def repeat_words(words: list[bytes], ids: dict[bytes, int]) -> int:
    """Words in windows of ``WINDOW`` words that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    # Two codes to one, exactly, until a window is one number.
    key = codes[:n]
    for i in range(1, WINDOW):
        key = np.unique(key * (len(ids) + 1) + codes[i:i + n], return_inverse=True)[1]
    again = (np.bincount(key) > 1)[key]
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[WINDOW:] -= again
    return int(np.count_nonzero(np.cumsum(edge)[:len(words)]))


def _count(text: bytes) -> tuple[int, ...]:
    words = text.split()
    joined = b"".join(words)
    raw = np.frombuffer(joined, np.uint8)
    lines = [line for line in text.split(b"\n") if line.strip()]
    letters = joined.translate(None, NOT_LETTERS)
    return (len(words), len(joined) - int(np.count_nonzero((raw & 0xC0) == 0x80)),
            len(joined) - len(joined.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeat_words(words, {}), len(lines), sum(a == b for a, b in zip(words, words[1:])),
            int(np.count_nonzero(np.frombuffer(letters, np.uint8) < 91)), len(letters))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_run_words", "n_capitals", "n_letters"]


def features(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts = [_count(t) for t in part.column("text").to_pylist()]
                yield {c: part.column(c) for c in ("doc_id", "lang")} | dict(zip(COUNTS, zip(*counts, strict=True), strict=True))

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "lang", text_bytes().alias("text")), run,
                     "doc_id long, lang string, " + ", ".join(f"{c} long" for c in COUNTS))


def share(rule: str) -> Column:
    over, _, under = RULES[rule].partition(" / ")
    return F.coalesce(F.try_divide(F.col(over), F.col(under)), F.lit(0.0))


def few_by_chance(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k)."""
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def n_passed(n: int, good: list[int], alpha: float, level: float) -> int:
    """How many candidates, from the loosest on, can be certified."""
    for i, k in enumerate(good):
        if k > alpha * n or few_by_chance(k, n, alpha) > level:
            return i
    return len(good)


def certified(n: int, good: list[int], bad: list[int], alpha: float, level: float) -> float | None:
    """The cutoff to use, given how many good and bad documents each candidate
    rejects; None if not even the loosest can be certified."""
    passed = n_passed(n, good, alpha, level)
    if not passed or not bad[passed - 1]:
        return None
    return next(c for c, b in zip(CUTOFFS, bad) if b >= ENOUGH * bad[passed - 1])


def members(of: int) -> list[str]:
    return [r for i, r in enumerate(RULES) if of >> i & 1]


def trials(labelled: DataFrame) -> DataFrame:
    """One trial per stratum and labelled document (rows with good): for each
    rule the first cutoff, by place, that any row of the document exceeds.
    Strata are the values of lang, and with ``every`` true all documents."""
    step = [sum((share(r) <= c).cast("int") for c in CUTOFFS).alias(r) for r in RULES]
    strata = labelled.select("doc_id", "lang", "good", *step).withColumn("every", F.explode(F.array(F.lit(False), F.lit(True))))
    return (strata.groupBy("every", F.when(~F.col("every"), F.col("lang")).alias("lang"), "doc_id")
            .agg(F.min("good").alias("good"), *[F.min(r).alias(r) for r in RULES]))


def cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per lang, and with ``every`` true for all: the set of rules to use (0
    for none), its cutoff, and for each set the tightest certified cutoff
    (``tightest``; null where none is)."""
    documents = written(trials(labelled), "trials")
    strata = max(1, documents.select("every", "lang").distinct().count())
    level = delta / (strata * len(SETS))
    first = F.explode(F.array(*[F.struct(F.lit(s).alias("rules"), F.array_min(F.array(*members(s))).alias("step")) for s in SETS])).alias("x")
    table = (documents.select("every", "lang", "good", first).groupBy("every", "lang", "x.rules", "x.step")
             .agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad")))

    def pick(rows: pa.Table) -> pa.Table:
        counts = np.zeros((2, len(SETS) + 1, len(CUTOFFS) + 1), np.int64)
        rules, step = (rows.column(c).to_numpy() for c in ("rules", "step"))
        for i, side in enumerate(("good", "bad")):
            counts[i, rules, step] = rows.column(side).to_numpy()
        n, rejected = int(counts[0, 1].sum()), counts.cumsum(axis=2)[:, :, :-1]
        best, used, cut, tightest = (0,), 0, None, [None]
        for s in SETS:
            good, bad = (x[s].tolist() for x in rejected)
            passed = n_passed(n, good, alpha, level)
            tightest.append(CUTOFFS[passed - 1] if passed else None)
            own = certified(n, good, bad, alpha, level)
            if own is not None:
                at = CUTOFFS.index(own)
                rank = (bad[at], -good[at], -len(members(s)), -s)
                if rank > best:
                    best, used, cut = rank, s, own
        return pa.table({"every": rows.column("every")[:1], "lang": rows.column("lang")[:1], "rules": pa.array([used], pa.int32()),
                         "cutoff": pa.array([cut], pa.float64()), "tightest": pa.array([tightest], pa.list_(pa.float64()))})

    return table.groupBy("every", "lang").applyInArrow(pick, "every boolean, lang string, rules int, cutoff double, tightest array<double>")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document (doc_id, text, lang), given labels (doc_id, quality): the
    counts, base_failed, rules (those that reject), kept."""
    rows = written(features(docs), "features")
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    cut = written(cutoffs(rows.join(known, "doc_id")), "cutoffs")
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    every = cut.where("every").first()
    # Where the stratum's own sets catch nothing, that of all, if certified there too.
    shared, loosest = (every["rules"], every["cutoff"]) if every else (0, None)
    there = F.get("tightest", F.lit(shared))
    of = cut.where("not every").select(
        F.col("lang").alias("of"),
        F.when(F.col("rules") > 0, F.col("rules")).when(there.isNotNull(), F.lit(shared)).otherwise(0).alias("used"),
        F.when(F.col("rules") > 0, F.col("cutoff")).otherwise(F.greatest(there, F.lit(loosest).cast("double"))).alias("cutoff"))
    failed = F.array_compact(F.array(*[F.when(F.col("used").bitwiseAND(1 << i).cast("boolean") & (share(r) > F.col("cutoff")), F.lit(r))
                                       for i, r in enumerate(RULES)]))
    return (rows.join(of, F.col("lang").eqNullSafe(F.col("of")), "left")
            .withColumn("base_failed", base).withColumn("rules", F.coalesce(failed, F.array().cast("array<string>")))
            .withColumn("kept", ~F.col("base_failed") & (F.size("rules") == 0))
            .select("doc_id", *COUNTS[:5], "base_failed", "kept", "rules"))
