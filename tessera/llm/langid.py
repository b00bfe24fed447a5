"""Language identification by prediction by partial matching.

Each language has a variable-order context tree over bytes, PPM with escape
method C: in a context seen ``total`` times with ``kinds`` different next
bytes, a byte seen c times has probability c / (total + kinds), and a new one
costs the escape kinds / (total + kinds) and is looked for in the context one
byte shorter; below order 0 all 256 bytes are equal. The statistics are frozen
after training, so the code length of a text is the sum over its bytes of a
function of the last ``ORDER`` + 1 bytes, exact for every language. The
shortest code names the language.

Training takes a bounded sample: at most ``sample`` documents per language,
dealt evenly over salts by a hash of the id, whole texts. That bounds what the
driver gathers and broadcasts; every document is predicted on its whole text.

Defined results: a null text, or one without a letter, is ``und`` with score
0; so is every text if no labelled document trains; ties go to the smallest
language name; a null language never trains; repeated rows are predicted one
by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, KeyTable, byte_grams, map_arrow, slices, text_bytes

ORDER = 3
SAMPLE = 1024
SALTS = 32
PAD = b"\n" * ORDER
#: A posterior is taken of at most so many bytes' worth of evidence.
EVIDENCE = 64


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams of the padded, lower-cased texts, and where each text's begin
    and end."""
    padded = [PAD + t.translate(LOWER) for t in texts]
    ends = np.cumsum([len(p) for p in padded]).astype(np.int64)
    first = ends - np.array([len(p) for p in padded], np.int64)
    return byte_grams(np.frombuffer(b"".join(padded), np.uint8), ORDER + 1), first, ends - ORDER


class Ppm:
    """Context trees of some languages, from counts of the longest grams."""

    def __init__(self, languages: list[str], language: np.ndarray, gram: np.ndarray, n: np.ndarray) -> None:
        self.languages = languages
        self.trees = [self._tree(gram[language == i], n[language == i]) for i in range(len(languages))]
        keys = np.unique(gram)
        self.table = KeyTable(keys)
        self.cost = self.lengths(keys)

    @staticmethod
    def _tree(gram: np.ndarray, n: np.ndarray) -> list[tuple]:
        """Per order, sorted grams with -log2 P and contexts with the cost of
        an escape."""
        orders = []
        for order in range(ORDER + 1):
            key, back = np.unique(gram & (256 ** (order + 1) - 1), return_inverse=True)
            count = np.bincount(back, n, len(key))
            context, of = np.unique(key >> 8, return_inverse=True)
            total, kinds = np.bincount(of, count), np.bincount(of)
            orders.append((key, -np.log2(count / (total + kinds)[of]), context, -np.log2(kinds / (total + kinds))))
        return orders

    @staticmethod
    def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        return at, keys[at] == wanted

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of each gram's last byte, a column per language."""
        out = np.zeros((len(grams), len(self.languages)))
        for i, tree in enumerate(self.trees):
            left = np.arange(len(grams))
            for order in range(ORDER, -1, -1):
                key, cost, context, escape = tree[order]
                own = grams[left] & (256 ** (order + 1) - 1)
                at, found = self._at(key, own)
                out[left[found], i] += cost[at[found]]
                left, own = left[~found], own[~found]
                at, found = self._at(context, own >> 8)
                out[left[found], i] += escape[at[found]]
            out[left, i] += 8.0
        return out.astype(np.float32)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text, a column per language."""
        grams, first, last = _grams(texts)
        at = self.table.find(grams)
        cost = self.cost[at] if len(self.cost) else np.zeros((len(at), len(self.languages)), np.float32)
        new = np.flatnonzero(at < 0)
        if len(new):
            unseen, back = np.unique(grams[new], return_inverse=True)
            cost[new] = self.lengths(unseen)[back]
        cuts = np.column_stack((first, np.maximum(first, last))).ravel()
        sums = np.add.reduceat(np.concatenate((cost, np.zeros((1, cost.shape[1]), np.float32))), cuts, axis=0, dtype=np.float64)[::2]
        return np.where((last > first)[:, None], sums, 0.0)


def train(labelled: DataFrame, sample: int = SAMPLE) -> Ppm:
    """Fit on (doc_id, text, lang) rows."""
    order = Window.partitionBy("lang", "salt").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (labelled.where("lang is not null and text is not null").select("doc_id", "lang")
              .withColumn("salt", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(SALTS)))
              .withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= sample // SALTS).select("doc_id", "lang"))
    # At most ``sample`` ids per language: the texts stay where they are.
    rows = labelled.select("doc_id", "lang", text_bytes().alias("text")).join(F.broadcast(chosen.distinct()), ["doc_id", "lang"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, "text"):
                langs = np.array(part.column("lang").to_pylist(), object)
                texts = part.column("text").to_pylist()
                for lang in set(langs):
                    grams, first, last = _grams([t for t, own in zip(texts, langs, strict=True) if own == lang])
                    keep = np.zeros(len(grams) + 1, np.int64)
                    np.add.at(keep, first, 1)
                    np.add.at(keep, np.maximum(first, last), -1)
                    key, n = np.unique(grams[np.cumsum(keep[:-1]) > 0], return_counts=True)
                    yield {"lang": [lang] * len(key), "gram": key, "n": n}

    counts = map_arrow(rows, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    codes = counts["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy(np.int64)
    return Ppm(languages, codes, counts["gram"].to_numpy(np.int64), counts["n"].to_numpy(np.float64))


def predict(docs: DataFrame, model: Ppm, carry: list[str]) -> DataFrame:
    """Adds lang_pred and score to (``carry``, text) rows: the language of the
    shortest code and its posterior."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*carry, text_bytes().alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*carry).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        ppm = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                out = {c: part.column(c) for c in carry}
                letters = np.array(part.column("letters").to_pylist(), bool)
                if not ppm.languages:
                    yield out | {"lang_pred": ["und"] * part.num_rows, "score": [0.0] * part.num_rows}
                    continue
                texts = part.column("text").to_pylist()
                bits = ppm.code_lengths(texts)
                best = bits.argmin(axis=1)
                scale = EVIDENCE / np.maximum([len(t) for t in texts], EVIDENCE)
                gap = (bits - bits.min(axis=1, keepdims=True)) * scale[:, None]
                score = 1.0 / np.exp2(-gap).sum(axis=1)
                yield out | {"lang_pred": [ppm.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)],
                             "score": np.where(letters, score, 0.0)}

    return map_arrow(rows, run, f"{schema}, lang_pred string, score double")
