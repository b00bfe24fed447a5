"""Best-fit packing of token sequences by exact complements.

Documents become token ids, documents over the capacity are cut, and the
pieces are packed by their lengths alone: there are at most ``capacity``
different lengths, so the histogram of lengths is bounded whatever the corpus
size. On it the plan is made: for each length, the longest first, the single
length, the pair or the triple that exactly fills the gap is looked up and
consumed as often as the counts allow; what is left goes best-fit. A plan is
a list of (lengths, how often); every piece then finds its place from its
rank among the pieces of its length, which needs no group in one task: ranks
come from counts of small salted groups.

Defined results: a null or empty text is the end id alone; repeated rows and
ids are packed one by one; an empty table gives an empty result; a piece is
never dropped; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.alignment import byte_characters
from tessera.llm.common import map_arrow, slices, text_bytes, written

#: How the tokenizer's file cuts words, and the same for words of plain
#: characters, lower-cased. Fixed values.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
WORD_END = "</w>"
#: Words remembered; as many of the time before are still looked up.
CACHE_WORDS = 300_000
SHOWN = {b: c for c, b in byte_characters().items()}
RANK_GROUP = 256


class WordTokens:
    """Token ids of texts, word by word with a bounded cache.

    A tokenizer that drops white space and never merges across it gives a text
    the ids of its words in a row; a file that is not known to be of this kind
    is refused. Words of plain characters are cut into parts here, and parts
    not yet known are encoded together, each ending in a word-end token; other
    words, and those that hold a special token, go through the tokenizer
    whole."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        cuts = [c.get("pattern", {}).get("Regex") for c in (file.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        bytewise = any(c.get("type") == "ByteLevel" and not c.get("add_prefix_space") for c in (file.get("pre_tokenizer") or {}).get("pretokenizers", []))
        if file["model"].get("end_of_word_suffix") != WORD_END or CUT not in cuts or not bytewise:
            raise ValueError(f"{path}: not a vocabulary of words with ends, cut as expected")
        self.tokenizer = Tokenizer.from_file(path)
        special = [re.escape(t["content"].lower()) for t in file.get("added_tokens", [])]
        self.special = re.compile("|".join(special) or "(?!)")
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_parts(self, parts: set[str]) -> None:
        """The model takes a part as the characters that stand for its bytes."""
        tokenize, known = self.tokenizer.model.tokenize, self.parts
        for part in parts.difference(known):
            shown = part if part.isascii() else part.encode().decode("latin-1").translate(SHOWN)
            known[part] = array("I", [t.id for t in tokenize(shown)]).tobytes()

    def _learn(self, words: list[bytes]) -> None:
        if not words:
            return
        texts = b"\n".join(words).decode().split("\n")
        low = "\n".join(texts).lower().split("\n")
        letters = [x.isascii() and x.isalpha() for x in low]
        single = list(compress(low, letters))
        self._learn_parts(set(single))
        self.words.update(zip(compress(words, letters), map(self.parts.__getitem__, single), strict=True))
        cut, at, whole = [], [], []
        for i, (text, plain) in enumerate(zip(texts, letters, strict=True)):
            if not plain:
                if PLAIN.fullmatch(text) and not ("<" in text and self.special.search(text.lower())):
                    cut.append(PARTS.findall(text.lower()))
                    at.append(i)
                else:
                    whole.append(i)
        self._learn_parts(set().union(*cut))
        get = self.parts.__getitem__
        self.words.update((words[i], get(c[0]) + get(c[1]) if len(c) == 2 else b"".join(map(get, c))) for i, c in zip(at, cut, strict=True))
        for i, ids in zip(whole, self._encode([texts[i] for i in whole]), strict=True):
            self.words[words[i]] = np.array(ids, "<u4").tobytes()

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [t.split() for t in texts]
        if len(self.words) > CACHE_WORDS:
            self.words, self.older, self.parts = {}, self.words, {}
        new = set().union(*split).difference(self.words)
        if new:
            again = new.intersection(self.older)
            self.words.update(zip(again, map(self.older.__getitem__, again), strict=True))
            self._learn(list(new - again))
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in split]


_loaded: dict[str, WordTokens] = {}


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        if tokenizer not in _loaded:
            _loaded[tokenizer] = WordTokens(tokenizer)
        tokens = _loaded[tokenizer]
        for batch in batches:
            for part in slices(batch, "text"):
                out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
                for doc, ids in zip(part.column("doc_id").to_pylist(), tokens.ids(part.column("text").to_pylist()), strict=True):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at:at + 4 * capacity]
                        for name, v in zip(out, (doc, n, at // 4, len(own) // 4, zlib.crc32(own)), strict=True):
                            out[name].append(v)
                yield out

    return map_arrow(docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")), run,
                     "doc_id long, piece int, start long, length long, ids_crc32 long")


def _pair(have: np.ndarray, gap: int, most: int) -> tuple[int, int] | None:
    """The available a + b = gap with the largest a <= most."""
    low, high = (gap + 1) // 2, min(gap - 1, most)
    if high < low:
        return None
    fits = (have[low:high + 1] > 0) & (have[gap - high:gap - low + 1][::-1] > 0)
    if gap % 2 == 0 and have[gap // 2] < 2:
        fits[0] = False
    found = np.flatnonzero(fits)
    return (low + int(found[-1]), gap - low - int(found[-1])) if len(found) else None


def _fill(have: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """A single length, else a pair, else a triple that fills ``gap``."""
    if have[gap]:
        return (gap,)
    if two := _pair(have, gap, gap):
        return two
    for a in np.flatnonzero(have[:gap - 1])[::-1].tolist():
        if 3 * a < gap:
            return None
        have[a] -= 1
        two = _pair(have, gap - a, a)
        have[a] += 1
        if two:
            return (a, *two)
    return None


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Which lengths share a sequence, and how many such sequences there are."""
    have = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        have[length] = count
    done: list[tuple[tuple[int, ...], int]] = []
    left: dict[int, int] = {}
    for length in range(capacity, 0, -1):
        while have[length]:
            have[length] -= 1
            rest = () if length == capacity else _fill(have, capacity - length)
            have[length] += 1
            if rest is None:
                left[length] = int(have[length])
                have[length] = 0
                break
            used = Counter((length, *rest))
            times = min(int(have[x]) // n for x, n in used.items())
            for x, n in used.items():
                have[x] -= n * times
            done.append(((length, *rest), times))
    gaps: list[int] = []
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(gap: int, lengths: tuple[int, ...], times: int) -> None:
        if gap not in open_:
            open_[gap] = []
            insort(gaps, gap)
        open_[gap].append((lengths, times))

    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = min(count, capacity // length)
                times = count // each
                put(capacity - each * length, (length,) * each, times)
                count -= times * each
                continue
            gap = gaps[at]
            lengths, times = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
                gaps.pop(at)
            each = min(gap // length, count)
            use = min(times, count // each)
            if use < times:
                put(gap, lengths, times - use)
            put(gap - each * length, lengths + (length,) * each, use)
            count -= use * each
    return done + [x for some in open_.values() for x in some]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length and rank range: first sequence and offset in it. Sorted
    by (length, first rank)."""
    rows, next_rank, sequence = [], Counter(), 0
    for lengths, times in patterns:
        offset = 0
        for length in lengths:
            rows.append((length, next_rank[length], sequence, offset))
            next_rank[length] += times
            offset += length
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def ranked(parts: DataFrame, counts: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank``, from 0, among rows of equal length. ``counts`` has a row
    (length, n) per length."""
    salted = (parts.join(F.broadcast(counts.select("length", F.ceil(F.col("n") / RANK_GROUP).alias("groups"))), "length")
              .withColumn("salt", F.pmod(F.xxhash64(*order), F.col("groups"))).drop("groups"))
    before = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
              .drop("n"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy(*order)) - 1
    return (salted.withColumn("own", own).join(before, ["length", "salt"])
            .withColumn("rank", F.col("own") + F.col("before")).drop("own", "before", "salt"))


def pack(parts: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to pieces (columns of ``pieces``). Only the
    histogram, at most ``capacity`` rows, comes to the driver."""
    counts = parts.groupBy("length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.collect()}
    where = places(plan(histogram, capacity))
    keys = where["length"] << 48 | where["rank"]
    bounded = parts.sparkSession.createDataFrame(sorted(histogram.items()), "length long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length << 48 | rank, side="right") - 1
            yield {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")} | {
                "sequence_id": where["sequence"][at] + rank - where["rank"][at],
                "offset": where["offset"][at]}

    return map_arrow(ranked(parts, bounded, ["doc_id", "piece", "start", "ids_crc32"]), run,
                     "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Tokenise, cut and pack documents (doc_id, text)."""
    return pack(written(pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)
