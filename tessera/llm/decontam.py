"""Benchmark passages in documents, by an FM-index per shard of documents.

The words of some documents, each text closed by a separator, make a shard.
Its index is stored once, whatever is searched later: the Burrows-Wheeler
transform of the word numbers as a wavelet matrix, the vocabulary, and the
text positions of a sample of suffixes. Equal texts of a shard share a place.

Benchmark items are cut into windows of words. All windows of a block of items
go through a shard together: backward search narrows each to its interval of
suffixes by ranks in the wavelet matrix; every suffix of an interval is then
followed backwards to the next sampled one, which gives its place; overlapping
places merge into spans. Items come in blocks of bounded bytes, one pass over
the index each, so neither driver nor tasks hold more than one.

Words are the runs of a-z, 0-9 and non-ASCII characters after lower-casing
A-Z, compared whole.

Defined results: null, empty and wordless texts have no words and no hits, and
such items no windows; an item shorter than a window is one window; an item
without an id marks words but is not listed; items of one id count once; null
and repeated document ids are rows of their own; empty tables give empty
results or no hits; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow, numbered, slices, text_bytes, written

SHARD_BYTES = 16 << 20
MOST_ROWS = 1 << 20
#: Every so many-th position of a shard is sampled, and each text's first.
SAMPLE_STEP = 16
#: Benchmark text searched in one pass.
BLOCK_BYTES = 4 << 20
#: Suffixes followed at once.
FOLLOW = 1 << 20
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def suffix_order(row: np.ndarray) -> np.ndarray:
    """Suffixes of a row of numbers in order, by prefix doubling. Zeros are
    separators, the last number is one; an earlier separator is the smaller."""
    n = len(row)
    cuts = np.flatnonzero(row == 0)
    rank = row.astype(np.int64) + (len(cuts) - 1)
    rank[cuts] = np.arange(len(cuts))
    bits = max(1, int(rank.max(initial=0)).bit_length())
    size = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(size):
        key <<= bits
        key[:max(0, n - k)] |= rank[k:]
    order = np.argsort(key)
    slots, key = np.arange(n), key[order]
    while True:
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        tied = ~(new & np.concatenate((new[1:], [True])))
        slots = slots[tied]
        if not len(slots):
            return order
        at = order[slots]
        key = rank[at] * n + rank[at + size]
        by = np.argsort(key)
        order[slots], key = at[by], key[by]
        size *= 2


class Bits:
    """A bit vector with ranks."""

    def __init__(self, packed: bytes) -> None:
        self.words = np.frombuffer(packed, np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    @staticmethod
    def pack(bits: np.ndarray) -> bytes:
        """Padded, so that a rank at the end needs no special case."""
        packed = np.packbits(bits, bitorder="little")
        return packed.tobytes() + bytes(8 + -len(packed) % 8)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class Index:
    """The FM-index of a shard."""

    SCHEMA = ("shard long, row_id array<long>, doc_id array<long>, text_of array<int>, sizes array<long>, vocabulary binary, "
              "levels array<binary>, counts binary, marks binary, samples binary")

    def __init__(self, stored: dict) -> None:
        self.sizes = np.array(stored["sizes"], np.int64)
        self.starts = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        self.number = {w: i for i, w in enumerate(stored["vocabulary"].split(b" "), 1)} if stored["vocabulary"] else {}
        self.levels = [Bits(x) for x in stored["levels"]]
        n = int((self.sizes + 1).sum())
        self.zeros = [n - int(x.rank(np.array([n]))[0]) for x in self.levels]
        #: Suffixes that begin with a smaller number.
        self.before = np.concatenate(([0], np.cumsum(np.frombuffer(stored["counts"], np.int64))))
        self.marks, self.samples = Bits(stored["marks"]), np.frombuffer(stored["samples"], np.int32)

    @staticmethod
    def build(shard: int, rows: list[tuple], texts: list[np.ndarray], text_of: list[int], words: list[bytes]) -> dict:
        """``texts`` are numbers from 1, ``words`` what they stand for."""
        sizes = np.array([len(t) for t in texts], np.int64)
        row = np.zeros(int((sizes + 1).sum()), np.int32)
        is_word = np.ones(len(row), bool)
        ends = np.cumsum(sizes + 1)
        is_word[ends - 1] = False
        row[is_word] = np.concatenate(texts)
        order = suffix_order(row)
        last = row[order - 1]
        marked = np.zeros(len(row), bool)
        marked[::SAMPLE_STEP] = True
        marked[ends - sizes - 1] = True
        chosen = marked[order]
        levels = []
        for level in reversed(range(len(words).bit_length())):
            ones = (last >> level & 1).astype(bool)
            levels.append(Bits.pack(ones))
            last = np.concatenate((last[~ones], last[ones]))
        return {"shard": [shard], "row_id": [[r for r, _ in rows]], "doc_id": [[d for _, d in rows]], "text_of": [text_of], "sizes": [sizes],
                "vocabulary": [b" ".join(words)], "levels": [levels], "counts": [np.bincount(row, minlength=len(words) + 1).astype(np.int64).tobytes()],
                "marks": [Bits.pack(chosen)], "samples": [order[chosen].astype(np.int32).tobytes()]}

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where ``at`` leads through the levels by each symbol's bits."""
        depth = len(self.levels)
        for i, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            ones = bits.rank(at)
            at = np.where(symbols >> (depth - 1 - i) & 1 == 1, zeros + ones, at - ones)
        return at

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of suffixes that begin with each window: a row of word
        numbers, filled up with 0 on the left; -1 is a word not in the shard."""
        live = np.flatnonzero((windows >= 0).all(axis=1) & (windows > 0).any(axis=1))
        low, high = np.zeros((2, len(windows)), np.int64)
        high[live] = self.before[-1]
        for column in reversed(range(windows.shape[1])):
            live = live[windows[live, column] > 0]
            word = windows[live, column]
            first = self._down(word, np.zeros(len(word), np.int64))
            for side in (low, high):
                side[live] = self.before[word] + self._down(word, side[live]) - first
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, suffix: np.ndarray) -> np.ndarray:
        """The text positions of suffixes, backwards to a sampled one."""
        place = np.empty(len(suffix), np.int64)
        left, at, steps = np.arange(len(suffix)), suffix, 0
        depth = len(self.levels)
        while len(left):
            here = self.marks.get(at)
            place[left[here]] = self.samples[self.marks.rank(at[here])] + steps
            left, at = left[~here], at[~here]
            symbol, to = np.zeros(len(at), np.int64), at
            for i, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
                one, ones = bits.get(to), bits.rank(to)
                symbol |= one.astype(np.int64) << (depth - 1 - i)
                to = np.where(one, zeros + ones, to - ones)
            word, which = np.unique(symbol, return_inverse=True)
            at = (self.before[word] - self._down(word, np.zeros(len(word), np.int64)))[which] + to
            steps += 1
        return place


def shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The stored index of (doc_id, text) rows, one row per shard of about
    ``shard_bytes`` of distinct texts; a longer text is a shard of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shard = TaskContext.get().partitionId() << 40

        def opened() -> tuple:
            return [], [], [], {}, defaultdict(count(1).__next__)

        (rows, texts, text_of, known, number), filled = opened(), 0
        for batch in batches:
            for part in slices(batch, "text"):
                for row, doc, text in zip(*(part.column(c).to_pylist() for c in ("row_id", "doc_id", "text")), strict=True):
                    if rows and (filled + len(text) > shard_bytes or len(rows) >= MOST_ROWS):
                        yield Index.build(shard, rows, texts, text_of, list(number))
                        shard, (rows, texts, text_of, known, number), filled = shard + 1, opened(), 0
                    words = words_of(text)
                    numbers = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
                    place = known.setdefault(numbers.tobytes(), len(texts))
                    if place == len(texts):
                        texts.append(numbers)
                        filled += len(text)
                    rows.append((row, doc))
                    text_of.append(place)
        if rows:
            yield Index.build(shard, rows, texts, text_of, list(number))

    return written(map_arrow(numbered(docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))), run, Index.SCHEMA), "fm-index")


def item_blocks(items: DataFrame, window: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Stored benchmark items (item_id, text) as rows of at most about
    ``block_bytes``: block, item_ids, texts. A longer item is cut into parts
    that overlap by a window less one word."""
    items = items.select(F.col("item_id").cast("string"), text_bytes().alias("text"))
    size = items.agg(F.sum(F.length("text") + 16).alias("n")).first()["n"] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, filled, block = [], 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            for item, text in zip(*(batch.column(c).to_pylist() for c in ("item_id", "text")), strict=True):
                words = words_of(text)
                step = max(1, block_bytes // (2 * max(map(len, words), default=1)))
                for at in range(0, max(1, len(words) - window + 1), step):
                    part = b" ".join(words[at:at + step + window - 1])
                    if held and filled + len(part) > block_bytes:
                        yield {"block": [block], "item_ids": [[i for i, _ in held]], "texts": [[t for _, t in held]]}
                        held, filled, block = [], 0, block + 1
                    if part:
                        held.append((item, part))
                        filled += len(part) + 16
        if held:
            yield {"block": [block], "item_ids": [[i for i, _ in held]], "texts": [[t for _, t in held]]}

    return written(map_arrow(items.repartition(max(1, -(-size // block_bytes))), run,
                             "block long, item_ids array<string>, texts array<binary>"), "items")


def windows_of(item_ids: list[str | None], texts: list[bytes], window: int) -> tuple[list[tuple[bytes, ...]], list[list[str]]]:
    """Distinct windows, and the items that hold each."""
    held: dict[tuple, dict] = {}
    for item, text in zip(item_ids, texts, strict=True):
        words = text.split()
        for at in range(max(1, len(words) - window + 1)):
            held.setdefault(tuple(words[at:at + window]), {})[item] = True
    held.pop((), None)
    return list(held), [[i for i in x if i is not None] for x in held.values()]


def _found(index: Index, windows: list[tuple[bytes, ...]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of windows in a shard: position, window."""
    get = index.number.get
    numbers = np.array([[0] * (width - len(w)) + [get(x, -1) for x in w] for w in windows], np.int64).reshape(-1, width)
    low, high = index.search(numbers)
    size = high - low
    which = np.repeat(np.arange(len(windows)), size)
    suffix = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
    parts = [index.locate(suffix[i:i + FOLLOW]) for i in range(0, len(suffix), FOLLOW)]
    return np.concatenate([*parts, np.zeros(0, np.int64)]), which


HITS = "row_id long, doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,length:long>>"


def _hits(index: DataFrame, block, window: int) -> DataFrame:
    """Hits of one broadcast block of items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        windows, held = windows_of(*block.value, window)
        lengths = np.array([len(w) for w in windows], np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                stored = batch.slice(i, 1).to_pylist()[0]
                own = Index(stored)
                at, which = _found(own, windows, window)
                n = int((own.sizes + 1).sum())
                marks = np.zeros(n + 1, np.int64)
                np.add.at(marks, at, 1)
                np.add.at(marks, at + lengths[which], -1)
                hit = np.concatenate(([0], (np.cumsum(marks[:n]) > 0).astype(np.int64), [0]))
                edge = np.flatnonzero(np.diff(hit))
                first, stop = edge[::2], edge[1::2]
                text = np.searchsorted(own.starts, first, side="right") - 1
                spans, items = defaultdict(list), defaultdict(set)
                for t, a, b in zip(text.tolist(), (first - own.starts[text]).tolist(), (stop - first).tolist(), strict=True):
                    spans[t].append({"start": a, "length": b})
                pairs = np.unique((np.searchsorted(own.starts, at, side="right") - 1) * max(1, len(windows)) + which)
                for t, w in zip((pairs // max(1, len(windows))).tolist(), (pairs % max(1, len(windows))).tolist(), strict=True):
                    items[t].update(held[w])
                of = stored["text_of"]
                yield {"row_id": stored["row_id"], "doc_id": stored["doc_id"], "n_words": own.sizes[of],
                       "n_hit": [sum(s["length"] for s in spans.get(t, ())) for t in of],
                       "items": [sorted(items.get(t, ())) for t in of], "spans": [spans.get(t, []) for t in of]}

    return map_arrow(index.drop("shard"), run, HITS)


def merged_spans(spans: str) -> F.Column:
    """Overlapping or touching spans of an array column as one each."""
    def add(done, span):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (span["start"] <= F.try_add(last["start"], last["length"]))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["start"].alias("start"), (F.greatest(last["start"] + last["length"], span["start"] + span["length"]) - last["start"]).alias("length"))))
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.expr("cast(array() as array<struct<start:long,length:long>>)"), add)


def contaminated(docs: DataFrame, items: DataFrame, window: int = 10, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per (doc_id, text) row: row_id (see ``numbered``), doc_id, n_words,
    n_hit (words inside occurrences), items (ids with an occurring window, as
    text, sorted), spans (start and length, in words, of what to remove)."""
    sc = docs.sparkSession.sparkContext
    index = shards(docs, shard_bytes)
    blocks = item_blocks(items, window, block_bytes)
    several = blocks.count() > 1
    results = []
    for row in blocks.toLocalIterator():
        found = _hits(index, sc.broadcast((row["item_ids"], [bytes(t) for t in row["texts"]])), window)
        results.append(written(found, "hits") if several else found)
    if not several:
        return results[0] if results else _hits(index, sc.broadcast(([], [])), window)
    every = results[0]
    for r in results[1:]:
        every = every.unionByName(r)
    spans = merged_spans("spans")
    joined = every.groupBy("row_id").agg(
        F.min("doc_id").alias("doc_id"), F.min("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))
    return joined.withColumn("spans", spans).select(
        "row_id", "doc_id", "n_words", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"]).alias("n_hit"), "items", "spans")
