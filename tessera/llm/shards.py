"""Per-document scores from corpus-wide n-gram tables of any size.

The tables of an n-gram model grow with the corpus, so they are neither
collected nor broadcast. The texts are stored in chunks of bounded bytes. Each
chunk asks once for each of its distinct keys, in one row per shard of the key
space, and each shard adds the counts up. The model turns counts into values;
each shard answers the rows it was asked, one by one; and the answers go back
to their chunk, where they are looked up for every position.

There are as many shards as chunks, but not more than the session has shuffle
partitions, so rows grow with the text and not with its square. A shard is one
task of any size: sums beyond ``HELD_KEYS`` keys become sorted runs in files of
the task, merged range by range, and values are looked up in a file.

A text is stored as its words, one space between them and one end byte, after
``order - 1`` end bytes of context. Texts beyond a chunk are cut between
words, each piece with its left context; a word beyond a chunk is cut too where
words are not looked up, and is a piece of its own where they are. Words are
known by 64-bit hashes.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import BLOCK_BYTES, KeyTable, SpanHash, byte_grams, map_arrow, slices, text_bytes, written

CHUNK_BYTES = 16 << 20
#: Keys whose sums a task holds in memory.
HELD_KEYS = 4 << 20
SPACE, END = 32, 10
#: Word keys are negative, gram keys are not.
WORD_BIT = np.int64(-(2**63))


def _cut(body: bytes, pad: int, limit: int, whole_words: bool) -> Iterator[bytes]:
    """Pieces of a text after ``pad`` bytes, cut after spaces, with context."""
    at = pad
    while len(body) - at > limit:
        end = body.rfind(b" ", at, at + limit) + 1
        if not end:
            end = body.find(b" ", at) + 1 if whole_words else at + limit
        if not end:
            break
        yield body[at - pad:end]
        at = end
    yield body[at - pad:]


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return np.mod(keys ^ (keys >> 13) ^ (keys >> 29), shards)


def shard_column(key: str, shards: int) -> Column:
    """``shard_of`` as a column."""
    return F.expr(f"cast(pmod({key} ^ shiftright({key}, 13) ^ shiftright({key}, 29), {shards}) as int)")


class Positions:
    """The grams, and the words if asked for, of some pieces in a row."""

    hashes = SpanHash()

    def __init__(self, bodies: list[bytes], order: int, with_words: bool) -> None:
        pad = order - 1
        data = np.frombuffer(b"".join(bodies), np.uint8)
        sizes = np.array([len(b) for b in bodies], np.int64)
        ends = np.cumsum(sizes)
        #: Gram i ends at byte pad + i; a piece's own grams are [first, last).
        self.first, self.last = ends - sizes, ends - pad
        self.grams = byte_grams(data, order)
        self.own = np.ones(len(self.grams), bool)
        for end in ends[:-1].tolist():
            self.own[end - pad:end] = False
        if with_words:
            self._words(data, ends - sizes + pad, ends)

    def _words(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        """Spans of the words and of the end token, which is its own byte."""
        starts, stops, self.counts = [], [], []
        cuts = np.flatnonzero((data == SPACE) | (data == END))
        lows, highs = np.searchsorted(cuts, begins), np.searchsorted(cuts, ends)
        for begin, end, low, high in zip(begins.tolist(), ends.tolist(), lows.tolist(), highs.tolist(), strict=True):
            stop = cuts[low:high]
            start = np.concatenate(([begin], stop[:-1] + 1))
            if data[end - 1] == END:
                if start[-1] == stop[-1]:
                    stop = np.concatenate((stop[:-1], [end]))
                else:
                    start, stop = np.concatenate((start, [end - 1])), np.concatenate((stop, [end]))
            starts.append(start)
            stops.append(stop)
            self.counts.append(len(start))
        self.words = (self.hashes.spans(data, np.concatenate(starts), np.concatenate(stops)).view(np.int64) | WORD_BIT
                      if starts else np.zeros(0, np.int64))

    @staticmethod
    def _sums(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        if not len(first):
            return np.zeros(0)
        cuts = np.column_stack((first, last)).ravel()
        return np.where(last > first, np.add.reduceat(np.append(values, 0.0), cuts)[::2], 0.0)

    def gram_sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per gram over each piece."""
        return self._sums(values, self.first, self.last)

    def word_sums(self, values: np.ndarray) -> np.ndarray:
        at = np.concatenate(([0], np.cumsum(self.counts))).astype(np.int64)
        return self._sums(values, at[:-1], at[1:])


_codec = pa.Codec("zstd", compression_level=3)
#: Texts are written once and sent once more, so they are worth more effort.
_text_codec = pa.Codec("zstd", compression_level=9)


def squeezed(data: bytes) -> bytes:
    return _codec.compress(data, asbytes=True)


def expanded(data: bytes, size: int) -> bytes:
    return _codec.decompress(data, size, asbytes=True)


def packed(values: np.ndarray) -> bytes:
    """Numbers as their differences, byte plane by byte plane, compressed."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return squeezed(np.ascontiguousarray(steps.view(np.uint8).reshape(len(values), -1).T).tobytes())


def unpacked(data: bytes, dtype: type, n: int) -> np.ndarray:
    planes = np.frombuffer(expanded(data, n * np.dtype(dtype).itemsize), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(-1, n).T).view(dtype).ravel(), dtype=dtype)


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def planes(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    return squeezed(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())


def from_planes(data: bytes, dtype: type, n: int) -> np.ndarray:
    rows = np.frombuffer(expanded(data, n * np.dtype(dtype).itemsize), np.uint8).reshape(np.dtype(dtype).itemsize, n)
    return np.ascontiguousarray(rows.T).view(dtype).ravel()


class Tally:
    """Sums of counts by key. Beyond ``held`` keys the sums go to ``folder`` as
    sorted runs."""

    def __init__(self, folder: str, held: int = HELD_KEYS) -> None:
        self.folder, self.limit = folder, max(2, held)
        self.keys: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.counts: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.held, self.runs = 0, 0

    def add(self, key: np.ndarray, n: np.ndarray) -> None:
        self.keys.append(key)
        self.counts.append(n)
        self.held += len(key)
        if self.held > self.limit:
            key, n = added(self.keys, self.counts)
            if len(key) > self.limit // 2:
                np.save(os.path.join(self.folder, f"key-{self.runs}.npy"), key)
                np.save(os.path.join(self.folder, f"n-{self.runs}.npy"), n)
                self.runs += 1
                key, n = key[:0], n[:0]
            self.keys, self.counts, self.held = [key], [n], len(key)

    def sums(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Keys in order with their sums, range by range."""
        runs = [[np.load(os.path.join(self.folder, f"{what}-{i}.npy"), mmap_mode="r") for what in ("key", "n")] for i in range(self.runs)]
        runs.append(list(added(self.keys, self.counts)))
        step = max(1, self.limit // len(runs))
        cuts = np.unique(np.concatenate([key[step::step] for key, _ in runs]))
        ends = [np.concatenate(([0], np.searchsorted(key, cuts), [len(key)])) for key, _ in runs]
        for i in range(len(cuts) + 1):
            parts = [(key[end[i]:end[i + 1]], n[end[i]:end[i + 1]]) for (key, n), end in zip(runs, ends, strict=True)]
            yield added(*map(list, zip(*parts, strict=True)))


#: What a chunk knows of each piece besides its text.
CARRIED = ("row", "doc_id", "row_id", "tag", "train")


class Chunk:
    """Some texts: one stored row."""

    SCHEMA = ("chunk long, row array<long>, doc_id array<long>, row_id array<long>, tag array<string>, train array<boolean>, size array<long>, "
              "bytes long, body binary")

    def __init__(self, stored: dict, order: int, with_words: bool) -> None:
        self.id, self.order, self.with_words = stored["chunk"], order, with_words
        self.rows = {c: stored[c] for c in CARRIED}
        self.train = np.array(stored["train"], bool)
        self.ends = np.cumsum(np.array(stored["size"], np.int64))
        self.body = expanded(stored["body"], stored["bytes"])

    @staticmethod
    def store(chunk: int, rows: list[tuple]) -> dict:
        *carried, pieces = zip(*rows, strict=True)
        body = b"".join(pieces)
        return {"chunk": [chunk]} | {c: [v] for c, v in zip(CARRIED, carried, strict=True)} | {
                "size": [[len(p) for p in pieces]],
                "bytes": [len(body)], "body": [_text_codec.compress(body, asbytes=True)]}

    def parts(self) -> Iterator[tuple[np.ndarray, Positions]]:
        """Positions of about ``BLOCK_BYTES`` at a time, with their pieces."""
        starts = np.concatenate(([0], self.ends[:-1]))
        at = 0
        while at < len(self.ends):
            end = max(at + 1, int(np.searchsorted(self.ends, starts[at] + BLOCK_BYTES, side="right")))
            yield np.arange(at, end), Positions([self.body[a:b] for a, b in zip(starts[at:end].tolist(), self.ends[at:end].tolist(), strict=True)],
                                                self.order, self.with_words)
            at = end

    def keys(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys by (shard, key), their shards, how often they train."""
        keys, counts = [], []
        for pieces, own in self.parts():
            trains = [(own.grams, np.repeat(self.train[pieces], own.last - own.first), own.own)]
            if self.with_words:
                trains.append((own.words, np.repeat(self.train[pieces], own.counts), None))
            for found, train, mask in trains:
                found = found if mask is None else found[mask]
                for some, weight in ((found[train], 1), (found[~train], 0)):
                    key, n = np.unique(some, return_counts=True)
                    keys.append(key)
                    counts.append(n * weight)
        key, n = added(keys, counts)
        place = shard_of(key, shards)
        by = np.argsort(place, kind="stable")
        return key[by], place[by], n[by]


class Corpus:
    """Texts stored in chunks, cut into words by ``words``, for grams of
    ``order`` bytes. Rows have doc_id, text and train (whether the text counts
    in the statistics), and may have tag, a string, and row_id, a number, that
    are carried along."""

    def __init__(self, docs: DataFrame, words: Callable[[bytes], list[bytes]], order: int, with_words: bool,
                 chunk_bytes: int = CHUNK_BYTES, held_keys: int = HELD_KEYS) -> None:
        self.order, self.with_words, self.held_keys = order, with_words, held_keys
        if "tag" not in docs.columns:
            docs = docs.withColumn("tag", F.lit(None).cast("string"))
        if "row_id" not in docs.columns:
            docs = docs.withColumn("row_id", F.lit(None).cast("long"))
        docs = docs.select(F.col("doc_id").cast("long"), "row_id", "tag", "train", text_bytes().alias("text"))
        self.chunks = self._store(docs, words, chunk_bytes)
        total = self.chunks.agg(F.sum("bytes").alias("n")).first()["n"] or 0
        most = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.shards = max(1, min(most, -(-total // chunk_bytes)))

    def _store(self, docs, words, chunk_bytes) -> DataFrame:
        pad, whole_words = self.order - 1, self.with_words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            chunk = row = TaskContext.get().partitionId() << 40
            held: list[tuple] = []
            filled = 0
            for batch in batches:
                for part in slices(batch, "text"):
                    for doc, row_id, tag, train, text in zip(*(part.column(c).to_pylist() for c in (*CARRIED[1:], "text")), strict=True):
                        for piece in _cut(b"\n" * pad + b" ".join(words(text)) + b"\n", pad, chunk_bytes, whole_words):
                            if held and filled + len(piece) > chunk_bytes:
                                yield Chunk.store(chunk, held)
                                chunk, held, filled = chunk + 1, [], 0
                            held.append((row, doc, row_id, tag, bool(train), piece))
                            filled += len(piece)
                        row += 1
            if held:
                yield Chunk.store(chunk, held)

        return written(map_arrow(docs, run, Chunk.SCHEMA), "chunks")

    def _asked(self) -> DataFrame:
        """chunk, shard, n, keys, counts (occurrences that train)."""
        order, with_words, shards = self.order, self.with_words, self.shards

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    chunk = Chunk(batch.slice(i, 1).to_pylist()[0], order, with_words)
                    key, place, n = chunk.keys(shards)
                    cuts = np.flatnonzero(np.diff(place)) + 1
                    lists = np.split(key, cuts)
                    yield {"chunk": [chunk.id] * len(lists), "shard": place[np.concatenate(([0], cuts))],
                           "n": [len(x) for x in lists], "keys": [packed(x) for x in lists],
                           "counts": [packed(x.astype(np.int32)) for x in np.split(n, cuts)]}

        return map_arrow(self.chunks, run, "chunk long, shard int, n int, keys binary, counts binary")

    def counts(self) -> DataFrame:
        """Every key once: shard, key, n (0 for keys that never train)."""
        held = self.held_keys

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            with tempfile.TemporaryDirectory() as folder:
                tally, shard = Tally(folder, held), None
                for batch in batches:
                    for shard, n, key, count in zip(*(batch.column(c).to_pylist() for c in ("shard", "n", "keys", "counts")), strict=True):
                        tally.add(unpacked(key, np.int64, n), unpacked(count, np.int32, n).astype(np.int64))
                for key, n in tally.sums():
                    yield {"shard": np.full(len(key), shard if len(key) else 0, np.int32), "key": key, "n": n}

        return written(map_arrow(self._asked().repartitionById(self.shards, "shard"), run, "shard int, key long, n long"), "counts")

    def scores(self, values: DataFrame, word_value: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
        """Per input row: row, doc_id, row_id, tag, train, n_bytes, gram_score and, with
        words, n_tokens, n_known, word_score. ``values`` has, for every key,
        shard, key and value: of a gram its score, of a word its count, which
        ``word_value`` turns into a score."""
        order, with_words, shards = self.order, self.with_words, self.shards

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            """The values come first, in order of their keys."""
            with tempfile.TemporaryDirectory() as folder:
                paths = [os.path.join(folder, name) for name in ("key", "value")]
                with open(paths[0], "wb") as keys, open(paths[1], "wb") as numbers:
                    key, value = np.zeros(0, np.int64), np.zeros(0)
                    for batch in batches:
                        n_values = batch.column("chunk").null_count
                        if n_values:
                            keys.write(batch.column("key")[:n_values].to_numpy().tobytes())
                            numbers.write(batch.column("value")[:n_values].to_numpy().tobytes())
                        asked = batch.slice(n_values)
                        if not asked.num_rows:
                            continue
                        if not len(key):
                            keys.flush()
                            numbers.flush()
                            key, value = np.memmap(paths[0], np.int64, "r"), np.memmap(paths[1], np.float64, "r")
                        for chunk, shard, n, b in zip(*(asked.column(c).to_pylist() for c in ("chunk", "shard", "n", "keys")), strict=True):
                            wanted = unpacked(b, np.int64, n)
                            found = value[np.searchsorted(key, wanted)]
                            yield {"chunk": [chunk], "shard": [shard], "counts": [planes(found[wanted < 0].astype(np.int64))],
                                   "scores": [planes(found[wanted >= 0].astype(np.float32))]}

        asked = self._asked().select("chunk", "shard", "n", "keys")
        both = asked.unionByName(values.select("shard", "key", F.col("value").cast("double").alias("value")), allowMissingColumns=True)
        answers = map_arrow(both.repartitionById(shards, "shard").sortWithinPartitions("chunk", "key"), answer,
                            "chunk long, shard int, counts binary, scores binary")
        schema = ("row long, doc_id long, row_id long, tag string, train boolean, n_bytes long, gram_score double, "
                  "n_tokens long, n_known long, word_score double")
        target = to_arrow_schema(T.StructType.fromDDL(schema))

        def score(left: pa.Table, right: pa.Table) -> pa.Table:
            chunk = Chunk(left.to_pylist()[0], order, with_words)
            key, place, _ = chunk.keys(shards)
            value = np.zeros(len(key))
            for row in right.to_pylist():
                low, high = np.searchsorted(place, (row["shard"], row["shard"] + 1))
                words = int(np.searchsorted(key[low:high], 0))
                value[low:low + words] = from_planes(row["counts"], np.int64, words)
                value[low + words:high] = from_planes(row["scores"], np.float32, high - low - words)
            table = KeyTable(key)
            parts = []
            for pieces, own in chunk.parts():
                columns = {c: [v[i] for i in pieces] for c, v in chunk.rows.items()}
                columns["n_bytes"] = own.last - own.first
                columns["gram_score"] = own.gram_sums(np.where(own.own, value[table.find(own.grams)], 0.0))
                none = np.zeros(len(pieces))
                counts = value[table.find(own.words)] if with_words else none
                columns["n_tokens"] = np.array(own.counts) if with_words else none.astype(np.int64)
                columns["n_known"] = (own.word_sums((counts > 0).astype(float)) if with_words else none).astype(np.int64)
                columns["word_score"] = own.word_sums(word_value(counts)) if with_words else none
                parts.append(pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in target], schema=target))
            return pa.Table.from_batches(parts, target)

        scored = self.chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)
        return scored.groupBy("row").agg(
            *[F.min(c).alias(c) for c in CARRIED[1:]],
            *[F.sum(c).alias(c) for c in ("n_bytes", "gram_score", "n_tokens", "n_known", "word_score")])
