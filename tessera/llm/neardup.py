"""Near-duplicate groups by SetSketch registers.

A document's set is its distinct shingles of ``WORDS`` words. Its sketch has
``BANDS * ROWS`` registers: the smallest of the shingles' values under a hash
of the register's own, made exponential, on a logarithmic scale of base
``BASE``, truncated to 16 bits. Sketches of parts merge by the larger
register, and two registers are equal with a probability close to the
similarity of the sets. Registers are banded into buckets; documents that
share a bucket are candidates. Of a candidate pair the likelihood of the
registers that are larger, smaller and equal gives an estimate of the
similarity; pairs far below the threshold go, and the others are confirmed on
their full sets.

Documents with the same set are one node. Buckets are settled without listing
the pairs in them. First every member meets one center of its bucket, which
joins groups of copies whatever their size. Where a bucket then still holds
several components, their members' sketches are compared in blocks of about
``BLOCK`` against ``BLOCK`` members; pairs of different components with a near
enough estimate are confirmed there and join their components, so fewer links
come out than members went in. Every member thus meets every other one of its
bucket or is in its component.

Defined results: a text without a word (null, empty) has an empty set, is
linked with nothing and is kept; a text of fewer words is one shingle;
component_id is the smallest id of a component (nulls do not count; null if
there is no other) and kept says that the row has that id, so repeated rows of
one id are kept together; an empty table gives an empty result; other columns
are ignored. ``docs`` must be a scan of stored files (its rows are numbered
twice).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, SpanHash, map_arrow, mix64, numbered, slices, text_bytes, written

WORDS = 5
BANDS, ROWS = 24, 6
BASE, RATE = 1.001, 20.0
LIMIT = 2**16 - 1
#: Estimates this far below the threshold are over four standard errors off.
SLACK = 0.13
BLOCK = 512

_random = np.random.default_rng(20240607)
FACTORS = _random.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _random.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
BAND_FACTORS = _random.integers(0, 2**62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_hash = SpanHash()


def shingles(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    split = [t.translate(LOWER).split() for t in texts]
    data = np.frombuffer(b"".join(b" ".join(w) + b"\n" for w in split if w), np.uint8)
    stops = np.flatnonzero((data == 32) | (data == 10))
    starts = np.concatenate(([0], stops[:-1] + 1)) if len(stops) else stops
    first, last, sizes, at = [], [], [], 0
    for words in split:
        n = len(words)
        if n:
            wide = min(WORDS, n)
            first.append(starts[at:at + n - wide + 1])
            last.append(stops[at + wide - 1:at + n])
            at += n
        sizes.append(max(0, n - WORDS + 1) if n >= WORDS else min(n, 1))
    if not first:
        return [np.zeros(0, np.uint64)] * len(texts)
    hashes = _hash.spans(data, np.concatenate(first), np.concatenate(last))
    return [np.unique(h) for h in np.split(hashes, np.cumsum(sizes)[:-1])]


def sketch(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of hashes."""
    values = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(FACTORS), 2**32 - 1, np.uint32)
    for at in range(0, len(values), 256):
        np.minimum(least, (values[at:at + 256, None] * FACTORS + SHIFTS).min(axis=0), out=least)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / math.log(BASE)), 0, LIMIT).astype("<u2")


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of a union."""
    return np.maximum(a, b)


def buckets(registers: np.ndarray) -> np.ndarray:
    """A bucket per band of each sketch (a row)."""
    mixed = (registers.astype(np.uint64) * BAND_FACTORS).reshape(len(registers), BANDS, ROWS).sum(axis=2, dtype=np.uint64)
    return mix64(mixed + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, steps: int = 101) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sketches (rows) of sets of
    known sizes, on a grid."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u = size_a / (size_a + size_b)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    grid = most[:, None] * np.linspace(0, 1, steps)

    def chance(x):
        return np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE), 1e-9, 1.0)

    larger, smaller = chance(u[:, None] - v[:, None] * grid), chance(v[:, None] - u[:, None] * grid)
    rest = np.clip(1 - larger - smaller, 1e-9, 1)
    fit = above[:, None] * np.log(larger) + below[:, None] * np.log(smaller) + equal[:, None] * np.log(rest)
    return grid[np.arange(len(grid)), fit.argmax(axis=1)]


def sketches(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, n_shingles, node (hash of
    the set; null if it is empty), registers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingles(part.column("text").to_pylist())
                yield {c: part.column(c) for c in ("row_id", "doc_id")} | {
                    "n_shingles": [len(s) for s in sets],
                    "node": [node_of(s) if len(s) else None for s in sets],
                    "registers": [sketch(s).tobytes() if len(s) else None for s in sets]}

    rows = numbered(docs.select("doc_id", "text")).select("row_id", F.col("doc_id").cast("long"), text_bytes().alias("text"))
    return map_arrow(rows, run, "row_id long, doc_id long, n_shingles long, node long, registers binary")


def node_of(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest of its component) for the ends of (a, b)
    edges, by alternating large-star and small-star steps."""
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = written(small.select("e.u", "e.v").where("u != v").distinct(), "edges")
        before, state = state, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _settled(percent: int):
    """Links (a, b) between components, from rows sorted by (bucket, low,
    high), the pair of blocks they are in: at most one less than the rows."""
    least = percent / 100 - SLACK

    def shared(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        every = np.concatenate(others)
        at = np.minimum(np.searchsorted(own, every), len(own) - 1)
        starts = np.cumsum([0] + [len(o) for o in others[:-1]])
        return np.add.reduceat((own[at] == every).astype(np.int64), starts)

    def links(node, root, band, block, registers, sets) -> list[tuple[int, int]]:
        size = np.array([len(s) for s in sets])
        group = np.unique(root, return_inverse=True)[1]
        inside = (block == block[0]).all()
        out = []
        for i in range(len(node) - 1):
            others = slice(i + 1, None)
            same = registers[others] == registers[i]
            near = same.sum(axis=1) >= (least - 0.02) * registers.shape[1]
            near &= (group[others] != group[i]) & (inside | (block[others] != block[i]))
            near &= 100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i])
            at = np.flatnonzero(near)
            # A pair is confirmed in the first of the buckets it shares.
            at = at[same[at].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band[i]] + i + 1
            if not len(at):
                continue
            at = at[estimate(registers[at], np.broadcast_to(registers[i], registers[at].shape),
                             size[at].astype(float), np.full(len(at), float(size[i]))) >= least]
            for some in range(0, len(at), 64):
                left = [j for j in at[some:some + 64].tolist() if group[j] != group[i]]
                if not left:
                    continue
                both = shared(sets[i], [sets[j] for j in left])
                for j, n in zip(left, both.tolist(), strict=True):
                    if group[j] != group[i] and 100 * n >= percent * (size[i] + size[j] - n):
                        out.append((int(min(node[i], node[j])), int(max(node[i], node[j]))))
                        group[group == group[j]] = group[i]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        keys, names = ("bucket", "low", "high"), ("node", "root", "band", "block", "registers", "shingles")
        held: list[tuple] = []
        now = None

        def found() -> dict:
            node, root, band, block, registers, sets = zip(*held, strict=True)
            out = links(np.array(node), np.array(root), np.array(band), np.array(block),
                        np.frombuffer(b"".join(registers), "<u2").reshape(len(node), -1), sets)
            return {"a": [a for a, _ in out], "b": [b for _, b in out]}

        for batch in batches:
            sets = batch.column("shingles")
            if not batch.num_rows:
                continue
            flat, ends = sets.flatten().to_numpy(), np.cumsum(sets.value_lengths().to_numpy())
            columns = [batch.column(c).to_pylist() for c in (*keys, *names[:-1])]
            for *row, values in zip(*columns, np.split(flat, ends[:-1]), strict=True):
                if row[:3] != now and held:
                    yield found()
                    held = []
                now = row[:3]
                held.append((*row[3:], values))
        if held:
            yield found()

    return run


def _links(nodes: DataFrame, sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Component roots (node, root) of all nodes that have a link."""
    known = written(nodes.select("node", F.col("n_shingles").alias("n"), "registers")
                    .join(members.select("node").distinct(), "node"), "known")

    def linked(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) confirmed on their full sets."""
        shared = F.size(F.array_intersect("sa", "sb"))
        return written(pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
                       .where(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b"), "links")

    # First every member meets one center of its bucket.
    centers = members.groupBy("bucket").agg(F.min("node").alias("center"))
    sizes = known.select("node", "n")
    first = (members.join(centers, "bucket").where("node != center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
             .join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
             .where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b"))
    links = linked(first)
    roots = components(links)
    # Then, where a bucket still holds several components, those meet.
    rows = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = (rows.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("members"))
             .where("least != most").select("bucket", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")))
    met = (rows.join(open_, "bucket").join(known, "node").join(sets, "node")
           .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                   "node", "root", "band", "block", "registers", "shingles"))
    found = map_arrow(met.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high"),
                      _settled(percent), "a long, b long")
    return components(links.union(found))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Per (doc_id, text) row: doc_id, row_id (see ``numbered``), n_shingles,
    component_id, kept, and first (true for one row of each component). Linked
    are sets with 100 * shared >= percent * union."""
    rows = written(sketches(docs), "sketches")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id"))
    nodes = written(rows.where("node is not null").groupBy("node").agg(
        least.alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
        .withColumn("row_id", F.col("least.row_id")), "nodes")

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            registers = np.frombuffer(b"".join(batch.column("registers").to_pylist()), "<u2").reshape(batch.num_rows, -1)
            yield {"node": batch.column("node"), "buckets": list(buckets(registers))}

    every = map_arrow(nodes.select("node", "registers"), banded, "node long, buckets array<long>").select(
        "node", F.posexplode("buckets").alias("band", "bucket"))
    several = every.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high").select("bucket")
    members = written(every.join(several, "bucket").select("bucket", "band", "node"), "members")
    wanted = members.select("node").distinct().join(nodes.select("node", "row_id"), "node").select("row_id", "node")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield {"node": part.column("node"), "shingles": [np.sort(s.view(np.int64)) for s in shingles(part.column("text").to_pylist())]}

    texts = numbered(docs.select(text_bytes().alias("text"))).join(wanted, "row_id")
    sets = written(map_arrow(texts.select("node", "text"), full, "node long, shingles array<long>"), "sets")
    roots = _links(nodes, sets, members, percent)
    rooted = nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("of"))
    of = rooted.join(smallest, "root").select("node", "of")
    alone = F.col("node").isNull()
    return (rows.drop("registers").join(of, "node", "left")
            .withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("of.doc_id")))
            .select("doc_id", "row_id", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
                    (alone | (F.col("row_id") == F.col("of.row_id"))).alias("first")))
