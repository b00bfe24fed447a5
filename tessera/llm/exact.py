"""Exact deduplication by Grace hashing.

Texts are equal when identical after replacing each run of space and
0x09-0x0D by one space. Two passes:

1. every scan task combines its own copies in blocks of bounded bytes (an
   open-addressing table over the complete content), so a text that makes a
   third of all rows leaves each block once;
2. the surviving records are shuffled by digest. A task keeps a table of
   distinct contents; once that outgrows its memory limit, the records go to
   spill files by the next digest bits, and each file is treated the same way.
   Records of a digest that more than ``FOLD`` blocks hold are first settled in
   salted groups of about ``FOLD``, again until no more are left, so no task
   reads all copies of a hot text.

Equality is always decided on whole contents; the digest only places records.

Defined results: a null text counts as empty; null ids sort after all others
(a group of nulls only has keep_id null); of rows that share the smallest id
exactly one is kept; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow, numbered, slices, text_bytes, written

COMBINE_BYTES = 16 << 20
TABLE_BYTES = 48 << 20
FANOUT_BITS = 4
FOLD = 64
#: Hot digests up to this many are sent to every task, about 100 MB.
SENT_DIGESTS = 1_000_000
LAST = 1 << 63  # after every id


def normalise(text: bytes) -> bytes:
    """Each run of ASCII white space becomes one space."""
    words = text.split()
    if not words:
        return b" " if text else b""
    lead = b" " if text[:1].isspace() else b""
    return lead + b" ".join(words) + (b" " if text[-1:].isspace() else b"")


class ContentTable:
    """Open addressing with linear probing over complete contents."""

    def __init__(self) -> None:
        self.slots = [-1] * 256
        self.digests: list[bytes] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def place(self, digest: bytes, content: bytes) -> int:
        """The group of a content, a new one if it is not there yet."""
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (group := self.slots[at]) >= 0:
            if self.digests[group] == digest and self.contents[group] == content:
                return group
            at = (at + 1) & mask
        group = self.slots[at] = len(self.contents)
        self.digests.append(digest)
        self.contents.append(content)
        self.bytes += len(content) + 200
        if 2 * len(self.contents) > len(self.slots):
            self._double()
        return group

    def _double(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for group, digest in enumerate(self.digests):
            at = int.from_bytes(digest[-8:], "little") & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = group


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Pass 1: rows with their local group; the first of a group carries the
    content, the group's smallest id and its size."""
    task, seen = TaskContext.get().partitionId() << 40, 0

    def flush(table, rows):  # rows: (doc, row_id, group)
        nonlocal seen
        best: dict[int, tuple[int, int]] = {}
        sizes = [0] * len(table.contents)
        for i, (doc, _, group) in enumerate(rows):
            sizes[group] += 1
            key = (LAST if doc is None else doc, i)
            if group not in best or key < best[group]:
                best[group] = key
        chosen = {i for _, i in best.values()}
        yield {
            "doc_id": [doc for doc, _, _ in rows],
            "row_id": [row for _, row, _ in rows],
            "text_sha256": [table.digests[g].hex() for *_, g in rows],
            "local": [task + seen + g for *_, g in rows],
            "first": [i in chosen for i in range(len(rows))],
            "content": [table.contents[g] if i in chosen else None for i, (*_, g) in enumerate(rows)],
            "size": [sizes[g] if i in chosen else None for i, (*_, g) in enumerate(rows)],
        }
        seen += len(table.contents)

    table, rows = ContentTable(), []
    for batch in batches:
        for part in slices(batch, "text"):
            for doc, row, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "row_id", "text")), strict=True):
                content = normalise(text)
                rows.append((doc, row, table.place(hashlib.sha256(content).digest(), content)))
            if table.bytes > COMBINE_BYTES or len(rows) > 200_000:
                yield from flush(table, rows)
                table, rows = ContentTable(), []
    if rows:
        yield from flush(table, rows)


class _Spill:
    """Records of one level, dealt to files by the next digest bits."""

    def __init__(self, folder: str, level: int) -> None:
        self.shift = level * FANOUT_BITS
        self.paths = [os.path.join(folder, f"{level}-{i}-{len(os.listdir(folder))}") for i in range(1 << FANOUT_BITS)]
        self.files = [open(p, "wb") for p in self.paths]

    def add(self, record: tuple) -> None:
        bits = int.from_bytes(record[0][:8], "big") >> self.shift
        pickle.dump(record, self.files[bits & ((1 << FANOUT_BITS) - 1)], protocol=5)

    def read(self) -> Iterator[Iterator[tuple]]:
        for f in self.files:
            f.close()
        for path in self.paths:
            yield self._records(path)
            os.remove(path)

    @staticmethod
    def _records(path: str) -> Iterator[tuple]:
        with open(path, "rb") as f:
            while True:
                try:
                    yield pickle.load(f)
                except EOFError:
                    return


def grace(records: Iterable[tuple], folder: str, limit: int, level: int = 0) -> Iterator[tuple[bytes, bytes, list[tuple]]]:
    """Groups of (digest, content, id, size, local) records with equal
    content: digest, content and a list of (id, size, local)."""
    table, members, spill = ContentTable(), [], None
    for record in records:
        if spill is None:
            group = table.place(record[0], record[1])
            if group == len(members):
                members.append([])
            members[group].append(record[2:])
            if table.bytes > limit and len(table.contents) > 1 and (level + 1) * FANOUT_BITS <= 64:
                spill = _Spill(folder, level)
                for digest, content, group in zip(table.digests, table.contents, members, strict=True):
                    for member in group:
                        spill.add((digest, content, *member))
                table, members = None, []
        else:
            spill.add(record)
    if spill is None:
        yield from zip(table.digests, table.contents, members, strict=True)
    else:
        for bucket in spill.read():
            yield from grace(bucket, folder, limit, level + 1)


def _settle(limit: int, contents: bool = False):
    """One row per record: its local group, the local group of the record that
    wins (head), and the smallest id and the size of its content's group;
    winners carry the digest and the content if ``contents``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        def records():
            for batch in batches:
                for part in slices(batch, "content"):
                    for row in zip(*(part.column(c).to_pylist() for c in ("text_sha256", "content", "doc_id", "size", "local")), strict=True):
                        yield (bytes.fromhex(row[0]), *row[1:])

        out: dict[str, list] = {c: [] for c in ("local", "head", "keep_id", "group_size", "text_sha256", "content")}
        held = 0
        with tempfile.TemporaryDirectory() as folder:
            for digest, content, group in grace(records(), folder, limit):
                winner = min(group, key=lambda m: (LAST if m[0] is None else m[0], m[2]))
                size = sum(m[1] for m in group)
                for member in group:
                    wins = member is winner and contents
                    out["local"].append(member[2])
                    out["head"].append(winner[2])
                    out["keep_id"].append(winner[0])
                    out["group_size"].append(size)
                    out["text_sha256"].append(digest.hex() if wins else None)
                    out["content"].append(content if wins else None)
                held += len(content) if contents else 0
                if len(out["local"]) >= 50_000 or held > COMBINE_BYTES:
                    held = 0
                    yield out
                    out = {k: [] for k in out}
        if out["local"]:
            yield out
    return run


def _settled(records: DataFrame, limit: int, fold: int) -> DataFrame:
    """local, keep_id, group_size, wins (whether its record stays) of the
    records (doc_id, text_sha256, local, content, size)."""
    shape = "local long, head long, keep_id long, group_size long, text_sha256 string, content binary"
    folds = []
    while True:
        hot = written(records.groupBy("text_sha256").agg(F.count("*").alias("n")).where(F.col("n") > fold)
                      .select("text_sha256", F.ceil(F.col("n") / fold).alias("salts")), "exact-hot")
        many = hot.count()
        if not many:
            break
        if many <= SENT_DIGESTS:
            hot = F.broadcast(hot)
        salted = records.join(hot, "text_sha256").withColumn("salt", F.pmod(F.xxhash64("local"), F.col("salts")))
        folded = written(map_arrow(salted.repartition("text_sha256", "salt").select("doc_id", "text_sha256", "local", "content", "size"),
                                   _settle(limit, contents=True), shape), "exact-fold")
        folds.append(folded.where("local != head").select(F.col("local").alias("member"), "head"))
        heads = folded.where("local = head").select(F.col("keep_id").alias("doc_id"), "text_sha256", "local", "content",
                                                    F.col("group_size").alias("size"))
        records = records.join(hot, "text_sha256", "left_anti").unionByName(heads)
    out = (map_arrow(records.repartition("text_sha256"), _settle(limit), shape)
           .select("local", "keep_id", "group_size", (F.col("local") == F.col("head")).alias("wins")))
    if folds:
        out = written(out, "exact-settled")
    for members in reversed(folds):
        out = out.unionByName(members.join(out, F.col("head") == F.col("local"))
                              .select(F.col("member").alias("local"), "keep_id", "group_size", F.lit(False).alias("wins")))
    return out


def exact_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES, fold: int = FOLD) -> DataFrame:
    """Per (doc_id, text) row: doc_id, row_id (see ``numbered``), keep_id (the
    id of the row that stays), group_size, kept, text_sha256 (of the
    normalised text)."""
    rows = written(map_arrow(
        numbered(docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))), _combine,
        "doc_id long, row_id long, text_sha256 string, local long, first boolean, content binary, size long"), "exact")
    settled = _settled(rows.where(F.col("first")).select("doc_id", "text_sha256", "local", "content", "size"), table_bytes, fold)
    return (rows.select("doc_id", "row_id", "text_sha256", "local", "first").join(settled, "local")
            .select("doc_id", "row_id", "keep_id", "group_size",
                    (F.col("first") & F.col("wins")).alias("kept"), "text_sha256"))
