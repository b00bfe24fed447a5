"""Alignment of two tokenizers over the same texts.

A text's tokens, once by tokenizer A and once by B, are laid over its bytes. An
end-to-index dictionary of each side maps the byte offset after a token to the
token; the offsets that both dictionaries hold cut the two id lists into
groups, and in each group the pairs of tokens that end together are linked.
Offsets are small numbers without gaps, so a dictionary is an array with one
slot per offset, for a block of texts at a time.

How often a pair of ids is linked in the whole corpus is counted over chunks:
a chunk keeps its links as places in its list of distinct pairs, asks once for
each of these, and looks the answers up.

Defined results: a text that is null, empty or not given back exactly by the
bytes of A's or B's tokens has no tokens; null and repeated ids are rows of
their own; an empty table gives an empty result; other columns are ignored.
Strings of special tokens inside a text are plain text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow, slices, written
from tessera.llm.shards import expanded, squeezed

CHUNK_BYTES = 4 << 20
#: How byte-level vocabularies cut a text before merging. Fixed value.
BYTE_LEVEL_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of other characters, or with very long words or gaps, take the
#: tokenizer file's own pipeline.
USUAL, GAP = re.compile(r"[\t\n\r -~¡-ɏ]*"), re.compile(r"\s{200}")
LONG_WORD = 1000
#: Bytes of words and ids that a task remembers of side B.
CACHE_BYTES = 64 << 20


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies:
    itself if it shows in Latin-1, else the next one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Side A: a byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        place = byte_characters()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(place[c] for c in token) if all(c in place for c in token) else token.encode()
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)
        self.ranks = self._ranks(path, vocabulary)

    def _ranks(self, path: str, vocabulary: dict[str, int]):
        """The same merges as byte pair ranks, if the file's merges make new
        entries in order, each by one merge, and nothing else is set."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, cut = file["model"], file.get("pre_tokenizer") or {}
        made = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
        special = {t["id"] for t in file.get("added_tokens", [])}
        plain = (model["type"] == "BPE" and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
                 and not file.get("normalizer") and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
                 and made == sorted(set(made)) and len(made) + 256 + len(special - set(made)) == len(vocabulary))
        if not plain:
            return None
        return tiktoken.Encoding("from-file", pat_str=BYTE_LEVEL_CUT, special_tokens={},
                                 mergeable_ranks={self.bytes[i]: i for i in vocabulary.values() if i not in special})

    def _usual(self, text: str) -> bool:
        return bool(self.ranks is not None and USUAL.fullmatch(text) and max(map(len, text.split()), default=0) < LONG_WORD and not GAP.search(text))

    def ids(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of a space and each text; None if they do not give it back."""
        out: list = [self.ranks.encode_ordinary(" " + t) if self._usual(t) else None for t in texts]
        odd = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(odd, self.tokenizer.encode_batch_fast([" " + texts[i] for i in odd], add_special_tokens=False), strict=True):
            out[i] = e.ids
        get = self.bytes.__getitem__
        return [np.array(ids, np.int32) if b"".join(map(get, ids)) == b" " + t.encode() else None for t, ids in zip(texts, out, strict=True)]


class Pieces:
    """Side B: a piece model with byte fallback that adds a space itself."""

    BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = self.BYTE.fullmatch(piece)
            self.bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)
        #: No piece goes on after a space, so words are cut one by one.
        self.by_word = not any(" " in p.lstrip(b" ").decode(errors="replace") for p in self.bytes)
        self.words: dict[str, bytes | None] = {}
        self.held = 0

    def _encoded(self, texts: list[str]) -> list[bytes | None]:
        """Little-endian 32-bit ids; None if they do not give the text back."""
        get = self.bytes.__getitem__
        return [np.array(ids, "<i4").tobytes() if b"".join(map(get, ids)) == b" " + t.encode() else None
                for t, ids in zip(texts, self.model.encode(texts, out_type=int, num_threads=1) if texts else [], strict=True)]

    def ids(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text, to which the model adds a space; None if they do
        not give it back."""
        if self.held > CACHE_BYTES:
            self.words, self.held = {}, 0
        split = [t.split(" ") if self.by_word and t and "  " not in t and t[0] != " " and t[-1] != " " else None for t in texts]
        new = list(set().union(*filter(None, split)).difference(self.words))
        found = self._encoded(new)
        self.words.update(zip(new, found, strict=True))
        self.held += sum(150 + len(w) + len(x or b"") for w, x in zip(new, found, strict=True))
        whole = iter(self._encoded([t for t, words in zip(texts, split, strict=True) if words is None]))
        out = []
        for words in split:
            parts = [next(whole)] if words is None else list(map(self.words.__getitem__, words))
            out.append(None if None in parts else np.frombuffer(b"".join(parts), "<i4"))
        return out


_loaded: dict[tuple, ByteLevel | Pieces] = {}


def _side(kind: type, path: str):
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]


def _spread(counts: np.ndarray) -> np.ndarray:
    """0, 0, ..., 1, 1, ...: ``counts[i]`` times i."""
    return np.repeat(np.arange(len(counts)), counts)


class Aligned:
    """The tokens, groups and links of a block of texts."""

    def __init__(self, texts: list[str | None], a: ByteLevel, b: Pieces) -> None:
        known = [t or "" for t in texts]
        ids = [(x, y) if t and x is not None and y is not None else (np.zeros(0, np.int32),) * 2
               for t, x, y in zip(known, a.ids(known), b.ids(known), strict=True)]
        sizes = [len(t.encode()) + 1 if len(x) else 0 for t, (x, _) in zip(known, ids, strict=True)]
        size = sum(sizes)
        (self.a, self.b), (self.n_a, self.n_b) = zip(*(
            (np.concatenate([*some, np.zeros(0, np.int32)]), np.array([len(x) for x in some], np.int64)) for some in ([x for x, _ in ids], [y for _, y in ids])), strict=True)
        ends_a, ends_b = (np.cumsum(side.lengths[own]) for side, own in ((a, self.a), (b, self.b)))
        at_a, at_b = np.full(size + 1, -1), np.full(size + 1, -1)
        at_a[ends_a] = np.arange(len(ends_a))
        at_b[ends_b] = np.arange(len(ends_b))
        both = np.flatnonzero((at_a >= 0) & (at_b >= 0))
        #: The last token of each group on either side; these are linked.
        self.last_a, self.last_b = at_a[both], at_b[both]
        self.n_groups = np.diff(np.searchsorted(both, np.cumsum([0, *sizes]), side="right"))

    def group_texts(self) -> list[bytes]:
        """Per text, its groups' ids as ``a1,a2|b1;a3|b2,b3``."""
        size_a, size_b = (np.diff(x, prepend=-1) for x in (self.last_a, self.last_b))
        group_a, group_b = _spread(size_a), _spread(size_b)
        to_a = np.arange(len(self.a)) + np.concatenate(([0], np.cumsum(size_b)))[group_a]
        to_b = np.arange(len(self.b)) + np.cumsum(size_a)[group_b]
        ids = np.empty(len(self.a) + len(self.b), np.int32)
        ids[to_a], ids[to_b] = self.a, self.b
        after = np.full(len(ids), ord(","), np.uint8)
        after[to_a[self.last_a]], after[to_b[self.last_b]] = ord("|"), ord(";")
        numbers = [str(i).encode() for i in range(int(ids.max(initial=0)) + 1)]
        width = len(numbers[-1])
        table = np.frombuffer(b"".join(n.ljust(width + 1, b" ") for n in numbers), np.uint8).reshape(-1, width + 1)
        digits = np.array([len(n) for n in numbers])[ids]
        cells = table[ids]
        cells.ravel()[np.arange(len(ids)) * (width + 1) + digits] = after
        body = cells[cells != ord(" ")].tobytes()
        ends = np.concatenate(([0], np.cumsum(digits + 1)))[np.cumsum([0, *(self.n_a + self.n_b)])].tolist()
        return [body[i:max(i, j - 1)] for i, j in zip(ends, ends[1:])]


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: doc_id, a_ids and b_ids (the tokens), a_ends and b_ends
    (how many tokens of either side precede each cut: group i is the slices
    from cut i - 1, or 0, to cut i; its last tokens are linked)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        a, b = _side(ByteLevel, path_a), _side(Pieces, path_b)
        for batch in batches:
            for part in slices(batch.set_column(1, "size", batch.column("text").cast(pa.binary())), "size", CHUNK_BYTES):
                own = Aligned(part.column("size").cast(pa.string()).to_pylist(), a, b)
                starts = {"a": np.cumsum([0, *own.n_a]), "b": np.cumsum([0, *own.n_b]), "g": np.cumsum([0, *own.n_groups])}
                yield {"doc_id": part.column("doc_id")} | {
                    f"{s}_ids": [ids[i:j] for i, j in zip(starts[s], starts[s][1:])] for s, ids in (("a", own.a), ("b", own.b))} | {
                    f"{s}_ends": [last[i:j] + 1 - at for i, j, at in zip(starts["g"], starts["g"][1:], starts[s])]
                    for s, last in (("a", own.last_a), ("b", own.last_b))}

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


def _chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Stored: one row per block of documents, with its distinct pairs of
    linked ids, how often it holds each, and its links as places among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        a, b = _side(ByteLevel, path_a), _side(Pieces, path_b)
        chunk = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch.set_column(1, "size", batch.column("text").cast(pa.binary())), "size", CHUNK_BYTES):
                own = Aligned(part.column("size").cast(pa.string()).to_pylist(), a, b)
                pairs, links, n = np.unique(own.a[own.last_a].astype(np.int64) << 32 | own.b[own.last_b], return_inverse=True, return_counts=True)
                yield {"chunk": [chunk], "doc_id": [part.column("doc_id").to_pylist()], "n_a": [own.n_a], "n_b": [own.n_b], "n_groups": [own.n_groups],
                       "groups_sha256": [[hashlib.sha256(t).hexdigest() if t else "" for t in own.group_texts()]],
                       "pairs": [pairs], "n": [n], "links": [squeezed(links.astype(np.uint32).tobytes())]}
                chunk += 1

    return written(map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run,
                             "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
                             "pairs array<long>, n array<long>, links binary"), "links")


def pair_counts(asked: DataFrame) -> DataFrame:
    """Per pair of ids: pair (a << 32 | b), total (how many links hold it in
    the corpus), best (whether none with the same b is held by more). There
    are no more b than B's vocabulary has entries."""
    totals = asked.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    return totals.join(F.broadcast(most), "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def aligned_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per (doc_id, text) row: doc_id, n_a, n_b, n_groups, n_links, n_best
    (links whose pair is best for its b), count_sum (the pair's total, over the
    links), groups_sha256 (of the text form of the groups; '' without tokens)."""
    chunks = _chunks(docs, path_a, path_b)
    asked = chunks.select("chunk", F.explode(F.arrays_zip("pairs", "n")).alias("x")).select("chunk", F.col("x.pairs").alias("pair"), F.col("x.n").alias("n"))
    known = written(pair_counts(asked), "pairs")
    answers = asked.join(known, "pair").select(F.col("chunk").alias("asker"), "pair", "total", "best")

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        order = np.argsort(right.column("pair").to_numpy())
        total, best = (right.column(c).to_numpy(zero_copy_only=False)[order].astype(np.int64) for c in ("total", "best"))
        n = np.array(row["n_groups"], np.int64)
        links = np.frombuffer(expanded(row["links"], 4 * int(n.sum())), np.uint32)
        sums = [np.diff(np.concatenate(([0], np.cumsum(v[links])))[np.cumsum([0, *n])]) for v in (best, total)]
        return pa.table({"doc_id": pa.array(row["doc_id"], pa.int64()), "n_a": pa.array(row["n_a"], pa.int64()), "n_b": pa.array(row["n_b"], pa.int64()),
                         "n_groups": n, "n_links": n, "n_best": sums[0], "count_sum": sums[1],
                         "groups_sha256": pa.array(row["groups_sha256"], pa.string())})

    return (chunks.select("chunk", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links").groupBy("chunk")
            .cogroup(answers.groupBy("asker"))
            .applyInArrow(look_up, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
