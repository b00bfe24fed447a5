"""Periodic runs, token alignment and contamination against brute force."""
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import alignment, queries
from tessera.llm.alignment import Aligned, ByteLevel, Pieces, aligned_documents, alignments
from tessera.llm.common import written
from tessera.llm.decontam import Index, contaminated, item_blocks, suffix_order
from tessera.llm.periods import find_runs, periodic_runs

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SCHEMA = "doc_id long, text string, row_id string, shard string, chunk string, runs string, pair string, items string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and very long texts, ties, repeats, clashing columns."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage = " ".join(f"passage{i}" for i in range(40))
    texts = [None, "", " \t\n", "one", "x" * 300_000, "one two " * 500, text(120_000), "a b c d e " * 40_000, text(30) + " " + passage + " " + text(30),
             passage.upper().replace(" ", ", "), passage, passage, "short item", "tail of a Short-Item here", "x <|endoftext|> y </s> <0x41>", "日本語 ​ é́ ﬁ",
             "  two  spaces ", "tail ", "▁ ▁a", "\x00 nul", *[text(rng.randint(1, 200)) for _ in range(40)]]
    rows = [(i, t, *["x"] * 6) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, passage, *[None] * 6), (None, None, *[None] * 6), (8, "another text under id 8", *[None] * 6)]
    return written(spark.createDataFrame(rows, SCHEMA).repartition(3), "matching-docs")


@pytest.fixture(scope="module")
def items(spark):
    passage = [f"Passage{i}" for i in range(40)]
    rows = [(3, " ".join(passage[:15])), (12, " ".join(passage[5:])), (12, " ".join(passage[5:])), (4, "short item"), (5, None), (6, " .,! "), (7, "never seen words"),
            (None, " ".join(passage[20:])), (8, " ".join(passage[:9]) + " otherwise it goes on"), (100, "one")]
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, words string")


def runs_by_hand(w):
    n, out = len(w), set()
    for q in range(1, n // 2 + 1):
        at = None
        for i in range(n - q + 1):
            same = i < n - q and w[i] == w[i + q]
            if same and at is None:
                at = i
            if not same and at is not None:
                if i + q - at >= max(12, 2 * q):
                    out.add((at, i + q - at, q))
                at = None
    return sorted((r for r in out if not any(p < r[2] and b <= r[0] and b + m >= r[0] + r[1] for b, m, p in out)), key=lambda r: (r[0], r[2]))


def hard_words(rng):
    kind = rng.choice(["two", "five", "repeat", "fibonacci", "morse", "step", "nested"])
    if kind in ("two", "five"):
        return [rng.randrange(2 if kind == "two" else 5) for _ in range(rng.randint(0, 150))]
    if kind == "repeat":
        root = [rng.randrange(3) for _ in range(rng.randint(1, 60))]
        return [rng.randrange(3) for _ in range(rng.randint(0, 30))] + (root * 9)[:rng.randint(1, 300)] + [rng.randrange(3) for _ in range(rng.randint(0, 30))]
    if kind == "fibonacci":
        a, b = [0], [0, 1]
        while len(b) < rng.randint(20, 400):
            a, b = b, b + a
        return b
    if kind == "morse":
        b = [0]
        while len(b) < 128:
            b += [1 - x for x in b]
        return b * 2
    root = [rng.randrange(2) for _ in range(rng.randint(1, 5))]
    if kind == "step":
        return (root * rng.randint(5, 60))[:-rng.randint(1, len(root))] + root[rng.randrange(len(root)):] + root * rng.randint(5, 60)
    root = root * rng.randint(2, 12) + [rng.randrange(3)]
    return root * rng.randint(2, 6) + [2] * rng.randint(0, 20) + root * 2


@pytest.mark.parametrize("seed", range(6))
def test_all_runs_are_found(seed):
    rng = random.Random(seed)
    for _ in range(6):
        texts = [hard_words(rng) for _ in range(15)]
        texts += [texts[3]] * 3
        found = [[] for _ in texts]
        for t, *run in zip(*(x.tolist() for x in find_runs(np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts]))), strict=True):
            found[t].append(tuple(run))
        assert found == [runs_by_hand(t) for t in texts]


def collapsed_by_hand(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_periodic_runs(docs, spark):
    rows = periodic_runs(docs).collect()
    expected = Counter()
    for r in docs.collect():
        words = WORD.findall(r.text or "")
        if len(words) < 2000:
            runs = runs_by_hand(words)
            expected[r.doc_id, len(words), tuple(runs), collapsed_by_hand(words, runs)] += 1
    got = Counter((r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in rows if r.n_words < 2000)
    assert got == expected and len(rows) == docs.count()
    assert next(tuple(map(tuple, r.runs)) for r in rows if r.doc_id == 7) == ((0, 200_000, 5),)
    assert periodic_runs(docs.where("false")).count() == 0


def test_op11(spark):
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    planted = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words = WORD.findall(r.text or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        if n > 1200:
            continue
        runs, row = runs_by_hand(words), got[r.doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period, row.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert row.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert row.collapsed_sha256 == sha(collapsed_by_hand(words, runs))
    assert planted > 5


@pytest.fixture(scope="module")
def paths():
    return queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")


def align_by_hand(text, a, b):
    """Ids, groups as text and links of one text, token by token."""
    whole = " " + (text or "")
    ids = a.tokenizer.encode(whole, add_special_tokens=False).ids if text else [], b.model.encode(text) if text else []
    if not text or any(b"".join(side.bytes[i] for i in own) != whole.encode() for side, own in zip((a, b), ids, strict=True)):
        return (0, 0), "", []
    ends = []
    for side, own in zip((a, b), ids, strict=True):
        at, of = 0, {}
        for i, x in enumerate(own):
            at += len(side.bytes[x])
            of[at] = i
        ends.append(of)
    groups, links, last = [], [], (0, 0)
    for end in sorted(ends[0].keys() & ends[1].keys()):
        i, j = ends[0][end], ends[1][end]
        groups.append(",".join(map(str, ids[0][last[0]:i + 1])) + "|" + ",".join(map(str, ids[1][last[1]:j + 1])))
        links.append((ids[0][i], ids[1][j]))
        last = i + 1, j + 1
    return (len(ids[0]), len(ids[1])), ";".join(groups), links


def check_alignment(texts, rows, paths):
    a, b = ByteLevel(paths[0]), Pieces(paths[1])
    done = [(d, *align_by_hand(t, a, b)) for d, t in texts]
    counts = Counter(link for *_, links in done for link in links)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(n, best.get(y, 0))
    expected = Counter((d, *n, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha(g) if g else "")
                       for d, n, g, links in done)
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows) == expected


def test_alignment(docs, paths, monkeypatch):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    check_alignment(texts, aligned_documents(docs, *paths).collect(), paths)
    assert aligned_documents(docs.where("false"), *paths).count() == 0
    row = next(r for r in alignments(docs, *paths).collect() if r.doc_id == 14)
    assert len(row.a_ends) == len(row.b_ends) and row.a_ends[-1] == len(row.a_ids) and row.b_ends[-1] == len(row.b_ids)
    assert 50256 not in row.a_ids


def test_op12(spark, paths):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_alignment(texts, queries.op12_token_alignment(spark, SF).collect(), paths)


def test_both_ways_of_cutting_agree(paths, monkeypatch):
    rng = random.Random(2)
    parts = ["a", "b", " ", "é", "ß", "<|endoftext|>", "1", "'s", "'S", "ª", "¼", "×", "\n", "\t", "²", "ǆ", "日", " ", "​", "  ", "x", "\r", "\x0b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    a, b = ByteLevel(paths[0]), Pieces(paths[1])
    assert a.ranks is not None and b.by_word
    groups = Aligned(texts, a, b).group_texts()
    assert [g.decode() for g in groups] == [align_by_hand(t, a, b)[1] for t in texts]
    monkeypatch.setattr(alignment, "CACHE_BYTES", 0)
    a.ranks, b.by_word = None, False
    assert Aligned(texts, a, b).group_texts() == groups


def contamination_by_hand(docs, items):
    def words(text):
        return [w.decode() for w in PLAIN_BYTES.findall((text or "").encode().translate(LOWER))]

    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[i:i + 10]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = Counter()
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        ids = sorted(str(i) for i in found - {None})
        spans = sorted(i for i in hit if i - 1 not in hit)
        out[doc, len(w), len(hit), tuple(ids), tuple(spans)] += 1
    return out


PLAIN_BYTES = re.compile(rb"[a-z0-9\x80-\xff]+")


@pytest.mark.parametrize("sizes", [(16 << 20, 4 << 20), (2000, 4 << 20), (5000, 150)])
def test_contamination(docs, items, sizes):
    rows = contaminated(docs, items, shard_bytes=sizes[0], block_bytes=sizes[1]).collect()
    expected = contamination_by_hand([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), tuple(s.start for s in r.spans)) for r in rows) == expected
    assert all(sum(s.length for s in r.spans) == r.n_hit for r in rows)
    assert len({r.row_id for r in rows}) == len(rows)


def test_contamination_of_empty_tables(docs, items):
    assert contaminated(docs.where("false"), items).count() == 0
    rows = contaminated(docs, items.where("false")).collect()
    assert len(rows) == docs.count() and not any(r.n_hit or r["items"] or r.spans for r in rows)


def test_long_items_are_cut_with_overlap(spark):
    text = " ".join(f"w{i}" for i in range(500))
    blocks = item_blocks(spark.createDataFrame([(1, text)], "item_id long, text string"), 10, 400).collect()
    seen = {tuple(w[i:i + 10]) for b in blocks for t in b.texts for w in [bytes(t).split()] for i in range(len(w) - 9)}
    assert len(blocks) > 5 and len(seen) == 491


def test_op13(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = Counter((d, n, h, len(i), sha(",".join(i)), h > 0) for (d, n, h, i, _), k in contamination_by_hand(texts, items).items() for _ in range(k))
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in queries.op13_contamination(spark, SF).collect())
    assert got == expected and any(h for (_, _, h, *_) in got)


def test_suffix_order_and_search():
    rng = random.Random(3)
    for _ in range(30):
        texts = [[rng.randint(1, 3) for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 8))]
        texts.append(texts[0])
        row = [x for t in texts for x in (*t, 0)]
        cuts = [i for i, x in enumerate(row) if not x]
        keys = [[(x, 0) if x else (0, cuts.index(i + j)) for j, x in enumerate(row[i:])] for i in range(len(row))]
        assert suffix_order(np.array(row, np.int32)).tolist() == sorted(range(len(row)), key=keys.__getitem__)
        stored = {k: v[0] for k, v in Index.build(0, [(0, 0)], [np.array(t, np.int32) for t in texts], [0], [b"a", b"b", b"c"]).items()}
        index = Index(stored)
        low, high = index.search(np.array([[1, 2], [0, 3], [3, -1], [2, 2]]))
        for window, i, j in zip(([1, 2], [3], None, [2, 2]), low.tolist(), high.tolist(), strict=True):
            at = sorted(index.locate(np.arange(i, j)).tolist())
            assert at == ([k for k in range(len(row)) if row[k:k + len(window)] == window] if window else [])


def test_packing_ids_are_the_tokenizers(spark):
    from tokenizers import Tokenizer

    from tessera.llm.packing import WordTokens, pieces
    path = queries.tokenizer_path()
    own, whole = WordTokens(path), Tokenizer.from_file(path)
    rng = random.Random(0)
    parts = ["x", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", " ", "'s", "é", "1", "2", "日", "!", "<", ".\n", "İ", "ª", "ß", "Ω", "'RE", "ÿ", "À", "\x1c", "\x85", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    texts += ["one x <|endoftext|> y", ("long " + "wörd" * 9 + " ") * 60_000]
    got = [np.frombuffer(x, "<u4").tolist() for x in own.ids([t.encode() for t in texts])]
    assert got == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    rows = pieces(spark.createDataFrame([(1, texts[-1])], "doc_id long, text string"), path).collect()
    assert sum(r.length for r in rows) == len(got[-1]) + 1 and max(r.length for r in rows) == 4096
    with pytest.raises(ValueError, match="not a vocabulary"):
        WordTokens(queries.tokenizer_path("byte_bpe_50k.json"))
