"""The shared n-gram tables against brute force, at any size of chunk and task."""
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.ctw import lower_words
from tessera.llm.quality import kneser_ney
from tessera.llm.shards import Corpus, Tally, _cut, from_planes, planes

ORDER = 4


def make(spark, n, words=60, seed=1):
    rng = random.Random(seed)
    kinds = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(kinds) for _ in range(words)), i % 3 != 0) for i in range(n)]
    return written(spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(2), "test-shards"), rows


def body(text):
    return b"\n" * (ORDER - 1) + b" ".join(text.encode().split()) + b"\n"


def grams(text, order=ORDER):
    data = body(text)
    return [data[i - order + 1:i + 1] for i in range(ORDER - 1, len(data))]


class KneserNey:
    """Interpolated modified Kneser-Ney, by its definition."""

    def __init__(self, texts):
        counts = Counter(g for t in texts for g in grams(t))
        self.tables = {ORDER: counts}
        for k in range(ORDER - 1, 0, -1):
            self.tables[k] = Counter(g[1:] for g in self.tables[k + 1])
        self.discount, self.total, self.left = {}, {}, {}
        for k, table in self.tables.items():
            n = Counter(table.values())
            y = n[1] / max(1, n[1] + 2 * n[2])
            d = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.5 * i for i in (1, 2, 3)] if n[1] else [0.5] * 3
            self.discount[k] = [min(i + 1.0, max(0.05, x)) for i, x in enumerate(d)]
            self.total[k], self.left[k] = defaultdict(int), defaultdict(float)
            for g, c in table.items():
                self.total[k][g[:-1]] += c
                self.left[k][g[:-1]] += self.discount[k][min(c, 3) - 1]

    def p(self, g):
        if not g:
            return 1 / 256
        k, c = len(g), self.tables[len(g)][g]
        if g[:-1] not in self.total[k]:
            return self.p(g[1:])
        own = c - self.discount[k][min(c, 3) - 1] if c else 0.0
        return (own + self.left[k][g[:-1]] * self.p(g[1:])) / self.total[k][g[:-1]]


def scored(docs, **limits):
    corpus = Corpus(docs, bytes.split, ORDER, with_words=False, **limits)
    rows = corpus.scores(written(kneser_ney(corpus.counts(), ORDER), "test-kn")).collect()
    return corpus, {r.doc_id: r.gram_score for r in rows}


@pytest.mark.parametrize("limits", [{}, {"chunk_bytes": 700}, {"chunk_bytes": 700, "held_keys": 50}])
def test_kneser_ney_by_definition(spark, limits):
    docs, rows = make(spark, 40)
    model = KneserNey([t for _, t, train in rows if train])
    want = {i: sum(math.log2(model.p(g)) for g in grams(t)) for i, t, _ in rows}
    _, got = scored(docs, **limits)
    assert got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 1e-3 for i in want)
    assert math.isclose(sum(model.p(b"abc" + bytes([b])) for b in range(256)), 1.0, abs_tol=1e-9)


def test_asked_rows_grow_with_the_text(spark):
    """Not with its square: four times the text, four times the rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        n = {}
        for size in (40, 160):
            corpus = Corpus(make(spark, size)[0], bytes.split, ORDER, with_words=False, chunk_bytes=1000)
            assert corpus.shards == 4
            n[size] = corpus._asked().count()
            assert n[size] <= 4 * corpus.chunks.count()
        assert 3 * n[40] < n[160] < 5 * n[40]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_counts_of_grams_and_words(spark):
    docs, rows = make(spark, 30)
    for held in (20, 10**6):
        corpus = Corpus(docs, lower_words, ORDER, with_words=True, chunk_bytes=900, held_keys=held)
        got = corpus.counts()
        assert got.groupBy("key").count().where("count > 1").count() == 0
        want = Counter(int.from_bytes(g, "big") for _, t, train in rows for g in grams(t) if train)
        assert {r.key: r.n for r in got.where("key >= 0 and n > 0").collect()} == want
        words = Counter(w for _, t, train in rows for w in [*t.split(), "END"] if train)
        assert sorted(r.n for r in got.where("key < 0 and n > 0").collect()) == sorted(words.values())


def test_tally_merges_runs(tmp_path):
    rng = np.random.default_rng(2)
    tally, want = Tally(str(tmp_path), held=64), Counter()
    for _ in range(60):
        key = np.unique(rng.integers(-500, 500, 40))
        n = rng.integers(0, 9, len(key))
        tally.add(key, n)
        for k, c in zip(key.tolist(), n.tolist(), strict=True):
            want[k] += c
    parts = list(tally.sums())
    assert tally.runs > 1
    keys = np.concatenate([k for k, _ in parts])
    assert (np.diff(keys) > 0).all()
    assert dict(zip(keys.tolist(), np.concatenate([n for _, n in parts]).tolist(), strict=True)) == dict(want)
    (tmp_path / "none").mkdir()
    assert [len(k) for k, _ in Tally(str(tmp_path / "none")).sums()] == [0]


def test_planes():
    for values in (np.zeros(0, np.float32), np.arange(5, dtype=np.int64) - 2, np.float32([1.5, -2.25])):
        assert (from_planes(planes(values), values.dtype.type, len(values)) == values).all()


def test_cuts_carry_their_context():
    text = b"\n\n" + b"aa bb " * 5 + b"x" * 40 + b" cc\n"
    for whole in (True, False):
        pieces = list(_cut(text, 2, 10, whole))
        assert b"".join([pieces[0][:2], *(p[2:] for p in pieces)]) == text
        at = 2
        for piece in pieces:
            assert piece[:2] == text[at - 2:at]
            at += len(piece) - 2
        assert max(map(len, pieces)) <= 12 or whole
        assert all(p.endswith((b" ", b"\n")) for p in pieces) or not whole


def test_long_texts_and_words(spark):
    """A text over 16 MB, and one word over 16 MB, score as their grams do."""
    rng = random.Random(4)
    kinds = ["".join(rng.choice("abcde") for _ in range(5)) for _ in range(50)]
    long_text, long_word = " ".join(rng.choice(kinds) for _ in range(3_000_000)), "".join(rng.choice("abcde") for _ in range(17_000_000))
    docs = written(spark.createDataFrame([(0, long_text, True), (1, long_word, False), (2, "abcde", True)], "doc_id long, text string, train boolean")
                   .repartition(1), "test-long")
    corpus, got = scored(docs)
    assert corpus.chunks.agg(F.max("bytes")).first()[0] <= (16 << 20) + ORDER
    counts = Counter()
    # Grams by integer, counted with numpy: the long text and the short one.
    for text in (long_text, "abcde"):
        data = np.frombuffer(body(text), np.uint8).astype(np.int64)
        keys = sum(data[i:len(data) - ORDER + 1 + i] << (8 * (ORDER - 1 - i)) for i in range(ORDER))
        counts.update(dict(zip(*(x.tolist() for x in np.unique(keys, return_counts=True)), strict=True)))
    assert {r.key: r.n for r in corpus.counts().where("n > 0").collect()} == counts
    assert got.keys() == {0, 1, 2} and all(v < 0 for v in got.values())
    with_words = Corpus(docs, bytes.split, ORDER, with_words=True)
    n = with_words.scores(with_words.counts().select("shard", "key", F.col("n").cast("double").alias("value")), lambda c: c)
    assert {r.doc_id: (r.n_tokens, r.n_known) for r in n.collect()} == {0: (3_000_001, 3_000_001), 1: (2, 1), 2: (2, 2)}
