"""Source mixing against independent targets, and on rows that share an id."""
from collections import Counter

import corpus_pipeline
from tessera.llm import mixing
from tessera.llm.common import written
from tessera.llm.mixing import mix, mixed_documents


def targets_by_hand(sizes, weights, share, most):
    """Pour the wanted amount over the sources by weight; what is above a
    source's limit is poured again over the others."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, full, want = dict(weight), {}, share * sum(sizes.values())
    while left:
        level = (want - sum(full.values())) / sum(left.values())
        above = [s for s in left if level * left[s] > most * sizes[s] + 1e-9]
        if not above:
            return full | {s: level * w for s, w in left.items()}
        for s in above:
            full[s] = most * sizes[s]
            del left[s]
    return full


def test_targets_match_pouring(spark):
    for sizes, weights in [({"a": 10, "b": 400, None: 90, "c": 5}, [3.0, 1.0, 2.0]), ({"a": 100, "b": 1, "B": 1}, [1.0, 5.0]), ({"x": 7}, [2.0]), ({"": 50, "é": 60, "z": 0}, [1.0])]:
        rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes.items())]
        got = mix(written(spark.createDataFrame(rows, "doc_id long, text string, source string"), "test-targets"), weights).collect()
        expected = targets_by_hand(sizes, weights, 1.5, 2.0)
        by_id = {i: s for i, s in enumerate(sizes)}
        assert all(abs(r.target - expected[by_id[r.doc_id]]) < 1e-6 for r in got)


def test_copies_are_due_shares_on_average(spark):
    """Each document's copies are its due share rounded up or down, and over
    many seeds their mean is near it."""
    rows = [(i, " ".join(["w"] * (3 + i % 5)), "ab"[i % 2]) for i in range(60)]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string, source string"), "test-shares")
    taken, seeds = Counter(), 25
    for seed in range(seeds):
        for r in mix(docs, [3.0, 2.0], seed=seed).collect():
            due = r.target / r.source_size
            assert r.copies in (int(due), int(due) + 1)
            taken[r.doc_id] += r.copies - due
    mean = sum(taken.values()) / (seeds * len(taken))
    assert abs(mean) < 0.02 and max(map(abs, taken.values())) / seeds < 0.5


def test_rows_without_ids_are_dealt_over_blocks(spark):
    n = 6000
    rows = [(None, "one two three", "a") for _ in range(n)] + [(7, "one two three", "b") for _ in range(n)]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), "test-null-ids")
    got = mix(docs, [3.0, 1.0]).collect()
    assert len(got) == 2 * n and len({r.row_id for r in got}) == 2 * n
    by = Counter()
    for r in got:
        by[r.source_size, r.target] += r.taken
    assert all(abs(t - target) <= 6 for (_, target), t in by.items())
    due = docs.selectExpr("monotonically_increasing_id() AS row_id", "doc_id", "3 AS size")
    blocks = due.selectExpr(f"pmod(xxhash64(0, doc_id, size, row_id), ceil({n} / {mixing.FAN})) AS block").groupBy("block").count().agg({"count": "max"}).first()[0]
    assert blocks < 10 * mixing.FAN


def test_columns_with_the_pipelines_own_names_are_kept(spark):
    rows = [(i, f"a text number {i} of some words", "en", "s", 5, "mine", "mine too", "and this") for i in range(20)]
    docs = written(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, corpus_row string, Corpus_Copies string, corpus_copy string"), "test-names")
    out = mixed_documents(docs, [1.0])
    assert out.columns == docs.columns and {r.corpus_row for r in out.collect()} == {"mine"}
    kept = corpus_pipeline.exact(spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == 20
