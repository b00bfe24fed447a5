"""What the certified rules promise, on labels made to break it."""
import random

import numpy as np

from tessera.llm import rules
from tessera.llm.common import written

WORDS = "some plain words in a text of ten or more words".split()


def judged(spark, rows, labels):
    docs = written(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "test-promise")
    return rules.judged(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()


def test_rows_of_one_document_are_one_trial(spark):
    """One good id 600 times over is not evidence of 600 documents."""
    plain, loud = " ".join(WORDS), " ".join(WORDS).upper()
    rows = [(0, plain, "en")] * 600 + [(i, loud, "en") for i in range(1, 201)] + [(i, loud, "en") for i in range(300, 310)]
    got = judged(spark, rows, [(0, 1)] + [(i, 0) for i in range(300, 310)])
    assert all(r.kept for r in got) and len(got) == 810


def test_all_rules_together_stay_below_alpha(spark):
    """Three rules that each reject another 1 % of the good documents: with
    the three the share is 3 %, above ALPHA."""
    rng = random.Random(1)

    def text(kind):
        words = [rng.choice(WORDS) + str(rng.randint(0, 10**6)) for _ in range(20)]
        if kind == "capitals":
            words = [w.upper() for w in words]
        elif kind == "symbols":
            words = [f"{w[:3]}####" for w in words]
        elif kind == "runs":
            words = [w for w in words for _ in range(2)]
        return " ".join(words)

    kinds = ["capitals", "symbols", "runs"]
    rows = [(i, text(kinds[i % 100] if i % 100 < 3 else ""), "en") for i in range(20_000)]
    bad = [(20_000 + i, text(kinds[i % 3]), "en") for i in range(3000)]
    got = {r.doc_id: r.kept for r in judged(spark, rows + bad, [(i, 1) for i, *_ in rows] + [(i, 0) for i, *_ in bad])}
    lost = sum(not got[i] for i, *_ in rows) / len(rows)
    assert 0 < lost <= rules.ALPHA
    assert sum(not got[i] for i, *_ in bad) > 900


def test_the_promise_holds_over_many_draws():
    """Good documents that the loosest cutoff rejects a little too often are
    certified in no more than the level's share of draws."""
    rng = np.random.default_rng(2)
    n, level = 600, 0.05
    passed = sum(rules.n_passed(n, [int(k)] * 3, rules.ALPHA, level) > 0 for k in rng.binomial(n, rules.ALPHA * 1.0001, 4000))
    assert passed / 4000 <= level * 1.15


def test_strata_are_certified_on_their_own(spark):
    """Enough labels in one language say nothing of another."""
    rows = [(i, " ".join(WORDS) + f" {i}", "en") for i in range(2000)] + [(i, (" ".join(WORDS) + f" {i}").upper(), "de") for i in range(5000, 5050)]
    rows += [(i, (" ".join(WORDS) + f" {i}").upper(), "en") for i in range(9000, 9100)]
    got = judged(spark, rows, [(i, int(i < 9000)) for i, *_ in rows])
    assert sorted(r.doc_id for r in got if not r.kept) == list(range(9000, 9100))
    assert {tuple(r.rules) for r in got if not r.kept} == {("capitals",)}
