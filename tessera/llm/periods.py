"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of words that repeats with a smallest period q, at least
``max(12, 2 q)`` words long, which no neighbouring word extends. All runs of a
text are found:

* periods below 6 by comparing each word with the one q words on;
* a period from 3 t to below 6 t, for t = 2, 4, 8, ..., by the synchronising
  set of scale t: positions where the smallest hash of the t words from there,
  among the next t + 1 such stretches, stands first or last. Whether a position
  belongs to the set depends on the 2 t words from it alone, and each t
  positions hold one, except where the text has a period of at most t / 3. Such
  regions are known from the scales before and are left out of the set;
* two members with the same 2 t words propose their distance as a period. A
  run without such a pair consists of two neighbouring regions of one small
  period out of step; these propose all distances that bring them into step.

Each proposal is extended in both directions by comparing words. A stretch
inside a run of a smaller period has that period too and is not a run.

Words are compared by number, stretches by 64-bit hashes. Texts are worked on
whole, some bytes of texts at a time; at each scale only texts of 6 t words or
more go on.

Defined results: a null text has no words, and a text without words no runs;
null and repeated ids are rows of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow, mix64, slices, text_bytes

LEAST = 12
SMALL = 6  # periods below are compared word by word


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches of at least ``least`` True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    start, size = edge[::2], edge[1::2] - edge[::2]
    return start[size >= least], size[size >= least]


def _windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each position on."""
    n = len(values)
    padded = np.concatenate((values, np.full(-n % width + width, np.iinfo(values.dtype).max, values.dtype)))
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1:n + width - 1])


class Runs:
    """Runs found so far over some texts in a row, as positions in the row."""

    def __init__(self) -> None:
        self.start = self.end = self.period = np.zeros(0, np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        """Adds the stretches that are long enough and not inside a known run.
        Periods of one call are never multiples of one another."""
        long = end - start >= np.maximum(LEAST, 2 * period)
        start, end, period = start[long], end[long], period[long]
        if len(self.start) and len(start):
            order = np.argsort(self.start, kind="stable")
            reach = np.maximum.accumulate(self.end[order])
            at = np.searchsorted(self.start[order], start, side="right") - 1
            new = (at < 0) | (reach[np.maximum(at, 0)] < end)
            start, end, period = start[new], end[new], period[new]
        found = np.unique(np.column_stack((start, period, end)), axis=0) if len(start) else np.zeros((0, 3), np.int64)
        self.start, self.period, self.end = (np.concatenate(x) for x in zip(
            (self.start, self.period, self.end), found.T, strict=True))

    def inside(self, n: int, size: int, most: int) -> np.ndarray:
        """Where ``size`` words from a position lie in a run of a period up to
        ``most``."""
        some = (self.period <= most) & (self.end - self.start >= size)
        marks = np.zeros(n + 1, np.int64)
        np.add.at(marks, self.start[some], 1)
        np.add.at(marks, self.end[some] - size + 1, -1)
        return np.cumsum(marks[:n]) > 0


def _extended(words: np.ndarray, at: np.ndarray, period: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """How far the words from ``at`` equal those ``period`` on: the first
    position of the stretch around ``at``, and the one after its last."""
    n, sides = len(words), []
    for way in (1, -1):
        #: Position of the next comparison.
        where, active = at.copy() if way > 0 else at - 1, np.arange(len(at))
        wide = np.arange(max(16, step)) * way
        while len(active):
            rest = []
            for some in np.array_split(active, max(1, len(active) * len(wide) >> 20)):
                left = where[some][:, None] + wide
                right = left + period[some][:, None]
                good = (left >= 0) & (right < n)
                good &= words[np.where(good, left, 0)] == words[np.where(good, right, 0)]
                size = np.where(good.all(axis=1), len(wide), good.argmin(axis=1))
                where[some] += way * size
                rest.append(some[size == len(wide)])
            active = np.concatenate(rest)
        sides.append(where if way > 0 else where + 1)
    return sides[1], sides[0]


def _out_of_step(words: np.ndarray, runs: Runs, scale: int) -> tuple[list[int], list[int]]:
    """Proposals of neighbouring regions of one period up to ``scale / 3``."""
    some = np.flatnonzero((runs.period <= scale // 3) & (runs.end - runs.start >= 3 * scale))
    some = some[np.lexsort((runs.start[some], runs.period[some]))]
    start, end, period = runs.start[some], runs.end[some], runs.period[some]
    at, found = [], []
    for i in np.flatnonzero((period[1:] == period[:-1]) & (end[:-1] >= start[1:])).tolist():
        p, b, e = int(period[i]), int(start[i + 1]), int(end[i])
        root, last = words[b:b + p], words[e - 2 * p:e - 1]
        shift = np.flatnonzero((np.lib.stride_tricks.sliding_window_view(last, p) == root).all(axis=1)) if p < 64 else _find(last, root)
        if len(shift):
            first = (b - (e - 2 * p + int(shift[0]))) % p
            low = 3 * scale + (first - 3 * scale) % p
            for q in range(low, min(6 * scale, e - int(start[i]) + 1, int(end[i + 1]) - b + 1), p):
                at.append(max(int(start[i]), b - q))
                found.append(q)
    return at, found


def _find(words: np.ndarray, root: np.ndarray) -> list[int]:
    body, part, at = words.tobytes(), root.tobytes(), -1
    size = words.itemsize
    while (at := body.find(part, at + 1)) >= 0:
        if at % size == 0:
            return [at // size]
    return []


def find_runs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of some texts, whose words are numbers >= 0, one text after
    the other: text, start in it, length and period, by text, start, period."""
    #: One separator after each text, equal to no other word.
    row = np.empty(len(words) + len(sizes), np.int64)
    ends = np.cumsum(sizes + 1)
    row[ends - 1] = -1 - np.arange(len(sizes))
    inside = np.ones(len(row), bool)
    inside[ends - 1] = False
    row[inside] = words
    starts, left = ends - sizes - 1, np.arange(len(sizes))
    found: list[tuple] = []

    def keep(of: Runs, some: np.ndarray, begin: np.ndarray) -> None:
        text = np.searchsorted(begin, of.start, side="right") - 1
        found.append((some[text], of.start - begin[text], of.end - of.start, of.period))

    def narrow(least: int) -> np.ndarray:
        """Go on with the texts of ``least`` words; keep the others' runs.
        Gives the words that stay."""
        nonlocal row, starts, left, runs
        some = sizes[left] >= least
        stay = np.repeat(some, sizes[left] + 1)
        if some.all():
            return stay
        text = np.searchsorted(starts, runs.start, side="right") - 1
        gone, stays = Runs(), Runs()
        for of, mask in ((gone, ~some[text]), (stays, some[text])):
            of.start, of.end, of.period = runs.start[mask], runs.end[mask], runs.period[mask]
        keep(gone, left, starts)
        moved = np.cumsum(np.where(some, sizes[left] + 1, 0)) - (sizes[left] + 1)
        shift = starts[text[some[text]]] - moved[text[some[text]]]
        stays.start, stays.end = stays.start - shift, stays.end - shift
        row = row[stay]
        left, starts, runs = left[some], moved[some], stays
        return stay

    runs = Runs()
    narrow(LEAST)
    for q in range(1, SMALL):
        start, size = _stretches(row[:-q] == row[q:], max(LEAST - q, q)) if len(row) > q else (np.zeros(0, np.int64),) * 2
        runs.add(start, start + size + q, np.full(len(start), q))
    hashes, scale = mix64(row.view(np.uint64)), 1
    while len(left):
        hashes = hashes[narrow(12 * scale)]  # 6 t words at the next scale
        if not len(left):
            break
        n, scale = len(row), 2 * scale
        half = np.concatenate((hashes[scale // 2:], np.arange(scale // 2, dtype=np.uint64)))
        hashes = mix64(hashes * np.uint64(0xD6E8FEB86659FD93) + mix64(half + np.uint64(scale)))
        if scale == 2:
            periodic = np.zeros(n, bool)
        elif scale in (4, 8):  # periods 1 and 2, regions too short to be runs
            q = scale // 4
            same = np.zeros(n, np.int8)
            same[:n - q] = row[:-q] == row[q:]
            periodic = _windows(same, scale - q) == 1
        else:
            periodic = runs.inside(n, scale, scale // 3)
        value = np.where(periodic, np.uint64(2**64 - 1), hashes >> np.uint64(1))
        least = _windows(value, scale + 1)
        last = np.concatenate((value[scale:], np.full(min(scale, n), 2**64 - 1, np.uint64)))[:n]
        members = np.flatnonzero((least != np.uint64(2**64 - 1)) & ((least == value) | (least == last)))
        members = members[members <= n - 2 * scale]
        context = mix64(hashes[members] + mix64(hashes[members + scale] + np.uint64(1)))
        order = np.lexsort((members, context))
        members, context = members[order], context[order]
        at, period = [], []
        for step in count(1):
            near = (context[step:] == context[:-step]) & (members[step:] - members[:-step] < 6 * scale) if step < len(members) else np.zeros(0, bool)
            if not near.any():
                break
            first, far = members[:-step][near], (members[step:] - members[:-step])[near]
            at.append(first[far >= 3 * scale])
            period.append(far[far >= 3 * scale])
        more = _out_of_step(row, runs, scale) if len(runs.start) else ([], [])
        at, period = (np.concatenate([*x, np.array(y, np.int64)]) for x, y in zip((at, period), more, strict=True))
        if len(at):
            order = np.lexsort((at, period))
            at, period = at[order], period[order]
            #: Within the 2 t equal words of one proposal lies the same stretch.
            head = np.concatenate(([True], (period[1:] != period[:-1]) | (at[1:] - at[:-1] > 2 * scale)))
            begin, stop = _extended(row, at[head], period[head], scale)
            runs.add(begin, stop + period[head], period[head])
    keep(runs, left, starts)
    text, start, size, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, start, text))
    return text[order], start[order], size[order], period[order]


def repeated(n: int, start: np.ndarray, size: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in a run after its first period."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, start + period, 1)
    np.add.at(marks, start + size, -1)
    return np.cumsum(marks[:n]) > 0


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per (doc_id, text) row: doc_id, n_words, runs (array of start, length
    and period, in words, by start and period) and collapsed (the words that no
    run repeats, joined by one space)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t.split() for t in part.column("text").to_pylist()]
                number = defaultdict(count().__next__)
                sizes = np.array([len(t) for t in texts], np.int64)
                words = np.fromiter((number[w] for t in texts for w in t), np.int64, int(sizes.sum()))
                text, *found = find_runs(words, sizes)
                cuts = np.searchsorted(text, np.arange(len(texts) + 1))
                runs, kept = [], []
                for own, n, i, j in zip(texts, sizes.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    some = [x[i:j] for x in found]
                    runs.append([dict(zip(("start", "length", "period"), x, strict=True)) for x in zip(*(x.tolist() for x in some), strict=True)])
                    kept.append(b" ".join(compress(own, (~repeated(n, *some)).tolist()) if i < j else own).decode())
                yield {"doc_id": part.column("doc_id"), "n_words": sizes, "runs": runs, "collapsed": kept}

    return map_arrow(docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text")), run,
                     "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
