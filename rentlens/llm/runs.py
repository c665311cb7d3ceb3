"""Periodic runs of words: maximal stretches that repeat a unit of q words at least four times over.

Every run of period q matches itself q words later at a stretch of at least 3q places, so one of the multiples of 3q
lies in it. For all periods these places are a harmonic grid of about n log(n)/3 pairs (i, i + q); from each pair whose
words agree, the run reaches as far as the longest common extensions (LCE) of its two places to the right and to the left.

An LCE compares words one by one until both places are in a difference cover, which takes less than ``V`` words. Only
the suffixes at the cover's places are sorted, and the rest of the extension is the least common prefix of neighbours
between the two in that order: one look at a sparse table.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import by_value, texts

by_value(sys.modules[__name__])

#: A perfect difference set. Each remainder of ``V`` but 0 is the difference of one pair of ``COVER``.
V, COVER = 31, (1, 5, 11, 24, 25, 27)
LEAST, TIMES = 6, 4  #: the shortest run in words, and in periods
GRID = 1 << 20  #: pairs of places that are looked at in one go
RUNS = "array<struct<start: long, length: long, period: long>>"


def _steps() -> np.ndarray:
    """At [d], the s for which s and s + d are both in the cover (modulo ``V``)."""
    out = np.zeros(V, np.int64)
    for a in COVER:
        for b in COVER:
            out[(b - a) % V] = a
    return out


STEPS = _steps()


class Extensions:
    """Longest common extensions to the right of places of one sequence of words (as numbers from 0)."""

    def __init__(self, words: np.ndarray):
        # words beyond the end differ from all others and from each other, so that no comparison needs a bound
        self.n = len(words)
        self.words = np.concatenate((words, -1 - np.arange(2 * V, dtype=np.int64)))
        self.table: list[np.ndarray] | None = None

    def _index(self) -> None:
        """Sort the suffixes at the cover's places and prepare the least common prefixes of ranges of neighbours."""
        here = np.arange(self.n + V)
        self.places = here[np.isin(here % V, COVER)]
        m = len(self.places)
        spot = np.full(self.n + V, -1)
        spot[self.places] = np.arange(m)
        # V words on from a place of the cover is one again; beyond the end there is nothing
        names, rank = [], self._named(np.stack([self.words[self.places + k] for k in range(V)]))
        names.append(rank)
        reach = V
        while rank.max(initial=0) < m - 1:  # equal names are left: take twice as many words
            far = self.places + reach
            follow = np.where(far < self.n + V, spot[np.minimum(far, self.n + V - 1)], -1)
            after = np.where(follow >= 0, rank[follow], -1)
            rank = self._named(np.stack([rank, after]))
            names.append(rank)
            reach *= 2
        self.spot, self.rank = spot, rank
        order = np.argsort(rank, kind="stable")
        self.table = [self._common(names, spot, order[:-1], order[1:])]
        while 2 << (len(self.table) - 1) < m:
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    @staticmethod
    def _named(columns: np.ndarray) -> np.ndarray:
        """Ranks of the columns of a table by its first row, then its second and so on; equal ones share a rank."""
        order = np.lexsort(columns[::-1])
        ordered = columns[:, order]
        rank = np.empty(columns.shape[1], np.int64)
        rank[order] = np.concatenate(([0], np.cumsum((ordered[:, 1:] != ordered[:, :-1]).any(axis=0))))[:len(order)]
        return rank

    def _common(self, names: list[np.ndarray], spot: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of each pair of sorted suffixes, from names of V, 2V, 4V... words downwards."""
        i, j = self.places[a], self.places[b]
        total = np.zeros(len(i), np.int64)
        for level in range(len(names) - 1, -1, -1):
            x, y = i + total, j + total
            inside = np.maximum(x, y) < self.n + V
            x, y = spot[np.where(inside, x, 0)], spot[np.where(inside, y, 0)]
            same = inside & (x >= 0) & (y >= 0) & (names[level][x] == names[level][y])
            total += np.where(same, V << level, 0)
        return self._plain(i, j, total)

    def _plain(self, i: np.ndarray, j: np.ndarray, total: np.ndarray, most: np.ndarray | int = V) -> np.ndarray:
        """Word by word from ``total`` on, until words differ or ``most`` of them were equal."""
        active, start = np.arange(len(i)), total.copy()
        limit = np.broadcast_to(most, i.shape)
        while len(active):
            active = active[total[active] - start[active] < limit[active]]
            a, b = i[active] + total[active], j[active] + total[active]
            active = active[self.words[a] == self.words[b]]
            total[active] += 1
        return total

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` on equal those from ``j`` on; ``i`` < ``j``."""
        if not len(i):
            return np.zeros(0, np.int64)
        steps = (STEPS[(j - i) % V] - i) % V  # this many words on, both places are in the cover
        steps = np.where((j - i) % V == 0, (COVER[0] - i) % V, steps)
        out = self._plain(i, j, np.zeros(len(i), np.int64), steps)
        far = np.flatnonzero((out == steps) & (j + steps < self.n))
        if len(far):
            if self.table is None:
                self._index()
            a, b = (self.rank[self.spot[x[far] + steps[far]]] for x in (i, j))
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(float))[1] - 1  # the largest power of two that fits
            common = np.empty(len(far), np.int64)
            for k in np.unique(level):
                at, row = level == k, self.table[k]
                common[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
            out[far] += common
        return out


def _grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) for all multiples of three periods and all periods of which four fit, some at a time."""
    first = 1
    while TIMES * first <= n:
        last = first
        size = 0
        while TIMES * last <= n and (size == 0 or size + n // (3 * last) < GRID):
            size += n // (3 * last) + 1
            last += 1
            if last - first >= GRID:
                break
        periods = np.arange(first, last)
        number = (n - 1 - periods) // (3 * periods) + 1  # places below n - q
        q = np.repeat(periods, number)
        turn = np.arange(len(q)) - np.repeat(np.cumsum(number) - number, number)
        yield turn * 3 * q, q
        first = last


def find(words: np.ndarray) -> np.ndarray:
    """(start, length, period) of each run, by start and then period, of a sequence of words given as numbers from 0."""
    n = len(words)
    found = []
    right, left = Extensions(words), Extensions(words[::-1])
    for i, q in _grid(n):
        same = words[i] == words[i + q]
        i, q = i[same], q[same]
        after = right.lce(i, i + q)
        before = left.lce(n - i - q, n - i)  # to the left of both places, which is to the right in the mirror
        length = before + after + q
        good = length >= np.maximum(LEAST, TIMES * q)
        found.append(np.stack([(i - before)[good], length[good], q[good]], axis=1))
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)  # by start, length, period
    # a run with period q has period 2q as well, over the same words: the first of equal stretches has the smallest
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in a run after its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:-1]) > 0


def words_of(text: str) -> list[bytes]:
    """The words of a text: what lies between ASCII white space."""
    return text.encode().split()


def numbers_of(words: list[bytes]) -> np.ndarray:
    """Words as numbers; equal words have equal numbers."""
    first: dict[bytes, int] = {}
    return np.fromiter(map(first.setdefault, words, count()), np.int64, len(words))


def _spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 64):  # bounded memory, whatever the batch holds
            part = batch.slice(k, 64)
            sizes, runs, collapsed = [], [], []
            for text in part.column("text"):
                words = words_of(text.as_py())
                rows = find(numbers_of(words))
                if len(rows):
                    words, size = [w for w, d in zip(words, dropped(len(words), rows).tolist()) if not d], len(words)
                else:
                    size = len(words)
                sizes.append(size)
                runs.append(rows)
                collapsed.append(b" ".join(words).decode())
            flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
            parts = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"])
            ends = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), parts),
                 pa.array(collapsed, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs and collapsed of every document.

    ``runs`` lists (start, length, period) in words by start: the maximal stretches whose smallest period is ``period``
    and that are at least 6 words and 4 periods long. ``collapsed`` is the text with one space between words and
    every word left out that a run holds after its first period.

    Each row is worked on by itself, so nothing is shuffled and a lost task is run again alone. Null and empty texts have
    no words, no runs and an empty ``collapsed``. Repeated rows each give a row, a null doc_id stays null, other columns
    are left out, and an empty table gives an empty result.
    """
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_spread, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def with_planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with one space between words, where a tenth of the documents, chosen by the CRC-32 of the id, repeat
    some of their words from a place on up to their end. A null doc_id is not chosen."""
    def run(batches):
        for batch in batches:
            out = []
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = words_of(text.as_py())
                h, n = zlib.crc32(str(i).encode()), len(words)
                if i is not None and h % 10 == 0 and n:
                    g = h // 10
                    a = g % n
                    unit = words[a:a + 1 + (n - a) // (3 + g % 8)]
                    words[a:] = (unit * ((n - a) // len(unit) + 1))[:n - a]
                out.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    rows = texts(docs)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def digests(found: DataFrame) -> DataFrame:
    """What ``detect`` found as numbers: the longest run (ties: the first) and digests of all runs and of the text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    rows = found.withColumn("top", longest)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.back")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.less")).alias("period"),
        F.floor(F.expr("(1000 * top.length) div (-top.less)")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
