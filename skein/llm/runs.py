"""Periodic runs in texts through a dictionary of basic factors.

Words of a text are numbered from 0. A run is a longest stretch whose words q
apart are identical, q being its smallest period, and at least 2 * q long.

For every power of two L the dictionary names the stretches ("factors") of L
words: two positions of a text have one name exactly where their factors are
equal. A run of period q with L <= q < 2L repeats the factor at its start q
words later, so q is found among the successor occurrences of a factor within
2L. Occurrences that follow each other by at most L/2 do so by one and the same
difference, the factor's own period: they form an arithmetic progression, and
at most three progressions follow within 2L. Of two progressions A and B, a
period is proposed

* from every member of A to the first member of B, and
* from the last member of A to the last member of B.

That is enough. Where the run goes on past the end of A's own stretch of small
period, that end is repeated q words later, so the last members correspond.
Where it doesn't, the stretch reaches into the run's second period, which
leaves B no member before the one that corresponds to the run's start.

Proposals are extended to both sides by comparing names from long factors to
short ones. Proposals of one run meet in its start and end; the smallest period
stays. Only positions whose factor occurs again in its text are carried to the
next power of two, so a text without repeats costs little.

Work is per text, so the corpus is scanned once, in place, without a shuffle.
Texts are handled many at a time in numpy: a block of texts is one sequence
whose factors never cross a text's end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, blocks, prepare

LEAST_LENGTH = 12
BLOCK_BYTES = 1 << 20


class FactorDictionary:
    """Names of the factors of 1, 2, 4, ... words at every position of several
    texts laid end to end. ``word`` holds word numbers, ``text`` the number of
    each position's text and ``end`` the end of that text."""

    def __init__(self, word: np.ndarray, text: np.ndarray, end: np.ndarray):
        self.n = len(word)
        self.text, self.end = text, end
        own = -np.arange(1, self.n + 1)  # a factor that occurs once is named after its position
        self.names: list[np.ndarray] = []
        self.alive: list[np.ndarray] = []  # positions whose factor occurs again in its text
        at, key = np.arange(self.n), word.astype(np.int64)
        length = 1
        while len(at):
            pair = text[at] * (int(key.max()) + 1) + key
            _, name, many = np.unique(pair, return_inverse=True, return_counts=True)
            again = many[name] > 1
            at, name = at[again], name[again]
            if not len(at):
                break
            full = own.copy()
            full[at] = name
            self.names.append(full)
            self.alive.append(at)
            # the factor twice as long: this one and the one that follows it
            at = at[at + 2 * length <= end[at]]
            second = full[at + length]
            at, second = at[second >= 0], second[second >= 0]
            key = full[at] * (int(name.max()) + 1) + second
            # names stay small, so that the next pair fits 64 bits
            key = np.unique(key, return_inverse=True)[1] if len(at) else key
            length *= 2

    def successors(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(occurrences grouped by factor in order of place, the index of each
        one's successor or -1)."""
        at = self.alive[level]
        order = np.lexsort((at, self.names[level][at]))
        at = at[order]
        name = self.names[level][at]
        nxt = np.full(len(at), -1)
        same = np.flatnonzero(name[:-1] == name[1:])
        nxt[same] = same + 1
        return at, nxt

    def proposals(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, period) with factor length <= period < twice that."""
        length = 1 << level
        at, nxt = self.successors(level)
        n = len(at)
        gap = np.where(nxt >= 0, at[np.maximum(nxt, 0)] - at, 1 << 60)
        breaks = 2 * gap > length  # the last member of a progression
        ids = np.arange(n)
        group = np.concatenate([[0], np.cumsum(breaks)[:-1]]) if n else ids
        last = np.flatnonzero(breaks)
        first = np.concatenate([[0], last[:-1] + 1]) if n else last
        chained = nxt[last] >= 0  # another progression of the same factor follows
        found_at, found_p = [], []
        for step in (1, 2, 3):
            # progressions that have a step-th follower of the same factor
            ok = np.zeros(len(last), bool)
            ok[:max(0, len(last) - step)] = True
            for s in range(step):
                ok[:len(last) - s] &= chained[s:]
            own = ids[ok[group]]
            to = at[first[group[own] + step]]
            tail = np.flatnonzero(ok)
            x = np.concatenate([at[own], at[last[tail]]])
            p = np.concatenate([to, at[last[tail + step]]]) - x
            fits = (p >= length) & (p < 2 * length)
            found_at.append(x[fits])
            found_p.append(p[fits])
        x, p = np.concatenate(found_at), np.concatenate(found_p)
        order = np.lexsort((x, p))
        x, p = x[order], p[order]
        # neighbours of one period at most a factor apart overlap by that period: one run
        new = np.ones(len(x), bool)
        new[1:] = (p[1:] != p[:-1]) | (x[1:] - x[:-1] > length)
        return x[new], p[new]

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and b on are identical (a < b, one text)."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        todo = np.arange(len(a))
        top = len(self.names) - 1
        while len(todo):  # the longest factor may fit several times
            same = self._equal(top, a[todo], b[todo])
            todo = todo[same]
            a[todo] += 1 << top
            b[todo] += 1 << top
        for level in range(top - 1, -1, -1):
            same = self._equal(level, a, b)
            a[same] += 1 << level
            b[same] += 1 << level
        return a - start

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and b are identical (a < b, one text)."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        todo = np.arange(len(a))
        top = len(self.names) - 1
        while len(todo):
            same = self._equal(top, a[todo] - (1 << top), b[todo] - (1 << top))
            todo = todo[same]
            a[todo] -= 1 << top
            b[todo] -= 1 << top
        for level in range(top - 1, -1, -1):
            same = self._equal(level, a - (1 << level), b - (1 << level))
            a[same] -= 1 << level
            b[same] -= 1 << level
        return start - a

    def _equal(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        inside = (a >= 0) & (b < self.n)
        x, y = np.maximum(a, 0), np.minimum(b, self.n - 1)
        names = self.names[level]
        return inside & (names[x] >= 0) & (names[x] == names[y]) & (self.text[x] == self.text[y])

    def runs(self, least_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, period) of all runs, by start, then period."""
        spans = []
        for level in range(len(self.names)):
            x, p = self.proposals(level)
            if len(x):
                right = self.forward(x, x + p)
                left = self.backward(x, x + p)
                start, length = x - left, left + right + p
                ok = (length >= 2 * p) & (length >= least_length)
                spans.append(np.stack([start[ok], length[ok], p[ok]]))
        if not spans:
            none = np.empty(0, np.int64)
            return none, none, none
        start, length, p = np.concatenate(spans, axis=1)
        order = np.lexsort((p, length, start))
        start, length, p = start[order], length[order], p[order]
        # one stretch, one run: that of its smallest period
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
        start, length, p = start[new], length[new], p[new]
        order = np.lexsort((p, start))
        return start[order], length[order], p[order]


def runs_of(texts: list[list[bytes]], least_length: int = LEAST_LENGTH) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of several word lists at once."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not sizes.sum():
        return out
    numbers: dict[bytes, int] = {}
    word = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)
    start, length, period = FactorDictionary(word, text, ends[text]).runs(least_length)
    begins = ends - sizes
    for s, n, p in zip(start.tolist(), length.tolist(), period.tolist()):
        t = int(text[s])
        out[t].append((s - int(begins[t]), n, p))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


RUNS = "runs array<struct<start:long,length:long,period:long>>"


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): every run of each whole text, by
    start, then period, and the text's words without the repeats, joined by
    one space.

    Words are cut at blanks (0x20, 0x09-0x0D) and compared as they are. A null,
    empty or word-less text has no words, no runs and an empty collapsed text.
    Of the periods of one stretch the smallest counts; runs may overlap. Every
    row is answered by itself: repeated rows and ids, and null ids, give a row
    each. Other columns are not read; an empty table gives none. A text is held
    whole, with about log2(words) numbers a word where it repeats itself.
    """
    prepare(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for ids, texts in blocks(batches, BLOCK_BYTES):
            words = [t.split() if t else [] for t in texts]
            found = runs_of(words, least_length)
            rows = [[dict(zip(("start", "length", "period"), r)) for r in f] for f in found]
            short = [b" ".join(collapse(w, f)).decode("utf-8", "replace") for w, f in zip(words, found)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()), pa.array(rows, kind), pa.array(short, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), as_bytes(f"`{text_col}`"))
    return src.mapInArrow(scan, f"doc_id long, n_words long, {RUNS}, collapsed string")


def find_runs_plain(words: list, least_length: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """Every period tried at every place, for tests."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least_length, 2 * q):
                best.setdefault((i, length), q)
            i = j
    return sorted((s, length, q) for (s, length), q in best.items())
