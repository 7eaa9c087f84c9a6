"""Approximate nearest neighbours with balanced posting lists.

Nearness is the inner product. A score is length times direction, so vectors
are first parted into bands of nearly equal length, and the vectors of a band
are clustered by direction. The lists are balanced: k-means gives each centroid
a weight that grows while its list is too full, and the weights hold for the
whole table. A vector goes to its best centroid and, when it lies near a border,
to up to COPIES lists in all: those whose distance is within BORDER of the best
one's and that no chosen centroid close by already stands for.

A list's reach for a query is the score that its best member is expected to
have: longest length times the mean along the query, plus what the members'
spread adds. Reach is an inner product of the query with one point per list, so
the lists with the largest reach are found by a best-first search in an
in-memory neighbour graph of these points. The gap between the largest score
possible and the reach is a squared distance; a query's lists are those whose
distance is within a ratio of the nearest list's. The ratio is not fixed: TRIED
queries are answered by brute force first, and the smallest ratio is taken whose
lists hold TARGET of their true neighbours. There is no cap on lists, and a
query always gets lists with enough vectors to fill its answer. Where a search of
the graph would follow a good part of the points, all are scored at once instead.

Equal vectors are one entry holding its smallest ids, as many as a result can
use, so a vector that a third of all rows repeat costs one entry. Lists are cut
into parts of at most about PART entries, which are dealt into buckets of about
BUCKET. A task scans the parts of one bucket for one block of the queries that
ask for them: a query comes once, with the numbers of its parts there, and is
held against a part only for what beats its best so far. One row of a query's
best in the bucket goes on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.session import delete_path, release, scratch_path

from .common import prepare, shuffle_partitions

BAND, BANDS = 1.25, 64     # ratio of the lengths in a band; bands at most, the last one open
SAMPLE = 65_536            # vectors the centroids are fitted on, about, at most
PER_LIST = 50              # of them for a list, as long as SAMPLE lasts
LIST_SIZE = 128            # vectors in a list, aimed at
MAX_LISTS = 16_384         # points of the graph, which every task holds
COPIES, BORDER = 4, 1.1    # lists a vector stands in at most, and how much farther they may be
APART = 0.12               # chosen centroids lie at least this share of the vector's squared distance apart
TRIED, TARGET = 256, 0.97  # queries the ratio is fitted on, and the share of their neighbours it keeps
SPREAD = 3.0               # standard deviations by which a list's best member is expected to stand out
DEGREE, BEAM = 24, 32      # of the graph and, at least, its search
AT_ONCE = 4                # points that a search follows in one step
PART = 4096                # entries of a list that stay together
DIRECT = 256               # a search of a beam of n scores up to n times as many points at once
BUCKET = 131_072           # entries in a task, about
QUERIES_AT_ONCE = 1 << 24  # 4-byte words of queries and the numbers of their list parts in a task, about
SCANNED = 1024             # queries scanned together
ROWS = 2048                # rows of the sample compared at once


def balanced_directions(x: np.ndarray, k: int, seed: int = 1, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """k unit centroids of unit vectors and their weights: a vector belongs
    where ``x @ c - weight`` is largest. Many centroids are fitted in two
    levels, a few groups first and then each group's own."""
    rng = np.random.default_rng(seed)
    if k > 128:
        top = round(math.sqrt(k))
        c, weight = balanced_directions(x, top, seed, rounds)
        own = _owners(x, c, weight)[0]
        parts = [x[own == g] for g in range(top)]
        share = [max(1, round(k * len(p) / len(x))) for p in parts]
        fitted = [balanced_directions(p, min(n, len(p)), seed, rounds) for p, n in zip(parts, share) if len(p)]
        c, weight = np.concatenate([f[0] for f in fitted]), np.concatenate([f[1] for f in fitted])
        rounds = 4  # and a few rounds over all, for vectors at the groups' borders
    else:
        c, weight = x[rng.choice(len(x), k, replace=False)].copy(), np.zeros(k)
    k = len(c)
    for _ in range(rounds):
        own, gap = _owners(x, c, weight)
        load = np.bincount(own, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        norm = np.sqrt((sums * sums).sum(1))
        ok = norm > 1e-9
        c[ok] = sums[ok] / norm[ok, None]
        if not ok.all():  # an empty list starts again at a vector of the fullest ones
            c[~ok] = x[rng.choice(len(x), int((~ok).sum()), p=load[own] / load[own].sum())]
            weight[~ok] = 0
        weight += gap * np.clip(load * k / len(x) - 1, -0.5, 1)
    return c, weight


def _owners(x: np.ndarray, c: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """(each vector's centroid, the median lead over the second best)."""
    own, lead = np.empty(len(x), np.int64), np.zeros(len(x))
    for lo in range(0, len(x), ROWS):
        s = x[lo:lo + ROWS] @ c.T - weight
        own[lo:lo + ROWS] = s.argmax(1)
        if len(c) > 1:
            r = np.arange(len(s))
            best = s[r, own[lo:lo + ROWS]]
            s[r, own[lo:lo + ROWS]] = -np.inf
            lead[lo:lo + ROWS] = best - s.max(1)
    return own, float(np.median(lead)) if len(x) else 0.0


class PointGraph:
    """Neighbour graph over points, searched for the largest inner products.
    One more component makes all points equally long, so that the nearest
    points of a point are those with the largest products."""

    def __init__(self, points: np.ndarray):
        k = len(points)
        square = (points * points).sum(1)
        self.p = np.concatenate([points, np.sqrt(np.maximum(square.max(initial=0) - square, 0))[:, None]], 1)
        if k <= DIRECT * BEAM:  # all points are scored at once
            return
        m = min(DEGREE, k - 1)
        self.near = np.empty((k, m), np.int64)
        for lo in range(0, k, 512):
            s = self.p[lo:lo + 512] @ self.p.T
            s[np.arange(len(s)), lo + np.arange(len(s))] = -np.inf
            self.near[lo:lo + 512] = np.argpartition(-s, min(m, k - 1) - 1, 1)[:, :m] if m else 0
        # entries spread over the points: each the farthest from those before
        entry = [0]
        close = self.p @ self.p[0]
        for _ in range(min(k, 32) - 1):
            entry.append(int(close.argmin()))
            close = np.maximum(close, self.p @ self.p[entry[-1]])
        self.entry = np.array(sorted(set(entry)))

    def search(self, q: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        """(point numbers, products), the largest first, ``want`` each; -1 and
        -inf where fewer were reached."""
        n, k = len(q), len(self.p)
        beam = min(k, max(BEAM, want + want // 2))
        if k <= DIRECT * max(beam, BEAM):
            return self._direct(q, min(want, beam))
        q = np.concatenate([q, np.zeros((n, 1))], 1)
        known = np.zeros((n, k), bool)
        known[:, self.entry] = True
        ids, score, done = np.full((n, beam), -1), np.full((n, beam), -np.inf), np.ones((n, beam), bool)
        m = min(beam, len(self.entry))
        s = q @ self.p[self.entry].T
        top = np.argsort(-s, 1)[:, :m]
        ids[:, :m], score[:, :m], done[:, :m] = self.entry[top], np.take_along_axis(s, top, 1), False
        rows = np.arange(n)
        while True:
            open_ = np.where(done, -np.inf, score)
            r = rows[np.isfinite(open_).any(1)]
            if not len(r):
                break
            # the best open points of each query are followed at once
            at = np.argpartition(-open_[r], min(AT_ONCE, beam) - 1, 1)[:, :AT_ONCE]
            follow = np.isfinite(np.take_along_axis(open_[r], at, 1))
            done[r[:, None], at] = True
            nb = np.where(follow[:, :, None], self.near[np.take_along_axis(ids[r], at, 1)], self.entry[0]).reshape(len(r), -1)
            nb.sort(1)
            new = ~known[r[:, None], nb]
            new[:, 1:] &= nb[:, 1:] != nb[:, :-1]
            known[r[:, None], nb] = True
            s = np.matmul(self.p[nb], q[r][:, :, None])[:, :, 0]
            s[~new] = -np.inf
            all_s = np.concatenate([score[r], s], 1)
            top = np.argpartition(-all_s, beam - 1, 1)[:, :beam]
            ids[r] = np.take_along_axis(np.concatenate([ids[r], nb], 1), top, 1)
            done[r] = np.take_along_axis(np.concatenate([done[r], ~new], 1), top, 1)
            score[r] = np.take_along_axis(all_s, top, 1)
        order = np.argsort(-score, 1, kind="stable")[:, :want]
        ids, score = np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)
        ids[~np.isfinite(score)] = -1
        return ids, score

    def _direct(self, q: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        ids, score = np.empty((len(q), want), np.int64), np.empty((len(q), want))
        for lo in range(0, len(q), 256):
            s = q[lo:lo + 256] @ self.p[:, :-1].T
            top = np.argpartition(-s, want - 1, 1)[:, :want] if want < s.shape[1] else np.broadcast_to(np.arange(want), s.shape)
            part = np.take_along_axis(s, top, 1)
            order = np.argsort(-part, 1, kind="stable")
            ids[lo:lo + 256], score[lo:lo + 256] = np.take_along_axis(top, order, 1), np.take_along_axis(part, order, 1)
        return ids, score


class Cells:
    """The lists of all bands: where a vector is posted."""

    def __init__(self, fitted: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.first, self.graphs, at = {}, {}, 0
        self.c = np.concatenate([c for c, _ in fitted.values()])
        for band, (c, weight) in fitted.items():
            self.first[band], at = at, at + len(c)
            self.graphs[band] = PointGraph(np.concatenate([c, -weight[:, None]], 1))

    def post(self, unit: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every posting."""
        rows, cells = [], []
        for band in np.unique(bands):
            at = np.flatnonzero(bands == band)
            x = unit[at]
            got, s = self.graphs[band].search(np.concatenate([x, np.ones((len(x), 1))], 1), 2 * COPIES)
            got = np.where(got < 0, got[:, :1], got) + self.first[band]
            far = 2 - 2 * np.matmul(self.c[got], x[:, :, None])[:, :, 0]  # squared distance of unit vectors
            ok = np.isfinite(s) & (far <= BORDER ** 2 * far[:, :1] + 1e-12)
            apart = 2 - 2 * np.matmul(self.c[got], self.c[got].transpose(0, 2, 1))
            for j in range(1, got.shape[1]):
                # a chosen centroid close by stands for this one
                ok[:, j] &= (ok[:, :j].sum(1) < COPIES) & ~(ok[:, :j] & (apart[:, j, :j] < APART * far[:, j:j + 1])).any(1)
            ok[:, 0] = True
            i, j = np.nonzero(ok)
            rows.append(at[i])
            cells.append(got[i, j])
        return np.concatenate(rows), np.concatenate(cells)


class Reach:
    """Which lists a query looks into."""

    def __init__(self, c: np.ndarray, size: np.ndarray, longest: np.ndarray, mean_cos: np.ndarray):
        spread = SPREAD * longest * np.sqrt(np.maximum(1 - mean_cos ** 2, 0) / c.shape[1])
        self.size = size
        self.cells = np.flatnonzero(size)
        self.points = np.concatenate([(longest * mean_cos)[:, None] * c, spread[:, None]], 1)[self.cells]
        self.most = float((longest * np.abs(mean_cos) + spread).max()) * (1 + 1e-9)
        self.graph = PointGraph(self.points)
        self.ratio, self.usual = math.inf, 32  # usual: lists that most queries look into

    def far(self, reach: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.most - reach, 0))

    def ratios(self, unit: np.ndarray) -> np.ndarray:
        """The distance ratio of every list (by its number) for a few queries."""
        far = self.far(np.concatenate([unit, np.ones((len(unit), 1))], 1) @ self.points.T)
        out = np.full((len(unit), len(self.size)), np.inf)
        out[:, self.cells] = far / np.maximum(far.min(1), 1e-12)[:, None]
        return out

    def aim(self, unit: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, list) of the lists within the ratio, and of more where
        those hold fewer than ``least`` postings."""
        q = np.concatenate([unit, np.ones((len(unit), 1))], 1)
        todo, want = np.arange(len(q)), self.usual
        rows, cells = [], []
        if len(self.cells) <= DIRECT * BEAM:
            short = []
            for lo in range(0, len(q), 256):
                far = self.far(q[lo:lo + 256] @ self.points.T)
                keep = far <= self.ratio * far.min(1)[:, None] + 1e-12
                few = keep @ self.size[self.cells] < least
                short.append(lo + np.flatnonzero(few))
                keep[few] = False
                i, j = np.nonzero(keep)
                rows.append(lo + i)
                cells.append(self.cells[j])
            todo = np.concatenate(short) if short else todo
        while len(todo):
            got, s = self.graph.search(q[todo], want)
            far = self.far(np.where(np.isfinite(s), s, -np.inf))
            held = np.where(got >= 0, self.size[self.cells[got]], 0)
            before = np.cumsum(held, 1) - held
            keep = (got >= 0) & ((far <= self.ratio * far[:, :1] + 1e-12) | (before < least))
            # all of it is known once a list beyond the ratio was met
            over = ~keep[:, -1] | (got.shape[1] >= len(self.cells))
            i, j = np.nonzero(keep & over[:, None])
            rows.append(todo[i])
            cells.append(self.cells[got[i, j]])
            todo, want = todo[~over], want * 2
        return np.concatenate(rows) if rows else todo, np.concatenate(cells) if cells else todo


def _grid(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def lengths(x: np.ndarray) -> np.ndarray:
    """Lengths without overflow or underflow on the way."""
    big = np.abs(x).max(1, initial=0)
    return np.minimum(big * np.sqrt(((x / np.where(big > 0, big, 1)[:, None]) ** 2).sum(1)), 1e300)


def units(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(1, initial=0)
    y = x / np.where(big > 0, big, 1)[:, None]
    return y / np.sqrt((y * y).sum(1))[:, None]


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as packed doubles; the unusable ones leave. Zeros at the end
    change no score and are cut."""
    for b in batches:
        column = b.column(1)
        dims = np.unique(pc.list_value_length(column).to_numpy(zero_copy_only=False)) if not column.null_count and b.num_rows else ()
        if len(dims) == 1 and dims[0] > 0 and not b.column(0).null_count and not column.flatten().null_count:
            x = column.flatten().to_numpy().astype(np.float64).reshape(b.num_rows, -1) + 0.0
            if np.isfinite(x).all() and (x[:, -1] != 0).all():
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v.tobytes() for v in x], pa.binary())], ["vec_id", "v"])
                continue
        ids, vs = [], []
        for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if i is None or not v or None in v:
                continue
            a = np.array(v, np.float64) + 0.0  # -0.0 and 0.0 are the same component
            if np.isfinite(a).all() and a.any():
                ids.append(i)
                vs.append(a[:np.flatnonzero(a)[-1] + 1].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vs, pa.binary())], ["vec_id", "v"])


def _padded(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vs = [v.ljust(8 * dim, b"\0") for v in b.column(1).to_pylist()]
            x = np.frombuffer(b"".join(vs), np.float64).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(vs, pa.binary()), pa.array(lengths(x), pa.float64())], ["vec_id", "v", "norm"])
    return run


def top_of(s: np.ndarray, k: int, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest of each row, and of those within ``room`` of them."""
    if s.shape[1] <= k:
        i, j = np.indices(s.shape)
        return i.ravel(), j.ravel()
    return np.nonzero(s >= (np.partition(s, -k, axis=1)[:, -k] - room)[:, None])


def _place(key: np.ndarray) -> np.ndarray:
    """Each element's place among its equal neighbours, from 0."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return np.arange(len(key)) - np.flatnonzero(new)[np.cumsum(new) - 1]


def _flat(column: pa.ChunkedArray, kind, width: int | None = None) -> np.ndarray:
    """The values of packed cells, one row each if all have ``width`` values."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    out = np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].view(kind) if at[-1] > at[0] else np.empty(0, kind)
    return out if width is None else out.reshape(-1, width)


def _cells(rows: np.ndarray, n: int, *values: np.ndarray) -> list[pa.Array]:
    """Values of n rows, sorted by row, as one packed cell a row."""
    at = np.searchsorted(rows, np.arange(n + 1))
    return [pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((at * v.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(v))]) for v in values]


def _best(y: np.ndarray, asks: list[np.ndarray], x: np.ndarray, holds: list[np.ndarray], low: np.ndarray, name: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row of x, score), sorted: the k best of each query among the rows
    of the list parts it asks for, an entry (``name``) once; ties by ``low``."""
    held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    bar, new, size = np.full(len(y), -np.inf), [], 0
    with np.errstate(over="ignore"):  # by how much a product may be off
        off = 1e-9 * (lengths(y) * lengths(x).max(initial=0) + 1e-300)

    def settle():
        nonlocal held, new, size
        i, j, s = (np.concatenate(c) for c in zip(held, *new))
        order = np.lexsort((name[j], low[j], -s, i))
        i, j, s = i[order], j[order], s[order]
        once = np.ones(len(i), bool)
        # equal scores and lows stand together, and so do the copies of an entry
        once[1:] = (i[1:] != i[:-1]) | (name[j[1:]] != name[j[:-1]])
        i, j, s = i[once], j[once], s[once]
        place = _place(i)
        ok = place < k
        full = place == k - 1
        bar[i[full]] = s[full]
        held, new, size = (i[ok], j[ok], s[ok]), [], 0

    for a, h in zip(asks, holds):
        if not len(a):
            continue
        part = x[h]
        s = y[a] @ part.T
        room = off[a]
        over = s >= (bar[a] - room)[:, None]
        many = np.flatnonzero(over.sum(1) > 2 * k)
        if len(many):  # no more than the k best of the part
            least = np.partition(s[many], -k, axis=1)[:, -k] - room[many]
            over[many] &= s[many] >= least[:, None]
        i, j = np.nonzero(over)
        new.append((a[i], h[j], (part[j] * y[a[i]]).sum(1)))
        size += len(i)
        if size > max(len(held[0]), 2 * k * len(y)):
            settle()
    settle()
    return held


def _merge(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The k best neighbours of each query from its best of each bucket; rows come sorted by query."""
    def ranked(t: pa.Table) -> pa.RecordBatch:
        score, entry, many, ids = (_flat(t.column(c), kind) for c, kind in (("scores", np.float64), ("entries", np.int64), ("counts", np.int32), ("ids", np.int64)))
        sizes = np.array([len(c) // 8 for c in t.column("scores").to_pylist()], np.int64)
        query, first = np.repeat(t.column("query_id").to_numpy(), sizes), np.cumsum(many) - many
        order = np.lexsort((-score, entry, query))
        q, e = query[order], entry[order]
        once = np.ones(len(order), bool)  # an entry found in several buckets counts once
        once[1:] = (q[1:] != q[:-1]) | (e[1:] != e[:-1])
        at = order[once]
        n = many[at].astype(np.int64)
        rows = np.repeat(at, n)
        vec = ids[np.repeat(first[at], n) + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)] if len(rows) else np.empty(0, np.int64)
        q, s = query[rows], score[rows]
        other = vec != q
        q, s, vec = q[other], s[other], vec[other]
        order = np.lexsort((vec, -s, q))
        q, s, vec = q[order], s[order], vec[order]
        rank = _place(q) + 1
        ok = rank <= k
        return pa.RecordBatch.from_arrays([pa.array(q[ok], pa.int64()), pa.array(rank[ok], pa.int32()), pa.array(vec[ok], pa.int64()), pa.array(s[ok], pa.float64())],
                                          ["query_id", "rank", "vec_id", "score"])

    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        if sum(x.num_rows for x in held) >= 8 * ROWS:
            t = pa.Table.from_batches(held).combine_chunks()
            q = t.column("query_id").to_numpy()
            cut = int(np.searchsorted(q, q[-1]))  # the last query may go on in the next batch
            if cut:
                yield ranked(t.slice(0, cut))
            held = pa.concat_tables([t.slice(cut)]).combine_chunks().to_batches()
    if held:
        yield ranked(pa.Table.from_batches(held).combine_chunks())


def nearest(vectors: DataFrame, k: int = 20, query_mod: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row
    (id divisible by ``query_mod``) among all other rows.

    Score is the inner product of the original vectors in double precision;
    ties go to the smaller id. Vectors that are null, zero or hold a null or
    non-finite component, and rows with a null id, take no part. A shorter
    vector counts as padded with zeros. A row repeated with its id and vector
    counts once; an id on several vectors takes part with each. With fewer
    candidates all are returned; an empty table gives none.
    """
    spark = prepare(vectors.sparkSession)
    root = scratch_path(spark, "ann")
    n_parts = shuffle_partitions(spark)

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    src = vectors.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{vec_col}`"))
    rows = stored(src.mapInArrow(_usable, "vec_id long, v binary").distinct(), "rows")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = (rows.agg(F.max(F.length("v"))).first()[0] or 0) // 8
    if not dim:
        return empty
    rows = stored(rows.mapInArrow(_padded(dim), "vec_id long, v binary, norm double"), "padded")
    delete_path(spark, f"{root}/rows")
    # equal vectors are one entry; k + 1 ids are all a result can use of it
    first = Window.partitionBy("v").orderBy("vec_id")
    entries = (rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
               .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.max("norm").alias("norm")))
    entries = stored(entries.select(F.monotonically_increasing_id().alias("entry"), "v", "ids", "norm"), "entries")
    longest = entries.agg(F.max("norm")).first()[0]
    band = F.least(F.lit(BANDS - 1), F.floor((F.log(F.lit(longest)) - F.log("norm")) / math.log(BAND) + 1e-6)).cast("int")
    entries = entries.withColumn("band", band)
    counts = {r["band"]: r["count"] for r in entries.groupBy("band").count().collect()}

    cells = spark.sparkContext.broadcast(Cells(_fit(entries, counts, dim)))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = cells.value
        for b in batches:
            if not b.num_rows:
                continue
            unit = units(_grid(b.column(1), dim))
            r, c = g.post(unit, b.column(4).to_numpy())
            order = np.argsort(r, kind="stable")
            r, c = r[order], c[order]
            at = pa.array(np.searchsorted(r, np.arange(b.num_rows + 1)), pa.int32())
            cos = (g.c[c] * unit[r]).sum(1)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.ListArray.from_arrays(at, pa.array(c)), pa.ListArray.from_arrays(at, pa.array(cos))],
                                             ["entry", "v", "ids", "norm", "cells", "cos"])

    # one row an entry, with its lists
    entries = stored(entries.select("entry", "v", "ids", "norm", "band")
                     .mapInArrow(post, "entry long, v binary, ids array<long>, norm double, cells array<long>, cos array<double>"), "posted")
    delete_path(spark, f"{root}/entries")
    release(spark)
    postings = entries.select("entry", "v", "ids", "norm", F.explode(F.arrays_zip("cells", "cos")).alias("p")).select("p.cells", "entry", "v", "ids", "norm", "p.cos").withColumnRenamed("cells", "cell")
    lists = postings.groupBy("cell").agg(F.count("*").alias("n"), F.max("norm").alias("longest"), F.avg("cos").alias("cos")).collect()  # MAX_LISTS rows
    c = cells.value.c
    size, far_out, mean_cos = np.zeros(len(c), np.int64), np.zeros(len(c)), np.zeros(len(c))
    for r in lists:
        size[r["cell"]], far_out[r["cell"]], mean_cos[r["cell"]] = r["n"], r["longest"], r["cos"]
    reach = Reach(c, size, far_out / longest, mean_cos)
    reach.ratio, reach.usual = _fit_ratio(reach, entries, postings, dim, k, query_mod)
    reach = spark.sparkContext.broadcast(reach)

    def aim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            r, cell = reach.value.aim(units(_grid(b.column(1), dim)), COPIES * (k + 1))
            asks = np.zeros((b.num_rows, len(size)), bool)
            asks[r, cell] = True
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x.tobytes() for x in np.packbits(asks, axis=1)], pa.binary()), pa.array(asks @ n_parts_of, pa.int64())],
                                             ["query_id", "v", "cells", "pairs"])

    # the parts of the lists are numbered; a part's bucket follows from its number
    n_parts_of = -(-size // PART)
    first_part = np.cumsum(n_parts_of) - n_parts_of
    asked = rows.where(F.pmod("vec_id", F.lit(query_mod)) == 0).select("vec_id", "v").mapInArrow(aim, "query_id long, v binary, cells binary, pairs long")
    asked = stored(asked, "asked")
    delete_path(spark, f"{root}/padded")
    release(spark)

    # a task holds one bucket of list parts and one block of the queries that ask for them
    buckets = max(n_parts, math.ceil(int(size.sum()) / BUCKET))
    told = asked.agg(F.count("*").alias("n"), F.sum("pairs").alias("pairs")).first()
    blocks = max(1, math.ceil((2 * dim * told["n"] + (told["pairs"] or 0) / buckets) / QUERIES_AT_ONCE))
    parts = spark.createDataFrame(pa.table({"cell": pa.array(np.flatnonzero(size)), "parts": pa.array(n_parts_of[size > 0], pa.int32()), "first_part": pa.array(first_part[size > 0])}))
    own_part = F.col("first_part") + F.pmod(F.xxhash64("entry"), F.col("parts"))
    there = (postings.join(F.broadcast(parts), "cell").select(own_part.alias("part"), "entry", "v", "ids")
             .select(F.pmod("part", F.lit(buckets)).cast("int").alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "part", "entry", "v", "ids"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 128):
                b = whole.slice(lo, 128)
                cells = np.unpackbits(np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(b.num_rows, -1), axis=1, count=len(size))
                r, cell = np.nonzero(cells)
                n = n_parts_of[cell]
                r, part = np.repeat(r, n), np.repeat(first_part[cell] - np.cumsum(n) + n, n) + np.arange(n.sum())
                group = r * buckets + part % buckets
                order = np.argsort(group, kind="stable")
                group, part = group[order], part[order].astype(np.int32)
                named, at = np.unique(group, return_inverse=True)
                of = pa.array(named // buckets)
                yield pa.RecordBatch.from_arrays([pa.array(named % buckets, pa.int32()), b.column(0).take(of), b.column(1).take(of), *_cells(at, len(named), part)],
                                                 ["bucket", "query_id", "q", "parts"])

    here = (asked.select("query_id", "v", "cells").mapInArrow(spread, "bucket int, query_id long, q binary, parts binary")
            .withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")))

    def scan(q: pa.Table, p: pa.Table) -> pa.Table:
        names = ["query_id", "scores", "entries", "counts", "ids"]
        if not q.num_rows or not p.num_rows:
            return pa.table([pa.array([], pa.int64()), *(pa.array([], pa.binary()) for _ in names[1:])], names=names)
        y, x = _flat(q.column("q"), np.float64, dim), _flat(p.column("v"), np.float64, dim)
        entry, ids = p.column("entry").to_numpy(), p.column("ids").combine_chunks()
        ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
        offsets, ids = ids.offsets.to_numpy(), ids.values.to_numpy()
        low = ids[offsets[:-1]]
        part = p.column("part").to_numpy()
        order = np.argsort(part, kind="stable")
        there_, at = np.unique(part[order], return_index=True)
        holds = np.split(order, at[1:])
        packed = q.column("parts").to_pylist()
        found = []
        for lo in range(0, len(y), SCANNED):
            some = [np.frombuffer(c, np.int32) for c in packed[lo:lo + SCANNED]]
            asks = np.zeros((len(some), len(there_)), bool)
            want, row = np.concatenate(some), np.repeat(np.arange(len(some)), [len(c) for c in some])
            col = np.minimum(np.searchsorted(there_, want), len(there_) - 1)
            here_ = there_[col] == want
            asks[row[here_], col[here_]] = True
            # one more than needed: the query's own entry may be among them
            i, j, s = _best(y[lo:lo + SCANNED], [np.flatnonzero(c) for c in asks.T], x, holds, low, entry, k + 1)
            found.append((lo + i, j, s))
        i, j, s = (np.concatenate(c) for c in zip(*found))
        n = (offsets[1:] - offsets[:-1])[j].astype(np.int64)
        flat = np.repeat(offsets[j] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return pa.table([q.column("query_id").combine_chunks(), *_cells(i, len(y), s, entry[j], n.astype(np.int32)), *_cells(np.repeat(i, n), len(y), ids[flat])], names=names)

    found = (here.groupBy("bucket", "block").cogroup(there.groupBy("bucket", "block"))
             .applyInArrow(scan, "query_id long, scores binary, entries binary, counts binary, ids binary"))
    return (found.repartition(n_parts, "query_id").sortWithinPartitions("query_id")
            .mapInArrow(lambda batches: _merge(batches, k), "query_id long, rank int, vec_id long, score double"))


def _fit(entries: DataFrame, counts: dict[int, int], dim: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Each band's centroids and weights, from a hash sample of about SAMPLE vectors."""
    lists = {b: max(1, math.ceil(n / LIST_SIZE)) for b, n in counts.items()}
    scale = min(1.0, MAX_LISTS / sum(lists.values()))
    lists = {b: max(1, int(n * scale)) for b, n in lists.items()}
    scale = min(1.0, SAMPLE / sum(PER_LIST * n for n in lists.values()))
    rate = {b: min(1.0, PER_LIST * lists[b] * scale / counts[b] + 8 / counts[b]) for b in counts}
    bar = F.create_map(*[F.lit(x) for b, r in sorted(rate.items()) for x in (b, int(r * (1 << 30)))])
    hashed = F.pmod(F.xxhash64("v"), F.lit(1 << 30))
    picked = entries.where(hashed <= bar[F.col("band")]).orderBy(F.xxhash64("v")).limit(2 * SAMPLE).select("band", "v").toArrow()
    bands = picked.column("band").to_numpy()
    x = units(_grid(picked.column("v"), dim))
    return {b: balanced_directions(x[bands == b], min(n, max(1, int((bands == b).sum()) // 4))) if (bands == b).any()
            else (np.eye(1, dim), np.zeros(1)) for b, n in sorted(lists.items())}


def _fit_ratio(reach: Reach, entries: DataFrame, postings: DataFrame, dim: int, k: int, query_mod: int) -> tuple[float, int]:
    """The smallest distance ratio whose lists hold TARGET of the true
    neighbours of TRIED queries, which are found by brute force in one scan;
    and the number of lists within it for most of them."""
    spark = entries.sparkSession
    tried = (entries.where(F.exists("ids", lambda i: F.pmod(i, F.lit(query_mod)) == 0)).orderBy(F.xxhash64("v"), "entry").limit(TRIED)
             .select("entry", "v").toArrow())
    if not tried.num_rows:
        return 1.0, 1
    own, y = tried.column("entry").to_numpy(), _grid(tried.column("v"), dim)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for b in batches:  # the k best of the task so far stay
            names, x = b.column(0).to_numpy(), _grid(b.column(1), dim)
            s = y @ x.T
            s[own[:, None] == names] = -np.inf
            i, j = top_of(s, k, np.zeros(len(y)))
            part = (i, names[j], s[i, j])
            best = part if best is None else tuple(np.concatenate(c) for c in zip(best, part))
            order = np.lexsort((best[1], -best[2], best[0]))
            best = tuple(c[order] for c in best)
            ok = (_place(best[0]) < k) & np.isfinite(best[2])
            best = tuple(c[ok] for c in best)
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array(best[0], pa.int64()), pa.array(best[1], pa.int64()), pa.array(best[2], pa.float64())], ["query", "entry", "score"])

    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "entry"))
    true = (entries.select("entry", "v").mapInArrow(scan, "query long, entry long, score double")
            .withColumn("place", place).where(F.col("place") <= k).select("query", "entry"))
    where = true.join(postings.select("entry", "cell"), "entry").groupBy("query", "entry").agg(F.collect_set("cell").alias("cells")).collect()
    ratios = reach.ratios(units(y))
    needed = sorted(float(ratios[r["query"], r["cells"]].min()) for r in where)
    ratio = needed[min(len(needed) - 1, math.ceil(TARGET * len(needed)))] * (1 + 1e-9) if needed else 1.0
    return ratio, int(np.percentile((ratios <= ratio).sum(1), 90)) + 8


def nearest_exact(vectors: list[tuple[int, list]], k: int = 20, query_mod: int = 20) -> dict[int, list[tuple[int, float]]]:
    """Brute force over a small list, for tests and recall."""
    ok = [(i, np.array(v, np.float64)) for i, v in vectors
          if i is not None and v is not None and len(v) and not any(c is None for c in v) and np.isfinite(np.array(v, np.float64)).all() and np.any(v)]
    dim = max((len(v) for _, v in ok), default=0)
    ids, grid = [i for i, _ in ok], np.array([np.pad(v, (0, dim - len(v))) for _, v in ok]).reshape(-1, dim)
    out = {}
    for q, y in zip(ids, grid):
        if q % query_mod == 0:
            got = sorted((-s, i) for i, s in zip(ids, (grid * y).sum(1).tolist()) if i != q)[:k]
            out[q] = [(i, -s) for s, i in got]
    return out
