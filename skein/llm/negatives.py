"""Hard-negative mining with segment summaries.

Vectors are quantised to integers, so scores are exact. A vector is cut into
segments, and each segment is stored with its mean m and its deviation s, the
length of what is left when the mean is taken off. By Cauchy and Schwarz the
score of two vectors lies within

    sum over segments of  width * m * m'  -  s * s'   and   ... + s * s'.

LEVELS cuts a vector ever finer. A pair is looked at on the coarsest level
first; if its interval can't reach the places still open it goes, the others
are refined on the next level, and what is left after the last one is scored
exactly. Nothing is lost: a pair goes only where its bounds prove it useless.

Anchors are the query set and meet all rows in blocks: a task holds about ROWS
rows and ANCHORS anchors, so no task grows with the tables, and a label or
vector that many rows share is spread like any other. Each task hands on an
anchor's best few, which are merged per anchor. The first pass finds the
positives, the second the negatives within each positive's window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.session import scratch_path

from .common import prepare, shuffle_partitions

LEVELS = (4, 16, 32)    # segments of a vector, coarse to fine
ROWS, ANCHORS = 32_768, 4_096
FEWEST = 2_048          # rows in a block, about, at least: every block hands on each anchor's best
STEP, GROUP = 1024, 256  # rows and anchors compared at once
LARGEST = 1 << 56        # scores saturate here; below 2 ** 53 they are exact


def summary(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each row's segments, side by side; the last
    segments may be padded with zeros, which leaves all scores as they are."""
    width = -(-max(1, x.shape[1]) // segments)
    wide = np.zeros((len(x), segments * width))
    wide[:, :x.shape[1]] = x
    cut = wide.reshape(len(x), segments, width)
    mean = cut.mean(2)
    rest = np.sqrt(((cut - mean[:, :, None]) ** 2).sum(2))
    return np.concatenate([mean * math.sqrt(width), rest], 1)


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lowest, highest) scores that two sets of summaries of one level allow."""
    k = a.shape[1] // 2
    centre, slack = a[:, :k] @ b[:, :k].T, a[:, k:] @ b[:, k:].T
    # room for the rounding of means, deviations and products
    slack += 1e-9 * np.sqrt((a * a).sum(1))[:, None] * np.sqrt((b * b).sum(1)) + 1e-6
    return centre - slack, centre + slack


class Block:
    """Vectors of one block with their ids, labels and summaries."""

    def __init__(self, t: pa.Table, dim: int):
        self.id = t.column("vec_id").to_numpy()
        self.label = t.column("label").to_numpy()
        self.x = np.frombuffer(b"".join(t.column("v").to_pylist()), np.float64).reshape(-1, dim)
        stored = np.frombuffer(b"".join(t.column("summary").to_pylist()), np.float64).reshape(len(self.x), -1)
        self.levels = np.split(stored, np.cumsum([2 * n for n in LEVELS])[:-1], axis=1)


def best_rows(anchors: Block, rows: Block, k: int, allowed: Callable, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, window, row, score) arrays: for each anchor and each of its
    windows ``[low, high]`` (arrays anchor x window) its k best rows by score,
    then smaller id. ``allowed(anchors, rows)`` masks the pairs that count. A
    pair whose bounds miss every window, or what is found already, isn't scored.
    """
    for a0 in range(0, len(anchors.id), GROUP):
        own = slice(a0, a0 + GROUP)
        floor, top = low[own].copy(), high[own]  # floor rises to the k-th best score found
        best: tuple[np.ndarray, ...] | None = None
        for r0 in range(0, len(rows.id), STEP):
            at = slice(r0, r0 + STEP)
            live = allowed(own, at)
            for mine, theirs in zip(anchors.levels, rows.levels):
                cols = np.flatnonzero(live.any(0))
                lo, hi = bounds(mine[own], theirs[at][cols])
                reach = np.zeros(lo.shape, bool)
                for w in range(floor.shape[1]):
                    reach |= (hi >= floor[:, w:w + 1]) & (lo <= top[:, w:w + 1])
                live[:, cols] &= reach
            cols = np.flatnonzero(live.any(0))
            if not len(cols):
                continue
            score = anchors.x[own] @ rows.x[at][cols].T
            new = []
            for w in range(floor.shape[1]):
                fits = live[:, cols] & (score >= floor[:, w:w + 1]) & (score <= top[:, w:w + 1])
                if len(cols) > k:  # no more than the k best of this step, and their ties
                    fits &= score >= np.partition(np.where(fits, score, -np.inf), -k, axis=1)[:, -k:-k + 1 or None]
                i, j = np.nonzero(fits)
                new.append((i, np.full(len(i), w), r0 + cols[j], score[i, j]))
            best = _top([best, *new] if best else new, rows.id, k, floor)
        if best:
            yield a0 + best[0], *best[1:]


def _top(parts: list[tuple[np.ndarray, ...]], ids: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, ...]:
    """The k best of each (anchor, window); raises ``floor`` to the k-th."""
    i, w, j, s = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((ids[j], -s, w, i))
    i, w, j, s = i[order], w[order], j[order], s[order]
    new = np.ones(len(i), bool)
    new[1:] = (w[1:] != w[:-1]) | (i[1:] != i[:-1])
    place = np.arange(len(i)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    full = place == k - 1
    floor[i[full], w[full]] = s[full]
    ok = place < k
    return i[ok], w[ok], j[ok], s[ok]


def _packed(dim: int):
    """Integer vectors, zero-padded to ``dim``, packed with their summaries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            x = np.zeros((b.num_rows, dim))
            x[np.arange(dim) < sizes[:, None]] = lists.flatten().to_numpy()
            stored = np.concatenate([summary(x, n) for n in LEVELS], 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in stored], pa.binary())],
                ["vec_id", "label", "v", "summary"])
    return run


def hard_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, anchor_mod: int = 100,
                   scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each anchor (id divisible by ``anchor_mod``) and each
    of its ``positives`` best rows of its label, the first ``negatives`` rows of
    other labels whose score is ``low`` to ``high`` percent of the positive's.

    Score is the inner product of the components floor(scale * x); higher comes
    first, ties by smaller id; it saturates at 2 ** 56 and is rounded to a double
    beyond 2 ** 53. Rows without id, label or vector, and vectors with a null or
    non-finite component, take no part. Shorter vectors count as padded with
    zeros, an empty one scores 0. Identical rows count once; an id on different
    rows takes part with each, but never for its own anchor. Fewer rows than
    asked for are all returned; an empty table gives none. Labels are integers.
    """
    spark = prepare(vectors.sparkSession)
    if not isinstance(vectors.schema[label_col].dataType, T.IntegralType):
        raise ValueError(f"labels are integers, not {vectors.schema[label_col].dataType.simpleString()}")
    root = scratch_path(spark, "negatives")
    n_parts = shuffle_partitions(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    vec = F.col(f"`{vec_col}`")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    usable = (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"), whole.alias("x"), finite.alias("ok"))
              .where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL AND ok").drop("ok").distinct())
    usable = stored(usable, "usable")
    stats = usable.agg(F.count("*").alias("n"), F.sum((F.col("vec_id") % anchor_mod == 0).cast("long")).alias("anchors"), F.max(F.size("x")).alias("dim")).first()
    if not stats["n"] or not stats["anchors"]:
        return spark.createDataFrame([], schema)
    dim = max(1, stats["dim"])
    rows = stored(usable.mapInArrow(_packed(dim), "vec_id long, label long, v binary, summary binary")
                  .withColumn("entry", F.monotonically_increasing_id()), "rows")
    row_blocks = max(math.ceil(stats["n"] / ROWS), min(n_parts, math.ceil(stats["n"] / FEWEST)))
    anchor_blocks = math.ceil(stats["anchors"] / ANCHORS)

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        """Each row in its own block and once for each block of the other side."""
        return df.select(F.pmod(F.xxhash64("entry"), F.lit(n_own)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other), "*")

    def meet(anchors: DataFrame, task, result: str) -> DataFrame:
        a = dealt(anchors, "anchor_block", anchor_blocks, "row_block", row_blocks).groupBy("anchor_block", "row_block")
        r = dealt(rows, "row_block", row_blocks, "anchor_block", anchor_blocks).groupBy("anchor_block", "row_block")
        return a.cogroup(r).applyInArrow(task, result)

    def pairs_of(a: pa.Table, r: pa.Table, k: int, same_label: bool, low_: np.ndarray, high_: np.ndarray) -> pa.Table:
        names = ("entry", "place", "vec_id", "score")
        if not a.num_rows or not r.num_rows:  # a block without rows has no columns either
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        anchors, others = Block(a, dim), Block(r, dim)

        def allowed(own: slice, at: slice) -> np.ndarray:
            same = anchors.label[own][:, None] == others.label[at]
            return (same if same_label else ~same) & (anchors.id[own][:, None] != others.id[at])

        entry = a.column("entry").to_numpy()
        out: dict[str, list] = {c: [] for c in names}
        for i, w, j, s in best_rows(anchors, others, k, allowed, low_, high_):
            for c, part in zip(out, (entry[i], w, others.id[j], np.clip(s, -LARGEST, LARGEST).astype(np.int64))):
                out[c].append(part)
        return pa.table({c: pa.array(np.concatenate(p) if p else np.empty(0, np.int64), pa.int64()) for c, p in out.items()})

    def find_positives(a: pa.Table, r: pa.Table) -> pa.Table:
        wide = np.full((a.num_rows, 1), np.inf)
        return pairs_of(a, r, positives, True, -wide, wide)

    def find_negatives(a: pa.Table, r: pa.Table) -> pa.Table:
        low_, high_ = np.full((a.num_rows, positives), np.inf), np.full((a.num_rows, positives), -np.inf)
        for i, scores in enumerate(a.column("scores").to_pylist() if a.num_rows else []):
            for w, s in enumerate(scores):
                low_[i, w], high_[i, w] = -(-low * s // 100), high * s // 100
        return pairs_of(a, r, negatives, False, low_, high_)

    found = "entry long, place long, vec_id long, score long"
    anchors = spark.read.schema(rows.schema).parquet(f"{root}/rows").where(F.col("vec_id") % anchor_mod == 0)
    order = [F.desc("score"), "vec_id"]
    top = (meet(anchors, find_positives, found).withColumn("place", F.row_number().over(Window.partitionBy("entry").orderBy(*order)))
           .where(F.col("place") <= positives))
    chosen = top.groupBy("entry").agg(F.array_sort(F.collect_list(F.struct((F.col("place") - 1).cast("long").alias("place"), "vec_id", "score"))).alias("chosen"))
    chosen = stored(chosen, "positives")
    asked = anchors.join(chosen.select("entry", F.col("chosen.score").alias("scores")), "entry")
    rank = F.row_number().over(Window.partitionBy("entry", "place").orderBy(*order))
    best = meet(asked, find_negatives, found).withColumn("rank", rank).where(F.col("rank") <= negatives)
    named = (chosen.join(anchors.select("entry", F.col("vec_id").alias("anchor_id")), "entry")
             .select("entry", "anchor_id", F.inline("chosen").alias("place", "positive_id", "positive_score")))
    return (best.join(named, ["entry", "place"])
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def hard_negatives_plain(rows: list[tuple], positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                         anchor_mod: int = 100, scale: int = 256) -> list[tuple]:
    """Brute force over (id, vector, label) rows without repeats, for tests."""
    ok = [(i, [math.floor(scale * float(c)) for c in v], y) for i, v, y in rows
          if i is not None and v is not None and y is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for a, x, label in ok:
        if a % anchor_mod:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, v)), i, y) for i, v, y in ok if i != a)
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            hits = [r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(hits)]
    return sorted(out)
