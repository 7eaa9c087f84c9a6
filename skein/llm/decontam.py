"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short, documents long, so the Jaccard similarity of the two is
tiny even when the item stands inside whole. Items are therefore partitioned
by shingle count (powers of four). For a partition whose largest item has u
shingles a document is read in windows of WINDOW * u shingles that overlap by
u, so an item lies whole in one window, whatever the document's length. In
such a window a containment of t means a Jaccard similarity of at least

    s = t * q / (W + q * (1 - t)),   q the partition's smallest item,

and the number of single-minimum bands b solves (1 - s)^b <= MISS. A window
that shares a minimum with an item makes (document, item) a candidate, which
is verified by exact containment of the item's shingles in the document's.

Documents are scanned once, in place, and never shuffled. The items are the
query set: they are searched in blocks of at most BLOCK_ITEMS items and
BLOCK_SHINGLES shingles, each broadcast under that bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.session import scratch_path

from .common import WordHashes, as_bytes, blocks, mix, odd_constants, prepare, shingles, word_hashes

WIDTH = 5
THRESHOLD = 0.75
WINDOW = 4
MISS = 1e-4
BLOCK_ITEMS, BLOCK_SHINGLES = 20_000, 1_000_000
BLOCK_BYTES = 2 << 20
CHUNK = 1 << 15  # shingles hashed at once, to stay in cache


class Partition:
    """Items of one size range with their minima."""

    def __init__(self, items: list[tuple[int, np.ndarray]], threshold: float):
        sizes = [len(s) for _, s in items]
        self.smallest, self.largest = min(sizes), max(sizes)
        self.window = WINDOW * self.largest
        s = threshold * self.smallest / (self.window + self.smallest * (1 - threshold))
        self.bands = max(8, math.ceil(math.log(MISS) / math.log1p(-s)))
        self.mult = (odd_constants(self.bands, 5) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        cat = np.concatenate([s for _, s in items])
        at = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        x = (cat >> np.uint64(32)).astype(np.uint32)
        self.keys, self.owners, self.masks = [], [], []
        for m in self.mult:
            low = np.minimum.reduceat(x * m, at)
            order = np.argsort(low, kind="stable")
            self.keys.append(low[order])
            self.owners.append(order)
            mask = np.zeros(1 << 16, bool)  # first look-up: the low 16 bits
            mask[low & np.uint32(0xFFFF)] = True
            self.masks.append(mask)

    def candidates(self, x: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, item) pairs that share a minimum. ``x``: 32-bit shingle
        hashes of consecutive windows beginning at ``starts``."""
        for m, keys, owners, mask in zip(self.mult, self.keys, self.owners, self.masks):
            low = np.minimum.reduceat(x * m, starts)
            near = np.flatnonzero(mask[low & np.uint32(0xFFFF)])
            if len(near):
                lo = np.searchsorted(keys, low[near], "left")
                hi = np.searchsorted(keys, low[near], "right")
                for w, a, b in zip(near[hi > lo], lo[hi > lo], hi[hi > lo]):
                    yield w, owners[a:b]


def partitions(items: Sequence[np.ndarray], threshold: float) -> list[tuple[Partition, np.ndarray]]:
    """Items by the power of four below their size; with the items' numbers."""
    by: dict[int, list[int]] = {}
    for i, s in enumerate(items):
        if len(s):
            by.setdefault((len(s).bit_length() - 1) // 2, []).append(i)
    return [(Partition([(i, items[i]) for i in ids], threshold), np.array(ids)) for _, ids in sorted(by.items())]


def _windows(n: int, size: int, overlap: int) -> list[tuple[int, int]]:
    """[start, end) windows over n shingles, each neighbour sharing ``overlap``."""
    step = size - overlap
    return [(a, min(a + size, n)) for a in range(0, max(1, n - overlap), step)] if n else []


def _finder(items: list[np.ndarray], threshold: float):
    """A function that gives the (text, item, shared shingles) of texts that
    hold items, by their numbers."""
    memo = WordHashes()
    parts = partitions(items, threshold)

    def search(texts: Sequence[bytes | None]) -> list[tuple[int, int, int]]:
        seqs = [shingles(word_hashes(t, memo), WIDTH) for t in texts]
        pairs: set[tuple[int, int]] = set()
        for part, numbers in parts:
            spans = [(d, a, b) for d, s in enumerate(seqs) for a, b in _windows(len(s), part.window, part.largest)]
            at = 0
            while at < len(spans):
                size, end = 0, at
                while end < len(spans) and (end == at or size + spans[end][2] - spans[end][1] <= CHUNK):
                    size += spans[end][2] - spans[end][1]
                    end += 1
                x = (np.concatenate([seqs[d][a:b] for d, a, b in spans[at:end]]) >> np.uint64(32)).astype(np.uint32)
                starts = np.cumsum([0, *(b - a for _, a, b in spans[at:end - 1])])
                for w, owners in part.candidates(x, starts):
                    d = spans[at + int(w)][0]
                    pairs.update((d, int(i)) for i in numbers[owners])
                at = end
        sets: dict[int, np.ndarray] = {}
        out = []
        for d, i in sorted(pairs):
            if d not in sets:
                sets[d] = np.unique(seqs[d])
            pos = np.searchsorted(sets[d], items[i])
            pos[pos == len(sets[d])] = 0
            shared = int((sets[d][pos] == items[i]).sum())
            if shared >= threshold * len(items[i]):
                out.append((d, i, shared))
        return out
    return search


def _search(items: list[np.ndarray], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _finder(items, threshold)
        for ids, texts in blocks(batches, BLOCK_BYTES):
            out = [(ids[d], i, shared, len(items[i])) for d, i, shared in search(texts)]
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item", "n_shared", "n_item"])
    return run


def _without(items: list[np.ndarray], threshold: float):
    """The rows whose text, the last column, holds none of the items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _finder(items, threshold)
        for b in batches:
            lo = 0
            for texts, in blocks([b.select([b.num_columns - 1])], BLOCK_BYTES):
                clean = np.ones(len(texts), bool)
                clean[[d for d, _, _ in search(texts)]] = False
                yield b.slice(lo, len(texts)).filter(pa.array(clean))
                lo += len(texts)
    return run


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item): the items of which a document holds
    at least ``threshold`` of the distinct 5-word shingles.

    An item of one to four words is a single shingle and fits only a document
    that is those words. Null, empty and word-less texts and items match
    nothing. Repeated documents and items give a row each; null ids are kept;
    either table may be empty. Other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), as_bytes(f"`{text_col}`"))
    found = None
    for ids, sets in _item_blocks(items.select(F.col(f"`{item_id_col}`").cast("long"), as_bytes(f"`{item_text_col}`"))):
        part = src.mapInArrow(_search(sets, threshold), "doc_id long, item long, n_shared long, n_item long")
        names = spark.createDataFrame(list(enumerate(ids)), "item long, item_id long")
        part = part.join(names, "item").select("doc_id", "item_id", "n_shared", "n_item")
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], "doc_id long, item_id long, n_shared long, n_item long")


def _item_blocks(items: DataFrame) -> Iterator[tuple[list, list[np.ndarray]]]:
    """The query set in blocks of bounded size, read row by row."""
    memo, ids, sets, size = WordHashes(), [], [], 0
    for item_id, text in items.toLocalIterator():
        s = np.unique(shingles(word_hashes(text, memo), WIDTH))
        if ids and (len(ids) >= BLOCK_ITEMS or size + len(s) > BLOCK_SHINGLES):
            yield ids, sets
            ids, sets, size = [], [], 0
        ids.append(item_id)
        sets.append(s)
        size += len(s)
    if ids:
        yield ids, sets


def clean_documents(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                    item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no item, with their own columns.

    Each row is judged by its own text, whatever its id: rows of one id, or
    without an id, stay or go one by one. A null, empty or word-less text
    stays, as do repeated rows; without items all rows stay.
    """
    spark = prepare(docs.sparkSession)
    names = docs.columns
    at = names.index(text_col)
    other = [c for c in names if c != text_col]
    kept = docs.select(*[F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(other)], as_bytes(f"`{text_col}`"))
    schema = kept.schema
    root = scratch_path(spark, "clean")
    for k, (_, sets) in enumerate(_item_blocks(items.select(F.col(f"`{item_id_col}`").cast("long"), as_bytes(f"`{item_text_col}`")))):
        if k:  # a task holds one block of items
            kept.write.parquet(f"{root}/{k}")
            kept = spark.read.schema(schema).parquet(f"{root}/{k}")
        kept = kept.mapInArrow(_without(sets, threshold), schema)
    cols = [F.col(f"keep_{i}").alias(c) for i, c in enumerate(other)]
    cols.insert(at, F.col("text").cast(docs.schema[text_col].dataType).alias(text_col))
    return kept.select(*cols)
