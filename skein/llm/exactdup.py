"""Exact deduplication with Patricia tries.

A text's key is its length, a 128-bit hash of its bytes, and then all its
bytes. Equal texts therefore meet in one partition of (length, hash), and a
compressed radix trie over whole keys decides equality byte by byte; a terminal
node holds the group's owner and the number of its rows.

Texts are read once. Each block of a scan goes through a trie of its own, so a
text that a third of all rows repeat leaves a block as one representative with
its count. Only representatives carry their bytes to the (length, hash)
partitions. There they arrive in key order (an external sort), which makes a
subtree complete as soon as a key with another head arrives: when the trie has
grown past its budget, the complete subtrees are spilled, that is, given out as
result rows and forgotten. What stays is the open subtree, texts of one length
and one hash, so memory doesn't grow with the partition. Members find their
group by their representative's number, of which a block's rows share few.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from skein.session import scratch_path

from .common import as_bytes, blocks, prepare

BLOCK_BYTES = 8 << 20    # of text in one block of the scan
TRIE_BYTES = 16 << 20    # of keys in a trie before complete subtrees are spilled
HEAD = 24                # bytes of a key before the text: length and hash


class Node:
    """``label``: the bytes from the parent to here; ``held``: what the key that
    ends here stands for, if one does."""
    __slots__ = ("label", "children", "held")

    def __init__(self, label: bytes, held=None):
        self.label, self.held = label, held
        self.children: dict[int, Node] = {}


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class PatriciaTrie:
    """Byte strings with path compression; ``add`` merges what equal keys hold."""

    def __init__(self):
        self.root = Node(b"")
        self.bytes = 0

    def add(self, key: bytes, held, merge) -> Node:
        """The terminal node of ``key``, holding ``held`` merged with the node's own."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:] if at else key)
                self.bytes += len(child.label)
                node, at = child, len(key)
                break
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            n = common_prefix(label, key[at:at + len(label)])
            fork = Node(label[:n])
            child.label = label[n:]
            fork.children[child.label[0]] = child
            node.children[key[at]] = fork
            node, at = fork, at + n
        node.held = held if node.held is None else merge(node.held, held)
        return node

    def spill(self, open_key: bytes | None) -> Iterator:
        """Takes out the subtrees beside the path of ``open_key`` and gives what
        their terminal nodes held; without a key, those of the whole trie."""
        node, at = self.root, 0
        while True:
            way = key = None
            if open_key is not None and at < len(open_key):
                key = open_key[at]
                way = node.children.get(key)
            for byte in [b for b in node.children if b != key or way is None]:
                yield from self._drain(node.children.pop(byte))
            if node.held is not None and (open_key is None or at < len(open_key)):
                yield node.held
                node.held = None
            if way is None or not open_key.startswith(way.label[:len(open_key) - at], at):
                if way is not None:
                    yield from self._drain(node.children.pop(key))
                return
            node, at = way, at + len(way.label)
            if at >= len(open_key):  # all below belongs to the open head
                return

    def _drain(self, top: Node) -> Iterator:
        todo = [top]
        while todo:
            node = todo.pop()
            self.bytes -= len(node.label)
            if node.held is not None:
                yield node.held
            todo.extend(node.children.values())


def _key(text: bytes) -> bytes:
    return len(text).to_bytes(8, "big") + xxh3_128_digest(text) + text


def _order(smallest: bool):
    """Sort key of an id: the one that stays comes first, null last."""
    return (lambda i: (i is None, i or 0)) if smallest else (lambda i: (i is None, -(i or 0)))


def _represent(smallest: bool):
    """Rows of a scan as (doc_id, rep, stays, text_sha256, n, key): a
    representative of each different text of a block carries the block's count
    and its key. ``stays``: the row's id is the block's best of that text."""
    rank = _order(smallest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for ids, texts in blocks(batches, BLOCK_BYTES):
            trie, groups, of = PatriciaTrie(), [], []
            for row, text in enumerate(texts):
                key = _key(text.lower() if text else b"")
                node = trie.add(key, (), lambda a, b: a)
                if node.held == ():
                    node.held = (len(groups), key)
                    groups.append([row, 0])
                g = groups[node.held[0]]
                of.append(node.held)
                g[1] += 1
                if rank(ids[row]) < rank(ids[g[0]]):
                    g[0] = row
            digests = {}
            for g, key in of:
                if g not in digests:
                    digests[g] = hashlib.sha256(memoryview(key)[HEAD:]).hexdigest()
            owner = [groups[g][0] == row for row, (g, _) in enumerate(of)]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([first + g for g, _ in of], pa.int64()), pa.array(owner), pa.array([digests[g] for g, _ in of]),
                pa.array([groups[g][1] if o else None for o, (g, _) in zip(owner, of)], pa.int64()),
                pa.array([k if o else None for o, (_, k) in zip(owner, of)], pa.binary())],
                ["doc_id", "rep", "stays", "text_sha256", "n", "key"])
            first += len(groups)
    return run


def _own(smallest: bool):
    """Representatives in key order as (rep, keep_rep, keep_id, group_size)."""
    rank = _order(smallest)

    def merge(a: list, b: list) -> list:
        # best id, its representative, all representatives, rows
        if (rank(b[0]), b[1]) < (rank(a[0]), a[1]):
            a[:2] = b[:2]
        a[2] += b[2]
        a[3] += b[3]
        return a

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, names = PatriciaTrie(), ["rep", "keep_rep", "keep_id", "group_size"]

        def rows(groups: Iterator) -> pa.RecordBatch:
            out = [(rep, best, i, n) for i, best, reps, n in groups for rep in reps]
            cols = list(zip(*out)) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

        for b in batches:
            for rep, i, n, key in zip(*(c.to_pylist() for c in b.columns)):
                if trie.bytes > TRIE_BYTES:
                    yield rows(trie.spill(key[:HEAD]))
                trie.add(key, [i, rep, [rep], n], merge)
        yield rows(trie.spill(None))
    return run


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    Of equal texts the row with the smallest (``keep="largest"``: largest) id
    stays; a null id only where the group has no other, and then keep_id is
    null. Exactly one row of a group is kept: of rows that repeat the id that
    stays, any one. text_sha256 is the digest of the lower-cased text in UTF-8.
    Other columns are not read; an empty table gives none.
    """
    spark = prepare(docs.sparkSession)
    smallest = {"smallest": True, "largest": False}[keep]
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), as_bytes(f"`{text_col}`"))
    schema = "doc_id long, rep long, stays boolean, text_sha256 string, n long, key binary"
    path = scratch_path(spark, "exactdup")
    src.mapInArrow(_represent(smallest), schema).write.parquet(path)  # the numbers of representatives are given once
    rows = spark.read.schema(schema).parquet(path)
    reps = rows.where("stays").select("rep", "doc_id", "n", "key")
    by_key = reps.repartition(F.substring("key", 1, HEAD)).sortWithinPartitions("key")
    groups = by_key.mapInArrow(_own(smallest), "rep long, keep_rep long, keep_id long, group_size long")
    members = rows.select("doc_id", "rep", "stays", "text_sha256")
    return members.join(groups, "rep").select(
        "doc_id", "keep_id", "group_size", (F.col("stays") & (F.col("rep") == F.col("keep_rep"))).alias("kept"), "text_sha256")


def exact_duplicates_plain(rows: list[tuple], smallest: bool = True) -> list[tuple]:
    """(doc_id, keep_id, group_size, text_sha256) of (doc_id, text) rows, for tests."""
    groups: dict[bytes, list] = {}
    for i, t in rows:
        groups.setdefault((t or "").encode().lower(), []).append(i)
    rank = _order(smallest)
    return [(i, min(g, key=rank), len(g), hashlib.sha256(t).hexdigest()) for t, g in groups.items() for i in g]
