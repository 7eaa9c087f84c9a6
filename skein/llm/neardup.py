"""MinHash near-duplicate groups by chosen-path set similarity join.

A document's set is its distinct 5-word shingles. Two sets are linked when
their exact Jaccard similarity is at least 0.75.

1. One pass computes each set's size, a 128-bit set key, T minima (its minwise
   tokens) and their low bytes (its sketch). Equal sets are one class from here
   on, so copies cost nothing further.
2. Chosen paths. In each of TREES independent trees a root picks one or two of
   the T positions (1/lambda on average) by its own seed, a node below it two,
   and branches every class to the child named by its token there. Classes alone
   in a node leave. TREES follows from MISS and DEPTH.
3. Drawing together. Nodes are dealt in blocks of about BLOCK classes and each
   class proposes its best partner of another component, one pair a class and
   node. Proposals are confirmed on full sets and joined to components. A few
   rounds with new blocks leave a large group of near copies as one component,
   after linear work.
4. Finishing. Nodes that still hold several components are compared
   exhaustively across components: small ones at once, larger ones in all pairs
   of their blocks, or, when few classes are outside the main component, these
   against each block. Very wide nodes branch again, DEPTH times at most. The
   first comparison only marks classes that have a partner; these get a longer sketch
   and only pairs near by that are confirmed, as texts that share most of a
   passage are often alike but seldom enough. A pair that meets in several
   trees is reported at its first meeting. No node is cut short, and every pair
   of different components that shares a last node is compared. By the branching
   probabilities a pair of similarity 0.75 shares none with a chance of at most
   MISS, even if all its nodes branch to DEPTH; with one position a node it
   would be about 1%.
5. The links give components (alternating large and small stars).

A node is a grouping key, not a task: its rows are compared in sorted order
within bounded blocks. Each stage is a table in the shared scratch folder, so a
lost executor costs one stage's tasks.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.session import release, scratch_path

from .common import WordHashes, as_bytes, blocks, mix, odd_constants, prepare, shingles, word_hashes

WIDTH = 5
SHARE, OF = 75, 100        # linked when OF * intersection >= SHARE * union
TOKENS = 128
BLOCK = 256                # classes that propose partners to each other
SMALL = 1024               # classes of a node compared exhaustively at once
ROUNDS = 2                 # of drawing together
WIDE = 8                   # nodes of more than WIDE * SMALL classes branch on
DEPTH = 8
MISS = 1e-6                # chance that a pair at the threshold shares no node at the last level
ID_BITS, MOST_BITS = 16, 1 << 27  # bits for an id in the map of texts to fetch, which all tasks hold, and its size at most
RUN_ROWS = 8192
SIEVE = 0.58               # estimated similarity below which a pair is let go (4.4 sigma under 0.75)
DEEP_TOKENS = 1024         # of the longer sketch that classes near a class of another component get
DEEP_SIEVE = 0.69          # (4.4 sigma)
BLOCK_BYTES = 2 << 20
CHUNK = 1 << 15

_M32 = np.uint64(0xFFFFFFFF)
BELOW = 62                 # the path of nodes below the roots; there are fewer root paths


def shingle_set(text: bytes | None, memo: WordHashes) -> np.ndarray:
    return np.unique(shingles(word_hashes(text, memo), WIDTH))


def set_key(s: np.ndarray) -> bytes:
    from xxhash import xxh3_128_digest
    return xxh3_128_digest(s.tobytes())


def token_multipliers(n: int = TOKENS) -> np.ndarray:
    return (odd_constants(n, 11) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def minima(sets: list[np.ndarray], mult: np.ndarray) -> np.ndarray:
    """One row of TOKENS 32-bit minima for each (non-empty) set."""
    out = np.empty((len(sets), len(mult)), np.uint32)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= CHUNK):
            size += len(sets[end])
            end += 1
        cat = np.concatenate(sets[at:end])
        x = ((cat >> np.uint64(32)) ^ (cat & _M32)).astype(np.uint32)
        starts = np.cumsum([0, *(len(s) for s in sets[at:end - 1])])
        for j, m in enumerate(mult):
            out[at:end, j] = np.minimum.reduceat(x * m, starts)
        at = end
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo, mult = WordHashes(), token_multipliers()
    for ids, keys, texts in blocks(batches, BLOCK_BYTES):
        sets = [shingle_set(t, memo) for t in texts]
        full = [s for s in sets if len(s)]
        rows = iter(minima(full, mult)) if full else iter(())
        tokens = [next(rows).tobytes() if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()), pa.array(tokens, pa.binary())],
            ["doc_id", "text_key", "n_shingles", "set_key", "tokens"])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The low byte of each token, for comparisons, and the whole tokens at
    the positions the trees' roots branch on."""
    at = [pos for _, pos in root_paths()]
    for b in batches:
        if b.num_rows:
            tokens = _matrix(b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _rows((tokens & np.uint32(0xFF)).astype(np.uint8)), _rows(tokens[:, at])],
                                             ["cid", "n", "sketch", "roots"])


def _rows(m: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in m], pa.binary())


def _choose(node: np.ndarray, root: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The positions a node branches on: two; a root one, and with chance
    1/lambda - 1 a second. Below the roots one more than 1/lambda keeps pairs
    from dying out with depth."""
    h = mix(node + np.uint64(0xA5A5A5A5))
    first = h % np.uint64(TOKENS)
    other = (first + np.uint64(1) + (h >> np.uint64(20)) % np.uint64(TOKENS - 1)) % np.uint64(TOKENS)
    two = ((h >> np.uint64(44)) % np.uint64(SHARE) < np.uint64(OF - SHARE)) | (not root)
    return first.astype(np.int64), np.where(two, other.astype(np.int64), -1)


def _children(node: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) for each branch of each row."""
    rows, out = [], []
    r = np.arange(len(node))
    for pos in _choose(node):
        ok = pos >= 0
        value = tokens[r[ok], pos[ok]].astype(np.uint64)
        rows.append(r[ok])
        out.append(_child(node[ok], pos[ok], value))
    return np.concatenate(rows), np.concatenate(out)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, TOKENS)


def root_paths(trees: int | None = None) -> list[tuple[int, int]]:
    """(tree, position) of every branch at the roots, in order."""
    seeds = np.arange(1, (trees or TREES) + 1, dtype=np.uint64)
    return [(t, int(p)) for t, pos in enumerate(zip(*_choose(seeds, root=True))) for p in pos if p >= 0]


def miss(paths: int, depth: int) -> float:
    """The chance that a pair at the threshold shares no node at level
    ``depth``, of ``paths`` branches at the roots."""
    share, gone = SHARE / OF, 0.0
    for _ in range(depth - 1):
        gone = (1 - share + share * gone) ** 2
    return (1 - share + share * gone) ** paths


TREES = next(t for t in range(1, TOKENS) if miss(len(root_paths(t)), DEPTH) <= MISS)


def _child(node: np.ndarray, pos: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix(node * np.uint64(0x9E3779B97F4A7C15) + (pos.astype(np.uint64) << np.uint64(32)) + value)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        tokens = _matrix(b.column(1))
        for path, (tree, pos) in enumerate(root_paths()):
            child = _child(np.full(len(tokens), tree + 1, np.uint64), np.full(len(tokens), pos), tokens[:, pos].astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), b.column(0), pa.array(np.full(len(tokens), path, np.int64))], ["node", "cid", "path"])


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        node, cid, tokens = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy(), _matrix(b.column(2))
        row, child = _children(node, tokens)
        yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(cid[row]), pa.array(np.full(len(row), BELOW))], ["node", "cid", "path"])


def _in_runs(compare):
    """Calls ``compare`` on runs of whole nodes; rows come sorted by node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            rows += b.num_rows
            if rows < RUN_ROWS:
                continue
            cols = _columns(held)
            # the last node may go on in the next batch: its rows are held back
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            if cut:
                yield from compare(*(c[:cut] for c in cols))
            whole = pa.Table.from_batches(held).slice(cut).combine_chunks()
            held = whole.to_batches()
            rows = whole.num_rows
        if held:
            yield from compare(*_columns(held))
    return run


def _columns(held: list[pa.RecordBatch]) -> list[np.ndarray]:
    """Numbers as vectors, binary columns as matrices of bytes."""
    t = pa.Table.from_batches(held)
    return [np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(t.num_rows, -1) if pa.types.is_binary(c.type) else c.to_numpy() for c in t.columns]


def _near(node, comp, cid, n, sketch, sieve: float = SIEVE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, agreeing tokens) of all rows of one node but different
    components whose sizes allow a link and whose sketches reach SIEVE."""
    for gap in range(1, len(node)):
        same = np.flatnonzero(node[gap:] == node[:-gap])
        if not len(same):
            return
        j = same + gap
        ok = (comp[same] != comp[j]) & (OF * np.minimum(n[same], n[j]) >= SHARE * np.maximum(n[same], n[j]))
        i, j = same[ok], j[ok]
        agree = (sketch[i] == sketch[j]).sum(1)
        ok = agree >= sieve * sketch.shape[1]
        if ok.any():
            yield i[ok], j[ok], agree[ok]


def _pairs(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def _propose(turn: int):
    """Each row's best partner; later turns add noise, so that a pair which
    wasn't confirmed isn't proposed again and again."""
    def compare(node, comp, cid, n, sketch) -> Iterator[pa.RecordBatch]:
        best, who = np.full(len(node), -1, np.int64), np.full(len(node), -1, np.int64)
        for i, j, agree in _near(node, comp, cid, n, sketch):
            score = agree.astype(np.int64)
            if turn:
                key = mix(mix(cid[i].view(np.uint64)) + mix(cid[j].view(np.uint64)) + np.uint64(turn))
                score = score + (key % np.uint64(TOKENS // 10)).astype(np.int64)
            for x, y in ((i, j), (j, i)):
                up = score > best[x]
                best[x[up]], who[x[up]] = score[up], y[up]
        x = np.flatnonzero(who >= 0)
        if len(x):
            a, b = cid[x], cid[who[x]]
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield _pairs(pairs[0], pairs[1])
    return compare


def _mark(node, comp, cid, n, sketch, path) -> Iterator[pa.RecordBatch]:
    """The rows with any partner."""
    has = np.zeros(len(node), bool)
    for i, j, _ in _near(node, comp, cid, n, sketch):
        has[i] = has[j] = True
    if has.any():
        yield pa.RecordBatch.from_arrays([pa.array(x[has]) for x in (node, cid, comp, path)], ["node", "cid", "comp", "path"])


def _exhaust(node, comp, cid, n, sketch, path, roots, wide) -> Iterator[pa.RecordBatch]:
    """Pairs near by, each where it meets first: not when the two also met at
    an earlier path of the roots, unless that node was too wide and branched."""
    roots = np.ascontiguousarray(roots).view(np.uint32)
    bit = np.int64(1) << np.arange(roots.shape[1], dtype=np.int64)
    for i, j, _ in _near(node, comp, cid, n, sketch, DEEP_SIEVE):
        met = (roots[i] == roots[j]) & (np.arange(roots.shape[1]) < path[i][:, None]) & ((wide[i][:, None] & bit) == 0)
        first = ~met.any(1)
        if first.any():
            yield _pairs(cid[i[first]], cid[j[first]])


def _deepen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Longer sketches of full sets."""
    mult = token_multipliers(DEEP_TOKENS)
    for b in batches:
        if b.num_rows:
            sets = [np.frombuffer(x, np.uint64) for x in b.column(1).to_pylist()]
            low = (minima(sets, mult) & np.uint32(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in sets], pa.int64()), _rows(low), b.column(2), b.column(3)],
                                             ["cid", "n", "sketch", "roots", "wide"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs linked by exact similarity of their full sets."""
    for b in batches:
        ok = []
        for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if min(len(x), len(y)) * OF < SHARE * max(len(x), len(y)):
                ok.append(False)
                continue
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            both = int((y[at] == x).sum())
            ok.append(OF * both >= SHARE * (len(x) + len(y) - both))
        yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _id_bits(ids: pa.Array, bits: int) -> np.ndarray:
    """Each id's bit in the map of ids; a null id has that of 0."""
    return mix(ids.fill_null(0).to_numpy().view(np.uint64)) & np.uint64(bits - 1)


def id_map(ids: DataFrame, count: int) -> np.ndarray:
    """The bits of about ``count`` ids (one long column) as 64-bit words: a few
    bytes an id, however the ids are spread. Other ids may share a bit."""
    bits = min(MOST_BITS, 1 << max(6, (ID_BITS * count - 1).bit_length()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _id_bits(b.column(0), bits)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["slot", "word"])

    got = ids.mapInArrow(words, "slot long, word long").groupBy("slot").agg(F.bit_or("word").alias("word")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[got.column("slot").to_numpy()] = got.column("word").to_numpy().view(np.uint64)
    return out


def _full_sets(wanted):
    """The full sets of texts (doc_id, text) whose id is in the broadcast map."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, words = WordHashes(), wanted.value

        def named(b: pa.RecordBatch) -> pa.RecordBatch:
            at = _id_bits(b.column(0), 64 * len(words))
            return b.filter(pa.array(words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1) == 1))

        for _, texts in blocks(map(named, batches), BLOCK_BYTES):
            sets = [shingle_set(t, memo) for t in texts]
            keep = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in keep], pa.binary()),
                                              pa.array([s.tobytes() for s in keep], pa.binary())], ["set_key", "members"])
    return run


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to and read from the shared scratch folder: cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, f"neardup-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(cid, comp): the smallest member of each linked class's component, by
    alternating large and small stars; ``before`` are components to go on from.
    Both steps only take minima by key and join them back, so a centre with a
    third of all links is no single task."""
    if before is not None and links.isEmpty():
        return before
    e = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    if before is not None:
        e = e.union(before.select(F.col("cid").alias("a"), F.col("comp").alias("b")))
    e = e.where("a <> b").distinct()
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        e = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        small = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        e = _stored(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        # done when all edges lead from a member to the top of its own star
        inner = e.join(e.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
        if inner.union(e.groupBy("a").count().where("count > 1").select("a")).isEmpty():
            break
    return e.select(F.col("a").alias("cid"), F.col("b").alias("comp")).union(e.select(F.col("b").alias("cid"), F.col("b").alias("comp")).distinct())


PAIR = "a long, b long"
NODE = "node long, cid long, path long"
ROW = "node long, cid long, comp long, path long"
SKETCH = "cid long, n long, sketch binary, roots binary"


class _Join:
    """State of one join over the classes (cid, rep, set_key, n, tokens)."""

    def __init__(self, spark: SparkSession, classes: DataFrame, docs: DataFrame):
        self.spark, self.classes, self.docs = spark, classes, docs
        self.tokens = classes.select("cid", "tokens")
        self.sketches = _stored(classes.select("cid", "n", "tokens").mapInArrow(_sketches, SKETCH), "sketches")
        self.sets: DataFrame | None = None
        self.tried: DataFrame | None = None

    def mixed(self, rows: DataFrame, comp: DataFrame | None) -> DataFrame:
        """Rows (node, cid, comp, path, size) of nodes that hold several components."""
        rows = rows.select("node", "cid", "path")
        if comp is None:
            rows = rows.withColumn("comp", F.col("cid"))
        else:
            rows = rows.join(comp, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        open_ = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
        return rows.join(open_.select("node", "size"), "node").select("node", "cid", "comp", "path", "size")

    def compare(self, rows: DataFrame, how, out: str, sketches: DataFrame, *more: str) -> DataFrame:
        """Runs ``how`` over the rows of each node, of bounded size here."""
        full = rows.join(sketches, "cid").select("node", "comp", "cid", "n", "sketch", *more)
        return full.repartition("node").sortWithinPartitions("node", "cid").mapInArrow(_in_runs(how), out)

    @staticmethod
    def dealt(rows: DataFrame, turn: int) -> DataFrame:
        """Nodes cut into blocks of about BLOCK classes, others in each turn."""
        block = F.pmod(F.xxhash64("cid", "node", F.lit(turn)), F.ceil(F.col("size") / BLOCK))
        return rows.select(F.when(F.col("size") <= BLOCK, F.col("node")).otherwise(F.xxhash64("node", block)).alias("node"), "cid", "comp")

    @staticmethod
    def in_blocks(big: DataFrame) -> DataFrame:
        """A node of m classes as all pairs of its blocks: every two classes
        meet in one of the bounded groups."""
        b = F.ceil(F.col("size") * 2 / SMALL).cast("int")
        own = F.pmod(F.xxhash64("cid"), b).cast("int")
        return (big.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), b - 1)).alias("other"))
                .select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), "cid", "comp", "path"))

    @staticmethod
    def beside_main(rows: DataFrame) -> DataFrame:
        """Nodes with few classes outside their main component: these are
        added to each block of the node, so they meet all its rows."""
        b = F.ceil(F.col("size") / SMALL).cast("int")
        own = F.pmod(F.xxhash64("cid"), b).cast("int")
        blocks_ = F.when(F.col("comp") == F.col("main"), F.array(own)).otherwise(F.sequence(F.lit(0), b - 1))
        return (rows.select("node", "cid", "comp", "path", F.explode(blocks_).alias("block"))
                .select(F.xxhash64("node", "block").alias("node"), "cid", "comp", "path"))

    @staticmethod
    def with_main(big: DataFrame) -> DataFrame:
        """Adds each node's main component and the number of classes outside."""
        each = big.groupBy("node", "comp").agg(F.count("*").alias("part"), F.max("size").alias("size"))
        main = each.groupBy("node").agg(F.max_by("comp", F.struct("part", "comp")).alias("main"), (F.max("size") - F.max("part")).alias("outside"))
        return big.join(main, "node")

    def fetch(self, used: DataFrame) -> DataFrame | None:
        """Full sets of the given classes and of those asked for before. The
        texts stay where they are read: tasks pass over those that aren't in a
        map of the wanted ids, and what it lets by in vain goes by its set key."""
        if self.sets is not None:
            used = used.join(self.sets.select("cid"), "cid", "left_anti")
        named = _stored(used.join(self.classes.select("cid", "rep", "set_key"), "cid"), "fetch")
        count = named.count()
        if count:
            wanted = self.spark.sparkContext.broadcast(id_map(named.select("rep"), count))
            got = self.docs.select("doc_id", "text").mapInArrow(_full_sets(wanted), "set_key binary, members binary")
            # an id may stand on several texts, a text on several rows: one set a class
            got = _stored(got.join(named.select("cid", "set_key"), "set_key").select("cid", "members").dropDuplicates(["cid"]), "full")
            wanted.destroy()
            self.sets = got if self.sets is None else self.sets.union(got)
        return self.sets

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The links among the pairs not tried before, as a table."""
        pairs = pairs.distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = _stored(pairs, "pairs")
        self.tried = pairs if self.tried is None else self.tried.union(pairs)
        sets = self.fetch(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct())
        if sets is None:
            return pairs
        both = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("members").alias("x")), "a")
                .join(sets.select(F.col("cid").alias("b"), F.col("members").alias("y")), "b").select("a", "b", "x", "y"))
        return _stored(both.mapInArrow(_confirm, PAIR), "links")

    def exhaust(self, groups: list[DataFrame], wide: DataFrame | None) -> DataFrame:
        """Candidate pairs of different components within bounded groups.
        ``wide``: (cid, wide), the root paths whose node branched, as bits."""
        # one comparison for all groups: one each would give as many tasks and plans
        rows = functools.reduce(DataFrame.union, [g.select("node", "cid", "comp", "path") for g in groups])
        marked = _stored(self.compare(rows, _mark, ROW, self.sketches, "path").distinct(), "marked")
        used = marked.select("cid").distinct()
        sets = self.fetch(used)
        if sets is None:  # nothing is marked
            return marked.select(F.col("cid").alias("a"), F.col("cid").alias("b"))
        sets = sets.join(used, "cid", "left_semi").join(self.sketches.select("cid", "roots"), "cid")
        sets = sets.join(wide, "cid", "left") if wide is not None else sets.withColumn("wide", F.lit(None).cast("long"))
        deep = _stored(sets.select("cid", "members", "roots", F.coalesce("wide", F.lit(0).cast("long")).alias("wide"))
                       .mapInArrow(_deepen, SKETCH + ", wide long"), "deep")
        return self.compare(marked, _exhaust, PAIR, deep, "path", "roots", "wide")

    def run(self) -> DataFrame:
        rows, comp = self.tokens.mapInArrow(_roots, NODE), None
        for turn in range(ROUNDS):
            rows = _stored(self.mixed(rows, comp), "nodes")
            links = self.confirm(self.compare(self.dealt(rows, turn), _propose(turn), PAIR, self.sketches))
            comp = _stored(components(links, comp), "comp")
            release(self.spark)
        groups, wide, level = [], None, 1
        while True:
            rows = _stored(self.mixed(rows, comp), "nodes")
            groups.append(rows.where(F.col("size") <= SMALL))
            large = _stored(self.with_main(rows.where(F.col("size") > SMALL)), "large")
            if large.isEmpty():
                break
            branch = (F.col("outside") > SMALL) & (F.col("size") > WIDE * SMALL) & F.lit(level < DEPTH)
            groups += [self.beside_main(large.where(F.col("outside") <= SMALL)), self.in_blocks(large.where((F.col("outside") > SMALL) & ~branch))]
            large = large.where(branch)
            if large.isEmpty():
                break
            if level == 1:
                wide = large.groupBy("cid").agg(F.bit_or(F.expr("shiftleft(1L, CAST(path AS INT))")).alias("wide"))
            rows = large.join(self.tokens, "cid").select("node", "cid", "tokens").mapInArrow(_branch, NODE)
            level += 1
            release(self.spark)
        return components(self.confirm(self.exhaust(groups, wide)), comp)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", text_key: Column | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, group_key), one row a document;
    with ``text_key``, a long, this too.

    ``component_id`` is the smallest doc_id linked directly or over others, the
    document's own included; ``kept`` marks the document that has that id;
    ``group_key`` names the component (null for texts without words).

    Null, empty and word-less texts have no shingles and are linked with
    nothing; one to four words are one shingle. Documents of equal sets are
    linked. A repeated row is a document of its own with the same results; a
    null id is larger than any other and kept only in a group of null ids. An
    empty table gives none. Only the two named columns are read.
    """
    spark = prepare(docs.sparkSession)
    key = F.lit(None) if text_key is None else text_key
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), key.cast("long").alias("text_key"), as_bytes(f"`{text_col}`"))
    seen = _stored(src.mapInArrow(_describe, "doc_id long, text_key long, n_shingles long, set_key binary, tokens binary"), "sets")
    classes = (seen.where("set_key IS NOT NULL").groupBy("set_key")
               .agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("tokens").alias("tokens")))
    # numbered when written: the numbers stay as they are from here on
    classes = _stored(classes.select(F.monotonically_increasing_id().alias("cid"), "rep", "set_key", "n", "tokens"), "classes")
    comp = _stored(_Join(spark, classes, src).run(), "comp")
    member = classes.join(comp, "cid", "left").select("set_key", "rep", F.coalesce("comp", "cid").alias("comp"))
    ids = member.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = member.join(ids, "comp").select("set_key", "component_id", F.col("comp").alias("group_key"))
    own = [] if text_key is None else ["text_key"]
    out = seen.select("doc_id", *own, "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "group_key", *own)
