"""Language-model scoring with a weighted backoff automaton.

States are contexts: the root, the begin state and one state for each training
word. A state has an arc for every word seen after it, weighted with the
smoothed bigram probability, and one failure arc to the root, weighted with
the mass kept for unseen words; the root has an arc for every word (the
smoothed unigram, unknown words included). A text is read once from left to
right: from each state the word's arc is taken, or the failure arc and then
the root's, and the log10 weights are added up.

    P(w | u) = (c(u, w) + K * P(w)) / (c(u) + K)   arc
    fail(u)  = K / (c(u) + K)                      failure arc, then P(w)
    P(w)     = (c(w) + 0.1) / (N + 0.1 * (V + 1))  root arc

The automaton grows with the corpus and is never gathered in one place. Texts
are coded in blocks against the block's own dictionary and written once.
Counting is a shuffle of packed messages, one for each block and shard of the
key space, with one entry for each distinct word or word pair of the block, so
a word in every text costs one entry a block. Each shard sums its keys and
answers every block with the totals of the keys it asked for, and a block then
walks its own part of the automaton. Words are counted by their full bytes;
word pairs by 64-bit fingerprints.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.session import scratch_path

from .common import WordHashes, as_bytes, blocks, mix, prepare, shuffle_partitions, split_remainder

HELD_MOD, HELD = 10, 0
K = 400.0                  # weight of the root's distribution in each state
BLOCK_BYTES = 6 << 20      # text in a block
SHARD_KEYS = 1_500_000     # pair entries aimed at for a shard
END = b""                  # local word 0: no real word is empty
BEGIN = np.uint64(0x5D1F_0BEE_71A3_9C47)


def _pack(a: np.ndarray) -> bytes:
    """Integers by byte planes, deflated."""
    return zlib.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes(), 1)


def _unpack(b: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(b), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(dtype)


class _Local(dict):
    """Word -> number, in order of first use."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block: its documents as local word numbers."""
    from pyspark import TaskContext
    base = TaskContext.get().partitionId() << 32
    for k, (ids, held, texts) in enumerate(blocks(batches, BLOCK_BYTES)):
        local = _Local({END: 0})
        docs = [np.fromiter(map(local.__getitem__, words := t.lower().split() if t else []), np.int32, len(words)) for t in texts]
        toks = np.concatenate([x for d in docs for x in (d, np.zeros(1, np.int32))])
        lens = np.array([len(d) + 1 for d in docs], np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([base + k]), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
             pa.array([_pack(lens)]), pa.array([_pack(toks)]), pa.array([zlib.compress(b"\n".join(local), 1)]), pa.array([len(toks)], pa.int64())],
            ["block", "ids", "held", "lens", "toks", "words", "n"])


ENCODED = "block long, ids array<long>, held array<boolean>, lens binary, toks binary, words binary, n long"


class Block:
    """A decoded block row."""

    def __init__(self, row):
        self.id, self.ids, self.held = row["block"], row["ids"], np.array(row["held"], bool)
        self.lens, self.toks = _unpack(row["lens"], np.int32), _unpack(row["toks"], np.int32)
        self.words = zlib.decompress(row["words"]).split(b"\n")
        memo = WordHashes(1 << 40)
        self.hash = np.fromiter(map(memo.__getitem__, self.words), np.uint64, len(self.words))
        self.starts = np.cumsum(self.lens) - self.lens
        # the context of each token: the word before it, -1 at the beginning
        self.prev = np.empty_like(self.toks)
        self.prev[1:] = self.toks[:-1]
        self.prev[self.starts] = -1
        self.train = np.repeat(~self.held, self.lens)
        self._pairs = None

    def pairs(self):
        """(distinct local pairs, the pair number of each token)."""
        if self._pairs is None:
            code = (self.prev.astype(np.int64) + 1) * len(self.words) + self.toks
            self._pairs = np.unique(code, return_inverse=True)
        return self._pairs

    def fingerprints(self) -> np.ndarray:
        u, w = np.divmod(self.pairs()[0], len(self.words))
        left = np.concatenate([[BEGIN], self.hash])[u]
        return mix(left * np.uint64(0x9E3779B97F4A7C15) + self.hash[w])

    def parts(self, shards: int):
        """For each kind: (name, keys, training counts, the shard of each key)."""
        words = np.bincount(self.toks[self.train], minlength=len(self.words))
        at = self.pairs()[1]
        both = np.bincount(at[self.train], minlength=len(self.pairs()[0]))
        fp = self.fingerprints()
        n = np.uint64(shards)
        yield "word", None, words, (mix(self.hash) % n).astype(np.int64)
        yield "pair", fp, both, ((fp >> np.uint64(20)) % n).astype(np.int64)


MESSAGE = "kind string, shard long, block long, keys binary, counts binary"


def _messages(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block = Block(row)
                out = []
                for kind, keys, counts, shard in block.parts(shards):
                    order = np.argsort(shard, kind="stable")
                    cut = np.searchsorted(shard[order], np.arange(shards + 1))
                    for s in range(shards):
                        i = order[cut[s]:cut[s + 1]]
                        if len(i):
                            k = zlib.compress(b"\n".join([block.words[j] for j in i.tolist()]), 1) if keys is None else keys[i].tobytes()
                            out.append((kind, s, block.id, k, _pack(counts[i].astype(np.uint32))))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                                                  pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary())],
                                                 ["kind", "shard", "block", "keys", "counts"])
    return run


ANSWER = "kind string, shard long, block long, counts binary, total long, types long"


def _sum_shard(df: pd.DataFrame) -> pd.DataFrame:
    """Adds up a shard's counts and answers each block in its own key order;
    one more row (block null) carries the sum and the number of seen keys."""
    kind, shard = df["kind"].iloc[0], df["shard"].iloc[0]
    counts = [_unpack(c, np.uint32) for c in df["counts"]]
    if kind == "word":
        number = _Local()
        keys = np.concatenate([np.fromiter(map(number.__getitem__, ws := zlib.decompress(k).split(b"\n")), np.int64, len(ws)) for k in df["keys"]])
    else:
        keys = np.unique(np.frombuffer(b"".join(df["keys"]), np.uint64), return_inverse=True)[1]
    totals = np.bincount(keys, np.concatenate(counts)).astype(np.int64)
    answers, at = [], 0
    for c in counts:
        answers.append(_pack(totals[keys[at:at + len(c)]]))
        at += len(c)
    return pd.DataFrame({"kind": kind, "shard": shard, "block": [*df["block"], None], "counts": [*answers, None],
                         "total": [None] * len(answers) + [int(totals.sum())],
                         "types": [None] * len(answers) + [int((totals > 0).sum())]}).astype({"block": "Int64", "total": "Int64", "types": "Int64"})


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _walk(shards: int, n_train: int, v_train: int):
    def run(coded: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in coded.to_dict("records"):
            block = Block(row)
            got = {}
            for kind, _, counts, shard in block.parts(shards):
                total = np.zeros(len(counts), np.int64)
                order = np.argsort(shard, kind="stable")
                cut = np.searchsorted(shard[order], np.arange(shards + 1))
                mine = answers[(answers["kind"] == kind) & (answers["block"] == block.id)]
                for s, c in zip(mine["shard"], mine["counts"]):
                    total[order[cut[s]:cut[s + 1]]] = _unpack(c, np.int64)
                got[kind] = total
            # the block's part of the automaton
            count = got["word"]
            root = (count + 0.1) / (n_train + 0.1 * (v_train + 1))
            visits = np.concatenate([[count[0]], count]).astype(float)   # a text begins as often as one ends
            visits[1] = 0                                                # nothing follows the end
            fail = np.log10(K / (visits + K))
            pairs, at = block.pairs()
            u, w = np.divmod(pairs, len(block.words))
            seen = got["pair"]
            arc = np.where(seen > 0, np.log10((seen + K * root[w]) / (visits[u] + K)), fail[u] + np.log10(root[w]))
            # one pass over the texts: each token's state is the word before it
            out.append(pd.DataFrame({
                "doc_id": block.ids, "held_out": block.held, "n_tokens": block.lens.astype(np.int64),
                "n_known": np.add.reduceat((count > 0)[block.toks].astype(np.int64), block.starts),
                "base_score": np.add.reduceat(np.log10(root)[block.toks], block.starts),
                "score": np.add.reduceat(arc[at], block.starts)}).astype({"doc_id": "Int64"}))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_mod: int = HELD_MOD, held: int = HELD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from documents whose crc32(id as text) mod ``held_mod`` is not
    ``held`` and scores all; log10. A null text is empty: its one token is the
    end. Unknown words share one type. Without training documents every state
    is the root. Repeated rows count and are scored each; null ids stay; an
    empty table gives none. Only the two named columns are read.
    """
    spark = prepare(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), (split_remainder(f"`{id_col}`", held_mod) == held).alias("held"),
                      as_bytes(f"`{text_col}`"))
    root = scratch_path(spark, "lm")
    src.mapInArrow(_encode, ENCODED).write.parquet(f"{root}/blocks")
    coded = spark.read.schema(ENCODED).parquet(f"{root}/blocks")
    tokens = coded.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(shuffle_partitions(spark), -(-tokens // SHARD_KEYS))
    n = shuffle_partitions(spark)
    asked = coded.select(*[f.split()[0] for f in ENCODED.split(", ")]).mapInArrow(_messages(shards), MESSAGE)
    asked.groupBy("kind", "shard").applyInPandas(_sum_shard, ANSWER).write.parquet(f"{root}/answers")
    answers = spark.read.schema(ANSWER).parquet(f"{root}/answers")
    total = (answers.where("block IS NULL AND kind = 'word'")
             .agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first())
    scored = (coded.repartition(n, "block").groupBy("block")
              .cogroup(answers.where("block IS NOT NULL").groupBy("block"))
              .applyInPandas(_walk(shards, total[0], total[1]), SCORED))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total[0]).cast("long").alias("train_tokens"), "base_score", "score")
