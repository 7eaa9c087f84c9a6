"""Toxicity scores from a counterfactual-regularised classifier.

A logistic model over word presence is trained in numpy on labelled texts.
For each text a counterfactual is made by swapping the identity terms it
mentions for others (a text without any gets a mention put in), and the
squared change of the score is added to the loss. A group's name alone then
neither raises nor lowers a score, so neutral mentions aren't flagged.

The words of the model are those that tell the two labels apart most, counted
in Spark; the identity terms are always among them. Words and weights are
fitted on at most MAX_ROWS labelled texts, chosen by a hash of the id; each
reaches the driver as the few numbers of its known words, never as text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from skein.session import scratch_path

from .common import as_bytes, prepare, split_remainder

HELD_MOD, HELD = 5, 0
MAX_ROWS = 20_000          # bound of the sample for the fit
MAX_WORDS = 1_000          # words of the model besides the identity terms
MIN_ROWS = 4               # labelled texts a word must stand in
STEPS, RATE, L2, SWAP = 400, 0.3, 1e-3, 1.0

# Names of groups, neutral by themselves; swapped only within a line.
IDENTITY = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant", "sikh"),
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european", "american", "arab"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("blind", "deaf", "disabled", "elderly", "young"),
    ("musulman", "chrétien", "juif", "muslimisch", "christlich", "jüdisch", "musulmán", "cristiano", "judío"),
    ("frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
)

# a word is a run of letters and digits; everything else in ASCII separates
_SPACE = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> set[bytes]:
    return set(text.lower().translate(_SPACE).split()) if text else set()


def identity_groups() -> list[list[bytes]]:
    return [[w.encode() for w in g] for g in IDENTITY]


def _labelled(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(text, y) of the training documents under at most ``limit`` labelled
    ids. The ids are drawn by a hash before texts are touched: with that bound
    they are broadcast and no text is shuffled. Rows that repeat an id all
    count; they stay in a table and are read by many tasks."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("lab_id"), F.col(f"`{label}`").cast("int").alias("y"))
           .where((split_remainder("lab_id", HELD_MOD) != HELD) & F.col("y").isin(0, 1)))
    # a doc labelled twice: the larger label
    lab = lab.groupBy("lab_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("lab_id"), "lab_id").limit(limit)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text"))
    got = src.join(F.broadcast(lab), F.col("doc_id") == F.col("lab_id")).select("text", "y")
    path = scratch_path(docs.sparkSession, "toxicity")
    got.write.parquet(path)
    return docs.sparkSession.read.schema(got.schema).parquet(path)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, rows, toxic rows), summed within a batch; the empty word counts texts."""
    for b in batches:
        n: dict[bytes, int] = {}
        pos: dict[bytes, int] = {}
        for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for w in (*words_of(text), b""):
                n[w] = n.get(w, 0) + 1
                if y:
                    pos[w] = pos.get(w, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64()),
                                          pa.array([pos.get(w, 0) for w in n], pa.int64())], ["word", "n", "pos"])


def choose_words(rows: DataFrame, size: int = MAX_WORDS) -> list[bytes]:
    """The words with the largest chi-square against the label, ties by word."""
    counts = rows.mapInArrow(_word_rows, "word binary, n long, pos long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    total = counts.where(F.length("word") == 0).first()
    if total is None or not 0 < total["pos"] < total["n"]:
        return []
    n, pos = float(total["n"]), float(total["pos"])
    gap = F.col("pos") * n - F.col("n") * pos
    chi = gap * gap / (F.col("n") * (n - F.col("n") + 1) * (pos * (n - pos)))
    top = counts.where((F.length("word") > 0) & (F.col("n") >= MIN_ROWS)).orderBy(chi.desc(), "word").limit(size)
    return [bytes(r["word"]) for r in top.collect()]


def _features(rows: DataFrame, vocab: dict[bytes, int], limit: int) -> tuple[list[list[int]], np.ndarray]:
    """The known words and the label of at most ``limit`` sampled rows, in a
    fixed order. An id that stands on many documents may give more: of all, the
    rows with the smallest text hashes are taken."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).to_pylist()
            found = [sorted(vocab[w] for w in words_of(t) & vocab.keys()) for t in texts]
            order = [xxh3_64_intdigest(t or b"") >> 1 for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array(found, pa.list_(pa.int32())), b.column(1)], ["h", "at", "y"])
    got = rows.mapInArrow(run, "h long, at array<int>, y int").orderBy("h", "y", "at").limit(limit).collect()
    got = sorted((list(r["at"]), r["y"]) for r in got)
    return [x for x, _ in got], np.array([y for _, y in got], float)


def counterfactuals(rows: list[list[int]], groups: list[list[int]], rng: np.random.Generator) -> list[list[int]]:
    """For each row its terms swapped within their groups; a row without any
    gets one term of a random group."""
    group_of = {t: g for g in groups for t in g}
    out = []
    for r in rows:
        has = [t for t in r if t in group_of]
        plain = [t for t in r if t not in group_of]
        if has:
            out.append(plain + [int(rng.choice([x for x in group_of[t] if x != t])) for t in has])
        else:
            out.append(plain + [int(rng.choice(groups[rng.integers(len(groups))]))])
    return out


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([x for r in rows for x in r], np.int64)


def fit(rows: list[list[int]], y: np.ndarray, groups: list[list[int]], size: int, swap: float = SWAP, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient descent with momentum."""
    rng = np.random.default_rng(seed)
    w, b = np.zeros(size), 0.0
    if not len(y) or y.min() == y.max():
        return w, (0.0 if not len(y) else (8.0 if y[0] else -8.0))
    (i, j), (ci, cj) = _flat(rows), _flat(counterfactuals(rows, groups, rng))
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    vw, vb = np.zeros(size), 0.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(i, w[j], len(y)), -30, 30)))
        q = 1 / (1 + np.exp(-np.clip(b + np.bincount(ci, w[cj], len(y)), -30, 30)))
        g = weight * (p - y)
        # d/dw of swap * (p - q)^2, both sides
        d = 2 * swap * weight * (p - q)
        left, right = g + d * p * (1 - p), -d * q * (1 - q)
        gw = np.bincount(j, left[i], size) + np.bincount(cj, right[ci], size) + L2 * w / size
        vw = 0.9 * vw + gw
        vb = 0.9 * vb + (left + right).sum()
        w -= RATE * 10 * vw
        b -= RATE * vb
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = MAX_ROWS) -> dict:
    """{word: weight} and the bias under the key b''. Null ids and labels
    other than 0 and 1 are left out; without labels of both kinds every score
    is the bias alone (0.5 without any). Weights are fitted on at most
    ``limit`` rows; the word counts that choose the words cover every row under
    the drawn ids, however often an id is repeated. Whole texts are read, and of
    ``docs`` and ``labels`` only the id, text and label columns."""
    prepare(docs.sparkSession)
    rows = _labelled(docs, labels, label, limit)
    groups = identity_groups()
    chosen = choose_words(rows)
    names = list(dict.fromkeys([w for g in groups for w in g] + chosen))
    vocab = {w: k for k, w in enumerate(names)}
    at, y = _features(rows, vocab, limit)
    w, b = fit(at, y, [[vocab[x] for x in g] for g in groups], len(names))
    return {**{n: float(x) for n, x in zip(names, w)}, b"": b}


def score_texts(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row; the model has at most
    MAX_WORDS words and the identity terms, so it travels with the tasks.

    Null, empty and word-less texts score as the bias alone says. A score
    counts each word of the whole text once, however long it is. Repeated rows
    and null ids stay; other columns are not read; an empty table gives none."""
    prepare(docs.sparkSession)
    bias = model[b""]
    weights = {w: x for w, x in model.items() if w and x}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = [bias + sum(sorted(weights[w] for w in words_of(t) & weights.keys())) for t in b.column(2).to_pylist()]
            p = 1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (split_remainder("doc_id", HELD_MOD) == HELD).alias("held_out"), as_bytes("text"))
    return src.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
