"""Language ID with a small byte convolutional network.

A text is cut into windows of WINDOW bytes. In a window each byte has an
embedding, filters of several widths slide over it, each filter keeps its
maximum, and a softmax over these gives the languages. A text's probability
is the mean over all its windows, weighted by their bytes.

The network is trained in numpy on windows of labelled texts: at most
MAX_ROWS texts of a hash-ordered sample, each with up to WINDOWS_EACH windows.

For prediction a filter's answer is a sum over the bytes it covers, so it is
looked up in tables of byte pairs made once from the weights. Every byte of
every text is read; windows are processed in batches of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, prepare, split_remainder

HELD_MOD, HELD = 3, 1
MAX_ROWS = 6_000           # bound of the training sample
WINDOWS_EACH = 2
WINDOW = 256
DIM, FILTERS, WIDTHS = 8, 12, (2, 3, 4)
EPOCHS, BATCH, RATE = 6, 64, 0.01
UNKNOWN = "und"
WINDOWS_AT_ONCE = 512

# any letter: what isn't a letter in ASCII and whose text has no other letter
_ASCII_LETTERS = bytes(c for c in range(128) if chr(c).isalpha())


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    if len(text.translate(None, _ASCII_LETTERS)) < len(text):
        return True
    return not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace")))


def _folded(text: bytes) -> bytes:
    return text.lower()


def windows(text: bytes) -> np.ndarray:
    """(windows, WINDOW) bytes over the whole text; the last is filled with 0."""
    n = -(-len(text) // WINDOW)
    out = np.zeros(n * WINDOW, np.uint8)
    out[:len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, WINDOW)


class Network:
    def __init__(self, classes: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.p = {"emb": rng.normal(0, 0.5, (256, DIM)).astype(np.float32)}
        for w in WIDTHS:
            self.p[f"f{w}"] = rng.normal(0, (w * DIM) ** -0.5, (w * DIM, FILTERS)).astype(np.float32)
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)
        self.p["out"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32)
        self.p["bias"] = np.zeros(len(classes), np.float32)
        self.tables: list | None = None

    # ------------------------------------------------------------- training

    def _step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy of a batch of windows."""
        p, n = self.p, len(x)
        e = p["emb"][x]
        peaks, where = [], []
        for w in WIDTHS:
            cols = np.concatenate([e[:, j:WINDOW - w + 1 + j] for j in range(w)], axis=2)
            a = cols @ p[f"f{w}"]
            at = a.argmax(1)
            peaks.append(np.take_along_axis(a, at[:, None], 1)[:, 0] + p[f"b{w}"])
            where.append((cols, at))
        h = np.concatenate(peaks, 1)
        act = np.maximum(h, 0)
        z = act @ p["out"] + p["bias"]
        z = np.exp(z - z.max(1, keepdims=True))
        d = z / z.sum(1, keepdims=True)
        d[np.arange(n), y] -= 1
        d /= n
        g = {"out": act.T @ d, "bias": d.sum(0), "emb": np.zeros_like(p["emb"])}
        back = (d @ p["out"].T) * (h > 0)
        for k, w in enumerate(WIDTHS):
            part, (cols, at) = back[:, k * FILTERS:(k + 1) * FILTERS], where[k]
            best = np.take_along_axis(cols, at[:, :, None], 1)          # n, FILTERS, w*DIM
            g[f"f{w}"] = np.einsum("nfd,nf->df", best, part)
            g[f"b{w}"] = part.sum(0)
            de = part[:, :, None] * p[f"f{w}"].T[None]
            for j in range(w):
                chars = np.take_along_axis(x, at + j, 1)
                np.add.at(g["emb"], chars.ravel(), de[:, :, j * DIM:(j + 1) * DIM].reshape(-1, DIM))
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 6) -> "Network":
        """Adam over shuffled batches."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for _ in range(EPOCHS if len(x) > 2000 else 4 * EPOCHS):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), BATCH):
                i = order[lo:lo + BATCH]
                t += 1
                for k, g in self._step(x[i], y[i]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.p[k] -= (RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
        return self

    # ----------------------------------------------------------- prediction

    def _tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """For each width its (offset, table) parts: pairs of bytes share a
        table of 65536 rows, a byte left over has one of 256."""
        if self.tables is None:
            self.tables = []
            for w in WIDTHS:
                f = self.p[f"f{w}"].reshape(w, DIM, FILTERS)
                one = [self.p["emb"] @ f[j] for j in range(w)]
                parts = [(j, (one[j][:, None] + one[j + 1][None]).reshape(65536, FILTERS).astype(np.float32)) for j in range(0, w - 1, 2)]
                if w % 2:
                    parts.append((w - 1, one[-1].astype(np.float32)))
                self.tables.append(parts)
        return self.tables

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Softmax over the classes for each window."""
        out = np.empty((len(x), len(self.classes)))
        for lo in range(0, len(x), WINDOWS_AT_ONCE):
            part = x[lo:lo + WINDOWS_AT_ONCE].astype(np.int32)
            pair = (part[:, :-1] << 8) | part[:, 1:]
            h = np.empty((len(part), len(WIDTHS) * FILTERS), np.float32)
            for r in range(0, len(part), 16):  # a few windows at once stay in cache
                for k, (w, parts) in enumerate(zip(WIDTHS, self._tables())):
                    m = WINDOW - w + 1
                    a = None
                    for j, t in parts:
                        got = t.take((pair if len(t) > 256 else part)[r:r + 16, j:j + m], axis=0)
                        a = got if a is None else np.add(a, got, out=a)
                    h[r:r + 16, k * FILTERS:(k + 1) * FILTERS] = a.max(1)
            for k, w in enumerate(WIDTHS):
                h[:, k * FILTERS:(k + 1) * FILTERS] += self.p[f"b{w}"]
            z = np.maximum(h, 0) @ self.p["out"] + self.p["bias"]
            z = np.exp(z - z.max(1, keepdims=True)).astype(float)
            out[lo:lo + WINDOWS_AT_ONCE] = z / z.sum(1, keepdims=True)
        return out

    def predict(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        """(language, probability) of whole texts."""
        use = [i for i, t in enumerate(texts) if has_letter(t)]
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        if not use or not self.classes:
            return out
        at = 0
        while at < len(use):  # texts in groups of about WINDOWS_AT_ONCE windows
            group, n = [], 0
            while at < len(use) and (not group or n < WINDOWS_AT_ONCE):
                group.append(use[at])
                n += -(-len(texts[use[at]]) // WINDOW)
                at += 1
            total = self._mean([texts[i] for i in group])
            for i, p in zip(group, total):
                k = int(p.argmax())
                out[i] = (self.classes[k], float(min(1.0, p[k])))
        return out

    def _mean(self, texts: list[bytes]) -> np.ndarray:
        sums = np.zeros((len(texts), len(self.classes)))
        # a very long text is read in pieces of whole windows
        step = WINDOW * 4096
        parts = [(i, t[a:a + step]) for i, t in enumerate(texts) for a in range(0, len(t), step)]
        for lo in range(0, len(parts), 512):
            chunk = parts[lo:lo + 512]
            grids = [windows(_folded(t)) for _, t in chunk]
            p = self.probabilities(np.concatenate(grids))
            size = np.concatenate([np.minimum(WINDOW, len(t) - np.arange(len(g)) * WINDOW) for (_, t), g in zip(chunk, grids)])
            owner = np.repeat([i for i, _ in chunk], [len(g) for g in grids])
            np.add.at(sums, owner, p * size[:, None])
        return sums / sums.sum(1, keepdims=True)


def train(docs: DataFrame, limit: int = MAX_ROWS) -> Network:
    """Learns text -> lang from rows with crc32(doc_id as text) mod HELD_MOD not
    HELD, a non-null lang and a letter in the text.

    The sample takes equally many texts of each language at most, by a hash of
    the text, and equal texts of a language once, so a hot source or a group of
    copies can't fill it. No more than ``limit`` texts reach the driver, or one
    of each language."""
    prepare(docs.sparkSession)
    src = (docs.where(F.col("lang").isNotNull() & (split_remainder("doc_id", HELD_MOD) != HELD))
           .select(as_bytes("text"), F.col("lang").cast("string").alias("lang")))
    src = src.withColumn("hash", F.xxhash64("text"))
    counts = {r["lang"]: r["count"] for r in src.select("lang", "hash").distinct().groupBy("lang").count().collect()}
    if not counts:
        return Network([])
    each = max(1, limit // len(counts))
    # twice as many as needed by a hash threshold, then the exact number
    key = F.pmod(F.col("hash"), F.lit(1 << 30)) / float(1 << 30)
    # lang is a handful of values here; the map of rates is bounded by them
    rate = F.create_map(*[x for k, c in counts.items() for x in (F.lit(k), F.lit(min(1.0, 2.0 * each / c)))])
    some = src.withColumn("key", key).where(F.col("key") < rate[F.col("lang")])
    once = (some.mapInArrow(_training_windows, "lang string, hash long, key double, bytes binary")
            .groupBy("lang", "hash", "key").agg(F.min("bytes").alias("bytes")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key", "bytes", "hash"))
    got = once.withColumn("place", place).where(F.col("place") <= each).select("lang", "key", "bytes").collect()
    xs, ys = [], []
    for r in sorted(got, key=lambda r: (r["key"], r["lang"], r["bytes"])):
        grid = np.frombuffer(r["bytes"], np.uint8).reshape(-1, WINDOW)
        xs.append(grid)
        ys += [r["lang"]] * len(grid)
    classes = sorted(set(ys))
    net = Network(classes)
    if len(classes) < 2:
        return net
    number = {c: k for k, c in enumerate(classes)}
    return net.fit(np.concatenate(xs), np.array([number[y] for y in ys]))


def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the middle windows of each text."""
    for b in batches:
        langs, hashes, keys, out = [], [], [], []
        for t, lang, h, key in zip(*(c.to_pylist() for c in b.columns)):
            if has_letter(t):
                grid = windows(_folded(t))
                pick = sorted({0, len(grid) // 2, len(grid) - 1})[:WINDOWS_EACH]
                langs.append(lang)
                hashes.append(h)
                keys.append(key)
                out.append(grid[pick].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(hashes, pa.int64()), pa.array(keys, pa.float64()), pa.array(out, pa.binary())],
                                         ["lang", "hash", "key", "bytes"])


def detect(docs: DataFrame, net: Network, keep: tuple[str, ...] = ()) -> DataFrame:
    """(``keep``, doc_id, held_out, lang_pred, score), one row a document.

    A null text or one without a letter is ``und`` with score 0, as is every
    text when nothing was learned. Repeated rows and null ids stay; an empty
    table gives none. Only doc_id, text and ``keep`` are read.
    """
    prepare(docs.sparkSession)
    kept = [F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)]
    src = docs.select(*kept, F.col("doc_id").cast("long").alias("doc_id"), (split_remainder("doc_id", HELD_MOD) == HELD).alias("held_out"), as_bytes("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = net.predict(b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())],
                [*b.schema.names[:-1], "lang_pred", "score"])

    fields = ", ".join([*(f"keep_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)),
                        "doc_id long, held_out boolean, lang_pred string, score double"])
    out = src.mapInArrow(run, fields)
    return out.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "doc_id", "held_out", "lang_pred", "score")
