"""Secret scans over a trigram inverted index.

Each rule's regex is reduced to a Boolean query over lower-cased byte
trigrams: alternatives give OR, sequences give AND. The documents of a block
are indexed (trigram -> sorted postings of document numbers), postings are
intersected and united as the query says, and the candidates are verified with
the regex itself. A rule without a mandatory trigram scans every document.

The index is segmented: a block of documents carries its own postings, so
nothing is shuffled, a lost task redoes only its own blocks and no trigram's
postings grow with the corpus. Only trigrams named by a rule are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, blocks, prepare

MAX_STRINGS = 64    # alternatives followed exactly before a part is left open
BLOCK_BYTES = 1 << 20


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost non-overlapping matches; one is kept when
    group ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    base: bool = False

    def compiled(self) -> re.Pattern:
        """A lone run of a class is searched at its least length at once: the
        runs found are the same, short ones are skipped inside the engine."""
        run = re.fullmatch(r"(\[[^\]\\]+\])\+", self.pattern)
        pattern = f"{run[1]}{{{max(1, self.least)},}}" if run and self.group == 0 else self.pattern
        return re.compile(pattern, re.ASCII)


# Kinds, patterns and lengths of the base rules.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18, 0, True),
    Rule("hex", r"[0-9a-f]+", 16, 0, True),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

# ------------------------------------------------- regex -> trigram query ---
# A query is True (no constraint), ("gram", bytes), ("and", qs) or ("or", qs).


def _join(op: str, qs) -> object:
    qs = [q for q in qs if not (op == "and" and q is True)]
    if op == "or" and any(q is True for q in qs):
        return True
    if not qs:
        return True
    return qs[0] if len(qs) == 1 else (op, tuple(dict.fromkeys(qs)))


def _grams(strings: set[str]) -> object:
    """Some string of the set occurs: OR of the ANDs of their trigrams."""
    alts = []
    for s in sorted(strings):
        b = s.encode().lower()
        alts.append(_join("and", [("gram", b[i:i + 3]) for i in range(len(b) - 2)]))
    return _join("or", alts) if alts else True


def _walk(nodes) -> tuple[set[str] | None, list]:
    """(the exact strings a part can be, or None when open; queries that hold)."""
    exact, held = {""}, []

    def close():
        nonlocal exact
        if exact is not None:
            held.append(_grams(exact))
        exact = None

    for op, arg in nodes:
        got, more = _one(op, arg)
        held.extend(more)
        if got is not None and exact is not None and len(exact) * len(got) <= MAX_STRINGS:
            exact = {a + b for a in exact for b in got}
            continue
        close()
        exact = got
    return exact, held


def _one(op, arg) -> tuple[set[str] | None, list]:
    if op is C.LITERAL:
        return {chr(arg)}, []
    if op is C.SUBPATTERN:
        return _walk(arg[3])
    if op is C.BRANCH:
        parts = [_whole(p) for p in arg[1]]
        exact = set().union(*(e for e, _ in parts)) if all(e is not None for e, _ in parts) else None
        return (exact, []) if exact is not None and len(exact) <= MAX_STRINGS else (None, [_join("or", [q for _, q in parts])])
    if op is C.IN and all(o is C.LITERAL for o, _ in arg) and len(arg) <= 4:
        return {chr(v) for _, v in arg}, []
    if op in (C.MAX_REPEAT, C.MIN_REPEAT):
        low, high, body = arg
        exact, held = _walk(body)
        if (low, high) == (0, 1) and exact is not None:
            return exact | {""}, []
        if low == 0:
            return None, []
        return None, [*held, *([_grams(exact)] if exact is not None else [])]
    if op is C.AT:
        return {""}, []
    return None, []


def _whole(nodes) -> tuple[set[str] | None, object]:
    exact, held = _walk(nodes)
    return exact, _join("and", [*held, *([_grams(exact)] if exact is not None else [])])


@lru_cache
def trigram_query(pattern: str) -> object:
    """The Boolean trigram query every match of ``pattern`` satisfies; True
    when it has no mandatory trigram."""
    return _whole(_parser.parse(pattern, re.ASCII))[1]


def query_grams(q: object) -> set[bytes]:
    if q is True:
        return set()
    return {q[1]} if q[0] == "gram" else set().union(*(query_grams(x) for x in q[1]))


# ----------------------------------------------------------------- index ---

class Segment:
    """Inverted index of one block: trigram -> ascending document numbers."""

    def __init__(self, texts: Sequence[bytes], table: np.ndarray, grams: Sequence[bytes]):
        self.n = len(texts)
        buf = np.frombuffer(b"\x00\x00".join(texts).lower(), np.uint8)
        self.postings = {g: np.empty(0, np.int64) for g in grams}
        if len(buf) < 3:
            return
        wide = buf.astype(np.uint32)
        which = table[(wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]]
        at = np.flatnonzero(which)
        ends = np.cumsum([len(t) + 2 for t in texts])
        doc = np.searchsorted(ends, at, side="right")
        pairs = np.unique(which[at].astype(np.int64) * self.n + doc)
        cut = np.searchsorted(pairs, np.arange(1, len(grams) + 2) * self.n)
        for k, g in enumerate(grams):
            self.postings[g] = pairs[cut[k]:cut[k + 1]] % self.n

    def find(self, q: object) -> np.ndarray:
        if q is True:
            return np.arange(self.n)
        if q[0] == "gram":
            return self.postings[q[1]]
        found = sorted((self.find(x) for x in q[1]), key=len)
        out = found[0]
        for x in found[1:]:
            out = np.intersect1d(out, x, True) if q[0] == "and" else np.union1d(out, x)
        return out


def _finder(rules: Sequence[Rule]):
    """Makes (texts) -> (strings, spans of each) in a worker."""
    def make():
        ready = [(k, r, r.compiled(), trigram_query(r.pattern)) for k, r in enumerate(rules)]
        grams = sorted(set().union(*(query_grams(q) for *_, q in ready)))
        table = np.zeros(1 << 24, np.uint8 if len(grams) < 256 else np.uint16)
        for i, g in enumerate(grams):
            table[int.from_bytes(g, "big")] = i + 1

        def search(texts: Sequence[bytes | None]) -> tuple[list[str], list[list[tuple[str, int, int]]]]:
            texts = [t or b"" for t in texts]
            seg = Segment(texts, table, grams)
            strings = [t.decode("utf-8", "replace") for t in texts]
            hits: list[list] = [[] for _ in texts]
            for k, r, rx, q in ready:
                for d in seg.find(q).tolist():
                    for m in rx.finditer(strings[d]):
                        lo, hi = m.span(r.group)
                        if hi - lo >= r.least:
                            hits[d].append((m.start(), k, r.kind, m.end()))
            return strings, [[(kind, s, e) for s, _, kind, e in sorted(h)] for h in hits]
        return search
    return make


def _scan(rules: Sequence[Rule]):
    find = _finder(rules)
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = find()
        for ids, texts in blocks(batches, BLOCK_BYTES):
            hits = search(texts)[1]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()),
                pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in h] for h in hits], spans)], ["doc_id", "found"])
    return run


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: Sequence[Rule] = (*BASE_RULES, *MORE_RULES)) -> DataFrame:
    """(doc_id, found): one row per document; ``found`` lists (kind, start, end)
    by start, then by the order of ``rules``. Offsets are code points, end
    exclusive. Null and empty texts have no spans; repeated rows and null ids
    stay; an empty table gives none. Only the two named columns are read."""
    prepare(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), as_bytes(f"`{text_col}`")).mapInArrow(
        _scan(tuple(rules)), "doc_id long, found array<struct<kind: string, start: long, end: long>>")


def redact(text: str, found: Sequence[tuple[str, int, int]]) -> str:
    """The text with each found span replaced by ``[kind]``; overlapping spans
    are replaced together under the kind that starts first."""
    out, at = [], 0
    for kind, s, e in sorted(found, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = (*BASE_RULES, *MORE_RULES)) -> DataFrame:
    """The documents, all columns and rows, with secrets replaced in the text.
    A null text stays null."""
    prepare(docs.sparkSession)
    names = docs.columns
    at = names.index(text_col)
    other = [c for c in names if c != text_col]
    src = docs.select(*[F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(other)], as_bytes(f"`{text_col}`"))
    find = _finder(tuple(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = find()
        for b in batches:
            for lo, texts in _runs_of(b.column(b.num_columns - 1)):
                part = b.slice(lo, len(texts))
                strings, hits = search(texts)
                clean = [redact(s, h) if t is not None else None for t, s, h in zip(texts, strings, hits)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(clean, pa.string())], part.schema.names)

    fields = ", ".join([*(f"keep_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(other)), "text string"])
    out = src.mapInArrow(run, fields)
    cols = [F.col(f"keep_{i}").alias(c) for i, c in enumerate(other)]
    cols.insert(at, F.col("text").alias(text_col))
    return out.select(*cols)


def _runs_of(column) -> Iterator[tuple[int, list]]:
    """Runs of about BLOCK_BYTES of a binary column, with their first row."""
    texts, lo, size = column.to_pylist(), 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > BLOCK_BYTES:
            yield lo, texts[lo:i]
            lo, size = i, 0
        size += n + 1
    if texts:
        yield lo, texts[lo:]


def count_of(found, kind: str):
    """How many spans of a kind a document has."""
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def spans_text(found, kinds: Sequence[str] | None = None):
    """``kind:start:end`` joined with commas, of the given kinds."""
    chosen = F.filter(found, lambda s: s["kind"].isin(list(kinds))) if kinds else found
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

