"""SentencePiece encoding and decoding for merge (BPE) models.

A merge encoder joins the best-scored neighbouring pair again and again. The
same ids are found here left to right: a token sequence is the encoder's
result exactly when every two neighbours are *compatible*, that is when
undoing the merges on both sides of their border never meets a pair that the
encoder would have joined earlier. So the longest match at each position (an
Aho-Corasick automaton over the pieces) is taken if it is compatible with the
token before it, else a shorter prefix piece; when none is left the last token
is given back and its end position is marked in a bitfield of failed
positions, so that no position is tried twice.

Characters without a piece never merge; they are cut out and written as byte
pieces. Piece lengths, the space mark and the byte pieces come from the model
file, read on the driver (its size is checked) and sent with the tasks.

Texts are encoded in words (the space mark only starts pieces, which is
checked on loading), so a bounded memo of words does most of the work.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, blocks, prepare

MARK = "▁"
MAX_MODEL_BYTES = 64 << 20
MEMO_WORDS, MEMO_WORD_CHARS, MEMO_PAIRS = 200_000, 64, 250_000
BLOCK_BYTES = 2 << 20

_WORD = re.compile(f"{MARK}+|[^{MARK}]+")


class PieceModel:
    """Tables of a merge model and the exact encoder over them."""

    def __init__(self, proto: bytes):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.byte_ids = [0] * 256
        self.text_of: list[bytes] = [b""] * n  # what each id decodes to
        pieces: dict[str, int] = {}
        for i in range(n):
            if sp.is_byte(i):
                b = int(sp.id_to_piece(i)[3:-1], 16)
                self.byte_ids[b], self.text_of[i] = i, bytes([b])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[sp.id_to_piece(i)] = i
                self.text_of[i] = sp.id_to_piece(i).replace(MARK, " ").encode()
        if sum(map(sp.is_byte, range(n))) != 256:
            raise ValueError("the model has no byte pieces")
        self.text_of[self.unk] = " ⁇ ".encode()
        self._check(sp, pieces)
        self.mark_runs = {len(p): i for p, i in pieces.items() if set(p) == {MARK}}
        self._build({p: i for p, i in pieces.items() if p == MARK or set(p) != {MARK}}, sp)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _check(sp, pieces: dict[str, int]) -> None:
        """Refuse models whose rules this encoder doesn't follow."""
        if any(MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and set(p) != {MARK}) for p in pieces):
            raise ValueError("the space mark may only start a piece")
        scores = [sp.get_score(i) for p, i in pieces.items() if set(p) != {MARK}]
        if len(set(scores)) != len(scores):
            raise ValueError("pieces share a score, so their merge order is open")
        if any(sp.get_score(i) >= min(scores) for p, i in pieces.items() if set(p) == {MARK} and len(p) > 1):
            raise ValueError("runs of the space mark must merge last")
        if "".join(sp.encode(" a  b ", out_type=str)) != f"{MARK}{MARK}a{MARK}{MARK}b{MARK}":
            raise ValueError("the model must add a dummy prefix and keep the text as it is")

    def _build(self, pieces: dict[str, int], sp) -> None:
        # merge rank: single characters 0, then best score first; only pieces
        # that merging can produce take part
        chars = {c for p in pieces for c in p}
        order = sorted((p for p in pieces if len(p) > 1), key=lambda p: -sp.get_score(pieces[p]))
        self.names = sorted(chars) + order
        self.id_of = [pieces.get(p, -1) for p in self.names]
        at = {p: k for k, p in enumerate(self.names)}
        self.chars = chars
        self.atoms = len(chars)
        self.split = [(k, k) for k in range(len(self.names))]
        self.pairs: dict[tuple[int, int], int] = {}
        self.pair_memo: dict[tuple[int, int], bool] = {}
        made = set(range(self.atoms))
        for k in range(self.atoms, len(self.names)):
            parts = self._merge(self.names[k], at, k)
            if parts:
                made.add(k)
                self.split[k] = parts
                self.pairs[parts] = k
        # a pair also joins when its own text is a piece, however that piece
        # is split when it is made alone
        for k in sorted(made):
            p = self.names[k]
            for cut in range(1, len(p)):
                a, b = at.get(p[:cut]), at.get(p[cut:])
                if a is not None and b is not None:
                    self.pairs.setdefault((a, b), k)
        self.auto = ahocorasick.Automaton()
        for k in sorted(made):
            # stored backwards: matches of the reversed text end where the piece starts
            self.auto.add_word(self.names[k][::-1], k)
        self.auto.make_automaton()
        self.size = [len(p) for p in self.names]
        self.shorter = [-1] * len(self.names)  # longest producible proper prefix
        for k in made:
            p = self.names[k]
            for n in range(len(p) - 1, 0, -1):
                j = at.get(p[:n])
                if j is not None and j in made:
                    self.shorter[k] = j
                    break

    def _merge(self, piece: str, at: dict[str, int], target: int) -> tuple[int, int] | None:
        """The last pair joined when ``piece`` is merged alone, or None if
        merging ends elsewhere."""
        toks = [at[c] for c in piece]
        while len(toks) > 1:
            best = min(((at.get(self.names[a] + self.names[b], 1 << 60), i) for i, (a, b) in enumerate(zip(toks, toks[1:]))))
            if best[0] == 1 << 60:
                return None
            if len(toks) == 2:
                return (toks[0], toks[1]) if best[0] == target else None
            i = best[1]
            toks[i:i + 2] = [best[0]]
        return None

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoder can leave the border between ``a`` and ``b``:
        both are taken apart in reverse merge order, and no pair seen at the
        border may be one that joins before the merges already undone."""
        got = self.pair_memo.get((a, b))
        if got is not None:
            return got
        x, y, limit, ok = a, b, 1 << 60, True
        while True:
            joined = self.pairs.get((x, y))
            if joined is not None and joined < limit:
                ok = False
                break
            # atoms have rank below all merges; of two merges the later one is
            # undone first, on equal rank the right one (the left was first)
            rx, ry = (x if x >= self.atoms else -1), (y if y >= self.atoms else -1)
            if rx < 0 and ry < 0:
                break
            if rx > ry:
                limit, x = x, self.split[x][1]
            else:
                limit, y = y + 1, self.split[y][0]
        if len(self.pair_memo) >= MEMO_PAIRS:
            self.pair_memo.clear()
        self.pair_memo[(a, b)] = ok
        return ok

    def _segment(self, text: str) -> list[int]:
        """Ranks of the pieces of a text made of known characters."""
        n = len(text)
        longest = [-1] * n
        for end, k in self.auto.iter(text[::-1]):
            # iter() reports every match; the longest one that starts at a position stays
            start = n - 1 - end
            if longest[start] < 0 or self.size[k] > self.size[longest[start]]:
                longest[start] = k
        failed = bytearray((n >> 3) + 1)
        toks, at = [], 0
        k = longest[0]
        while at < n:
            while True:
                end = at + self.size[k]
                if not failed[end >> 3] & (1 << (end & 7)) and (not toks or self.compatible(toks[-1], k)):
                    toks.append(k)
                    at = end
                    k = longest[at] if at < n else -1
                    break
                if self.shorter[k] >= 0:
                    k = self.shorter[k]
                    continue
                # nothing starts here after the last token: give it back
                failed[at >> 3] |= 1 << (at & 7)
                k = toks.pop()
                at -= self.size[k]
                break
        return toks

    def _mark_run(self, n: int) -> list[int]:
        """Runs of the space mark merge at one shared score, leftmost first."""
        stack: list[int] = []
        for _ in range(n):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.mark_runs:
                stack[-2:] = [stack[-2] + stack[-1]]
        return [self.mark_runs[m] for m in stack]

    def _word(self, word: str) -> list[int]:
        """Ids of marks followed by other characters."""
        body = word.lstrip(MARK)
        marks = len(word) - len(body)
        ids: list[int] = []
        rest = (MARK if marks else "") + body
        parts, known = [], ""
        for c in rest if not self.chars.issuperset(rest) else ():
            if c in self.chars:
                known += c
            else:
                parts += [known, c]
                known = ""
        parts = [*parts, known] if parts else [rest]
        out: list[int] = []
        for j, p in enumerate(parts):
            if j % 2:
                out += [self.byte_ids[b] for b in p.encode()]
            elif p:
                for k in self._segment(p):
                    i = self.id_of[k]
                    out += [i] if i >= 0 else [self.byte_ids[b] for b in self.names[k].encode()]
        if marks and out and out[0] == self.mark_runs.get(1):
            return self._mark_run(marks) + out[1:]
        return (self._mark_run(marks - 1) if marks > 1 else ids) + out

    def _bytes_of(self, word: str) -> bytes:
        got = self.older.get(word)
        if got is None:
            got = array("I", self._word(word)).tobytes()
            if len(word) > MEMO_WORD_CHARS:
                return got
        if len(self.memo) >= MEMO_WORDS:
            self.older, self.memo = self.memo, {}
        self.memo[word] = got
        return got

    def encode(self, text: str) -> array:
        """Ids with begin and end, as unsigned 32-bit integers."""
        ids = array("I", [self.bos])
        if text:
            marked = MARK + text.replace(" ", MARK)
            memo, parts = self.memo, []
            # a word: its marks and what follows them
            pieces = _WORD.findall(marked)
            words = [a + b for a, b in zip(pieces[::2], pieces[1::2])]
            if len(pieces) % 2:
                words.append(pieces[-1])
            for w in words:
                got = memo.get(w)
                parts.append(got if got is not None else self._bytes_of(w))
                memo = self.memo
            ids.frombytes(b"".join(parts))
        ids.append(self.eos)
        return ids

    def decode(self, ids) -> str:
        """The text of ids: begin and end are skipped, the mark becomes a
        space, the first piece loses its leading space, byte pieces are joined
        to characters (an incomplete one becomes U+FFFD)."""
        out = b"".join(map(self.text_of.__getitem__, ids))
        first = next((i for i in ids if self.text_of[i]), None)
        if first is not None and self.text_of[first].startswith(b" ") and first != self.unk:
            out = out[1:]
        return out.decode("utf-8", "replace")


_LOADED: dict[str, PieceModel] = {}


def load_model(proto: bytes) -> PieceModel:
    """One model per process; Python workers are reused."""
    key = hashlib.sha256(proto).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = PieceModel(proto)
    return _LOADED[key]


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        proto = f.read(MAX_MODEL_BYTES + 1)
    if len(proto) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return proto


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Encode and decode each whole text: ``keep`` columns, doc_id, n_tokens,
    ids (little-endian unsigned 32-bit integers) and decoded.

    Null counts as empty: begin and end only, decoded ''. Very long texts and
    words are encoded whole, in linear memory. Repeated rows and null ids stay;
    an empty table gives none. Only the named columns are read.
    """
    spark = prepare(docs.sparkSession)
    proto = spark.sparkContext.broadcast(read_model(model_path))
    kept = [F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)]
    src = docs.select(*kept, F.col(f"`{id_col}`").cast("long").alias("doc_id"), as_bytes(f"`{text_col}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(proto.value)
        for batch in batches:
            for lo, texts in _slices(batch.column(batch.num_columns - 1)):
                part = batch.slice(lo, len(texts))
                coded, plain = [], []
                for t in texts:
                    ids = model.encode(t.decode("utf-8", "replace") if t else "")
                    coded.append(ids)
                    plain.append(model.decode(ids))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([len(x) for x in coded], pa.int64()),
                     pa.array([_little(x) for x in coded], pa.binary()), pa.array(plain, pa.string())],
                    [*part.schema.names[:-1], "n_tokens", "ids", "decoded"])

    fields = ", ".join([*(f"keep_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)),
                        "doc_id long", "n_tokens long", "ids binary", "decoded string"])
    out = src.mapInArrow(run, fields)
    return out.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "doc_id", "n_tokens", "ids", "decoded")


def _little(ids: array) -> bytes:
    import sys
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def _slices(column) -> Iterator[tuple[int, list]]:
    """Runs of about BLOCK_BYTES of a binary column, with their first row."""
    texts = column.to_pylist()
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > BLOCK_BYTES:
            yield lo, texts[lo:i]
            lo, size = i, 0
        size += n + 1
    if texts:
        yield lo, texts[lo:]
