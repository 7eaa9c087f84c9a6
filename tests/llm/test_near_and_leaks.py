import random

import numpy as np
import pyarrow as pa
import pytest

from skein.llm import decontam, neardup

WORDS = [f"w{i}" for i in range(3000)]


def shingle_set(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    w = [x for part in w for x in part.split() if x] if "\u00a0" not in (text or "") else [x for part in w for x in part.replace("\n", " ").replace("\t", " ").split(" ") if x]
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return sorted(((d, len(sets[i]), c := best.get(find(i)), d == c) if sets[i] else (d, 0, d, True) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, cid int, set_key string").repartition(5)
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()), key=str)


def prose(rng, n):
    return rng.choices(WORDS, k=n)


def edited(rng, words, edits):
    out = list(words)
    for i in rng.sample(range(len(out)), edits):
        out[i] = rng.choice(WORDS)
    return out


def corpus(seed):
    rng = random.Random(seed)
    passage = prose(rng, 60)
    rows = []
    for g in range(25):
        base = prose(rng, rng.choice([30, 120, 400]))
        rows += [base] + [edited(rng, base, rng.randint(0, max(1, len(base) // 45))) for _ in range(rng.randint(0, 6))]
    # chains: each like the one before, the ends unlike
    link = prose(rng, 300)
    for _ in range(8):
        rows.append(link)
        link = link[12:] + prose(rng, 12)
    # one passage shared by many otherwise different documents
    rows += [prose(rng, 100) + passage + prose(rng, 100) for _ in range(40)]
    rng.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def test_groups_chains_and_shared_passages(spark):
    rows = corpus(1)
    assert run(spark, rows) == brute(rows)


def test_large_nodes_branch_and_end_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    monkeypatch.setattr(neardup, "SMALL", 4)
    monkeypatch.setattr(neardup, "WIDE", 2)
    monkeypatch.setattr(neardup, "DEPTH", 3)
    rows = corpus(2)
    assert run(spark, rows) == brute(rows)


def test_finishing_alone_finds_all_links(spark, monkeypatch):
    """Without rounds of drawing together every link comes from the
    exhaustive comparison, with and without branching."""
    monkeypatch.setattr(neardup, "_propose", lambda turn: lambda *cols: iter(()))
    rows = corpus(3)
    assert run(spark, rows) == brute(rows)
    monkeypatch.setattr(neardup, "SMALL", 6)
    monkeypatch.setattr(neardup, "WIDE", 3)
    assert run(spark, rows) == brute(rows)


def test_one_finishing_comparison_for_all_groups(spark, monkeypatch):
    """The number of tasks and plans doesn't follow the levels of branching."""
    ran = []

    def compare(self, rows, how, out, sketches, *more):
        ran.append((how, sorted(tuple(r) for r in rows.collect())))
        return spark.createDataFrame([], out)
    monkeypatch.setattr(neardup._Join, "compare", compare)
    monkeypatch.setattr(neardup._Join, "fetch", lambda self, used: None)
    join = neardup._Join.__new__(neardup._Join)
    join.sketches = None
    row = "node long, cid long, comp long, path long"
    groups = [spark.createDataFrame([(1, 1, 1, 0, 9)], row + ", size long"), spark.createDataFrame([(2, 1, 1, 0)], row), spark.createDataFrame([(3, 2, 2, 0)], row)]
    assert join.exhaust(groups, None).isEmpty()
    assert ran == [(neardup._mark, [(1, 1, 1, 0), (2, 1, 1, 0), (3, 2, 2, 0)])]


def test_the_map_of_wanted_ids_holds_all_in_a_few_bytes_each(spark, monkeypatch):
    rng = np.random.default_rng(5)
    ids = [None, 0, -1, *map(int, rng.integers(-1 << 63, 1 << 63, 20_000))]
    there = pa.array(ids, pa.int64())
    other = pa.array(rng.integers(-1 << 63, 1 << 63, 20_000), pa.int64())

    def held(words, x):
        at = neardup._id_bits(x, 64 * len(words))
        return words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1) == 1
    df = spark.createDataFrame([(i,) for i in ids], "rep long").repartition(3)
    words = neardup.id_map(df, len(ids))
    assert held(words, there).all() and held(words, other).mean() < 0.1 and words.nbytes <= 4 * len(ids)
    monkeypatch.setattr(neardup, "MOST_BITS", 1 << 16)  # however many are wanted
    words = neardup.id_map(df, len(ids))
    assert held(words, there).all() and words.nbytes == 1 << 13


def test_pairs_at_the_threshold_meet_at_any_depth():
    rng = np.random.default_rng(4)
    n = 1500
    a = rng.integers(0, 1 << 32, (n, neardup.TOKENS)).astype(np.uint32)
    b = np.where(rng.random(a.shape) < neardup.SHARE / neardup.OF, a, a + np.uint32(1))
    pair, node = [], []
    for tree, pos in neardup.root_paths():
        same = np.flatnonzero(a[:, pos] == b[:, pos])
        pair.append(same)
        node.append(neardup._child(np.full(len(same), tree + 1, np.uint64), np.full(len(same), pos), a[same, pos].astype(np.uint64)))
    pair, node = np.concatenate(pair), np.concatenate(node)
    for _ in range(neardup.DEPTH - 1):
        row, x = neardup._children(node, a[pair])
        same = x == neardup._children(node, b[pair])[1]
        pair, node = pair[row[same]], x[same]
    assert len(set(pair.tolist())) == n


def test_edges(spark):
    long = " ".join(prose(random.Random(3), 60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c"), (5, "A  B\nc"), (6, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (8, "É b c d e"), (9, "é b c d e"),
            (10, "x y z"), (None, "a b c"), (None, "only null id"), (12, long), (11, long + " tail"), (13, "a b c d"), (14, "z\x0by")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 1, True), (2, 0, 2, True)]


# --------------------------------------------------------- decontamination

def leaks(docs, items, threshold=0.75):
    out = []
    for d, t in docs:
        s = shingle_set(t)
        for i, q in items:
            x = shingle_set(q)
            if x and len(x & s) >= threshold * len(x):
                out.append((d, i, len(x & s), len(x)))
    return sorted(out, key=str)


def find(spark, docs, items):
    a = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item int")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in decontam.find_items(a, b).collect()), key=str)


def test_items_inside_long_documents(spark):
    rng = random.Random(6)
    items = [(i, " ".join(prose(rng, n))) for i, n in enumerate([5, 6, 9, 16, 20, 40, 70, 130, 300] * 3)]
    docs = []
    for d in range(120):
        words = prose(rng, rng.choice([20, 300, 3000, 12_000]))
        for _ in range(rng.randint(0, 3)):
            q = rng.choice(items)[1].split()
            if rng.random() < 0.4:
                q = edited(rng, q, max(1, len(q) // 40))
            at = rng.randint(0, len(words))
            words[at:at] = q
        docs.append((d, " ".join(words)))
    assert find(spark, docs, items) == leaks(docs, items)


def test_leak_edges(spark):
    items = [(1, None), (2, ""), (3, "a b c"), (4, "a b c d e f g h"), (4, "a b c d e f g h"), (None, "q r s t u")]
    docs = [(1, "A b\nC"), (2, "x a b c d e f g h y"), (2, "x a b c d e f g h y"), (None, "q r s t u"), (4, None), (5, ""), (6, "a b c d"), (7, "x a b c d e f y")]
    assert find(spark, docs, items) == leaks(docs, items)
    assert find(spark, [], items) == [] and find(spark, docs, []) == []


def test_item_blocks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 2)
    rng = random.Random(8)
    items = [(i, " ".join(prose(rng, 12))) for i in range(5)]
    docs = [(i, "x " + t + " y") for i, t in items]
    assert find(spark, docs, items) == leaks(docs, items)


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 16, 100])
def test_windows_cover_every_item_position(n):
    spans = decontam._windows(n, 8, 2)
    assert all(any(a <= i and i + 2 <= b for a, b in spans) for i in range(n - 1))
    assert {i for a, b in spans for i in range(a, b)} == set(range(n))


@pytest.mark.parametrize("block", [20_000, 1])
def test_leaked_rows_go_and_clean_rows_of_their_id_stay(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", block)
    items = spark.createDataFrame([(1, "q r s t u v"), (2, "a b c d e f")], "item_id long, text string")
    leaked = [(None, "x q r s t u v y", "l"), (7, "a b c d e f", "l"), (8, "q r s t u v", "l")]
    clean = [(None, "no item here", "c"), (None, None, None), (7, "nor in this text", "c"), (7, "nor in this text", "c"), (9, "", "c")]
    docs = spark.createDataFrame(leaked + clean, "doc_id long, text string, `a.b` string").repartition(3)
    got = decontam.clean_documents(docs, items)
    assert got.schema == docs.schema
    assert sorted(map(tuple, got.collect()), key=str) == sorted(clean, key=str)
    assert decontam.clean_documents(docs, items.limit(0)).count() == docs.count()
