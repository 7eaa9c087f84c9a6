import random

import pytest
from pyspark.sql import functions as F

from skein.llm import exactdup
from skein.llm.exactdup import HEAD, PatriciaTrie, _key, common_prefix, exact_duplicates, exact_duplicates_plain


def test_common_prefix():
    rng = random.Random(1)
    for _ in range(500):
        a = bytes(rng.randrange(2) for _ in range(rng.randrange(12)))
        b = bytes(rng.randrange(2) for _ in range(rng.randrange(12)))
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common_prefix(a, b) == n


def _add(trie, key, value):
    trie.add(key, [value], lambda a, b: a + b)


def test_trie_holds_prefixes_and_equal_keys():
    rng = random.Random(2)
    for _ in range(100):
        trie, want = PatriciaTrie(), {}
        for i in range(60):
            k = bytes(rng.choice(b"ab") for _ in range(rng.randrange(8)))
            _add(trie, k, i)
            want.setdefault(k, []).append(i)
        assert sorted(trie.spill(None)) == sorted(want.values()) and trie.bytes == 0
        assert list(trie.spill(None)) == []


def test_spill_by_subtree_keeps_the_open_one():
    rng = random.Random(3)
    for _ in range(200):
        keys = sorted(bytes(rng.choice(b"abc") for _ in range(rng.randrange(3, 9))) for _ in range(80))
        trie, out = PatriciaTrie(), []
        for k in keys:
            if rng.random() < 0.2:
                out += trie.spill(k[:3])
                assert all(x[0][:3] != k[:3] for x in out)  # what may still grow stays
            _add(trie, k, k)
        out += trie.spill(None)
        assert sorted(out) == sorted([k] * keys.count(k) for k in set(keys)) and trie.bytes == 0


def _rows(rng):
    base = ["", "Text", "tEXT", "text ", "long " * 5000, "LONG " * 5000, "ÄÖ", "äö", "a" * 9, "a" * 10]
    rows = [(i, rng.choice(base)) for i in range(300)] + [(1000 + i, "HOT copy") for i in range(200)]
    return rows + [(None, "Text"), (None, "only here"), (None, None), (7, None), (2000, "twice"), (2000, "TWICE"), (2000, "twice"), (-5, "hot COPY")]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups_equal_brute_force(spark, monkeypatch, keep):
    monkeypatch.setattr(exactdup, "BLOCK_BYTES", 4000)  # many blocks a task
    monkeypatch.setattr(exactdup, "TRIE_BYTES", 200)    # many spills
    rows = _rows(random.Random(4))
    docs = spark.createDataFrame([(i, t, "x", True) for i, t in rows], "doc_id long, text string, rep string, kept boolean").repartition(5)
    got = exact_duplicates(docs, keep=keep).collect()
    want = exact_duplicates_plain(rows, keep == "smallest")
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == sorted((str(i), str(k), n, s) for i, k, n, s in want)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({s for *_, s in want}) == len({r.text_sha256 for r in kept})  # one of each group, repeated rows too
    assert all(r.doc_id == r.keep_id for r in kept)


def test_empty_table_and_wrong_choice(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_duplicates(docs).collect() == []
    with pytest.raises(KeyError):
        exact_duplicates(docs, keep="any")


def test_other_columns_are_not_read(spark, tmp_dir):
    spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, extra string").write.parquet(f"{tmp_dir}/d")
    docs = spark.read.parquet(f"{tmp_dir}/d")
    assert [tuple(r)[:4] for r in exact_duplicates(docs).collect()] == [(1, 1, 1, True)]


def test_a_hot_text_leaves_a_block_once(spark):
    """A third of all rows are one text: a scan task sends it once a block."""
    rows = [(i, "hot text " * 20 if i % 3 == 0 else f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    sent = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        exactdup._represent(True), "doc_id long, rep long, stays boolean, text_sha256 string, n long, key binary")
    hot = sent.where(F.col("key").isNotNull() & (F.length("key") == HEAD + 180)).collect()
    assert len(hot) == 2 and sum(r.n for r in hot) == 1000
    got = exact_duplicates(docs).where("group_size = 1000").collect()
    assert len(got) == 1000 and {r.keep_id for r in got} == {0} and [r.doc_id for r in got if r.kept] == [0]


def test_texts_of_one_length_and_hash_are_told_apart(spark, monkeypatch):
    """The trie compares bytes: a hash that says nothing changes no result."""
    own = exactdup._own(True)
    import pyarrow as pa
    keys = sorted((len(t).to_bytes(8, "big") + bytes(16) + t, i) for i, t in enumerate([b"abc", b"abd", b"abc", b"xyz", b"abd"]))
    batch = pa.RecordBatch.from_arrays([pa.array([i for _, i in keys]), pa.array([i for _, i in keys]), pa.array([1] * 5), pa.array([k for k, _ in keys], pa.binary())],
                                       ["rep", "doc_id", "n", "key"])
    out = {r["rep"]: (r["keep_rep"], r["group_size"]) for b in own(iter([batch])) for r in b.to_pylist()}
    assert out == {0: (0, 2), 2: (0, 2), 1: (1, 2), 4: (1, 2), 3: (3, 1)}
    assert _key(b"abc")[:8] == (3).to_bytes(8, "big") and len(_key(b"")) == HEAD
