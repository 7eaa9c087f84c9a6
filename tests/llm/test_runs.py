import random

import pytest
from pyspark.sql import functions as F

from skein.llm import runs
from skein.llm.runs import collapse, find_runs, find_runs_plain, runs_of


def _word_lists(rng, n):
    """Random, periodic and Fibonacci-like sequences over few words."""
    out = []
    for _ in range(n):
        k, size = rng.choice([1, 2, 2, 3, 5]), rng.randrange(90)
        kind = rng.random()
        if kind < 0.4:
            w = [rng.randrange(k) for _ in range(size)]
        elif kind < 0.8:
            w = []
            while len(w) < size:
                u = [rng.randrange(k) for _ in range(rng.randrange(1, 9))]
                w += u * rng.randrange(1, 6) + u[:rng.randrange(len(u) + 1)]
            w += w[:rng.randrange(len(w) + 1)]
        else:
            a, b = [0], [0, 1]
            while len(b) < 100:
                a, b = b, b * rng.randrange(1, 3) + a
            w = b
        out.append([b"%d" % x for x in w])
    return out


@pytest.mark.parametrize("least", [1, 2, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(250):
        texts = _word_lists(rng, rng.randrange(1, 5))
        assert runs_of(texts, least) == [find_runs_plain(t, least) for t in texts]


def test_all_words_equal_and_nested_periods():
    assert runs_of([[b"a"] * 500]) == [[(0, 500, 1)]]
    w = ([b"a", b"b"] * 8 + [b"c"]) * 3
    assert runs_of([w]) == [find_runs_plain(w)] and (0, 51, 17) in runs_of([w])[0] and (0, 16, 2) in runs_of([w])[0]
    assert collapse(w, runs_of([w])[0]) == [b"a", b"b", b"c"]


def test_texts_of_a_block_are_apart():
    w = [b"x%d" % i for i in range(7)]
    assert runs_of([w, w, w * 2, [], w]) == [[], [], [(0, 14, 7)], [], []]


def test_find_runs_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(runs, "BLOCK_BYTES", 300)  # several blocks a task
    rng = random.Random(3)
    texts = [None, "", " \t\n\r ", "one", "A a " * 6, "a b " * 7, "\x0b\x0cx y\x1cz\n" * 9, "lösung ☃ " * 20]
    texts += [" ".join(w.decode() for w in t) for t in _word_lists(rng, 40)]
    rows = [(i, t, "x", 1.5) for i, t in enumerate(texts)] + [(None, "u v " * 9, "x", 0.0), (4, "A a " * 6, "y", None), (4, "other", "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words double").repartition(3)
    got = find_runs(docs).collect()
    want = []
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        r = find_runs_plain(w)
        want.append((i, len(w), r, b" ".join(collapse(w, r)).decode()))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=str) == sorted(want, key=str)
    assert find_runs(docs.limit(0)).collect() == []
    assert find_runs(docs.limit(0)).columns == ["doc_id", "n_words", "runs", "collapsed"]


def test_a_very_long_text(spark):
    unit = [f"w{i}" for i in range(30_000)]
    text = " ".join(["head"] + unit * 3 + ["w0", "tail"])
    r = find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.n_words, [tuple(x) for x in r.runs]) == (90_003, [(1, 90_001, 30_000)])
    assert r.collapsed == " ".join(["head"] + unit + ["tail"])


def test_words_that_differ_in_case_are_different(spark):
    r = find_runs(spark.createDataFrame([(1, "Ab ab " * 6)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r.runs] == [(0, 12, 2)]


def test_one_scan_without_a_shuffle(spark):
    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.lit("a b " * 8).alias("text"))
    plan = find_runs(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
