import numpy as np
import pytest

from skein.llm import negatives
from skein.llm.negatives import LEVELS, bounds, hard_negatives, hard_negatives_plain, summary

SCHEMA = "vec_id long, embedding array<float>, label int"


def _vectors(n=900, dim=12, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(8, dim))
    x = (centre[rng.integers(8, size=n)] + spread * rng.normal(size=(n, dim))).astype(np.float32)
    return [(int(i), [float(c) for c in v], int(y)) for i, v, y in zip(rng.permutation(n), x, rng.integers(4, size=n))]


def test_bounds_hold_on_every_level():
    rng = np.random.default_rng(0)
    for dim in (1, 3, 12, 64, 70):
        a, b = np.floor(300 * rng.normal(size=(30, dim))), np.floor(300 * rng.normal(size=(40, dim)) + 100)
        exact, widths = a @ b.T, []
        for n in LEVELS:
            lo, hi = bounds(summary(a, n), summary(b, n))
            assert (lo <= exact).all() and (exact <= hi).all()
            widths.append((hi - lo).mean())
        assert widths == sorted(widths, reverse=True)  # finer levels bound closer


@pytest.mark.parametrize("step, group, block", [(1024, 256, 32768), (50, 3, 100)])
def test_equal_to_brute_force(spark, monkeypatch, step, group, block):
    monkeypatch.setattr(negatives, "STEP", step)
    monkeypatch.setattr(negatives, "GROUP", group)
    monkeypatch.setattr(negatives, "ANCHORS", 4 if block == 100 else 4096)
    monkeypatch.setattr(negatives, "ROWS", block)
    rows = _vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", score string, entry int").repartition(3)
    got = sorted(tuple(r) for r in hard_negatives(df, anchor_mod=30).collect())
    assert got == hard_negatives_plain(rows, anchor_mod=30) and len(got) > 300


def test_bounds_spare_the_scoring(monkeypatch):
    """Rows whose intervals miss the window are never scored."""
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(40, 8)), 8, axis=1) * 100 + rng.normal(size=(40, 64))
    many = np.floor(np.concatenate([x[k % 40] + 5 * rng.normal(size=(1, 64)) for k in range(4000)]))

    class Made:
        pass

    def block(v):
        b = Made()
        b.id, b.label, b.x = np.arange(len(v)), np.zeros(len(v), int), v
        b.levels = [summary(v, n) for n in LEVELS]
        return b
    seen = []
    monkeypatch.setattr(negatives, "STEP", 100)
    rows, anchors = block(many), block(many[:1])
    rows.x = type("Counted", (), {"__getitem__": lambda self, k: type("C", (), {"__getitem__": lambda s, c: (seen.append(len(c)), many[k][c])[1]})()})()
    wide = np.full((1, 1), np.inf)
    (i, w, j, s), = negatives.best_rows(anchors, rows, 5, lambda a, r: np.ones((1, 100), bool), -wide, wide)
    exact = many @ many[0]
    assert sorted(s, reverse=True) == sorted(exact, reverse=True)[:5] and sum(seen) < 1500


def test_ties_nulls_mixed_lengths_and_repeats(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(100, [1.0, 0.5], 1), (200, [1.0], 1), (300, [], 1), (400, [-1.0, 0.0], 2), (1, [1.0, 0.5, 0.25], 1), (2, [1.0, 0.5], 1), (3, [1.0, 0.5], 1),
            (4, [0.5, 0.25], 2), (5, [0.5, 0.25], 2), (6, [0.5, 0.25], 2), (7, [0.6, 0.1], 3), (8, [0.2, 0.0], 2), (9, [1.0, 0.5], 2), (10, [0.0, 0.0], 2)]
    bad = [(500, None, 1), (600, [1.0, None], 1), (11, [nan, 1.0], 2), (12, [inf], 2), (13, [0.5, 0.2], None), (None, [0.5, 0.2], 2), (700, [1.0], None)]
    df = spark.createDataFrame([*rows, *bad, *rows[3:9]], SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in hard_negatives(df).collect())
    assert got == hard_negatives_plain([*rows, *bad])
    assert [r[3] for r in got if r[:2] == (100, 1)][:3] == [7, 4, 5]  # 179.2, then ties by id
    assert hard_negatives(df.where("vec_id % 100 <> 0")).collect() == [] == hard_negatives(df.limit(0)).collect()
    assert hard_negatives(df.where("label = 1")).collect() == []  # positives, no negatives
    assert hard_negatives(df.where("vec_id = 100")).collect() == []


def test_few_negatives_and_very_large_components(spark):
    rows = [(0, [1e30, 1.0], 0), (1, [1e30, 2.0], 0), (2, [1e30, 3.0], 1), (3, [-1e30, 0.0], 1)]
    got = hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert got == [] or all(r.positive_score == negatives.LARGEST for r in got)  # saturated, no crash


def test_labels_are_integers(spark):
    with pytest.raises(ValueError):
        hard_negatives(spark.createDataFrame([(1, [1.0], "a")], "vec_id long, embedding array<float>, label string"))


def test_an_id_on_two_rows(spark):
    rows = [(0, [1.0], 0), (0, [0.5], 0), (1, [1.0], 0), (2, [0.5], 1)]
    got = sorted(tuple(r) for r in hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect())
    # each row of id 0 is an anchor; neither is the other's positive
    assert got == [(0, 1, 1, 2, 32768, 16384), (0, 1, 1, 2, 65536, 32768)]
