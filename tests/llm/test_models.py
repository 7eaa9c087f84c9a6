import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from skein.llm import ann, langid, lm, toxicity


def remainder(i, m):
    return zlib.crc32(("" if i is None else str(i)).encode()) % m


# -------------------------------------------------------------------- LM

def brute_lm(rows):
    docs = [(i, remainder(i, 10) == 0, (t or "").encode().lower().split() + [None]) for i, t in rows]
    train = [w for _, h, w in docs if not h]
    c1 = Counter(x for w in train for x in w)
    c2 = Counter((a, b) for w in train for a, b in zip(["begin", *w], w))
    n, v = sum(c1.values()), len(c1)
    root = lambda w: (c1[w] + 0.1) / (n + 0.1 * (v + 1))
    out = []
    for i, h, words in docs:
        base = score = 0.0
        for u, w in zip(["begin", *words], words):
            base += math.log10(root(w))
            visits = len(train) if u == "begin" else c1[u]
            score += math.log10((c2[u, w] + lm.K * root(w)) / (visits + lm.K))
        out.append((i, h, len(words), sum(c1[w] > 0 for w in words), n, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


def run_lm(spark, rows):
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, block int").repartition(4)
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                   for r in lm.score_documents(df).collect()), key=str)


def test_lm_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 300)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("The the of a b c d é É x1".split(), k=rng.randint(0, 30)))) for i in range(200)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, "new\x0bwords\x0chere"), (504, "the the"), (504, "the the"), (None, "a b"), (505, "the " * 20_000)]
    assert run_lm(spark, rows) == brute_lm(rows)


def test_lm_without_rows_or_training(spark):
    assert run_lm(spark, []) == []
    held = [i for i in range(100) if remainder(i, 10) == 0][:3]
    rows = [(i, "a b") for i in held]
    assert run_lm(spark, rows) == brute_lm(rows)


def test_states_are_distributions():
    # arcs and the failure arc's share add up to 1 in any state
    c2, c, n, v = {"a": 3, "b": 1}, 4, 100, 3
    counts = {"a": 60, "b": 30, "c": 10}
    root = {w: (k + 0.1) / (n + 0.1 * (v + 1)) for w, k in counts.items()}
    unknown = 0.1 / (n + 0.1 * (v + 1))
    total = sum((c2.get(w, 0) + lm.K * root[w]) / (c + lm.K) for w in counts) + lm.K / (c + lm.K) * unknown
    assert total == pytest.approx(1)


# -------------------------------------------------------------- toxicity

def toxic_corpus(n=600, seed=2):
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=40)
        bad = rng.random() < 0.3
        if bad:
            words[5] = rng.choice(["vile", "scoundrel"])
        if rng.random() < (0.8 if bad else 0.05):  # the group is mentioned mostly in toxic texts
            words[9] = rng.choice(["muslim", "gay", "women"])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity_holds_out_and_spares_groups(spark):
    docs, labels = toxic_corpus()
    d = spark.createDataFrame([(*r, 5.0) for r in docs], "doc_id long, text string, score double")
    l = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(d, l)
    got = {r.doc_id: r for r in toxicity.score_texts(d, model).collect()}
    assert all(r.held_out == (remainder(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    held = [(got[i].predicted, y) for i, _, y in labels if got[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.97
    groups = toxicity.identity_groups()
    vocab = {w: k for k, w in enumerate([w for g in groups for w in g] + [b"vile", b"scoundrel"])}
    rows = [sorted(vocab[w] for w in toxicity.words_of(t.encode()) & vocab.keys()) for _, t in docs]
    y = np.array([x[2] for x in labels], float)
    numbers = [[vocab[w] for w in g] for g in groups]
    free, tied = (toxicity.fit(rows, y, numbers, len(vocab), swap=s)[0] for s in (0.0, toxicity.SWAP))
    # the penalty lowers what a mention alone adds to a score
    assert abs(tied[vocab[b"muslim"]]) < abs(free[vocab[b"muslim"]])


def test_toxicity_equals_brute_force(spark):
    """Chosen words, features and scores against plain loops."""
    docs, labels = toxic_corpus(n=300, seed=5)
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, y string, lab_id int").repartition(3)
    l = spark.createDataFrame([(*r, "z") for r in labels], "doc_id long, quality int, toxic int, text string")
    model = toxicity.train(d, l)
    lab = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % toxicity.HELD_MOD != toxicity.HELD}
    rows = [(toxicity.words_of(t.encode()), lab[i]) for i, t in docs if i in lab]
    n, pos = len(rows), sum(y for _, y in rows)
    count, bad = {}, {}
    for w, y in rows:
        for x in w:
            count[x] = count.get(x, 0) + 1
            bad[x] = bad.get(x, 0) + y
    chi = {w: (bad[w] * n - c * pos) ** 2 / (c * (n - c + 1) * pos * (n - pos)) for w, c in count.items() if c >= toxicity.MIN_ROWS}
    chosen = sorted(chi, key=lambda w: (-chi[w], w))[:toxicity.MAX_WORDS]
    groups = toxicity.identity_groups()
    names = list(dict.fromkeys([w for g in groups for w in g] + chosen))
    vocab = {w: k for k, w in enumerate(names)}
    at = sorted((sorted(vocab[w] for w in ws if w in vocab), y) for ws, y in rows)
    w, b = toxicity.fit([a for a, _ in at], np.array([y for _, y in at], float), [[vocab[x] for x in g] for g in groups], len(names))
    assert model == {**{x: float(v) for x, v in zip(names, w)}, b"": b}
    for r in toxicity.score_texts(d, model).collect():
        z = b + sum(model.get(x, 0.0) for x in toxicity.words_of(dict(docs)[r.doc_id].encode()) if x)
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30)))) and r.predicted == (r.score >= 0.5)


def test_toxicity_sample_is_bounded_when_an_id_is_repeated(spark):
    docs = spark.createDataFrame([(1, f"word{k % 7} text {k}") for k in range(500)] + [(2, "calm words")], "doc_id long, text string")
    rows = toxicity._labelled(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"), "toxic", 10)
    at, y = toxicity._features(rows, {b"text": 0}, 10)
    assert len(at) == len(y) == 10
    assert rows.count() >= 500


def test_toxicity_edges(spark):
    d = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "x"), (4, "y " * 100_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(d, none)
    got = toxicity.score_texts(d, model).collect()
    assert len(got) == 5 and all(r.score == 0.5 for r in got)
    one = spark.createDataFrame([(1, 1, 1), (1, 0, None), (None, 1, 1), (4, 1, 1)], "doc_id long, quality int, toxic int")
    assert all(r.predicted == 1 for r in toxicity.score_texts(d, toxicity.train(d, one)).collect())
    assert toxicity.score_texts(d.limit(0), model).collect() == []


# ------------------------------------------------------------ language ID

ENDS = {"en": ["ing", "the", "tion", "wh"], "de": ["ung", "ich", "sch", "ä"], "fr": ["eau", "que", "é", "ç"]}


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(ENDS))
        out.append((i, " ".join("".join(rng.choices(ENDS[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 120))), lang))
    return out


def test_language_accuracy_and_edges(spark):
    rows = texts(500, 3)
    edge = [(9001, None, "en"), (9002, "", "de"), (9003, "123 !?", "fr"), (9004, "é", None), (None, "the ing", None), (9001, None, "en"), (9005, "schich " * 60_000, "de")]
    df = spark.createDataFrame([(*r, "s") for r in rows + edge], "doc_id long, text string, lang string, score string")
    got = langid.detect(df, langid.train(df)).collect()
    assert len(got) == len(rows) + len(edge)
    by = {r.doc_id: r for r in got}
    held = [by[i].lang_pred == lang for i, _, lang in rows if by[i].held_out]
    assert np.mean(held) > 0.95
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    assert [by[i].lang_pred for i in (9001, 9002, 9003)] == ["und"] * 3 and by[9004].lang_pred in ENDS and by[9005].lang_pred == "de"
    assert langid.detect(df.limit(0), langid.train(df.limit(0))).collect() == []


def test_language_sample_takes_equal_texts_once(spark, monkeypatch):
    rows = [(i, t, lang) for i, t, lang in texts(400, 5)]
    hot = [(1000 + i, "the ing wh tion", "en") for i in range(600)]
    df = spark.createDataFrame(rows + hot, "doc_id long, text string, lang string").repartition(4)
    seen = []
    monkeypatch.setattr(langid.Network, "fit", lambda self, x, y: seen.append((x, y, self.classes)) or self)
    for limit in (6000, 90):
        langid.train(df, limit)
        x, y, classes = seen.pop()
        known = {lang: {t for i, t, k in rows + hot if k == lang and remainder(i, langid.HELD_MOD) != langid.HELD} for lang in ENDS}
        first = {lang: {langid.windows(t.encode().lower())[0].tobytes() for t in known[lang]} for lang in ENDS}
        for k, lang in enumerate(classes):
            starts = [w.tobytes() for w, c in zip(x, y) if c == k and w.tobytes() in first[lang]]
            assert len(starts) == len(set(starts)) == min(len(known[lang]), limit // 3)


def test_language_tables_equal_the_convolution():
    net = langid.Network(["a", "b", "c"])
    x = np.random.default_rng(1).integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    e, peaks = net.p["emb"][x], []
    for w in langid.WIDTHS:
        cols = np.concatenate([e[:, j:langid.WINDOW - w + 1 + j] for j in range(w)], axis=2)
        peaks.append((cols @ net.p[f"f{w}"] + net.p[f"b{w}"]).max(1))
    z = np.maximum(np.concatenate(peaks, 1), 0) @ net.p["out"] + net.p["bias"]
    z = np.exp(z - z.max(1, keepdims=True))
    assert np.allclose(net.probabilities(x), z / z.sum(1, keepdims=True), atol=1e-4)


def test_language_gradients():
    net = langid.Network(["a", "b"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(2)
    x, y = rng.integers(97, 105, (4, langid.WINDOW)).astype(np.uint8), np.array([0, 1, 1, 0])

    def loss():
        e, peaks = net.p["emb"][x], []
        for w in langid.WIDTHS:
            cols = np.concatenate([e[:, j:langid.WINDOW - w + 1 + j] for j in range(w)], axis=2)
            peaks.append((cols @ net.p[f"f{w}"]).max(1) + net.p[f"b{w}"])
        z = np.maximum(np.concatenate(peaks, 1), 0) @ net.p["out"] + net.p["bias"]
        z -= z.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(4), y]))
    g = net._step(x, y)
    for k in ("out", "bias", "f2", "f4", "emb"):
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        net.p[k][at] += 1e-6
        up = loss()
        net.p[k][at] -= 2e-6
        down = loss()
        net.p[k][at] += 1e-6
        assert g[k][at] == pytest.approx((up - down) / 2e-6, rel=1e-2, abs=1e-7)


# ------------------------------------------------------------------- ANN

def run_ann(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(4)
    out = {}
    for r in sorted(ann.nearest(df, **kw).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_ann_recall_with_norms_and_copies(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16)) + rng.normal(size=(12, 16))[rng.integers(0, 12, 3000)] * 2
    x *= rng.uniform(0.5, 2, (3000, 1))
    x[500:1500] = x[500]  # a third are one vector
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    got, want = run_ann(spark, rows), ann.nearest_exact(rows)
    assert set(got) == set(want)
    recall = []
    for q, exact in want.items():
        assert [r for r, _, _ in got[q]] == list(range(1, 21)) and q not in [i for _, i, _ in got[q]]
        keys = [(-s, i) for _, i, s in got[q]]
        assert keys == sorted(keys)
        y = np.array(rows[q][1])
        assert all(s == pytest.approx(float(np.dot(y, np.array(rows[i][1]))), abs=1e-9) for _, i, s in got[q])
        recall.append(len({i for i, _ in exact} & {i for _, i, _ in got[q]}) / 20)
    assert np.mean(recall) >= 0.95


def test_ann_small_and_unusable(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
            (40, [float("inf"), 1.0]), (None, [1.0, 2.0]), (7, []), (8, [-1.0, -1.0]), (9, [1.0, 1.0]), (11, [0.5]), (60, [0.0, 0.0, -2.0])]
    got = run_ann(spark, rows)
    # vectors of other lengths count as padded with zeros
    assert got == {0: [(1, 1, 1.0), (2, 9, 1.0), (3, 11, 0.5), (4, 20, 0.0), (5, 60, 0.0), (6, 8, -1.0)],
                   20: [(1, 1, 1.0), (2, 9, 1.0), (3, 0, 0.0), (4, 11, 0.0), (5, 60, 0.0), (6, 8, -1.0)],
                   60: [(i + 1, v, 0.0) for i, v in enumerate([0, 1, 8, 9, 11, 20])]}
    assert run_ann(spark, []) == {} and run_ann(spark, [(0, [1.0])]) == {}


def test_ann_splits_large_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 16)
    monkeypatch.setattr(ann, "BUCKET", 50)
    monkeypatch.setattr(ann, "QUERIES_AT_ONCE", 3)
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(400, 8)))]
    got, want = run_ann(spark, rows), ann.nearest_exact(rows)
    assert np.mean([len({i for i, _ in want[q]} & {i for _, i, _ in got[q]}) / 20 for q in want]) >= 0.95


@pytest.mark.parametrize("sigma, clustered", [(0.0, False), (0.5, False), (1.0, True)])
def test_ann_recall_with_many_lists_and_unequal_lengths(spark, monkeypatch, sigma, clustered):
    monkeypatch.setattr(ann, "LIST_SIZE", 8)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6000, 24))
    if clustered:
        x = rng.normal(size=(150, 24))[rng.integers(150, size=6000)] + 0.4 * x
    x *= np.exp(sigma * rng.normal(size=(6000, 1)))
    made = []

    def kept(*args):
        made.append(args[0])
        return fit(*args)
    fit = ann._fit_ratio
    monkeypatch.setattr(ann, "_fit_ratio", kept)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    got, want = run_ann(spark, rows), ann.nearest_exact(rows)
    assert len(made[0].cells) > 500
    assert all(len(got[q]) == 20 for q in want)
    assert np.mean([len({i for i, _ in want[q]} & {i for _, i, _ in got[q]}) / 20 for q in want]) >= 0.95
    size = np.sort(made[0].size[made[0].cells])[::-1]
    assert size[:len(size) // 5].sum() < 0.5 * size.sum()  # the lists are balanced


def test_ann_sends_a_query_once_however_many_lists_it_asks(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(ann, "LIST_SIZE", 4)
    monkeypatch.setattr(ann, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    rng = np.random.default_rng(9)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(400, 8)))]
    got, want = run_ann(spark, rows), ann.nearest_exact(rows)
    assert np.mean([len({i for i, _ in want[q]} & {i for _, i, _ in got[q]}) / 20 for q in want]) >= 0.95
    # each asks several of the lists
    assert spark.read.parquet(f"{tmp_dir}/ann/asked").count() == len(want)


def test_ann_scan_keeps_the_best_and_counts_an_entry_once():
    rng = np.random.default_rng(10)
    v = rng.integers(-3, 4, (300, 5)).astype(float)  # many equal scores
    at = np.concatenate([rng.permutation(300), rng.permutation(300)[:150]])  # half stand in two lists
    low = rng.permutation(300)[at]
    holds = np.array_split(rng.permutation(len(at)), 12)
    y = rng.integers(-3, 4, (40, 5)).astype(float)
    asks = rng.random((12, 40)) < 0.6
    i, j, s = ann._best(y, [np.flatnonzero(a) for a in asks], v[at], holds, low, at, 7)
    for q in range(40):
        there = {(-float(y[q] @ v[at[x]]), int(low[x]), int(at[x])) for a, h in zip(asks, holds) if a[q] for x in h}
        assert [(-a, int(low[b]), int(at[b])) for a, b in zip(s[i == q], j[i == q])] == sorted(there)[:7]


def test_few_points_are_searched_exactly(monkeypatch):
    rng = np.random.default_rng(11)
    points, q = rng.normal(size=(700, 9)), rng.normal(size=(300, 9))
    ids, score = ann.PointGraph(points).search(q, 8)
    assert (ids == np.argsort(-(q @ points.T), 1)[:, :8]).all() and np.allclose(score, -np.sort(-(q @ points.T), 1)[:, :8])
    monkeypatch.setattr(ann, "DIRECT", 0)  # and over the graph, nearly
    walked = ann.PointGraph(points).search(q, 8)[0]
    assert np.mean([len({*a} & {*b}) / 8 for a, b in zip(ids, walked)]) > 0.9


def test_ann_fills_every_answer(spark, monkeypatch):
    """A query whose lists hold too few vectors gets more lists."""
    monkeypatch.setattr(ann, "LIST_SIZE", 4)
    monkeypatch.setattr(ann, "_fit_ratio", lambda *args: (1.0, 2))
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(300, 6)) * np.exp(2 * rng.normal(size=(300, 1))))]
    got = run_ann(spark, rows)
    assert set(got) == set(range(0, 300, 20)) and all(len(v) == 20 for v in got.values())


def test_balanced_directions_and_extreme_lengths(spark):
    rng = np.random.default_rng(8)
    x = ann.units(rng.normal(size=(6000, 16)) + 2 * rng.normal(size=(3, 16))[rng.integers(3, size=6000)])
    c, weight = ann.balanced_directions(x, 200)
    load = np.sort(np.bincount(ann._owners(x, c, weight)[0], minlength=len(c)))[::-1]
    assert np.allclose((c * c).sum(1), 1) and load[:len(load) // 5].sum() < 0.45 * len(x)
    big = np.array([[1e300, 1e300], [1e-300, 0], [3, 4]])
    assert ann.lengths(big)[2] == 5 and np.isfinite(ann.lengths(big)).all() and np.allclose((ann.units(big) ** 2).sum(1), 1)
    got = run_ann(spark, [(0, [1e30, 1.0]), (20, [1e-30, 0.0]), (1, [1.0, 2.0]), (2, [-1e-40, 1e-40])])
    assert [len(got[q]) for q in (0, 20)] == [3, 3] and got[0][0][1] == 1
